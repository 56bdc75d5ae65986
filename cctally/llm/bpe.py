"""Operator 10: BPE encoding and decoding with a pair occurrence index.

A tokenizer file of the ``tokenizers`` library is read (vocabulary, merges,
special tokens); nothing is trained. Its pattern never matches white space,
so a text is encoded as its white-space-separated words, each distinct word
once per task. The pieces of all new words of a slice are laid out in one
array; an index maps each pair that can merge to all its positions there. The
active pairs are applied in ascending rank, each at all its positions from
left to right, and the lists of the pairs that arise beside it are updated.

The work is one narrow pass: no shuffle, and a task keeps at most
``CACHE_WORDS`` words (the cache is emptied when full; results do not change).

Defined results: a null text is encoded as an empty one: no tokens, the digest
of the empty string. Special tokens' strings in a text become their ids, as
the library does by default. Repeated rows and null ids are encoded each.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cctally.llm.common import slices

CACHE_WORDS = 600_000
ENCODE_BYTES = 8_000_000


#: Number of tokens, their decimal ids joined by blanks, their decoded text.
Piece = tuple[int, str, str]


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Tokenizer:
    """The parts of a word-end BPE tokenizer file that encoding and decoding need."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, added = spec["model"], spec["added_tokens"]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        if (kinds != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE" or level["add_prefix_space"]
                or level["use_regex"] or not split["invert"] or split["behavior"] != "Removed" or spec["decoder"]
                or any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized"))):
            raise ValueError("this tokenizer file uses parts that are not supported")
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        self.token = {i: t for t, i in self.vocab.items()} | {a["id"]: a["content"] for a in added}
        self.number = {i: str(i) for i in self.token}
        self.pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"), regex.V0)
        self.special = {a["content"]: a["id"] for a in added}
        self.special_pattern = regex.compile("(" + "|".join(
            regex.escape(x) for x in sorted(self.special, key=len, reverse=True)) + ")") if added else None
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.pairs: list[tuple[int, int]] = []
        made: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ids = (self.vocab[a], self.vocab[b])
            new = self.vocab[a + b]
            if max(made.get(ids[0], -1), made.get(ids[1], -1)) >= rank:
                raise ValueError("a merge stands before one that makes its part")
            made.setdefault(new, rank)
            self.merges[ids] = (rank, new)
            self.pairs.append(ids)
        letters = byte_letters()
        self.letters = letters
        self.size = max(self.vocab.values()) + 1
        keys = np.array([a * self.size + b for a, b in self.merges], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.merges.values()], np.int64)[order]
        self.first = {x: self.vocab[x] for x in letters}
        self.last = {x: self.vocab[x + self.suffix] for x in letters}
        self.first_ids, self.last_ids = np.zeros((2, 512), np.int64)
        for x in letters:
            self.first_ids[ord(x)], self.last_ids[ord(x)] = self.first[x], self.last[x]

    def _ranks(self, symbol: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, position) of the pairs that can merge, in order of rank and position."""
        key = symbol[left] * self.size + symbol[right]
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        good = self.pair_keys[at] == key
        rank, left = self.pair_ranks[at[good]], left[good]
        order = np.lexsort((left, rank))
        return rank[order], left[order]

    def apply_merges(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each piece (a string of byte letters), by the pair occurrence index."""
        if not pieces or not self.pairs:
            return [[*[self.first[c] for c in p[:-1]], self.last[p[-1]]] for p in pieces]
        letters = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        end = np.cumsum([len(p) for p in pieces])
        begin = np.r_[0, end[:-1]]
        symbol = self.first_ids[letters]
        symbol[end - 1] = self.last_ids[letters[end - 1]]
        after, before = np.arange(1, len(symbol) + 1), np.arange(-1, len(symbol) - 1)
        after[end - 1], before[begin] = -1, -1
        positions: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(left, right):
            rank, left = self._ranks(symbol, left, right)
            cut = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            for r, part in zip(rank[np.r_[0, cut]].tolist() if len(rank) else [], np.split(left, cut), strict=False):
                if r not in positions:
                    positions[r] = []
                    heapq.heappush(active, r)
                positions[r].append(part)

        first = np.flatnonzero(after >= 0)
        add(first, after[first])
        while active:
            rank = heapq.heappop(active)
            a, b = self.pairs[rank]
            i = np.unique(np.concatenate(positions.pop(rank)))
            j = after[i]
            good = (symbol[i] == a) & (j >= 0)
            i, j = i[good], j[good]
            i = i[symbol[j] == b]
            if a == b and len(i) > 1:  # of overlapping pairs, the leftmost merge
                used, keep = -1, []
                for x, y in zip(i.tolist(), after[i].tolist(), strict=True):
                    if x != used:
                        keep.append(x)
                        used = y
                i = np.array(keep)
            j = after[i]
            k = after[j]
            symbol[i], symbol[j] = self.merges[a, b][1], -1
            after[i], after[j] = k, -1
            before[k[k >= 0]] = i[k >= 0]
            h = before[i]
            add(np.concatenate([h[h >= 0], i[k >= 0]]), np.concatenate([i[h >= 0], k[k >= 0]]))
        left = symbol[symbol >= 0].tolist()
        stop = np.cumsum(np.add.reduceat(symbol >= 0, begin, dtype=np.int64)).tolist()
        return [left[x:y] for x, y in zip([0, *stop], stop, strict=False)]

    def encode_words(self, words: Iterable[str]) -> dict[str, list[Piece]]:
        """The pieces, with their ids, of each distinct word (a run without white space)."""
        words = list(words)
        whole = "\n".join(words)
        if not any(x in whole for x in self.special):
            low = unicodedata.normalize("NFC", whole).replace("Σ", "σ").lower().split("\n")
            parts = dict(zip(words, map(self.pattern.findall, low), strict=True)) if words else {}
        else:
            parts = {}
            for word in words:
                found: list = []
                for k, part in enumerate(self.special_pattern.split(word)):
                    if k % 2:
                        found.append(self.special[part])
                    elif part:
                        text = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                        found += self.pattern.findall(text)
                parts[word] = found
        distinct = list({x for found in parts.values() for x in found})
        texts = [x for x in distinct if isinstance(x, str)]
        spelled = ["".join(map(self.letters.__getitem__, x.encode("utf-8"))) for x in texts]
        made = {x: self._piece(ids) for x, ids in zip(texts, self.apply_merges(spelled), strict=True)}
        made |= {x: self._piece([x]) for x in distinct if isinstance(x, int)}
        return {word: [made[x] for x in found] for word, found in parts.items()}

    def _piece(self, ids: list[int]) -> Piece:
        return len(ids), " ".join(map(self.number.__getitem__, ids)), self.decode(ids)

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens joined by blanks: the file names no decoder. Unknown ids are left out."""
        return " ".join([self.token[i] for i in ids if i in self.token])


_SPLIT = regex.compile(r"\p{White_Space}+")


def split_words(texts: pa.Array) -> pa.ListArray:
    """The runs between Unicode white space of each text (null: none)."""
    texts = pc.fill_null(texts, "")
    if pc.any(pc.match_substring_regex(texts, "[\x1c-\x1f]")).as_py():  # white space to Arrow, but not to Unicode
        return pa.array([[w for w in _SPLIT.split(t) if w] for t in texts.to_pylist()], pa.list_(pa.string()))
    words = pc.utf8_split_whitespace(texts)
    flat, parents = words.flatten(), pc.list_parent_indices(words)
    keep = pc.not_equal(pc.binary_length(flat), 0)
    count = np.bincount(parents.filter(keep).to_numpy(), minlength=len(texts))
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)], pa.int32()), flat.filter(keep))


class Encoder:
    """Encodes texts with a bounded cache of words: count, ids as text, decoded text."""

    def __init__(self, tokenizer: Tokenizer, size: int = CACHE_WORDS):
        self.tokenizer, self.size = tokenizer, size
        self.cache: dict[str, Piece] = {}

    def _learn(self, words: Iterable[str]) -> None:
        for word, found in self.tokenizer.encode_words(words).items():
            if len(found) == 1:
                self.cache[word] = found[0]
            else:
                self.cache[word] = (sum([x[0] for x in found]), " ".join([x[1] for x in found]),
                                    " ".join([x[2] for x in found]))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Of each text: number of tokens, decimal ids joined by a blank, decoded text."""
        split = split_words(texts)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.cache]
        if len(self.cache) + len(new) > self.size:
            self.cache, new = {}, words
        self._learn(new)
        found = list(map(self.cache.__getitem__, words))
        at = coded.indices.to_numpy()
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        counts = np.array([x[0] for x in found], np.int64)
        totals = np.r_[0, np.cumsum(counts[at])]
        held = counts[at] > 0
        lists = pa.array(np.r_[0, np.cumsum(held)][offsets], pa.int32())
        indices = pa.array(at[held])
        joined = [pc.binary_join(pa.ListArray.from_arrays(lists, pa.array([x[k] for x in found], pa.string())
                                                          .take(indices)), " ") for k in (1, 2)]
        return totals[offsets[1:]] - totals[offsets[:-1]], *joined


def _encode(spec: str, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Tokenizer(spec))
        gc.disable()  # millions of small tuples and no cycles: scanning them costs a quarter of the time
        sha = lambda column: pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in column], pa.string())
        for batch in batches:
            for start, texts in slices(batch.column(1), ENCODE_BYTES):
                counts, ids, decoded = encoder.encode(texts)
                columns = [batch.column(0).slice(start, len(texts)), pa.array(counts, pa.int64())]
                names = ["doc_id", "n_tokens"]
                if keep_text:
                    columns += [pa.array([[int(i) for i in x.split()] for x in ids.to_pylist()], pa.list_(pa.int32())),
                                decoded]
                    names += ["ids", "decoded"]
                else:
                    columns += [sha(ids), sha(decoded)]
                    names += ["ids_sha256", "decoded_sha256"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` of every text; the tokenizer file is read on the driver."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    return _source(docs).mapInArrow(_encode(spec, True), "doc_id long, n_tokens long, ids array<int>, decoded string")


def digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of the same encoding, without moving the ids."""
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = f.read()
    return _source(docs).mapInArrow(
        _encode(spec, False), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
