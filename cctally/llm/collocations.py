"""Operator 13: phrase collocations mined with stripes.

A stripe belongs to a prefix phrase and maps each next word to a count. One
merged structure, level by level, gives everything the ranking needs: its
entries are the extensions of the prefix, the entry's count is the count of
the longer phrase, and the greatest count among a phrase's extensions to the
right or left (the *subsumption maximum*) tells whether a longer phrase
replaces it.

1. A narrow pass cuts the texts into blocks of bounded bytes and turns each
   into its distinct words and an array of word numbers. Word counts per
   language are summed over all blocks; words with the least count get global
   numbers, which return to the blocks that hold them.
2. At each level a block builds its stripes: for each prefix it holds, the
   next words in ascending order with their counts, written as differences of
   one to two bytes. Only prefixes and suffixes that reached the least count
   over the whole corpus take part; a phrase that reaches it has only such
   parts, so nothing is lost.
3. Stripes of one prefix meet in sorted partitions and are merged elementwise
   as a stream. A stripe is cut into segments by a hash of the next word, in
   proportion to the prefix's count, so that none holds much more than
   1 / ``SPLIT`` of all occurrences. Entries that reach the least count are
   numbered and return to the blocks.
4. Cuts, scores and the greatest extension counts are joins and grouped
   aggregates over the phrases that were kept, in exact decimals.

A block passes on only the stretches of text that can still grow. No step
holds more than a block, a segment or an Arrow batch; nothing is broadcast by a
hint. Stripes are built twice, for the merge and for the return, and not kept.

Defined results: a null text is empty; a null language is ``und``. Repeated
rows count each time. An empty table gives no rows. ``doc_id`` and other
columns are not read. Ties of score and count are in byte order of the phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cctally.llm.common import mix, slices, stage
from cctally.operators.dedup import number_in_order

MAX_WORDS, MIN_COUNT, TOP = 5, 100, 2000
#: Bytes of text of a block (or one longer text).
BLOCK_BYTES = 12_000_000
#: A prefix that holds 1 / SPLIT of all words has one segment, a more frequent one several.
SPLIT = 1000
#: Words of a block's vocabulary in one Arrow batch.
VOCABULARY_ROWS = 50_000

_BLANKS, _BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANKS)], _KIND[list(_BREAKS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of the texts in order, the text of each, and the running number of its piece."""
    empty, line = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    lines = pc.binary_join_element_wise(pc.fill_null(texts, "").cast(pa.large_string()), line, empty)
    n = len(lines)
    _, offsets, data = lines.buffers()
    offsets = np.frombuffer(offsets, np.int64)[lines.offset:lines.offset + n + 1]
    data = _LOWER[np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]]
    kind = _KIND[data]
    inside = kind == 0
    edge = np.diff(inside.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    ends = np.r_[0, np.cumsum(end - start)]
    words = pa.Array.from_buffers(pa.large_binary(), len(start), [
        None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[inside]))])
    piece = np.cumsum(kind == 2, dtype=np.int32)[start] if len(start) else np.empty(0, np.int32)
    doc = np.searchsorted(offsets - offsets[0], start, side="right") - 1
    return words, doc, piece


_CODEC = "zstd"


def packed(x: np.ndarray | None) -> bytes | None:
    """An array as its length and its compressed bytes."""
    return None if x is None else len(x).to_bytes(8, "little") + pa.compress(x.tobytes(), _CODEC, asbytes=True)


def unpacked(field: bytes | None, kind) -> np.ndarray | None:
    if field is None:
        return None
    size = int.from_bytes(field[:8], "little") * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(field[8:], size, _CODEC) if size else b"", kind)


_BLOCKS = "block long, tokens binary, pos int, lang string, word string, n long"


def _blocks(block_bytes: int):
    return lambda batches: _read_blocks(batches, block_bytes)


def _coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words in order of appearance, number of each word, its text, the words that begin a piece).

    The texts are split a slice at a time, so that only numbers of all words are held at once.
    """
    distinct, codes, docs, breaks, n = [], [], [], [], 0
    for first, part in slices(texts):
        words, doc, piece = tokens_of(part)
        if not len(words):
            continue
        coded = words.dictionary_encode()
        distinct.append(coded.dictionary)
        codes.append(coded.indices.to_numpy())
        docs.append((doc + first).astype(np.int32))
        breaks.append(np.flatnonzero(np.diff(piece, prepend=-1)) + n)  # a text ends a piece
        n += len(words)
    if not n:
        return pa.array([], pa.large_binary()), *[np.empty(0, np.int32)] * 3
    both = pa.concat_arrays(distinct).dictionary_encode()
    place, at = both.indices.to_numpy(), 0
    for k, words in enumerate(distinct):
        codes[k] = place[at:at + len(words)][codes[k]]
        at += len(words)
    return both.dictionary, np.concatenate(codes), np.concatenate(docs), np.concatenate(breaks)[1:]


def _numbers(key: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys ascending, place of each key among them, count of each) of keys below ``most``."""
    if most > 4 * len(key):
        return np.unique(key, return_inverse=True, return_counts=True)
    count = np.bincount(key, minlength=most)
    found = np.flatnonzero(count)
    place = np.zeros(most, np.int32)
    place[found] = np.arange(len(found), dtype=np.int32)
    return found, place[key], count[found]


def _read_blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("block", pa.int64()), ("tokens", pa.binary()), ("pos", pa.int32()), ("lang", pa.string()),
                        ("word", pa.string()), ("n", pa.int64())])
    block = TaskContext.get().partitionId() << 33
    for batch in batches:
        langs = batch.column(0)
        for first, texts in slices(batch.column(1), block_bytes):
            distinct, code, doc, breaks = _coded(texts)
            if not len(code):
                continue
            spoken = pc.fill_null(langs.slice(first, len(texts)), "und").dictionary_encode()
            size = len(distinct)
            key = spoken.indices.to_numpy().astype(np.int64)[doc] * size + code
            vocabulary, local, count = _numbers(key, len(spoken.dictionary) * size)
            tokens = np.insert(local.astype(np.int32), breaks, -1)
            del code, doc, key, local
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([packed(tokens)], pa.binary()),
                 *[pa.nulls(1, f.type) for f in list(schema)[2:]]], schema=schema)
            del tokens
            # the vocabulary in pieces: each is a batch on both sides
            for k in range(0, len(vocabulary), VOCABULARY_ROWS):
                part = vocabulary[k:k + VOCABULARY_ROWS]
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block)), pa.nulls(n, pa.binary()), pa.array(np.arange(k, k + n, dtype=np.int32)),
                     spoken.dictionary.cast(pa.string()).take(pa.array(part // size)),
                     distinct.take(pa.array(part % size)).cast(pa.string()), pa.array(count[k:k + n], pa.int64())],
                    schema=schema)
            block += 1


def prune(words: np.ndarray, grams: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions that lie in some kept phrase of ``length`` words, one gap (-1) left between stretches."""
    step = np.zeros(len(words) + length + 1, np.int64)
    at = np.flatnonzero(grams >= 0)
    step[at] += 1
    step[at + length] -= 1
    covered = np.cumsum(step)[:len(words)] > 0
    keep = covered.copy()
    keep[1:] |= covered[:-1]
    return np.where(covered, words, -1)[keep], np.where(covered, grams, -1)[keep]


def stripes(words: np.ndarray, grams: np.ndarray, length: int, size: int):
    """(prefix, next word, count) of the phrases of ``length`` words, and the entry at each position (or -1).

    ``grams`` holds the kept phrase of ``length - 1`` words that begins at
    each position, or -1. A phrase counts when both its prefix and its suffix
    are kept.
    """
    at = np.flatnonzero((grams[:-1] >= 0) & (grams[1:] >= 0))
    key, entry, count = np.unique(grams[at].astype(np.int64) * size + words[at + length - 1],
                                  return_inverse=True, return_counts=True)
    found = np.full(len(words), -1, np.int32)
    found[at] = entry
    return key // max(size, 1), key % max(size, 1), count, found


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in groups of seven bits, low first, the last byte of each below 128; and the size of each."""
    size = np.ones(len(values), np.int64)
    rest = values >> 7
    while rest.any():
        size += rest > 0
        rest = rest >> 7
    begin = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    for k in range(int(size.max(initial=0))):
        at = np.flatnonzero(size > k)
        out[begin[at] + k] = (values[at] >> (7 * k)) & 127 | np.where(size[at] > k + 1, 128, 0)
    return out, size


def read_varints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers written by ``varints`` and the last byte of each."""
    last = np.flatnonzero(data < 128)
    if not len(last):
        return np.empty(0, np.int64), last
    begin = np.r_[0, last[:-1] + 1]
    shift = 7 * (np.arange(len(data)) - np.repeat(begin, last - begin + 1))
    return np.add.reduceat((data & 127).astype(np.int64) << shift, begin), last


def _blobs(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(sizes), [
        None, pa.py_buffer(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.py_buffer(data)])


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes of a binary column without nulls, row ends)."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets[1:] - offsets[0]


def _entries(nexts: pa.Array, counts: pa.Array | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, next word, count) of the entries of a column of stripes."""
    data, ends = _bytes(nexts)
    value, last = read_varints(data)
    row = np.searchsorted(ends, last, side="right")
    step = np.cumsum(value >> 1)
    first = np.searchsorted(row, np.arange(len(nexts)))
    before = np.r_[0, step][first]
    count = np.ones(len(value), np.int64)
    if counts is not None:
        count[value & 1 == 1] = read_varints(_bytes(counts)[0])[0]
    return row, step - before[row], count


_STATE = "block long, words binary, ids binary, grams binary, numbers binary, splits binary"


class Block:
    """What can still grow of a block: word and prefix at each position, -1 for none; their global numbers."""

    def __init__(self, words, ids, grams, numbers, splits):
        self.words, self.ids, self.grams, self.numbers, self.splits = words, ids, grams, numbers, splits

    def row(self, block: int) -> pa.RecordBatch:
        fields = [packed(x) for x in (self.words, self.ids, self.grams, self.numbers, self.splits)]
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), *[pa.array([f], pa.binary()) for f in fields]],
            names=[x.split()[0] for x in _STATE.split(", ")])

    @staticmethod
    def read(fields: list) -> Block:
        """From the binary fields of a row; single words are their own prefixes and not written twice."""
        words, ids, grams, numbers, splits = map(unpacked, fields, (np.int32, np.int64, np.int32, np.int64, np.int32))
        return Block(words, ids, words if grams is None else grams, ids if numbers is None else numbers, splits)

    def stripes(self, length: int):
        """Rows of ``prefix, seg, nexts, counts``."""
        prefix, after, count, _ = stripes(self.words, self.grams, length, len(self.ids))
        after = self.ids[after]
        first = np.cumsum(self.splits) - self.splits
        part = (mix(after.astype(np.uint64)) % self.splits[prefix].astype(np.uint64)).astype(np.int64)
        group = first[prefix] + part
        order = np.argsort(group, kind="stable")
        group, prefix, part, after, count = (x[order] for x in (group, prefix, part, after, count))
        new = np.r_[True, group[1:] != group[:-1]] if len(group) else np.empty(0, bool)
        step = np.diff(after, prepend=0)
        step[new] = after[new]
        many = count > 1
        nexts, size = varints(step << 1 | many)
        counts, more = varints(count[many])
        wide = np.zeros(len(count), np.int64)
        wide[many] = more
        at = np.flatnonzero(new)
        if not len(at):
            return None
        return [pa.array(self.numbers[prefix[at]]), pa.array(part[at].astype(np.int32)),
                _blobs(nexts, np.add.reduceat(size, at)), _blobs(counts, np.add.reduceat(wide, at))]

    def advance(self, length: int, prefix: np.ndarray, after: np.ndarray, number: np.ndarray, split: np.ndarray) -> Block:
        """The block with phrases of ``length`` words for prefixes, of which it holds (prefix, next word, number, split)."""
        by = np.argsort(self.numbers)
        left = by[np.searchsorted(self.numbers, prefix, sorter=by)]
        right = np.searchsorted(self.ids, after)  # ids ascend
        key = left.astype(np.int64) * len(self.ids) + right
        order = np.argsort(key)
        key, number, split = key[order], number[order], split[order]
        at = np.flatnonzero((self.grams[:-1] >= 0) & (self.grams[1:] >= 0))
        mine = self.grams[at].astype(np.int64) * len(self.ids) + self.words[at + length - 1]
        place = np.minimum(np.searchsorted(key, mine), len(key) - 1)
        grams = np.full(len(self.words), -1, np.int32)
        grams[at] = np.where(key[place] == mine, place, -1)
        words, grams = prune(self.words, grams, length)
        return Block(words, self.ids, grams, number, split)


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the numbers of their kept words -> what can grow."""
    for batch in batches:
        for block, tokens, kept in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            pos, number, split = (kept.values.field(x).to_numpy() for x in ("pos", "id", "split"))
            order = np.argsort(number)
            tokens = unpacked(tokens.as_py(), np.int32)
            place = np.full(max(int(tokens.max()), int(pos.max())) + 2, -1, np.int32)  # the last stays -1, for gaps
            place[pos[order]] = np.arange(len(pos), dtype=np.int32)
            words = place[tokens]
            words, _ = prune(words, words, 1)
            yield Block(words, number[order], None, None, split[order]).row(block)


def _stripes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, block in enumerate(batch.column(0).to_pylist()):
                found = Block.read([batch.column(c)[k].as_py() for c in range(1, 6)]).stripes(length)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found[0]), block)), *found],
                                                     names=["block", "prefix", "seg", "nexts", "counts"])
    return run


def _advance(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, block in enumerate(batch.column(0).to_pylist()):
                kept = batch.column(6)[k].values
                yield Block.read([batch.column(c)[k].as_py() for c in range(1, 6)]).advance(
                    length, *[kept.field(x).to_numpy() for x in ("prefix", "next", "id", "split")]).row(block)
    return run


def _sums(group: np.ndarray, after: np.ndarray, count: np.ndarray):
    """Elementwise sum of stripes: (group, next word, count), each once and in order."""
    order = np.lexsort((after, group))
    group, after, count = group[order], after[order], count[order]
    at = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (after[1:] != after[:-1])]) if len(group) else order
    return group[at], after[at], np.add.reduceat(count, at) if len(at) else count


def _merge(least: int):
    """Stripes sorted by prefix and segment -> ``prefix, seg, next, a`` of the entries with the least count."""
    def out(prefix, seg, after, count):
        good = count >= least
        return pa.RecordBatch.from_arrays([pa.array(x[good]) for x in (prefix, seg, after, count)],
                                          names=["prefix", "seg", "next", "a"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # prefix, segment, next words and counts of the stripe that the next batch may go on with
        for batch in batches:
            if not batch.num_rows:
                continue
            prefix, seg = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            row, after, count = _entries(batch.column(2), batch.column(3))
            change = np.r_[False, (prefix[1:] != prefix[:-1]) | (seg[1:] != seg[:-1])]
            group = np.cumsum(change)
            if held is not None and (held[0], held[1]) == (prefix[0], seg[0]):
                after, count = np.r_[held[2], after], np.r_[held[3], count]
                row = np.r_[np.zeros(len(held[2]), np.int64), row]
            elif held is not None:
                n = len(held[2])
                yield out(np.full(n, held[0]), np.full(n, held[1], np.int32), held[2], held[3])
            number, after, count = _sums(group[row], after, count)
            heads = np.flatnonzero(np.r_[True, change[1:]])
            done = int(np.searchsorted(number, group[-1]))
            yield out(prefix[heads][number[:done]], seg[heads][number[:done]], after[:done], count[:done])
            held = prefix[-1], seg[-1], after[done:], count[done:]
        if held is not None:
            n = len(held[2])
            yield out(np.full(n, held[0]), np.full(n, held[1], np.int32), held[2], held[3])
    return run


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stripes of blocks beside the kept entries of their segment -> the kept entries that the block has."""
    for batch in batches:
        if not batch.num_rows:
            continue
        row, after, _ = _entries(batch.column(2), None)
        kept = batch.column(3)
        owner = pc.list_parent_indices(kept).to_numpy()
        entry = kept.flatten()
        after_kept = entry.field("next").to_numpy()
        have, want = row << 44 | after, owner << 44 | after_kept  # both ascend
        place = np.minimum(np.searchsorted(have, want), len(have) - 1)
        good = have[place] == want
        owner = owner[good]
        yield pa.RecordBatch.from_arrays(
            [pa.array(batch.column(0).to_numpy()[owner]), pa.array(batch.column(1).to_numpy()[owner]),
             pa.array(after_kept[good]), *[pa.array(entry.field(x).to_numpy()[good]) for x in ("id", "split")]],
            names=["block", "prefix", "next", "id", "split"])


def _numbered(counts: DataFrame, order: list, share: float, name: str) -> DataFrame:
    """``counts`` with a number ``id`` and the segments ``split`` of each phrase, written."""
    split = F.ceil(F.col("a") * share).cast("int")
    return stage(number_in_order(counts, order, "id").withColumn("split", split), name)


def phrases(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, block_bytes: int = BLOCK_BYTES,
            split: int = SPLIT) -> tuple[DataFrame, DataFrame]:
    """All phrases that occur ``min_count`` times, and the number of words of each language.

    ``lang, phrase, n_words, a`` for 1 to ``max_words`` words; ``lang, n``.
    """
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    blocks = stage(rows.mapInArrow(_blocks(block_bytes), _BLOCKS), "collocation_blocks")
    vocabulary = blocks.filter("word IS NOT NULL")
    totals = stage(vocabulary.groupBy("lang").agg(F.sum("n").alias("n")), "collocation_totals")
    share = split / (totals.agg(F.sum("n")).first()[0] or 1)
    kept = _numbered(
        vocabulary.groupBy("lang", "word").agg(F.sum("n").alias("a")).filter(F.col("a") >= min_count),
        [F.col("a").desc(), F.col("lang"), F.col("word")], share, "collocation_words")
    known = single = kept.select("id", "lang", F.col("word").alias("phrase"), "a")
    found = [single.withColumn("n_words", F.lit(1))]
    back = vocabulary.join(kept.select("lang", "word", "id", "split"), ["lang", "word"]).groupBy("block").agg(
        F.collect_list(F.struct("pos", "id", "split")).alias("kept"))
    state = stage(blocks.filter("tokens IS NOT NULL").select("block", "tokens").join(back, "block").select(
        "block", "tokens", "kept").mapInArrow(_first, _STATE), "collocation_state_1")
    for length in range(2, max_words + 1):
        held = state.mapInArrow(_stripes(length), "block long, prefix long, seg int, nexts binary, counts binary")
        merged = held.select("prefix", "seg", "nexts", "counts").repartition("prefix", "seg").sortWithinPartitions(
            "prefix", "seg").mapInArrow(_merge(min_count), "prefix long, seg int, next long, a long")
        kept = _numbered(merged, [F.col("prefix"), F.col("next")], share, f"collocation_kept_{length}")
        known = stage(
            kept.join(known.select(F.col("id").alias("prefix"), "lang", F.col("phrase").alias("head")), "prefix")
            .join(single.select(F.col("id").alias("next"), F.col("phrase").alias("tail")), "next")
            .select("id", "lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "a"), f"collocation_phrases_{length}")
        found.append(known.withColumn("n_words", F.lit(length)))
        if length == max_words:
            break
        segments = stage(kept.groupBy("prefix", "seg").agg(
            F.sort_array(F.collect_list(F.struct("next", "id", "split"))).alias("kept")), f"collocation_segments_{length}")
        back = held.select("block", "prefix", "seg", "nexts").join(segments, ["prefix", "seg"]).select(
            "block", "prefix", "nexts", "kept").mapInArrow(
            _match, "block long, prefix long, next long, id long, split int").groupBy("block").agg(
            F.collect_list(F.struct("prefix", "next", "id", "split")).alias("kept"))
        state = stage(state.join(back, "block").select("block", "words", "ids", "grams", "numbers", "splits", "kept")
                      .mapInArrow(_advance(length), _STATE), f"collocation_state_{length}")
    out = found[0]
    for level in found[1:]:
        out = out.unionByName(level)
    return out.select("lang", "phrase", "n_words", "a"), totals


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, **bounds) -> DataFrame:
    """``lang, phrase, n_words, a, l, r, n, score`` of every phrase of two words or more that no longer one replaces."""
    counted, totals = phrases(docs, max_words, min_count, **bounds)
    counted = stage(counted, "collocation_phrases")
    candidates = counted.filter("n_words > 1")
    part = counted.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    word = F.split("phrase", " ", -1)
    cut = candidates.select("lang", "phrase", "n_words", "a", word.alias("w"), F.explode(
        F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "n_words", "a", "k",
                     F.concat_ws(" ", F.slice("w", F.lit(1), F.col("k"))).alias("first"),
                     F.concat_ws(" ", F.slice("w", F.col("k") + 1, F.col("n_words") - F.col("k"))).alias("rest"))
    cut = (cut.join(part.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
           .join(part.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
           .join(totals, "lang"))  # one row per language
    exact = F.expr("(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0)))"
                   " div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    lowest = cut.withColumn("score", exact).groupBy("lang", "phrase", "n_words", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"))
    # a longer phrase as frequent as this one contains one that is a word longer and as frequent
    longer = candidates.filter("n_words > 2").select("lang", F.col("a").alias("longest"), F.explode(F.array(
        F.concat_ws(" ", F.slice(word, F.lit(1), F.col("n_words") - 1)),
        F.concat_ws(" ", F.slice(word, F.lit(2), F.col("n_words") - 1)))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longest").alias("longest"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").filter("longest IS NULL OR longest < a")
    return kept.select("lang", "phrase", "n_words", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n",
                       F.col("best.score").alias("score"))


def top_collocations(docs: DataFrame, top: int = TOP, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                     **bounds) -> DataFrame:
    """The first ``top`` phrases of each language by score, count and byte order, by their places in one sorted table."""
    order = [F.col("lang"), F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    placed = number_in_order(collocations(docs, max_words, min_count, **bounds), order, "place")
    first = placed.groupBy("lang").agg(F.min("place").alias("first"))  # one row per language
    return placed.join(first, "lang").withColumn("rank", F.col("place") - F.col("first") + 1).filter(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\\x0A-\\x0D]+')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM words),
grams AS (
  SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase
  FROM places, range(1, {MAX_WORDS + 1}) AS t(m) WHERE i + m - 1 <= len(ws)),
totals AS (SELECT lang, count(*) AS n FROM places GROUP BY lang),
counted AS (SELECT lang, m, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
candidates AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM counted WHERE m > 1),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, f.a AS l, g.a AS r, t.n,
    (1000::HUGEINT * c.a * t.n) // (f.a::HUGEINT * g.a) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN counted f ON f.lang = c.lang AND f.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counted g ON g.lang = c.lang AND g.phrase = array_to_string(c.w[c.k + 1:], ' ')),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM candidates c WHERE c.lang = s.lang AND c.a >= s.a AND c.phrase <> s.phrase
      AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  a, l, r, n, score::BIGINT AS score
FROM kept QUALIFY rank <= {TOP}
"""
