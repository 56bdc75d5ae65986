"""Operator 4: language-model scores from a probabilistic suffix tree.

The tree's contexts have variable length, in two layers. The next token is
predicted from the longest retained suffix of the tokens so far, of at most
``TOKEN_DEPTH`` tokens (the text's beginning counts as one). The root's
distribution over tokens is smoothed with their spelling, in which each byte
(or the token's end) is predicted from the longest retained suffix of up to
``DEPTH`` bytes of its token.

1. A narrow pass over the training texts counts byte contexts. Those that hold
   ``MIN_SHARE`` of all symbols are candidates, at most ``DEPTH / MIN_SHARE``;
   one is retained when its next-symbol distribution diverges from its
   parent's: count times Kullback-Leibler divergence of at least ``MIN_GAIN``
   nats per next symbol seen. The suffixes of retained contexts stay too. They
   are broadcast.
2. A second narrow pass writes the texts as blocks of token numbers, a table
   bucketed by block, which no later step shuffles.
3. The tree over tokens grows level by level. A level takes two questions of
   the blocks to the whole corpus: how often its strings (context and token)
   occur in training texts, then how much each context gains. Questions are
   sorted hashes, dealt into buckets and packed; a bucket sums what all blocks
   say of a hash and answers each block in the order of its question.
4. A context's gain is that of its next-token distribution over its parent's
   (the next shorter retained context, or the root), in nats, each occurrence
   left out of its own counts, added over all occurrences in training texts.
   It is retained if that is at least ``TOKEN_GAIN`` for the best of
   ``WEIGHTS``, however large the corpus is. Only retained contexts are
   extended, to those that occur at least twice: one occurrence, left out of
   its own counts, gains nothing.
5. Distributions are smoothed with their parents' (Witten-Bell, or the chosen
   weight for a token context), the root of the spelling with the uniform one.

A block asks once for a hash, however often it occurs in it; blocks hold a
bounded number of bytes, and a bucket as many hashes as a block, up to
``MAX_BUCKETS`` blocks (786 GB; beyond that take larger blocks). A hash is known
by 48 bits within its bucket. No result depends on how the texts are cut into
blocks, but for the rounding of gains to 24 bits.

Defined results: a null text is empty and has one token, its end. Without
training texts N and V are 0, base scores are 0 and symbols are uniform.
Repeated rows and null ids are scored each (a null id is in training).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cctally.llm.common import U64, held_out, mix, slices, span_hashes, stage
from cctally.session import staging_dir

DEPTH = 5
MIN_SHARE = 1e-5
MIN_GAIN = 4.0
BLOCK_BYTES = 12_000_000
#: Symbols: a byte plus 1; the token's beginning; the token's end; the text's end. 0: none.
BEGIN, TOKEN_END, TEXT_END = 257, 258, 259
NEXT_SYMBOLS = 256 + 2
BITS = 9
CHUNK_TOKENS = 50_000
#: Places of a block that a step of many temporary arrays handles at once.
CHUNK_PLACES = 1 << 17
#: Most tokens of a context, a parameter of ``score_texts``.
TOKEN_DEPTH = 3
#: The bit of a hash that is set for strings of several tokens, and the most buckets of hashes.
TOKEN_BIT, MAX_BUCKETS = 1 << 16, 1 << 16
#: Least gain in nats of a retained token context.
TOKEN_GAIN = 10.0
#: Weights of the root in a token context's distribution, of which the best is chosen.
WEIGHTS = (0.5, 3.0, 20.0, 150.0)
#: Hashes of the text's beginning as a context and of its end as a next token.
START_HASH, END_HASH = U64(0x5354415254), U64(0x454E44)
STATISTICS = "depth int, context long, symbol int, n long"


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row of each token, index into the distinct tokens, distinct tokens as bytes).

    Tokens are runs without ASCII white space, with A-Z lowered and other
    bytes as they are.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, rows = split.flatten(), pc.list_parent_indices(split)
    full = pc.not_equal(pc.binary_length(flat), 0)
    coded = flat.filter(full).dictionary_encode()
    return rows.filter(full).to_numpy(), coded.indices.to_numpy(), coded.dictionary.cast(pa.binary())


def byte_strings(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a binary column."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return offsets - offsets[0], np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]


def token_hashes(tokens: pa.Array) -> np.ndarray:
    """A 64-bit hash of each token that is the same in every block."""
    out = [np.zeros(0, U64)]
    for low in range(0, len(tokens), CHUNK_TOKENS):
        offsets, data = byte_strings(tokens.slice(low, CHUNK_TOKENS))
        out.append(span_hashes(data, offsets[:-1], offsets[1:]))
    return np.concatenate(out)


def pairs_of(texts: pa.Array) -> tuple:
    """Per token place, texts' ends included: row, context and next token; the distinct tokens.

    Contexts and next tokens are indexes of distinct tokens; their number
    stands for the text's beginning and end.
    """
    row, at, distinct = tokens_of(texts)
    n, size = len(texts), len(distinct)
    count = np.bincount(row, minlength=n)
    last = np.cumsum(count + 1) - 1
    rows = np.repeat(np.arange(n, dtype=np.int32), count + 1)
    inner = np.ones(len(rows), bool)
    inner[last] = False
    after = np.full(len(rows), size, np.int32)
    after[inner] = at
    before = np.roll(after, 1)
    before[last - count] = size
    return rows, before, after, distinct


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the training texts: per task, counts of byte contexts."""
    names = [x.split()[0] for x in STATISTICS.split(", ")]
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        for _, texts in slices(batch.column(0), BLOCK_BYTES):
            _, _, after, distinct = pairs_of(texts)
            times = np.bincount(after, minlength=len(distinct) + 1)
            for low in range(0, len(distinct), CHUNK_TOKENS):
                owner, context, symbol = contexts(distinct.slice(low, CHUNK_TOKENS))
                held.append(((context << BITS) | symbol, times[low + owner]))
            held = [_merge(held)] if held else held
    if held:
        keys, counts = held[0]
        context, symbol = keys >> BITS, keys & ((1 << BITS) - 1)
        for d in range(DEPTH + 1):
            # a context shorter than d symbols has no d-symbol form
            deep = np.ones(len(context), bool) if d == 0 else (context >> (BITS * (d - 1))) & ((1 << BITS) - 1) != 0
            short = context & ((1 << (BITS * d)) - 1) if d else np.zeros(len(context), np.int64)
            k, n = _merge([(((short << BITS) | symbol)[deep], counts[deep])])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(k), d), pa.int32()), pa.array(k >> BITS, pa.int64()),
                pa.array(k & ((1 << BITS) - 1), pa.int32()), pa.array(n, pa.int64())], names=names)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys in order of appearance, sum of each one's counts)."""
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    coded = pa.array(keys).dictionary_encode()
    unique = coded.dictionary.to_numpy()
    return unique, np.bincount(coded.indices.to_numpy(), weights=counts, minlength=len(unique)).astype(np.int64)


#: One row per block of texts: per text its id and flags, its number of tokens with the end; per place
#: the local number of its token; per distinct token its hash and its spelling's log10 probability.
BLOCKS = ("block long, train_tokens long, ids binary, flags binary, lengths binary, tokens binary, hashes binary, "
          "logp binary")
#: Questions of a block to a bucket of hashes, and the bucket's answers in the order of the questions.
QUESTIONS = "block long, step int, bucket int, hashes binary, amounts binary"
ANSWERS = "block long, step int, bucket int, data binary, kinds long"


def pack(values: np.ndarray) -> bytes:
    """An array's bytes, those of one place of the numbers together, compressed behind their length."""
    places = np.ascontiguousarray(values).reshape(-1, 1).view(np.uint8)
    planes = np.empty(places.shape[::-1], np.uint8)
    for k in range(len(planes)):  # several times faster than a transposed copy
        planes[k] = places[:, k]
    return planes.size.to_bytes(8, "little") + pa.Codec("zstd").compress(planes.reshape(-1), asbytes=True)


def unpack(data: bytes, kind) -> np.ndarray:
    planes = pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    planes = np.frombuffer(planes, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    places = np.empty(planes.shape[::-1], np.uint8)
    for k in range(len(planes)):
        places[:, k] = planes[k]
    return places.view(kind).ravel()


def _block(tree: Tree, block_bytes: int):
    """A row for each block of at most ``block_bytes`` of text, or one text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            pa.default_memory_pool().release_unused()
            for start, texts in slices(batch.column(1), block_bytes):
                n = len(texts)
                held = batch.column(2).slice(start, n).to_numpy(zero_copy_only=False).astype(bool)
                ids = batch.column(0).slice(start, n)
                row, _, after, distinct = pairs_of(texts)
                lengths = np.bincount(row, minlength=n)
                flags = held.astype(np.uint8) + 2 * pc.is_null(ids).to_numpy(zero_copy_only=False).astype(np.uint8)
                columns = [ids.fill_null(0).to_numpy().astype(np.int64), flags, lengths.astype(np.int64),
                           after.astype(np.int32), token_hashes(distinct), spell(tree, distinct).astype(np.float32)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) | number], pa.int64()), pa.array([int(lengths[~held].sum())], pa.int64())]
                    + [pa.array([pack(c)], pa.binary()) for c in columns], names=[x.split()[0] for x in BLOCKS.split(", ")])
                number += 1
    return run


def spell(tree: Tree, tokens: pa.Array) -> np.ndarray:
    """log10 probability of each token's bytes and end."""
    out = [np.zeros(0)]
    for low in range(0, len(tokens), CHUNK_TOKENS):
        part = tokens.slice(low, CHUNK_TOKENS)
        owner, context, symbol = contexts(part)
        coded = pa.array((context << BITS) | symbol).dictionary_encode()
        key = coded.dictionary.to_numpy()
        order = np.argsort(key)  # lookups in order are near each other
        logs = np.empty(len(key))
        logs[order] = tree.log10(key[order] >> BITS, key[order] & ((1 << BITS) - 1))
        out.append(np.bincount(owner, weights=logs[coded.indices.to_numpy()], minlength=len(part)))
    return np.concatenate(out)


def contexts(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, context of up to ``DEPTH`` symbols, next symbol) of every symbol of the tokens.

    A context is an integer with its latest symbol in the lowest bits.
    """
    offsets, data = byte_strings(tokens)
    lengths = np.diff(offsets)
    # each token as BEGIN, its bytes, TOKEN_END
    end = np.cumsum(lengths + 2)
    begin = end - lengths - 2
    symbols = np.zeros(int(end[-1]) if len(end) else 0, np.int64)
    inner = np.ones(len(symbols), bool)
    inner[begin], inner[end - 1] = False, False
    symbols[inner] = data.astype(np.int64) + 1
    symbols[begin], symbols[end - 1] = BEGIN, TOKEN_END
    context, back = np.zeros(len(symbols), np.int64), symbols
    for d in range(DEPTH):
        back = np.roll(back, 1)
        back[begin] = 0  # nothing stands before a token
        context |= back << (BITS * d)
    is_next = np.ones(len(symbols), bool)
    is_next[begin] = False
    return np.repeat(np.arange(len(lengths)), lengths + 1), context[is_next], symbols[is_next]


@dataclass
class Tree:
    """Per depth: sorted states with total and kinds of next symbols, sorted transitions with counts."""

    states: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    moves: list[tuple[np.ndarray, np.ndarray]]

    def log10(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol after its context, by the longest suffix state."""
        p = np.full(len(context), 1.0 / NEXT_SYMBOLS)
        alive = np.ones(len(context), bool)
        for d, ((state, total, kinds), (move, count)) in enumerate(zip(self.states, self.moves, strict=True)):
            if not len(state):
                break
            short = context & ((1 << (BITS * d)) - 1) if d else np.zeros(len(context), np.int64)
            at = np.minimum(np.searchsorted(state, short), len(state) - 1)
            alive &= state[at] == short
            if d:
                alive &= (context >> (BITS * (d - 1))) & ((1 << BITS) - 1) != 0
            key = (short << BITS) | symbol
            to = np.minimum(np.searchsorted(move, key), len(move) - 1)
            n = np.where(move[to] == key, count[to], 0)
            p = np.where(alive, (n + kinds[at] * p) / (total[at] + kinds[at]), p)
        return np.log10(p)


def learn(statistics: DataFrame, texts: int, min_share: float = MIN_SHARE, min_gain: float = MIN_GAIN) -> Tree:
    """The spelling tree of the counted byte contexts and the number of training texts."""
    ends = statistics.sparkSession.createDataFrame([(0, 0, TEXT_END, texts), (1, BEGIN, TEXT_END, texts)],
                                                   "depth int, context long, symbol int, n long").filter("n > 0")
    moves = statistics.union(ends)
    symbols = moves.filter("depth = 0").agg(F.sum("n")).first()[0] or 0
    states = moves.groupBy("depth", "context").agg(F.sum("n").alias("total"), F.count("*").alias("kinds")) \
        .filter(F.col("total") >= min_share * symbols)
    frequent = stage(moves.join(states, ["depth", "context"]), "frequent")  # at most DEPTH / min_share contexts
    above = frequent.select((F.col("depth") + 1).alias("depth"), F.col("context").alias("parent"), "symbol",
                            F.col("n").alias("pn"), F.col("total").alias("pt"))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), ((F.col("depth") - 1) * BITS).cast("int")) - 1
    own = frequent.filter("depth > 0").withColumn("parent", F.col("context").bitwiseAND(mask))
    gain = F.sum(F.col("n") * F.log((F.col("n") / F.col("total")) / (F.col("pn") / F.col("pt"))))
    diverging = own.join(above, ["depth", "parent", "symbol"]).groupBy("depth", "context").agg(
        gain.alias("gain"), F.max("kinds").alias("kinds")).filter(F.col("gain") >= min_gain * F.col("kinds"))
    up = F.explode(F.sequence(F.lit(1), F.col("depth")))
    kept = diverging.select("context", up.alias("depth")).select("depth", F.col("context").bitwiseAND(
        F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("depth") * BITS).cast("int")) - 1).alias("context")).distinct()
    rows = frequent.join(kept, ["depth", "context"]).union(
        frequent.filter("depth = 0").select("depth", "context", "symbol", "n", "total", "kinds"))
    t = rows.orderBy("depth", "context", "symbol").toArrow().to_pandas()
    out = Tree([], [])
    for d in range(DEPTH + 1):
        x = t[t["depth"] == d]
        first = x.drop_duplicates("context")
        out.states.append((first["context"].to_numpy(), first["total"].to_numpy(float), first["kinds"].to_numpy(float)))
        out.moves.append(((x["context"].to_numpy() << BITS) | x["symbol"].to_numpy(), x["n"].to_numpy(float)))
    return out


def add(count: np.ndarray, weight, logp: np.ndarray) -> np.ndarray:
    """log10(count + weight * 10**logp), also where the power is too small for a float."""
    out = np.power(10.0, logp)
    out *= weight
    out += count
    with np.errstate(divide="ignore"):  # replaced below
        np.log10(out, out=out)
    small = np.flatnonzero(logp < -290)
    if len(small):
        weight = np.broadcast_to(weight, out.shape)
        with np.errstate(divide="ignore"):  # a count of 0 adds nothing
            out[small] = np.logaddexp(np.log(count[small]), np.log(weight[small]) + logp[small] * np.log(10)) / np.log(10)
    return out


@dataclass
class Corpus:
    """What the blocks need of the whole corpus; ``distinct`` is known after the first step."""

    buckets: int
    total: int = 0
    distinct: int = 0
    end_logp: float = 0.0
    depth: int = TOKEN_DEPTH


class Block:
    """A block's texts, replayed along the answers of the steps done so far.

    ``place`` of a token within its text; ``n`` training occurrences of the
    string of a place's context and token; ``c`` of its context alone; ``logp``
    by the longest retained context so far. A step of ``questions`` and one of
    ``answer`` alternate for each level.
    """

    def __init__(self, row, corpus: Corpus):
        self.corpus = corpus
        self.ids, self.flags = unpack(row["ids"], np.int64), unpack(row["flags"], np.uint8)
        self.lengths, self.after = unpack(row["lengths"], np.int64), unpack(row["tokens"], np.int32)
        first = np.cumsum(self.lengths) - self.lengths
        self.first = first
        self.place = np.arange(len(self.after), dtype=np.int32)
        self.place -= np.repeat(first.astype(np.int32), self.lengths)
        self.train = np.repeat(self.flags & 1 == 0, self.lengths)
        self.hashes = np.r_[unpack(row["hashes"], U64), END_HASH, START_HASH]
        self.spelled = np.r_[unpack(row["logp"], np.float32).astype(float), corpus.end_logp]
        self.gram = self.hashes[self.after]

    def before(self, values: np.ndarray) -> np.ndarray:
        """The value at the place before, of the same text where it matters."""
        return np.roll(values, 1)

    def strings(self, d: int) -> np.ndarray:
        """The hash of the string of ``d`` tokens and the token at each place; the text's beginning counts as one."""
        longer = np.roll(self.hashes[self.after], d)
        longer[self.place < d] = START_HASH
        for low in range(0, len(longer), CHUNK_PLACES):
            part = slice(low, low + CHUNK_PLACES)
            longer[part] = mix(self.gram[part] * U64(0x9E3779B97F4A7C15) + longer[part] + U64(d))
        return longer

    def counted(self, d: int) -> tuple[np.ndarray, list[np.ndarray]]:
        """(hashes, training occurrences in parts) that level ``d`` asks the counts of; a hash may stand repeatedly."""
        longer = self.strings(d)
        if d == 1:
            times = np.bincount(self.after[self.train], minlength=len(self.hashes))
            times[-1] = (self.flags & 1 == 0).sum()
            self.shorter, self.gram, self.asked = None, longer, np.ones(len(longer), bool)
            own = np.concatenate([self.hashes, longer])
            own |= U64(TOKEN_BIT)
            own[:len(self.hashes) - 1] &= ~U64(TOKEN_BIT)  # the beginning is no token
            return own, [times, self.train]
        self.asked = self.alive & (self.place >= d - 1)
        if d == 2:  # every string of two tokens was counted at the level before
            self.asked &= self.before(self.n) >= 2
        else:
            self.asked &= ~(self.before(self.known) & (self.before(self.n) <= 1))
        self.shorter, self.gram = self.before(self.gram), longer
        own = np.concatenate([longer[self.asked]] + [self.shorter[self.asked]] * (d > 2))
        own |= U64(TOKEN_BIT)
        return own, [self.train[self.asked]] * (1 + (d > 2))

    def take_counts(self, d: int, index: np.ndarray, counts: np.ndarray) -> None:
        """Counts of level ``d``'s strings and contexts, and the contexts as numbers."""
        of = counts.astype(float)
        if d == 1:
            size = len(self.hashes)
            token, string = index[:size], index[size:]
            previous = self.before(self.after)
            previous[self.first] = size - 1
            times = of[token]  # of the tokens alone, so that all places read few numbers
            self.token_counts = times[:-1]
            self.context, self.c, self.n = token[previous], times[previous], of[string]
            self.string, self.known = string, np.ones(len(string), bool)
            self.alive = self.can_gain()
            self.logp = root_logp(self.corpus, self.token_counts, self.spelled)[self.after]
            return
        m = int(self.asked.sum())
        context, c = np.zeros(len(self.n), np.int32), np.zeros(len(self.n))
        if d == 2:
            context, c = self.before(self.string), self.before(self.n)
        else:
            context[self.asked], c[self.asked] = index[m:], of[index[m:]]
        # a string that was not asked for has a context seen once at most, or one that is not retained
        self.known = self.alive | (self.n <= 1)
        n = np.minimum(self.n, 1.0)
        n[self.asked] = of[index[:m]]
        string = np.zeros(len(n), np.int32)
        string[self.asked] = index[:m]
        self.context, self.c, self.n, self.string = context, c, n, string
        self.alive = self.asked & self.can_gain()

    def can_gain(self) -> np.ndarray:
        """Places whose context may gain: not if it occurs once, nor if it occurs twice before different tokens.

        The count of a string that occurs once says the latter in both places, so no block asks for that context.
        """
        return (self.c > 2) | (self.c == 2) & (self.n != 1)

    def contexts(self, size: int) -> np.ndarray:
        """The contexts that stand here, of the ``size`` sorted hashes."""
        mark = np.zeros(size, bool)
        mark[self.context[self.alive]] = True
        return np.flatnonzero(mark)

    def gains(self, at: np.ndarray, size: int) -> np.ndarray:
        """Per context of this block, its leave-one-out gain over its parent with each weight."""
        use = self.alive & self.train
        number = np.zeros(size, np.int32)
        number[at] = np.arange(len(at), dtype=np.int32)
        own = number[self.context[use]].astype(np.int64)
        del number
        odds = -self.logp[use]  # of a training token, so at most about the corpus' tokens when raised
        np.power(10.0, odds, out=odds)
        odds *= self.n[use] - 1
        others = self.c[use]
        others -= 1
        out = np.empty((len(at), len(WEIGHTS)))
        for k, w in enumerate(WEIGHTS):
            gain = odds + w
            gain /= others + w
            out[:, k] = np.bincount(own, weights=np.log(gain, out=gain), minlength=len(at))
        return out

    def take_weights(self, at: np.ndarray, choice: np.ndarray, size: int) -> None:
        """The chosen weight per context, 0 where it is not retained, refines the probabilities."""
        chosen = np.zeros(size + 1, np.uint8)  # a byte a hash, so that all places read near each other
        chosen[at] = choice
        use = chosen[self.context]
        use[~self.alive] = 0
        self.alive = use > 0
        weights = np.r_[0.0, WEIGHTS]
        for low in range(0, len(use), CHUNK_PLACES):
            at = low + np.flatnonzero(self.alive[low:low + CHUNK_PLACES])
            n, c, w, p = self.n[at], self.c[at], weights[use[at]], self.logp[at]
            self.logp[at] = add(n, w, p) - np.log10(c + w)

    def replay(self, answers: pd.DataFrame, until: int) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys, amounts) that step ``until`` asks, the answers of the steps before it taken in."""
        data = {step: part.sort_values("bucket")["data"] for step, part in answers.groupby("step")}

        def answer(step: int, kind) -> np.ndarray:
            return np.concatenate([np.zeros(0, kind), *[unpack(x, kind) for x in data.get(step, ())]])

        for d in range(1, self.corpus.depth + 1):
            hashes, times = self.counted(d)
            hashes = keyed(hashes, self.corpus.buckets)
            keys, index = numbered(hashes)
            del hashes
            if until == 2 * d - 1:
                return keys, np.bincount(index, weights=np.concatenate(times, dtype=float), minlength=len(keys)).astype(np.int64)
            self.take_counts(d, index, answer(2 * d - 1, np.int64))
            among = pairs if d == 2 else keys
            at = self.contexts(len(among))
            if until == 2 * d:
                self.gram = self.shorter = self.string = None  # no later step follows
                return among[at], self.gains(at, len(among))
            self.take_weights(at, answer(2 * d, np.uint8), len(among))
            pairs = keys
        return np.zeros(0, U64), np.zeros(0)


def keyed(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket from a hash's lowest 16 bits, before its other 48 bits."""
    out = hashes & U64(0xFFFF)
    out *= U64(buckets)
    out >>= U64(16)
    out <<= U64(48)
    out |= hashes >> U64(16)
    return out


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys ascending, place of each key among them), with fewer copies than ``np.unique`` makes.

    The lowest bits of a key give way to its place, as numbers sort several
    times faster than their places do; the few runs of keys that differ in
    those bits alone are sorted on their own.
    """
    bits = len(keys).bit_length()
    room = 64 - int(keys.max(initial=1)).bit_length()
    order = keys << U64(room)
    order >>= U64(bits)
    order <<= U64(bits)
    order |= np.arange(len(keys), dtype=U64)
    order.sort()
    order &= U64((1 << bits) - 1)
    order = order.astype(np.int64)
    ordered = keys[order]
    lost = U64(max(bits - room, 0))
    for run in np.unique(ordered[1:][ordered[1:] < ordered[:-1]] >> lost):
        low = int(np.searchsorted(ordered, run << lost))  # the runs themselves ascend
        high = int(np.searchsorted(ordered, (run << lost) | U64((1 << int(lost)) - 1), side="right"))
        inner = np.argsort(ordered[low:high])
        order[low:high], ordered[low:high] = order[low:high][inner], ordered[low:high][inner]
    keys = ordered
    del ordered
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    keys = keys[new]
    number = np.cumsum(new, dtype=np.int32)
    number -= 1
    index = np.empty(len(order), np.int32)
    index[order] = number
    return keys, index


def root_logp(corpus: Corpus, counts: np.ndarray, spelled: np.ndarray) -> np.ndarray:
    """log10 probability by the root: counts smoothed with the spelling, weighted by the number of distinct tokens."""
    distinct = max(corpus.distinct, 1)
    return add(counts, distinct, spelled) - np.log10(corpus.total + distinct)


def _ask(corpus: Corpus, step: int):
    def run(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        keys, amounts = Block(own.iloc[0], corpus).replay(answers, step)
        bucket = (keys >> U64(48)).astype(np.int64)
        cut = np.flatnonzero(np.diff(bucket, prepend=-1))
        rest = keys & U64((1 << 48) - 1)
        rows = []
        for low, high in zip(cut, [*cut[1:], len(keys)], strict=False):
            amount = amounts[low:high].astype(np.float32 if step % 2 == 0 else np.int64)
            rows.append((own["block"].iloc[0], step, bucket[low], pack(np.diff(rest[low:high], prepend=U64(0))),
                         pack(amount.ravel())))
        return pd.DataFrame(rows, columns=[x.split()[0] for x in QUESTIONS.split(", ")])
    return run


def _answer(step: int):
    """Sums a bucket's amounts over all blocks; each block gets them in the order of its hashes."""
    def run(asked: pd.DataFrame) -> pd.DataFrame:
        keys = [np.cumsum(unpack(x, U64), dtype=U64) for x in asked["hashes"]]
        unique, index = numbered(np.concatenate(keys))
        kinds = 0
        if step % 2:
            sums = np.bincount(index, weights=np.concatenate([unpack(x, np.int64) for x in asked["amounts"]]),
                               minlength=len(unique)).astype(np.int64)
            if step == 1:
                kinds = int(((unique & U64(TOKEN_BIT >> 16)) == 0)[sums > 0].sum())
        else:
            gains = np.concatenate([unpack(x, np.float32).reshape(-1, len(WEIGHTS)) for x in asked["amounts"]])
            total = np.array([np.bincount(index, weights=gains[:, k], minlength=len(unique)) for k in range(len(WEIGHTS))])
            sums = np.where(total.max(axis=0) >= TOKEN_GAIN, total.argmax(axis=0) + 1, 0).astype(np.uint8)
            kinds = int((sums > 0).sum())
        ends = np.cumsum([len(k) for k in keys])
        data = [pack(sums[x]) for x in np.split(index, ends[:-1])]
        return pd.DataFrame({"block": asked["block"], "step": step, "bucket": asked["bucket"], "data": data,
                             "kinds": [kinds] + [0] * (len(data) - 1)})
    return run


def _score(corpus: Corpus):
    scale = corpus.total + 0.1 * (corpus.distinct + 1)

    def run(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        b = Block(own.iloc[0], corpus)
        b.replay(answers, 2 * corpus.depth + 1)
        count = b.token_counts[b.after]
        sums = lambda x: np.add.reduceat(x, b.first) if len(b.first) else np.zeros(0)
        ids = pd.array(b.ids, dtype="Int64")
        ids[b.flags & 2 > 0] = pd.NA
        return pd.DataFrame({
            "doc_id": ids, "held_out": b.flags & 1 > 0, "n_tokens": b.lengths, "n_known": sums((count > 0).astype(np.int64)),
            "train_tokens": corpus.total, "base_score": sums(np.log10((count + 0.1) / scale)), "score": sums(b.logp)})
    return run


def write_blocks(source: DataFrame, tree: Tree, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The texts' blocks as a table bucketed by block, so that no step shuffles them."""
    spark = source.sparkSession
    path, name = staging_dir(spark, "blocks"), f"blocks_{uuid.uuid4().hex}"
    source.mapInArrow(_block(tree, block_bytes), BLOCKS).write.option("path", path) \
        .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block").saveAsTable(name)
    return spark.table(name)


def grow(blocks: DataFrame, end_logp: float, depth: int = TOKEN_DEPTH) -> tuple[Corpus, DataFrame]:
    """(the corpus' numbers, all answers to the blocks): level by level, counts and then retained contexts."""
    spark = blocks.sparkSession
    own = blocks.agg(F.count("*").alias("blocks"), F.sum("train_tokens").alias("total")).first()
    buckets = min(max(own["blocks"], int(spark.conf.get("spark.sql.shuffle.partitions"))), MAX_BUCKETS)
    corpus = Corpus(buckets, own["total"] or 0, end_logp=end_logp, depth=depth)
    answers = spark.createDataFrame([], ANSWERS)
    for step in range(1, 2 * depth + 1):
        asked = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_ask(corpus, step), QUESTIONS)
        answered = stage(asked.groupBy("bucket").applyInPandas(_answer(step), ANSWERS), f"answers_{step}")
        answers = answers.union(answered) if step > 1 else answered
        if step == 1:
            corpus.distinct = answered.agg(F.sum("kinds")).first()[0] or 0  # with the text's end
    return corpus, answers


def scores(blocks: DataFrame, corpus: Corpus, answers: DataFrame) -> DataFrame:
    """The blocks' texts scored by the tree that their answers hold."""
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_score(corpus), (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"))


def score_texts(docs: DataFrame, folds: int = 10, fold: int = 0, block_bytes: int = BLOCK_BYTES,
                depth: int = TOKEN_DEPTH) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every text.

    Texts whose crc32(doc_id as text) modulo ``folds`` is ``fold`` are held out.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         held_out("doc_id", folds, fold).alias("held_out"))
    statistics = stage(source.filter("not held_out").select("text").mapInArrow(_statistics, STATISTICS)
                       .groupBy("depth", "context", "symbol").agg(F.sum("n").alias("n")), "statistics")
    texts = source.filter("not held_out").count()
    tree = learn(statistics, texts)
    end_logp = float(tree.log10(np.array([BEGIN]), np.array([TEXT_END]))[0])
    blocks = write_blocks(source, tree, block_bytes)
    return scores(blocks, *grow(blocks, end_logp, depth))
