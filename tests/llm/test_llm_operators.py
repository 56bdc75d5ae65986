"""The training-data operators against brute force, SQL and exact round trips, with their edge cases."""

import hashlib
import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter
from itertools import combinations
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cctally.llm import (
    bpe, decontaminate, hamming, html_text, jaccard_join, language, line_dedup, queries, suffix_tree, toxicity, warc)
from cctally.llm.common import held_out, stage
from cctally.session import SHUFFLE_CLEANUP

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, at int, chunk string, row string, class_id long"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", 1, "c", "r", 5) for i, t in rows], SCHEMA)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(n))


ODD = [(None, None), (1, ""), (2, None), (3, "  \n\n "), (4, "x"), (4, "x"), (5, "…!"), (6, "a" * 50_000), (7, "é ß\x1c　z")]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    base = words(rng, 60)
    rows = [*ODD, (10, base), (11, base), (12, base + " extra"), (13, words(rng, 60)), (14, None)]
    return frame(spark, rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(want.fetchall())


# --- 1 -------------------------------------------------------------------------

def test_alignment_equals_plain_dynamic_programme():
    rng = np.random.default_rng(0)
    for _ in range(30):
        a, b = rng.integers(0, 4, 9), rng.integers(0, 4, 14)
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                s = decontaminate.MATCH if a[i - 1] == b[j - 1] else decontaminate.MISMATCH
                h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + decontaminate.GAP, h[i, j - 1] + decontaminate.GAP)
        assert decontaminate.align(a, b)[0] == h.max()


def test_leaks_found_edited_or_common_and_clean_kept(spark):
    rng = random.Random(1)
    item = words(rng, 30)
    edited = " ".join(w if k % 6 else "other" for k, w in enumerate(item.split()))
    rows = [*ODD, (20, words(rng, 40) + " " + item.upper() + " " + words(rng, 40)), (21, words(rng, 9) + " " + edited),
            *[(100 + k, words(rng, 5) + " " + item) for k in range(30)], (22, words(rng, 90))]
    d = frame(spark, rows)
    b = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short"), (None, words(rng, 20))], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(d, b).collect()}
    assert got == {(i, 1) for i in (20, 21, *range(100, 130))}
    left = decontaminate.drop_leaking(d, b)
    assert left.columns == d.columns and left.count() == len(ODD) + 1
    empty = b.filter("false")
    assert decontaminate.leaks(d, empty).count() == 0 and decontaminate.leaks(d.filter("false"), b).count() == 0


def test_leaks_with_few_common_seeds_found(spark):
    rng = random.Random(8)
    item = words(rng, 16).split()
    edited = " ".join("other" if k in (3, 8, 13) else w for k, w in enumerate(item))
    b = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    rows = [(k, words(rng, 20) + " " + edited + " " + words(rng, 20)) for k in range(40)] + [(50, words(rng, 60))]
    for some in (rows, rows[:1] + rows[-1:]):
        got = {r.doc_id: r.score for r in decontaminate.leaks(frame(spark, some), b).collect()}
        assert got == {i: 23 / 32 for i, _ in some if i < 40}
        assert [r.doc_id for r in decontaminate.drop_leaking(frame(spark, some), b).collect()] == [50]


def test_score_bound_is_never_below_the_alignment():
    rng = np.random.default_rng(4)
    for _ in range(200):
        a, b = rng.integers(0, 9, rng.integers(1, 12)), rng.integers(0, 9, rng.integers(0, 20))
        best = decontaminate.align(a, b)[0]
        assert decontaminate.score_bound(a, b) >= best and decontaminate.score_bound(b, a) >= best


def test_leaks_equal_all_items_against_all_texts(spark):
    rng = random.Random(31)
    vocabulary = [f"w{k}" for k in range(60)]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [some(rng.randrange(3, 30)) for _ in range(12)]
    common = items[0]
    texts = []
    for k in range(150):
        item = list(common if k % 3 == 0 else rng.choice(items))
        for _ in range(rng.randrange(0, 1 + len(item) // 4)):
            item[rng.randrange(len(item))] = "zz"
        texts.append(some(rng.randrange(20)) + item[:rng.randrange(1, len(item) + 1)] + some(rng.randrange(20)))
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score
           for r in decontaminate.leaks(frame(spark, [(k, " ".join(t)) for k, t in enumerate(texts)]), b).collect()}
    number = {w: k for k, w in enumerate([*vocabulary, "zz"])}
    runs = lambda v: {tuple(v[i:i + 4]) for i in range(len(v) - 3)}
    want = {}
    for d, t in enumerate(texts):
        for k, item in enumerate(items):
            if runs(t) & runs(item):
                score = decontaminate.align(np.array([number[w] for w in item]), np.array([number[w] for w in t]))[0] / (2 * len(item))
                if score >= max(decontaminate.MIN_SCORE, min(1.0, decontaminate.MIN_POINTS / (2 * len(item)))):
                    want[d, k] = score
    assert got == want and len(want) > 30


def test_rare_seeds_by_documents_that_hold_them(spark):
    rng = random.Random(32)
    frequent, rare = words(rng, 6), words(rng, 6)
    d = frame(spark, [(k, frequent + " " + frequent) for k in range(11)] + [(50 + k, rare) for k in range(10)])
    seeds = decontaminate.with_rare(decontaminate.seeds_of([1, 2], [frequent, rare]), d)
    assert {(int(k), bool(r)) for k, r in zip(seeds.item, seeds.rare, strict=True)} == {(0, False), (1, True)}
    assert decontaminate.with_rare(seeds, d.filter("false")).rare.all()


# --- 2 -------------------------------------------------------------------------

def line_dedup_oracle(rows):
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()),
                                        "text": pa.array([t for _, t in rows], pa.string())}))
    return Counter(con.execute(line_dedup.ORACLE_SQL).fetchall())


def line_dedup_rows(out):
    return Counter(map(tuple, out.select("doc_id", "text", "removed_chunks", "removed_lines").collect()))


def test_line_dedup_edge_cases(spark):
    rng = random.Random(2)
    lines = [words(rng, 4) for _ in range(12)]
    passage = "\n".join(lines)
    rows = [*ODD, (30, passage), (31, passage), (31, passage), (32, words(rng, 3) + "\n" + passage)]
    d = frame(spark, rows)
    out = line_dedup.remove_repeated_chunks(d)
    assert out.count() == len(rows) and set(d.columns) < set(out.columns)
    got = {r.doc_id: r for r in out.collect()}
    assert got[30].text == passage and got[30].removed_chunks == 0
    assert got[31].text == "" and got[31].removed_lines == 12
    assert got[32].text == rows[-1][1].split("\n")[0]
    assert got[2].text is None and got[1].text == ""
    assert line_dedup.remove_repeated_chunks(d.filter("false")).count() == 0
    assert line_dedup_rows(out) == line_dedup_oracle(rows)


def test_line_dedup_removes_whole_planted_runs(spark):
    rng = random.Random(21)
    line = lambda: words(rng, 6)
    rows, runs, n = [], {}, 0
    for length in (2, 3, 4, 6, 8, 12, 40):
        for _ in range(20):
            run = [line() for _ in range(length)]
            for _ in range(3):
                before, after = ([line() for _ in range(rng.randrange(4))] for _ in range(2))
                rows.append((n, "\n".join(before + run + after)))
                runs[n] = ("\n".join(before + after), length)
                n += 1
    got = {r.doc_id: r for r in line_dedup.remove_repeated_chunks(frame(spark, rows)).collect()}
    for k, (rest, length) in runs.items():
        if k % 3 == 0:
            assert got[k].text == rows[k][1] and got[k].removed_lines == 0
        else:
            assert (got[k].text, got[k].removed_lines) == (rest, length)


def test_line_dedup_equals_sql_on_few_distinct_lines(spark):
    rng = random.Random(22)
    rows = [(k % 50, "\n".join(rng.choice(["", "a", "b", "c", "d e", "f"]) for _ in range(rng.randrange(1, 30))))
            for k in range(120)]
    whole = rows[7][1]
    rows += [(60, whole[:len(whole) // 2]), (61, "x\n" + whole + "\ny"), (None, whole), (62, None)]
    assert line_dedup_rows(line_dedup.remove_repeated_chunks(frame(spark, rows))) == line_dedup_oracle(rows)


# --- 3 -------------------------------------------------------------------------

def shingle_set(text):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("block_bytes", [4_000_000, 12_000])
def test_jaccard_join_equals_brute_force(spark, block_bytes):
    rng = random.Random(5)
    rows = [(i, t) for i, t in ODD if i is not None]
    for g in range(4):
        base = words(rng, 80).split()
        for k in range(8):
            w = list(base)
            for _ in range(k % 4):
                w[rng.randrange(len(w))] = "edit"
            rows.append((1000 + 10 * g + k, " ".join(w)))
    got = jaccard_join.near_duplicates(frame(spark, rows), block_bytes=block_bytes).collect()
    sets = [shingle_set(t) for _, t in rows]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and both >= 0.8 * len(sets[a] | sets[b]):
            links[a] += 1
            links[b] += 1
            parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(i, least.get(root(k), i))
    want = Counter((i, least[root(k)], links[k]) for k, (i, _) in enumerate(rows))
    assert Counter(map(tuple, got)) == want


def test_keep_one_row_of_each_class(spark, docs):
    left = jaccard_join.keep_one(docs)
    assert left.columns == docs.columns
    ids = Counter(r.doc_id for r in left.collect())
    assert ids[10] == 1 and ids[11] == 0 and ids[12] == 0 and ids[13] == 1 and ids[4] == 1
    assert ids[None] == 1 and ids[1] == ids[2] == ids[3] == ids[14] == 1
    assert jaccard_join.keep_one(docs.filter("false")).count() == 0
    assert jaccard_join.near_duplicates(docs.filter("false")).count() == 0


def test_pruning_rule_is_the_binomial_tail():
    for n, least in jaccard_join.least_matches(0.8, 1e-4, 48, 16):
        tail = lambda m, n=n: sum(math.comb(n + 1, k) * 0.8 ** k * 0.2 ** (n + 1 - k) for k in range(m + 1))
        assert tail(least) >= 1e-4 and (least == 0 or tail(least - 1) < 1e-4)


# --- 4 -------------------------------------------------------------------------

def test_language_model_base_equals_brute_force_and_model_is_proper(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, t) for i, t in rows][:120] + [(i, t) for i, t in ODD if i is not None]
    got = suffix_tree.score_texts(frame(spark, rows)).collect()
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", low(t)), "<end>"]
    c = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    want = sorted((i, len(tokens(t)), sum(c[x] > 0 for x in tokens(t)), n,
                   round(sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in tokens(t)), 4)) for i, t in rows)
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert suffix_tree.score_texts(frame(spark, rows).filter("false")).count() == 0


def test_language_model_does_not_depend_on_blocks(spark):
    rows = [(i, t) for i, t in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()][:150]
    whole, cut = ({r.doc_id: r.score for r in suffix_tree.score_texts(frame(spark, rows).coalesce(1), block_bytes=b).collect()}
                  for b in (12_000_000, 3_000))
    assert whole.keys() == cut.keys() and all(abs(whole[i] - cut[i]) < 1e-3 for i in whole)


def test_token_tree_equals_brute_force(spark):
    rows = [(i, t) for i, t in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()][:150]
    rows += [(9000 + i, "one two three four five six " * 3 + "seven eight") for i in range(20)]
    source = frame(spark, rows).select("doc_id", "text", held_out("doc_id", 10, 0).alias("held_out")).coalesce(1)
    tree, end = suffix_tree.Tree([], []), -math.log10(suffix_tree.NEXT_SYMBOLS)
    blocks = suffix_tree.write_blocks(source, tree, 20_000)
    corpus, answers = suffix_tree.grow(blocks, end, 3)
    scored = suffix_tree.scores(blocks, corpus, answers).collect()
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    texts = {i: [None, *re.findall(r"[^\x20\x09-\x0D]+", low(t)), "\n"] for i, t in rows}  # the beginning and the end
    n, of, c = Counter(), Counter(), Counter()  # strings, contexts, tokens
    training = [x for i, x in texts.items() if zlib.crc32(str(i).encode()) % 10]
    for x in training:
        for k in range(1, len(x)):
            c[x[k]] += 1
            for d in range(1, min(k, 3) + 1):
                n[*x[k - d:k + 1]] += 1
                of[*x[k - d:k]] += 1
    total, distinct = sum(c.values()), len(c)
    spell = lambda w: suffix_tree.NEXT_SYMBOLS ** -(1.0 if w == "\n" else len(w.encode()) + 1)
    kept, gains = [{}, {}, {}, {}], Counter()

    def p(x, k, depth):
        at = (c[x[k]] + distinct * spell(x[k])) / (total + distinct)
        for d in range(1, min(k, depth) + 1):
            w = kept[d].get(tuple(x[k - d:k]))
            if w is None:
                break
            at = (n[*x[k - d:k + 1]] + w * at) / (of[*x[k - d:k]] + w)
        return at

    for d in (1, 2, 3):
        gains.clear()
        for x in training:
            for k in range(d, len(x)):
                h = tuple(x[k - d:k])
                if d == 1 or h[1:] in kept[d - 1]:
                    q = p(x, k, d - 1)
                    for w in suffix_tree.WEIGHTS:
                        gains[h, w] += math.log((n[*h, x[k]] - 1 + w * q) / (of[h] - 1 + w) / q)
        for h in {h for h, _ in gains}:
            best = max(suffix_tree.WEIGHTS, key=lambda w: gains[h, w])
            if gains[h, best] >= suffix_tree.TOKEN_GAIN:
                kept[d][h] = best
    assert all(kept[1:]) and any(of[h] < 20 for h in kept[2])
    asked = {r.step: r.n for r in answers.groupBy("step").agg(F.sum("kinds").alias("n")).collect()}
    assert [asked[2], asked[4], asked[6]] == [len(k) for k in kept[1:]] and asked[1] == distinct
    want = {i: sum(math.log10(p(x, k, 3)) for k in range(1, len(x))) for i, x in texts.items()}
    assert len(scored) == len(want) and all(abs(r.score - want[r.doc_id]) < 1e-3 for r in scored)


def test_blocks_of_the_language_model_are_replayed_in_bounded_memory():
    rng = np.random.default_rng(5)
    text = " ".join(f"w{k}" for k in rng.zipf(1.3, 300_000) % 50_000)
    _, _, after, distinct = suffix_tree.pairs_of(pa.array([text]))
    size = len(after)
    row = {"ids": np.array([1]), "flags": np.zeros(1, np.uint8), "lengths": np.array([size]), "tokens": after.astype(np.int32),
           "hashes": suffix_tree.token_hashes(distinct), "logp": np.full(len(distinct), -6.0, np.float32)}
    own = pd.DataFrame([{"block": 0, **{k: suffix_tree.pack(v) for k, v in row.items()}}])
    corpus = suffix_tree.Corpus(3, size, len(distinct) + 1, -2.0)
    answers = pd.DataFrame({"block": [], "step": [], "bucket": [], "data": [], "kinds": []})
    for step in range(1, 7):
        tracemalloc.start()
        asked = suffix_tree._ask(corpus, step)(own, answers)
        peak = tracemalloc.get_traced_memory()[1] / size
        tracemalloc.stop()
        assert peak < 110, (step, peak)  # bytes a token; with np.unique and whole temporary arrays up to 146
        answers = pd.concat([answers, *[suffix_tree._answer(step)(x.reset_index(drop=True)) for _, x in asked.groupby("bucket")]])
    keys = rng.integers(0, 1000, 5000).astype(np.uint64)
    for got, want in zip(suffix_tree.numbered(keys), np.unique(keys, return_inverse=True), strict=True):
        assert (got == want).all()
    assert [len(x) for x in suffix_tree.numbered(keys[:0])] == [0, 0]


def test_keys_that_share_their_leading_bits_are_numbered():
    rng = np.random.default_rng(6)
    keys = (rng.integers(0, 50, 20_000).astype(np.uint64) << np.uint64(40)) | rng.integers(0, 9, 20_000).astype(np.uint64)
    keys = np.r_[keys, np.uint64(2**64 - 1), np.uint64(2**64 - 2), np.uint64(0)]
    for got, want in zip(suffix_tree.numbered(keys), np.unique(keys, return_inverse=True), strict=True):
        assert (got == want).all()


def test_contexts_that_occur_twice_before_different_tokens_are_not_asked_for():
    text = " ".join([f"a{k} x{k}" for k in range(300)] + [f"a{k} y{k}" for k in range(300)] + ["b c"] * 50)
    _, _, after, distinct = suffix_tree.pairs_of(pa.array([text]))
    row = {"ids": np.array([1]), "flags": np.zeros(1, np.uint8), "lengths": np.array([len(after)]),
           "tokens": after.astype(np.int32), "hashes": suffix_tree.token_hashes(distinct),
           "logp": np.full(len(distinct), -6.0, np.float32)}
    own = pd.DataFrame([{"block": 0, **{k: suffix_tree.pack(v) for k, v in row.items()}}])
    corpus = suffix_tree.Corpus(1, len(after), len(distinct) + 1, -2.0)
    answers = pd.DataFrame({"block": [], "step": [], "bucket": [], "data": [], "kinds": []})
    answers = suffix_tree._answer(1)(suffix_tree._ask(corpus, 1)(own, answers))
    asked = suffix_tree._ask(corpus, 2)(own, answers)
    # b and c; 300 contexts occur twice, each before two tokens, and 600 once
    assert [len(suffix_tree.unpack(x, np.uint64)) for x in asked["hashes"]] == [2]


def test_logarithms_of_sums_at_any_size():
    logp = np.array([-1.0, -289.0, -291.0, -400.0, -400.0])
    count = np.array([3.0, 0.0, 0.0, 0.0, 2.0])
    want = [math.log10(3.05), math.log10(0.5) - 289, math.log10(0.5) - 291, math.log10(0.5) - 400, math.log10(2)]
    assert np.allclose(suffix_tree.add(count, 0.5, logp), want, rtol=1e-14)
    assert np.allclose(suffix_tree.add(count, np.full(5, 0.5), logp), want, rtol=1e-14)


def test_shuffle_files_of_a_staged_table_go(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for d in disk.localDirs() for f in Path(d.getPath()).rglob("shuffle_*.data")}
    before, mode = shuffled(), spark.conf.get(SHUFFLE_CLEANUP)
    rows = stage(spark.range(50_000).repartition(4, "id"), "freed")
    for _ in range(100):  # files go a moment after the query
        if not (left := shuffled() - before):
            break
        time.sleep(0.1)
    assert not left and rows.count() == 50_000 and spark.conf.get(SHUFFLE_CLEANUP) == mode


def test_spelling_distribution_sums_to_one():
    counts = {"a": 5, "ab": 3, "b": 1}
    owner, context, symbol = suffix_tree.contexts(pa.array(list(counts), pa.binary()))
    n = np.array(list(counts.values()))[owner]
    states, moves = [], []
    for d in range(3):
        short = context & ((1 << (suffix_tree.BITS * d)) - 1) if d else context * 0
        key, inverse = np.unique((short << suffix_tree.BITS) | symbol, return_inverse=True)
        total = np.bincount(inverse, weights=n)
        state, at = np.unique(key >> suffix_tree.BITS, return_inverse=True)
        states.append((state, np.bincount(at, weights=total), np.bincount(at).astype(float)))
        moves.append((key, total))
    tree = suffix_tree.Tree(states, moves)
    every = np.array([*range(1, 257), suffix_tree.TOKEN_END, suffix_tree.TEXT_END])
    for ctx in {0, *context.tolist()}:
        assert abs((10 ** tree.log10(np.full(len(every), ctx), every)).sum() - 1) < 1e-9


# --- 5 -------------------------------------------------------------------------

def test_language_mixtures(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(d, lambda c: ~held_out(c, 4, 2))
    got = language.predict(d, model).join(d.select("doc_id", "lang"), "doc_id").filter(held_out("doc_id", 4, 2)).collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)
    odd = {r.doc_id: r for r in language.predict(frame(spark, [(i, t) for i, t in ODD if i]), model).collect()}
    assert odd[1].lang_pred == odd[2].lang_pred == odd[5].lang_pred == "und" and odd[5].score == 0
    assert odd[6].lang_pred in model.languages
    none = language.fit(d.filter("false"), lambda c: ~held_out(c, 4, 2))
    assert {r.lang_pred for r in language.predict(d, none).collect()} == {"und"}


def test_mixture_recovers_proportions():
    rng = np.random.default_rng(1)
    p = rng.dirichlet(np.ones(50), 3).T
    draw = np.r_[rng.choice(50, 700, p=p[:, 0]), rng.choice(50, 300, p=p[:, 2])]
    bucket, count = np.unique(draw, return_counts=True)
    _, share = language.mixtures(np.zeros(len(bucket), int), bucket, count.astype(float), p)
    assert abs(share[0, 0] - 0.7) < 0.08 and share[0, 1] == 0


def test_mixture_finds_a_minor_language_among_many():
    rng = np.random.default_rng(5)
    p = rng.dirichlet(np.ones(200), 9).T
    p[:, 1:8] = 0.5 * p[:, :1] + 0.5 * p[:, 1:8]  # eight related languages and one apart from them
    draw = np.r_[rng.choice(200, 1600, p=p[:, 0]), rng.choice(200, 400, p=p[:, 8])]
    bucket, count = np.unique(draw, return_counts=True)
    single = count @ np.log(p[bucket])
    assert np.argsort(-single).tolist().index(8) >= 6
    _, share = language.mixtures(np.zeros(len(bucket), int), bucket, count.astype(float), p)
    assert share[0, 8] > 0.1 and share[0, 0] > 0.5


# --- 6 -------------------------------------------------------------------------

@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("<!-- x", ""), ("<script>x", ""), ("<p>only", "only"),
    ("a &lt; b &amp;c &#233;<br>d", "a < b &c é d"),
    ("<nav><a href=x>Menu</a></nav><article><h1>T</h1><p><b>one, two<br><p>three</article><footer>f</footer>",
     "T\n\none, two\n\nthree"),
    ('<div class="post"><p>Long text, with commas, and more of it.</p><ul><li>i</ul></div><div id="comments"><p>I, really, '
     'hate, this, so, much, you, know</p></div><aside>x</aside><form><p>Subscribe</p></form>',
     "Long text, with commas, and more of it.\n\ni"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
])
def test_main_text(html, text):
    assert html_text.extract(html) == text


def test_main_text_of_pages(spark):
    pages = spark.createDataFrame([(1, None, None), (None, "u", "<p>a  b</p>")], "page_id long, url string, html string")
    assert {tuple(r) for r in html_text.main_text(pages).collect()} == {(1, None, "", 0), (None, "u", "a b", 3)}
    assert html_text.main_text(pages.filter("false")).count() == 0


# --- 7 -------------------------------------------------------------------------

def test_toxicity_held_out_and_edge_cases(spark):
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        w = words(rng, 30).split()
        if bad:
            w[4], w[9] = "idiotic", "moron!"
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    d = frame(spark, [*rows, (None, None), (900, ""), (901, "z" * 40_000)])
    known = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(d, known, lambda c: ~held_out(c, 3, 1))
    got = toxicity.score(d, model)
    assert got.count() == 303 and got.columns == [*d.columns, "score"]
    right = got.join(known.filter("toxic is not null and doc_id is not null"), "doc_id").filter(held_out("doc_id", 3, 1)) \
        .filter((F.col("score") >= 0.7).cast("int") == F.col("toxic")).count()
    total = sum(zlib.crc32(str(i).encode()) % 3 == 1 for i in range(300))
    assert right >= 0.95 * total
    none = toxicity.fit(d, known.filter("false"), lambda c: ~held_out(c, 3, 1))
    assert {r.score for r in toxicity.score(d, none).collect()} == {0.0}


# --- 8 -------------------------------------------------------------------------

def test_top_k_with_ties_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(8)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 40)))]
    vectors += [(100 + k, vectors[0][1]) for k in range(25)] + [(200, None), (201, []), (None, vectors[1][1]), (202, [None] * 40)]
    d = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    codes = hamming.binary_codes(d, "vec_id", "embedding", 1)
    got = hamming.top_k(codes, codes.filter("id % 50 = 0"), k=7)
    bits = {i: [x is not None and x > 0 for x in v] for i, v in vectors if i is not None and v}
    want = set()
    for q in (i for i in bits if i % 50 == 0):
        near = sorted((sum(a != b for a, b in zip(bits[q], bits[i], strict=True)), i) for i in bits if i != q)[:7]
        want |= {(q, k + 1, i, dist) for k, (dist, i) in enumerate(near)}
    assert {tuple(r) for r in got.collect()} == want
    few = codes.filter("id < 3")
    assert hamming.top_k(few, few.filter("id = 0")).count() == 2
    assert hamming.top_k(few.filter("false"), few.filter("false")).count() == 0


def test_top_k_uses_every_component(spark, tmp_path):
    v = np.random.default_rng(2).normal(size=(30, 150))
    v[1:, :64] = v[0, :64]
    rows = [(i, [float(x) for x in a]) for i, a in enumerate(v)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.QUERIES["op8_hamming_top_k"](spark, str(tmp_path))
    got = sorted(tuple(r) for r in found.select("neighbour_id", "distance").collect())
    d = ((v[1:] > 0) != (v[0] > 0)).sum(axis=1)
    assert got == sorted((i + 1, int(d[i])) for i in np.argsort(d, kind="stable")[:hamming.K])


# --- 9 -------------------------------------------------------------------------

def test_archives_round_trip(spark):
    rows = [(5, "http://a/ b", "<p>é\r\n\r\nWARC/1.1\r\n"), (3, None, "same"), (9, "u", "same"), (9, "u", "same"), (None, "v", "same"),
            (1, "w", None), (2, "w", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = warc.archive_folder(pages)
    index = warc.write_archives(pages, folder)
    got = warc.read_archives(index, folder).collect()
    facts = Counter((r.page_id, r.record_type, r.refers_to, r.payload) for r in got)
    assert facts == Counter([(5, "response", None, rows[0][2]), (3, "response", None, "same"), (9, "revisit", 3, None),
                             (9, "revisit", 3, None), (None, "revisit", 3, None), (1, "response", None, ""),
                             (2, "revisit", 1, None)])
    assert {r.payload_bytes for r in got if r.page_id == 9} == {4}
    one = warc.read_archives(index.filter("page_id = 5"), folder).collect()
    assert [r.payload for r in one] == [rows[0][2]]
    assert warc.read_archives(warc.write_archives(pages.filter("false"), folder), folder).count() == 0


def test_ranges_are_coalesced():
    assert warc.coalesce_ranges([(0, 10), (10, 5), (warc.GAP_BYTES * 3, 4)]) == [(0, 15, 2), (196608, 196612, 1)]


# --- 10 ------------------------------------------------------------------------

def test_bpe_equals_the_library(spark, docs):
    import tokenizers
    path = queries.tokenizer_file()
    reference = tokenizers.Tokenizer.from_file(path)
    reference.no_truncation()
    reference.no_padding()
    rng = random.Random(4)
    pool = [chr(c) for c in (*range(0x20, 0x250), *range(0x300, 0x340), 0x3A3, 0x130, 0x2003, 0x3000, 0xAC00, 0x1F600, 0x1C)]
    rows = [(i, "".join(rng.choices(pool, k=rng.randint(0, 60)))) for i in range(300)]
    rows += [(400, "it's <|endoftext|>I'LL<|startoftext|> x"), *[(i + 1000, t) for i, t in ODD if i in (1, 2, 3, 5, 6, 7)]]
    for r in bpe.encode(frame(spark, rows), path).collect():
        want = reference.encode(dict(rows)[r.doc_id] or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == reference.decode(want, skip_special_tokens=False)
    hashed = {r.doc_id: r for r in bpe.digests(frame(spark, rows), path).collect()}
    assert hashed[1002].n_tokens == 0 and hashed[1002].ids_sha256 == hashlib.sha256(b"").hexdigest()


# --- pipeline ------------------------------------------------------------------

def test_pipeline_stages(spark):
    import corpus_pipeline
    names = spark.read.parquet(f"{SF}/documents.parquet")
    docs, kept = names, []
    for name, stage_of in corpus_pipeline.STAGES[1:4]:
        docs = stage_of(spark, docs, SF)
        kept.append(docs.count())
        assert docs.columns == names.columns
    assert names.count() >= kept[0] >= kept[1] >= kept[2] > 0.5 * names.count()
