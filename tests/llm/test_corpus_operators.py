"""Packing, prefix trie and collocations against the library and brute force, with their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cctally.llm import collocations, html_text, language, packing, prefix_trie, queries, suffix_tree

SCHEMA = "doc_id long, text string, lang string, source string, n int, ids string, pos int, a long, row string"
ODD = [None, "", " ", "\n\n\n", "x", "a" * 30_000, "don't  stop\t\n now 12 345!!", "é b 　c\u0085d\x1ce",
       "an <|endoftext|> inside <|endoftext|>", "日本語 テスト👩‍👩‍👧 ok", "tail  ", "  head", "﻿bom b", "I'll we've 's x's"]


def frame(spark, texts, langs=None):
    rows = [(i, t, langs[i] if langs else "en", "s", 1, "i", 2, 3, "r") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


# --- 11 ------------------------------------------------------------------------

def check_packed(rows, ids_of, length):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids_of)
    for doc, found in pieces.items():
        ids, at = ids_of[doc], 0
        for r in sorted(found, key=lambda r: r.start):
            data = np.array(ids[at:at + r.length], "<u4").tobytes()
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(data))
            assert r.ids is None or bytes(r.ids) == data
            at += r.length
        assert at == len(ids)
    sizes = []
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        sizes.append(at)
    assert all(n <= length and n & (n - 1) == 0 for n in sizes)
    assert sum(n < length for n in sizes) <= length.bit_length()


@pytest.mark.parametrize("length", [2048, 64, 1])
def test_packing_holds_each_id_once(spark, length):
    path = queries.tokenizer_file("byte_bpe_50k.json")
    rng = random.Random(5)
    texts = [*ODD, *["".join(rng.choices("ab c'é\n.1\t S ", k=rng.randint(0, 400))) for _ in range(60)]]
    texts = [t[:50] if t and length == 1 else t for t in texts]
    found = Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)
    rows = packing.pack(frame(spark, texts), path, length=length).collect()
    check_packed(rows, {i: [*e.ids, 1] for i, e in enumerate(found)}, length)


def test_packing_of_repeated_rows_null_ids_and_an_empty_table(spark):
    path = queries.tokenizer_file("byte_bpe_50k.json")
    docs = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "no id"), (None, None)], "doc_id long, text string")
    rows = packing.pack(docs, path).collect()
    assert Counter(r.doc_id for r in rows)[1] >= 2 and sum(r.length for r in rows) == 2 * 3 + 3 + 1
    assert packing.unused_share(packing.pack(docs, path)) == 0
    assert packing.pack(docs.limit(0), path).collect() == []
    with pytest.raises(ValueError):
        packing.pack(docs, path, length=100)


def test_hilbert_curve_visits_each_cell_once_by_single_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        key = packing.hilbert(cells, bits)
        assert sorted(key) == list(range(side ** dims))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1) == 1).all()


def test_copies_are_neighbours(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghijklmno", k=5))
    texts = [" ".join(word() for _ in range(300)) for _ in range(40)]
    texts += texts[:40]
    rows = packing.pack(frame(spark, texts), queries.tokenizer_file("byte_bpe_50k.json")).collect()
    start = {r.doc_id: r.sequence_id * 2048 + r.offset for r in rows if r.start == 0}
    size = {r.doc_id: r.doc_tokens for r in rows}
    assert all(abs(start[i] - start[i + 40]) == size[i] for i in range(40))


def test_chunks_equal_the_library(monkeypatch):
    path = queries.tokenizer_file("byte_bpe_50k.json")
    monkeypatch.setattr(packing, "CACHE_CHUNKS", 50)  # emptied again and again
    encoder = packing.ChunkEncoder(open(path, encoding="utf-8").read())
    rng = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ'’0123456789 \t\n\r\x0b\x0c.,!?-_äöüßéèñçøæœ漢字あア한국👍́‍  "
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(4000)]
    ids, count = encoder.encode(pa.array(texts))
    want = [e.ids for e in encoder.whole.encode_batch(texts, add_special_tokens=False)]
    assert count.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


# --- 12 ------------------------------------------------------------------------

def brute_trie(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    new = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        new[c] = own.get(base, [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c in sorted(new):
        for d in range(len(new[c]) + 1):
            members[tuple(new[c][:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * words
    return Counter((m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in m if len(new[c]) == len(p)).encode()).hexdigest())
                   for p, m in members.items())


def talks(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows],
                                 "conv_id long, turn long, role string, text string, pos string, words int, depth int")


@pytest.mark.parametrize(("shard", "band"), [(1024, 1024), (3, 2), (1, 1), (7, 5)])
def test_trie_equals_brute_force(spark, shard, band):
    rng = random.Random(shard)
    rows = []
    for c in [*range(-25, 30), 40, 41, 47, 1000, 10 ** 15]:
        if c in (0, 21):  # a family without its first conversation
            continue
        for t in range(rng.choice([1, 2, 3, 4, 6])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]),
                         rng.choice(["hello there", "yes", "a b  c\td", "", None, " x y"])))
    rows += [(40, 2, "user", "yes")] * 3 + [(None, 1, "user", "lost")]
    rows += [(c, t, "user", f"turn {t}") for c in (60, 61, 62) for t in range(23)]
    got = prefix_trie.digests(prefix_trie.rebuilt(talks(spark, rows)), shard=shard, band=band).collect()
    assert Counter(map(tuple, got)) == brute_trie(rows)


def test_trie_of_an_empty_table_and_texts_of_nodes(spark):
    assert prefix_trie.digests(prefix_trie.rebuilt(talks(spark, []))).collect() == []
    rows = [(c, t, "user", f"t{t} of {c % 2}") for c in (1, 2, 3) for t in range(5)]
    turns = prefix_trie.rebuilt(talks(spark, rows), family=1, keep_text=True)
    nodes, _ = prefix_trie.trie(turns)
    found = {(r.conv_id, r.depth): r.text for r in prefix_trie.last_turns(nodes, turns).collect()}
    assert found[1, 0] is None and found[1, 3] == "t2 of 1" and found[2, 1] == "t0 of 0" and (3, 1) not in found


# --- 13 ------------------------------------------------------------------------

def brute_collocations(rows, least, top):
    total, counts = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for m in range(1, 6):
                counts.update((lang, *words[i:i + m]) for i in range(len(words) - m + 1))
    found = defaultdict(list)
    kept = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    for (lang, *w), a in kept.items():
        n = total[lang]
        score, _, k = min((1000 * a * n // (counts[lang, *w[:k]] * counts[lang, *w[k:]]), k, k) for k in range(1, len(w)))
        if not any(q[0] == lang and len(q) > len(w) + 1 and b >= a and
                   any(list(q[i:i + len(w)]) == w for i in range(1, len(q) - len(w) + 1)) for q, b in kept.items()):
            found[lang].append((-score, -a, " ".join(w).encode(), counts[lang, *w[:k]], counts[lang, *w[k:]], n))
    return Counter((lang, r + 1, p.decode(), -a, l, r_, n, -s) for lang, v in found.items()
                   for r, (s, a, p, l, r_, n) in enumerate(sorted(v)[:top]))


@pytest.mark.parametrize(("block_bytes", "split"), [(12_000_000, 1000), (300, 1000), (300, 1), (2000, 5)])
def test_collocations_equal_brute_force(spark, block_bytes, split):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["a", "B", "c", "d", "é", "x\x1fy", "one", "two.", "\t", "f\ng", "", "U v"],
                                  k=rng.randint(0, 60))) for _ in range(150)]
    texts += ["in the long run of it", "In the LONG run of it!"] * 6 + [None, "", "...", "q" * 5000, "z z z z z z z z"]
    langs = [rng.choice(["en", "de", "de", None, "und", ""]) for _ in texts]
    docs = frame(spark, texts, langs)
    want = brute_collocations(list(zip(langs, texts, strict=True)), 4, 30)
    got = collocations.top_collocations(docs, top=30, min_count=4, block_bytes=block_bytes, split=split).collect()
    assert Counter(map(tuple, got)) == want


def test_collocations_of_an_empty_table(spark):
    assert collocations.top_collocations(frame(spark, []).limit(0)).collect() == []


def test_varints_round_trip():
    values = np.array([0, 1, 127, 128, 300, 2 ** 40, 2 ** 62, 5], np.int64)
    data, size = collocations.varints(values)
    back, last = collocations.read_varints(data)
    assert back.tolist() == values.tolist() and (np.cumsum(size) - 1).tolist() == last.tolist()
    assert len(collocations.varints(values[:0])[0]) == 0


# --- 4 -------------------------------------------------------------------------

def test_language_model_scores_very_long_unseen_words(spark):
    rows = [(i, "the cat sat on the mat " * 3) for i in range(40)]
    rows += [(1000 + i, f"the {'q' * n} mat {'z' * n} cat") for i, n in enumerate([300, 400, 10_000] * 12)]
    got = suffix_tree.score_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and any(r.held_out for r in got if r.doc_id >= 1000)
    assert all(r.score is not None and -1e6 < r.score < 0 for r in got)


# --- 5, 6 and the pipeline -------------------------------------------------------

def test_marks_alone_are_undetermined_and_texts_do_not_sway_each_other(spark):
    rng = random.Random(3)
    text = lambda letters: " ".join("".join(rng.choices(letters, k=5)) for _ in range(40))
    rows = [(i, text("abcde"), "aa") for i in range(30)] + [(100 + i, text("vwxyz"), "zz") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, lambda c: F.col(c).isNotNull())
    odd = [(1, "́ ̂"), (2, "123 !"), (3, None), (4, text("abcde")), (5, text("abcde") + " " + text("vwxyz"))]
    alone = {i: language.predict(spark.createDataFrame([(i, t)], "doc_id long, text string"), model).first() for i, t in odd}
    together = {r.doc_id: r for r in language.predict(spark.createDataFrame(odd, "doc_id long, text string").coalesce(1), model).collect()}
    assert alone == together
    assert [alone[i].lang_pred for i in (1, 2, 3, 4)] == ["und", "und", "und", "aa"] and alone[1].score == 0
    assert set(alone[5].languages) == {"aa", "zz"}


def test_language_mixture_equals_brute_force():
    """The chosen set and shares against plain expectation-maximisation over every prefix of the ranked languages."""
    rng = np.random.default_rng(0)
    p = rng.dirichlet(np.full(50, 0.3), size=3).T
    texts = [rng.choice(50, size=200, p=p[:, rng.integers(3)]) for _ in range(10)]
    texts += [np.r_[rng.choice(50, size=150, p=p[:, 0]), rng.choice(50, size=150, p=p[:, 2])] for _ in range(5)]
    row = np.concatenate([np.full(len(np.unique(t)), i) for i, t in enumerate(texts)])
    bucket, count = map(np.concatenate, zip(*[np.unique(t, return_counts=True) for t in texts], strict=True))
    at, found = language.mixtures(row, bucket, count.astype(float), p)
    assert at.tolist() == list(range(15)) and np.allclose(found.sum(1), 1)
    for i, t in enumerate(texts):
        log = lambda share: np.log(p[t] @ share).sum()  # noqa: E731,B023
        single = max(log(np.eye(3)[k]) for k in range(3))
        assert log(found[i]) >= single - 1e-6
        assert (found[i] > 0.2).sum() == (1 if i < 10 else 2)


@pytest.mark.parametrize("name", [
    "comment-body", "comment-text", "post-comments", "article-comments", "entry-comments", "story-comments", "commentlist",
    "main-menu", "article-sidebar", "footer-content", "newsletter-body", "cookie-text", "ad-content", "sponsored-content"])
def test_boilerplate_classes_go_and_the_article_stays(name):
    para = "A paragraph of the article, with commas, clauses, and words enough to count as running text in any page."
    page = (f"<body><div class='post-content main'><h1>Title</h1><p>{para}</p><div class='{name}'><p>UNWANTED {para}</p></div>"
            f"<p>{para}</p><section><h3>Comments (2)</h3><p>READER {para}</p></section><p>{para}</p></div></body>")
    text = html_text.extract(page)
    assert text.count(para) == 3 and "UNWANTED" not in text and "READER" not in text


def test_pipeline_keeps_columns_of_any_name(spark):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    names = ["score", "features", "_text_", "removed_chunks", "removed_lines", "_set_key_", "row", "h", "whole row", "x"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for n in names:
        docs = docs.withColumn(n, F.concat(F.lit(n), F.col("doc_id").cast("string")))
    plain, out = spark.read.parquet(f"{sf}/documents.parquet"), docs
    for _, stage_of in corpus_pipeline.STAGES[:4]:
        out, plain = stage_of(spark, out, sf), stage_of(spark, plain, sf)
        assert out.columns == docs.columns
    rows = out.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in plain.collect()}
    assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)


def test_toxicity_task_gets_each_text_once(spark, monkeypatch):
    """The pipeline sent three copies of a text to a task, and held the running sums of all facts at once."""
    import corpus_pipeline
    from cctally.llm import toxicity
    model = toxicity.Model(toxicity.Lexicon(["vile$"], []), None, None, 0.0)
    seen = []

    class Trees:
        def transform(self, rows):
            seen.append(rows)
            return rows.withColumn("probability", rows["x"])

    model.trees = Trees()
    monkeypatch.setattr(toxicity, "fit", lambda *a, **k: model)
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: None)
    docs = spark.createDataFrame([(1, "a vile text", "x", 3), (2, None, "y", None)],
                                 "doc_id long, text string, lang string, `a.b` int")
    out = corpus_pipeline.drop_toxic(spark, docs, "")
    assert out.columns == docs.columns and out.schema["text"].dataType == docs.schema["text"].dataType
    plan = seen[0]._jdf.queryExecution().analyzed().toString()
    line = next(x for x in plan.splitlines() if "MapInArrow" in x)
    assert line.count("text#") == 2  # once in, once out
    assert "text" not in seen[0].schema["row"].dataType["rest"].dataType.names


def test_features_hold_one_fact_at_a_time():
    import tracemalloc

    from cctally.llm import toxicity
    texts = pa.array(["you are a vile person and this text is long " * 400] * 20)
    tracemalloc.start()
    x = toxicity.features_of(texts, toxicity.Lexicon(["vile$"], ["pers"]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    words = 10 * 400 * 20
    assert np.allclose(x[0, :2], [0.1, 0.1]) and x[0, 3] == np.log1p(400) and x[0, 4] == pytest.approx(0.1)
    assert peak < 10 * 8 * words  # before: the sums of 13 facts, twice


def test_blocks_are_read_a_slice_at_a_time(monkeypatch):
    from cctally.llm import common
    texts = pa.array(["A b. c a", None, "", "b;b é\nc", "x", "  ", "a b c d e"])
    words, doc, piece = collocations.tokens_of(texts)
    coded = words.dictionary_encode()
    breaks = np.flatnonzero(piece[1:] != piece[:-1]) + 1
    for limit in (1, 9, 1000):
        monkeypatch.setattr(collocations, "slices", lambda t, n=limit: common.slices(t, n))
        distinct, code, at, cut = collocations._coded(texts)
        assert distinct.to_pylist() == coded.dictionary.to_pylist()
        assert code.tolist() == coded.indices.to_pylist()
        assert at.tolist() == doc.tolist() and cut.tolist() == breaks.tolist()
    key = np.array([5, 1, 5, 3])
    for most in (6, 1000):
        got = collocations._numbers(key, most)
        assert [x.tolist() for x in got] == [[1, 3, 5], [2, 0, 2, 1], [1, 1, 2]]
