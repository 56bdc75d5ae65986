"""Property test: the fallback lookup (J2) against a Python model."""

from hypothesis import given, settings
from hypothesis import strategies as st

from cctally.operators.lookup import fallback_lookup

KEY = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
VAL = st.one_of(st.none(), st.sampled_from(["S1", "S2", "S3"]))


def model(facts, dims, default="none"):
    def first(col):
        seen = {}
        for row in sorted(dims, key=lambda r: r[4]):
            k = row[col]
            if k is not None and k not in seen:
                seen[k] = row[3]
        return seen
    b = [first(0), first(1), first(2)]
    out = []
    for n, cid, ph in facts:
        cands = [b[0].get(cid) if cid is not None else None,
                 b[1].get(ph) if ph is not None else None,
                 b[2].get(ph) if ph is not None else None]
        out.append((n, next((c for c in cands if c is not None), default)))
    return sorted(out)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(KEY, KEY), min_size=1, max_size=12),
       st.lists(st.tuples(KEY, KEY, KEY, VAL), min_size=1, max_size=12),
       st.booleans())
def test_fallback_matches_model(spark, facts, dims, use_broadcast):
    facts = [(i, c, p) for i, (c, p) in enumerate(facts)]
    dims = [(a, b, c, v, i) for i, (a, b, c, v) in enumerate(dims)]
    f = spark.createDataFrame(facts, "n int, cid string, ph string")
    d = spark.createDataFrame(dims, "cid string, p1 string, p2 string, seg string, o int")
    out = fallback_lookup(f, d, keys=[("cid", "cid"), ("ph", "p1"), ("ph", "p2")], value="seg", out="b",
                          order=["o"], default="none", broadcast=use_broadcast)
    assert sorted((r["n"], r["b"]) for r in out.collect()) == model(facts, dims)
