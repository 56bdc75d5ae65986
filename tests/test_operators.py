"""Lookups, dedup, numbering and counts: semantics and plan properties."""

from pyspark.sql import functions as F

from cctally.operators import counts as A
from cctally.operators.dedup import keep_first, number_in_order
from cctally.operators.lookup import fallback_lookup, first_wins, lookup


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_wins_keeps_null_of_first_row(spark):
    dim = spark.createDataFrame([("k", None, 1), ("k", "late", 2), (None, "x", 0)], "key string, v string, o int")
    assert [tuple(r) for r in first_wins(dim, "key", ["v"], ["o"]).collect()] == [("k", None)]


def test_lookup_preserves_left_rows_and_null_keys_never_match(spark):
    fact = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, k string")
    dim = spark.createDataFrame([("a", "A", 1), (None, "N", 0), ("a", "A2", 2)], "k string, v string, o int")
    out = lookup(fact, dim, fact_key="k", dim_key="k", values=["v"], order=["o"])
    assert sorted(tuple(r) for r in out.select("id", "v").collect()) == [(1, "A"), (2, None), (3, None)]
    assert "BroadcastHashJoin" in plan(out)


def test_lookup_without_broadcast_is_sort_merge(spark):
    fact = spark.range(100).withColumn("k", F.col("id").cast("string"))
    dim = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v"), F.col("id").alias("o"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup(fact, dim, fact_key="k", dim_key="k", values=["v"], order=["o"], max_rows=10)
        assert out.count() == 100
        assert "BroadcastHashJoin" not in plan(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_absent_dimension_marker(spark):
    fact = spark.createDataFrame([(1,)], "id int")
    out = lookup(fact, None, fact_key="id", dim_key="id", values=["q"], marker="Error de Cruce")
    assert out.first()["q"] == "Error de Cruce"


def test_fallback_priority(spark):
    fact = spark.createDataFrame([(1, "id1", "p1"), (2, None, "p2"), (3, None, "zz")], "n int, cid string, ph string")
    dim = spark.createDataFrame([("id1", None, None, None, 1), (None, "p1", None, "PHONE", 2),
                                 (None, None, "p2", "SECOND", 3)],
                                "cid string, p1 string, p2 string, seg string, o int")
    out = fallback_lookup(fact, dim, keys=[("cid", "cid"), ("ph", "p1"), ("ph", "p2")], value="seg", out="b",
                          order=["o"], default="No Encontrado")
    got = dict((r["n"], r["b"]) for r in out.collect())
    # id hit with a null segment falls through to the phone's segment
    assert got == {1: "PHONE", 2: "SECOND", 3: "No Encontrado"}
    assert out.count() == 3


def test_keep_first_total_order_and_idempotent(spark):
    df = spark.createDataFrame([("k", "10:00", "b.csv", 2), ("k", "10:00", "a.csv", 5), ("k", None, "a.csv", 0),
                                ("j", "09:00", "a.csv", 1)], "key string, t string, f string, o int")
    order = [F.col("t").asc_nulls_last(), F.col("f"), F.col("o")]
    once = keep_first(df, ["key"], order)
    assert sorted(tuple(r) for r in once.collect()) == [("j", "09:00", "a.csv", 1), ("k", "10:00", "a.csv", 5)]
    assert sorted(once.collect()) == sorted(keep_first(once, ["key"], order).collect())
    assert "WindowGroupLimit" in plan(once)


def test_keep_first_independent_of_partitioning(spark):
    df = spark.range(2000).select((F.col("id") % 37).alias("k"), (F.col("id") * 7919 % 1000).alias("t"), "id")
    order = [F.col("t"), F.col("id")]
    a = sorted(keep_first(df.repartition(1), ["k"], order).collect())
    b = sorted(keep_first(df.repartition(8), ["k"], order).collect())
    assert a == b


def test_keep_first_sorts_behind_an_exchange_and_deals_hot_keys(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, (F.col("id") % 50).cast("string")).alias("k"),
        (F.col("id") * 7919 % 1009).alias("t"), "id")
    order = [F.col("t").asc_nulls_last(), F.col("id")]
    out = keep_first(df, ["k"], order)
    rows = sorted(df.collect(), key=lambda r: (r["t"], r["id"]), reverse=True)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, {r["k"]: r for r in rows}.values()), key=str)
    # no input split is sorted: an exchange lies below the lowest sort, and it deals a key's rows by their parts
    text = plan(out)
    assert text.rindex("Exchange hashpartitioning") > text.rindex("Sort [") and "hashpartitioning(k#" in text
    assert "__part#" in text[text.rindex("Exchange hashpartitioning"):].splitlines()[0]


def test_number_in_order_matches_sorted_positions(spark):
    df = spark.range(500).select("id", ((F.col("id") * 7919) % 503).alias("k")).repartition(7)
    out = number_in_order(df, [F.col("k"), F.col("id")])
    got = [r["id"] for r in out.orderBy("row_no").collect()]
    expected = [r["id"] for r in df.orderBy("k", "id").collect()]
    assert got == expected
    assert [r["row_no"] for r in out.orderBy("row_no").collect()] == list(range(1, 501))


def test_bucket_counts_sum(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "l string")
    row = A.bucket_counts(df, "l", {"A": "a", "B": "b", "C": "c"}, total="rows").first()
    assert (row["A"], row["B"], row["C"], row["rows"]) == (2, 1, 0, 4)


def test_null_keys_spread_on_sort_merge_path(spark):
    """Without a broadcast, null fact keys are spread over many reducers and
    still never match; every left row survives exactly once."""
    fact = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, None)
                                    .otherwise((F.col("id") % 50).cast("string")).alias("k"))
    dim = spark.range(60).select(F.col("id").cast("string").alias("k"), F.concat(F.lit("v"), "id").alias("v"),
                                 F.col("id").alias("o"))
    out = lookup(fact, dim, fact_key="k", dim_key="k", values=["v"], order=["o"], broadcast=False)
    rows = out.collect()
    assert len(rows) == 4000
    assert all((r["v"] is None) == (r["k"] is None) for r in rows)
    assert all(r["v"] == "v" + r["k"] for r in rows if r["k"] is not None)
    fb = fallback_lookup(fact.withColumn("k2", F.col("k")), dim.withColumn("k2", F.col("k")),
                         keys=[("k", "k"), ("k2", "k2")], value="v", out="b", order=["o"], default="none",
                         broadcast=False)
    assert fb.count() == 4000 and fb.where("k IS NULL AND b <> 'none'").count() == 0


def test_hot_key_salting_is_exact(spark):
    """One key holds a third of the fact: it is salted over many reducers on
    the sort-merge path, and the result equals the broadcast result."""
    fact = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, F.lit("HOT"))
                                    .when(F.col("id") % 7 == 0, F.lit(None))
                                    .otherwise((F.col("id") % 40).cast("string")).alias("k"))
    dim = spark.range(40).select(F.col("id").cast("string").alias("k"), F.concat(F.lit("v"), "id").alias("v"),
                                 F.col("id").alias("o")).unionByName(
        spark.createDataFrame([("HOT", "vhot", 0)], "k string, v string, o long"))
    from cctally.operators.lookup import hot_keys
    assert "kHOT" in hot_keys(fact, F.concat(F.lit("k"), F.col("k")), fraction=1.0, min_share=0.2)
    salted = lookup(fact, dim, fact_key="k", dim_key="k", values=["v"], order=["o"], broadcast=False)
    plain = lookup(fact, dim, fact_key="k", dim_key="k", values=["v"], order=["o"], broadcast=True)
    assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert salted.count() == 6000


def test_map_with_table_modes(spark):
    from cctally.operators.lookup import map_with_table
    fact = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "s string")
    mp = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "late")], "from string, to string")
    for mode in ("auto", False):
        rep = map_with_table(fact, "s", mp, out="r", broadcast=mode)
        assert sorted(((r["s"], r["r"]) for r in rep.collect()), key=str) == sorted(
            [("a", "b"), ("b", "a"), ("c", "c"), (None, None)], key=str)
        dflt = map_with_table(fact, "s", mp, out="r", keep_unmapped=False, default="-", broadcast=mode)
        assert sorted(((r["s"], r["r"]) for r in dflt.collect()), key=str) == sorted(
            [("a", "b"), ("b", "a"), ("c", "-"), (None, "-")], key=str)
