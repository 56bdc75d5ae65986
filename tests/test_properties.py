"""Properties and plan checks (§5.5)."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cctally.functions import rules as R
from cctally.operators import counts as A
from cctally.plans import catalog as CA
from cctally.plans import catalog_jobs as CJ
from cctally.plans import jobs
from cctally.sources import readers

SF = "/root/testdata/sf0.001"


def test_rows_read_equal_kept_plus_rejected(spark, scratch):
    lines = ["id;name"] + [f"{i};n{i}" + (";extra" if i % 4 == 0 else "") for i in range(1, 41)]
    os.makedirs(scratch, exist_ok=True)
    with open(f"{scratch}/a.csv", "w") as fh:
        fh.write("\n".join(lines) + "\n")
    res = readers.read_delimited(spark, [scratch], ["id", "name"])
    assert res.data.count() + res.rejects.count() == 40
    assert res.rejects.count() == 10


def test_lookups_preserve_left_row_count(spark):
    inter = CA.standin(spark, SF, ["orders"], CJ._interactions)
    n = inter.count()
    cl = CA.standin(spark, SF, ["customer"], CJ._contact_list)
    st = CA.standin(spark, SF, ["customer"], CJ._staffing)
    qu = CA.standin(spark, SF, ["customer"], CJ._quartiles)
    sh = CA.standin(spark, SF, ["customer"], CJ._shifts)
    # no dedup key can collide when the key includes the unique row order
    out = jobs.consolidated_interactions(inter, cl, st, qu, sh, as_of=CA.AS_OF, inputs=CJ.INPUTS,
                                         dedup_keys=("time", "agent", "phone", "disposition", "bucket", "_ord"))
    assert out.count() == n


def test_buckets_plus_unmatched_equal_rows(spark):
    df = CA.standin(spark, SF, ["events"], CA._count_files).withColumn(
        "label", R.first_match(F.upper("file_name"), CA.FILE_RULES))
    row = A.bucket_counts(df, "label", CA.BUCKETS, total="rows").first()
    unmatched = df.where(F.col("label").isNull()).count()
    assert sum(row[k] for k in CA.BUCKETS) + unmatched == row["rows"]


def test_consolidation_independent_of_partitioning(spark):
    a = sorted(map(tuple, E.entry(spark).collect()), key=str)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        inter = CA.standin(spark, SF, ["orders"], CJ._interactions).repartition(5).orderBy(F.rand(3))
        cl = CA.standin(spark, SF, ["customer"], CJ._contact_list).repartition(3)
        st = CA.standin(spark, SF, ["customer"], CJ._staffing)
        qu = CA.standin(spark, SF, ["customer"], CJ._quartiles)
        sh = CA.standin(spark, SF, ["customer"], CJ._shifts)
        b = jobs.consolidated_interactions(inter, cl, st, qu, sh, as_of=CA.AS_OF, inputs=CJ.INPUTS)
        b = sorted(map(tuple, b.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


@pytest.fixture(scope="module")
def plans(spark):
    out = {}
    for name, fn in CA.QUERIES.items():
        out[name] = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
    return out


def test_no_python_or_cartesian_in_any_plan(plans):
    assert len(plans) == len(CA.ORACLES)
    for name, plan in plans.items():
        for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                    "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)


def test_dimensions_are_broadcast_at_test_scale(plans):
    for name in ("consolidated_interactions", "form_report", "fallback_lookup", "lookup_left_first_wins",
                 "accumulated_contacts"):
        assert "BroadcastHashJoin" in plans[name], name
        assert "SortMergeJoin" not in plans[name], name


def test_consolidation_same_without_broadcast(spark):
    """Every lookup forced beyond the broadcast bound (sort-merge, null-key
    spreading, hot-key salting) gives the same rows as the broadcast plan."""
    a = sorted(map(tuple, E.entry(spark).collect()), key=str)
    spark.conf.set("cctally.broadcast.maxRows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = E.entry(spark)
        plan = df._jdf.queryExecution().executedPlan().toString()
        b = sorted(map(tuple, df.collect()), key=str)
    finally:
        spark.conf.unset("cctally.broadcast.maxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert a == b


@pytest.mark.parametrize("name", ["form_report", "accumulated_contacts", "fallback_lookup", "lookup_left_first_wins",
                                  "lookup_fanout", "null_keys_never_match"])
def test_queries_same_without_broadcast(spark, name):
    q = CA.QUERIES[name]
    a = sorted(map(tuple, q(spark, SF).collect()), key=str)
    spark.conf.set("cctally.broadcast.maxRows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        b = sorted(map(tuple, q(spark, SF).collect()), key=str)
    finally:
        spark.conf.unset("cctally.broadcast.maxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert a == b
