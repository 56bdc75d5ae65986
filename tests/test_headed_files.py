import glob

from pyspark.sql import functions as F

from cctally.plans.catalog_io import _headed


def test_every_file_begins_with_its_header_and_no_row_moves(spark, scratch):
    body = spark.range(0, 1000, 1, 5).select((F.col("id") % 4).alias("part"), F.concat(F.lit("r"), F.col("id")).alias("line"))
    lines = _headed(body, "HEAD", 4)
    assert "Exchange" not in lines._jdf.queryExecution().executedPlan().toString()
    lines.write.partitionBy("part").text(scratch)
    seen = []
    for k in range(4):
        files = glob.glob(f"{scratch}/part={k}/*.txt")
        assert len(files) == 5  # one of each task, not one task for the whole part
        for f in files:
            with open(f) as text:
                head, *rows = text.read().splitlines()
            assert head == "HEAD" and "HEAD" not in rows
            assert all(int(r[1:]) % 4 == k for r in rows)
            seen += rows
    assert sorted(seen) == sorted(f"r{i}" for i in range(1000))
