"""Keep-first dedup and ordering: D2, O1, O2.

``keep_first`` is ``row_number() = 1`` over a window partitioned by the key,
taken twice: first within ``SALTS`` parts of each key, then over the parts'
first rows.  Both are computed behind an exchange, so a task sorts one shuffle
partition and no task sorts all rows of its input split; a key holding a third
of the rows is dealt over ``SALTS`` tasks and shrinks to one row per part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import freed_shuffles, staging_dir
from .lookup import hashable

#: Parts of a key's rows that are reduced on their own.
SALTS = 32


def _col(c) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def keep_first(df: DataFrame, keys: Sequence, order_by: Sequence[Column]) -> DataFrame:
    """One row per key -- the first in ``order_by`` (make it a total
    order: e.g. time nulls last, then source file, then row ordinal, Q5)."""
    cols = [_col(k) for k in keys]

    def first(rows: DataFrame, by: Sequence[Column]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*order_by)
        # dealt before the window: its partial group limit would sort whole input splits
        dealt = rows.repartition(*by) if by else rows
        return dealt.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")

    part = F.pmod(F.xxhash64(*hashable(df)), F.lit(SALTS)).cast("int")
    parts = first(df.withColumn("__part", part), [*cols, F.col("__part")])
    return first(parts, cols).drop("__part")


def number_in_order(df: DataFrame, order_by: Sequence[Column], out: str = "row_no") -> DataFrame:
    """O1/O2: global 1-based position of every row in a total order.

    Distributed: a range-partitioned sort is written once, with each row's
    partition and place in it, to the shared folder.  The rows and the sizes
    (one small row per partition) are both read from that table, so they see
    the same partitions whatever columns either needs.
    No step moves the rows to one task.
    """
    row = df.orderBy(*order_by).select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.spark_partition_id().alias("pid"),
        F.monotonically_increasing_id().alias("mid"),
    )
    path = staging_dir(df.sparkSession, "numbered")
    with freed_shuffles(df.sparkSession):
        row.write.parquet(path)
    tagged = df.sparkSession.read.schema(row.schema).parquet(path)
    # the id is (partition << 33) + index within the partition
    index = F.col("mid") - F.shiftleft(F.col("pid").cast("long"), 33)
    offsets = tagged.groupBy("pid").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("pid").alias("part"),
        F.sum("n").over(Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)).alias("off"),
    )
    # one row per partition: bounded by the partition count, safe to broadcast
    placed = tagged.join(F.broadcast(offsets), F.col("pid") == F.col("part"), "left")
    kept = [F.col(f"row.`{c}`") for c in df.columns if c != out]
    return placed.select(*kept, (F.coalesce(F.col("off"), F.lit(0)) + index + 1).cast("long").alias(out))
