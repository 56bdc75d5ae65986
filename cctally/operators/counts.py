"""Counts and run metrics: A1-A4, M1.

Every count is a global or grouped aggregate with map-side partial
aggregation; nothing is collected row by row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def count_rows(df: DataFrame, out: str = "rows") -> DataFrame:
    """A1: one row, one bigint."""
    return df.agg(F.count(F.lit(1)).alias(out))


def bucket_counts(df: DataFrame, label_col: str, buckets: Mapping[str, str],
                  total: str | None = None) -> DataFrame:
    """A2: one wide row ``{output column: rows whose label equals value}``;
    empty buckets give 0; ``total`` adds the row count (A1).  One scan, one
    partial aggregate."""
    aggs = [
        F.count_if(F.col(f"`{label_col}`") == F.lit(label)).cast("long").alias(name)
        for name, label in buckets.items()
    ]
    if total:
        aggs.append(F.count(F.lit(1)).alias(total))
    return df.agg(*aggs)


def per_group_counts(df: DataFrame, group_col: str, out: str = "rows") -> DataFrame:
    """A3 (first half): rows per group (e.g. per source file)."""
    return df.groupBy(F.col(f"`{group_col}`")).agg(F.count(F.lit(1)).alias(out))


def sum_of_counts(counts: DataFrame, col: str = "rows", out: str = "total") -> DataFrame:
    """A3 (second half): one row with the sum; 0 when there are no groups."""
    return counts.agg(F.coalesce(F.sum(col), F.lit(0)).cast("long").alias(out))


def observe_counts(df: DataFrame, name: str, predicates: Mapping[str, object] | None = None
                   ) -> tuple[DataFrame, Observation]:
    """M1: attach an Observation counting rows (and rows per predicate) as the
    data flows through the next action; no extra job."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    for k, p in (predicates or {}).items():
        metrics.append(F.count_if(p).alias(k))
    return df.observe(obs, *metrics), obs


def removed_rows(before: int, after: int) -> int:
    """A4: rows removed by a step, from two observed counts."""
    return int(before) - int(after)


def metrics_frame(spark, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """M1: a run-metrics table (one row per observed step)."""
    return spark.createDataFrame([dict(r) for r in rows])
