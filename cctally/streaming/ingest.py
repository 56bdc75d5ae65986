"""Incremental folder ingestion.

The reference re-reads whole export folders on a clock.  The Spark-native
equivalent of that re-run is a file-stream with ``trigger(availableNow=True)``:
each run processes only the files that landed since the last run (the
stream's checkpoint remembers them), applies the stateless per-row stage of a
job, and appends to a table.  Stateful steps that need all rows (keep-first
dedup, counts) stay in the batch job that reads the appended table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ensure_checkpoint_dir
from ..sources.readers import FILE_COL, NA_TOKENS, file_name_col


#: Triggers of one run whose row counts are kept (a few hundred bytes each).
PROGRESS_KEPT = 1_000_000


def ingest_new_files(spark: SparkSession, landing: str, columns: Sequence[str], out: str, *,
                     sep: str = ";", encoding: str = "UTF-8", pattern: str = "*.csv",
                     transform: Callable[[DataFrame], DataFrame] | None = None,
                     checkpoint: str | None = None, max_files_per_trigger: int | None = None) -> dict:
    """Append the newly landed files of ``landing`` to the Parquet table ``out``.

    ``columns`` is the declared header (all strings; a streaming source needs
    a fixed schema).  ``transform`` is the stateless per-row stage (for
    example :func:`cctally.plans.jobs.normalise_interactions`).  The stream's
    checkpoint defaults to a folder below ``spark.checkpoint.dir``.  Returns
    the number of input rows processed by this run.
    """
    schema = StructType([StructField(c, StringType()) for c in columns])
    reader = (spark.readStream.schema(schema).option("header", True).option("sep", sep)
              .option("encoding", encoding).option("pathGlobFilter", pattern)
              # a header in another order fails the run instead of being read by position
              .option("escape", '"').option("enforceSchema", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(landing).select(
        *[F.when(~F.col(f"`{c}`").isin(list(NA_TOKENS)), F.col(f"`{c}`")).alias(c) for c in columns],
        file_name_col().alias(FILE_COL))
    if transform is not None:
        stream = transform(stream)
    # a stable name per (landing, output) pair, so every run resumes the same stream
    digest = hashlib.sha1(f"{landing}\n{out}".encode()).hexdigest()[:16]
    # below the configured folder itself: what Spark appends to it changes with every application
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or ensure_checkpoint_dir(spark)
    ckpt = checkpoint or f"{shared.rstrip('/')}/streams/{digest}"
    retention = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(retention)
    spark.conf.set(retention, str(PROGRESS_KEPT))  # the default forgets all but the last hundred triggers
    query = (stream.writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
    spark.conf.set(retention, before)
    query.awaitTermination()
    rows = sum(int(p.get("numInputRows", 0)) for p in query.recentProgress)
    return {"rows": rows, "checkpoint": ckpt}
