"""Sinks: K1-K5.

Outputs are replaced as a whole (``mode('overwrite')``, K5); Spark creates
the target folder.  Spark writes no byte-order mark: a documented difference
from the ``utf-8-sig`` spreadsheets of the reference (K1).
"""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_delimited(df: DataFrame, path: str, *, sep: str = ";", header: bool = True,
                    encoding: str = "UTF-8", mode: str = "overwrite") -> str:
    """K1: delimited text with a header row."""
    (df.write.mode(mode).option("sep", sep).option("header", header)
       .option("encoding", encoding).option("escape", '"').csv(path))
    return path


def write_table(df: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None, **options) -> str:
    """K2: one table as a dataset folder."""
    w = df.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_tables(tables: Mapping[str, DataFrame | None], root: str, *, fmt: str = "parquet",
                 optional: set[str] | frozenset = frozenset(), **options) -> dict[str, str]:
    """K3/K4/K5: one dataset folder per named table under ``root``.

    Tables named in ``optional`` are skipped when empty (K4); ``None`` is
    always skipped.  Returns ``{name: 'written' | 'skipped'}``.
    """
    status = {}
    for name, df in tables.items():
        if df is None or (name in optional and df.isEmpty()):
            status[name] = "skipped"
            continue
        write_table(df, os.path.join(root, name), fmt=fmt, **options)
        status[name] = "written"
    return status
