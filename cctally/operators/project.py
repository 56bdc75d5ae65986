"""Projection / schema operators: P1-P9, U1.

Header names are decided on the driver from the schema (names only, never
data); the data itself stays in the plan.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WS_RUN = re.compile(r"\s+")


def normalize_header(name: str, *, deep: bool = False) -> str:
    """P1 (``deep=False``): strip.  P2 (``deep=True``): drop double quotes and
    byte-order marks (decoded or as Latin-1 mojibake), no-break space -> blank,
    collapse white space, strip."""
    if name is None:
        return ""
    if deep:
        name = name.replace('"', "").replace("ï»¿", "").replace("﻿", "")
        name = name.replace("\xa0", " ")
        name = _WS_RUN.sub(" ", name)
    return name.strip()


def dedupe_names(names: Sequence[str]) -> list[str]:
    """Repeated header names get ``.1``, ``.2`` suffixes (as pandas does)."""
    seen: dict[str, int] = {}
    out = []
    for n in names:
        if n in seen:
            seen[n] += 1
            out.append(f"{n}.{seen[n]}")
        else:
            seen[n] = 0
            out.append(n)
    return out


def normalize_headers(df: DataFrame, *, deep: bool = False,
                      rename: Mapping[str, str] | None = None) -> DataFrame:
    """Clean every header, then apply the repair map."""
    rename = rename or {}
    names = [normalize_header(c, deep=deep) for c in df.columns]
    names = [rename.get(n, n) for n in names]
    return df.toDF(*dedupe_names(names))


def select_present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in have])


def fixed_order(df: DataFrame, cols: Sequence[str], *, fill_missing: bool = False) -> DataFrame:
    """Fixed output order; absent columns are skipped or null-filled."""
    have = set(df.columns)
    out = []
    for c in cols:
        if c in have:
            out.append(F.col(f"`{c}`"))
        elif fill_missing:
            out.append(F.lit(None).cast("string").alias(c))
    return df.select(*out)


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the listed columns that exist (unknown names are ignored)."""
    return df.drop(*list(names))


def with_constants(df: DataFrame, consts: Mapping[str, object]) -> DataFrame:
    """Constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in consts.items()})


def union_all_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union-all by column name, gaps null-filled."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
