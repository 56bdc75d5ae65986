"""Mapping / classification / predicate helpers.

C1-C6 and F1-F9 as native Column expressions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import py_strip


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag_in(c, values: Iterable[str]) -> Column:
    """1 when the value is in the list, else 0 (never null)."""
    return F.coalesce(_c(c).isin(list(values)), F.lit(False)).cast("int")


def flag_eq(c, value) -> Column:
    """1 when equal, else 0 (never null)."""
    return F.coalesce(_c(c) == F.lit(value), F.lit(False)).cast("int")


def label_in(c, values: Iterable[str], yes: str, no: str) -> Column:
    """C4: two-way label from a membership list (null -> ``no``)."""
    return F.when(F.coalesce(_c(c).isin(list(values)), F.lit(False)), F.lit(yes)).otherwise(F.lit(no))


def call_type(agent, direction, *, dialler: str = "Discador", manual: str = "Manual",
              manual_directions: Sequence[str] = ("Entrante", "Saliente")) -> Column:
    """``manual`` when the agent is not the dialler and the direction
    is one of ``manual_directions``; else ``dialler``."""
    cond = (_c(agent) != F.lit(dialler)) & _c(direction).isin(list(manual_directions))
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(manual)).otherwise(F.lit(dialler))


def map_values(c, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """Value map with a default for unmapped and null values."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    mapped = F.try_element_at(F.create_map(*kv), _c(c)) if kv else F.lit(None).cast("string")
    return F.coalesce(mapped, F.lit(default)) if default is not None else mapped


def band(c, bands: Sequence[tuple[int, str]], otherwise: str, null: str) -> Column:
    """``value > threshold`` ladder, checked in the given order."""
    c = _c(c)
    expr = F.when(c.isNull(), F.lit(null))
    for threshold, label in bands:
        expr = expr.when(c > F.lit(threshold), F.lit(label))
    return expr.otherwise(F.lit(otherwise))


TENURE_BANDS = ((36, "Vigente"), (6, "Prematuro"))


def tenure_band(days, bands=TENURE_BANDS, otherwise: str = "OJT", null: str = "No aplica") -> Column:
    """C6 preset: > 36 days, > 6 days, else, unknown."""
    return band(days, bands, otherwise, null)


def first_match(c, rules: Sequence[tuple[Sequence[str], str]], default: str | None = None) -> Column:
    """ordered rules ``(substrings that must all occur, label)``; the first
    rule that matches wins; no match -> ``default``."""
    c = _c(c)
    expr = None
    for needles, label in rules:
        cond = F.lit(True)
        for n in needles:
            cond = cond & F.coalesce(F.contains(c, F.lit(n)), F.lit(False))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


# --- predicates (F1-F7) -------------------------------------------------------

def is_in(c, values: Iterable[str]) -> Column:
    """keep rows whose value is in the list (null -> dropped)."""
    return F.coalesce(_c(c).isin(list(values)), F.lit(False))


def not_in_upper(c, values: Iterable[str]) -> Column:
    """keep rows whose trimmed upper-case value is not listed; null rows
    are kept (Q9)."""
    up = F.upper(py_strip(_c(c)))
    return ~F.coalesce(up.isin([v.upper() for v in values]), F.lit(False))


def contains_ci(c, pattern: str) -> Column:
    """case-insensitive regex search; null -> false."""
    return F.coalesce(_c(c).rlike(f"(?i){pattern}"), F.lit(False))


def contains_text(c, needle) -> Column:
    """substring test against a literal or Column; null -> false."""
    n = needle if isinstance(needle, Column) else F.lit(needle)
    return F.coalesce(F.contains(_c(c), n), F.lit(False))
