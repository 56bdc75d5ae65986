"""String functions: X1-X19, N1-N4.

Every helper returns a native Spark expression, so whole-stage codegen keeps
it JVM-side; no Python UDF is involved.  Python text semantics that Spark
lacks (``str.title``, Unicode ``strip``) are rebuilt from built-ins.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Text that pandas' CSV reader turns into a missing value by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# White space as Python's ``str.strip()`` and ``re`` ``\s`` see it
# (``str.isspace``): tab to carriage return, the four information separators,
# blank, next line, no-break space, ogham space, en quad to hair space, line
# and paragraph separators, narrow no-break, medium mathematical and
# ideographic space.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_WS_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
             r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- blanks and nulls ---------------------------------------------------------

def py_strip(c) -> Column:
    """Python ``str.strip()``: removes Python white space at both ends
    (incl. U+00A0), with Spark's character-set trim (no regex)."""
    return F.trim(_c(c), F.lit(PY_WHITESPACE))


def collapse_ws(c) -> Column:
    """Every white-space run (incl. no-break space) -> one blank, trimmed."""
    return F.trim(F.regexp_replace(_c(c), _WS_CLASS + "+", " "))


def is_blank(c) -> Column:
    """Null, or only white space."""
    c = _c(c)
    return c.isNull() | (py_strip(c) == F.lit(""))


def nullif_blank(c) -> Column:
    """Blank text -> null, anything else unchanged."""
    c = _c(c)
    return F.when(~is_blank(c), c)


def na_to_null(c, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """NA tokens (as pandas reads them) -> null."""
    c = _c(c)
    return F.when(~c.isin(list(tokens)), c)


def fill(c, value) -> Column:
    """Null -> constant."""
    return F.coalesce(_c(c), F.lit(value))


# --- case -------------------------------------------------------------------

def title_case(c) -> Column:
    """Python ``str.title()``.

    Python starts a new word after any non-letter (digit, apostrophe,
    hyphen, blank); Spark's ``initcap`` lower-cases the text and title-cases
    the first letter after a blank.  So every non-letter other than a blank
    is first followed by a marker and a blank, ``initcap`` runs, and the
    markers are removed.  The marker is U+FFFF, a Unicode noncharacter that
    interchanged text does not contain.  Matches ``str.title()`` including
    title-case letters (``ǆ`` -> ``ǅ``) and ``ß`` (-> ``Ss``); everything
    stays in codegen.
    """
    marked = F.regexp_replace(_c(c), r"([^\p{L} ])", "$1\uffff ")
    return F.replace(F.initcap(marked), F.lit("\uffff "), F.lit(""))


def collapse_title(c) -> Column:
    """Collapse white space, trim, title-case."""
    return title_case(collapse_ws(c))


def upper_trim(c) -> Column:
    """``str.strip().upper()``."""
    return F.upper(py_strip(c))


# --- parts ------------------------------------------------------------------

def agent_name(c, *, part_index: int, missing: str | None, title: bool = False) -> Column:
    """Agent name from a platform user string ``a_b_Name_c; extra``.

    The text before the first ``;`` is split on ``_``.  ``part_index`` is
    1-based, or negative to count from the end; when the text has fewer parts
    than the index needs, the whole text is kept.  Blank input gives
    ``missing``.  The result is stripped and, with ``title``, title-cased.
    """
    c = _c(c)
    head = F.substring_index(c, ";", 1)
    parts = F.split(head, "_", -1)
    need = abs(part_index)
    picked = F.when(F.size(parts) >= need, F.try_element_at(parts, F.lit(part_index))).otherwise(head)
    out = py_strip(picked)
    if title:
        out = title_case(out)
    return F.when(is_blank(c), F.lit(missing)).otherwise(out)


def agent_name_accumulated(c) -> Column:
    """X1 preset: second-last part, blank -> empty text."""
    return agent_name(c, part_index=-2, missing="")


def agent_name_consolidated(c, missing: str = "Discador") -> Column:
    """X2 preset: third part, blank -> the dialler label, title-cased."""
    return agent_name(c, part_index=3, missing=missing, title=True)


def disposition(c) -> Column:
    """Second ``;`` part, stripped; the text itself when it has no ``;``;
    blank -> null."""
    c = _c(c)
    parts = F.split(c, ";", -1)
    return (
        F.when(is_blank(c), F.lit(None).cast("string"))
        .when(F.size(parts) >= 2, py_strip(F.try_element_at(parts, F.lit(2))))
        .otherwise(c)
    )


def strip_literals(c, literals: Iterable[str]) -> Column:
    """Remove each literal substring, in the given order."""
    out = _c(c)
    for lit in literals:
        out = F.replace(out, F.lit(lit), F.lit(""))
    return out


def repair_text(c, mapping: Mapping[str, str]) -> Column:
    """Literal substring replacements, longest key first (Q10)."""
    out = _c(c)
    for bad in sorted(mapping, key=lambda k: (-len(k), k)):
        out = F.replace(out, F.lit(bad), F.lit(mapping[bad]))
    return out


def replace_values(c, mapping: Mapping[str, str]) -> Column:
    """Whole-value replacement in one pass (a->b, b->a swaps, no chaining).

    For mappings that are data rather than code, use
    :func:`cctally.operators.lookup.map_with_table`.
    """
    c = _c(c)
    if not mapping:
        return c
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.coalesce(F.try_element_at(F.create_map(*kv), c), c)


def phone_suffix(c, n: int = 9, strip_first: bool = True) -> Column:
    """Last ``n`` characters; blank -> null."""
    c = _c(c)
    src = py_strip(c) if strip_first else c
    return F.when(~is_blank(c), F.right(src, F.lit(n)))


def name_swap(c) -> Column:
    """X11: ``Last, First`` -> ``First Last``; without a comma the stripped text."""
    c = _c(c)
    parts = F.split(c, ",", 2)
    return F.when(
        F.size(parts) == 2,
        F.concat(py_strip(F.element_at(parts, 2)), F.lit(" "), py_strip(F.element_at(parts, 1))),
    ).otherwise(py_strip(c))


def after_equals(c) -> Column:
    """Text after the first ``=``; the whole cell when there is none."""
    c = _c(c)
    pos = F.instr(c, "=")
    return F.when(pos > 0, F.substr(c, pos + F.lit(1))).otherwise(c)


def numeric_id_text(c) -> Column:
    """Canonical text of an integral numeric id.

    ``'00123'`` -> ``'123'``, ``'12.0'`` -> ``'12'``; text, fractions and
    blanks -> null (Q17: the reference raised on fractions; null never joins).
    """
    s = py_strip(_c(c))
    d = s.try_cast("decimal(38,6)")
    # a fraction too small for the decimal type is still a fraction
    return F.when((d == F.floor(d)) & ~s.rlike(r"\.[0-9]*[1-9][0-9]*$"), F.floor(d).cast("decimal(38,0)").cast("string"))


def first_token(c, sep: str = " ") -> Column:
    """X15 (date part): text before the first separator, the whole text if none."""
    return F.substring_index(_c(c), sep, 1)


def after_first(c, sep: str = " ") -> Column:
    """X15 (time part): text after the first separator; null when there is none."""
    c = _c(c)
    pos = F.instr(c, sep)
    return F.when(pos > 0, F.substr(c, pos + F.lit(len(sep))))


def hhmm(c, mode: str = "prefix", default: str = "00:00") -> Column:
    """Time of day as ``HH:mm`` text.

    ``prefix``: the first five characters (null -> ``default``).
    ``strict``: only ``H:M`` text parses (``10:15:30`` does not), re-rendered
    with two digits each; anything else -> ``default``.
    """
    c = _c(c)
    if mode == "prefix":
        return F.coalesce(F.substr(c, F.lit(1), F.lit(5)), F.lit(default))
    if mode != "strict":
        raise ValueError(f"unknown mode {mode!r}")
    pat = r"^([01]?[0-9]|2[0-3]):([0-5]?[0-9])$"
    ok = F.coalesce(c.rlike(pat), F.lit(False))
    return F.when(
        ok,
        F.concat(F.lpad(F.regexp_extract(c, pat, 1), 2, "0"), F.lit(":"),
                 F.lpad(F.regexp_extract(c, pat, 2), 2, "0")),
    ).otherwise(F.lit(default))


def composite_key(cols: Iterable, sep: str = " | ", null_text: str = "∅") -> Column:
    """One text key from several columns (stripped; null rendered)."""
    return F.concat_ws(sep, *[F.coalesce(py_strip(_c(x)), F.lit(null_text)) for x in cols])
