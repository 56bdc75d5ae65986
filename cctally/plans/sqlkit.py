"""SQL text shared by the query catalogue.

The stand-in inputs of the driver queries (dirty text built from the clean
test tables) are written once as SQL that both Spark and DuckDB run, so the
Spark job and the DuckDB oracle start from identical rows.  Only timestamp
formatting differs between the two dialects.  The ``duck_*`` helpers are the
oracle's own (independent) spelling of the operators.
"""

from __future__ import annotations

_STRF = {
    "dd/MM/yyyy": "%d/%m/%Y",
    "dd/MM/yyyy HH:mm": "%d/%m/%Y %H:%M",
    "yyyyMMdd": "%Y%m%d",
    "yyyy-MM-dd": "%Y-%m-%d",
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
    "HH:mm": "%H:%M",
    "d/M/yyyy": "%-d/%-m/%Y",
    "HH": "%H",
    "mm": "%M",
}


def fmt(dialect: str, col: str, pattern: str) -> str:
    """Timestamp -> text in either dialect (Java pattern given)."""
    if dialect == "spark":
        return f"date_format({col}, '{pattern}')"
    return f"strftime({col}, '{_STRF[pattern]}')"


# --- DuckDB spellings used by the oracles -------------------------------------------

def duck_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')"


def duck_collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[\s\x{{00A0}}]+', ' ', 'g'))"


def duck_title(x: str) -> str:
    # Python's title case maps a word-initial sharp s to "Ss" (its titlecase
    # mapping); DuckDB's upper() maps it to U+1E9E
    return (rf"array_to_string(list_transform(regexp_extract_all({x}, '(\p{{L}}+|\P{{L}}+)'), "
            r"lambda r: CASE WHEN r[1] = 'ß' THEN 'Ss' ELSE upper(r[1]) END || lower(r[2:])), '')")


def duck_blank(x: str) -> str:
    return f"({x} IS NULL OR {duck_strip(x)} = '')"


def duck_disposition(x: str) -> str:
    return (f"CASE WHEN {duck_blank(x)} THEN NULL "
            f"WHEN len(string_split({x}, ';')) >= 2 THEN {duck_strip(f'string_split({x}, {chr(39)};{chr(39)})[2]')} "
            f"ELSE {x} END")


def duck_strip_literals(x: str, literals) -> str:
    out = x
    for lit in literals:
        out = f"replace({out}, '{lit}', '')"
    return out


def duck_phone(x: str, strip_first: bool = True) -> str:
    src = duck_strip(x) if strip_first else x
    return f"CASE WHEN {duck_blank(x)} THEN NULL ELSE right({src}, 9) END"


def duck_numeric_id(x: str) -> str:
    d = f"TRY_CAST({duck_strip(x)} AS DECIMAL(38,6))"
    return f"CASE WHEN {d} = floor({d}) THEN CAST(CAST(floor({d}) AS DECIMAL(38,0)) AS VARCHAR) END"
