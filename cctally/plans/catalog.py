"""Query catalogue for the driver contract.

Each entry reads the driver's test tables, builds the raw (dirty) input the
operator expects with a stand-in SQL text (identical for Spark and DuckDB,
see ``sqlkit``), runs the library's operator on Spark, and has an
independent DuckDB SQL oracle over the same tables.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import rules as R
from ..functions import text as T
from ..operators import counts as A
from ..operators.dedup import keep_first, number_in_order
from ..operators.lookup import fallback_lookup, lookup, map_with_table
from ..operators.project import union_all_by_name
from . import rules_config as C
from .sqlkit import (duck_blank, duck_collapse, duck_disposition, duck_numeric_id, duck_phone,
                     duck_strip, duck_strip_literals, duck_title, fmt)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "1997-03-15"          # fixed run date of the date-window queries
EVENTS_AS_OF = "2024-01-16"   # fixed run date inside the events month


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


_REGISTERED: dict[tuple[int, str], str] = {}


def views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    """Register the test tables as temporary views (lazy parquet scans);
    a view already registered for the same path in this session is kept."""
    from ..sources.readers import read_table
    sid = id(spark._jsparkSession)
    for n in names:
        path = os.path.join(sf_dir, f"{n}.parquet")
        if _REGISTERED.get((sid, n)) == path and spark.catalog.tableExists(n):
            continue
        read_table(spark, path).createOrReplaceTempView(n)
        _REGISTERED[(sid, n)] = path


def standin(spark: SparkSession, sf_dir: str, tables, sql_fn) -> DataFrame:
    views(spark, sf_dir, *tables)
    return spark.sql(sql_fn("spark"))


def cte(sql_fn, name: str = "src") -> str:
    return f"WITH {name} AS ({sql_fn('duckdb')})\n"


# =============================================================================
# X: string functions
# =============================================================================

def _users(d):
    return """SELECT c_custkey,
      CASE c_custkey % 6
        WHEN 0 THEN NULL
        WHEN 1 THEN '   '
        WHEN 2 THEN 'ivr_out_' || lower(c_name) || '_v2; extra ' || c_mktsegment
        WHEN 3 THEN 'out_' || c_name
        WHEN 4 THEN c_name || '_x;y_z'
        ELSE '  ' || replace(c_name, '#', '  ') || ' '
      END AS user_text
    FROM customer"""


def _duck_agent_a(u):
    head = f"split_part({u}, ';', 1)"
    return (f"CASE WHEN {duck_blank(u)} THEN '' ELSE {duck_strip(f'CASE WHEN len(string_split({head}, {chr(39)}_{chr(39)})) >= 2 THEN string_split({head}, {chr(39)}_{chr(39)})[-2] ELSE {head} END')} END")


def _duck_agent_b(u):
    head = f"split_part({u}, ';', 1)"
    inner = f"CASE WHEN len(string_split({head}, '_')) >= 3 THEN string_split({head}, '_')[3] ELSE {head} END"
    return f"CASE WHEN {duck_blank(u)} THEN 'Discador' ELSE {duck_title(duck_strip(inner))} END"


@register("agent_name_a", cte(_users) + f"SELECT c_custkey, {_duck_agent_a('user_text')} AS agent FROM src")
def q_agent_name_a(spark, sf_dir):
    """Second-last ``_`` part before ``;``; blank -> empty text."""
    df = standin(spark, sf_dir, ["customer"], _users)
    return df.select("c_custkey", T.agent_name_accumulated("user_text").alias("agent"))


@register("agent_name_b", cte(_users) + f"SELECT c_custkey, {_duck_agent_b('user_text')} AS agent FROM src")
def q_agent_name_b(spark, sf_dir):
    """Third part if there are three, title-cased; blank -> dialler."""
    df = standin(spark, sf_dir, ["customer"], _users)
    return df.select("c_custkey", T.agent_name_consolidated("user_text").alias("agent"))


def _conclusions(d):
    return """SELECT event_id,
      CASE event_id % 7
        WHEN 0 THEN NULL
        WHEN 1 THEN '  '
        WHEN 2 THEN 'ININ-OUTBOUND-CAMPAIGN-FORCED-OFF; C' || CAST(user_id AS STRING) || '; ' || upper(event_type) || ' - SOP'
        WHEN 3 THEN 'ININ-WRAPUP;  ' || upper(event_type) || '  '
        WHEN 4 THEN upper(event_type)
        WHEN 5 THEN 'C1;' || event_type || ';x; y'
        ELSE 'ININ-OUTBOUND-TRANSFERRED-TO-QUEUE; ' || event_type || ' ; label ' || CAST(user_id AS STRING)
      END AS conclusion
    FROM events"""


@register("disposition", cte(_conclusions) + f"""
SELECT event_id, cleaned, {duck_disposition('cleaned')} AS disposition
FROM (SELECT event_id, {duck_strip_literals('conclusion', C.CONCLUSION_LITERALS)} AS cleaned FROM src)""")
def q_disposition(spark, sf_dir):
    """X9 + X3 + N3: literal prefixes removed, second ``;`` part kept."""
    df = standin(spark, sf_dir, ["events"], _conclusions)
    cleaned = T.strip_literals("conclusion", C.CONCLUSION_LITERALS)
    return df.select("event_id", cleaned.alias("cleaned")).withColumn("disposition", T.disposition("cleaned"))


def _dirty_names(d):
    return """SELECT p_partkey,
      '  ' || replace(p_name, ' ',
          CASE p_partkey % 3 WHEN 0 THEN chr(160) || '  ' WHEN 1 THEN '   ' ELSE ' ' END)
      || '-' || lower(p_brand) || '''s x2b ' || upper(p_type) || chr(160) AS raw
    FROM part"""


@register("whitespace_title", cte(_dirty_names) + f"""
SELECT p_partkey, {duck_collapse('raw')} AS collapsed, {duck_strip('raw')} AS stripped,
       {duck_title(duck_collapse('raw'))} AS titled
FROM src""")
def q_whitespace_title(spark, sf_dir):
    """X8 collapse, X12 strip, X7/X17 collapse + Python-style title case
    (no-break spaces count as blanks, Q24)."""
    df = standin(spark, sf_dir, ["part"], _dirty_names)
    return df.select("p_partkey", T.collapse_ws("raw").alias("collapsed"), T.py_strip("raw").alias("stripped"),
                     T.collapse_title("raw").alias("titled"))


@register("document_whitespace", f"""
SELECT doc_id, {duck_collapse('text')} AS collapsed, length({duck_collapse('text')}) AS n
FROM documents""")
def q_document_whitespace(spark, sf_dir):
    """X8 over whole documents (every line break and blank run -> one blank)."""
    views(spark, sf_dir, "documents")
    c = T.collapse_ws("text")
    return spark.table("documents").select("doc_id", c.alias("collapsed"), F.length(c).cast("bigint").alias("n"))


def _phones(d):
    return """SELECT c_custkey,
      CASE c_custkey % 5
        WHEN 0 THEN NULL
        WHEN 1 THEN '  '
        WHEN 2 THEN ' 569' || lpad(CAST(c_custkey AS STRING), 8, '0') || ' '
        WHEN 3 THEN CAST(c_custkey AS STRING)
        ELSE '+56 9' || lpad(CAST(c_custkey AS STRING), 8, '0')
      END AS raw
    FROM customer"""


@register("phone_suffix", cte(_phones) + f"""
SELECT c_custkey, {duck_phone('raw', True)} AS phone_trimmed, {duck_phone('raw', False)} AS phone_raw,
       coalesce(substr(raw, 1, 5), '00:00') AS first5
FROM src""")
def q_phone_suffix(spark, sf_dir):
    """Last 9 characters (trimmed first or not), blank -> null; X19 slice."""
    df = standin(spark, sf_dir, ["customer"], _phones)
    return df.select("c_custkey", T.phone_suffix("raw", 9, True).alias("phone_trimmed"),
                     T.phone_suffix("raw", 9, False).alias("phone_raw"),
                     T.hhmm("raw", "prefix").alias("first5"))


def _call_names(d):
    return """SELECT s_suppkey,
      CASE s_suppkey % 3
        WHEN 0 THEN 'Last' || CAST(s_suppkey AS STRING) || ', First ' || CAST(s_nationkey AS STRING)
        WHEN 1 THEN ' ' || s_name || ' '
        ELSE ' A , B, C' || CAST(s_suppkey AS STRING)
      END AS raw
    FROM supplier"""


@register("name_swap", cte(_call_names) + f"""
SELECT s_suppkey,
  CASE WHEN strpos(raw, ',') > 0
       THEN {duck_strip("substr(raw, strpos(raw, ',') + 1)")} || ' ' || {duck_strip("split_part(raw, ',', 1)")}
       ELSE {duck_strip('raw')} END AS name
FROM src""")
def q_name_swap(spark, sf_dir):
    """X11: ``Last, First`` -> ``First Last``."""
    df = standin(spark, sf_dir, ["supplier"], _call_names)
    return df.select("s_suppkey", T.name_swap("raw").alias("name"))


NAME_FIXES = {"NATION_1": "NATION_2", "NATION_2": "NATION_1", "NATION_3": "Nation Three"}


@register("value_replacement", """
SELECT n_nationkey,
  CASE n_name WHEN 'NATION_1' THEN 'NATION_2' WHEN 'NATION_2' THEN 'NATION_1'
              WHEN 'NATION_3' THEN 'Nation Three' ELSE n_name END AS by_map,
  CASE n_name WHEN 'NATION_1' THEN 'NATION_2' WHEN 'NATION_2' THEN 'NATION_1'
              WHEN 'NATION_3' THEN 'Nation Three' ELSE n_name END AS by_table
FROM nation""")
def q_value_replacement(spark, sf_dir):
    """Whole-value replacement in one pass (a swap proves no chaining),
    as an inline map and as a broadcast mapping table."""
    views(spark, sf_dir, "nation")
    df = spark.table("nation").select("n_nationkey", "n_name")
    mapping = spark.createDataFrame(list(NAME_FIXES.items()), "from string, to string")
    df = df.withColumn("by_map", T.replace_values("n_name", NAME_FIXES))
    df = map_with_table(df, "n_name", mapping, out="by_table")
    return df.select("n_nationkey", "by_map", "by_table")


def _mojibake(d):
    return """SELECT s_suppkey,
      CASE s_suppkey % 5
        WHEN 0 THEN 'Mu' || chr(195) || chr(177) || 'oz ' || s_name
        WHEN 1 THEN 'Jos' || chr(195) || chr(169) || ' Ram' || chr(195) || chr(173) || 'rez'
        WHEN 2 THEN 'Andr' || chr(195) || chr(163) || 'S ' || chr(194) || chr(148) || CAST(s_suppkey AS STRING)
        WHEN 3 THEN 'Pe' || chr(195) || chr(163) || 'N ' || chr(195) || chr(145) || 'u ' || chr(194) || chr(176)
        ELSE s_name
      END AS raw,
      'Naci' || chr(195) || chr(179) || 'n ' || CAST(s_nationkey AS STRING) AS raw2
    FROM supplier"""


_ASCII_ORDER = [("\xc3\xa3N", "n"), ("\xc3\xa3S", "es"), ("\xc2\x94", ""), ("\xc3\x91", "N"),
                ("\xc3\xa1", "a"), ("\xc3\xa3", "a"), ("\xc3\xa9", "e"), ("\xc3\xad", "i"),
                ("\xc3\xb1", "n"), ("\xc3\xb3", "o"), ("\xc3\xba", "u")]
_ACCENT_ORDER = [("\xc2\x94", ""), ("\xc2\xb0", "°"), ("\xc3\x91", "Ñ"), ("\xc3\xa1", "á"),
                 ("\xc3\xa9", "é"), ("\xc3\xad", "í"), ("\xc3\xb1", "ñ"), ("\xc3\xb3", "ó"), ("\xc3\xba", "ú")]


def _duck_replace_chain(x, pairs):
    out = x
    for a, b in pairs:
        out = f"replace({out}, '{a}', '{b}')"
    return out


@register("text_repair_ascii", cte(_mojibake) + f"""
SELECT s_suppkey, {_duck_replace_chain('raw', _ASCII_ORDER)} AS repaired FROM src""")
def q_text_repair_ascii(spark, sf_dir):
    """Damaged letters -> ASCII, longest damaged form first."""
    df = standin(spark, sf_dir, ["supplier"], _mojibake)
    return df.select("s_suppkey", T.repair_text("raw", C.REPAIR_TO_ASCII).alias("repaired"))


@register("text_repair_all_columns", cte(_mojibake) + f"""
SELECT s_suppkey, {_duck_replace_chain('raw', _ACCENT_ORDER)} AS raw,
       {_duck_replace_chain('raw2', _ACCENT_ORDER)} AS raw2 FROM src""")
def q_text_repair_all_columns(spark, sf_dir):
    """The accent repair applied to every string column in one select."""
    df = standin(spark, sf_dir, ["supplier"], _mojibake)
    return df.select("s_suppkey", *[T.repair_text(f.name, C.REPAIR_TO_ACCENTS).alias(f.name)
                                    for f in df.schema.fields if f.dataType.simpleString() == "string"])


def _ids(d):
    return """SELECT o_orderkey,
      CASE o_orderkey % 6
        WHEN 0 THEN lpad(CAST(o_custkey AS STRING), 8, '0')
        WHEN 1 THEN CAST(o_custkey AS STRING) || '.0'
        WHEN 2 THEN 'x' || CAST(o_custkey AS STRING)
        WHEN 3 THEN NULL
        WHEN 4 THEN CAST(o_custkey AS STRING) || '.5'
        ELSE ' ' || CAST(o_custkey AS STRING) || ' '
      END AS raw
    FROM orders"""


@register("numeric_id_text", cte(_ids) + f"SELECT o_orderkey, {duck_numeric_id('raw')} AS id_text FROM src")
def q_numeric_id_text(spark, sf_dir):
    """Canonical integer text; text and fractions -> null."""
    df = standin(spark, sf_dir, ["orders"], _ids)
    return df.select("o_orderkey", T.numeric_id_text("raw").alias("id_text"))


def _na(d):
    return """SELECT n_nationkey,
      CASE n_nationkey % 5 WHEN 0 THEN 'NA' WHEN 1 THEN 'null' WHEN 2 THEN '-' WHEN 3 THEN '' ELSE n_name END AS raw,
      CASE n_nationkey % 3 WHEN 0 THEN CAST(n_nationkey AS STRING) WHEN 1 THEN 'x' ELSE '12.5' END AS num
    FROM nation"""


@register("na_tokens", cte(_na) + """
SELECT n_nationkey,
  CASE WHEN raw IN ('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN',
                    '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null') THEN NULL ELSE raw END AS cleaned,
  CASE WHEN regexp_matches(num, '^[+-]?[0-9]+$') THEN CAST(TRY_CAST(num AS INTEGER) AS VARCHAR) END AS as_int
FROM src""")
def q_na_tokens(spark, sf_dir):
    """NA tokens -> null (``-`` is kept); N4: coercing parse."""
    df = standin(spark, sf_dir, ["nation"], _na)
    return df.select("n_nationkey", T.na_to_null("raw").alias("cleaned"),
                     F.col("num").try_cast("int").cast("string").alias("as_int"))


# =============================================================================
# T: dates
# =============================================================================

def _datetimes(d):
    dmy = fmt(d, "o_orderdate", "dd/MM/yyyy")
    hh = "lpad(CAST(o_orderkey % 24 AS STRING), 2, '0')"
    mm = "lpad(CAST(o_orderkey % 60 AS STRING), 2, '0')"
    return f"""SELECT o_orderkey,
      CASE o_orderkey % 6
        WHEN 0 THEN {dmy}
        WHEN 1 THEN {dmy} || ' ' || {hh} || ':' || {mm}
        WHEN 2 THEN {dmy} || ' ' || CAST(o_orderkey % 10 AS STRING) || ':' || {mm}
        WHEN 3 THEN {dmy} || ' ' || {hh} || ':' || {mm} || ':30'
        WHEN 4 THEN {dmy} || ' 25:00'
        ELSE NULL
      END AS date_text
    FROM orders"""


@register("datetime_split", cte(_datetimes) + """
SELECT o_orderkey, date_part, coalesce(substr(time_part, 1, 5), '00:00') AS time_prefix,
       coalesce(strftime(try_strptime(time_part, '%H:%M'), '%H:%M'), '00:00') AS time_strict
FROM (SELECT o_orderkey, split_part(date_text, ' ', 1) AS date_part,
             CASE WHEN strpos(date_text, ' ') > 0 THEN substr(date_text, strpos(date_text, ' ') + 1) END AS time_part
      FROM src)""")
def q_datetime_split(spark, sf_dir):
    """X15 + X19 + T2/Q13: date/time split, prefix and strict ``HH:mm``."""
    df = standin(spark, sf_dir, ["orders"], _datetimes)
    t = T.after_first("date_text")
    return df.select("o_orderkey", T.first_token("date_text").alias("date_part"),
                     T.hhmm(t, "prefix").alias("time_prefix"), T.hhmm(t, "strict").alias("time_strict"))


def _ymd(d):
    ymd = fmt(d, "o_orderdate", "yyyyMMdd")
    return f"""SELECT o_orderkey,
      CASE o_orderkey % 4
        WHEN 0 THEN {ymd}
        WHEN 1 THEN substr({ymd}, 1, 4) || '13' || substr({ymd}, 7, 2)
        WHEN 2 THEN NULL
        ELSE 'x' || {ymd}
      END AS raw
    FROM orders"""


@register("ymd_reformat", cte(_ymd) + """
SELECT o_orderkey, strftime(try_strptime(raw, '%Y%m%d'), '%d/%m/%Y') AS base_date FROM src""")
def q_ymd_reformat(spark, sf_dir):
    """``yyyyMMdd`` -> ``dd/MM/yyyy``; invalid -> null."""
    df = standin(spark, sf_dir, ["orders"], _ymd)
    return df.select("o_orderkey", D.ymd_to_dmy("raw").alias("base_date"))


@register("timestamp_texts", """
SELECT event_id, strftime(ts, '%d/%m/%Y %H:%M') AS stamp, strftime(ts, '%d/%m/%Y') AS day,
       strftime(ts, '%H:%M') AS clock
FROM events""")
def q_timestamp_texts(spark, sf_dir):
    """Display texts of a timestamp."""
    views(spark, sf_dir, "events")
    t = D.display_texts("ts")
    return spark.table("events").select("event_id", t["stamp"].alias("stamp"), t["date"].alias("day"),
                                        t["time"].alias("clock"))


def _dmy_text(d):
    return f"""SELECT o_orderkey,
      CASE WHEN o_orderkey % 9 = 0 THEN '31/02/' || {fmt(d, 'o_orderdate', 'yyyyMMdd')}
           ELSE {fmt(d, 'o_orderdate', 'd/M/yyyy')} END AS date_text
    FROM orders"""


@register("date_window", cte(_dmy_text) + f"""
SELECT o_orderkey, date_text, strftime(d, '%Y-%m-%d') AS day
FROM (SELECT *, CAST(try_strptime(date_text, '%d/%m/%Y') AS DATE) AS d FROM src)
WHERE d BETWEEN CAST(date_trunc('month', DATE '{AS_OF}') - INTERVAL 10 DAY AS DATE) AND last_day(DATE '{AS_OF}')""")
def q_date_window(spark, sf_dir):
    """T3 + T4 + F4: day-first parse, month window of ``as_of`` minus 10 days."""
    df = standin(spark, sf_dir, ["orders"], _dmy_text)
    d = D.parse_day_first("date_text")
    return (df.where(D.in_month_window(d, AS_OF))
              .select("o_orderkey", "date_text", F.date_format(d, "yyyy-MM-dd").alias("day")))


def _dated_rows(d):
    return f"""SELECT o_orderkey, {fmt(d, 'o_orderdate', 'dd/MM/yyyy')} AS base_date,
      o_orderkey % 10 <> 0 AS has_base_date
    FROM orders"""


@register("date_contains_bypass", cte(_dated_rows) + f"""
SELECT o_orderkey FROM src
WHERE NOT has_base_date OR contains(base_date, strftime(DATE '{AS_OF}', '%d/%m/%Y'))""")
def q_date_contains_bypass(spark, sf_dir):
    """rows whose date text contains the run date; rows of sources
    without the date column all pass."""
    df = standin(spark, sf_dir, ["orders"], _dated_rows)
    today = F.date_format(D.as_date(AS_OF), "dd/MM/yyyy")
    return df.where(~F.col("has_base_date") | R.contains_text("base_date", today)).select("o_orderkey")


def _tenure(d):
    return f"""SELECT o_orderkey,
      CASE o_orderkey % 3
        WHEN 0 THEN {fmt(d, 'o_orderdate', 'yyyy-MM-dd')}
        WHEN 1 THEN {fmt(d, 'o_orderdate', 'yyyy-MM-dd')} || ' 10:30:00'
        ELSE {fmt(d, 'o_orderdate', 'd/M/yyyy')}
      END AS start_text
    FROM orders"""


@register("tenure_band", cte(_tenure) + f"""
SELECT o_orderkey, CAST(days AS VARCHAR) AS days,
  CASE WHEN days IS NULL THEN 'No aplica' WHEN days > 36 THEN 'Vigente' WHEN days > 6 THEN 'Prematuro' ELSE 'OJT' END AS tenure
FROM (SELECT o_orderkey, CAST(floor(date_diff('second', s, TIMESTAMP '{AS_OF} 00:00:00') / 86400) AS INTEGER) AS days
      FROM (SELECT o_orderkey, coalesce(try_strptime(start_text, '%Y-%m-%d %H:%M:%S'), try_strptime(start_text, '%Y-%m-%d'),
                                        try_strptime(start_text, '%d/%m/%Y')) AS s FROM src))""")
def q_tenure_band(spark, sf_dir):
    """T5 + C6: floored whole days to ``as_of``, banded > 36 / > 6 / else."""
    df = standin(spark, sf_dir, ["orders"], _tenure)
    days = D.whole_days(D.parse_timestamp("start_text"), AS_OF)
    return df.select("o_orderkey", days.cast("string").alias("days"), R.tenure_band(days).alias("tenure"))


# =============================================================================
# F / C: filters and classification
# =============================================================================

@register("filter_include", """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def q_filter_include(spark, sf_dir):
    """keep listed values."""
    views(spark, sf_dir, "customer")
    return spark.table("customer").where(R.is_in("c_mktsegment", ["BUILDING", "MACHINERY"])) \
        .select("c_custkey", "c_mktsegment")


def _segments(d):
    return """SELECT o_orderkey,
      CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE '  ' || lower(o_orderpriority) || chr(160) END AS segment
    FROM orders"""


@register("filter_exclude_nullsafe", cte(_segments) + f"""
SELECT o_orderkey, upper({duck_strip('segment')}) AS segment_norm FROM src
WHERE coalesce(upper({duck_strip('segment')}) NOT IN ('1-URGENT', '5-LOW'), TRUE)""")
def q_filter_exclude_nullsafe(spark, sf_dir):
    """F2 + X13: exclusion after trim + upper; null rows kept (Q9)."""
    df = standin(spark, sf_dir, ["orders"], _segments)
    return df.where(R.not_in_upper("segment", ["1-urgent", "5-LOW"])) \
        .select("o_orderkey", T.upper_trim("segment").alias("segment_norm"))


DOC_PATTERN = "ouen|ENAUX|the end"


@register("regex_contains_ci", f"""
SELECT doc_id, lang FROM documents WHERE coalesce(regexp_matches(text, '(?i)(?:{DOC_PATTERN})'), FALSE)""")
def q_regex_contains_ci(spark, sf_dir):
    """case-insensitive alternation over whole documents; null -> out."""
    views(spark, sf_dir, "documents")
    return spark.table("documents").where(R.contains_ci("text", f"(?:{DOC_PATTERN})")).select("doc_id", "lang")


def _repeated_header(d):
    return """SELECT CASE WHEN n_nationkey % 5 = 0 THEN 'key' ELSE CAST(n_nationkey AS STRING) END AS key,
                     CASE WHEN n_nationkey % 5 = 0 THEN 'name' ELSE n_name END AS name,
                     n_nationkey AS ord
              FROM nation
              UNION ALL SELECT NULL, 'orphan ' || r_name, 100 + r_regionkey FROM region"""


@register("drop_repeated_header", cte(_repeated_header) + """
SELECT key, name FROM src WHERE key IS DISTINCT FROM 'key'""")
def q_drop_repeated_header(spark, sf_dir):
    """rows whose first column holds its own name are dropped; null kept."""
    df = standin(spark, sf_dir, ["nation", "region"], _repeated_header)
    return df.where(~F.col("key").eqNullSafe(F.lit("key"))).select("key", "name")


def _nullable_keys(d):
    return """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS key
              FROM orders"""


@register("dropna_key", cte(_nullable_keys) + "SELECT o_orderkey, key FROM src WHERE key IS NOT NULL")
def q_dropna_key(spark, sf_dir):
    """rows with a null key dropped."""
    return standin(spark, sf_dir, ["orders"], _nullable_keys).dropna(subset=["key"])


def _calls(d):
    return """SELECT event_id,
      CASE WHEN user_id % 4 = 0 THEN 'Discador' ELSE 'Agent ' || CAST(user_id AS STRING) END AS agent,
      CASE event_type WHEN 'click' THEN 'Entrante' WHEN 'view' THEN 'Saliente' WHEN 'error' THEN NULL
                      ELSE 'Interna' END AS direction
    FROM events"""


@register("call_type_mask", cte(_calls) + """
SELECT event_id, CASE WHEN agent <> 'Discador' AND direction IN ('Entrante', 'Saliente') THEN 'Manual'
                      ELSE 'Discador' END AS call_type FROM src""")
def q_call_type_mask(spark, sf_dir):
    """F8 + C5: manual when an agent (not the dialler) handled an in/out call."""
    df = standin(spark, sf_dir, ["events"], _calls)
    return df.select("event_id", R.call_type("agent", "direction").alias("call_type"))


QUEUE_MAP = {"1-URGENT": "Urgent base", "2-HIGH": "High base", "3-MEDIUM": "Medium base"}


@register("map_with_default", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent base' WHEN '2-HIGH' THEN 'High base'
                   WHEN '3-MEDIUM' THEN 'Medium base' ELSE '-' END AS base_cloud FROM orders""")
def q_map_with_default(spark, sf_dir):
    """Code -> label, ``-`` when unmapped."""
    views(spark, sf_dir, "orders")
    return spark.table("orders").select("o_orderkey", R.map_values("o_orderpriority", QUEUE_MAP, "-").alias("base_cloud"))


def _dispositions(d):
    return """SELECT o_orderkey,
      CASE o_orderkey % 7
        WHEN 0 THEN 'ACEPTA AGENDA - MIGRACION'
        WHEN 1 THEN 'CLIENTE INFACTIBLE'
        WHEN 2 THEN 'Error de ingreso'
        WHEN 3 THEN 'WRAP-UP-TIMEOUT'
        WHEN 4 THEN NULL
        WHEN 5 THEN 'NO ACEPTA MIGRACION'
        ELSE o_orderpriority
      END AS disposition
    FROM orders"""


def _duck_in(x, values):
    vals = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"CAST(coalesce({x} IN ({vals}), FALSE) AS INTEGER)"


@register("flags_and_labels", cte(_dispositions) + f"""
SELECT o_orderkey,
  {_duck_in('disposition', C.NOT_APPLICABLE)} AS not_applicable,
  {_duck_in('disposition', C.MIGRATION)} AS migration,
  CASE WHEN coalesce(disposition IN ({", ".join("'" + v + "'" for v in C.CONTACT)}), FALSE) THEN 'Contacto' ELSE 'No Contacto' END AS contact_label,
  {_duck_in('disposition', C.CONTACT)} AS contact,
  CAST(coalesce(disposition = 'Error de ingreso', FALSE) AS INTEGER) AS errors,
  CAST(coalesce(disposition = 'WRAP-UP-TIMEOUT', FALSE) AS INTEGER) AS untyped
FROM src""")
def q_flags_and_labels(spark, sf_dir):
    """C2 + C3 + C4: 0/1 flags (never null) and a two-way label."""
    df = standin(spark, sf_dir, ["orders"], _dispositions)
    return df.select(
        "o_orderkey",
        R.flag_in("disposition", C.NOT_APPLICABLE).alias("not_applicable"),
        R.flag_in("disposition", C.MIGRATION).alias("migration"),
        R.label_in("disposition", C.CONTACT, C.CONTACT_YES, C.CONTACT_NO).alias("contact_label"),
        R.flag_in("disposition", C.CONTACT).alias("contact"),
        R.flag_eq("disposition", C.ERROR_DISPOSITION).alias("errors"),
        R.flag_eq("disposition", C.UNTYPED_DISPOSITION).alias("untyped"),
    )


# =============================================================================
# J / D: lookups and keep-first dimensions
# =============================================================================

def _fact_keys(d):
    return """SELECT o_orderkey,
      CASE WHEN o_orderkey % 5 = 0 THEN ' ' || CAST(o_custkey AS STRING) || chr(160)
           ELSE CAST(o_custkey AS STRING) END AS key
    FROM orders"""


def _dup_dim(d):
    return """SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE '  ' || CAST(c_custkey AS STRING) END AS key,
             CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS segment,
             c_custkey AS ord
      FROM customer
      UNION ALL
      SELECT CAST(c_custkey AS STRING), 'DUP-' || c_mktsegment, c_custkey + 100000000 FROM customer"""


@register("lookup_left_first_wins", f"""
WITH f AS ({_fact_keys('duckdb')}), d AS ({_dup_dim('duckdb')}),
first AS (SELECT {duck_strip('key')} AS k, arg_min_null(segment, ord) AS segment FROM d
          WHERE key IS NOT NULL GROUP BY 1)
SELECT f.o_orderkey, first.segment FROM f LEFT JOIN first ON {duck_strip('f.key')} = first.k""")
def q_lookup_left_first_wins(spark, sf_dir):
    """J1 + J6 + D1 + F7: keys canonicalised on both sides, null keys dropped,
    the first dimension row per key wins (its null value included)."""
    fact = standin(spark, sf_dir, ["orders"], _fact_keys).withColumn("k", T.py_strip("key"))
    dim = standin(spark, sf_dir, ["customer"], _dup_dim).withColumn("k", T.py_strip("key"))
    return lookup(fact, dim, fact_key="k", dim_key="k", values=["segment"], order=["ord"]) \
        .select("o_orderkey", "segment")


def _fb_fact(d):
    return """SELECT o_orderkey,
      CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'C' || CAST(o_custkey AS STRING) END AS contact_id,
      lpad(CAST((o_custkey * 7) % 1500 AS STRING), 9, '0') AS phone
    FROM orders"""


def _fb_dim(d):
    return """SELECT CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'C' || CAST(c_custkey AS STRING) END AS contact_id,
             CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE lpad(CAST(c_custkey AS STRING), 9, '0') END AS phone_1,
             lpad(CAST((c_custkey * 11) % 1500 AS STRING), 9, '0') AS phone_2,
             CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS segment,
             c_custkey AS ord
      FROM customer
      UNION ALL
      SELECT 'C' || CAST(c_custkey AS STRING), NULL, NULL, 'LATE', c_custkey + 100000000 FROM customer"""


@register("fallback_lookup", f"""
WITH f AS ({_fb_fact('duckdb')}), d AS ({_fb_dim('duckdb')}),
b1 AS (SELECT contact_id AS k, arg_min_null(segment, ord) AS v FROM d WHERE contact_id IS NOT NULL GROUP BY 1),
b2 AS (SELECT phone_1 AS k, arg_min_null(segment, ord) AS v FROM d WHERE phone_1 IS NOT NULL GROUP BY 1),
b3 AS (SELECT phone_2 AS k, arg_min_null(segment, ord) AS v FROM d WHERE phone_2 IS NOT NULL GROUP BY 1)
SELECT f.o_orderkey, coalesce(b1.v, b2.v, b3.v, 'No Encontrado') AS bucket
FROM f LEFT JOIN b1 ON f.contact_id = b1.k LEFT JOIN b2 ON f.phone = b2.k LEFT JOIN b3 ON f.phone = b3.k""")
def q_fallback_lookup(spark, sf_dir):
    """J2 + N1: id, then phone in either phone column; first non-null
    segment, else the default."""
    fact = standin(spark, sf_dir, ["orders"], _fb_fact)
    dim = standin(spark, sf_dir, ["customer"], _fb_dim)
    out = fallback_lookup(fact, dim, keys=[("contact_id", "contact_id"), ("phone", "phone_1"), ("phone", "phone_2")],
                          value="segment", out="bucket", order=["ord"], default=C.NOT_FOUND)
    return out.select("o_orderkey", "bucket")


def _nation_dups(d):
    return """SELECT n_nationkey AS s_nationkey, n_name, n_nationkey AS ord FROM nation
              UNION ALL SELECT n_nationkey, 'DUP', n_nationkey + 100 FROM nation"""


@register("lookup_same_name", f"""
WITH d AS ({_nation_dups('duckdb')}),
first AS (SELECT s_nationkey, arg_min_null(n_name, ord) AS n_name FROM d GROUP BY 1)
SELECT s.s_suppkey, first.n_name FROM supplier s LEFT JOIN first USING (s_nationkey)""")
def q_lookup_same_name(spark, sf_dir):
    """Left lookup on a same-named key."""
    views(spark, sf_dir, "supplier")
    dim = standin(spark, sf_dir, ["nation"], _nation_dups)
    return lookup(spark.table("supplier"), dim, fact_key="s_nationkey", dim_key="s_nationkey",
                  values=["n_name"], order=["ord"]).select("s_suppkey", "n_name")


@register("today_in_zone", """
SELECT r_regionkey, CAST(now() AT TIME ZONE 'Pacific/Kiritimati' AS DATE) - CAST(now() AT TIME ZONE 'Pacific/Niue' AS DATE) AS days
FROM region""")
def q_today_in_zone(spark, sf_dir):
    """The current day in a zone; two zones 25 hours apart are one or two days apart."""
    views(spark, sf_dir, "region")
    return spark.table("region").select("r_regionkey", F.date_diff(
        D.today_in("Pacific/Kiritimati"), D.today_in("Pacific/Niue")).cast("long").alias("days"))


def _fanout_hot(d):
    return """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'HOT' WHEN o_orderkey % 3 = 1 THEN NULL
             ELSE CAST(o_custkey AS STRING) END AS k FROM orders"""


def _fanout_hot_right(d):
    return """SELECT CASE WHEN s_suppkey % 5 = 0 THEN 'HOT' ELSE CAST(s_suppkey % 50 AS STRING) END AS rk,
             s_suppkey AS v FROM supplier"""


@register("lookup_fanout_hot_both", f"""
WITH f AS ({_fanout_hot('duckdb')}), r AS ({_fanout_hot_right('duckdb')})
SELECT o_orderkey, k, count(*) AS n, count(v) AS matches, coalesce(sum(v), 0)::BIGINT AS total
FROM f LEFT JOIN r ON f.k = r.rk GROUP BY o_orderkey, k""")
def q_lookup_fanout_hot_both(spark, sf_dir):
    """J4 beyond the broadcast bound with a key that is hot on both sides:
    its rows are dealt over a grid of reducers, none copied to all."""
    f = standin(spark, sf_dir, ["orders"], _fanout_hot)
    r = standin(spark, sf_dir, ["supplier"], _fanout_hot_right)
    out = lookup(f, r, fact_key="k", dim_key="rk", values=["v"], dedupe=False, broadcast=False, hot=["HOT"], hot_right=["HOT"])
    return out.groupBy("o_orderkey", "k").agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("matches"),
                                              F.coalesce(F.sum("v"), F.lit(0)).cast("long").alias("total"))


@register("lookup_fanout", """
SELECT c.c_custkey, CAST(o.o_orderkey AS VARCHAR) AS o_orderkey
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey""")
def q_lookup_fanout(spark, sf_dir):
    """Left join keeping every match (right side not unique)."""
    views(spark, sf_dir, "customer", "orders")
    out = lookup(spark.table("customer"), spark.table("orders"), fact_key="c_custkey", dim_key="o_custkey",
                 values=["o_orderkey"], dedupe=False)
    return out.select("c_custkey", F.col("o_orderkey").cast("string").alias("o_orderkey"))


def _event_users(d):
    return """SELECT event_id,
      CASE WHEN event_id % 3 = 0 THEN ' Customer#' || lpad(CAST(user_id AS STRING), 9, '0') || chr(160)
           ELSE 'Customer#' || lpad(CAST(user_id AS STRING), 9, '0') END AS user_text
    FROM events"""


@register("lookup_derived_key", f"""
WITH f AS ({_event_users('duckdb')}),
first AS (SELECT c_name, arg_min_null(c_custkey, c_custkey) AS c_custkey FROM customer WHERE c_name IS NOT NULL GROUP BY 1)
SELECT f.event_id, CAST(first.c_custkey AS VARCHAR) AS c_custkey
FROM f LEFT JOIN first ON {duck_strip('f.user_text')} = first.c_name""")
def q_lookup_derived_key(spark, sf_dir):
    """Join on a key derived in the plan (stripped user text), then dropped."""
    fact = standin(spark, sf_dir, ["events"], _event_users).withColumn("__user", T.py_strip("user_text"))
    views(spark, sf_dir, "customer")
    out = lookup(fact, spark.table("customer"), fact_key="__user", dim_key="c_name", values=["c_custkey"],
                 order=["c_custkey"]).drop("__user")
    return out.select("event_id", F.col("c_custkey").cast("string").alias("c_custkey"))


def _half_null_fact(d):
    return """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS key
              FROM orders"""


def _half_null_dim(d):
    return """SELECT CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END AS key,
                     c_mktsegment AS segment, c_custkey AS ord FROM customer"""


@register("null_keys_never_match", f"""
WITH f AS ({_half_null_fact('duckdb')}), d AS ({_half_null_dim('duckdb')}),
first AS (SELECT key, arg_min_null(segment, ord) AS segment FROM d WHERE key IS NOT NULL GROUP BY 1)
SELECT f.o_orderkey, first.segment FROM f LEFT JOIN first ON f.key = first.key""")
def q_null_keys_never_match(spark, sf_dir):
    """Q1/Q2: null keys on either side never match (no text 'nan' keys)."""
    fact = standin(spark, sf_dir, ["orders"], _half_null_fact)
    dim = standin(spark, sf_dir, ["customer"], _half_null_dim)
    return lookup(fact, dim, fact_key="key", dim_key="key", values=["segment"], order=["ord"]) \
        .select("o_orderkey", "segment")


def _sites(d):
    return """SELECT n_nationkey AS s_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_name END AS site,
                     n_nationkey AS ord FROM nation"""


@register("absent_dimension_marker", f"""
WITH d AS ({_sites('duckdb')})
SELECT s.s_suppkey, 'Error de Cruce' AS quartile, 'Error de Cruce' AS shift, coalesce(d.site, 'Sin sede') AS site
FROM supplier s LEFT JOIN d USING (s_nationkey)""")
def q_absent_dimension_marker(spark, sf_dir):
    """J7 (absent dimension -> marker), J8 (missing key column -> marker),
    J9 (null attribute filled after the lookup)."""
    views(spark, sf_dir, "supplier")
    df = spark.table("supplier")
    df = lookup(df, None, fact_key="s_suppkey", dim_key="dni", values=["quartile"], marker=C.LOOKUP_FAILED)
    dim = standin(spark, sf_dir, ["nation"], _sites)
    df = lookup(df, dim, fact_key="dni", dim_key="s_nationkey", values=["shift"], marker=C.LOOKUP_FAILED)
    df = lookup(df, dim, fact_key="s_nationkey", dim_key="s_nationkey", values=["site"], order=["ord"],
                fill={"site": "Sin sede"})
    return df.select("s_suppkey", "quartile", "shift", "site")


# =============================================================================
# A / M: counts and metrics
# =============================================================================

def _count_files(d):
    return """SELECT event_id,
      CASE WHEN event_type = 'click' THEN 'confirm q001 base ' || CAST(user_id AS STRING) || '.csv'
           WHEN event_type = 'view' AND user_id % 2 = 0 THEN 'MAIN BASE Q001.csv'
           WHEN event_type = 'view' THEN 'MAIN BASE Q001 confirm.csv'
           WHEN event_type = 'error' THEN 'daily q003.csv'
           WHEN event_type = 'purchase' THEN 'Q004 list.csv'
           ELSE 'other.csv' END AS file_name
    FROM events"""


FILE_RULES = ((("CONFIRM", "Q001"), "confirm"), (("MAIN BASE Q001",), "main"), (("Q003",), "q3"), (("Q004",), "q4"))
BUCKETS = {"main_base": "main", "confirmations": "confirm", "base_q3": "q3", "base_q4": "q4"}


@register("bucket_counts", cte(_count_files) + """
SELECT CAST(count_if(label = 'main') AS BIGINT) AS main_base, CAST(count_if(label = 'confirm') AS BIGINT) AS confirmations,
       CAST(count_if(label = 'q3') AS BIGINT) AS base_q3, CAST(count_if(label = 'q4') AS BIGINT) AS base_q4,
       CAST(count(*) AS BIGINT) AS rows
FROM (SELECT CASE WHEN contains(u, 'CONFIRM') AND contains(u, 'Q001') THEN 'confirm'
                  WHEN contains(u, 'MAIN BASE Q001') THEN 'main' WHEN contains(u, 'Q003') THEN 'q3'
                  WHEN contains(u, 'Q004') THEN 'q4' END AS label
      FROM (SELECT upper(file_name) AS u FROM src))""")
def q_bucket_counts(spark, sf_dir):
    """A1 + A2 + F9: ordered file-name rules label each row; one wide row of
    counts (0 for empty buckets) in one scan."""
    df = standin(spark, sf_dir, ["events"], _count_files)
    labelled = df.withColumn("label", R.first_match(F.upper("file_name"), FILE_RULES))
    return A.bucket_counts(labelled, "label", BUCKETS, total="rows")


@register("per_file_counts", """
SELECT CAST(sum(n) AS BIGINT) AS records, CAST(count(*) AS BIGINT) AS files
FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)""")
def q_per_file_counts(spark, sf_dir):
    """A3: records per source file, then summed."""
    views(spark, sf_dir, "events")
    df = spark.table("events").withColumn("file", F.concat(F.lit("events_"), F.col("event_type"), F.lit(".rsl")))
    per_file = A.per_group_counts(df, "file")
    return per_file.agg(F.sum("rows").cast("long").alias("records"), F.count(F.lit(1)).alias("files"))


def _dedup_events(d):
    return f"""SELECT event_id, ts, event_type, {fmt(d, 'ts', 'HH')} || ':00' AS hour,
      CASE WHEN event_id % 9 = 0 THEN NULL ELSE ' ' || CAST(user_id AS STRING) END AS user_text
    FROM events"""


@register("dedup_composite_first", cte(_dedup_events) + f"""
SELECT event_id, hour, {duck_strip('user_text')} AS user_key, event_type,
       concat_ws(' | ', coalesce({duck_strip('hour')}, '∅'), coalesce({duck_strip('user_text')}, '∅'),
                 coalesce({duck_strip('event_type')}, '∅')) AS key_text
FROM src
QUALIFY row_number() OVER (PARTITION BY hour, {duck_strip('user_text')}, event_type
                           ORDER BY ts ASC NULLS LAST, event_id) = 1""")
def q_dedup_composite_first(spark, sf_dir):
    """D2 + X16 + O1: keep the first row (time, then id) of each
    (hour, user, type) key; null keys group together."""
    df = standin(spark, sf_dir, ["events"], _dedup_events).withColumn("user_key", T.py_strip("user_text"))
    out = keep_first(df, ["hour", "user_key", "event_type"],
                     [F.col("ts").asc_nulls_last(), F.col("event_id").asc()])
    return out.select("event_id", "hour", "user_key", "event_type",
                      T.composite_key(["hour", "user_text", "event_type"]).alias("key_text"))


@register("run_metrics", """
SELECT CAST(count(*) AS BIGINT) AS rows_read,
       CAST(count_if(l_returnflag = 'R') AS BIGINT) AS returned,
       CAST(count_if(l_discount >= 0.05) AS BIGINT) AS rows_kept,
       CAST(count(*) - count_if(l_discount >= 0.05) AS BIGINT) AS rows_dropped
FROM lineitem""")
def q_run_metrics(spark, sf_dir):
    """M1 + A4: observed counts before and after a filter, gathered while
    one action runs over the data (no extra pass), as a one-row table."""
    views(spark, sf_dir, "lineitem")
    src, before = A.observe_counts(spark.table("lineitem"), "read",
                                   {"returned": F.col("l_returnflag") == "R"})
    kept, after = A.observe_counts(src.where(F.col("l_discount") >= 0.05), "kept")
    kept.write.format("noop").mode("overwrite").save()
    b, a = before.get, after.get
    row = {"rows_read": int(b["rows"]), "returned": int(b["returned"]), "rows_kept": int(a["rows"]),
           "rows_dropped": A.removed_rows(b["rows"], a["rows"])}
    return A.metrics_frame(spark, [row]).select("rows_read", "returned", "rows_kept", "rows_dropped")


def _sort_keys(d):
    return "SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS k FROM customer"


@register("sort_nulls_last", cte(_sort_keys) + """
SELECT c_custkey, row_number() OVER (ORDER BY k ASC NULLS LAST, c_custkey) AS row_no FROM src""")
def q_sort_nulls_last(spark, sf_dir):
    """O1 + O2: ascending, nulls last, positions numbered without moving all
    rows to one task."""
    df = standin(spark, sf_dir, ["customer"], _sort_keys)
    return number_in_order(df, [F.col("k").asc_nulls_last(), F.col("c_custkey").asc()]).select("c_custkey", "row_no")


@register("union_by_name", """
SELECT r_regionkey AS key, r_name AS name, NULL AS parent FROM region
UNION ALL SELECT n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) FROM nation""")
def q_union_by_name(spark, sf_dir):
    """U1 + U2: union by column name, missing columns null."""
    views(spark, sf_dir, "region", "nation")
    a = spark.table("region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    b = spark.table("nation").select(F.col("n_regionkey").cast("string").alias("parent"),
                                     F.col("n_name").alias("name"), F.col("n_nationkey").alias("key"))
    return union_all_by_name([a, b]).select("key", "name", "parent")


# =============================================================================
# P: projection / schema
# =============================================================================

@register("project_fixed_order", """
SELECT 'Lines' AS base, l_orderkey, l_linenumber, CAST(1 AS INTEGER) AS handled, l_returnflag FROM lineitem""")
def q_project_fixed_order(spark, sf_dir):
    """P4 (present columns), P8 (drop if present), P9 (constants), P7 (order)."""
    from ..operators.project import drop_present, fixed_order, select_present, with_constants
    views(spark, sf_dir, "lineitem")
    df = select_present(spark.table("lineitem"),
                        ["l_orderkey", "l_linenumber", "no_such_column", "l_returnflag", "l_shipdate"])
    df = drop_present(df, ["l_shipdate", "also_missing"])
    df = with_constants(df, {"handled": 1, "base": "Lines"})
    return fixed_order(df, ["base", "l_orderkey", "l_linenumber", "handled", "l_returnflag"])


@register("header_repair", """
SELECT n_nationkey AS key, n_name AS nation_name, n_regionkey AS region_key FROM nation""")
def q_header_repair(spark, sf_dir):
    """P1/P2 (trim, quotes, byte-order mark, no-break space), P3 (repair map
    for damaged spellings), P6 (rename)."""
    from ..operators.project import normalize_headers
    from ..schemas import header_repairs, mojibake
    views(spark, sf_dir, "nation")
    dirty = ["  n_nationkey ", '﻿"Nombre\xa0 país"', mojibake("Región") + "\xa0"]
    df = spark.table("nation").select("n_nationkey", "n_name", "n_regionkey").toDF(*dirty)
    fixes = header_repairs({"n_nationkey": "key", "Nombre país": "name", "Región": "region_key"})
    return normalize_headers(df, deep=True, rename=fixes).withColumnRenamed("name", "nation_name")


# =============================================================================
# T8 month labels, X14 value after '='
# =============================================================================

@register("month_labels", """
SELECT o_orderkey, strftime(o_orderdate, '%m') || '. ' ||
  CASE month(o_orderdate) WHEN 1 THEN 'Enero' WHEN 2 THEN 'Febrero' WHEN 3 THEN 'Marzo' WHEN 4 THEN 'Abril'
    WHEN 5 THEN 'Mayo' WHEN 6 THEN 'Junio' WHEN 7 THEN 'Julio' WHEN 8 THEN 'Agosto' WHEN 9 THEN 'Septiembre'
    WHEN 10 THEN 'Octubre' WHEN 11 THEN 'Noviembre' ELSE 'Diciembre' END AS folder
FROM orders""")
def q_month_labels(spark, sf_dir):
    """``MM. Month`` folder label of each order date."""
    views(spark, sf_dir, "orders")
    return spark.table("orders").select("o_orderkey", D.month_label("o_orderdate").alias("folder"))


def _cells(d):
    return """SELECT p_partkey,
      CASE p_partkey % 3 WHEN 0 THEN 'NAME=' || p_name WHEN 1 THEN p_name
                         ELSE 'EXPR=size=' || CAST(p_size AS STRING) END AS cell
    FROM part"""


@register("after_equals", cte(_cells) + """
SELECT p_partkey, CASE WHEN strpos(cell, '=') > 0 THEN substr(cell, strpos(cell, '=') + 1) ELSE cell END AS value
FROM src""")
def q_after_equals(spark, sf_dir):
    """The text after the first ``=`` of a cell, the cell when it has none."""
    df = standin(spark, sf_dir, ["part"], _cells)
    return df.select("p_partkey", T.after_equals("cell").alias("value"))


@register("document_title", f"""
SELECT doc_id, {duck_title(duck_collapse('text'))} AS titled FROM documents""")
def q_document_title(spark, sf_dir):
    """X7/X17 over whole documents: blanks collapsed, Python-style title case."""
    views(spark, sf_dir, "documents")
    return spark.table("documents").select("doc_id", T.collapse_title("text").alias("titled"))
