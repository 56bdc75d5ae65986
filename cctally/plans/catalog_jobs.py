"""Driver queries for the composite jobs.

Stand-in inputs are built from the test tables by SQL text shared with the
DuckDB oracle; the jobs themselves run through ``cctally.plans.jobs``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import jobs
from . import rules_config as C
from .catalog import AS_OF, EVENTS_AS_OF, FILE_RULES, BUCKETS, register, standin
from .rules_config import JobInputs
from .sqlkit import (duck_blank, duck_collapse, duck_disposition, duck_numeric_id, duck_strip,
                     duck_strip_literals, duck_title, fmt)

QUEUES = {"Q_1-URGENT": "Base Uno", "Q_2-HIGH": "Base Dos", "Q_3-MEDIUM": "Base Tres"}
NAME_FIXES = {"Customer 000000007": "Customer Seven"}
INPUTS = JobInputs(queue_map=QUEUES, name_fixes=NAME_FIXES, default_site="Sin sede",
                   excluded_campaigns=("PILOTO X", "SIGNUP"), campaign_names=("CAMP_A", "CAMP_B"),
                   file_rules=FILE_RULES, bucket_columns=BUCKETS)


def _id(d: str, name: str) -> str:
    """Quoted identifier in either dialect."""
    return f"`{name}`" if d == "spark" else f'"{name}"'


def _q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _duck_case_map(x: str, mapping: dict, default: str | None) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    other = f"ELSE {_q(default)}" if default is not None else f"ELSE {x}"
    return f"CASE {x} {whens} {other} END"


def _duck_in(x: str, values) -> str:
    return f"CAST(coalesce({x} IN ({', '.join(_q(v) for v in values)}), FALSE) AS INTEGER)"


def _cust_name(col: str) -> str:
    return f"'Customer#' || lpad(CAST({col} AS STRING), 9, '0')"


# =============================================================================
# shared stand-ins
# =============================================================================

def _interactions(d):
    dmy = fmt(d, "o_orderdate", "dd/MM/yyyy")
    hh = "lpad(CAST(8 + o_orderkey % 12 AS STRING), 2, '0')"
    mm = "lpad(CAST((o_custkey % 4) * 15 AS STRING), 2, '0')"
    name = f"lower(replace({_cust_name('o_custkey')}, '#', ' '))"
    return f"""SELECT
      CASE o_orderkey % 9
        WHEN 0 THEN NULL
        WHEN 1 THEN '  '
        WHEN 2 THEN 'ivr_out_' || replace({name}, 'e', chr(195) || chr(169)) || '_v2; grp ' || o_orderstatus
        ELSE 'ivr_out_' || {name} || '_v' || CAST(o_orderkey % 3 AS STRING) || '; grp ' || o_orderstatus
      END AS user,
      CASE o_orderkey % 8
        WHEN 0 THEN NULL
        WHEN 1 THEN {dmy}
        WHEN 2 THEN {dmy} || ' ' || CAST(o_orderkey % 10 AS STRING) || ':' || {mm}
        WHEN 3 THEN {dmy} || ' ' || {hh} || ':' || {mm} || ':30'
        ELSE {dmy} || ' ' || {hh} || ':' || {mm}
      END AS date_text,
      CAST(o_custkey AS STRING) AS phone_in,
      CASE o_orderstatus WHEN 'F' THEN 'Entrante' WHEN 'O' THEN 'Saliente' ELSE 'Interna' END AS direction,
      CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE '56' || lpad(CAST(o_custkey AS STRING), 9, '0') END AS dnis,
      'Q_' || o_orderpriority AS queue,
      CASE o_orderkey % 7
        WHEN 0 THEN 'ININ-OUTBOUND-CAMPAIGN-FORCED-OFF; C1; ACEPTA AGENDA - MIGRACION - SOP'
        WHEN 1 THEN 'C2; CLIENTE INFACTIBLE'
        WHEN 2 THEN 'C3;  Error de ingreso '
        WHEN 3 THEN 'ININ-WRAP-UP-TIMEOUT'
        WHEN 4 THEN NULL
        WHEN 5 THEN 'C9; acepta reingreso migracion'
        ELSE 'C0; VOLVER A LLAMAR'
      END AS conclusion,
      CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE ' K' || CAST(o_custkey AS STRING) END AS contact_id,
      'CAMP-' || o_orderstatus AS campaign,
      'calls_' || CAST(year(o_orderdate) AS STRING) || '.csv' AS source_file,
      o_orderkey AS _ord
    FROM orders"""


def _contact_list(d):
    return """SELECT CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'K' || CAST(c_custkey AS STRING) END AS contact_id,
             CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE lpad(CAST(c_custkey AS STRING), 9, '0') END AS phone_1,
             lpad(CAST((c_custkey * 7) % 1500 AS STRING), 9, '0') AS phone_2,
             CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS segment,
             c_custkey AS _ord
      FROM customer"""


def _staffing(d):
    return f"""SELECT CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE replace({_cust_name('c_custkey')}, '#', '  ') END AS full_name,
             'pu' || CAST(c_custkey AS STRING) AS platform_user,
             'A' || CAST(c_nationkey AS STRING) AS andes,
             'Sup ' || CAST(c_nationkey % 5 AS STRING) AS supervisor,
             CASE c_custkey % 4
               WHEN 0 THEN NULL
               WHEN 1 THEN '1997-02-0' || CAST(c_custkey % 9 + 1 AS STRING) || ' 10:30:00'
               WHEN 2 THEN 'sin fecha'
               ELSE '1996-1' || CAST(c_custkey % 3 AS STRING) || '-15'
             END AS start_date,
             CASE c_custkey % 5
               WHEN 0 THEN lpad(CAST(c_custkey AS STRING), 8, '0')
               WHEN 1 THEN CAST(c_custkey AS STRING) || '.0'
               WHEN 2 THEN ' ' || CAST(c_custkey AS STRING) || ' '
               ELSE CAST(c_custkey AS STRING)
             END AS dni,
             CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'Site ' || CAST(c_nationkey % 3 AS STRING) END AS site,
             c_custkey AS _ord
      FROM customer
      UNION ALL
      SELECT replace({_cust_name('c_custkey')}, '#', ' '), 'pu' || CAST(c_custkey AS STRING), 'A-late', 'Sup late',
             NULL, 'late', 'Site late', c_custkey + 100000000
      FROM customer"""


def _quartiles(d):
    return """SELECT CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(c_custkey AS STRING) END AS dni,
                     'Q' || CAST(c_custkey % 4 + 1 AS STRING) AS quartile, c_custkey AS _ord FROM customer
              UNION ALL SELECT CAST(c_custkey AS STRING), 'Q-late', c_custkey + 100000000 FROM customer"""


def _shifts(d):
    return """SELECT ' ' || CAST(c_custkey AS STRING) AS dni,
                     CASE c_nationkey % 3 WHEN 0 THEN 'Morning' WHEN 1 THEN 'Evening' ELSE NULL END AS shift,
                     c_custkey AS _ord FROM customer"""


def _duck_first(src: str, key: str, values: list[str]) -> str:
    """DuckDB first-wins: one row per non-null key, values of the min _ord row."""
    packed = ", ".join(f"'{v}': {v}" for v in values)
    return (f"(SELECT k, {', '.join(f'p.{v} AS {v}' for v in values)} FROM "
            f"(SELECT {key} AS k, arg_min_null({{{packed}}}, _ord) AS p FROM {src} WHERE {key} IS NOT NULL GROUP BY 1))")


# =============================================================================
# L4 consolidation (flagship)
# =============================================================================

def _duck_agent_b(u: str) -> str:
    head = f"split_part({u}, ';', 1)"
    inner = f"CASE WHEN len(string_split({head}, '_')) >= 3 THEN string_split({head}, '_')[3] ELSE {head} END"
    return f"CASE WHEN {duck_blank(u)} THEN 'Discador' ELSE {duck_title(duck_strip(inner))} END"


_L4_ORACLE = f"""
WITH i AS ({_interactions('duckdb')}), cl AS ({_contact_list('duckdb')}), st AS ({_staffing('duckdb')}),
qu AS ({_quartiles('duckdb')}), sh AS ({_shifts('duckdb')}),
a0 AS (
  SELECT *, {_duck_case_map(duck_title(duck_collapse(_duck_agent_b('user'))), NAME_FIXES, None)} AS agent,
         split_part(date_text, ' ', 1) AS date,
         coalesce(substr(CASE WHEN strpos(date_text, ' ') > 0 THEN substr(date_text, strpos(date_text, ' ') + 1) END, 1, 5), '00:00') AS time,
         CASE WHEN {duck_blank('dnis')} THEN NULL ELSE right(dnis, 9) END AS phone,
         {duck_strip_literals('conclusion', C.CONCLUSION_LITERALS)} AS cleaned
  FROM i),
a1 AS (
  SELECT * EXCLUDE (contact_id, cleaned), {duck_disposition('cleaned')} AS disposition,
         {duck_strip('contact_id')} AS contact_id
  FROM a0),
a2 AS (
  SELECT *, CAST(1 AS INTEGER) AS handled,
    CASE WHEN coalesce(agent <> 'Discador' AND direction IN ('Entrante', 'Saliente'), FALSE) THEN 'Manual' ELSE 'Discador' END AS call_type,
    {_duck_in('disposition', C.NOT_APPLICABLE)} AS not_applicable,
    {_duck_in('disposition', C.MIGRATION)} AS migration,
    {_duck_in('disposition', C.CONTACT)} AS contact,
    CAST(coalesce(disposition = 'Error de ingreso', FALSE) AS INTEGER) AS errors,
    CAST(coalesce(disposition = 'WRAP-UP-TIMEOUT', FALSE) AS INTEGER) AS untyped,
    {_duck_case_map('queue', QUEUES, '-')} AS base_cloud
  FROM a1),
b1 AS (SELECT {duck_strip('contact_id')} AS k, arg_min_null(segment, _ord) AS v FROM cl WHERE {duck_strip('contact_id')} IS NOT NULL GROUP BY 1),
b2 AS (SELECT {duck_strip('phone_1')} AS k, arg_min_null(segment, _ord) AS v FROM cl WHERE {duck_strip('phone_1')} IS NOT NULL GROUP BY 1),
b3 AS (SELECT {duck_strip('phone_2')} AS k, arg_min_null(segment, _ord) AS v FROM cl WHERE {duck_strip('phone_2')} IS NOT NULL GROUP BY 1),
a3 AS (
  SELECT a2.*, coalesce(b1.v, b2.v, b3.v, 'No Encontrado') AS bucket
  FROM a2 LEFT JOIN b1 ON a2.contact_id = b1.k LEFT JOIN b2 ON a2.phone = b2.k LEFT JOIN b3 ON a2.phone = b3.k),
stf AS {_duck_first(f"(SELECT *, {duck_title(duck_collapse('full_name'))} AS nk FROM st)", 'nk',
                    ['andes', 'supervisor', 'start_date', 'dni', 'site'])},
a4 AS (
  SELECT a3.*, stf.andes, stf.supervisor, stf.start_date, {duck_strip('stf.dni')} AS dni,
         coalesce(stf.site, 'Sin sede') AS site
  FROM a3 LEFT JOIN stf ON a3.agent = stf.k),
a5 AS (
  SELECT *, CASE WHEN days IS NULL THEN 'No aplica' WHEN days > 36 THEN 'Vigente' WHEN days > 6 THEN 'Prematuro' ELSE 'OJT' END AS tenure
  FROM (SELECT *, CAST(floor(date_diff('second',
          coalesce(try_strptime(start_date, '%Y-%m-%d %H:%M:%S'), try_strptime(start_date, '%Y-%m-%d')),
          TIMESTAMP '{AS_OF} 00:00:00') / 86400) AS INTEGER) AS days FROM a4)),
quf AS {_duck_first(f"(SELECT *, {duck_strip('dni')} AS nk FROM qu)", 'nk', ['quartile'])},
shf AS {_duck_first(f"(SELECT *, {duck_strip('dni')} AS nk FROM sh)", 'nk', ['shift'])},
a6 AS (
  SELECT a5.*, quf.quartile, shf.shift FROM a5 LEFT JOIN quf ON a5.dni = quf.k LEFT JOIN shf ON a5.dni = shf.k)
SELECT date, time, queue, campaign, agent, phone, disposition, contact_id, source_file, call_type, handled,
       not_applicable, migration, contact, errors, untyped, base_cloud, bucket, andes, dni, supervisor, tenure,
       quartile, shift, site
FROM a6
QUALIFY row_number() OVER (
  PARTITION BY {duck_strip('time')}, {duck_strip('agent')}, {duck_strip('phone')}, {duck_strip('disposition')}, {duck_strip('bucket')}
  ORDER BY time ASC NULLS LAST, source_file ASC NULLS LAST, _ord ASC NULLS LAST) = 1
"""


@register("consolidated_interactions", _L4_ORACLE)
def q_consolidated_interactions(spark, sf_dir):
    """L4: interactions (orders) normalised, classified, enriched from the
    contact list (J2), staffing (J1 + tenure), quartile and shift (J3), and
    de-duplicated keep-first (D2)."""
    inter = standin(spark, sf_dir, ["orders"], _interactions)
    cl = standin(spark, sf_dir, ["customer"], _contact_list)
    st = standin(spark, sf_dir, ["customer"], _staffing)
    qu = standin(spark, sf_dir, ["customer"], _quartiles)
    sh = standin(spark, sf_dir, ["customer"], _shifts)
    return jobs.consolidated_interactions(inter, cl, st, qu, sh, as_of=AS_OF, inputs=INPUTS)


# =============================================================================
# L1 accumulated
# =============================================================================

_L1_REPAIR = [("\xc3\xa3N", "n"), ("\xc3\xa3S", "es"), ("\xc2\x94", ""), ("\xc3\x91", "N"), ("\xc3\xa1", "a"),
              ("\xc3\xa3", "a"), ("\xc3\xa9", "e"), ("\xc3\xad", "i"), ("\xc3\xb1", "n"), ("\xc3\xb3", "o"),
              ("\xc3\xba", "u")]


def _duck_agent_a(u: str) -> str:
    head = f"split_part({u}, ';', 1)"
    inner = f"CASE WHEN len(string_split({head}, '_')) >= 2 THEN string_split({head}, '_')[-2] ELSE {head} END"
    return f"CASE WHEN {duck_blank(u)} THEN '' ELSE {duck_strip(inner)} END"


def _repair_chain(x: str) -> str:
    out = x
    for a, b in _L1_REPAIR:
        out = f"replace({out}, '{a}', '{b}')"
    return out


_L1_AGENT = _duck_case_map(
    duck_title(duck_collapse(_repair_chain(_duck_case_map(_duck_agent_a("user"), NAME_FIXES, None)))), NAME_FIXES, None)

_L1_ORACLE = f"""
WITH i AS ({_interactions('duckdb')}), st AS ({_staffing('duckdb')}),
stf AS {_duck_first(f"(SELECT *, {duck_title(duck_collapse('full_name'))} AS nk FROM st)", 'nk', ['supervisor'])},
a0 AS (
  SELECT i.*, {_L1_AGENT} AS agent FROM i),
a1 AS (
  SELECT a0.*, stf.supervisor,
         {duck_disposition(duck_strip_literals('conclusion', C.CONCLUSION_LITERALS))} AS disposition,
         {_duck_case_map('queue', QUEUES, '-')} AS base_cloud,
         split_part(date_text, ' ', 1) AS date,
         CASE WHEN strpos(date_text, ' ') > 0 THEN substr(date_text, strpos(date_text, ' ') + 1) END AS tpart
  FROM a0 LEFT JOIN stf ON a0.agent = stf.k)
SELECT date, coalesce(strftime(try_strptime(tpart, '%H:%M'), '%H:%M'), '00:00') AS time, queue, agent,
       phone_in AS phone, disposition, contact_id, base_cloud, source_file, supervisor
FROM a1
WHERE coalesce(regexp_matches(disposition, '(?i){C.ACCEPTED_PATTERN}'), FALSE)
  AND coalesce(CAST(try_strptime(date, '%d/%m/%Y') AS DATE)
               BETWEEN CAST(date_trunc('month', DATE '{AS_OF}') - INTERVAL 10 DAY AS DATE) AND last_day(DATE '{AS_OF}'), FALSE)
"""


@register("accumulated_contacts", _L1_ORACLE)
def q_accumulated_contacts(spark, sf_dir):
    """L1: accepted migration contacts in the month window of ``as_of``,
    with the supervisor looked up by canonical agent name."""
    inter = standin(spark, sf_dir, ["orders"], _interactions)
    st = standin(spark, sf_dir, ["customer"], _staffing)
    return jobs.accumulated_contacts(inter, st, as_of=AS_OF, inputs=INPUTS)


# =============================================================================
# L2 contact base
# =============================================================================

def _raw_contacts(d):
    return f"""SELECT
      CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE ' K' || CAST(c_custkey AS STRING) || chr(160) END AS contact_id,
      CASE c_custkey % 3 WHEN 0 THEN '1997' || lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0') || '15'
                         WHEN 1 THEN '19971345' ELSE NULL END AS effective_date,
      'RUT ' || chr(160) || ' ' || CAST(c_custkey AS STRING) || ' Mu' || chr(195) || chr(177) || 'oz' AS person_id,
      CASE c_custkey % 5 WHEN 0 THEN '  ' WHEN 1 THEN NULL
           ELSE ' +56 9' || lpad(CAST(c_custkey AS STRING), 8, '0') || ' ' END AS phone_1,
      '569' || lpad(CAST((c_custkey * 7) % 1500 AS STRING), 8, '0') AS phone_2,
      c_mktsegment || '  ' || chr(195) || chr(179) || 'n' AS segment
    FROM customer"""


def _accent_chain(x: str) -> str:
    pairs = [("\xc2\x94", ""), ("\xc2\xb0", "°"), ("\xc3\x91", "Ñ"), ("\xc3\xa1", "á"), ("\xc3\xa9", "é"),
             ("\xc3\xad", "í"), ("\xc3\xb1", "ñ"), ("\xc3\xb3", "ó"), ("\xc3\xba", "ú")]
    out = x
    for a, b in pairs:
        out = f"replace({out}, '{a}', '{b}')"
    return out


def _duck_l2_phone(x):
    c = duck_collapse(x)
    return _accent_chain(f"CASE WHEN {duck_blank(c)} THEN NULL ELSE right({duck_strip(c)}, 9) END")


@register("contact_base", f"""
WITH src AS ({_raw_contacts('duckdb')})
SELECT strftime(try_strptime({duck_collapse('effective_date')}, '%Y%m%d'), '%d/%m/%Y') AS base_date,
       {_accent_chain(duck_collapse('person_id'))} AS person_id,
       {_accent_chain(duck_collapse('contact_id'))} AS contact_id,
       {_duck_l2_phone('phone_1')} AS phone_1, {_duck_l2_phone('phone_2')} AS phone_2,
       {_accent_chain(duck_collapse('segment'))} AS segment
FROM src""")
def q_contact_base(spark, sf_dir):
    """L2: contact lists cleaned -- blanks collapsed in every column (X8),
    ``yyyyMMdd`` -> ``dd/MM/yyyy`` (T1), phones cut to 9 (X10), damaged
    letters repaired in every column (X6)."""
    raw = standin(spark, sf_dir, ["customer"], _raw_contacts)
    return jobs.contact_base(raw)


# =============================================================================
# L5 form report
# =============================================================================

def _form(d):
    return f"""SELECT event_id, ts AS stamp,
      CASE WHEN event_id % 5 = 0 THEN ' pu' || CAST(user_id AS STRING) || ' ' ELSE 'pu' || CAST(user_id AS STRING) END AS user,
      CASE event_type WHEN 'click' THEN ' piloto x ' WHEN 'view' THEN 'Keep Me' WHEN 'error' THEN NULL
                      ELSE lower(event_type) END AS campaign_type,
      CASE event_id % 4 WHEN 0 THEN 'ACEPTA AGENDA - MIGRACION - SOP' WHEN 1 THEN 'NO ACEPTA'
                        WHEN 2 THEN 'OTRO' ELSE NULL END AS disposition,
      CASE WHEN event_id % 3 = 0 THEN 'SI' ELSE 'NO' END AS contacted,
      'obs ' || CAST(event_id AS STRING) AS {_id(d, 'OBSERVACIÓN')},
      'x' AS {_id(d, 'FECHA')}
    FROM events"""


def _calls(d):
    # agents without calls get a name that is null (never matches); every
    # sixth agent appears twice (fan-out)
    return f"""SELECT CASE WHEN c_custkey % 2 = 0 THEN lpad(CAST(c_custkey AS STRING), 9, '0') || ', Customer' END
                       AS {_id(d, 'Name')},
                     CAST(c_nationkey AS STRING) AS calls, '00:01' AS {_id(d, 'AHT')}, c_custkey AS _ord
              FROM customer
              UNION ALL
              SELECT CASE WHEN c_custkey % 6 = 0 THEN lpad(CAST(c_custkey AS STRING), 9, '0') || ',Customer' END,
                     'extra', '00:02', c_custkey + 100000000
              FROM customer"""


def _form_quartiles(d):
    return """SELECT CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS STRING) || '.0'
                                      WHEN 1 THEN lpad(CAST(c_custkey AS STRING), 7, '0') ELSE 'n/a' END AS dni,
                     'Q' || CAST(c_custkey % 4 + 1 AS STRING) AS quartile, c_custkey AS _ord FROM customer"""


_L5_ORACLE = f"""
WITH fo AS ({_form('duckdb')}), st AS ({_staffing('duckdb')}), ca AS ({_calls('duckdb')}),
qu AS ({_form_quartiles('duckdb')}), sh AS ({_shifts('duckdb')}),
f0 AS (
  SELECT event_id, strftime(stamp, '%d/%m/%Y %H:%M') AS stamp, strftime(stamp, '%d/%m/%Y') AS date,
         strftime(stamp, '%H:%M') AS time, user, upper({duck_strip('campaign_type')}) AS campaign_type,
         disposition, contacted,
         {_duck_in('disposition', C.FORM_MIGRATION)} AS migration_form,
         CAST(coalesce(disposition = 'NO ACEPTA', FALSE) AS INTEGER) AS not_accepted_form,
         CAST(1 AS INTEGER) AS handled_form,
         CAST(coalesce(contacted = 'SI', FALSE) AS INTEGER) AS contact_form,
         {duck_strip('user')} AS uk
  FROM fo
  WHERE coalesce(upper({duck_strip('campaign_type')}) NOT IN ('PILOTO X', 'SIGNUP'), TRUE)),
stf AS {_duck_first(f"(SELECT *, {duck_strip('platform_user')} AS nk, {duck_title(duck_collapse('full_name'))} AS fn, {duck_numeric_id('dni')} AS dn FROM st)",
                    'nk', ['fn', 'supervisor', 'start_date', 'dn', 'site'])},
f1 AS (
  SELECT f0.*, stf.fn AS full_name, stf.supervisor, stf.dn AS dni, stf.site,
         coalesce(try_strptime(stf.start_date, '%Y-%m-%d %H:%M:%S'), try_strptime(stf.start_date, '%Y-%m-%d')) AS sd
  FROM f0 LEFT JOIN stf ON f0.uk = stf.k),
f2 AS (
  SELECT f1.*, CASE WHEN days IS NULL THEN 'No aplica' WHEN days > 36 THEN 'Vigente' WHEN days > 6 THEN 'Prematuro' ELSE 'OJT' END AS tenure
  FROM (SELECT *, CAST(floor(date_diff('second', sd, TIMESTAMP '{EVENTS_AS_OF} 00:00:00') / 86400) AS INTEGER) AS days FROM f1) f1),
cal AS (SELECT CASE WHEN strpos("Name", ',') > 0
                    THEN {duck_strip('substr("Name", strpos("Name", \',\') + 1)')} || ' ' || {duck_strip('split_part("Name", \',\', 1)')}
                    ELSE {duck_strip('"Name"')} END AS nk, calls FROM ca),
f3 AS (SELECT f2.*, cal.calls FROM f2 LEFT JOIN cal ON f2.full_name = cal.nk),
quf AS {_duck_first(f"(SELECT *, {duck_numeric_id('dni')} AS nk FROM qu)", 'nk', ['quartile'])},
shf AS {_duck_first(f"(SELECT *, {duck_numeric_id('dni')} AS nk FROM sh)", 'nk', ['shift'])}
SELECT event_id, stamp, user, campaign_type, disposition, contacted, date, time, migration_form,
       not_accepted_form, handled_form, contact_form, full_name, supervisor, dni, site, tenure, calls,
       quf.quartile, shf.shift
FROM f3 LEFT JOIN quf ON f3.dni = quf.k LEFT JOIN shf ON f3.dni = shf.k
"""


@register("form_report", _L5_ORACLE)
def q_form_report(spark, sf_dir):
    """Form responses (events) filtered by campaign, flagged, joined to
    staffing by platform user (J5), calls per agent with fan-out (J4),
    quartile and shift by canonical id (X18 + J3); listed columns dropped."""
    form = standin(spark, sf_dir, ["events"], _form)
    st = standin(spark, sf_dir, ["customer"], _staffing)
    calls = standin(spark, sf_dir, ["customer"], _calls)
    qu = standin(spark, sf_dir, ["customer"], _form_quartiles)
    sh = standin(spark, sf_dir, ["customer"], _shifts)
    out = jobs.form_report(form, st, calls, qu, sh, as_of=EVENTS_AS_OF, inputs=INPUTS)
    return out


# =============================================================================
# L6 campaign activity, L8 daily base counts
# =============================================================================

def _campaigns(d):
    return f"""SELECT CASE p_partkey % 4 WHEN 0 THEN 'CAMP_A' WHEN 1 THEN 'CAMP_B'
                                       ELSE 'CAMP_' || CAST(p_partkey AS STRING) END AS {_id(d, 'Name')},
                     CAST(p_size AS STRING) AS {_id(d, 'Answers')}, CAST(p_partkey % 17 AS STRING) AS {_id(d, 'Records Completed')},
                     CAST(p_size % 7 AS STRING) || '%' AS {_id(d, 'Hit Ratio')}, CAST(p_size * 3 AS STRING) AS {_id(d, 'No Answer Result')},
                     p_brand AS {_id(d, 'Extra column')}
              FROM part"""


@register("campaign_activity", f"""
WITH src AS ({_campaigns('duckdb')})
SELECT "Name", "Hit Ratio", "Records Completed" AS "Gestiones Completas", "Answers" AS "Contacto (Answer)",
       "No Answer Result" AS "No Contacto (No Answer Result)"
FROM src WHERE "Name" IN ('CAMP_A', 'CAMP_B')""")
def q_campaign_activity(spark, sf_dir):
    """Kept campaigns, renamed, fixed order, renamed again."""
    raw = standin(spark, sf_dir, ["part"], _campaigns)
    return jobs.campaign_activity(raw, inputs=INPUTS)


def _base_rows(d):
    return f"""SELECT
      CASE WHEN event_type = 'click' THEN 'confirm q001 base ' || CAST(user_id % 3 AS STRING) || '.csv'
           WHEN event_type = 'view' AND user_id % 2 = 0 THEN 'MAIN BASE Q001.csv'
           WHEN event_type = 'view' THEN 'MAIN BASE Q001 confirm.csv'
           WHEN event_type = 'error' THEN 'daily q003.csv'
           WHEN event_type = 'purchase' THEN 'Q004 list.csv'
           ELSE 'other.csv' END AS file_name,
      {fmt(d, 'ts', 'dd/MM/yyyy')} AS base_date,
      event_type <> 'purchase' AS has_base_date
    FROM events"""


@register("daily_base_counts", f"""
WITH src AS ({_base_rows('duckdb')})
SELECT CAST(count_if(label = 'main') AS BIGINT) AS main_base, CAST(count_if(label = 'confirm') AS BIGINT) AS confirmations,
       CAST(count_if(label = 'q3') AS BIGINT) AS base_q3, CAST(count_if(label = 'q4') AS BIGINT) AS base_q4
FROM (SELECT CASE WHEN contains(u, 'CONFIRM') AND contains(u, 'Q001') THEN 'confirm'
                  WHEN contains(u, 'MAIN BASE Q001') THEN 'main' WHEN contains(u, 'Q003') THEN 'q3'
                  WHEN contains(u, 'Q004') THEN 'q4' END AS label
      FROM (SELECT upper(file_name) AS u FROM src
            WHERE NOT has_base_date OR contains(base_date, strftime(DATE '{EVENTS_AS_OF}', '%d/%m/%Y'))))""")
def q_daily_base_counts(spark, sf_dir):
    """Rows dated ``as_of`` per base file (all rows for files without a
    date column), labelled by ordered file-name rules, one row of counts."""
    rows = standin(spark, sf_dir, ["events"], _base_rows)
    return jobs.daily_base_counts(rows, as_of=EVENTS_AS_OF, inputs=INPUTS)
