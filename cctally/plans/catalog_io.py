"""Driver queries for readers and sinks.

Each query stages files written by Spark from a test table into a fresh
folder below the shared checkpoint folder, then reads them back through the
library's readers; the oracle is the table itself.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.lookup import first_wins
from ..operators.project import union_all_by_name
from ..session import staging_dir
from ..sources import readers, sinks
from . import jobs
from .catalog import AS_OF, register, views
from .rules_config import JobInputs


def _text_lines(df, path, *, encoding="UTF-8", partition_by=None):
    """Write one text line per row (column ``line``) without quoting."""
    w = df.write.mode("overwrite").option("sep", "\u0001").option("quote", "").option("header", False) \
        .option("encoding", encoding)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def _headed(body, header: str, parts: int):
    """``part, line`` with a header line first in each file: every task puts one before its lines of each part.

    No row leaves its task, so neither a task's sort nor the data moved grows with the table.
    """
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    heads = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda k: F.struct(
        k.cast("long").alias("part"), F.lit(0).alias("o"), F.lit(header).alias("line")))
    own = F.array(F.struct(F.col("part").cast("long").alias("part"), F.lit(1).alias("o"), F.col("line").alias("line")))
    lines = body.withColumn("first", first).select(
        F.explode(F.when(F.col("first"), F.concat(heads, own)).otherwise(own)).alias("e"))
    return lines.select("e.*").sortWithinPartitions("part", "o").select("part", "line")


@register("folder_scan_roundtrip", """
SELECT n_nationkey AS key, n_name AS name, n_regionkey AS region_key,
       CASE WHEN n_regionkey <= 1 THEN 'root_a' ELSE 'root_b' END AS root
FROM nation""")
def q_folder_scan_roundtrip(spark, sf_dir):
    """S1 + U2 (several roots, a missing one ignored), S3 (``;`` with header),
    S14 (source file), K1 (``;`` sink)."""
    views(spark, sf_dir, "nation")
    base = staging_dir(spark, "scan")
    nat = spark.table("nation").select(F.col("n_nationkey").alias("Clave"), F.col("n_name").alias("Nombre"),
                                       F.col("n_regionkey").alias("Región"))
    # two roots; every row is written once
    sinks.write_delimited(nat.where("`Región` <= 1").repartition(3), f"{base}/root_a")
    sinks.write_delimited(nat.where("`Región` > 1"), f"{base}/root_b")
    res = readers.read_delimited(spark, [f"{base}/root_a", f"{base}/root_b", f"{base}/missing"],
                                 ["Clave", "Nombre", "Región"])
    root = F.regexp_extract(F.col(f"{readers.ORD_COL}.file"), r"/(root_[ab])/", 1)
    return res.data.select(
        F.col("Clave").cast("int").alias("key"), F.col("Nombre").alias("name"),
        F.col("`Región`").cast("int").alias("region_key"), root.alias("root"))


@register("encoding_fallback", """
SELECT p_partkey, replace(p_name, 'e', 'é') || ' Ñu' AS name, p_brand AS brand FROM part""")
def q_encoding_fallback(spark, sf_dir):
    """Files in UTF-8 and in Latin-1 in one folder; each file is decoded
    by its own validity check."""
    views(spark, sf_dir, "part")
    base = staging_dir(spark, "enc")
    df = spark.table("part").select(
        F.col("p_partkey").alias("id"),
        F.concat(F.replace(F.col("p_name"), F.lit("e"), F.lit("é")), F.lit(" Ñu")).alias("name"),
        F.col("p_brand").alias("brand"))
    # the table is split in two halves (every row written once), one per encoding
    sinks.write_delimited(df.where(F.col("id") % 2 == 0), base, encoding="UTF-8")
    sinks.write_delimited(df.where(F.col("id") % 2 == 1), base, encoding="ISO-8859-1", mode="append")
    res = readers.read_delimited(spark, [base], ["id", "name", "brand"])
    return res.data.select(F.col("id").cast("bigint").alias("p_partkey"), "name", "brand")


@register("delimiter_header_groups", """
SELECT CAST(s_suppkey AS VARCHAR) AS id,
       CASE WHEN s_suppkey % 3 = 1 THEN NULL ELSE s_name END AS name,
       CASE WHEN s_suppkey % 3 = 2 THEN NULL ELSE CAST(s_nationkey AS VARCHAR) END AS nation
FROM supplier""")
def q_delimiter_header_groups(spark, sf_dir):
    """S5/S6 (delimiter per file, sniffed), P4 (wanted columns present),
    U1 (files with reordered, missing and extra columns unioned by name)."""
    views(spark, sf_dir, "supplier")
    base = staging_dir(spark, "delim")
    s = spark.table("supplier")
    k = F.col("s_suppkey") % 3      # three layouts; every row is written once
    sinks.write_delimited(s.where(k == 0).select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                                 F.col("s_nationkey").alias("nation")), base, sep=",")
    sinks.write_delimited(s.where(k == 1).select(F.col("s_nationkey").alias("nation"), F.col("s_suppkey").alias("id"),
                                                 F.col("s_acctbal").alias("extra")), base, sep=";", mode="append")
    sinks.write_delimited(s.where(k == 2).select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")),
                          base, sep="\t", mode="append")
    res = readers.read_delimited(spark, [base], ["id", "name", "nation"], delimiters=readers.SNIFF_CANDIDATES,
                                 delimiter_mode="sniff")
    return res.data.select("id", "name", "nation")


@register("wide_row_skip", """
SELECT CAST(r_regionkey AS VARCHAR) AS key, r_name AS name, 'kept' AS status FROM region
UNION ALL SELECT CAST(r_regionkey + 10 AS VARCHAR), NULL, 'kept' FROM region
UNION ALL SELECT CAST(r_regionkey + 20 AS VARCHAR), NULL, 'too_wide' FROM region""")
def q_wide_row_skip(spark, sf_dir):
    """S7 (too-wide rows out, short rows null-padded) + S8 (reject table)."""
    views(spark, sf_dir, "region")
    base = staging_dir(spark, "wide")
    r = spark.table("region")
    part = (F.col("r_regionkey") % 2).alias("part")
    header = r.select(part, F.lit(0).alias("o"), F.lit("Clave;Nombre").alias("line"), F.lit(-1).alias("k")).distinct()
    body = union_all_by_name([
        r.select(part, F.lit(1).alias("o"), F.concat_ws(";", "r_regionkey", "r_name").alias("line"), F.col("r_regionkey").alias("k")),
        r.select(part, F.lit(1).alias("o"), (F.col("r_regionkey") + 10).cast("string").alias("line"), (F.col("r_regionkey") + 10).alias("k")),
        r.select(part, F.lit(1).alias("o"), F.concat_ws(";", (F.col("r_regionkey") + 20).cast("string"), "r_name",
                                                         F.lit("x"), F.lit("y")).alias("line"), (F.col("r_regionkey") + 20).alias("k")),
    ])
    # one hash partition per folder value: its header line sorts first in its file
    lines = union_all_by_name([header, body]).repartition("part").sortWithinPartitions("part", "o", "k")
    _text_lines(lines.select("part", "line"), base, partition_by=["part"])
    res = readers.read_delimited(spark, [f"{base}/part=0", f"{base}/part=1"], ["Clave", "Nombre"])
    kept = res.data.select(F.col("Clave").alias("key"), F.col("Nombre").alias("name"), F.lit("kept").alias("status"))
    rej = res.rejects.select(F.split_part("raw", F.lit(";"), F.lit(1)).alias("key"), F.lit(None).cast("string").alias("name"),
                             F.col("reason").alias("status"))
    return kept.unionByName(rej)


@register("keyvalue_scan", """
SELECT CAST(p_partkey AS VARCHAR) AS "ID", p_name AS "NAME",
       CASE WHEN p_partkey % 5 = 0 THEN '' ELSE p_brand END AS "BRAND",
       CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'size=' || CAST(p_size AS VARCHAR) END AS "EXPR"
FROM part""")
def q_keyvalue_scan(spark, sf_dir):
    """S9 (``k=v|k=v`` Latin-1 records, split at the first ``=``), S10 (keys
    discovered), X14, Q21 (keys in any order), F6 (header lines dropped)."""
    views(spark, sf_dir, "part")
    base = staging_dir(spark, "kv")
    p = spark.table("part")
    idc, name, brand = (F.concat(F.lit("ID="), F.col("p_partkey")), F.concat(F.lit("NAME="), F.col("p_name")),
                        F.concat(F.lit("BRAND="), F.when(F.col("p_partkey") % 5 == 0, F.lit("")).otherwise(F.col("p_brand"))))
    expr = F.when(F.col("p_partkey") % 7 != 0, F.concat(F.lit("EXPR=size="), F.col("p_size")))
    line = F.when(F.col("p_partkey") % 3 == 0, F.concat_ws("|", name, idc, expr, brand)) \
        .otherwise(F.concat_ws("|", idc, name, brand, expr))
    recs = p.select(line.alias("line"))
    headers = p.select(F.when(F.col("p_partkey") % 50 == 0, F.lit("ID|NAME|BRAND|EXPR"))
                       .otherwise(F.lit("ID=ID|NAME=NAME")).alias("line")).distinct()
    _text_lines(union_all_by_name([recs, headers]), base, encoding="ISO-8859-1")
    out = readers.read_keyvalue(spark, [base], pattern="*.csv")
    return out.select("ID", "NAME", "BRAND", "EXPR")


@register("keyvalue_base", """
SELECT CAST(o_orderkey AS VARCHAR) AS "ORDER", o_orderstatus AS "STATUS", o_orderpriority AS "PRIORITY",
       TRUE AS from_file
FROM orders""")
def q_keyvalue_base(spark, sf_dir):
    """L3: key=value exports of several files -> one table with the source
    file name (S14) per row."""
    views(spark, sf_dir, "orders")
    base = staging_dir(spark, "kvbase")
    o = spark.table("orders")
    line = F.concat_ws("|", F.concat(F.lit("ORDER="), F.col("o_orderkey")), F.concat(F.lit("STATUS="), F.col("o_orderstatus")),
                       F.concat(F.lit("PRIORITY="), F.col("o_orderpriority")))
    _text_lines(o.select(line.alias("line")).repartition(4), base, encoding="ISO-8859-1")
    out = readers.read_keyvalue(spark, [base], ["ORDER", "STATUS", "PRIORITY"], pattern="*.csv")
    return out.select("ORDER", "STATUS", "PRIORITY",
                      F.col(readers.FILE_COL).endswith(".csv").alias("from_file"))


@register("record_count", "SELECT CAST(count(*) AS BIGINT) AS records FROM lineitem")
def q_record_count(spark, sf_dir):
    """L7 (S1 + S9 + A3): record lines per file of a key=value export,
    summed to one row."""
    views(spark, sf_dir, "lineitem")
    base = staging_dir(spark, "rsl")
    li = spark.table("lineitem")
    line = F.concat_ws("|", F.concat(F.lit("ORDER="), F.col("l_orderkey")), F.concat(F.lit("LINE="), F.col("l_linenumber")))
    _text_lines(li.select(line.alias("line")).repartition(4), base, encoding="ISO-8859-1")
    lines = readers.read_keyvalue_lines(spark, [base], pattern="*.csv")
    return jobs.record_count(lines)


@register("multi_table_sink", """
SELECT 'nation' AS table_name, 'written' AS status, CAST(count(*) AS BIGINT) AS rows FROM nation
UNION ALL SELECT 'region', 'written', CAST(count(*) AS BIGINT) FROM region
UNION ALL SELECT 'empty', 'skipped', CAST(0 AS BIGINT)""")
def q_multi_table_sink(spark, sf_dir):
    """K2/K3 (one dataset per named table), K4 (optional empty table
    skipped), K5 (second run replaces the first)."""
    views(spark, sf_dir, "region", "nation")
    root = staging_dir(spark, "sink")
    tables = {"nation": spark.table("nation"), "region": spark.table("region"),
              "empty": spark.table("region").where(F.lit(False))}
    sinks.write_tables(tables, root, optional={"empty"})
    status = sinks.write_tables(tables, root, optional={"empty"})
    frames = []
    for name, st in status.items():
        if st == "written":
            frames.append(spark.read.parquet(os.path.join(root, name))
                          .agg(F.count(F.lit(1)).alias("rows"))
                          .select(F.lit(name).alias("table_name"), F.lit(st).alias("status"), "rows"))
        else:
            # a global aggregate has exactly one row
            frames.append(spark.table("region").agg(F.count(F.lit(1)).alias("n"))
                          .select(F.lit(name).alias("table_name"), F.lit(st).alias("status"), F.lit(0).cast("long").alias("rows")))
    return union_all_by_name(frames)


@register("staged_dimension_scan", """
SELECT s_suppkey, s_name, 'double' AS inferred_type, s_nationkey FROM supplier""")
def q_staged_dimension_scan(spark, sf_dir):
    """S11 (staged dimension, Parquet and CSV), S12/S13 (all-string,
    declared and inferred schemas)."""
    views(spark, sf_dir, "supplier")
    base = staging_dir(spark, "dim")
    s = spark.table("supplier")
    sinks.write_delimited(s, f"{base}/csv", sep=",")
    sinks.write_table(s, f"{base}/parquet")
    as_text = readers.read_dimension(spark, f"{base}/csv", fmt="csv")
    declared = readers.read_dimension(spark, f"{base}/csv", fmt="csv", schema=StructType([
        StructField("s_suppkey", LongType()), StructField("s_name", StringType()),
        StructField("s_nationkey", StringType()), StructField("s_acctbal", StringType())]))
    inferred = readers.read_dimension(spark, f"{base}/csv", fmt="csv", infer=True)
    inferred_type = dict(inferred.dtypes)["s_acctbal"]
    parquet = readers.read_dimension(spark, f"{base}/parquet")
    out = declared.select("s_suppkey").join(
        as_text.select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "s_name"), "s_suppkey", "left")
    out = out.join(parquet.select("s_suppkey", "s_nationkey"), "s_suppkey", "left")
    return out.select("s_suppkey", "s_name", F.lit(inferred_type).alias("inferred_type"), "s_nationkey")


@register("optional_output_read", """
SELECT 'previous' AS source, CAST(r_regionkey AS VARCHAR) AS key, r_name AS name FROM region
UNION ALL SELECT 'notice', NULL, 'previous output not found'
UNION ALL SELECT 'empty_input', NULL, 'no input'""")
def q_optional_output_read(spark, sf_dir):
    """S15 (previous output if present, else a one-row notice) and S16
    (an empty input folder yields a status, no data)."""
    views(spark, sf_dir, "region")
    base = staging_dir(spark, "opt")
    sinks.write_delimited(spark.table("region"), f"{base}/previous")
    prev = readers.read_optional(spark, f"{base}/previous")
    absent = readers.read_optional(spark, f"{base}/absent")
    empty = readers.read_delimited(spark, [f"{base}/empty"], ["r_regionkey"])
    parts = [
        prev.select(F.lit("previous").alias("source"), F.col("r_regionkey").alias("key"), F.col("r_name").alias("name")),
        absent.select(F.lit("notice").alias("source"), F.lit(None).cast("string").alias("key"), F.col("Aviso").alias("name")),
    ]
    if empty.empty:
        # one status row (a global aggregate has exactly one row)
        parts.append(spark.table("region").agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit("empty_input").alias("source"), F.lit(None).cast("string").alias("key"),
                             F.lit("no input").alias("name")))
    return union_all_by_name(parts)


@register("month_folder_pruning", f"""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
FROM orders
WHERE date_trunc('month', o_orderdate) IN (date_trunc('month', DATE '{AS_OF}'),
                                            date_trunc('month', DATE '{AS_OF}') - INTERVAL 1 MONTH)""")
def q_month_folder_pruning(spark, sf_dir):
    """S2 + T9: orders staged as ``year=/month=`` folders; only the month of
    ``as_of`` and the month before are read (partition pruning)."""
    views(spark, sf_dir, "orders")
    root = staging_dir(spark, "months")
    o = spark.table("orders").select("o_orderkey", F.year("o_orderdate").alias("year"),
                                     F.month("o_orderdate").alias("month"))
    sinks.write_table(o, root, partition_by=["year", "month"])
    return readers.read_month_partitions(spark, root, AS_OF).select("o_orderkey", "year", "month")


@register("wide_rows_exact", """
SELECT CAST(doc_id AS VARCHAR) AS id, nullif(text, '') AS text, lang, 'kept' AS status FROM documents
UNION ALL SELECT CAST(doc_id AS VARCHAR), coalesce(source, '') || ' 5" x', NULL, 'kept' FROM documents
UNION ALL SELECT CAST(doc_id AS VARCHAR), NULL, NULL, 'too_wide' FROM documents""")
def q_wide_rows_exact(spark, sf_dir):
    """Whole texts with quotes, separators and line breaks, short
    rows with an inch mark, and too-wide rows, read back byte for byte."""
    views(spark, sf_dir, "documents")
    base = staging_dir(spark, "exact")
    quoted = F.concat(F.lit('"'), F.replace(F.coalesce("text", F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    d = spark.table("documents").withColumns({"id": F.col("doc_id").cast("string"), "part": F.col("doc_id") % 4})
    body = d.select("part", F.explode(F.array(
        F.concat("id", F.lit(";"), quoted, F.lit(";"), F.coalesce("lang", F.lit(""))),
        F.concat("id", F.lit(";"), F.coalesce("source", F.lit("")), F.lit(' 5" x')),
        F.concat("id", F.lit(';"a;b\n""c""";5" y;z;LOST"')))).alias("line"))
    _headed(body, "id;text;lang", 4).write.partitionBy("part").text(base)
    res = readers.read_delimited(spark, [f"{base}/part={k}" for k in range(4)], ["id", "text", "lang"], pattern="*.txt",
                                 na_tokens=None)
    landed = readers.land(res)
    rejected = landed.rejects.select(F.split_part("raw", F.lit(";"), F.lit(1)).alias("id"), F.lit(None).cast("string").alias("text"),
                                     F.lit(None).cast("string").alias("lang"), F.col("reason").alias("status"))
    return landed.rows.select("id", "text", "lang", F.lit("kept").alias("status")).unionByName(rejected)


@register("root_order_first_wins", """
SELECT CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN c_custkey % 2 = 0 THEN 'first ' || c_mktsegment ELSE 'second ' || c_mktsegment END AS segment
FROM customer""")
def q_root_order_first_wins(spark, sf_dir):
    """Two roots hold the same keys; the root given first wins, whatever
    its name, through the written contact base (L2) and its source order."""
    views(spark, sf_dir, "customer")
    base = staging_dir(spark, "ranked")
    c = spark.table("customer")
    row = lambda label: [F.col("c_custkey").alias("inin-outbound-id"), F.concat(
        F.lit(label), F.col("c_mktsegment")).alias("Segment_of_Origin")]
    sinks.write_delimited(c.where(F.col("c_custkey") % 2 == 0).select(*row("first ")), f"{base}/z", sep=",")
    sinks.write_delimited(c.select(*row("second ")), f"{base}/a", sep=";")
    jobs.run_contact_base(spark, [f"{base}/z", f"{base}/a"], f"{base}/out", ordered_out=f"{base}/out_ordered")
    handed = spark.read.parquet(f"{base}/out_ordered")
    return first_wins(handed, "contact_id", ["segment"], ["_ord"]).select(F.col("contact_id").alias("id"), "segment")


@register("keyvalue_bare_cells", """
SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name, p_brand AS brand, 'kept' AS status FROM part
UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name, NULL, 'kept' FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT CAST(p_partkey AS VARCHAR), NULL, NULL, 'bare_cell' FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT CAST(p_partkey AS VARCHAR), NULL, NULL, 'unknown_key' FROM part WHERE p_partkey % 5 = 0
UNION ALL SELECT CAST(p_partkey AS VARCHAR), NULL, NULL, 'kept' FROM part WHERE p_partkey % 5 = 0
UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name, p_brand, 'kept' FROM part WHERE p_partkey % 7 = 0""")
def q_keyvalue_bare_cells(spark, sf_dir):
    """Bare cells take the key of their place or are rejected, bare
    lines are rows, unknown keys are rejected; keys declared, so one scan."""
    views(spark, sf_dir, "part")
    base = staging_dir(spark, "bare")
    p = spark.table("part")
    key, name, brand = F.concat(F.lit("ID="), "p_partkey"), F.col("p_name"), F.concat(F.lit("BRAND="), "p_brand")
    lines = union_all_by_name([
        p.select(F.concat_ws("|", key, name, brand).alias("line")),
        p.where("p_partkey % 3 = 0").select(F.concat_ws("|", key, name, F.lit(""), F.lit("plain")).alias("line")),
        p.where("p_partkey % 5 = 0").select(F.concat_ws("|", key, F.lit("COLOUR=red")).alias("line")),
        p.where("p_partkey % 7 = 0").select(F.concat_ws("|", "p_partkey", name, "p_brand").alias("line"))])
    _text_lines(lines, base, encoding="ISO-8859-1")
    res = readers.read_keyvalue_parsed(spark, [base], ["ID", "NAME", "BRAND"], pattern="*.csv")
    blank = lambda c: F.when(F.col(c) != "", F.col(c))
    kept = res.data.select(F.col("ID").alias("key"), blank("NAME").alias("name"), blank("BRAND").alias("brand"),
                           F.lit("kept").alias("status"))
    lost = res.rejects.select(F.regexp_extract("raw", r"ID=(\d+)", 1).alias("key"), F.lit(None).cast("string").alias("name"),
                              F.lit(None).cast("string").alias("brand"), F.col("reason").alias("status"))
    return kept.unionByName(lost)


@register("fallback_delimiter_scan", """
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, 'read' AS status FROM supplier
UNION ALL SELECT DISTINCT NULL, NULL, 'no_wanted_columns' FROM supplier""")
def q_fallback_delimiter_scan(spark, sf_dir):
    """S5 (comma, then semicolon, by the header of each file) and P5 (a file
    without a wanted column is reported, not read)."""
    views(spark, sf_dir, "supplier")
    base = staging_dir(spark, "fallback")
    s = spark.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("x"))
    sinks.write_delimited(s.where("id % 2 = 0"), base, sep=",")
    sinks.write_delimited(s.where("id % 2 = 1").select("x", "name", "id"), base, sep=";", mode="append")
    sinks.write_delimited(s.select(F.col("x").alias("other"), F.col("x").alias("more")), base, sep=";", mode="append")
    res = readers.read_delimited(spark, [base], ["id", "name"], delimiters=(",", ";"), delimiter_mode="fallback")
    lost = res.rejects.select(F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("name"),
                              F.col("reason").alias("status")).distinct()  # one row per file of the sink
    return res.data.select("id", "name", F.lit("read").alias("status")).unionByName(lost)


@register("record_count_skips_wide", """
SELECT 'within the first line' AS kind, count(*) AS records FROM part WHERE p_partkey % 10 <> 0
UNION ALL SELECT 'all', count(*) FROM part""")
def q_record_count_skips_wide(spark, sf_dir):
    """Records with more cells than their file's first line are not counted."""
    views(spark, sf_dir, "part")
    base = staging_dir(spark, "counted")
    p = spark.table("part")
    wide = p.select((F.col("p_partkey") % 3).alias("part"), (F.col("p_partkey") % 10 == 0).alias("wide"), F.when(
        F.col("p_partkey") % 10 == 0, F.concat(F.lit("ID="), "p_partkey", F.lit("|A=1|B=2|C=3"))).otherwise(
        F.concat(F.lit("ID="), "p_partkey", F.lit("|A=1"))).alias("line"))
    # a narrow record opens each file
    _text_lines(wide.repartition("part").sortWithinPartitions("part", "wide").select("part", "line"), base, partition_by=["part"])
    roots = [f"{base}/part={k}" for k in range(3)]
    count = lambda kind, **how: jobs.run_record_count(spark, roots, pattern="*.csv", **how).select(
        F.lit(kind).alias("kind"), "records")
    return count("within the first line", skip_wide=True).unionByName(count("all"))


def _run_all_today(d):
    """Interactions of the run: one call per order, twice for some (removed as duplicates)."""
    return """SELECT 'x_agent ' || CAST(o_custkey % 50 AS STRING) || '_v' AS "Usuarios",
             '15/03/1997 ' || lpad(CAST(8 + o_orderkey % 12 AS STRING), 2, '0') || ':15' AS "Fecha",
             'Q' || CAST(o_orderkey % 3 AS STRING) AS "Cola", 'VOLVER A LLAMAR' AS "Conclusión",
             'K' || CAST(o_custkey AS STRING) AS "Identificación de contacto", 'Saliente' AS "Dirección",
             '569' || lpad(CAST(o_orderkey AS STRING), 8, '0') AS "DNIS" FROM orders""".replace(
        '"', "`" if d == "spark" else '"')


@register("run_all", f"""
WITH today AS ({_run_all_today('duckdb')}),
first AS (SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN 'first' ELSE 'second' END AS bucket
          FROM customer WHERE c_custkey % 3 <> 0)
SELECT 'consolidated' AS tbl, coalesce(bucket, 'No Encontrado') AS key, count(*) AS n
  FROM today LEFT JOIN first ON "Identificación de contacto" = 'K' || id GROUP BY ALL
UNION ALL SELECT 'accumulated', 'Q' || CAST(o_orderkey % 3 AS VARCHAR), count(*) FROM orders WHERE o_orderkey % 2 = 0 GROUP BY ALL
UNION ALL SELECT 'contact_base', 'rows', count(*) + count(*) FILTER (c_custkey % 2 = 0) FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT 'base_counts', 'main', count(*) FROM supplier
UNION ALL SELECT 'keyvalue_base', 'rows', count(*) FROM part
UNION ALL SELECT 'form_report', 'rows', count(*) FROM supplier
UNION ALL SELECT 'record_count', 'records', count(*) FROM part
UNION ALL SELECT 'rejects', 'too_wide', count(*) FROM nation
UNION ALL SELECT 'metrics', 'duplicates_removed', count(*) FROM orders WHERE o_orderkey % 4 = 0
UNION ALL SELECT 'metrics', 'resumed jobs', 5 FROM region WHERE r_regionkey = 0""")
def q_run_all(spark, sf_dir):
    """L1 to L8 as one run over raw folders, every written table read
    back: buckets by the first root that has the contact, accumulated rows
    under report headers, counts, rejects; a resumed run repeats no job."""
    views(spark, sf_dir, "orders", "customer", "supplier", "part", "nation", "region")
    base = staging_dir(spark, "run_all")
    today = spark.sql(_run_all_today("spark"))
    fields = lambda df: df.select(F.concat_ws(";", *[f"`{c}`" for c in today.columns]).alias("line"))
    again = today.where(F.right("DNIS", F.lit(8)).cast("long") % 4 == 0)
    body = union_all_by_name([fields(today), fields(again), spark.table("nation").select(
        F.concat_ws(";", *["n_name"] * 9).alias("line"))]).withColumn("part", F.crc32("line") % 2)
    _text_lines(_headed(body, ";".join(today.columns), 2), f"{base}/today", partition_by=["part"])
    past = today.withColumns({"Fecha": F.lit("03/03/1997 10:15"), "Conclusión": F.lit("C; ACEPTA AGENDA - MIGRACION")})
    even = spark.table("orders").where("o_orderkey % 2 = 0").select(
        F.concat(F.lit("569"), F.lpad(F.col("o_orderkey").cast("string"), 8, "0")).alias("DNIS"))
    sinks.write_delimited(past.join(even, "DNIS", "left_semi"), f"{base}/hist/1997/03. Marzo")
    contacts = lambda label, keep: sinks.write_delimited(spark.table("customer").where(keep).select(
        F.concat(F.lit("K"), "c_custkey").alias("inin-outbound-id"), F.lit(label).alias("Segment_of_Origin")), f"{base}/lists/{label}")
    contacts("second", "c_custkey % 3 <> 0")
    contacts("first", "c_custkey % 3 <> 0 and c_custkey % 2 = 0")
    sinks.write_delimited(spark.table("supplier").select("s_suppkey", "s_name"), f"{base}/bases")
    _text_lines(spark.table("part").select(F.concat(F.lit("ID="), "p_partkey", F.lit("|NAME="), "p_name").alias("line")),
                f"{base}/records", encoding="ISO-8859-1")
    out = f"{base}/out"
    stages = {"contact_roots": [f"{base}/lists/first", f"{base}/lists/second"], "contact_out": f"{out}/contact_base",
              "accumulated_root": f"{base}/hist", "accumulated_out": f"{out}/accumulated",
              "today_root": [f"{base}/today/part=0", f"{base}/today/part=1"], "consolidated_out": f"{out}/consolidated",
              "bases_root": f"{base}/bases", "keyvalue_roots": [f"{base}/records"], "keyvalue_pattern": "*.csv",
              "keyvalue_keys": ["ID", "NAME"], "keyvalue_out": f"{out}/keyvalue", "form_out": f"{out}/form",
              "form": spark.table("supplier").select(F.col("s_suppkey").alias("event_id"), F.lit("u").alias("user")),
              "report_headers": True, "state_out": f"{out}/state"}
    inputs = JobInputs(file_rules=((("PART",), "main"),), bucket_columns={"main": "main"})
    report = jobs.run_all(spark, as_of=AS_OF, stages=stages, inputs=inputs)
    resumed = jobs.run_all(spark, as_of=AS_OF, stages=stages, inputs=inputs, resume=True)
    skipped = sum(r.get("status") == "done before" for r in resumed.values())

    def counted(path, tbl, key):
        df = spark.read.parquet(f"{out}/{path}")
        return df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(tbl).alias("tbl"), "key", "n")

    rows = F.lit("rows")
    one = spark.table("region").where("r_regionkey = 0")
    metric = lambda key, n: one.select(F.lit("metrics").alias("tbl"), F.lit(key).alias("key"), F.lit(n).cast("long").alias("n"))
    return union_all_by_name([
        counted("consolidated/consolidated", "consolidated", F.col("Bucket")),
        counted("consolidated/accumulated", "accumulated", F.col("Cola")),
        counted("contact_base", "contact_base", rows),
        spark.read.parquet(f"{out}/consolidated/base_counts").select(
            F.lit("base_counts").alias("tbl"), F.lit("main").alias("key"), F.col("main").alias("n")),
        counted("keyvalue", "keyvalue_base", rows), counted("form/form_report", "form_report", rows),
        spark.read.parquet(f"{out}/form/record_count").select(
            F.lit("record_count").alias("tbl"), F.lit("records").alias("key"), F.col("records").alias("n")),
        counted("consolidated_rejects", "rejects", F.col("reason")),
        metric("duplicates_removed", report["consolidated_metrics"]["duplicates_removed"]), metric("resumed jobs", skipped)])
