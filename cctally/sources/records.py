"""Records of delimited text by a quote-state machine.

A quote opens a field only as the field's first character; elsewhere (an inch
mark) it is text. Within a quoted field two quotes are one; a single one ends
the quoting, and the field goes on to the next separator. ``quote_state``
folds this rule over the parts of a line between separators, in time linear in
its length, so a line needs no regular expression over quotes.

``read_records`` joins the lines of quoted line breaks. What a line does to
the state "within quotes" is one of four things: close it, open it, keep it or
flip it. The state after a line is that of the last closing or opening line
before, flipped once per flip since: window sums over the lines of a file
split, then over one row per split. A file with quoted line breaks is
therefore still read in splits. Records of one line never move to be
assembled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import staging_dir

QUOTE = '"'
#: A quoted field that runs over more lines was never closed: its lines are rejected one by one.
MAX_RECORD_LINES = 100_000


def _parts(line: Column, sep: str) -> Column:
    return F.split(line, "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E", -1)


def _lone_quote(text: Column) -> Column:
    return F.contains(F.replace(text, F.lit(QUOTE * 2), F.lit("")), F.lit(QUOTE))


def quote_state(line: Column, sep: str, within: bool = False) -> Column:
    """``struct(open, n)`` after a line that begins within quotes or not: state, and fields begun in it."""
    def step(state: Column, part: Column) -> Column:
        begins = part.startswith(QUOTE) & ~_lone_quote(F.substr(part, F.lit(2)))
        return F.struct(F.when(state["open"], ~_lone_quote(part)).otherwise(begins).alias("open"),
                        (state["n"] + F.when(state["open"], 0).otherwise(1)).alias("n"))
    return F.aggregate(_parts(line, sep), F.struct(F.lit(within).alias("open"), F.lit(0).alias("n")), step)


def field_count(record: Column, sep: str) -> Column:
    """Fields of a whole record; separators within quotes do not count."""
    return F.when(F.contains(record, F.lit(QUOTE)), quote_state(record, sep)["n"]).otherwise(F.size(_parts(record, sep)))


def ends_open(line: Column, sep: str) -> Column:
    """True when a line that begins outside quotes ends within them: its record goes on."""
    return F.contains(line, F.lit(QUOTE)) & quote_state(line, sep)["open"]


def _resolve(fixed: Column, odd: Column, start: Column) -> Column:
    return F.when(odd, ~F.coalesce(fixed, start)).otherwise(F.coalesce(fixed, start))


def read_records(spark: SparkSession, files: Sequence[str], sep: str, decode, name: Column, order: Column,
                 ignore_corrupt: bool = False, max_lines: int = MAX_RECORD_LINES) -> tuple[DataFrame, DataFrame]:
    """(records, lines of quotes that are never closed) of files with quoted line breaks, header records left out.

    ``record, name, ord`` and ``name, line``. Line breaks within quotes are
    kept as they are; a carriage return before the line break that ends a
    record is not part of it. Blank records are dropped, as in a plain scan.
    """
    raw = (
        spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", ignore_corrupt).text(list(files))
        .select(decode(F.col("value")).alias("line"), name.alias("name"), order.alias("ord"))
        .withColumns({"file": F.col("ord.file"), "block": F.col("ord.block"), "row": F.col("ord.row")})
    )
    quoted = F.contains("line", F.lit(QUOTE))
    from_closed = quoted & quote_state(F.col("line"), sep)["open"]
    from_open = F.when(quoted, quote_state(F.col("line"), sep, within=True)["open"]).otherwise(True)
    raw = raw.withColumns({"c": from_closed, "o": from_open})
    raw = raw.withColumns({"fixed": F.when(F.col("c") == F.col("o"), F.col("c")),
                           "flip": (F.col("c") & ~F.col("o")).cast("int")}).drop("c", "o")
    lines = Window.partitionBy("file", "block").orderBy("row")
    so_far = lines.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips = F.sum("flip").over(so_far)
    raw = raw.withColumn("flips", flips).withColumn("at_set", F.when(F.col("fixed").isNotNull(), F.col("flips")))
    raw = raw.withColumns({
        "set_to": F.last("fixed", ignorenulls=True).over(so_far),
        "odd": (F.col("flips") - F.coalesce(F.last("at_set", ignorenulls=True).over(so_far), F.lit(0))) % 2 == 1})
    raw = raw.withColumns({"set_before": F.lag("set_to").over(lines), "odd_before": F.coalesce(F.lag("odd").over(lines), F.lit(False)),
                           "is_last": F.lead("row").over(lines).isNull()}).drop("fixed", "flip", "flips", "at_set")
    path = staging_dir(spark, "quoted_lines")
    raw.write.parquet(path)
    raw = spark.read.schema(raw.schema).parquet(path)

    # the state at the start of each split: one row per split
    splits = raw.filter("is_last").select("file", "block", F.col("set_to").alias("fixed"), F.col("odd").cast("int").alias("odd_"))
    order_of = Window.partitionBy("file").orderBy("block")
    upto = order_of.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    splits = splits.withColumn("sum_", F.sum("odd_").over(upto))
    # a split with a fixed state ends in it, flipped if ``odd_``; later flips add to that
    splits = splits.withColumns({
        "fixed_end": F.last(F.when(F.col("fixed").isNotNull(), F.col("fixed") != (F.col("odd_") == 1)), ignorenulls=True).over(upto),
        "sum_at": F.coalesce(F.last(F.when(F.col("fixed").isNotNull(), F.col("sum_")), ignorenulls=True).over(upto), F.lit(0))})
    after = _resolve(F.col("fixed_end"), (F.col("sum_") - F.col("sum_at")) % 2 == 1, F.lit(False))
    splits = splits.select("file", "block", after.alias("open_after")).withColumn(
        "open_at_start", F.coalesce(F.lag("open_after").over(order_of), F.lit(False)))
    start = F.col("open_at_start")
    placed = raw.join(F.broadcast(splits.select("file", "block", "open_at_start")), ["file", "block"])
    placed = placed.withColumns({"before": _resolve(F.col("set_before"), F.col("odd_before"), start),
                                 "after": _resolve(F.col("set_to"), F.col("odd"), start)})
    # a line outside quotes begins a record; records are numbered per split, the splits by their sums
    begins = (~F.col("before")).cast("long")
    placed = placed.withColumn("local", F.sum(begins).over(so_far))
    sums = placed.groupBy("file", "block").agg(F.sum(begins).alias("n")).withColumn(
        "offset", F.coalesce(F.sum("n").over(order_of.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = placed.join(F.broadcast(sums.select("file", "block", "offset")), ["file", "block"]).withColumn(
        "number", F.col("offset") + F.col("local"))
    head = placed.filter(~F.col("before") & (F.trim(F.regexp_replace("line", "[\\x{feff}\r]", "")) != "")) \
        .groupBy("file").agg(F.min("number").alias("head"))  # one row per file
    placed = placed.join(F.broadcast(head), "file").filter("number > head").select(
        "name", "file", "ord", "line", "before", "after", "number")
    single = placed.filter("not before and not after").select("line", "name", "ord")
    parts = placed.filter("before or after")
    sizes = parts.groupBy("file", "number").agg(F.count(F.lit(1)).alias("lines"), F.bool_and("after").alias("never_closed"))
    parts = parts.join(sizes, ["file", "number"])
    whole = ~F.col("never_closed") & (F.col("lines") <= max_lines)
    joined = parts.filter(whole).groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("ord", "line", "name"))).alias("rows")).select(
        F.array_join(F.transform("rows", lambda r: r["line"]), "\n").alias("line"),
        F.col("rows")[0]["name"].alias("name"), F.col("rows")[0]["ord"].alias("ord"))
    records = single.unionByName(joined).withColumn(
        "record", F.when(F.endswith("line", F.lit("\r")), F.left("line", F.length("line") - 1)).otherwise(F.col("line")))
    return records.filter(F.trim("record") != "").select("record", "name", "ord"), parts.filter(~whole).select("name", "line")
