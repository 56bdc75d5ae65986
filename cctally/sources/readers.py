"""Folder readers for untidy exports: S1-S16, P1-P5, N2.

``read_delimited`` is a text-first reader.  One distributed pass over the
raw lines decides, per file, the encoding (UTF-8 unless some line is not
valid UTF-8, then Latin-1: S4) and the header line.  The driver receives one
small row per file (file listing metadata, never data rows), picks each
file's delimiter (fixed S3, fallback S5 or sniffed S6) and groups files by
(encoding, delimiter, header).  Each group is then read by Spark's CSV
source with an all-string schema one column wider than its header, so rows
that are too wide are caught (S7) and routed to a reject table (S8) while
short rows are null-padded.  Groups are unioned by name (U1), so files with
reordered or missing columns line up (mixed headers in one plain CSV read
would be silently misaligned).
"""

from __future__ import annotations

import csv
import fnmatch
import io
import re
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import NA_TOKENS
from ..operators.project import dedupe_names, normalize_header, union_all_by_name
from ..session import staging_dir
from .records import ends_open, field_count, read_records

SNIFF_CANDIDATES = (",", ";", "\t", "|")
LATIN1 = "ISO-8859-1"
UTF8 = "UTF-8"
FILE_COL = "Origen_Archivo"
ORD_COL = "_ord"
REASON_COL = "_reason"
RAW_COL = "_reject"


@dataclass
class ReadResult:
    """Rows read, rejected rows and the per-file decisions.

    ``parsed`` holds both kinds as one plan (``_reason`` is null for rows that
    are kept), for ``land`` to write in one pass.
    """
    data: DataFrame | None
    rejects: DataFrame | None
    files: list[dict]
    parsed: DataFrame | None = None

    @property
    def empty(self) -> bool:
        return self.data is None


# --- listing (S1, S2, U2) -------------------------------------------------------

def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def existing_roots(spark: SparkSession, roots: Iterable[str]) -> list[str]:
    """The root folders that exist (a missing month folder is empty)."""
    return [r for r in roots if _fs_exists(spark, r)]


def list_names(spark: SparkSession, root: str) -> list[tuple[str, str]]:
    """(path, name) of the plain files right below a folder, in order; a file is its own only entry."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted((s.getPath().toString(), s.getPath().getName()) for s in fs.listStatus(path) if s.isFile())


def _same_path(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def root_paths(spark: SparkSession, roots: Sequence[str]) -> list[str]:
    """The roots as the file system names them in the paths of their files."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(r) for r in roots]
    return [p.getFileSystem(conf).makeQualified(p).toString() for p in paths]


def source_order(roots: Sequence[str]) -> F.Column:
    """Place of a row in its input -- rank of its root, file, split, row: a total order.

    Roots rank in the order in which they were given, so the first root wins
    a keep-first step; the order is a plain value that outlives a written table.
    """
    path = F.regexp_replace(_decoded(F.col("_metadata.file_path")), "^file:/+", "/")
    rank = F.lit(len(roots))
    for k, root in reversed(list(enumerate(roots))):
        root = re.sub("^file:/+", "/", root).rstrip("/")
        rank = F.when(path.startswith(root + "/") | (path == root), F.lit(k)).otherwise(rank)
    return F.struct(rank.alias("root"), F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def _decoded(c: F.Column) -> F.Column:
    # ``_metadata`` paths are URL-encoded; a literal '+' must survive decoding
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def file_name_col() -> F.Column:
    """Base name of the source file."""
    return _decoded(F.col("_metadata.file_name"))


def decode_line(value: F.Column, utf8_ok: F.Column) -> F.Column:
    """Keep UTF-8 text, re-decode other files' bytes as Latin-1."""
    return F.when(utf8_ok, value).otherwise(F.decode(value.cast("binary"), LATIN1))


def scan_file_heads(spark: SparkSession, roots: Sequence[str], pattern: str,
                    check_utf8: bool = True, fixed_encoding: str | None = None,
                    ignore_corrupt: bool = False, delimiters: Sequence[str] = ()) -> list[dict]:
    """Per file: UTF-8 validity, first line that is not blank, and the delimiters that leave a line within quotes.

    The pass over all lines aggregates fixed-width values only (row ids and
    flags), so it is a hash aggregate without a sort. A second look at the
    first split of each file fetches the text of its first line by row id.
    Returns one small dict per file that has a line; ``head`` is None when all are blank.
    """
    lines = (
        spark.read.option("pathGlobFilter", pattern).option("ignoreCorruptFiles", ignore_corrupt)
        .text([escape_glob(r) for r in roots])
        .select(
            F.col("value"),
            _decoded(F.col("_metadata.file_path")).alias("path"),
            file_name_col().alias("name"),
            F.col("_metadata.file_block_start").alias("blk"),
            F.monotonically_increasing_id().alias("mid"),
        )
    )
    text = F.col("value")
    printed = F.trim(F.regexp_replace(F.left(text, F.lit(4096)), "^\ufeff", "")) != ""
    valid = F.bool_and(F.is_valid_utf8(text)) if check_utf8 else F.lit(True)
    files = lines.groupBy("path", "name").agg(
        valid.alias("utf8"), F.min(F.when(printed & (F.col("blk") == 0), F.col("mid"))).alias("first"),
        *[F.bool_or(ends_open(text, d)).alias(f"open_{k}") for k, d in enumerate(delimiters)])
    # one row per file, which the driver lists in any case
    found = [r.asDict() for r in files.collect()]
    places = [(r["path"], r["first"]) for r in found if r["first"] is not None]
    heads = {}
    if places:
        first = spark.createDataFrame(places, "path string, mid long")
        found_lines = lines.join(F.broadcast(first), ["path", "mid"]).select("path", F.col("value").cast("binary").alias("head"))
        heads = {r["path"]: bytes(r["head"]) for r in found_lines.collect()}
    out = []
    for r in found:
        head = heads.get(r["path"])
        code = fixed_encoding or (UTF8 if r["utf8"] else LATIN1)
        out.append({"path": r["path"], "name": r["name"], "utf8": r["utf8"],
                    "head": None if head is None else head.decode(code, "replace"),
                    "open": {d for k, d in enumerate(delimiters) if r[f"open_{k}"]}})
    return out


_GLOB_CHARS = "\\*?[]{}"


def escape_glob(path: str) -> str:
    """A listed file path as a literal for ``spark.read`` (which treats every
    path as a Hadoop glob): glob characters get a backslash."""
    return "".join("\\" + ch if ch in _GLOB_CHARS else ch for ch in path)


# --- per-file decisions (S5, S6, P1-P3, P5) ----------------------------------------

def split_header(line: str, sep: str) -> list[str]:
    line = (line or "").lstrip("﻿")
    return next(csv.reader(io.StringIO(line), delimiter=sep, quotechar='"'), [])


def choose_delimiter(line: str, mode: str, delimiters: Sequence[str]) -> str:
    """S3 ``fixed``: the first delimiter.  S5 ``fallback``: the first whose
    header split gives more than one column, else the last.  S6 ``sniff``:
    the candidate giving the most header fields (ties: first listed)."""
    if mode == "fixed":
        return delimiters[0]
    if mode == "fallback":
        for d in delimiters:
            if len(split_header(line, d)) > 1:
                return d
        return delimiters[-1]
    if mode == "sniff":
        best, best_n = delimiters[0], -1
        for d in delimiters:
            n = len(split_header(line, d))
            if n > best_n:
                best, best_n = d, n
        return best
    raise ValueError(f"unknown delimiter mode {mode!r}")


def clean_header(fields: Sequence[str], deep: bool, rename: Mapping[str, str] | None) -> list[str]:
    rename = rename or {}
    names = [normalize_header(f, deep=deep) for f in fields]
    return dedupe_names([rename.get(n, n) for n in names])


# --- the reader -------------------------------------------------------------------

def _read_group(spark: SparkSession, files: list[str], enc: str, sep: str, names: list[str],
                wanted: Sequence[str] | None, na_tokens: Sequence[str] | None,
                flag_columns: Sequence[str] = (), multi_line: bool = False,
                ignore_corrupt: bool = False, roots: Sequence[str] = ()):
    """Rows and rejects of files with one header: a CSV scan, or whole records where lines break within quotes."""
    width = len(names)
    fields = [StructField(f"_c{i}", StringType()) for i in range(width)]
    order = source_order(roots)
    if multi_line:
        decode = (lambda v: v) if enc.upper().replace("_", "-") in ("UTF-8", "UTF8") else (
            lambda v: F.decode(v.cast("binary"), enc))
        found, unclosed = read_records(spark, files, sep, decode, file_name_col(), order, ignore_corrupt)
        schema = ", ".join(f"{f.name} STRING" for f in fields)
        options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
        raw = found.withColumn("_wide", field_count(F.col("record"), sep) > width).select(
            F.from_csv("record", schema, options).alias("fields"), F.col("record").alias("_raw"), "_wide",
            F.col("name").alias(FILE_COL), F.col("ord").alias(ORD_COL)).select(
            *[F.col(f"fields.{f.name}").alias(f.name) for f in fields], "_raw", "_wide", FILE_COL, ORD_COL)
        lost = unclosed.select(F.lit("open_quote").alias(REASON_COL), F.col("line").alias(RAW_COL),
                               F.col("name").alias(FILE_COL), F.lit(None).cast(raw.schema[ORD_COL].dataType).alias(ORD_COL))
    else:
        raw = (
            spark.read.schema(StructType([*fields, StructField("_raw", StringType())]))
            .option("columnNameOfCorruptRecord", "_raw")
            .option("header", True).option("enforceSchema", True)
            .option("sep", sep).option("encoding", enc).option("quote", '"').option("escape", '"')
            .option("mode", "PERMISSIVE").option("ignoreCorruptFiles", ignore_corrupt)
            .csv(files)
            .select("*", file_name_col().alias(FILE_COL), order.alias(ORD_COL))
        )
        # Spark keeps the untouched line of a row whose number of fields is not the header's;
        # every field is asked for: Spark counts a row's fields against the columns it reads
        asked = F.length(F.concat_ws("", *[F.col(f.name) for f in fields])) >= 0
        raw = raw.withColumn("_wide", F.when(F.col("_raw").isNull(), False).otherwise(
            field_count(F.col("_raw"), sep) > width) & asked)
        lost = None
    keep = [i for i, n in enumerate(names) if wanted is None or n in wanted]
    cols = []
    for i in keep:
        c = F.col(f"_c{i}")
        if na_tokens:
            c = F.when(~c.isin(list(na_tokens)), c)
        cols.append(c.alias(names[i]))
    flags = [F.lit(c in names).alias(f"_has_{c}") for c in flag_columns]
    wide = F.col("_wide")
    parsed = raw.select(*cols, *flags, F.when(wide, F.lit("too_wide")).alias(REASON_COL),
                        F.when(wide, F.col("_raw")).alias(RAW_COL), F.col(FILE_COL), F.col(ORD_COL))
    return parsed if lost is None else parsed.unionByName(lost, allowMissingColumns=True)


def _unread(spark: SparkSession, roots: Sequence[str], pattern: str, seen: set[str]) -> list[dict]:
    """Files of the folders that look wanted but were not scanned, with the reason.

    Spark leaves out names that begin with ``_`` or ``.``, names that match
    the pattern only without regard to case, and files without a line.
    """
    out = []
    for root in roots:
        for path, name in list_names(spark, root):
            if _same_path(path) in seen or not fnmatch.fnmatchcase(name.lower(), pattern.lower()):
                continue
            hidden = name.startswith(("_", "."))
            status = "hidden_name" if hidden else "empty" if fnmatch.fnmatchcase(name, pattern) else "name_case"
            out.append({"file": name, "status": status, "header": None})
    return out


def read_delimited(spark: SparkSession, roots: Sequence[str] | str, wanted: Sequence[str] | None = None,
                   *, pattern: str = "*.csv", delimiters: Sequence[str] = (";",),
                   delimiter_mode: str = "fixed", deep_headers: bool = False,
                   rename: Mapping[str, str] | None = None,
                   na_tokens: Sequence[str] | None = NA_TOKENS,
                   flag_columns: Sequence[str] = (),
                   encodings: Sequence[str] = (UTF8, LATIN1),
                   multi_line: bool = False, ignore_corrupt_files: bool = False) -> ReadResult:
    """Read every matching file under the
    roots into one all-string DataFrame.

    ``flag_columns`` adds a boolean ``_has_<name>`` per row telling whether
    the row's file had that column at all (null value vs absent column).
    ``encodings``: (UTF-8, fallback) decides per file by a whole-file
    validity check (S4); a single encoding skips the check.
    Files with a line break within quotes are found in the same pass and read
    by records, still in splits (``records.read_records``); ``multi_line=True``
    reads every file so.
    ``ignore_corrupt_files`` skips unreadable files/blocks (S8) instead of
    failing the job.  Files without any wanted column appear in the reject
    table with reason ``no_wanted_columns`` (P5).

    Output columns: the wanted columns present in at least one file (null
    where a file lacks them), ``Origen_Archivo`` (file name) and ``_ord``
    (file path, split start, row id: a total order for keep-first steps).
    Files holding none of the wanted columns are reported, not read (P5).
    Returns ``ReadResult(data=None, ...)`` when nothing is readable (S16).
    """
    if isinstance(roots, str):
        roots = [roots]
    roots = existing_roots(spark, roots)
    if not roots:
        return ReadResult(None, None, [])
    detect = len(encodings) > 1
    if detect and encodings[0].upper().replace("_", "-") not in ("UTF-8", "UTF8"):
        raise ValueError("encoding detection needs UTF-8 first, then the fallback")
    heads = scan_file_heads(spark, roots, pattern, check_utf8=detect,
                            fixed_encoding=None if detect else encodings[0],
                            ignore_corrupt=ignore_corrupt_files, delimiters=delimiters)
    seen = {_same_path(h["path"]) for h in heads}
    qualified = root_paths(spark, roots)
    groups: dict[tuple, list[str]] = defaultdict(list)
    report = _unread(spark, roots, pattern, seen)
    for h in sorted(heads, key=lambda r: r["path"]):
        if h["head"] is None:
            report.append({"file": h["name"], "status": "blank", "header": None})
            continue
        if not detect:
            enc = encodings[0]
        else:
            enc = encodings[0] if h["utf8"] else encodings[1]
        sep = choose_delimiter(h["head"], delimiter_mode, delimiters)
        names = clean_header(split_header(h["head"], sep), deep_headers, rename)
        present = [n for n in names if wanted is None or n in wanted]
        status = "read" if present else "no_wanted_columns"
        report.append({"file": h["name"], "encoding": enc, "delimiter": sep,
                       "columns": len(names), "status": status, "header": h["head"]})
        if present:
            groups[(enc, sep, tuple(names), multi_line or sep in h["open"])].append(escape_glob(h["path"]))
    if not groups:
        return ReadResult(None, None, report)
    parsed = union_all_by_name([
        _read_group(spark, files, enc, sep, list(names), wanted, na_tokens, flag_columns, by_record,
                    ignore_corrupt_files, qualified)
        for (enc, sep, names, by_record), files in sorted(groups.items())])
    order = [c for c in (wanted or parsed.columns) if c in parsed.columns and c not in (
        REASON_COL, RAW_COL, FILE_COL, ORD_COL, *[f"_has_{f}" for f in flag_columns])]
    parsed = parsed.select(*[F.col(f"`{c}`") for c in order], *[f"_has_{c}" for c in flag_columns], FILE_COL, ORD_COL,
                           REASON_COL, RAW_COL)
    skipped = [(f["file"], f["status"], f["header"]) for f in report if f["status"] != "read"]
    if skipped:
        # one row per skipped file (bounded by the file listing)
        files = spark.createDataFrame(skipped, f"`{FILE_COL}` string, {REASON_COL} string, {RAW_COL} string")
        parsed = parsed.unionByName(files, allowMissingColumns=True)
    return ReadResult(_kept(parsed), _rejected(parsed), report, parsed)


def _kept(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REASON_COL).isNull()).drop(REASON_COL, RAW_COL)


def _rejected(parsed: DataFrame) -> DataFrame:
    """``file, reason, raw`` of rejected rows and of files that were not read."""
    return parsed.where(F.col(REASON_COL).isNotNull()).select(
        F.col(FILE_COL).alias("file"), F.col(REASON_COL).alias("reason"), F.col(RAW_COL).alias("raw"))


@dataclass
class Landed:
    """A parsed input, written once: rows, rejects (M1: and how many of each)."""
    rows: DataFrame
    rejects: DataFrame
    n_rows: int
    n_rejected: int


def land(result: ReadResult) -> Landed:
    """One parse that writes rows and rejects as two partitions of one dataset, counted on the way.

    What follows reads the written rows, so source order (``_ord``) is a plain
    value, a lost executor re-reads files, and no input is scanned again to
    count or write its rejects.
    """
    parsed = result.parsed
    spark = parsed.sparkSession
    seen = Observation("landed")
    bad = F.col(REASON_COL).isNotNull()
    path = staging_dir(spark, "landed")
    parsed.withColumn("_kind", F.when(bad, "rejects").otherwise("rows")).observe(
        seen, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected")).write.partitionBy("_kind").parquet(path)
    written = spark.read.schema(parsed.withColumn("_kind", F.lit("")).schema).parquet(path)
    part = lambda kind: written.where(F.col("_kind") == kind).drop("_kind")  # noqa: E731  (one folder is read)
    counts = seen.get
    return Landed(_kept(part("rows")), _rejected(part("rejects")), counts["rows"], counts["rejected"])


# --- key=value records (S9, S10, X14, F6) -----------------------------------------------

def read_keyvalue_lines(spark: SparkSession, roots: Sequence[str] | str, *, pattern: str = "*.rsl",
                        encoding: str = LATIN1, drop_first_line: bool = False) -> DataFrame | None:
    """Raw decoded lines with file name and order (blank lines dropped)."""
    if isinstance(roots, str):
        roots = [roots]
    roots = existing_roots(spark, roots)
    if not roots:
        return None
    line = F.col("value") if encoding.upper() in ("UTF-8", "UTF8") else F.decode(F.col("value").cast("binary"), encoding)
    lines = (
        spark.read.option("pathGlobFilter", pattern).text([escape_glob(r) for r in roots])
        .select(
            line.alias("line"),
            file_name_col().alias(FILE_COL),
            source_order(root_paths(spark, roots)).alias(ORD_COL),
        )
    )
    if drop_first_line:
        # the first line of each file: one small row per file, broadcast back
        from ..operators.lookup import guarded_broadcast
        firsts = lines.groupBy(F.col(f"{ORD_COL}.file").alias("__f")).agg(F.min(ORD_COL).alias("__first"))
        firsts = guarded_broadcast(firsts)      # one row per file
        lines = lines.join(firsts, F.col(ORD_COL) == F.col("__first"), "left_anti")
    return lines.where(F.length(F.trim("line")) > 0)


def parse_pairs(line: F.Column, pair_sep: str = "|", kv_sep: str = "=") -> F.Column:
    """``k1=v1|k2=v2`` -> array<struct<k, v>>; each cell splits at its
    first ``kv_sep``; a cell without it has a null key and the cell as value."""
    import re as _re
    cells = F.split(line, _re.escape(pair_sep), -1)
    return F.transform(
        cells,
        lambda c: F.struct(
            F.when(F.instr(c, kv_sep) > 0, F.substring_index(c, kv_sep, 1)).alias("k"),
            F.when(F.instr(c, kv_sep) > 0, F.substr(c, F.instr(c, kv_sep) + F.lit(len(kv_sep)))).otherwise(c).alias("v"),
        ),
    )


def keyvalue_keys(pairs: DataFrame, col: str = "pairs") -> list[str]:
    """The distinct keys (a distributed distinct; only names reach the
    driver), in order of first appearance."""
    ks = (pairs.select(F.posexplode(col).alias("pos", "p"), F.col(ORD_COL))
          .where(F.col("p.k").isNotNull())
          .groupBy(F.col("p.k").alias("k"))
          .agg(F.min(F.struct(F.col(ORD_COL), F.col("pos"))).alias("first")))
    return [r["k"] for r in ks.orderBy("first").collect()]


def read_keyvalue(spark: SparkSession, roots, keys: Sequence[str] | None = None, *,
                  pattern: str = "*.rsl", pair_sep: str = "|", kv_sep: str = "=",
                  encoding: str = LATIN1, drop_first_line: bool = False,
                  drop_header_rows: bool = True) -> DataFrame | None:
    """key=value records parsed by key (Q21), one column
    per key (declared, or discovered when ``keys`` is None) plus
    ``Origen_Archivo``.  A key's value is the text after the first ``=`` of
    its first cell.  Rows whose first column holds its own name (repeated
    header lines) are dropped; null there is kept."""
    res = read_keyvalue_parsed(spark, roots, keys, pattern=pattern, pair_sep=pair_sep, kv_sep=kv_sep, encoding=encoding,
                               drop_first_line=drop_first_line, drop_header_rows=drop_header_rows)
    return res.data


def read_keyvalue_parsed(spark: SparkSession, roots, keys: Sequence[str] | None = None, *,
                         pattern: str = "*.rsl", pair_sep: str = "|", kv_sep: str = "=",
                         encoding: str = LATIN1, drop_first_line: bool = False,
                         drop_header_rows: bool = True) -> ReadResult:
    """``read_keyvalue`` with its rejects, as one plan.

    A key's value is that of its first cell. A cell
    without ``=`` (X14: its value is the whole cell) belongs to the key at its
    place among the keys, unless the record names that key elsewhere. A line of
    bare cells that are all key names, or hold all key names, is a header. Nothing else is lost: a bare
    cell without a place and a key that is not wanted send a copy of the line
    to the rejects (``bare_cell``, ``unknown_key``), the row itself stays; a
    line that fills no key is rejected (``no_key``).
    """
    lines = read_keyvalue_lines(spark, roots, pattern=pattern, encoding=encoding,
                                drop_first_line=drop_first_line)
    if lines is None:
        return ReadResult(None, None, [])
    pairs = lines.select("line", parse_pairs(F.col("line"), pair_sep, kv_sep).alias("pairs"), FILE_COL, ORD_COL)
    if keys is None:
        keys = keyvalue_keys(pairs)
    if not keys:
        return ReadResult(None, None, [])
    keys = list(keys)
    names = F.array(*[F.lit(k) for k in keys])
    cells = pairs.withColumns({"at": F.transform("pairs", lambda p: p["k"])})

    def value_of(i: int, key: str) -> F.Column:
        """The first cell of the key, else the bare cell at its place."""
        cell = F.try_element_at("pairs", F.lit(i + 1))
        named = F.try_element_at(F.filter("pairs", lambda p: p["k"] == F.lit(key)), F.lit(1))
        return F.coalesce(named, F.when(cell["k"].isNull(), cell))["v"]

    value = {k: value_of(i, k) for i, k in enumerate(keys)}
    named_at = lambda i: F.coalesce(F.array_contains("at", F.try_element_at(names, i + 1)), F.lit(False))
    homeless = F.exists("placed", lambda p: p["k"].isNull() & (F.trim(p["v"]) != "") & (
        (p["i"] >= len(keys)) | named_at(p["i"])))
    cells = cells.withColumn("placed", F.transform("pairs", lambda p, i: F.struct(p["k"].alias("k"), p["v"].alias("v"), i.alias("i"))))
    bare_line = F.forall("pairs", lambda p: p["k"].isNull())
    texts = F.transform("pairs", lambda p: F.trim(p["v"]))
    header = bare_line & (F.forall(texts, lambda t: F.array_contains(names, t))
                          | (F.size(F.array_except(names, texts)) == 0))
    cells = cells.where(~header) if drop_header_rows else cells
    out = cells.select(*[v.alias(k) for k, v in value.items()], FILE_COL, ORD_COL, "line",
                       F.when(homeless, "bare_cell").when(
                           F.exists("at", lambda k: k.isNotNull() & ~F.array_contains(names, k)), "unknown_key").alias("_odd"))
    empty = F.lit(True)
    for k in keys:
        empty = empty & F.col(f"`{k}`").isNull()
    if drop_header_rows:
        out = out.where(empty | ~F.col(f"`{keys[0]}`").eqNullSafe(F.lit(keys[0])))
    kept = out.where(~empty).drop("line", "_odd")
    reason = F.when(empty, "no_key").otherwise(F.col("_odd"))
    rejects = out.select(F.col(FILE_COL).alias("file"), reason.alias("reason"), F.col("line").alias("raw")).where(
        "reason IS NOT NULL")
    return ReadResult(kept, rejects, [])


# --- dimensions and staged tables (S11-S13, S15) -------------------------------------------

def read_dimension(spark: SparkSession, path: str, *, fmt: str = "parquet", schema=None,
                   infer: bool = False, sep: str = ",", deep_headers: bool = True,
                   rename: Mapping[str, str] | None = None,
                   na_tokens: Sequence[str] | None = NA_TOKENS) -> DataFrame:
    """A staged dimension (Parquet, or CSV read all-string, with a
    declared schema, or with inferred types); headers cleaned (P2), NA
    tokens nulled in string columns (N2)."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "csv":
        r = spark.read.option("header", True).option("sep", sep)
        if schema is not None:
            r = r.schema(schema).option("enforceSchema", True)
        elif infer:
            r = r.option("inferSchema", True)
        df = r.csv(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    names = clean_header(df.columns, deep_headers, rename)
    df = df.toDF(*names)
    if na_tokens:
        df = df.select(*[
            (F.when(~F.col(f"`{f.name}`").isin(list(na_tokens)), F.col(f"`{f.name}`")).alias(f.name)
             if isinstance(f.dataType, StringType) else F.col(f"`{f.name}`"))
            for f in df.schema.fields
        ])
    return df


def _fs_bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return int(p.getFileSystem(conf).getContentSummary(p).getLength())


def read_table(spark: SparkSession, path: str, *, fmt: str = "parquet",
               min_partitions: int | None = None, min_split_bytes: int = 1 << 20) -> DataFrame:
    """A staged table.  When it arrives in fewer splits than the cluster has
    cores (one file, one row group) and those splits are big (more than
    ``min_split_bytes`` each), it is spread round-robin so the per-row work
    uses every core.  A small table (a dimension) stays as scanned, and a
    large input already has enough splits: no shuffle in either case."""
    df = spark.read.format(fmt).load(path)
    want = min_partitions if min_partitions is not None else spark.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()
    if have < want and _fs_bytes(spark, path) > min_split_bytes * have:
        df = df.repartition(want)
    return df


def read_optional(spark: SparkSession, path: str, *, sep: str = ";",
                  notice_col: str = "Aviso", notice: str = "previous output not found") -> DataFrame:
    """A previous job's ``;`` output if it exists, else a one-row notice."""
    if _fs_exists(spark, path):
        return spark.read.option("header", True).option("sep", sep).csv(path)
    return spark.createDataFrame([(notice,)], StructType([StructField(notice_col, StringType())]))


def month_partition_filter(as_of, year_col: str = "year", month_col: str = "month") -> F.Column:
    """S2 for staged data laid out ``year=/month=``: a partition filter on the
    month of ``as_of`` and the month before; the scan prunes every other
    folder (``PartitionFilters`` in the plan)."""
    from ..functions.dates import month_starts
    cur, prev = month_starts(as_of)
    ym = F.col(year_col) * 100 + F.col(month_col)
    return ym.isin(cur.year * 100 + cur.month, prev.year * 100 + prev.month)


def read_month_partitions(spark: SparkSession, root: str, as_of, fmt: str = "parquet") -> DataFrame:
    """The two months of ``as_of`` from a ``year=/month=`` dataset."""
    return spark.read.format(fmt).load(root).where(month_partition_filter(as_of))
