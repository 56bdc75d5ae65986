"""The reporting jobs: L1-L9.

Each job is a DataFrame -> DataFrame function over already-read inputs
(``interactions``, ``staffing``, ...) with internal column names (see
``cctally.schemas``), plus a ``run_*`` wrapper that reads folders and
writes outputs.  Every job is one lazy plan: narrow per-row expressions,
left lookups whose dimension side is first reduced to one row per key
(broadcast when its checked size allows), and at most one shuffle of the
fact for the keep-first dedup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import dates as D
from ..functions import rules as R
from ..functions import text as T
from ..operators import counts as A
from ..operators.dedup import keep_first
from ..operators.lookup import fallback_lookup, hot_keys_of, lookup, prove_small
from ..operators.project import drop_present, fixed_order
from ..sources import readers, sinks
from . import rules_config as C
from .rules_config import JobInputs


def _c(name: str):
    return F.col(f"`{name}`")


def with_columns_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """A wanted column that no input file had is a null column (this replaces
    the reference's per-column ``if col in df`` guards)."""
    missing = [n for n in names if n not in df.columns]
    return df.withColumns({n: F.lit(None).cast("string") for n in missing}) if missing else df


ACCUMULATED_INPUT = ("user", "date_text", "phone_in", "queue", "conclusion", "contact_id", "source_file")
CONSOLIDATED_INPUT = ("user", "date_text", "direction", "dnis", "queue", "conclusion", "contact_id",
                      "campaign", "source_file")


# --- L1 accumulated contacts ------------------------------------------------------

def accumulated_contacts(interactions: DataFrame, staffing: DataFrame | None, *, as_of,
                         inputs: JobInputs = JobInputs(), days_before: int = 10) -> DataFrame:
    """L1: accepted migration contacts of the month window, with supervisor.

    Input columns: user, date_text, phone_in, queue, conclusion, contact_id,
    source_file, _ord.  Staffing: full_name, supervisor (+ _ord).
    """
    agent = T.agent_name_accumulated(_c("user"))
    agent = T.replace_values(agent, inputs.name_fixes)
    agent = T.repair_text(agent, C.REPAIR_TO_ASCII)
    agent = T.replace_values(T.collapse_title(agent), inputs.name_fixes)
    df = with_columns_present(interactions, ACCUMULATED_INPUT).withColumn("agent", agent)

    if staffing is not None:
        dim = with_columns_present(staffing, ["full_name"]).withColumn("__name", T.collapse_title(_c("full_name")))
        df = lookup(df, dim, fact_key="agent", dim_key="__name", values=["supervisor"], order=["_ord"])
    else:
        df = df.withColumn("supervisor", F.lit(C.NO_QUEUE))

    disp = T.disposition(T.strip_literals(_c("conclusion"), C.CONCLUSION_LITERALS))
    df = df.withColumns({
        "disposition": disp,
        "base_cloud": R.map_values(_c("queue"), inputs.queue_map, C.NO_QUEUE),
    })
    df = df.where(R.contains_ci(_c("disposition"), C.ACCEPTED_PATTERN))
    date_txt = T.first_token(_c("date_text"))
    df = df.withColumns({
        "date": date_txt,
        "time": T.hhmm(T.after_first(_c("date_text")), mode="strict"),
        "phone": _c("phone_in"),
    })
    df = df.where(D.in_month_window(D.parse_day_first(date_txt), as_of, days_before))
    return fixed_order(df, schemas.ACCUMULATED_COLUMNS, fill_missing=True)


# --- L2 contact base ---------------------------------------------------------------

def contact_base(raw: DataFrame, keep_order: bool = False) -> DataFrame:
    """L2: cleaned contact lists.  Input: the contact-list columns present
    (contact_id, effective_date, person_id, phone_1, phone_2, segment)."""
    strings = [c for c in raw.columns if c not in (readers.ORD_COL,)]
    df = raw.withColumns({c: T.collapse_ws(_c(c)) for c in strings})          # X8
    df = df.withColumns({
        "base_date": D.ymd_to_dmy(_c("effective_date")) if "effective_date" in df.columns
        else F.lit(None).cast("string"),                                      # T1
    })
    for p in ("phone_1", "phone_2"):
        if p in df.columns:
            df = df.withColumn(p, T.phone_suffix(_c(p), 9, strip_first=True))   # X10
    df = df.withColumns({c: T.repair_text(_c(c), C.REPAIR_TO_ACCENTS)          # X6
                         for c in df.columns if c in schemas.CONTACT_BASE_COLUMNS})
    order = [readers.ORD_COL] if keep_order else []
    return fixed_order(df, [*schemas.CONTACT_BASE_COLUMNS, *order], fill_missing=True)


# --- L4 consolidation ----------------------------------------------------------------

def normalise_interactions(interactions: DataFrame, inputs: JobInputs = JobInputs()) -> DataFrame:
    """The stateless per-row stage of L4 (X2 X7 X4, X15 X19, X10, X9 X3, C1-C5):
    usable on a stream as well as in batch."""
    df = with_columns_present(interactions, CONSOLIDATED_INPUT)
    agent = T.replace_values(T.collapse_title(T.agent_name_consolidated(_c("user"), inputs.dialler)),
                             inputs.name_fixes)
    df = df.withColumns({
        "agent": agent,
        "date": T.first_token(_c("date_text")),
        "time": T.hhmm(T.after_first(_c("date_text")), mode="prefix"),
        "phone": T.phone_suffix(_c("dnis"), 9, strip_first=False),
        "disposition": T.disposition(T.strip_literals(_c("conclusion"), C.CONCLUSION_LITERALS)),
    })
    return df.withColumns({
        "handled": F.lit(1),
        "call_type": R.call_type(_c("agent"), _c("direction"), dialler=inputs.dialler,
                                 manual=C.MANUAL, manual_directions=C.MANUAL_DIRECTIONS),
        "not_applicable": R.flag_in(_c("disposition"), C.NOT_APPLICABLE),
        "migration": R.flag_in(_c("disposition"), C.MIGRATION),
        "contact": R.flag_in(_c("disposition"), C.CONTACT),
        "errors": R.flag_eq(_c("disposition"), C.ERROR_DISPOSITION),
        "untyped": R.flag_eq(_c("disposition"), C.UNTYPED_DISPOSITION),
        "base_cloud": R.map_values(_c("queue"), inputs.queue_map, C.NO_QUEUE),
        "contact_id": T.py_strip(_c("contact_id")),
    })


def consolidated_interactions(interactions: DataFrame, contact_list: DataFrame | None,
                              staffing: DataFrame | None, quartiles: DataFrame | None,
                              shifts: DataFrame | None, *, as_of, inputs: JobInputs = JobInputs(),
                              dedup_keys: Sequence[str] = ("time", "agent", "phone", "disposition", "bucket"),
                              ) -> DataFrame:
    """L4: today's interactions, classified, enriched and de-duplicated.

    Interactions: user, date_text, direction, dnis, queue, conclusion,
    contact_id, campaign, source_file, _ord.  Contact list (L2 output +
    _ord): contact_id, phone_1, phone_2, segment.  Staffing: full_name,
    andes, supervisor, start_date, dni, site, _ord.  Quartiles / shifts:
    dni, quartile / shift, _ord.
    """
    df = normalise_interactions(interactions, inputs)
    # every dimension's size bound, proven in one job (x2: two key runs in J2)
    small = prove_small({"contact": contact_list, "staff": staffing, "quartile": quartiles, "shift": shifts},
                        factors={"contact": 2})

    # beyond the bound, the hot keys of all lookups are found in one job over the raw interactions
    large = [k for k, dim in (("contact", contact_list), ("staff", staffing), ("quartile", quartiles), ("shift", shifts))
             if dim is not None and not small[k]]
    hot = hot_keys_of(df, {k: _c(k) for k in ("contact_id", "phone", "agent")}) if large else {}

    # Contact id, then phone in either phone column
    if contact_list is not None:
        cl = with_columns_present(contact_list, ["contact_id", "phone_1", "phone_2", "segment"]).withColumns({
            "__id": T.py_strip(_c("contact_id")),
            "__p1": T.py_strip(_c("phone_1")),
            "__p2": T.py_strip(_c("phone_2")),
        })
        df = fallback_lookup(df, cl, keys=[("contact_id", "__id"), ("phone", "__p1"), ("phone", "__p2")],
                             value="segment", out="bucket", order=["_ord"], default=C.NOT_FOUND,
                             broadcast=small["contact"], hot=hot)
    else:
        df = df.withColumn("bucket", F.lit(C.LOOKUP_FAILED))

    # J1 + J9: staffing by canonical name
    staff_values = ["andes", "supervisor", "start_date", "dni", "site"]
    if staffing is not None:
        st = with_columns_present(staffing, ["full_name"]).withColumn("__name", T.collapse_title(_c("full_name")))
        df = lookup(df, st, fact_key="agent", dim_key="__name", values=staff_values, order=["_ord"],
                    fill={"site": inputs.default_site} if inputs.default_site else None,
                    broadcast=small["staff"], hot=hot.get("agent"))
    else:
        df = df.withColumns({
            "andes": F.lit(C.LOOKUP_FAILED), "supervisor": F.lit(C.LOOKUP_FAILED),
            "start_date": F.lit(None).cast("string"), "dni": F.lit(None).cast("string"),
            "site": F.lit(inputs.default_site).cast("string"),
        })
    # T5 + C6
    days = D.whole_days(D.parse_timestamp(_c("start_date")), as_of)
    df = df.withColumn("tenure", R.tenure_band(days))

    # J3 x2: quartile and shift by id; its hot values are those of the hot agents
    df = df.withColumn("dni", T.py_strip(_c("dni")))
    hot_ids = []
    if staffing is not None and hot.get("agent") and {"quartile", "shift"} & set(large):
        rows = st.where(_c("__name").isin(hot["agent"]))
        found = with_columns_present(rows, ["dni"]).select(T.py_strip(_c("dni")).alias("k")).distinct()
        hot_ids = [r["k"] for r in found.limit(10 * len(hot["agent"])).collect() if r["k"] is not None]
    for dim, val in ((quartiles, "quartile"), (shifts, "shift")):
        if dim is not None:
            d = with_columns_present(dim, ["dni"]).withColumn("__dni", T.py_strip(_c("dni")))
            df = lookup(df, d, fact_key="dni", dim_key="__dni", values=[val], order=["_ord"],
                        broadcast=small[val], hot=hot_ids)
        else:
            df = df.withColumn(val, F.lit(C.LOOKUP_FAILED))

    # First by time (nulls last), then source file, then row order
    keyed = df.withColumns({f"__k{i}": T.py_strip(_c(k)) for i, k in enumerate(dedup_keys)})
    out = keep_first(
        keyed, [f"__k{i}" for i in range(len(dedup_keys))],
        [_c("time").asc_nulls_last(), _c("source_file").asc_nulls_last(), _c("_ord").asc_nulls_last()],
    )
    return fixed_order(out, schemas.CONSOLIDATED_COLUMNS, fill_missing=True)


# --- L5 form report ---------------------------------------------------------------------

def form_report(form: DataFrame, staffing: DataFrame | None, calls: DataFrame | None,
                quartiles: DataFrame | None, shifts: DataFrame | None, *, as_of,
                inputs: JobInputs = JobInputs(), dedupe_calls: bool = False) -> DataFrame:
    """Form responses joined with staffing, calls per agent, quartile
    and shift.  Form: stamp (timestamp), user, campaign_type, disposition,
    contacted (+ any columns).  Staffing: platform_user, full_name,
    supervisor, start_date, dni, site, _ord.  Calls: Name (+ metrics, _ord).
    """
    df = form
    if "campaign_type" in df.columns:
        df = df.where(R.not_in_upper(_c("campaign_type"), inputs.excluded_campaigns))      # F2
        df = df.withColumn("campaign_type", T.upper_trim(_c("campaign_type")))              # X13
    if "stamp" in df.columns:
        texts = D.display_texts(_c("stamp"))                                                   # T6
        df = df.withColumns({"stamp": texts["stamp"], "date": texts["date"], "time": texts["time"]})
    if "disposition" in df.columns:
        df = df.withColumns({
            "migration_form": R.flag_in(_c("disposition"), C.FORM_MIGRATION),
            "not_accepted_form": R.flag_eq(_c("disposition"), C.FORM_NOT_ACCEPTED),
        })
    df = df.withColumns({"handled_form": F.lit(1), "form_base": F.lit("Form")})
    if "contacted" in df.columns:
        df = df.withColumn("contact_form", R.flag_eq(_c("contacted"), C.FORM_CONTACT_YES))

    small = prove_small({"staff": staffing, "calls": calls, "quartile": quartiles, "shift": shifts})
    staff_values = ["platform_user", "full_name", "supervisor", "start_date", "dni", "site"]
    if staffing is not None and "user" in df.columns:
        st = with_columns_present(staffing, staff_values).withColumns({
            "__key": T.py_strip(_c("platform_user")),
            "full_name": T.collapse_title(_c("full_name")),
            "dni": T.numeric_id_text(_c("dni")),
        })
        vals = [v for v in staff_values if v in st.columns]
        df = df.withColumn("__user", T.py_strip(_c("user")))                                   # J5
        df = lookup(df, st, fact_key="__user", dim_key="__key", values=vals, order=["_ord"],
                    broadcast=small["staff"]).drop("__user")
        start = D.parse_timestamp(_c("start_date"))
        df = df.withColumns({
            "tenure": R.tenure_band(D.whole_days(start, as_of)),
            "start_date": F.date_format(start, "dd/MM/yyyy"),
        })
    else:
        df = df.withColumns({c: F.lit("Error") for c in staff_values})

    if calls is not None and "full_name" in df.columns:
        cl = with_columns_present(calls, ["Name"]).withColumn("__name", T.replace_values(T.name_swap(_c("Name")), inputs.name_fixes))
        metric_cols = [c for c in cl.columns if c not in ("__name", "Name", "_ord")]
        df = lookup(df, cl, fact_key="full_name", dim_key="__name", values=metric_cols,
                    order=["_ord"], dedupe=dedupe_calls, broadcast=small["calls"])           # J4

    if "dni" in df.columns:
        for dim, val in ((quartiles, "quartile"), (shifts, "shift")):
            if dim is not None:
                d = with_columns_present(dim, ["dni"]).withColumn("__dni", T.numeric_id_text(_c("dni")))   # X18
                df = lookup(df, d, fact_key="dni", dim_key="__dni", values=[val], order=["_ord"],
                            broadcast=small[val])
    return drop_present(df, C.FORM_DROP_COLUMNS + ("_ord",))


# --- L6 campaign activity ---------------------------------------------------------------

def campaign_activity(raw: DataFrame, *, inputs: JobInputs = JobInputs()) -> DataFrame:
    """Campaign rows kept by name, renamed, fixed order."""
    if "Name" not in raw.columns:
        return raw
    df = raw.where(R.is_in(_c("Name"), inputs.campaign_names))                     # F1
    df = df.withColumnsRenamed({k: v for k, v in C.CAMPAIGN_RENAMES_BEFORE.items() if k in df.columns})
    df = fixed_order(df, C.CAMPAIGN_ORDER)                                          # P4 P7
    return df.withColumnsRenamed({k: v for k, v in C.CAMPAIGN_RENAMES_AFTER.items() if k in df.columns})


# --- L7 record count / L8 daily base counts ----------------------------------------------

def record_count(records: DataFrame, *, file_col: str = readers.FILE_COL, out: str = "records") -> DataFrame:
    """Rows per file, summed to one row."""
    return A.sum_of_counts(A.per_group_counts(records, file_col), "rows", out)


def daily_base_counts(rows: DataFrame, *, as_of, inputs: JobInputs, file_col: str = "file_name",
                      date_col: str = "base_date", has_date_col: str = "has_base_date") -> DataFrame:
    """Per file, rows dated ``as_of`` (all rows when the file has no date
    column, F5), labelled by ordered file-name rules (F9), counted into one
    wide row (A2)."""
    today = F.date_format(D.as_date(as_of), "dd/MM/yyyy")
    keep = ~_c(has_date_col) | R.contains_text(_c(date_col), today)
    labelled = rows.where(keep).withColumn(
        "__label", R.first_match(F.upper(_c(file_col)), inputs.file_rules))
    return A.bucket_counts(labelled, "__label", inputs.bucket_columns)


# --- runners: read folders, write outputs (L9) ----------------------------------------------

def _rejects(landed: readers.Landed, out: str) -> None:
    """Every runner leaves its rejects beside its output (an empty table when there are none)."""
    sinks.write_table(landed.rejects, out.rstrip("/") + "_rejects")


def run_accumulated(spark: SparkSession, root: str, staffing: DataFrame | None, out: str, *,
                    as_of, inputs: JobInputs = JobInputs(), report_headers: bool = False) -> dict:
    """L1 over ``<root>/<yyyy>/<MM. Month>`` of this and the previous month."""
    paths = D.month_folder_paths(root, as_of)
    res = readers.read_delimited(spark, paths, list(schemas.INTERACTION_HEADERS.values()),
                                 rename=schemas.header_repairs(schemas.INTERACTION_HEADERS))
    if res.empty:
        return {"status": "no input", "files": res.files}
    landed = readers.land(res)
    inter = landed.rows.withColumnRenamed(readers.FILE_COL, "source_file")
    result, kept = A.observe_counts(accumulated_contacts(inter, staffing, as_of=as_of, inputs=inputs), "kept")
    sinks.write_delimited(schemas.report_headers(result, schemas.ACCUMULATED_REPORT) if report_headers else result, out)
    _rejects(landed, out)
    return {"status": "written", "files": res.files,
            "metrics": {"rows_read": landed.n_rows, "rows_rejected": landed.n_rejected,
                        "rows_written": kept.get["rows"],
                        "rows_filtered": A.removed_rows(landed.n_rows, kept.get["rows"])}}


def run_contact_base(spark: SparkSession, roots: Sequence[str] | None, out: str, *, as_of=None,
                     base_root: str | None = None, cloud_root: str | None = None,
                     ordered_out: str | None = None) -> dict:
    """L2 over several roots (comma or semicolon, UTF-8 or Latin-1).

    Without ``roots`` the four folders of ``as_of`` are read (current load,
    two months of history, cloud bases). ``ordered_out`` is the hand-over to
    later jobs: the same table with its source order (``_ord``: rank of the
    root, file, place), so that the first root wins in the lookups that read it.
    """
    if roots is None:
        roots = D.contact_folder_paths(base_root, cloud_root, as_of)
    res = readers.read_delimited(spark, roots, list(schemas.CONTACT_LIST_HEADERS.values()),
                                 delimiters=(",", ";"), delimiter_mode="fallback", deep_headers=True,
                                 rename=schemas.CONTACT_LIST_HEADERS)
    if res.empty:
        return {"status": "no input", "files": res.files}
    landed = readers.land(res)
    out_df, kept = A.observe_counts(contact_base(landed.rows, keep_order=True), "kept")
    if ordered_out:
        sinks.write_table(out_df, ordered_out)
        sinks.write_table(spark.read.parquet(ordered_out).drop(readers.ORD_COL), out)
    else:
        sinks.write_table(out_df.drop(readers.ORD_COL), out)
    _rejects(landed, out)
    return {"status": "written", "files": res.files,
            "metrics": {"rows_written": kept.get["rows"], "rows_rejected": landed.n_rejected}}


def run_daily_base_counts(spark: SparkSession, root: str, *, as_of, inputs: JobInputs,
                          date_col: str = "Fecha_Base") -> DataFrame | None:
    """L8 over a folder of base files (sniffed delimiters): the date filter
    applies per file, only to files that have the date column (F5)."""
    res = readers.read_delimited(spark, [root], None, delimiters=readers.SNIFF_CANDIDATES,
                                 delimiter_mode="sniff", flag_columns=[date_col])
    if res.empty:
        return None
    rows = with_columns_present(res.data, [date_col])
    return daily_base_counts(rows, as_of=as_of, inputs=inputs, file_col=readers.FILE_COL,
                             date_col=date_col, has_date_col=f"_has_{date_col}")


def run_record_count(spark: SparkSession, roots, *, pattern: str = "*.rsl",
                     drop_first_line: bool = False, skip_wide: bool = False, sep: str = "|") -> DataFrame:
    """L7 over key=value export folders; 0 when there is no file.
    ``drop_first_line=True`` reproduces the reference, whose reader takes
    each file's first line as a header and does not count it (Q20).
    ``skip_wide=True`` leaves out records with more cells than their file's
    first line, as that reader does (A3)."""
    lines = readers.read_keyvalue_lines(spark, roots, pattern=pattern)
    if lines is None:
        return spark.range(1).select(F.lit(0).cast("long").alias("records"))
    order = F.col(f"{readers.ORD_COL}.row")
    cells = F.length("line") - F.length(F.replace(F.col("line"), F.lit(sep), F.lit("")))
    lines = lines.select(readers.FILE_COL, F.col(f"{readers.ORD_COL}.file").alias("path"), order.alias("row"), cells.alias("cells"),
                         (F.col(f"{readers.ORD_COL}.block") == 0).alias("head"))
    if drop_first_line or skip_wide:
        # fixed-width values of each file's first line: one row per file
        first = lines.where("head").groupBy("path").agg(F.min("row").alias("first"), F.min_by("cells", "row").alias("width"))
        lines = lines.join(first, "path")
        if drop_first_line:
            lines = lines.where("row <> first")
        if skip_wide:
            lines = lines.where("cells <= width")
    return record_count(lines)


def run_keyvalue_base(spark: SparkSession, roots, out: str, *, pattern: str = "*.rsl",
                      keys: Sequence[str] | None = None, drop_first_line: bool = False) -> dict:
    """L3: key=value exports -> one table with the source file per row, and the rejects."""
    res = readers.read_keyvalue_parsed(spark, roots, keys, pattern=pattern, drop_first_line=drop_first_line)
    if res.empty:
        return {"status": "no input"}
    rows, kept = A.observe_counts(res.data.drop(readers.ORD_COL), "kept")
    sinks.write_table(rows, out)
    sinks.write_table(res.rejects, out.rstrip("/") + "_rejects")
    return {"status": "written", "metrics": {"rows_written": kept.get["rows"]}}


def run_form_report(spark: SparkSession, *, form: DataFrame, staffing: DataFrame | None,
                    calls: DataFrame | None, quartiles: DataFrame | None, shifts: DataFrame | None,
                    campaign_raw: DataFrame | None, rsl_roots, out: str, as_of,
                    inputs: JobInputs = JobInputs(), rsl_pattern: str = "*.rsl",
                    drop_first_line: bool = False, skip_wide: bool = False) -> dict:
    """L5 + L6 + L7 written as one multi-table output (K3); the campaign
    table is optional and skipped when empty (K4)."""
    tables = {
        "form_report": form_report(form, staffing, calls, quartiles, shifts, as_of=as_of, inputs=inputs),
        "campaign_activity": campaign_activity(campaign_raw, inputs=inputs) if campaign_raw is not None else None,
        "record_count": run_record_count(spark, rsl_roots, pattern=rsl_pattern, drop_first_line=drop_first_line,
                                         skip_wide=skip_wide),
    }
    return sinks.write_tables(tables, out, optional={"campaign_activity"})


def _ordered(stages: dict) -> str:
    """Where the contact base is handed over with its source order."""
    return stages["contact_out"].rstrip("/") + "_ordered"


def run_consolidated(spark: SparkSession, *, as_of, stages: dict, inputs: JobInputs = JobInputs()) -> dict:
    """L4 over the written contact base and accumulated report: three tables (K3) and the rejects.

    ``consolidated`` is written in order of time (nulls last), ``base_counts``
    is there when ``bases_root`` is given, ``accumulated`` is the written
    report or a notice (S15).
    """
    res = readers.read_delimited(spark, stages["today_root"], list(schemas.INTERACTION_HEADERS.values()),
                                 rename=schemas.header_repairs(schemas.INTERACTION_HEADERS))
    if res.empty:
        return {"status": "no input", "files": res.files}
    landed = readers.land(res)
    inter = landed.rows.withColumnRenamed(readers.FILE_COL, "source_file")
    written = readers.existing_roots(spark, [_ordered(stages)])
    cons = consolidated_interactions(inter, spark.read.parquet(*written) if written else None, stages.get("staffing"),
                                     stages.get("quartiles"), stages.get("shifts"), as_of=as_of, inputs=inputs)
    cons = cons.orderBy(_c("time").asc_nulls_last(), "source_file", "agent", "phone", "disposition", "bucket")
    cons, kept = A.observe_counts(cons, "kept")  # after the sort, whose sampling reads its input once more
    if stages.get("report_headers"):
        cons = schemas.report_headers(cons, schemas.CONSOLIDATED_REPORT)
    tables = {"consolidated": cons}
    if stages.get("bases_root"):
        tables["base_counts"] = run_daily_base_counts(spark, stages["bases_root"], as_of=as_of, inputs=inputs)
    tables["accumulated"] = readers.read_optional(spark, stages["accumulated_out"])
    status = sinks.write_tables(tables, stages["consolidated_out"])
    _rejects(landed, stages["consolidated_out"])
    # A4: lookups keep every row, so the difference is what the dedup removed
    return {"status": "written", "tables": status, "files": res.files, "metrics": {
        "rows_read": landed.n_rows, "rows_rejected": landed.n_rejected, "rows_written": kept.get["rows"],
        "duplicates_removed": A.removed_rows(landed.n_rows, kept.get["rows"])}}


#: Job -> the jobs whose written tables it reads. A job that lacks its folders is left out.
JOB_NEEDS = {
    "contact_base": (), "accumulated": (), "keyvalue_base": (), "form_report": (),
    "consolidated": ("contact_base", "accumulated"),
}


def _job(spark: SparkSession, name: str, as_of, stages: dict, inputs: JobInputs) -> dict | None:
    """Run one job of ``JOB_NEEDS``; None when ``stages`` does not ask for it."""
    if name == "contact_base":
        return run_contact_base(spark, stages.get("contact_roots"), stages["contact_out"], as_of=as_of,
                                base_root=stages.get("contact_base_root"), cloud_root=stages.get("contact_cloud_root"), ordered_out=_ordered(stages))
    if name == "accumulated":
        return run_accumulated(spark, stages["accumulated_root"], stages.get("staffing"), stages["accumulated_out"],
                               as_of=as_of, inputs=inputs, report_headers=bool(stages.get("report_headers")))
    if name == "keyvalue_base" and stages.get("keyvalue_out"):
        return run_keyvalue_base(spark, stages["keyvalue_roots"], stages["keyvalue_out"], keys=stages.get("keyvalue_keys"),
                                 pattern=stages.get("keyvalue_pattern", "*.rsl"))
    if name == "form_report" and stages.get("form_out"):
        return run_form_report(spark, form=stages["form"], staffing=stages.get("staffing"), calls=stages.get("calls"),
                               quartiles=stages.get("quartiles"), shifts=stages.get("shifts"),
                               campaign_raw=stages.get("campaign_raw"), rsl_roots=stages.get("keyvalue_roots", []),
                               rsl_pattern=stages.get("keyvalue_pattern", "*.rsl"), out=stages["form_out"], as_of=as_of, inputs=inputs)
    if name == "consolidated" and stages.get("consolidated_out"):
        return run_consolidated(spark, as_of=as_of, stages=stages, inputs=inputs)
    return None


def run_all(spark: SparkSession, *, as_of, stages: dict, inputs: JobInputs = JobInputs(), resume: bool = False) -> dict:
    """All jobs, producers first (``JOB_NEEDS``); each hands over written tables.

    A failed job is reported and the jobs that need it are left out; the others
    run. With ``state_out`` every job's report is written there under its name
    and run date, and ``resume=True`` runs only the jobs that are not done yet.
    """
    report: dict = {}
    done = _finished(spark, stages, as_of) if resume else set()
    for name, needs in JOB_NEEDS.items():
        if name in done:
            report[name] = {"status": "done before"}
            continue
        if any(report.get(n, {}).get("status") == "failed" for n in needs):
            report[name] = {"status": "left out", "needs": list(needs)}
            continue
        try:
            found = _job(spark, name, as_of, stages, inputs)
        except (PySparkException, KeyError, OSError) as failure:
            report[name] = {"status": "failed", "error": str(failure)[:2000]}
            continue
        if found is None:
            continue
        report[name] = found
        if name == "consolidated" and "tables" in found:
            report[name] = found["tables"]
            report["consolidated_rejected"] = found["metrics"].pop("rows_rejected")
            report["consolidated_metrics"] = found["metrics"]
        if stages.get("state_out"):
            row = {"job": name, "as_of": str(as_of), "status": found.get("status", "written")}
            sinks.write_table(A.metrics_frame(spark, [row]), f"{stages['state_out']}/{as_of}/{name}")
    return report


def _finished(spark: SparkSession, stages: dict, as_of) -> set[str]:
    """The jobs whose reports of this run date are written."""
    root = f"{stages['state_out']}/{as_of}"
    return {n for n in JOB_NEEDS if readers.existing_roots(spark, [f"{root}/{n}/_SUCCESS"])}
