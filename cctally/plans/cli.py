"""Command-line entry: run one job from a JSON config.

    python -m cctally <job> --config run.json --as-of 2026-04-15

Jobs: accumulated, contact-base, keyvalue-base, consolidated (runs
contact-base and accumulated first, L9), form-report, daily-counts.
The config holds folder paths and the business inputs (``JobInputs``
fields); dimensions are staged tables ``{"path": ..., "format": "parquet" |
"csv", "rename": {raw header: internal name}}``.  Scheduling is left to an
external scheduler; the job runs in the session Spark provides.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..sources import readers
from . import jobs
from .rules_config import JobInputs

JOBS = ("accumulated", "contact-base", "keyvalue-base", "consolidated", "form-report", "daily-counts")


def inputs_from(cfg: dict) -> JobInputs:
    raw = dict(cfg.get("inputs", {}))
    if "file_rules" in raw:
        raw["file_rules"] = tuple((tuple(r["contains"]), r["label"]) for r in raw["file_rules"])
    for k in ("excluded_campaigns", "campaign_names"):
        if k in raw:
            raw[k] = tuple(raw[k])
    return JobInputs(**raw)


def dimension(spark: SparkSession, spec: dict | None):
    """A staged dimension with a row order (``_ord``) for keep-first steps."""
    if not spec:
        return None
    df = readers.read_dimension(spark, spec["path"], fmt=spec.get("format", "parquet"),
                                rename=spec.get("rename"))
    return df.withColumn("_ord", F.monotonically_increasing_id())


def run(spark: SparkSession, job: str, cfg: dict, as_of: dt.date) -> dict:
    inputs = inputs_from(cfg)
    paths = cfg.get("paths", {})
    dims = {k: dimension(spark, cfg.get("dimensions", {}).get(k))
            for k in ("staffing", "quartiles", "shifts", "calls")}
    if job == "accumulated":
        return jobs.run_accumulated(spark, paths["accumulated_root"], dims["staffing"], paths["accumulated_out"],
                                    as_of=as_of, inputs=inputs)
    if job == "contact-base":
        return jobs.run_contact_base(spark, paths.get("contact_roots"), paths["contact_out"], as_of=as_of,
                                     base_root=paths.get("contact_base_root"), cloud_root=paths.get("contact_cloud_root"))
    if job == "keyvalue-base":
        return jobs.run_keyvalue_base(spark, paths["keyvalue_roots"], paths["keyvalue_out"])
    if job == "consolidated":
        stages = dict(paths, staffing=dims["staffing"], quartiles=dims["quartiles"], shifts=dims["shifts"])
        return jobs.run_all(spark, as_of=as_of, stages=stages, inputs=inputs, resume=bool(cfg.get("resume")))
    if job == "form-report":
        form = dimension(spark, cfg["dimensions"]["form"])
        campaign = None
        if paths.get("campaign_root"):
            res = readers.read_delimited(spark, [paths["campaign_root"]], None,
                                         delimiters=readers.SNIFF_CANDIDATES, delimiter_mode="sniff")
            campaign = None if res.empty else res.data.drop(readers.FILE_COL, readers.ORD_COL)
        return jobs.run_form_report(spark, form=form, staffing=dims["staffing"], calls=dims["calls"],
                                    quartiles=dims["quartiles"], shifts=dims["shifts"], campaign_raw=campaign,
                                    rsl_roots=paths.get("keyvalue_roots", []), out=paths["form_out"],
                                    as_of=as_of, inputs=inputs, drop_first_line=bool(cfg.get("drop_first_line")),
                                    skip_wide=bool(cfg.get("skip_wide")))
    if job == "daily-counts":
        counts = jobs.run_daily_base_counts(spark, paths["bases_root"], as_of=as_of, inputs=inputs)
        if counts is None:
            return {"status": "no input"}
        counts.write.mode("overwrite").parquet(paths["counts_out"])
        return {"status": "written"}
    raise ValueError(f"unknown job {job!r}; one of {JOBS}")


def main(argv=None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="cctally", description=__doc__.split("\n\n")[0])
    ap.add_argument("job", choices=JOBS)
    ap.add_argument("--config", required=True, help="JSON file with paths, dimensions and inputs")
    ap.add_argument("--as-of", required=True, help="run date, YYYY-MM-DD")
    args = ap.parse_args(argv)
    with open(args.config, encoding="utf-8") as fh:
        cfg = json.load(fh)
    spark = spark or SparkSession.builder.appName(f"cctally-{args.job}").getOrCreate()
    report = run(spark, args.job, cfg, dt.date.fromisoformat(args.as_of))
    print(json.dumps(report, default=str))
    return report


if __name__ == "__main__":
    main(sys.argv[1:])
