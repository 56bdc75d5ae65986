"""Incremental ingestion: a second run reads only the newly landed file."""

import os

from cctally.plans import jobs
from cctally.plans.rules_config import JobInputs
from cctally.streaming.ingest import ingest_new_files

COLS = ["user", "date_text", "direction", "dnis", "queue", "conclusion", "contact_id"]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_available_now_processes_only_new_files(spark, scratch):
    land, out = f"{scratch}/landing", f"{scratch}/normalised"
    head = ";".join(COLS) + "\n"
    write(f"{land}/a.csv", head + "x_y_ana_z;03/04/2026 10:15;Saliente;56911112222;Q1;\"C; SIN FACTIBILIDAD\";k1\n")
    norm = lambda df: jobs.normalise_interactions(df, JobInputs(queue_map={"Q1": "Uno"}))
    first = ingest_new_files(spark, land, COLS, out, transform=norm)
    write(f"{land}/b.csv", head + ";NA;Entrante;;Q2;;\n")
    second = ingest_new_files(spark, land, COLS, out, transform=norm)
    assert (first["rows"], second["rows"]) == (1, 1)
    rows = sorted((r["agent"], r["time"], r["not_applicable"], r["base_cloud"], r["Origen_Archivo"])
                  for r in spark.read.parquet(out).collect())
    assert rows == [("Ana", "10:15", 1, "Uno", "a.csv"), ("Discador", "00:00", 0, "-", "b.csv")]


def test_checkpoint_name_is_stable(spark, scratch):
    land, out = f"{scratch}/landing2", f"{scratch}/out2"
    write(f"{land}/a.csv", ";".join(COLS) + "\nu;01/01/2026;x;1;q;c;k\n")
    first = ingest_new_files(spark, land, COLS, out)
    again = ingest_new_files(spark, land, COLS, out)
    assert first["checkpoint"] == again["checkpoint"] and (first["rows"], again["rows"]) == (1, 0)
