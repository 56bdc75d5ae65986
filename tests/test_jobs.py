"""Job goldens (L1, L2, L4, L9) on tiny invented folders, plus oracle
checks of the driver catalogue at sf0.001."""

import os

import duckdb
import pytest

from cctally.plans import jobs
from cctally.plans.rules_config import JobInputs
from cctally.sources import readers

HEAD = "Usuarios;Fecha;Cola;Conclusión;Identificación de contacto;Dirección;DNIS\n"


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(text.encode(encoding))


def staffing(spark):
    return spark.createDataFrame(
        [("ana  pérez", "A1", "Sup Uno", "2026-03-20 08:00:00", " 77 ", None, 1),
         ("Ana Pérez", "A9", "Sup Late", None, "78", "S", 2)],
        "full_name string, andes string, supervisor string, start_date string, dni string, site string, _ord int")


def test_accumulated_runner_reads_two_month_folders(spark, scratch):
    root = f"{scratch}/hist"
    write(f"{root}/2026/04. Abril/x.csv", "﻿" + HEAD +
          '"q_w_ana pérez_z; t";03/04/2026 10:15;Q1;"C1; ACEPTA AGENDA - MIGRACION - SOP";k1;Saliente;56911112222\n'
          '"q_w_ana pérez_z; t";03/04/2026 10:15:30;Q1;"C1; NO ACEPTA MIGRACION";k2;Saliente;56911112222\n')
    write(f"{root}/2026/03. Marzo/y.csv", HEAD.replace("Conclusión", "ConclusiÃ³n") +
          "b_ana_c;22/03/2026 9:05:01;Q2;acepta reingreso migracion;k3;Entrante;1\n", encoding="latin-1")
    write(f"{root}/2026/02. Febrero/z.csv", HEAD + 'b_ana_c;03/02/2026;Q2;"x; ACEPTA AGENDA - MIGRACION";k4;E;1\n')
    out = f"{scratch}/acc"
    rep = jobs.run_accumulated(spark, root, staffing(spark), out, as_of="2026-04-15",
                               inputs=JobInputs(queue_map={"Q1": "Base Uno"}))
    assert rep["status"] == "written"
    # the February folder is outside the two months of as_of and never read
    assert rep["metrics"] == {"rows_read": 3, "rows_rejected": 0, "rows_written": 2, "rows_filtered": 1}
    rows = spark.read.option("header", True).option("sep", ";").csv(out).collect()
    got = sorted((r["contact_id"], r["time"], r["agent"], r["base_cloud"], r["supervisor"], r["source_file"])
                 for r in rows)
    assert got == [("k1", "10:15", "Ana Pérez", "Base Uno", "Sup Uno", "x.csv"),
                   ("k3", "00:00", "Ana", "-", None, "y.csv")]


def test_contact_base_runner(spark, scratch):
    write(f"{scratch}/c1/a.csv", '"inin-outbound-id",vCampaignEffectiveDate,FONO_CONTACTO,Segment_of_Origin\n'
          " id1 ,20260403, 56911112222 ,Seg\xa0 A\n")
    write(f"{scratch}/c2/b.csv", "inin-outbound-id;Fono1;Segment_of_Origin\nid2;  ;SeÃ±al\n", encoding="latin-1")
    write(f"{scratch}/c2/bad.csv", "nothing;here\n1;2\n")
    out = f"{scratch}/cb"
    rep = jobs.run_contact_base(spark, [f"{scratch}/c1", f"{scratch}/c2"], out)
    rows = sorted((tuple(r) for r in spark.read.parquet(out).collect()), key=str)
    assert rows == [("03/04/2026", None, "id1", "911112222", None, "Seg A"),
                    (None, None, "id2", None, None, "Señal")]
    assert any(f["status"] == "no_wanted_columns" for f in rep["files"])


def test_consolidation_dedup_and_enrichment(spark):
    inter = spark.createDataFrame([
        ("a_b_ana pérez_c", "03/04/2026 10:15", "Saliente", "56911112222", "Q1", "C; ACEPTA AGENDA - MIGRACION", "k1", "f2.csv", 2),
        ("a_b_ana pérez_c", "04/04/2026 10:15:59", "Saliente", "56911112222", "Q1", "C; ACEPTA AGENDA - MIGRACION", "k1", "f1.csv", 9),
        (None, None, "Entrante", None, None, None, None, "f1.csv", 1),
    ], "user string, date_text string, direction string, dnis string, queue string, conclusion string, "
       "contact_id string, source_file string, _ord int")
    cl = spark.createDataFrame([("k1", None, None, None, 1), (None, "911112222", None, "PHONE", 2)],
                               "contact_id string, phone_1 string, phone_2 string, segment string, _ord int")
    qu = spark.createDataFrame([("77", "Q1", 1)], "dni string, quartile string, _ord int")
    out = jobs.consolidated_interactions(inter, cl, staffing(spark), qu, None, as_of="2026-04-15",
                                         inputs=JobInputs(default_site="Sin sede"))
    rows = {r["source_file"]: r for r in out.collect()}
    assert set(rows) == {"f1.csv"} and out.count() == 2          # same key on two days: first file wins
    r = [x for x in out.collect() if x["agent"] == "Ana Pérez"][0]
    assert (r["call_type"], r["migration"], r["contact"], r["bucket"], r["supervisor"], r["dni"], r["quartile"],
            r["tenure"], r["site"], r["shift"]) == ("Manual", 1, 1, "PHONE", "Sup Uno", "77", "Q1", "Prematuro",
                                                   "Sin sede", "Error de Cruce")
    d = [x for x in out.collect() if x["agent"] == "Discador"][0]
    assert (d["time"], d["call_type"], d["bucket"], d["handled"]) == ("00:00", "Discador", "No Encontrado", 1)


def test_consolidation_plan_shuffles_fact_once(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "CartesianProduct" not in plan
    assert plan.count("BroadcastHashJoin") == 5
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("name", ["consolidated_interactions", "accumulated_contacts", "form_report",
                                  "fallback_lookup", "keyvalue_scan", "delimiter_header_groups",
                                  "whitespace_title", "sort_nulls_last"])
def test_oracle_equality_sf0001(spark, name):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    got = E.queries()[name](spark, sf).toPandas()
    exp = con.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    cols = sorted(got.columns)
    norm = lambda df: sorted(tuple("∅" if (v is None or v != v) else str(v) for v in row)
                             for row in df[cols].itertuples(index=False))
    assert norm(got) == norm(exp)


def test_daily_base_counts_runner_per_file_date_column(spark, scratch):
    write(f"{scratch}/b/BASE MAIN Q001 x.csv", "Fecha_Base;id\n15/04/2026;1\n14/04/2026;2\n15/04/2026;3\n")
    write(f"{scratch}/b/confirm q001.csv", "id,other\n1,a\n2,b\n")               # no date column: all rows
    write(f"{scratch}/b/q003 list.csv", "Fecha_Base\t id\n15/04/2026\t1\n")
    write(f"{scratch}/b/none.csv", "Fecha_Base;id\n15/04/2026;1\n")
    inputs = JobInputs(file_rules=((("CONFIRM", "Q001"), "confirm"), (("BASE MAIN Q001",), "main"),
                                   (("Q003",), "q3"), (("Q004",), "q4")),
                       bucket_columns={"main": "main", "confirm": "confirm", "q3": "q3", "q4": "q4"})
    row = jobs.run_daily_base_counts(spark, f"{scratch}/b", as_of="2026-04-15", inputs=inputs).first()
    assert (row["main"], row["confirm"], row["q3"], row["q4"]) == (2, 2, 1, 0)


def test_run_all_end_to_end(spark, scratch):
    write(f"{scratch}/cl/a.csv", "inin-outbound-id,FONO_CONTACTO,Segment_of_Origin\nk1,911112222,Seg A\n")
    write(f"{scratch}/hist/2026/04. Abril/h.csv", HEAD +
          'a_b_ana pérez_c;03/04/2026 10:15;Q1;"C; ACEPTA AGENDA - MIGRACION";k1;Saliente;56911112222\n')
    write(f"{scratch}/today/t.csv", HEAD +
          'a_b_ana pérez_c;15/04/2026 09:00;Q1;"C; VOLVER A LLAMAR";k1;Saliente;56911112222\n'
          'a_b_ana pérez_c;15/04/2026 09:00;Q1;"C; VOLVER A LLAMAR";k1;Saliente;56911112222\n')
    stages = {"contact_roots": [f"{scratch}/cl"], "contact_out": f"{scratch}/out/contact_base",
              "accumulated_root": f"{scratch}/hist", "accumulated_out": f"{scratch}/out/accumulated",
              "today_root": f"{scratch}/today", "consolidated_out": f"{scratch}/out/consolidated",
              "staffing": staffing(spark)}
    rep = jobs.run_all(spark, as_of="2026-04-15", stages=stages)
    assert rep["consolidated"] == {"consolidated": "written", "accumulated": "written"}
    cons = spark.read.parquet(f"{scratch}/out/consolidated/consolidated").collect()
    assert len(cons) == 1 and cons[0]["bucket"] == "Seg A" and cons[0]["supervisor"] == "Sup Uno"
    assert rep["consolidated_metrics"] == {"rows_read": 2, "rows_written": 1, "duplicates_removed": 1}
    acc = spark.read.parquet(f"{scratch}/out/consolidated/accumulated").collect()
    assert [r["contact_id"] for r in acc] == ["k1"]


def test_record_count_and_keyvalue_runners(spark, scratch):
    write(f"{scratch}/r/a.rsl", "ID=1|N=a\nID=2|N=b\n", encoding="latin-1")
    write(f"{scratch}/r/b.rsl", "ID=3|N=c\n", encoding="latin-1")
    assert jobs.run_record_count(spark, [f"{scratch}/r"]).first()["records"] == 3
    assert jobs.run_record_count(spark, [f"{scratch}/r"], drop_first_line=True).first()["records"] == 1
    assert jobs.run_record_count(spark, [f"{scratch}/missing"]).first()["records"] == 0
    assert jobs.run_keyvalue_base(spark, [f"{scratch}/r"], f"{scratch}/kv")["status"] == "written"
    assert spark.read.parquet(f"{scratch}/kv").count() == 3


def test_form_report_runner_multi_table(spark, scratch):
    import datetime as dt
    form = spark.createDataFrame(
        [(dt.datetime(2026, 4, 10, 9, 30), " pu1 ", "Keep", "NO ACEPTA", "SI", "obs"),
         (dt.datetime(2026, 4, 10, 9, 31), "pu2", "piloto x", "OTRO", "NO", "obs")],
        "stamp timestamp_ntz, user string, campaign_type string, disposition string, contacted string, "
        "`OBSERVACIÓN` string")
    st = spark.createDataFrame([("pu1", "ana  perez", "Sup", "2026-04-01", "0077", "S1", 1)],
                               "platform_user string, full_name string, supervisor string, start_date string, "
                               "dni string, site string, _ord int")
    calls = spark.createDataFrame([("Perez, Ana", "5", "00:03", 1), ("Perez,Ana", "6", "00:04", 2)],
                                  "Name string, calls string, AHT string, _ord int")
    qu = spark.createDataFrame([("77.0", "Q2", 1)], "dni string, quartile string, _ord int")
    write(f"{scratch}/camp/a.csv", "Name|Answers|Hit Ratio|No Answer Result\nC1|3|5%|1\nC9|1|1%|0\nC1|4|6%|2|x\n")
    camp = readers.read_delimited(spark, [f"{scratch}/camp"], None, delimiters=readers.SNIFF_CANDIDATES,
                                  delimiter_mode="sniff").data.drop(readers.FILE_COL, readers.ORD_COL)
    write(f"{scratch}/rsl/a.rsl", "ID=1\nID=2\n", encoding="latin-1")
    inputs = JobInputs(excluded_campaigns=("PILOTO X",), campaign_names=("C1",))
    st_out = jobs.run_form_report(spark, form=form, staffing=st, calls=calls, quartiles=qu, shifts=None,
                                  campaign_raw=camp, rsl_roots=[f"{scratch}/rsl"], out=f"{scratch}/out",
                                  as_of="2026-04-15", inputs=inputs)
    assert st_out == {"form_report": "written", "campaign_activity": "written", "record_count": "written"}
    fr = spark.read.parquet(f"{scratch}/out/form_report").collect()
    assert len(fr) == 2                                   # one form row, two call rows (fan-out)
    r = fr[0]
    assert (r["full_name"], r["dni"], r["quartile"], r["tenure"], r["not_accepted_form"], r["contact_form"],
            r["stamp"]) == ("Ana Perez", "77", "Q2", "Prematuro", 1, 1, "10/04/2026 09:30")
    assert "AHT" not in r.asDict() and "OBSERVACIÓN" not in r.asDict() and "start_date" not in r.asDict()
    ca = spark.read.parquet(f"{scratch}/out/campaign_activity")
    assert ca.columns == ["Name", "Hit Ratio", "Contacto (Answer)", "No Contacto (No Answer Result)"]
    assert ca.count() == 1                                # C9 filtered, the too-wide row rejected
    assert spark.read.parquet(f"{scratch}/out/record_count").first()["records"] == 2
    empty = jobs.run_form_report(spark, form=form, staffing=st, calls=None, quartiles=None, shifts=None,
                                 campaign_raw=camp.where("false"), rsl_roots=[f"{scratch}/none"],
                                 out=f"{scratch}/out2", as_of="2026-04-15", inputs=inputs)
    assert empty["campaign_activity"] == "skipped"


def test_cli_runs_consolidation_from_config(spark, scratch):
    import json
    from cctally.plans import cli
    write(f"{scratch}/cl/a.csv", "inin-outbound-id,FONO_CONTACTO,Segment_of_Origin\nk1,911112222,Seg A\n")
    write(f"{scratch}/today/t.csv", HEAD +
          'a_b_ana pérez_c;15/04/2026 09:00;Q1;"C; VOLVER A LLAMAR";k1;Saliente;56911112222\n')
    write(f"{scratch}/dims/staff.csv", "NOMBRE COMPLETO,SUPERVISOR,ANDES,SEDE,FECHA INGRESO,DNI\nAna Pérez,Sup Uno,A1,,2026-03-20,77\n")
    cfg = {"paths": {"contact_roots": [f"{scratch}/cl"], "contact_out": f"{scratch}/out/cb",
                     "accumulated_root": f"{scratch}/hist", "accumulated_out": f"{scratch}/out/acc",
                     "today_root": f"{scratch}/today", "consolidated_out": f"{scratch}/out/cons"},
           "dimensions": {"staffing": {"path": f"{scratch}/dims/staff.csv", "format": "csv",
                                       "rename": {"NOMBRE COMPLETO": "full_name", "SUPERVISOR": "supervisor",
                                                  "ANDES": "andes", "SEDE": "site", "FECHA INGRESO": "start_date",
                                                  "DNI": "dni"}}},
           "inputs": {"queue_map": {"Q1": "Base Uno"}, "default_site": "Sin sede"}}
    with open(f"{scratch}/run.json", "w") as fh:
        json.dump(cfg, fh)
    rep = cli.main(["consolidated", "--config", f"{scratch}/run.json", "--as-of", "2026-04-15"], spark=spark)
    assert rep["accumulated"]["status"] == "no input"
    row = spark.read.parquet(f"{scratch}/out/cons/consolidated").first()
    assert (row["bucket"], row["supervisor"], row["base_cloud"], row["site"], row["tenure"]) == (
        "Seg A", "Sup Uno", "Base Uno", "Sin sede", "Prematuro")


def test_four_folders_report_headers_and_rejects(spark, scratch):
    write(f"{scratch}/b/Cargue Actual/z.csv", "inin-outbound-id;Segment_of_Origin\nk1;current\n")
    write(f"{scratch}/b/Historico/2026/04. Abril/a.csv", "inin-outbound-id;Segment_of_Origin\nk1;april\nk2;april\nk;w;x;y\n")
    write(f"{scratch}/b/Historico/2026/03. Marzo/a.csv", "inin-outbound-id;Segment_of_Origin\nk2;march\nk3;march\n")
    write(f"{scratch}/cloud/a.csv", "inin-outbound-id,Segment_of_Origin\nk3,cloud\nk4,cloud\n")
    rep = jobs.run_contact_base(spark, None, f"{scratch}/cb", as_of="2026-04-15", base_root=f"{scratch}/b",
                                cloud_root=f"{scratch}/cloud", ordered_out=f"{scratch}/cb_ordered")
    assert rep["metrics"] == {"rows_written": 7, "rows_rejected": 1}
    first = {}
    for r in sorted(spark.read.parquet(f"{scratch}/cb_ordered").collect(), key=lambda r: r._ord):
        first.setdefault(r.contact_id, r.segment)
    assert first == {"k1": "current", "k2": "april", "k3": "march", "k4": "cloud"}
    assert [tuple(r) for r in spark.read.parquet(f"{scratch}/cb_rejects").collect()] == [("a.csv", "too_wide", "k;w;x;y")]
    write(f"{scratch}/hist/2026/04. Abril/h.csv", HEAD +
          'a_b_ana pérez_c;03/04/2026 10:15;Q1;"C; ACEPTA AGENDA - MIGRACION";k1;Saliente;56911112222\n')
    jobs.run_accumulated(spark, f"{scratch}/hist", None, f"{scratch}/acc", as_of="2026-04-15", report_headers=True)
    out = spark.read.option("header", True).option("sep", ";").csv(f"{scratch}/acc")
    assert out.columns == list(jobs.schemas.ACCUMULATED_REPORT.values()) and out.first()["Usuarios"] == "Ana Pérez"


def test_a_failed_job_is_reported_and_the_run_resumes(spark, scratch):
    write(f"{scratch}/cl/a.csv", "inin-outbound-id,Segment_of_Origin\nk1,Seg A\n")
    write(f"{scratch}/today/t.csv", HEAD + 'a_b_ana_c;15/04/2026 09:00;Q1;x;k1;Saliente;56911112222\n')
    stages = {"contact_roots": [f"{scratch}/cl"], "contact_out": f"{scratch}/out/cb", "accumulated_root": f"{scratch}/none",
              "accumulated_out": f"{scratch}/out/acc", "keyvalue_out": f"{scratch}/out/kv",      # no keyvalue_roots: fails
              "today_root": f"{scratch}/today", "consolidated_out": f"{scratch}/out/cons", "state_out": f"{scratch}/state"}
    first = jobs.run_all(spark, as_of="2026-04-15", stages=stages)
    assert first["keyvalue_base"]["status"] == "failed" and first["consolidated"]["consolidated"] == "written"
    write(f"{scratch}/kv/a.rsl", "ID=1|N=a\n")
    second = jobs.run_all(spark, as_of="2026-04-15", stages=stages | {"keyvalue_roots": [f"{scratch}/kv"]}, resume=True)
    assert second["keyvalue_base"]["status"] == "written" and second["consolidated"] == {"status": "done before"}


def test_optional_columns_may_be_absent(spark):
    inter = spark.createDataFrame([("a_b_ana_c", "03/04/2026 10:15", "f.csv", 1)], "user string, date_text string, source_file string, _ord int")
    bare = spark.createDataFrame([("x", 1)], "other string, _ord int")
    out = jobs.consolidated_interactions(inter, bare, bare, bare, bare, as_of="2026-04-15").collect()
    assert len(out) == 1 and out[0]["supervisor"] is None
    form = spark.createDataFrame([("pu1",)], "user string")
    st = spark.createDataFrame([("pu1", 1)], "platform_user string, _ord int")
    rows = jobs.form_report(form, st, bare, bare, bare, as_of="2026-04-15").collect()
    assert len(rows) == 1 and rows[0]["dni"] is None


def test_whole_days_do_not_depend_on_the_session_zone(spark):
    from cctally.functions import dates as D
    df = spark.createDataFrame([("2025-09-07 00:00:00", 7), ("2025-09-06 23:30:00", 7), ("2025-09-07 00:00:01", 6),
                                ("2025-09-20 10:00:00", -7), (None, None)], "s string, n int")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Santiago", "Asia/Beirut"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = df.select(D.whole_days(D.parse_timestamp("s"), "2025-09-14").alias("d"), "n").collect()
            assert all(r.d == r.n for r in got), zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
