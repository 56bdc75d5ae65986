"""Text-first reader (S1-S16) and sinks (K1-K5) on small invented folders."""

import os

from cctally.sources import readers, sinks


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(text.encode(encoding))


def test_mixed_encodings_delimiters_headers(spark, scratch):
    root = scratch
    write(f"{root}/a one.csv", "﻿id;name\n1;Ana Pérez\n2;Luis\n")                 # UTF-8 + BOM
    write(f"{root}/b.csv", "name;id;extra\nJosé;3;x\n", encoding="latin-1")            # Latin-1, reordered
    write(f"{root}/c.csv", "id,name\n4,Eva\n")                                         # comma
    write(f"{root}/none.csv", "foo;bar\n1;2\n")                                        # no wanted column
    write(f"{root}/skip.txt", "id;name\n9;no\n")                                       # other extension
    res = readers.read_delimited(spark, [root], ["id", "name"], delimiters=(",", ";"),
                                 delimiter_mode="fallback")
    rows = sorted((r["id"], r["name"], r["Origen_Archivo"]) for r in res.data.collect())
    assert rows == [("1", "Ana Pérez", "a one.csv"), ("2", "Luis", "a one.csv"), ("3", "José", "b.csv"),
                    ("4", "Eva", "c.csv")]
    status = {f["file"]: (f["encoding"], f["delimiter"], f["status"]) for f in res.files}
    assert status["b.csv"] == ("ISO-8859-1", ";", "read")
    assert status["none.csv"][2] == "no_wanted_columns"
    assert [(r["file"], r["reason"]) for r in res.rejects.collect()] == [("none.csv", "no_wanted_columns")]


def test_wide_rows_rejected_short_rows_padded(spark, scratch):
    write(f"{scratch}/r.csv", "id;name\n1;a\n2\n3;b;extra\n4;c\n")
    res = readers.read_delimited(spark, [scratch], ["id", "name"])
    assert sorted(tuple(r) for r in res.data.select("id", "name").collect()) == [
        ("1", "a"), ("2", None), ("4", "c")]
    rej = res.rejects.collect()
    assert len(rej) == 1 and rej[0]["reason"] == "too_wide" and rej[0]["raw"].startswith("3;b;extra")


def test_header_repair_and_na_tokens(spark, scratch):
    write(f"{scratch}/h.csv", ' "Fono" ;DirecciÃ³n\nNA;Entrante\n-;null\n')
    res = readers.read_delimited(spark, [scratch], ["Fono", "Dirección"], deep_headers=True,
                                 rename={"DirecciÃ³n": "Dirección"})
    assert sorted([tuple(r) for r in res.data.select("Fono", "Dirección").collect()], key=str) == [
        ("-", None), (None, "Entrante")]


def test_empty_inputs_short_circuit(spark, scratch):
    os.makedirs(f"{scratch}/empty", exist_ok=True)
    assert readers.read_delimited(spark, [f"{scratch}/empty", f"{scratch}/absent"], ["x"]).empty
    notice = readers.read_optional(spark, f"{scratch}/absent")
    assert notice.columns == ["Aviso"] and notice.count() == 1


def test_keyvalue_by_key_and_headers(spark, scratch):
    write(f"{scratch}/a.rsl", "ID=1|NAME=Ana|EXPR=a=b\nNAME=Luis|ID=2\nID|NAME|EXPR\nID=ID|NAME=NAME\n\n",
          encoding="latin-1")
    write(f"{scratch}/b.rsl", "ID=3|NAME=José|EXPR=\n", encoding="latin-1")
    out = readers.read_keyvalue(spark, [scratch])
    rows = sorted((r["ID"], r["NAME"], r["EXPR"], r["Origen_Archivo"]) for r in out.collect())
    assert rows == [("1", "Ana", "a=b", "a.rsl"), ("2", "Luis", None, "a.rsl"), ("3", "José", "", "b.rsl")]
    first_dropped = readers.read_keyvalue(spark, [scratch], drop_first_line=True)
    assert sorted(r["ID"] for r in first_dropped.collect()) == ["2"]


def test_write_tables_overwrite_and_optional(spark, scratch):
    df = spark.range(3)
    st = sinks.write_tables({"t": df, "e": df.where("id < 0"), "n": None}, scratch, optional={"e"})
    assert st == {"t": "written", "e": "skipped", "n": "skipped"}
    sinks.write_tables({"t": spark.range(5)}, scratch)
    assert spark.read.parquet(f"{scratch}/t").count() == 5


def test_delimited_roundtrip_latin1(spark, scratch):
    df = spark.createDataFrame([("1", "Peña")], "id string, name string")
    sinks.write_delimited(df, f"{scratch}/out", encoding="ISO-8859-1")
    res = readers.read_delimited(spark, [f"{scratch}/out"], ["id", "name"])
    assert [tuple(r) for r in res.data.select("id", "name").collect()] == [("1", "Peña")]


def test_single_declared_encoding_skips_detection(spark, scratch):
    write(f"{scratch}/l.csv", "id;Año\n1;Peña\n", encoding="latin-1")
    res = readers.read_delimited(spark, [scratch], ["id", "Año"], encodings=("ISO-8859-1",))
    assert [r["Año"] for r in res.data.collect()] == ["Peña"]
    assert res.files[0]["encoding"] == "ISO-8859-1"


def test_quoted_line_breaks_with_multi_line(spark, scratch):
    write(f"{scratch}/m.csv", 'id;note\n1;"two\nlines"\n2;plain\n')
    res = readers.read_delimited(spark, [scratch], ["id", "note"], multi_line=True)
    assert sorted(tuple(r) for r in res.data.select("id", "note").collect()) == [("1", "two\nlines"), ("2", "plain")]


def test_file_names_with_glob_characters(spark, scratch):
    write(f"{scratch}/base[1] {{x}}.csv", "id;name\n1;a\n")
    write(f"{scratch}/base1 x.csv", "id;name\n2;b\n")
    res = readers.read_delimited(spark, [scratch], ["id", "name"])
    assert sorted((r["id"], r["Origen_Archivo"]) for r in res.data.collect()) == [
        ("1", "base[1] {x}.csv"), ("2", "base1 x.csv")]
