"""Quoted records: the quote-state machine against a plain one, long fields, line breaks, odd names, root order."""

import os
import random

import pytest
from pyspark.sql import functions as F

from cctally.sources import readers, records


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as fh:
        fh.write(text.encode(encoding))


def plain_state(line, sep, within):
    """Character by character: (still within quotes, fields begun)."""
    state, fields, i = ("quoted" if within else "start"), 0, 0
    while i < len(line):
        ch = line[i]
        if state == "start":
            fields += 1
            state = "quoted" if ch == '"' else "text"
            if ch == sep:
                state = "start"
        elif state == "quoted" and ch == '"':
            if line[i + 1:i + 2] == '"':
                i += 1
            else:
                state = "text"
        elif state == "text" and ch == sep:
            state = "start"
        i += 1
    return state == "quoted", fields + (state == "start")


@pytest.mark.parametrize("within", [False, True])
def test_quote_state_equals_a_plain_machine(spark, within):
    rng = random.Random(1)
    lines = ["".join(rng.choices('ab";', k=rng.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = df.select("line", records.quote_state(F.col("line"), ";", within)["open"].alias("open"),
                    records.quote_state(F.col("line"), ";", within)["n"].alias("n")).collect()
    assert all(plain_state(r.line, ";", within) == (r.open, r.n) for r in got)


def test_long_quoted_fields_and_inch_marks(spark, scratch):
    long = '"' + "x" * 1_000_000 + '"'
    write(f"{scratch}/a.csv", f'a;b;c\n{long}\n{long};y\n{long};1;2;LOST\n5" x;y;z;LOST"\n"p;q";5" r;s\n"say ""a;b""";t;u\n')
    res = readers.read_delimited(spark, [scratch], ["a", "b", "c"])
    kept = {(len(r.a), r.a[:9], r.b, r.c) for r in res.data.collect()}
    assert kept == {(1_000_000, "x" * 9, None, None), (1_000_000, "x" * 9, "y", None), (3, "p;q", '5" r', "s"),
                    (9, 'say "a;b"', "t", "u")}
    assert sorted(r.raw[-6:] for r in res.rejects.collect()) == ["2;LOST", ";LOST\""]


@pytest.mark.parametrize("split", [None, 700, 90])
def test_quoted_line_breaks_over_splits(spark, scratch, split):
    rng = random.Random(9)
    rows = [("".join(rng.choices('ab";\n\r ', k=rng.randint(0, 14))), "".join(rng.choices('x;"\n', k=rng.randint(0, 6))), str(i))
            for i in range(120)]
    quoted = lambda x: '"' + x.replace('"', '""') + '"'
    body = "".join(";".join([quoted(a), quoted(b), c]) + rng.choice(["\n", "\r\n"]) for a, b, c in rows)
    body += 'one;5" two;k1\n"wide";2;3;4\n\nshort\n'
    write(f"{scratch}/q.csv", "\n\na;b;c\n" + body + 'x;"never closed;k2\nlast line')
    write(f"{scratch}/plain.csv", "c;a\nk3;only\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        res = readers.read_delimited(spark, [scratch], ["a", "b", "c"])
        got = sorted([(r.a or "", r.b or "", r.c or "") for r in res.data.collect()])
        lost = sorted((r.reason, r.raw) for r in res.rejects.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == sorted([*rows, ("one", '5" two', "k1"), ("only", "", "k3"), ("short", "", "")])
    assert lost == [("open_quote", "last line"), ("open_quote", 'x;"never closed;k2'), ("too_wide", '"wide";2;3;4')]


def test_detection_has_no_sort(spark, scratch):
    write(f"{scratch}/a.csv", "a;b\n1;2\n")
    lines = spark.read.text(scratch).select(F.col("value"), F.col("_metadata.file_path").alias("path"),
                                            F.monotonically_increasing_id().alias("mid"))
    plan = lines.groupBy("path").agg(F.min(F.when(F.trim("value") != "", F.col("mid"))), F.bool_and(F.is_valid_utf8("value")),
                                     F.bool_or(records.ends_open(F.col("value"), ";")))._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_odd_names_and_blank_heads_are_read_or_reported(spark, scratch):
    for name in ("_x.csv", ".y.csv", "X.CSV", "other.txt"):
        write(f"{scratch}/g[1]/{name}", "id;name\n1;no\n")
    write(f"{scratch}/g[1]/b.csv", "\n  \nid;name\n2;yes\n")
    write(f"{scratch}/g[1]/c[2].csv", "id;name\n3;si\n")
    write(f"{scratch}/g[1]/empty.csv", "")
    write(f"{scratch}/g[1]/blank.csv", "\n \n")
    res = readers.read_delimited(spark, [f"{scratch}/g[1]"], ["id", "name"])
    assert sorted((r.id, r.name) for r in res.data.collect()) == [("2", "yes"), ("3", "si")]
    assert sorted((r.file, r.reason) for r in res.rejects.collect()) == [
        (".y.csv", "hidden_name"), ("X.CSV", "name_case"), ("_x.csv", "hidden_name"), ("blank.csv", "blank"),
        ("empty.csv", "empty")]


def test_first_root_ranks_first(spark, scratch):
    write(f"{scratch}/a/z.csv", "id;v\n1;from a\n")
    write(f"{scratch}/b/a.csv", "id;v\n1;from b\n2;b only\n")
    for roots, want in (([f"{scratch}/a", f"{scratch}/b"], "from a"), ([f"{scratch}/b", f"{scratch}/a"], "from b")):
        rows = readers.read_delimited(spark, roots, ["id", "v"]).data.collect()
        assert min((r._ord, r.v) for r in rows if r.id == "1")[1] == want
