"""Rules (C1-C6, F1-F9) and dates."""

import datetime as dt

from pyspark.sql import functions as F

from cctally.functions import dates as D
from cctally.functions import rules as R


def test_flags_never_null(spark):
    df = spark.createDataFrame([("A",), (None,), ("B",)], "s string")
    out = [tuple(r) for r in df.select(R.flag_in("s", ["A"]), R.flag_eq("s", "B"),
                                       R.label_in("s", ["A"], "yes", "no")).collect()]
    assert out == [(1, 0, "yes"), (0, 0, "no"), (0, 1, "no")]


def test_tenure_boundaries(spark):
    df = spark.createDataFrame([(None,), (6,), (7,), (36,), (37,)], "d int")
    assert [r[0] for r in df.select(R.tenure_band("d")).collect()] == [
        "No aplica", "OJT", "Prematuro", "Prematuro", "Vigente"]


def test_first_match_order_decides(spark):
    rules = ((("CONFIRM", "Q001"), "confirm"), (("Q001",), "main"))
    df = spark.createDataFrame([("CONFIRM Q001",), ("X Q001",), ("none",)], "s string")
    assert [r[0] for r in df.select(R.first_match("s", rules)).collect()] == ["confirm", "main", None]


def test_exclude_keeps_nulls(spark):
    df = spark.createDataFrame([(" piloto ",), (None,), ("keep",)], "s string")
    assert df.where(R.not_in_upper("s", ["PILOTO"])).count() == 2


def test_month_window_and_day_first(spark):
    as_of = "2026-04-15"
    # first of month - 11, - 10, last day, next day, invalid, null
    df = spark.createDataFrame([("21/03/2026",), ("22/03/2026",), ("30/04/2026",), ("01/05/2026",),
                                ("31/02/2026",), (None,)], "s string")
    kept = [r[0] for r in df.where(D.in_month_window(D.parse_day_first("s"), as_of)).collect()]
    assert kept == ["22/03/2026", "30/04/2026"]


def test_whole_days_floors(spark):
    df = spark.createDataFrame([("2026-01-01 10:00:00",), ("2026-01-31",), ("2026-02-02",)], "s string")
    out = [r[0] for r in df.select(D.whole_days(D.parse_timestamp("s"), "2026-01-31")).collect()]
    assert out == [29, 0, -2]


def test_ymd_and_month_paths(spark):
    df = spark.createDataFrame([("20260403",), ("20261345",), (None,)], "s string")
    assert [r[0] for r in df.select(D.ymd_to_dmy("s")).collect()] == ["03/04/2026", None, None]
    assert D.month_folder_paths("/r", dt.date(2026, 1, 9)) == ["/r/2026/01. Enero", "/r/2025/12. Diciembre"]
    assert spark.range(1).select(D.month_label(F.lit(dt.date(2026, 3, 1)))).first()[0] == "03. Marzo"


def test_today_in_zone_is_a_date(spark):
    d = spark.range(1).select(D.today_in("America/Santiago").alias("d")).first()["d"]
    assert isinstance(d, dt.date) and abs((d - dt.date.today()).days) <= 1
