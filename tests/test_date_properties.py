"""Property tests: date helpers against Python ``strptime`` models."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cctally.functions import dates as D
from cctally.functions import text as T
from cctally.operators.lookup import hot_keys

DAY_TEXT = st.one_of(
    st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2035, 12, 31)).flatmap(
        lambda d: st.sampled_from([d.strftime("%d/%m/%Y"), f"{d.day}/{d.month}/{d.year}", d.strftime("%Y%m%d")])),
    st.sampled_from(["31/02/2026", "00/01/2026", "1/13/2026", "x", "", "2026-01-01", "20261301", "2026010"]),
)
TIME_TEXT = st.one_of(
    st.tuples(st.integers(0, 30), st.integers(0, 70)).map(lambda t: f"{t[0]}:{t[1]:02d}"),
    st.tuples(st.integers(0, 23), st.integers(0, 59)).map(lambda t: f"{t[0]:02d}:{t[1]:02d}:30"),
    st.sampled_from(["", "10", "ab:cd", "7:5"]),
)


def model_day_first(v):
    if not re.fullmatch(r"\d{1,2}/\d{1,2}/\d{4}", v):
        return None
    try:
        return dt.datetime.strptime(v, "%d/%m/%Y").date()
    except ValueError:
        return None


def model_ymd(v):
    if not re.fullmatch(r"\d{8}", v):
        return None
    try:
        return dt.datetime.strptime(v, "%Y%m%d").strftime("%d/%m/%Y")
    except ValueError:
        return None


def model_strict_time(v):
    m = re.fullmatch(r"(\d{1,2}):(\d{1,2})", v)
    if not m or int(m.group(1)) > 23 or int(m.group(2)) > 59:
        return "00:00"
    return f"{int(m.group(1)):02d}:{int(m.group(2)):02d}"


@settings(max_examples=15, deadline=None)
@given(st.lists(DAY_TEXT, min_size=1, max_size=40), st.lists(TIME_TEXT, min_size=1, max_size=40))
def test_date_parsers_match_models(spark, days, times):
    df = spark.createDataFrame([(d,) for d in days], "s string")
    got = df.select(D.parse_day_first("s"), D.ymd_to_dmy("s")).collect()
    assert [(r[0], r[1]) for r in got] == [(model_day_first(d), model_ymd(d)) for d in days]
    tf = spark.createDataFrame([(t,) for t in times], "s string")
    assert [r[0] for r in tf.select(T.hhmm("s", "strict")).collect()] == [model_strict_time(t) for t in times]


def test_hot_key_list_is_bounded(spark):
    uniform = spark.range(20000).select((F.col("id") % 5000).cast("string").alias("k"))
    keys = hot_keys(uniform, F.col("k"), fraction=1.0, min_share=0.01)
    assert len(keys) <= 100 and keys == []
    skewed = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit("H"))
                                       .otherwise((F.col("id") % 5000).cast("string")).alias("k"))
    assert hot_keys(skewed, F.col("k"), fraction=0.2, min_share=0.01) == ["H"]
