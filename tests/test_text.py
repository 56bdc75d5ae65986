"""Operator tests for the string functions (X1-X19, N1-N4) on edge rows
(FIXTURES §3)."""

import random
import string

from pyspark.sql import functions as F

from cctally.functions import text as T


def col1(spark, values, expr, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_agent_name_presets(spark):
    vals = ["x_y_ana pérez_z; w", "x_y_ana", "x_ana", "ana", None, "  "]
    assert col1(spark, vals, T.agent_name_accumulated) == ["ana pérez", "y", "x", "ana", "", ""]
    assert col1(spark, vals, T.agent_name_consolidated) == [
        "Ana Pérez", "Ana", "X_Ana", "Ana", "Discador", "Discador"]


def test_disposition(spark):
    vals = ["C1; LABEL A; t", "ONLY", "  ", None, "a;  b  "]
    assert col1(spark, vals, T.disposition) == ["LABEL A", "ONLY", None, None, "b"]


def test_phone_suffix(spark):
    assert col1(spark, ["56900000001", "123", "", None, " 56911112222 "],
                lambda c: T.phone_suffix(c, 9)) == ["900000001", "123", None, None, "911112222"]


def test_unicode_blanks_and_title(spark):
    assert col1(spark, ["a   b", "  x  "], T.collapse_ws) == ["a b", "x"]
    assert col1(spark, ["perez-lopez o'neil x2b", "ANDRÉS  felipe"], T.collapse_title) == [
        "Perez-Lopez O'Neil X2B", "Andrés Felipe"]


def test_title_matches_python_on_random_latin_text(spark):
    rnd = random.Random(7)
    alphabet = string.ascii_letters + "áéíóúñÑÁÉ" + " -'_0123456789.,"
    vals = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    vals += ["ß straße", "ǆemal", "a\tb\nc", "x\xa0y", "--a--b", ""]
    assert col1(spark, vals, T.title_case) == [v.title() for v in vals]


def test_repair_longest_first(spark):
    mapping = {"\xc3\xa3": "a", "\xc3\xa3S": "es"}
    assert col1(spark, ["Andr\xc3\xa3S", "S\xc3\xa3o"], lambda c: T.repair_text(c, mapping)) == ["Andres", "Sao"]


def test_replace_values_single_pass(spark):
    m = {"a": "b", "b": "a"}
    assert col1(spark, ["a", "b", "c", None], lambda c: T.replace_values(c, m)) == ["b", "a", "c", None]


def test_name_swap(spark):
    assert col1(spark, ["Perez, Ana", "Ana Perez", " A , B, C"], T.name_swap) == ["Ana Perez", "Ana Perez", "B, C A"]


def test_numeric_id_text(spark):
    assert col1(spark, ["00123", "12.0", "x", None, "12.5", " 7 "], T.numeric_id_text) == [
        "123", "12", None, None, None, "7"]


def test_na_tokens_and_after_equals(spark):
    assert col1(spark, ["NA", "null", "-", "", "ok"], T.na_to_null) == [None, None, "-", None, "ok"]
    assert col1(spark, ["k=v=w", "plain", "k="], T.after_equals) == ["v=w", "plain", ""]


def test_time_modes(spark):
    vals = ["10:15", "9:05", "10:15:30", None, "25:00"]
    assert col1(spark, vals, lambda c: T.hhmm(c, "strict")) == ["10:15", "09:05", "00:00", "00:00", "00:00"]
    assert col1(spark, vals, lambda c: T.hhmm(c, "prefix")) == ["10:15", "9:05", "10:15", "00:00", "25:00"]


def test_no_python_udf_in_text_plans(spark):
    df = spark.createDataFrame([("x_y_Ana b",)], "s string")
    plan = df.select(T.agent_name_consolidated("s"), T.collapse_title("s"))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_whitespace_matches_python(spark):
    ws = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
    vals = [ws + "a" + ws + "b" + ws, "\x1c x 　", "​ zero-width stays ​", "plain"]
    assert col1(spark, vals, T.py_strip) == [v.strip() for v in vals]
    assert col1(spark, vals, T.collapse_ws) == [" ".join(v.split()) for v in vals]
