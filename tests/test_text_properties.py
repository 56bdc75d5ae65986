"""Property tests: the Column functions against small pure-Python models of
the per-value semantics (SURVEY §2.10), on generated text."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from cctally.functions import text as T

ALPHABET = st.sampled_from(list("abcXYZ ñÉ_;,.=-'0129") + ["\xa0", "\t", "  "])
TEXT = st.lists(ALPHABET, max_size=24).map("".join)
VALUES = st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=40)


def model_agent_b(v, missing="Discador"):
    if v is None or v.strip() == "":
        return missing
    head = v.split(";")[0]
    parts = head.split("_")
    picked = parts[2] if len(parts) >= 3 else head
    return picked.strip().title()


def model_agent_a(v):
    if v is None or v.strip() == "":
        return ""
    head = v.strip().split(";")[0].strip()
    if "_" in head:
        return head.split("_")[-2].strip()
    return head


def model_disposition(v):
    if v is None or v.strip() == "":
        return None
    parts = [p.strip() for p in v.split(";")]
    return parts[1] if len(parts) >= 2 else v


def model_phone(v):
    return v.strip()[-9:] if v is not None and v.strip() != "" else None


def model_name_swap(v):
    if v is None:
        return None
    if "," in v:
        last, first = v.split(",", 1)
        return first.strip() + " " + last.strip()
    return v.strip()


def model_numeric_id(v):
    if v is None:
        return None
    s = v.strip()
    if not re.fullmatch(r"[+-]?(\d+(\.\d*)?|\.\d+)", s):
        return None
    num = float(s)
    return str(int(num)) if num == int(num) else None


def run(spark, values, exprs):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [tuple(r) for r in df.select(*[e("s").alias(f"c{i}") for i, e in enumerate(exprs)]).collect()]


@settings(max_examples=25, deadline=None)
@given(VALUES)
def test_text_functions_match_models(spark, values):
    exprs = [T.py_strip, T.collapse_ws, T.title_case, lambda c: T.phone_suffix(c, 9), T.disposition,
             T.agent_name_consolidated, T.agent_name_accumulated, T.name_swap, T.numeric_id_text]
    got = run(spark, values, exprs)
    for v, row in zip(values, got):
        expect = (
            None if v is None else v.strip(),
            None if v is None else re.sub(r"\s+", " ", v).strip(),
            None if v is None else v.title(),
            model_phone(v), model_disposition(v), model_agent_b(v), model_agent_a(v), model_name_swap(v),
            model_numeric_id(v),
        )
        assert row == expect, (v, row, expect)
