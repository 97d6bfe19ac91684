import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sediment.functions import measures as m
from sediment.functions.keys import date_key, surrogate_key


def test_parse_decimal_edges(column):
    values = ["23.364,50", "135", "73,5", "0", "", "abc", "12345678901234567890", None, "1.234,567"]
    assert column(m.parse_decimal, values) == [
        Decimal("23364.50"), Decimal("135.00"), Decimal("73.50"), Decimal("0.00"), None, None, None, None,
        Decimal("1234.57"),
    ]


def test_format_then_parse_is_identity(spark):
    numbers = [Decimal(n) / 100 for n in (0, 1, 99, 100, 123456, -123456, 99999999999, 4447356)]
    df = spark.createDataFrame([(n,) for n in numbers], "v decimal(18,2)")
    back = df.select("v", m.parse_decimal(m.format_decimal("v")).alias("b")).collect()
    assert all(r["v"] == r["b"] for r in back)


def test_missing_number_is_shown_as_dash(column):
    assert column(lambda c: m.format_decimal(F.col(c).cast("decimal(18,2)")), ["1234.5", None]) == ["1.234,50", "—"]


def test_ratio_edges(spark):
    data = [(None, 5.0), (5.0, None), (5.0, 0.0), (0.0, 5.0), (23364.5, 7045.36), (5.0, -1.0), (None, None)]
    df = spark.createDataFrame(data, "n double, d double").coalesce(1)
    got = [tuple(r) for r in df.select(m.ratio("n", "d", 100), m.ratio_decimal("n", "d", 100)).collect()]
    assert got == [
        (None, None), (None, None), (None, None), (0.0, Decimal("0.0000")), (331.6296, Decimal("331.6296")),
        (None, None), (None, None),
    ]


def test_scaled_units_are_exact(spark):
    cents = list(range(0, 100000, 7))
    df = spark.createDataFrame([(c / 100, c) for c in cents], "v double, c bigint")
    bad = df.filter((m.scaled("v") != F.col("c")) | (m.from_scaled(m.scaled("v")) != F.col("v").cast("decimal(18,2)")))
    assert bad.count() == 0


def test_strict_add_and_flags(spark):
    df = spark.createDataFrame([(1, 2), (1, None), (None, None), (0, 0)], "a int, b int").coalesce(1)
    got = df.select(
        m.strict_add("a", "b"), m.complete("a", "b"), m.complete("a", "b", positive="b"), m.non_negative_violation("a", "b")
    )
    assert [tuple(r) for r in got.collect()] == [
        (3, True, True, False), (None, False, False, False), (None, False, False, False), (0, True, False, False),
    ]


QUANTITIES = {
    "2 x 10.000 + 30.000": (2, 50000),
    "1 x 20.000 + 2 x 10.000 + 3x30.000": (3, 130000),
    "7.500,50": (2, 7550),
    "1.000 x 5": (2, 1005),
    "5000 litros e 2 X 500": (2, 6000),
    "2  x 7500": (1, 15000),
    "0": (1, 0),
}


@pytest.mark.parametrize("strict", [False, True])
def test_quantity_texts(spark, strict):
    texts = [*QUANTITIES, "cheia", None]
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    got = {r["raw"]: (r["terms"], r["total"], r["status"]) for r in m.with_quantity(df, "raw", strict=strict).collect()}
    for text, (terms, total) in QUANTITIES.items():
        if strict and text in ("7.500,50", "1.000 x 5"):
            assert got[text] == (None, None, m.STATUS_UNPARSED)
        else:
            assert got[text] == (terms, total, m.STATUS_PARSED)
    assert got["cheia"] == (None, None, m.STATUS_UNPARSED)
    assert got[None] == (None, None, m.STATUS_UNDECLARED)


def test_quantity_too_large_is_null_unread_and_not_fatal(spark):
    texts = ["99999999999999999999", "9223372036854775807 + 1", "9000000000000000000 x 3 + 5", "5 + 99999999999999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    got = [(r["total"], r["status"]) for r in m.with_quantity(df, "raw").collect()]
    assert got == [(None, m.STATUS_UNPARSED)] * 4


def brute_quantity(text):
    total, n = 0, 0
    for term in re.finditer(r"(?:([0-9]+)\s*x\s*)?([0-9][0-9.]*)", text.lower(), re.ASCII):
        total += int(term[1] or 1) * int(term[2].replace(".", ""))
        n += 1
    return (n, total) if n else (None, None)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="019.x X+e,\n", max_size=14), min_size=40, max_size=40))
def test_quantity_against_brute_force(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    for r in m.with_quantity(df, "raw").collect():
        assert (r["terms"], r["total"]) == brute_quantity(r["raw"]), r["raw"]


def test_gap_labels(spark):
    df = spark.createDataFrame(
        [(True, True, 1, 1), (False, False, None, None), (False, True, None, 1), (False, True, 1, None),
         (False, True, None, None), (False, True, 1, 0)],
        "ok boolean, measured boolean, a int, b int",
    ).coalesce(1)
    gap = m.classify_gap("ok", "measured", {"a": "A", "b": "B"}, "none", "missing ", " and ", "zero")
    assert [r[0] for r in df.select(gap).collect()] == [None, "none", "missing A", "missing B", "missing A and B", "zero"]


def test_keys(spark):
    df = spark.createDataFrame([(7, "A", None, "2026-08-17")], "id int, a string, b string, d string")
    got = df.select(
        surrogate_key("id"), surrogate_key("a", "b", "a"), date_key(F.col("d").cast("date"))
    ).first()
    import hashlib

    assert got[0] == hashlib.md5(b"7").hexdigest()
    assert got[1] == hashlib.md5(b"A||A").hexdigest()
    assert got[2] == 20260817
