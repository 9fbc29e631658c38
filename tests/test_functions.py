"""Scalar rules on hand-written cells."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kpiloom.functions import numbers as nb
from kpiloom.functions import text as tx
from kpiloom.functions.dates import answer_date, messy_date


def values(spark, cells, kind, change):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")
    return [r.v for r in df.select("i", change(F.col("c")).alias("v")).orderBy("i").collect()]


def test_headers():
    given = [" First Name ", "Last-Name", "Price / kW", "Total Revenue ($)", "a.b  c", "__x__", "Contract  Start"]
    assert [tx.snake_case(h) for h in given] == ["first_name", "last_name", "price_kw", "total_revenue", "a_b_c", "x", "contract_start"]
    assert tx.snake_case("a&b") == "ab" and tx.match_key("a&b") == "a_b"


def test_trim_all_white_space(spark):
    assert values(spark, ["  a b ", "\t x　", " ", "", None], "string", tx.trimmed) == ["a b", "x", None, None, None]


def test_plain_numbers(spark):
    given = ["1,250", "$499", "33%", "(200)", "€ 1,234.50", "($200)", "33%%", "call 5,000 first", "n/a", "(1,200.5)", "%", None, "1,2,3"]
    want = ["1250", "499", "33", "-200", "1234.50", "($200)", "33%", "call 5000 first", "n/a", "-1200.5", None, None, "123"]
    assert values(spark, given, "string", lambda c: tx.null_if_empty(tx.plain_number(c))) == want


def test_power_units(spark):
    given = ["4.5 MW", "15kW", "1,500 kw", "1.001 mw", "12", "2 GW", "1.2.3 MW", None]
    got = values(spark, given, "string", lambda c: F.coalesce(tx.number_text(tx.kilowatts(c)), c))
    assert got == ["4500", "15", "1500", "1000.9999999999999", "12", "2 GW", "1.2.3 MW", None]


def test_number_text_has_no_exponent(spark):
    assert values(spark, [12345678.5, 5.0, 0.25, 1e17], "double", tx.number_text) == ["12345678.5", "5", "0.25", "100000000000000000"]


def test_numeric_text_guards(spark):
    assert values(spark, ["1d", "1e3", ".5", "5.", "abc", "-2", "+7"], "string", tx.as_double) == [None, 1000.0, 0.5, 5.0, None, -2.0, 7.0]
    assert values(spark, ["12", "12.0", "99999999999999999999"], "string", tx.as_long) == [12, None, None]


@pytest.mark.parametrize("text, want", [
    ("2024-03-05", (2024, 3, 5)), ("03/05/2024", (2024, 3, 5)), ("25/12/2024", (2024, 12, 25)), ("5-Jan-24", (2024, 1, 5)),
    ("5-jan-75", (1975, 1, 5)), ("5-Jan-68", (2068, 1, 5)), ("5-Jan-2024", (2024, 1, 5)), ("March 5 2024", (2024, 3, 5)), ("March  5, 2024", (2024, 3, 5)),
    ("Mar 5 2024", (2024, 3, 5)), ("MAY 5, 2024", (2024, 5, 5)), ("2024-03-05 14:30:00", (2024, 3, 5)), ("2024-03-05T14:30:00", (2024, 3, 5)),
    ("2024-03-05 14:30:00.12", (2024, 3, 5)), ("2024-03-05T14:30:00.000001", (2024, 3, 5)), ("2024-02-30", None), ("24-03-05", None),
    ("TBD", None), ("0000-01-01", None), ("2024-03-05 24:00:00", None), ("13/13/2024", None), ("2024-003-05", None), ("Marc 5 2024", None), ("2024", None),
])
def test_messy_dates(spark, text, want):
    assert values(spark, [text], "string", messy_date) == [dt.date(*want) if want else None]


def test_answer_dates(spark):
    given = ["45292", "2024-01-01", "01/02/2024", "31/01/2024", "2024/01/31", "soon", "0", None]
    d = dt.date
    assert values(spark, given, "string", answer_date) == [d(2024, 1, 1), d(2024, 1, 1), d(2024, 1, 2), d(2024, 1, 31), d(2024, 1, 31), None, None, None]


def test_display_matches_python_formatting(spark):
    given = [0.0, 66.7, 50.0, 1234567.0, 1e-4, 999999.5, -3.25, 66.65, 0.25, 12345.678, 1e9]
    assert values(spark, given, "double", nb.percent_text) == [f"{v:g}%" for v in given]
    assert values(spark, given, "double", lambda c: nb.card_value(c, F.lit("%"))) == [f"{v:.1f}%" for v in given]
    assert values(spark, given, "double", lambda c: nb.display_value(c, F.lit("USD"))) == [f"${v:,.2f}" for v in given]
    plain = [f"{int(v):,}" if v == int(v) else f"{v:,}" for v in given]
    assert values(spark, given, "double", lambda c: nb.display_value(c, F.lit("MW"))) == plain
    assert values(spark, [None, float("nan")], "double", lambda c: nb.display_value(c, F.lit("MW"))) == ["", ""]


def test_round_half_even(spark):
    given = [0.5, 1.5, 2.5, -0.5, 2.675]
    assert values(spark, given, "double", lambda c: nb.round_even(c, 0)) == [0.0, 2.0, 2.0, -0.0, 3.0]


def test_labels_and_bands(spark):
    assert values(spark, ["site_control", "NAM", "o'neil-x", "A_B"], "string", nb.segment_label) == ["Site Control", "NAM", "O'Neil-X", "A B"]
    assert values(spark, [70.0, 50.0, 49.9], "double", nb.completion_colour) == [nb.GREEN, nb.AMBER, nb.RED]
    assert values(spark, [-4.0, 55.5, 180.0], "double", nb.bar_width) == [0, 56, 100]
    assert values(spark, [0.31, 0.3, 0.06, 0.05], "double", nb.null_rate_band) == ["hi", "mid", "mid", "ok"]
    assert values(spark, [1, 2, None], "int", lambda c: nb.counted(c, "open gap")) == ["1 open gap", "2 open gaps", None]
