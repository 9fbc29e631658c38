"""Rounding and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kpiloom.functions.text import title_text


def round_even(c: Column, decimals: int) -> Column:
    """Round half to even on the scaled binary value."""
    power = float(10**decimals)
    return F.rint(c * power) / power if decimals else F.rint(c)


def ratio_in_cents(part: Column, whole: Column, scale: int, times: int = 1) -> Column:
    """part / whole * times to two decimals, half away from zero, rounded once; null over zero.

    Both are decimals of at most ``scale`` decimals. The division is one of whole numbers, so no digit is lost before it.
    """
    a = F.abs(part.cast("decimal(38,6)") * 10**scale).cast("decimal(28,0)") * (200 * times)
    b = F.abs(whole.cast("decimal(38,6)") * 10**scale).cast("decimal(28,0)")
    cents = F.call_function("div", a.cast("decimal(38,0)") + b, F.nullif((b * 2).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")))
    amount = (cents.cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("double")
    return amount * F.signum(part.cast("double")) * F.signum(whole.cast("double"))


def _plain(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(""))


def general(c: Column) -> Column:
    """Six significant digits, no trailing zeros, exponent only when very small or large."""
    scientific = F.format_string("%.5e", c)
    exponent = F.regexp_extract(scientific, r"e([+-][0-9]+)$", 1).try_cast("int")
    fixed = _plain(F.call_function("format_number", c, F.greatest(F.lit(5) - exponent, F.lit(0))))
    shortened = F.regexp_replace(F.regexp_replace(fixed, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    mantissa = F.regexp_replace(scientific, r"\.?0*e", "e")
    return F.when(c == 0, "0").when(exponent.between(-4, 5), shortened).otherwise(mantissa)


def _tiny(value: Column) -> Column:
    """Shortest digits with an exponent of two places, for numbers nearer to zero than 0.0001."""
    shortest = value.cast("string")
    digits = F.regexp_replace(F.substring_index(shortest, "E", 1), r"\.0$", "")
    return F.concat(digits, F.lit("e-"), F.lpad(F.substring_index(shortest, "E-", -1), 2, "0"))


def display_value(value: Column, unit: Column) -> Column:
    """Report text: dollars with cents, percent in short form, otherwise digits with commas."""
    text = (
        F.when(unit == "USD", F.concat(F.lit("$"), F.format_number(value, 2)))
        .when(unit == "%", F.concat(general(value), F.lit("%")))
        .when(value == F.rint(value), F.format_number(value, 0))
        .when(F.abs(value) < 1e-4, _tiny(value))
        .otherwise(F.call_function("format_number", value, F.lit("#,##0.0################")))
    )
    return F.when(value.isNull() | F.isnan(value), "").otherwise(text)


def percent_text(value: Column) -> Column:
    return display_value(value, F.lit("%"))


def card_value(value: Column, unit: Column) -> Column:
    """Dashboard text: percent with one decimal, otherwise the nearest whole number."""
    return (
        F.when(value.isNull() | F.isnan(value), "—")
        .when(unit == "%", F.concat(_plain(F.format_number(value, 1)), F.lit("%")))
        .otherwise(F.rint(value).cast("bigint").cast("string"))
    )


def segment_label(c: Column) -> Column:
    """All-capital names stay; others lose underscores and get title case."""
    shouting = (F.upper(c) == c) & (F.lower(c) != c) & ~c.contains("_")
    return F.when(shouting, c).otherwise(title_text(F.replace(c, F.lit("_"), F.lit(" "))))


# Traffic-light colours.
GREEN, AMBER, RED = "#27ae60", "#f39c12", "#e74c3c"


def completion_colour(pct: Column) -> Column:
    return F.when(pct >= 70, GREEN).when(pct >= 50, AMBER).otherwise(RED)


def bar_width(pct: Column) -> Column:
    return F.least(F.lit(100), F.greatest(F.lit(0), F.rint(pct).cast("int")))


def null_rate_band(rate: Column) -> Column:
    pct = round_even(rate * 100, 1)
    return F.when(pct > 30, "hi").when(pct > 5, "mid").otherwise("ok")


def counted(n: Column, noun: str) -> Column:
    """'1 gap', '2 gaps'."""
    whole = n.cast("bigint")
    return F.concat(whole.cast("string"), F.lit(f" {noun}"), F.when(whole != 1, "s").otherwise(""))
