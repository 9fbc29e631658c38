"""Date text in many layouts to DATE, without exception-driven parsing.

Each layout is one anchored pattern; its pieces are cut out with plain string functions and ``try_cast``
checks the calendar. A text that is no date costs a pattern test, not a thrown parse error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month abbreviations in calendar order, three letters each.
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
MONTH_NAMES = (
    "january|february|march|april|may|june|july|august|september|october|november|december"
    "|jan|feb|mar|apr|jun|jul|aug|sep|oct|nov|dec"
)
ABBREVIATIONS = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"

DAY = "(?: [1-9]|[0-9]{1,2})"
YEAR = "(?!0000)[0-9]{4}"
CLOCK = r"(?:2[0-3]|[01]?[0-9]):[0-5]?[0-9]:[0-5]?[0-9](?:\.[0-9]{1,6})?"

ISO_STAMP = rf"^{YEAR}-[0-9]{{1,2}}-{DAY}(?:(?:T|\s+){CLOCK})?$"
SLASHED = rf"^{DAY}/{DAY}/{YEAR}$"
YEAR_FIRST = rf"^{YEAR}/[0-9]{{1,2}}/{DAY}$"
DAY_MONTH = rf"(?i)^{DAY}-(?:{ABBREVIATIONS})-(?:{YEAR}|[0-9]{{2}})$"
WRITTEN = rf"(?i)^(?:{MONTH_NAMES})\s+{DAY},?\s+{YEAR}$"
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def _piece(c: Column, mark: str, n: int) -> Column:
    """The n-th piece (from 1) between marks."""
    return F.substring_index(F.substring_index(c, mark, n), mark, -1)


def _calendar(year: Column, month: Column, day: Column) -> Column:
    """DATE from texts, null where no such day exists."""
    return F.concat_ws("-", year, F.trim(month), F.trim(day)).try_cast("date")


def _month_number(name: Column) -> Column:
    return ((F.instr(F.lit(MONTHS), F.lower(F.substring(name, 1, 3))) + 2) / 3).cast("int").cast("string")


def _iso(c: Column) -> Column:
    return F.when(c.rlike(ISO_STAMP), F.replace(c, F.lit("- "), F.lit("-")).try_cast("date"))


def _slashed(c: Column) -> Column:
    first, second, year = _piece(c, "/", 1), _piece(c, "/", 2), F.right(c, F.lit(4))
    return F.when(c.rlike(SLASHED), F.coalesce(_calendar(year, first, second), _calendar(year, second, first)))


def _day_month(c: Column) -> Column:
    year = F.substring_index(c, "-", -1)
    full = F.when(F.length(year) == 4, year).when(year >= "69", F.concat(F.lit("19"), year)).otherwise(F.concat(F.lit("20"), year))
    return F.when(c.rlike(DAY_MONTH), _calendar(full, _month_number(_piece(c, "-", 2)), _piece(c, "-", 1)))


def _written(c: Column) -> Column:
    day = F.regexp_extract(c, r"([0-9]{1,2}),?\s+[0-9]{4}$", 1)
    return F.when(c.rlike(WRITTEN), _calendar(F.right(c, F.lit(4)), _month_number(c), day))


def messy_date(c: Column) -> Column:
    """Thirteen accepted layouts of trimmed text; month-first wins where both slash readings are possible.

    The first character and a slash decide which layouts are worth a pattern test.
    """
    from_digit = F.when(c.contains("/"), _slashed(c)).otherwise(F.coalesce(_iso(c), _day_month(c)))
    return F.when((c >= "0") & (c < ":"), from_digit).when((c >= "A") & (c < "{"), _written(c))


def answer_date(c: Column) -> Column:
    """A date typed into an intake answer: spreadsheet day number, or one of four layouts."""
    text = F.trim(c)
    serial = F.when(text.rlike(r"^[0-9]+(\.[0-9]+)?$"), F.floor(text.try_cast("double")).cast("int"))
    iso = rf"^{YEAR}-[0-9]{{1,2}}-[0-9]{{1,2}}(?: .*)?$"
    return F.coalesce(
        F.when(serial > 0, F.date_add(F.lit("1899-12-30").cast("date"), serial)),
        F.when(text.rlike(iso), text.try_cast("date")),
        _slashed(text),
        F.when(text.rlike(YEAR_FIRST), _calendar(_piece(text, "/", 1), _piece(text, "/", 2), _piece(text, "/", 3))),
    )


def is_iso_date(c: Column) -> Column:
    return c.rlike(ISO_DATE)
