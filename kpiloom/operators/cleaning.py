"""Messy text tables to typed tables.

The standardised text is written once, beside the text it came from; writing it also estimates how many different values each
column has. Kinds are decided on the different values with their counts, combined on the map side, so that a value is matched
against the patterns once however often it occurs; columns of mostly different values are matched row by row instead. One
projection applies the decisions. Only counts per column reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions import text as tx
from kpiloom.functions.dates import messy_date
from kpiloom.plans.registry import ColumnRule, ConfigError
from kpiloom.session import materialized

DATE_SHARE = 0.5  # at least this share of present values must read as dates
#: Up to this share of different values a column is matched by its values, above it row by row.
MOST_DIFFERENT = 0.5
_COUNTED = ("present", "date", "bigint", "double")


@dataclass
class Cleaned:
    raw: DataFrame
    typed: DataFrame  # every input row
    table: DataFrame  # without exact duplicates
    kinds: dict[str, str]  # clean column -> date | iso_text | bigint | double | text | kept
    headers: dict[str, str]  # raw column -> clean column
    already_numeric: set[str] = field(default_factory=set)
    keep: list[str] = field(default_factory=list)


def clean_headers(columns: list[str]) -> dict[str, str]:
    names = {c: tx.snake_case(c) for c in columns}
    taken: dict[str, list[str]] = {}
    for raw, clean in names.items():
        taken.setdefault(clean, []).append(raw)
    clashes = {k: v for k, v in taken.items() if len(v) > 1 or not k}
    if clashes:
        raise ConfigError(f"headers that become equal or empty: {clashes}")
    return names


def with_clean_headers(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    names = clean_headers([c for c in raw.columns if c not in (keep or [])])
    return raw.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in raw.columns])


def text_columns(df: DataFrame, keep: list[str] | None = None) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in (keep or [])]


def _map_text(df: DataFrame, change, keep: list[str] | None = None) -> DataFrame:
    return df.withColumns({c: change(F.col(c), c) for c in text_columns(df, keep)})


def null_sentinels(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return _map_text(df, lambda c, _: tx.null_if_sentinel(c), keep)


def clean_cells(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return _map_text(df, lambda c, _: tx.trimmed(c), keep)


def plain_numbers(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Number dressing stripped off all text cells.

    One expression serves the cells of a row as an array: written out per column, the patterns make generated code of more
    than the 8,000 bytes a method that the JVM compiles, and every row is interpreted then.
    """
    columns = text_columns(df, keep)
    if not columns:
        return df
    bare = df.withColumn("bare:", F.transform(F.array(*[F.col(f"`{c}`") for c in columns]), tx.plain_number))
    return bare.withColumns({c: tx.null_if_empty(F.col("`bare:`")[i]) for i, c in enumerate(columns)}).select(*[F.col(f"`{c}`") for c in df.columns])


def power_units(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Power texts to kW texts in columns named after power; the number is its own step, so it is read once."""
    powered = [c for c in text_columns(df, keep) if tx.is_power_name(c)]
    measured = df.withColumns({f"kw:{c}": tx.kilowatts(F.col(c)) for c in powered})
    shown = measured.withColumns({c: F.coalesce(tx.number_text(F.col(f"`kw:{c}`")), F.col(c)) for c in powered})
    return shown.select(*[F.col(f"`{c}`") for c in df.columns])


def datetimes_to_dates(df: DataFrame) -> DataFrame:
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({c: F.col(c).cast("date") for c in stamps})


def kind_counts(df: DataFrame, keep: list[str] | None = None) -> dict[str, Column]:
    """Aggregates that settle the kind of each text column."""
    counts: dict[str, Column] = {}
    for c in text_columns(df, keep):
        counts[f"present:{c}"] = F.count(F.col(c))
        counts[f"date:{c}"] = F.count(messy_date(F.col(c)))
        counts[f"bigint:{c}"] = F.count(tx.as_long(F.col(c)))
        counts[f"double:{c}"] = F.count(tx.as_double(F.col(c)))
    return counts


def decide_kind(present: int, dates: int, longs: int, doubles: int) -> str:
    if present == 0:
        return "text"
    if dates == present:
        return "date"
    if dates / present >= DATE_SHARE:
        return "iso_text"
    if longs == present:
        return "bigint"
    return "double" if doubles == present else "text"


def infer_kinds(standard: DataFrame, keep: list[str] | None = None, shares: dict[str, float] | None = None) -> tuple[dict[str, str], dict[str, int]]:
    """Kinds of all columns, and the counts they rest on. ``shares`` tells the share of different values where it is known; the others are matched row by row."""
    columns = text_columns(standard, keep)
    repeating = [c for c in columns if (shares or {}).get(c, 1.0) <= MOST_DIFFERENT]
    counts = {n: e for n, e in kind_counts(standard, keep).items() if n.split(":", 1)[1] not in repeating}
    seen = standard.agg(*[e.alias(n) for n, e in counts.items()]).first().asDict() if counts else {}
    if repeating:
        for r in value_counts(standard, repeating).collect():  # one row per column
            seen |= {f"{what}:{r.column}": r[what] for what in _COUNTED}
    kinds = {c: "kept" for c in standard.columns if c not in (keep or [])}
    for c in columns:
        kinds[c] = decide_kind(*(seen.get(f"{what}:{c}", 0) for what in _COUNTED))
    return kinds, seen


def value_counts(standard: DataFrame, columns: list[str]) -> DataFrame:
    """Per column how many values there are, and how many read as a date, a whole number and a number; each different value is read once."""
    cells = standard.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in columns])))
    values = cells.where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    reads = {"present": F.col("value"), "date": messy_date(F.col("value")), "bigint": tx.as_long(F.col("value")), "double": tx.as_double(F.col("value"))}
    return values.groupBy("column").agg(*[F.sum(F.when(x.isNotNull(), F.col("n")).otherwise(0)).alias(what) for what, x in reads.items()])


def apply_kinds(standard: DataFrame, kinds: dict[str, str]) -> DataFrame:
    def typed(name: str) -> Column:
        c, kind = F.col(name), kinds.get(name, "kept")
        if kind == "date":
            return messy_date(c)
        if kind == "iso_text":
            return F.coalesce(messy_date(c).cast("string"), c)
        if kind == "bigint":
            return tx.as_long(c)
        return tx.as_double(c) if kind == "double" else c

    return standard.select(*[typed(c).alias(c) for c in standard.columns])


def standardize(raw: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The steps that do not depend on the data: headers, cells, number dressing, units, datetimes."""
    return (
        with_clean_headers(raw, keep)
        .transform(clean_cells, keep).transform(plain_numbers, keep)
        .transform(power_units, keep).transform(datetimes_to_dates)
    )


def clean(raw: DataFrame, keep: list[str] | None = None) -> Cleaned:
    """All cleaning steps in their fixed order, ending with removal of exact duplicates.

    ``keep`` names columns such as the source file that are carried along untouched; duplicates are
    then only removed within the same values of those columns.
    """
    keep = keep or []
    raw = null_sentinels(raw, keep)
    headers = clean_headers([c for c in raw.columns if c not in keep])
    beside = raw.withColumns({f"raw:{clean_name}": F.col(f"`{c}`") for c, clean_name in headers.items()})
    carried = [f"raw:{c}" for c in headers.values()]
    stored, shares = _stored(standardize(beside, [*keep, *carried]), [*keep, *carried])
    kinds, _ = infer_kinds(stored, [*keep, *carried], shares)
    # which numbers were plain numbers in the raw text all along
    dressed = [c for c in text_columns(raw, keep) if kinds[headers[c]] in ("bigint", "double")]
    plain = [F.count(F.col(f"`raw:{headers[c]}`")) == F.count(tx.as_double(F.col(f"`raw:{headers[c]}`"))) for c in dressed]
    already = {headers[c] for c, yes in zip(dressed, stored.agg(*plain).first(), strict=True) if yes} if dressed else set()
    before = stored.select(*[F.col(f"`{c}`") if c in keep else F.col(f"`raw:{headers[c]}`").alias(c) for c in raw.columns])
    typed = apply_kinds(stored.drop(*carried), kinds)
    return Cleaned(before, typed, typed.dropDuplicates(), kinds, headers, already, keep)


def _stored(standard: DataFrame, keep: list[str]) -> tuple[DataFrame, dict[str, float]]:
    """The rows written to scratch and read back, and per text column its estimated share of different values."""
    columns = text_columns(standard, keep)
    if not columns:
        return materialized(standard, "standard"), {}
    seen = Observation()
    counts = [x for i, c in enumerate(columns) for x in (F.count(F.col(f"`{c}`")).alias(f"n{i}"), F.approx_count_distinct(F.col(f"`{c}`")).alias(f"d{i}"))]
    stored = materialized(standard.observe(seen, *counts), "standard")
    found = seen.get
    return stored, {c: found.get(f"d{i}", 0) / max(1, found.get(f"n{i}", 0)) for i, c in enumerate(columns)}


def rename_by_rule(df: DataFrame, rules: dict[str, ColumnRule]) -> DataFrame:
    """Apply rename rules; a rule key may be the exact column or the header it came from."""
    names = {}
    for key, rule in rules.items():
        source = key if key in df.columns else tx.snake_case(key)
        if rule.rename and source in df.columns:
            names[source] = rule.rename
    return df.withColumnsRenamed(names)


def select_output(df: DataFrame, columns: list[str]) -> DataFrame:
    """Wanted columns in the wanted order; unknown ones are skipped, none known leaves all."""
    present = [c for c in columns if c in df.columns]
    return df.select(*present) if present else df
