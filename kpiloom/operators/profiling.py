"""Column and table profiles of a cleaned table, optionally per source file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import text as tx
from kpiloom.functions.dates import is_iso_date
from kpiloom.operators.cleaning import Cleaned
from kpiloom.operators.sets import distinct_with_copies

# Words in a column name that settle what a number or text means.
CURRENCY_WORDS = ["revenue", "cost", "price", "amount", "fee", "salary", "income", "spend", "budget", "payment", "charge"]
ID_WORDS = {"id", "code", "key", "uuid", "ref"}

TYPE_NAMES = {"date": "Date", "iso_text": "String", "text": "String", "bigint": "Int64", "double": "Float64"}


def type_name(cleaned: Cleaned, column: str) -> str:
    kind = cleaned.kinds[column]
    return TYPE_NAMES[kind] if kind != "kept" else dict(cleaned.typed.dtypes)[column]


def row_counts(cleaned: Cleaned, by: list[str] | None = None) -> DataFrame:
    """rows_loaded, rows_output, duplicates_removed and columns, from one shuffle of the typed rows."""
    counted = distinct_with_copies(cleaned.typed, "copies")
    grouped = counted.groupBy(*by) if by else counted.groupBy()
    return grouped.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_loaded"), F.count(F.lit(1)).alias("rows_output"),
    ).withColumns({
        "duplicates_removed": F.col("rows_loaded") - F.col("rows_output"), "columns": F.lit(len(cleaned.kinds)),
    })


def _number_meaning(column: str) -> str | None:
    if any(word in column for word in CURRENCY_WORDS):
        return "currency"
    return "power_kw" if tx.is_power_name(column) else None


def _meaning_rule(cleaned: Cleaned, column: str) -> str:
    """The semantic type where kind and name settle it; otherwise which counts decide."""
    kind = cleaned.kinds[column]
    if kind == "kept":
        declared = dict(cleaned.typed.dtypes)[column]
        kind = "date" if declared == "date" else "double" if declared in ("bigint", "int", "double") else "other"
    if kind == "date":
        return "date"
    if kind in ("bigint", "double"):
        return _number_meaning(column) or "by signs"
    if kind == "other":
        return "text"
    return "by dates, else identifier" if set(column.split("_")) & ID_WORDS else "by dates, else text"


def semantic_type(rule: Column) -> Column:
    """What a column means, from its rule and counts of ISO dates and currency signs."""
    iso, present = F.col("iso"), F.col("present")
    mostly = (iso / present >= 0.7) | ((iso >= 3) & (iso > present / 2))
    by_dates = (
        F.when(present == 0, "text").when(mostly & (iso == present), "date").when(mostly, "date_mixed_invalid")
        .otherwise(F.substring_index(rule, " ", -1))
    )
    by_signs = F.when(F.coalesce("signs", F.lit(0)) > 0, "currency").otherwise("numeric")
    return F.when(rule == "by signs", by_signs).when(rule.startswith("by dates"), by_dates).otherwise(rule)


def _date_rule(cleaned: Cleaned, column: str) -> str:
    """Whether the column was turned into dates: yes, no, or to be decided by counts."""
    kind = cleaned.kinds[column]
    if kind == "kept":
        source = {v: k for k, v in cleaned.headers.items()}[column]
        stamp = dict(cleaned.raw.dtypes)[source].startswith("timestamp") and dict(cleaned.typed.dtypes)[column] == "date"
        return "yes" if stamp else "no"
    return {"date": "yes", "iso_text": "by dates", "text": "by dates"}.get(kind, "no")


def normalized_to_date(rule: Column) -> Column:
    """Text or datetime that became a date, or text that became uniform ISO text."""
    uniform = (F.col("present") > 0) & (F.col("iso") == F.col("present"))
    was_uniform = F.coalesce((F.col("raw_present") > 0) & (F.col("raw_iso") == F.col("raw_present")), F.lit(False))
    return F.when(rule == "by dates", uniform & ~was_uniform).otherwise(rule == "yes")


def _per_column(df: DataFrame, by: list[str], columns: list[str], measures: dict) -> DataFrame:
    """Counts of many columns from one aggregate, turned to one row per column."""
    wide = [expr(c).alias(f"{name}:{c}") for c in columns for name, expr in measures.items()]
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{name}:{c}`").alias(name) for name in measures]) for c in columns
    ])
    return df.groupBy(*by).agg(*wide).select(*by, F.inline(rows))


def column_profile(cleaned: Cleaned, by: list[str] | None = None) -> DataFrame:
    """One row per column: type, nulls, semantic type, and what cleaning changed.

    Counts of the cleaned side come from the distinct rows, counts of the raw side from the raw text;
    each is one aggregate for all columns, and the two meet per column (and file).
    """
    by = by or []
    source = {clean: raw for raw, clean in cleaned.headers.items()}
    raw_types, typed = dict(cleaned.raw.dtypes), dict(cleaned.typed.dtypes)
    columns = list(cleaned.kinds)
    was_text = [c for c in columns if raw_types[source[c]] == "string"]

    def before(c: str) -> Column:
        return F.col(f"`{source[c]}`")

    after = _per_column(cleaned.table, by, columns, {
        "nulls": lambda c: F.count_if(F.col(c).isNull()), "present": lambda c: F.count(F.col(c)),
        "iso": lambda c: F.count_if(is_iso_date(F.col(c))) if typed[c] == "string" else F.lit(0).cast("bigint"),
    })
    if was_text:
        raw_side = _per_column(cleaned.raw, by, was_text, {
            "raw_present": lambda c: F.count(before(c)), "raw_iso": lambda c: F.count_if(is_iso_date(before(c))),
            "signs": lambda c: F.count_if(F.btrim(before(c), F.lit(tx.UNICODE_SPACES)).rlike(f"^[{tx.CURRENCY_SIGNS}]")),
        })
        after = after.join(raw_side, [*by, "column"], "left")
    else:
        after = after.withColumns({c: F.lit(None).cast("bigint") for c in ("raw_present", "raw_iso", "signs")})

    def known(answer) -> Column:
        return F.create_map(*[F.lit(x) for c in columns for x in (c, answer(c))])[F.col("column")]

    def from_text(c: str) -> bool:
        return c in was_text and cleaned.kinds[c] in ("bigint", "double") and c not in cleaned.already_numeric

    return after.select(
        *by, "column", known(lambda c: type_name(cleaned, c)).alias("inferred_type"), F.col("nulls").alias("null_count"),
        semantic_type(known(lambda c: _meaning_rule(cleaned, c))).alias("semantic_type"), known(from_text).alias("number_from_text"),
        normalized_to_date(known(lambda c: _date_rule(cleaned, c))).alias("date_from_text"),
    )


def renamed_headers(cleaned: Cleaned) -> dict[str, str]:
    return {raw: clean for raw, clean in cleaned.headers.items() if raw != clean}


def profile_report(cleaned: Cleaned) -> DataFrame:
    """The whole profile as one row with nested maps and arrays, ready for JSON."""
    columns = column_profile(cleaned)

    def mapping(value: str) -> Column:
        return F.map_from_entries(F.collect_list(F.struct("column", value)))

    def flagged(flag: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col(flag), F.col("column"))))

    # one row per column of the table, so these collections are as long as the header
    nested = columns.agg(
        mapping("inferred_type").alias("inferred_types"), mapping("null_count").alias("null_counts"),
        mapping("semantic_type").alias("semantic_types"), flagged("number_from_text").alias("numeric_columns_normalized"),
        flagged("date_from_text").alias("date_columns_normalized"),
    )
    renamed = [F.lit(x) for pair in renamed_headers(cleaned).items() for x in pair]
    names = ("rows_loaded", "rows_output", "duplicates_removed")
    counts = row_counts(cleaned).select(F.struct(*names).alias("counts"))
    return (
        nested.withColumn("columns_renamed", F.create_map(*renamed)).withColumn("counts", counts.scalar())
        .select("*", *[F.col(f"counts.{n}") for n in names]).drop("counts")
    )
