"""Quality checks of a cleaned table, optionally per source file, and batch totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.dates import is_iso_date
from kpiloom.functions.numbers import round_even
from kpiloom.functions.text import snake_case
from kpiloom.operators import findings as fnd
from kpiloom.operators.cleaning import Cleaned
from kpiloom.operators.sets import distinct_with_copies
from kpiloom.plans.registry import ColumnRule

STATUSES = ("fail", "warn", "pass")

# Name parts that announce a date, the loose date shape, and its share that counts.
DATE_NAME_PARTS = {"date", "time", "posted", "created", "updated", "start", "end", "due", "expir", "at", "on"}
DATE_LIKE = r"\b\d{1,4}[/\-]\d{1,2}[/\-]\d{1,4}\b"
DATE_LIKE_SHARE = 0.2
# Expected type names and the column types that satisfy them.
ACCEPTED_TYPES = {"numeric": {"bigint", "double"}, "date": {"date"}, "string": {"string"}}
TYPE_LABELS = {"bigint": "Int64", "double": "Float64", "date": "Date", "string": "String"}


def table_counts(table: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per file: rows loaded and kept, nulls per column, date-like and ISO counts of date-named text.

    Takes the typed rows before duplicates are removed; one shuffle on the row counts both.
    """
    by = by or []
    types = {n: t for n, t in table.dtypes if n not in by}
    counts = [F.coalesce(F.sum("copies"), F.lit(0)).alias("rows_loaded"), F.count(F.lit(1)).alias("rows_output")]
    for c, kind in types.items():
        counts.append(F.count_if(F.col(c).isNull()).alias(f"nulls:{c}"))
        if kind == "string" and set(c.split("_")) & DATE_NAME_PARTS:
            counts += [F.count_if(F.col(c).rlike(DATE_LIKE)).alias(f"datelike:{c}"), F.count_if(is_iso_date(F.col(c))).alias(f"iso:{c}")]
    distinct = distinct_with_copies(table, "copies")
    return (distinct.groupBy(*by) if by else distinct.groupBy()).agg(*counts)


def null_rates(counts: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Share of nulls per column, four decimals."""
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), round_even(_rate(f"nulls:{c}"), 4).alias("null_rate")) for c in columns
    ])
    return counts.select(*(by or []), F.inline(rows))


def _rate(name: str) -> Column:
    return F.coalesce(F.try_divide(F.col(f"`{name}`"), F.col("rows_output")), F.lit(0.0))


def _percent(rate: Column) -> Column:
    return F.concat(F.format_number(rate * 100, 1), F.lit("%"))


def name_findings(raw_columns: list[str], columns: list[str], required: list[str], is_csv: bool = True) -> list[tuple]:
    """Checks on headers alone: a single-column parse and required columns."""
    rows = []
    if is_csv and len(raw_columns) == 1:
        rows.append(("single_column", fnd.WARNING, None, 1,
                     "suspicious single-column parse: CSV loaded as 1 column — file may use a non-comma delimiter"))
    for wanted in required:
        snake = snake_case(wanted)
        if wanted in columns:
            continue
        if snake in columns:
            rows.append(("required_renamed", fnd.WARNING, wanted, 1,
                         f"required column '{wanted}' was renamed to '{snake}' during cleaning"
                         f" — update required_columns to use '{snake}'"))
        else:
            rows.append(("required_missing", fnd.ERROR, wanted, 1, f"required column missing: '{wanted}'"))
    return rows


def _rule_candidates(table: DataFrame, rules: dict[str, ColumnRule]) -> list[Column]:
    types, found = dict(table.dtypes), []
    for key, rule in rules.items():
        wanted = rule.rename or key
        c = wanted if wanted in types else snake_case(wanted)
        if c not in types:
            continue
        nulls = F.col(f"`nulls:{c}`")
        if not rule.nullable:
            found.append(fnd.candidate("not_nullable", fnd.WARNING, c, nulls, F.concat(
                F.lit(f"column '{c}' has "), nulls.cast("string"), F.lit(" null(s) but is configured as nullable: false"))))
        accepted = ACCEPTED_TYPES.get(rule.type)
        if accepted and types[c] not in accepted:
            found.append(fnd.candidate("wrong_type", fnd.WARNING, c, F.lit(1), F.lit(
                f"column '{c}': expected type '{rule.type}' but got '{TYPE_LABELS.get(types[c], types[c])}'")))
    return found


def data_findings(
    table: DataFrame,
    by: list[str] | None = None,
    null_threshold: float = 0.3,
    duplicate_threshold: float = 0.3,
    rules: dict[str, ColumnRule] | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Findings from counts: empty input, duplicates, null rates, leftover dates, column rules.

    ``counts``: the result of table_counts() for this table, where it is already at hand.
    """
    by = by or []
    counts = counts if counts is not None else table_counts(table, by)
    columns = [c for c in table.columns if c not in by]
    loaded, kept = F.col("rows_loaded"), F.col("rows_output")
    duplicates = loaded - kept
    duplicate_rate = F.coalesce(F.try_divide(duplicates, loaded), F.lit(0.0))

    candidates = [
        fnd.candidate("empty", fnd.ERROR, None, F.when(loaded == 0, 1).otherwise(0), F.lit("empty file: 0 rows loaded")),
        fnd.candidate("nothing_left", fnd.ERROR, None, F.when((loaded > 0) & (kept == 0), loaded).otherwise(0),
                      F.lit("0 rows remain after cleaning")),
        fnd.candidate("duplicate_rate", fnd.WARNING, None,
                      F.when((duplicate_rate > duplicate_threshold) & (duplicates >= 2), duplicates).otherwise(0),
                      F.concat(F.lit("high duplicate rate: "), _percent(duplicate_rate), F.lit(" of rows are duplicates"))),
    ]
    for c in columns:
        rate = _rate(f"nulls:{c}")
        candidates.append(fnd.candidate("null_rate", fnd.WARNING, c,
                                        F.when(rate > null_threshold, F.col(f"`nulls:{c}`")).otherwise(0),
                                        F.concat(F.lit(f"high null rate in '{c}': "), _percent(rate))))
    for c in [name.split(":", 1)[1] for name in counts.columns if name.startswith("datelike:")]:
        present = kept - F.col(f"`nulls:{c}`")
        suspicious = (present > 0) & (F.col(f"`datelike:{c}`") / present >= DATE_LIKE_SHARE) & (F.col(f"`iso:{c}`") < present)
        candidates.append(fnd.candidate("mixed_dates", fnd.WARNING, c,
                                        F.when(suspicious, present - F.col(f"`iso:{c}`")).otherwise(0),
                                        F.lit(f"date-like column '{c}': mixed valid/invalid date values remain after cleaning")))
    candidates += _rule_candidates(table, rules or {})
    return fnd.raised(counts, candidates, by)


def validate(
    cleaned: Cleaned,
    table: DataFrame | None = None,
    required: list[str] | None = None,
    null_threshold: float = 0.3,
    duplicate_threshold: float = 0.3,
    rules: dict[str, ColumnRule] | None = None,
    is_csv: bool = True,
) -> DataFrame:
    """All findings of one table. ``table`` is the typed table after renames, if any were applied."""
    table = table if table is not None else cleaned.typed
    raw_columns = [c for c in cleaned.raw.columns if c not in cleaned.keep]
    names = name_findings(raw_columns, table.columns, required or [], is_csv)
    return fnd.known(table.sparkSession, names).unionByName(data_findings(table, None, null_threshold, duplicate_threshold, rules))


def file_statuses(files: DataFrame, findings: DataFrame, by: list[str]) -> DataFrame:
    """Status per file; files without findings pass. ``files`` has one row per file."""
    counted = fnd.counts_of(findings, by)
    joined = files.join(counted, by, "left").fillna(0, ["error_count", "warning_count"])
    return joined.withColumn("status", fnd.status_of(STATUSES))


def worst_status(statuses: DataFrame) -> DataFrame:
    rank = F.min(F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("status")))
    return statuses.agg(F.coalesce(F.element_at(F.array(*[F.lit(s) for s in STATUSES]), rank.cast("int")), F.lit("pass")).alias("status"))


def batch_totals(statuses: DataFrame, block_on_fail: bool = False, failed_files: dict[str, str] | None = None) -> DataFrame:
    """One summary row over per-file statuses (rows_loaded, rows_output, load_warnings, status).

    The warnings counted here are those raised while loading, such as over-long rows; findings of the
    checks show in the status.
    """
    failed = F.count_if(F.col("status") == "fail")
    lost = failed_files or {}
    done = F.count(F.lit(1))
    return statuses.agg(
        (done + len(lost)).alias("files_found"), done.alias("files_processed"), F.lit(len(lost)).cast("bigint").alias("files_failed"),
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded_total"),
        F.coalesce(F.sum("rows_output"), F.lit(0)).alias("rows_output_total"),
        F.coalesce(F.sum(F.col("rows_loaded") - F.col("rows_output")), F.lit(0)).alias("duplicates_removed_total"),
        F.coalesce(F.sum("load_warnings"), F.lit(0)).alias("warnings_total"),
        failed.alias("files_failed_validation"),
        (failed if block_on_fail else F.lit(0).cast("bigint")).alias("files_export_blocked"),
    )
