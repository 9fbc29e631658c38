"""Checks of a fact table before metrics are computed from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.operators import findings as fnd
from kpiloom.operators.ordering import iqr_outliers
from kpiloom.operators.schema import Normalized
from kpiloom.operators.sets import duplicate_rows
from kpiloom.plans.registry import Registry, rollup_label
from kpiloom.session import materialized

STATUSES = ("failed", "passed_with_warnings", "passed")


def column_findings(normalized: Normalized, registry: Registry) -> DataFrame:
    """What the column names alone reveal: missing inputs, dropped columns, skipped rollups."""
    columns = set(normalized.facts.columns)
    rows = [
        ("missing_input", fnd.ERROR, c, 1, f"Missing required metric input column: '{c}'")
        for c in registry.summed_columns if c not in columns
    ]
    rows += [
        ("missing_condition", fnd.ERROR, c, 1, f"Missing required condition column: '{c}'")
        for c in registry.condition_columns if c not in columns
    ]
    rows += [
        ("dropped_column", fnd.WARNING, c, 1, f"Column '{c}' was dropped (not recognized by schema)")
        for c in normalized.dropped
    ]
    for segment in sorted(set(normalized.missing_segments)):
        skipped = [list(r) for r in registry.rollups if segment in r]
        rows.append((
            "missing_segment", fnd.WARNING, segment, len(skipped),
            f"Optional segment column '{segment}' is missing from data; rollup(s) {skipped} will be skipped",
        ))
    return fnd.known(normalized.facts.sparkSession, rows)


def _text(n: Column) -> Column:
    return n.cast("bigint").cast("string")


def value_findings(facts: DataFrame, registry: Registry) -> DataFrame:
    """Nulls, zero denominators and impossible values, all from one aggregate row."""
    inputs = [c for c in registry.summed_columns if c in facts.columns]
    denominators = [c for c in registry.denominators if c in facts.columns]
    stats = {f"nulls:{c}": F.count_if(F.col(c).isNull()) for c in {*inputs, *denominators, "date"} if c in facts.columns}
    stats |= {f"zeros:{c}": F.count_if(F.col(c) == 0) for c in denominators}

    def stat(name: str) -> Column:
        return F.col(f"`{name}`")

    candidates = [
        fnd.candidate("null_input", fnd.ERROR, c, stat(f"nulls:{c}"),
                      F.lit(f"Null values found in metric input column: '{c}'")) for c in inputs
    ]
    if "date" in facts.columns:
        candidates.append(fnd.candidate("null_date", fnd.ERROR, "date", stat("nulls:date"),
                                        F.lit("Null/unparseable values found in 'date' column")))
    candidates += [
        fnd.candidate("zero_denominator", fnd.ERROR, c, F.when(stat(f"nulls:{c}") == 0, stat(f"zeros:{c}")).otherwise(0),
                      F.lit(f"Zero values in denominator column: '{c}'")) for c in denominators
    ]
    if {"leased_mw", "capacity_mw"} <= set(facts.columns):
        stats["overleased"] = F.count_if(F.col("leased_mw") > F.col("capacity_mw"))
        candidates.append(fnd.candidate("leased_over_capacity", fnd.WARNING, "leased_mw", stat("overleased"), F.concat(
            _text(stat("overleased")), F.lit(" row(s) where leased_mw exceeds capacity_mw"))))
    if "revenue" in facts.columns:
        stats["negative"] = F.count_if(F.col("revenue") < 0)
        candidates.append(fnd.candidate("negative_revenue", fnd.WARNING, "revenue", stat("negative"), F.concat(
            _text(stat("negative")), F.lit(" row(s) with negative revenue"))))
    return fnd.raised(facts.agg(*[e.alias(name) for name, e in stats.items()]), candidates)


def duplicate_findings(facts: DataFrame) -> DataFrame:
    message = F.concat(_text(F.col("n")), F.lit(" duplicate row(s) found (exact match)"))
    return fnd.raised(duplicate_rows(facts), [fnd.candidate("duplicate_rows", fnd.WARNING, None, F.col("n"), message)])


def shared_keys(facts: DataFrame, registry: Registry) -> DataFrame:
    """Per rollup, the rows beyond the first of each key: rollup_level, n. Null segments are one key."""
    rollups = registry.usable_rollups(facts.columns)
    segments = sorted({s for r in rollups for s in r})
    fine = facts.groupBy("date", *segments).agg(F.count(F.lit(1)).alias("rows"))
    if not rollups:
        return facts.sparkSession.createDataFrame([], "rollup_level string, n bigint")
    if not segments:
        return fine.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("n")).select(F.lit(rollup_label(())).alias("rollup_level"), "n")
    sets = {frozenset(r): r for r in rollups}
    grouped = fine.groupingSets([[F.col("date"), *[F.col(s) for s in r]] for r in sets.values()], "date", *segments).agg(
        F.sum("rows").alias("rows"), F.grouping_id().alias("gid")
    )
    width = len(segments)
    gids = {used: sum(1 << (width - 1 - i) for i, s in enumerate(segments) if s not in used) for used in sets}
    labels = F.create_map(*[x for used, gid in gids.items() for x in (F.lit(gid), F.array(*[F.lit(rollup_label(r)) for r in rollups if frozenset(r) == used]))])
    return grouped.groupBy("gid").agg(F.sum(F.col("rows") - 1).alias("n")).select(
        F.explode(labels[F.col("gid").cast("int")]).alias("rollup_level"), "n"
    )


def key_findings(facts: DataFrame, registry: Registry) -> DataFrame:
    described = {
        rollup_label(r): "the same date" if not r else "the same date+" + "+".join(r) + " key" for r in registry.rollups
    }
    described_by = F.create_map(*[F.lit(x) for pair in described.items() for x in pair])
    return shared_keys(facts, registry).filter(F.col("n") > 0).select(
        F.lit("shared_key").alias("check"), F.lit(fnd.WARNING).alias("severity"), F.col("rollup_level").alias("column"),
        F.col("n").cast("bigint").alias("n"),
        F.concat(_text(F.col("n")), F.lit(" additional row(s) share "), described_by[F.col("rollup_level")],
                 F.lit(" for rollup "), F.col("rollup_level"), F.lit("; values will be aggregated.")).alias("message"),
    )


def outlier_texts(outliers: DataFrame) -> DataFrame:
    """Findings for the columns that have outliers, from ``iqr_outliers``."""
    def cents(c: Column) -> Column:
        return F.replace(F.format_number(c, 2), F.lit(","), F.lit(""))

    message = F.concat(_text(F.col("n")), F.lit(" outlier value(s) in '"), F.col("column"), F.lit("' (outside ["),
                       cents(F.col("low")), F.lit(", "), cents(F.col("high")), F.lit("])"))
    return outliers.filter(F.col("n") > 0).select(
        F.lit("outliers").alias("check"), F.lit(fnd.WARNING).alias("severity"), "column",
        F.col("n").cast("bigint").alias("n"), message.alias("message"),
    )


def outlier_findings(facts: DataFrame, registry: Registry) -> DataFrame:
    numeric = {f.name for f in facts.schema.fields if isinstance(f.dataType, T.NumericType)}
    columns = [c for c in registry.summed_columns if c in numeric]
    return outlier_texts(iqr_outliers(facts, columns)) if columns else fnd.known(facts.sparkSession, [])


def metric_findings(normalized: Normalized, registry: Registry) -> DataFrame:
    """All findings of a fact table, which is written once, as every check reads it."""
    facts = materialized(normalized.facts, "checked_facts")
    frames = [column_findings(normalized, registry), value_findings(facts, registry), duplicate_findings(facts)]
    if "date" in facts.columns:
        frames.append(key_findings(facts, registry))
    frames.append(outlier_findings(facts, registry))
    return fnd.together(frames)


def validation_summary(findings: DataFrame) -> DataFrame:
    """One row: status, error_count, warning_count."""
    return fnd.counts_of(findings).select(fnd.status_of(STATUSES).alias("status"), "error_count", "warning_count")


def validation_report(findings: DataFrame) -> DataFrame:
    """One row: status, errors and warnings as lists of messages (a few per declared column and check)."""
    def messages(severity: str) -> Column:
        rows = F.collect_list(F.when(F.col("severity") == severity, F.struct("check", "column", "message")))
        return F.transform(F.array_sort(rows), lambda r: r["message"])

    lists = findings.agg(messages(fnd.ERROR).alias("errors"), messages(fnd.WARNING).alias("warnings"))
    counted = lists.withColumns({"error_count": F.size("errors"), "warning_count": F.size("warnings")})
    return counted.select(fnd.status_of(STATUSES).alias("status"), "errors", "warnings")


class ValidationFailed(RuntimeError):
    """The facts have errors; metrics were not computed."""


def stop_if_failed(findings: DataFrame) -> None:
    errors = findings.filter(F.col("severity") == fnd.ERROR).select("message").collect()  # at most a few per declared column
    if errors:
        raise ValidationFailed("; ".join(r.message for r in errors))
