"""Findings tables: one row per problem, with the columns check, severity, column, n, message."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "check string, severity string, column string, n bigint, message string"
_FIELDS = [part.split(" ") for part in SCHEMA.split(", ")]
ERROR, WARNING = "error", "warning"


def known(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Findings that follow from configuration and column names alone."""
    return spark.createDataFrame(rows, SCHEMA)


def known_for_each(files: DataFrame, keys: list[str], rows: list[tuple]) -> DataFrame:
    """The same configuration findings once per row of ``files``."""
    if not rows:
        return files.select(*keys).limit(0).select(*keys, *[F.lit(None).cast(kind).alias(name) for name, kind in _FIELDS])
    structs = [candidate(check, severity, column, F.lit(n), F.lit(text)) for check, severity, column, n, text in rows]
    return files.select(*keys, F.inline(F.array(*structs)))


def candidate(check: str, severity: str, column: str | None, n: Column, message: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"), F.lit(severity).alias("severity"), F.lit(column).cast("string").alias("column"),
        n.cast("bigint").alias("n"), message.alias("message"),
    )


def raised(stats: DataFrame, candidates: list[Column], keys: list[str] | None = None) -> DataFrame:
    """Candidates whose count is positive, one row each, per row of ``stats``."""
    rows = stats.select(*(keys or []), F.inline(F.array(*candidates)))
    return rows.filter(F.col("n") > 0)


def together(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def counts_of(findings: DataFrame, keys: list[str] | None = None) -> DataFrame:
    grouped = findings.groupBy(*keys) if keys else findings.groupBy()
    return grouped.agg(
        F.count_if(F.col("severity") == ERROR).alias("error_count"),
        F.count_if(F.col("severity") == WARNING).alias("warning_count"),
    )


def status_of(names: tuple[str, str, str]) -> Column:
    """Status from error_count and warning_count; ``names`` go worst to best."""
    worst, middle, best = names
    return F.when(F.col("error_count") > 0, worst).when(F.col("warning_count") > 0, middle).otherwise(best)
