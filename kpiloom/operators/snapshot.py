"""Latest values out of long metrics.

Three meanings of "latest" are kept apart: the last known value of each column per metric
(``snapshot``), the rows at the newest date of one rollup level (``at_latest_date``), and the newest
date itself (``latest_date``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.rollups import CHANGE_COLUMNS

# The metrics readiness reports are about, in display order.
READINESS_IDS = ["readiness_completion_pct", "total_requirement_count", "open_gap_count", "critical_item_count"]


def at_level(long: DataFrame, level: str) -> DataFrame:
    return long.filter(F.col("rollup_level") == level)


def latest_date(long: DataFrame, level: str = "date_only") -> DataFrame:
    return at_level(long, level).agg(F.max("date").alias("date"))


def at_latest_date(long: DataFrame, level: str, keys: list[str] | None = None) -> DataFrame:
    """Rows of one level at that level's newest date, whole table or per key."""
    rows = at_level(long, level)
    if not keys:
        return rows.filter(F.col("date") == latest_date(long, level).scalar())
    newest = rows.groupBy(*keys).agg(F.max("date").alias("date"))
    return rows.join(newest, [*keys, "date"], "left_semi")


def snapshot(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per metric at date_only: newest date, and for every other column its newest known value.

    Columns are settled one by one, so a null in the newest row lets an older value through.
    """
    others = [c for c in ("label", "value", "unit", *CHANGE_COLUMNS) if c in long.columns]
    known = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("date"))).alias(c) for c in others]
    return at_level(long, "date_only").groupBy(*(keys or []), "metric_id").agg(F.max("date").alias("date"), *known)


def segment_matrix(long: DataFrame, level: str, segment: str, keys: list[str] | None = None) -> DataFrame:
    """Per segment at the newest date: the four readiness metrics and their units, absent ones null and ''."""
    rows = at_latest_date(long, level, keys).filter(F.col(segment).isNotNull())

    def of(metric_id: str, column: str) -> Column:
        return F.max(F.when(F.col("metric_id") == metric_id, F.col(column)))

    cells = [of(m, "value").alias(m) for m in READINESS_IDS]
    units = [F.coalesce(of(m, "unit"), F.lit("")).alias(f"{m}_unit") for m in READINESS_IDS]
    return rows.groupBy(*(keys or []), F.col(segment).alias("segment")).agg(*cells, *units)


def report_summary(long: DataFrame) -> DataFrame:
    """Dates covered, number of metrics, rollup levels (a declared handful)."""
    return long.agg(
        F.min("date").alias("date_min"), F.max("date").alias("date_max"),
        F.count_distinct("metric_id").alias("metric_count"), F.array_sort(F.collect_set("rollup_level")).alias("rollup_levels"),
    )
