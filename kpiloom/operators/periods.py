"""Change against the prior period."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.operators.rollups import segment_columns


def with_prior_period(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Adds prior value, change and change percent within each rollup, segment and metric.

    A window group holds one row per date, since the input is already aggregated; null segments
    form one group like any other value. Zero or missing prior gives a null percent.
    """
    group = [*(keys or []), "rollup_level", *segment_columns(long, keys), "metric_id"]
    history = Window.partitionBy(*group).orderBy("date")
    change = F.col("value") - F.col("prior_period_value")
    return long.withColumn("prior_period_value", F.lag("value").over(history)).withColumns({
        "period_change": change,
        "period_change_pct": change / F.nullif(F.col("prior_period_value"), F.lit(0.0)) * 100,
    })
