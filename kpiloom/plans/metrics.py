"""Facts to published metric tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from kpiloom.operators.periods import with_prior_period
from kpiloom.operators.rollups import long_metrics, metric_dictionary, ordered_long, rounded, wide_metrics
from kpiloom.plans.registry import Registry


@dataclass
class MetricTables:
    long: DataFrame
    wide: DataFrame
    dictionary: DataFrame


def published_long(facts: DataFrame, registry: Registry, keys: list[str] | None = None, changes: bool = False) -> DataFrame:
    """Long metrics, rounded; with changes, the lag runs on rounded values and is rounded again."""
    long = rounded(long_metrics(facts, registry, keys), registry)
    if changes:
        long = rounded(with_prior_period(long, keys), registry)
    return ordered_long(long, keys)


def metric_tables(facts: DataFrame, registry: Registry, keys: list[str] | None = None, changes: bool = False) -> MetricTables:
    base = published_long(facts, registry, keys)
    return MetricTables(
        long=published_long(facts, registry, keys, changes) if changes else base,
        wide=wide_metrics(base, registry, keys),
        dictionary=metric_dictionary(facts.sparkSession, registry),
    )
