"""Configured metrics over a family of rollups, in long and wide form.

One pass over the facts builds additive parts at the finest grain (map-side combined, so a hot key
costs one row per task). Grouping sets then run on that small table, and every metric is finished
from the parts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.numbers import round_even
from kpiloom.plans.registry import ConfigError, Metric, Registry, rollup_label

LONG_HEAD = ["rollup_level", "date"]
LONG_TAIL = ["metric_id", "label", "value", "unit"]
CHANGE_COLUMNS = ["prior_period_value", "period_change", "period_change_pct"]


def segment_columns(long: DataFrame, keys: list[str] | None = None) -> list[str]:
    taken = {*LONG_HEAD, *LONG_TAIL, *CHANGE_COLUMNS, *(keys or [])}
    return sorted(c for c in long.columns if c not in taken)


def _parts(registry: Registry) -> dict[str, Column]:
    """Additive building blocks, named by what they hold."""
    parts = {f"sum:{c}": F.sum(F.col(f"`{c}`")) for c in registry.summed_columns}
    parts["rows"] = F.count(F.lit(1))
    for m in registry.metrics:
        if m.condition_column:
            parts[f"hits:{m.id}"] = F.count_if(F.col(f"`{m.condition_column}`").isin(list(m.matched_values)))
    return parts


def _part(name: str) -> Column:
    return F.col(f"`{name}`")


def _total(column: str) -> Column:
    """A group whose inputs are all null sums to zero."""
    return F.coalesce(_part(f"sum:{column}").cast("double"), F.lit(0.0))


def _finished(m: Metric) -> Column:
    if m.type == "sum":
        return _total(m.source_col)
    if m.type in ("ratio", "per_unit"):
        share = F.try_divide(_total(m.numerator), _total(m.denominator))
        return share * float(m.scale) if m.type == "ratio" else share
    if m.type == "count":
        return _part("rows").cast("double")
    hits = _part(f"hits:{m.id}").cast("double")
    return hits if m.type == "conditional_count" else hits / _part("rows").cast("double") * float(m.scale)


def require_inputs(facts: DataFrame, registry: Registry) -> None:
    absent = sorted({*registry.summed_columns, *registry.condition_columns} - set(facts.columns))
    if absent:
        raise ConfigError(f"facts lack metric input columns {absent}")


def finest_parts(facts: DataFrame, registry: Registry, keys: list[str] | None = None) -> DataFrame:
    """Additive parts per key, date and every segment in use; null segments kept."""
    segments = sorted({s for r in registry.usable_rollups(facts.columns) for s in r})
    names = list(dict.fromkeys([*(keys or []), "date", *segments]))
    aggregates = [expr.alias(name) for name, expr in _parts(registry).items()]
    return facts.filter(F.col("date").isNotNull()).groupBy(*names).agg(*aggregates)


def rollup_parts(facts: DataFrame, registry: Registry, keys: list[str] | None = None) -> DataFrame:
    """Parts per rollup, labelled; rows with a null segment leave only the rollups that use it."""
    keys = keys or []
    rollups = registry.usable_rollups(facts.columns)
    segments = sorted({s for r in rollups for s in r})
    clash = sorted(set(keys) & set(segments))
    if clash:
        raise ConfigError(f"columns cannot be key and segment at once: {clash}")
    fine = finest_parts(facts, registry, keys)
    part_names = list(_parts(registry))
    if not rollups:
        # every declared rollup lacks a column: a table of no rows
        return fine.where(F.lit(False)).select(*keys, F.lit(None).cast("string").alias("rollup_level"), "date", *map(_part, part_names))
    shared = [F.col(c) for c in [*keys, "date"]]
    merged = [F.sum(_part(p)).alias(p) for p in part_names]
    if not segments:
        # the finest parts are the only rollup
        return fine.select(*keys, F.lit(rollup_label(())).alias("rollup_level"), "date", *map(_part, part_names))

    rolled_up = {s: F.grouping(s).alias(f"rolled:{s}") for s in segments}
    grouped = fine.groupingSets(
        [[*shared, *[F.col(s) for s in r]] for r in {frozenset(r): r for r in rollups}.values()], *keys, "date", *segments
    ).agg(*merged, *rolled_up.values())
    # rollups over the same set of segments are one grouping set with a label each
    labels: dict[frozenset, list[str]] = {}
    for r in rollups:
        labels.setdefault(frozenset(r), []).append(rollup_label(r))
    level = F.coalesce(*[
        F.when(reduce(lambda a, b: a & b, [_part(f"rolled:{s}") == (0 if s in used else 1) for s in segments]), F.array(*map(F.lit, names)))
        for used, names in labels.items()
    ])
    known_segments = reduce(
        lambda a, b: a & b, [(_part(f"rolled:{s}") == 1) | F.col(s).isNotNull() for s in segments]
    )
    return grouped.filter(known_segments).select(
        *keys, F.explode(level).alias("rollup_level"), "date", *segments, *map(_part, part_names)
    )


def melt(parts: DataFrame, registry: Registry, keys: list[str] | None = None) -> DataFrame:
    """One row per metric; label and unit ride along as literals, so no lookup join is needed."""
    keys = keys or []
    rows = F.array(*[
        F.struct(F.lit(m.id).alias("metric_id"), F.lit(m.label).alias("label"),
                 _finished(m).alias("value"), F.lit(m.unit).alias("unit"))
        for m in registry.metrics
    ])
    segments = [s for s in registry.segments if s in parts.columns]
    return parts.select(*keys, *LONG_HEAD, *segments, F.inline(rows))


def long_metrics(facts: DataFrame, registry: Registry, keys: list[str] | None = None) -> DataFrame:
    """Unrounded long metrics for every usable rollup (optionally once per key)."""
    require_inputs(facts, registry)
    return melt(rollup_parts(facts, registry, keys), registry, keys)


def _rounded(column: str, registry: Registry) -> Column:
    by_decimals: dict[int, list[str]] = {}
    for m in registry.metrics:
        by_decimals.setdefault(m.decimals, []).append(m.id)
    result = F.col(column)
    for decimals, ids in sorted(by_decimals.items()):
        result = F.when(F.col("metric_id").isin(ids), round_even(F.col(column), decimals)).otherwise(result)
    return result


def rounded(long: DataFrame, registry: Registry) -> DataFrame:
    """Round each metric by its declared decimals, change percent to two."""
    present = [c for c in ("value", "prior_period_value", "period_change") if c in long.columns]
    changes = {c: _rounded(c, registry) for c in present}
    if "period_change_pct" in long.columns:
        changes["period_change_pct"] = round_even(F.col("period_change_pct"), 2)
    return long.withColumns(changes)


def ordered_long(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Fixed column order with segments sorted by name."""
    extra = [c for c in CHANGE_COLUMNS if c in long.columns]
    return long.select(*(keys or []), *LONG_HEAD, *segment_columns(long, keys), *LONG_TAIL, *extra)


def wide_metrics(long: DataFrame, registry: Registry, keys: list[str] | None = None) -> DataFrame:
    """One column per metric; null segments are ordinary key values. The ids are declared, so no pass finds them."""
    index = [*(keys or []), *LONG_HEAD, *segment_columns(long, keys)]
    return long.groupBy(*index).pivot("metric_id", registry.ids).agg(F.first("value", ignorenulls=True))


def metric_dictionary(spark, registry: Registry) -> DataFrame:
    rows = [(m.id, m.label, m.type, m.unit, int(m.decimals), m.description) for m in registry.metrics]
    return spark.createDataFrame(rows, "id string, label string, type string, unit string, decimals bigint, description string")
