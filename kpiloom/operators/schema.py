"""Fact tables brought to standard column names and types."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions.dates import messy_date
from kpiloom.functions.text import as_double, match_key
from kpiloom.plans.registry import ColumnSpec, ConfigError, FactSchema


@dataclass
class Normalized:
    facts: DataFrame
    dropped: list[str] = field(default_factory=list)
    missing_segments: list[str] = field(default_factory=list)


def standard_names(columns: list[str], schema: FactSchema) -> dict[str, str]:
    """Input column to standard column, through names and aliases; two inputs for one target is an error."""
    targets = {match_key(name): spec.name for spec in schema.all for name in (spec.name, *spec.aliases)}
    found: dict[str, list[str]] = {}
    for column in columns:
        target = targets.get(match_key(column))
        if target:
            found.setdefault(target, []).append(column)
    clashes = {target: sources for target, sources in found.items() if len(sources) > 1}
    if clashes:
        raise ConfigError(f"several columns claim one standard name: {clashes}")
    return {sources[0]: target for target, sources in found.items()}


def _typed(c: Column, spec: ColumnSpec, current: T.DataType) -> Column:
    if isinstance(current, (T.DoubleType, T.FloatType)):
        # a number that is none is a missing one
        return F.nanvl(c, F.lit(None).cast(current))
    if spec.type == "float" and not isinstance(current, T.NumericType):
        return as_double(F.trim(c.cast("string")))
    if spec.type == "date" and not isinstance(current, T.DateType):
        if not isinstance(current, T.StringType):
            return c.cast("date")
        # the intake layouts, and the year first with slashes
        slashed = F.when(F.trim(c).rlike(r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$"), F.try_to_date(F.trim(c), "y/M/d"))
        return F.coalesce(messy_date(F.trim(c)), slashed)
    return c


def failed_casts(facts: DataFrame, schema: FactSchema) -> DataFrame:
    """One row: per base column that needs a cast, how many present values it cannot convert."""
    types = {f.name: f.dataType for f in facts.schema.fields}
    counts = [
        F.count_if(F.col(s.name).isNotNull() & _typed(F.col(s.name), s, types[s.name]).isNull()).alias(s.name)
        for s in schema.base if s.name in types
    ]
    return facts.agg(*counts)


def normalize(raw: DataFrame, schema: FactSchema, check_values: bool = True) -> Normalized:
    """Rename, drop unknown columns, require the declared ones, cast base columns.

    With ``check_values`` a value that cannot be cast stops the run, at the price of one pass over
    the base columns that need casting; without it such values become null and show up in the checks.
    """
    names = standard_names(raw.columns, schema)
    dropped = [c for c in raw.columns if c not in names]
    facts = raw.select(*[F.col(f"`{c}`").alias(names[c]) for c in raw.columns if c in names])

    absent = [s.name for s in schema.base if s.name not in facts.columns]
    absent += [s.name for s in schema.conditions if s.required and s.name not in facts.columns]
    if absent:
        raise ConfigError(f"required columns are missing: {absent}")

    types = {f.name: f.dataType for f in facts.schema.fields}
    casts = {s.name: _typed(F.col(s.name), s, types[s.name]) for s in schema.base}
    casts |= {s.name: _typed(F.col(s.name), s, types[s.name]) for s in (*schema.segments, *schema.conditions) if s.name in types and isinstance(types[s.name], (T.DoubleType, T.FloatType))}
    converting = [s for s in schema.base if isinstance(types[s.name], T.StringType) and s.type in ("float", "date")]
    if check_values and converting:
        failures = failed_casts(facts, FactSchema(tuple(converting))).first().asDict()
        broken = {name: n for name, n in failures.items() if n}
        if broken:
            raise ConfigError(f"values that cannot be converted, per column: {broken}")
    missing = [s.name for s in schema.segments if s.name not in facts.columns]
    return Normalized(facts.withColumns(casts), dropped, missing)
