"""Duplicates, set difference and key constraints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.session import materialized


def _quoted(names) -> list:
    return [F.col(f"`{n}`") for n in names]


#: Rows of a table that goes to every task.
MOST_BROADCAST_ROWS = 10_000


def small_side(table: DataFrame) -> DataFrame:
    """The table marked for broadcast if a count shows that it is small; else as it is, and a join shuffles both sides.

    For declared tables, such as a requirement map or a metric dictionary, whose size the planner does not know.
    """
    counted = table.limit(MOST_BROADCAST_ROWS + 1).count()
    return F.broadcast(table) if counted <= MOST_BROADCAST_ROWS else table


def distinct_with_copies(rows: DataFrame, copies: str = "copies") -> DataFrame:
    """Distinct rows with how often each occurred; one shuffle serves both questions."""
    return rows.groupBy(*_quoted(rows.columns)).agg(F.count(F.lit(1)).alias(copies))


def duplicate_rows(rows: DataFrame, name: str = "n") -> DataFrame:
    """One row: how many rows repeat an earlier one exactly."""
    return distinct_with_copies(rows).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias(name))


def first_occurrences(rows: DataFrame, order: str) -> DataFrame:
    """Drop exact duplicates and keep the smallest row id of each, for callers that need source order."""
    others = [c for c in rows.columns if c != order]
    return rows.groupBy(*_quoted(others)).agg(F.min(order).alias(order)).select(*_quoted(rows.columns))


def require_same_columns(new: list[str], existing: list[str]) -> None:
    extra, absent = sorted(set(new) - set(existing)), sorted(set(existing) - set(new))
    if extra or absent:
        raise ValueError(f"columns differ: the table lacks {extra}, the new rows lack {absent}")


def rows_not_in(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct new rows that the existing table lacks; nulls compare equal. Both must have the same columns."""
    require_same_columns(new.columns, existing.columns)
    return new.select(*_quoted(existing.columns)).subtract(existing)


def as_stored(new: DataFrame, stored: DataFrame) -> DataFrame:
    """The new rows in the column types of the stored ones. A value that the stored type cannot hold stops the run."""
    wanted = {f.name: f.dataType for f in stored.schema.fields}
    differing = [f.name for f in new.schema.fields if f.name in wanted and f.dataType != wanted[f.name]]
    if not differing:
        return new
    cast = {c: F.col(f"`{c}`").try_cast(wanted[c]) for c in differing}

    def lost(c: str):
        back = cast[c].try_cast(new.schema[c].dataType)
        return F.count_if(F.col(f"`{c}`").isNotNull() & ~F.coalesce(back == F.col(f"`{c}`"), F.lit(False))).alias(c)

    failures = {c: n for c, n in new.agg(*[lost(c) for c in differing]).first().asDict().items() if n}
    if failures:
        raise ValueError(f"values that the stored type cannot hold, per column: {failures}")
    return new.withColumns(cast)


def one_per_key(rows: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the smallest by ``order_by``, then by the remaining columns.

    A struct minimum combines on the map side, so a key with many rows never gathers in one task.
    """
    lead = order_by or []
    rest = [c for c in rows.columns if c not in keys and c not in lead]
    ordered = [c for c in lead if c not in keys] + rest
    if not ordered:
        return rows.select(*keys).distinct()
    best = rows.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("best"))
    return best.select(*keys, "best.*").select(*rows.columns)


def insert_ignore(new: DataFrame, target: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """Rows to append so that each key appears once and existing keys stay as they are."""
    return one_per_key(new, keys, order_by).join(target.select(*keys), keys, "left_anti")


def repeated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def orphans(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose key has no parent. A null key refers to nothing and is not an orphan.

    Rows are reduced to their different keys on the map side, and only keys meet the parents, so a key with a third of all
    rows is one row per task there. The keys found missing go back to the rows: to every task if they are few, else in a
    join that shuffles both sides.
    """
    known = parents.select(F.col(parent_key).alias(key)).distinct()
    keys = rows.select(key).where(F.col(key).isNotNull()).distinct()
    missing = materialized(keys.join(known, key, "left_anti"), "missing_keys")
    return rows.join(small_side(missing), key, "left_semi")
