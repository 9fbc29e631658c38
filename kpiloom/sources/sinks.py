"""Writers: CSV, parquet, versioned tables, JSON reports."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from kpiloom.sources.versions import VersionedTables


def table_name(stem: str) -> str:
    """A safe table name for the cleaned data of a file."""
    return re.sub(r"\W", "_", stem + "_clean")


def write_csv(df: DataFrame, path: str, separator: str = ",") -> str:
    """CSV with a header row; cell white space is written as it is."""
    (
        df.write.mode("overwrite").option("header", True).option("sep", separator).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """One JSON document per row; readers of a single report and of many see the same shape."""
    df.write.mode("overwrite").json(path)
    return path


def tables_at(spark: SparkSession, path: str) -> tuple[VersionedTables, str]:
    """The versioned folder of a table, and the table's name, which is that of the folder."""
    return VersionedTables(spark, path), path.rstrip("/").rsplit("/", 1)[-1]


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    tables, name = tables_at(spark, path)
    return tables.read(name, version)


def load_table(df: DataFrame, path: str, mode: str = "replace") -> int:
    """Replace the table, or append the distinct rows that it lacks (creating it with its repeats); returns its row count.

    Either is one new version: a run that fails changes nothing, and the rows may come from the table itself.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown table mode {mode!r}: use 'replace' or 'append'")
    tables, name = tables_at(df.sparkSession, path)
    tables.replace({name: df}) if mode == "replace" else tables.append_new(name, df)
    return tables.count(name)
