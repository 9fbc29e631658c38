"""Metric bundles and nested JSON reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.sources.delimited import LoadError

DICTIONARY_SCHEMA = "id string, label string, type string, unit string, decimals bigint, description string"
STATUS_SCHEMA = "status string, errors array<string>, warnings array<string>"
INSIGHTS_SCHEMA = (
    "generated_at string, has_insights boolean, insights array<struct<metric_id:string,label:string,date:string,"
    "period_change_pct:double,direction:string,text:string>>"
)
SUMMARY_SCHEMA = (
    "validation_status string, error_count bigint, warning_count bigint, template string, "
    "date_range struct<min:string,max:string>, metric_count bigint, rollup_levels array<string>"
)
DEFAULT_LONG_SCHEMA = (
    "rollup_level string, date string, provider string, region string, metric_id string, label string, value double, "
    "unit string, prior_period_value double, period_change double, period_change_pct double"
)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
        return True
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def or_empty(spark: SparkSession, path: str, schema: str, read) -> DataFrame:
    """The table at ``path``, or an empty one of the declared schema when there is none."""
    return read(path) if exists(spark, path) else spark.createDataFrame([], schema)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise LoadError(f"{name} holds no rows")
    return df


def read_facts(spark: SparkSession, path: str, **options) -> DataFrame:
    """A fact file for metrics: CSV or parquet, must hold rows."""
    from kpiloom.sources.delimited import read_delimited

    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind not in ("csv", "parquet"):
        raise LoadError(f"{path}: facts must be .csv or .parquet")
    return require_rows(spark.read.parquet(path) if kind == "parquet" else read_delimited(spark, path, **options), path)


def load_status(spark: SparkSession, path: str) -> DataFrame:
    """A validation report: status, errors and warnings."""
    return spark.read.schema(STATUS_SCHEMA).option("multiLine", True).json(path)


@dataclass
class Bundle:
    long: DataFrame
    wide: DataFrame
    dictionary: DataFrame
    status: DataFrame


def metric_columns(spark: SparkSession, path: str) -> str:
    """Schema of a metrics CSV: measures are doubles, everything else text."""
    from kpiloom.sources.delimited import layout_of

    measures = {"value", "prior_period_value", "period_change", "period_change_pct"}
    return ", ".join(f"`{c}` {'double' if c in measures else 'string'}" for c in layout_of(spark, path).header)


def load_bundle(spark: SparkSession, folder: str, long_schema: str | None = None, wide_schema: str | None = None) -> Bundle:
    """The metric tables of a folder. Absent CSV tables become empty ones; the status file is required."""
    status_path = f"{folder}/validation_report.json"
    if not exists(spark, status_path):
        raise LoadError(f"required report missing: {status_path}")

    def csv(schema: str | None):
        def read(path: str) -> DataFrame:
            wanted = schema or metric_columns(spark, path)
            return spark.read.schema(wanted).option("header", True).option("escape", '"').csv(path)
        return read

    return Bundle(
        long=or_empty(spark, f"{folder}/long_metrics.csv", long_schema or DEFAULT_LONG_SCHEMA, csv(long_schema)),
        wide=or_empty(spark, f"{folder}/wide_metrics.csv", wide_schema or "rollup_level string, date string",
                      lambda p: spark.read.option("header", True).csv(p) if not wide_schema else csv(wide_schema)(p)),
        dictionary=or_empty(spark, f"{folder}/metric_dictionary.csv", DICTIONARY_SCHEMA, csv(DICTIONARY_SCHEMA)),
        status=load_status(spark, status_path),
    )


def load_insights(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """insights[] of reports, one row each. ``multiline=False`` reads many documents, one per line."""
    return or_empty(
        spark, path, INSIGHTS_SCHEMA,
        lambda p: spark.read.schema(INSIGHTS_SCHEMA).option("multiLine", multiline).json(p),
    ).select(F.inline("insights"))


def load_summary(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Run summary with its date range flattened and absent parts filled in."""
    report = or_empty(
        spark, path, SUMMARY_SCHEMA,
        lambda p: spark.read.schema(SUMMARY_SCHEMA).option("multiLine", multiline).json(p),
    )
    text, number = (lambda c: F.coalesce(F.col(c), F.lit(""))), (lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint"))
    return report.select(
        text("validation_status").alias("validation_status"), number("error_count").alias("error_count"),
        number("warning_count").alias("warning_count"), text("template").alias("template"),
        number("metric_count").alias("metric_count"), text("date_range.min").alias("date_min"), text("date_range.max").alias("date_max"),
    )
