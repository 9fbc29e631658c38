"""Files to clean tables: read, clean, check, gate, write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators import findings as fnd
from kpiloom.operators.cleaning import Cleaned, clean, rename_by_rule, select_output
from kpiloom.operators.intake_checks import STATUSES, batch_totals, data_findings, file_statuses, name_findings, table_counts
from kpiloom.plans.registry import IntakeConfig
from kpiloom.session import materialized
from kpiloom.sources.delimited import SOURCE_FILE, read_folder
from kpiloom.sources.sinks import load_table, write_csv, write_parquet


@dataclass
class Intake:
    cleaned: Cleaned
    table: DataFrame  # rows to write
    findings: DataFrame
    status: DataFrame


def prepare(raw: DataFrame, config: IntakeConfig) -> Intake:
    """Clean one table, rename by rule, check all its columns, choose the output columns."""
    cleaned = clean(raw)
    typed = rename_by_rule(cleaned.typed, config.columns)
    names = name_findings(raw.columns, typed.columns, config.required_columns)
    found = fnd.known(raw.sparkSession, names).unionByName(
        data_findings(typed, None, config.null_threshold, config.duplicate_threshold, config.columns)
    )
    status = fnd.counts_of(found).withColumn("status", fnd.status_of(STATUSES))
    table = rename_by_rule(cleaned.table, config.columns)
    return Intake(cleaned, select_output(table, config.select_columns) if config.select_columns else table, found, status)


def export(intake: Intake, path: str, config: IntakeConfig, table_path: str | None = None) -> bool:
    """Write the clean table unless the gate is on and the checks failed. Returns whether it was written."""
    if config.block_export_on_fail and intake.status.first().status == "fail":
        return False
    (write_parquet if config.output_format == "parquet" else write_csv)(intake.table, path)
    if table_path:
        load_table(intake.table, table_path, config.table_mode)
    return True


@dataclass
class FolderRun:
    tables: list[DataFrame]  # one per layout, each with source_file
    files: DataFrame  # one row per file that could be read, with or without rows
    findings: DataFrame
    totals: DataFrame


def run_folder(spark: SparkSession, folder: str, config: IntakeConfig, multiline: bool | None = None) -> FolderRun:
    """Clean and check a folder. Files of one layout are typed together and checked one by one.

    The listing is the base: a file with a header and no rows has counts of zero, and is found empty.
    """
    batch = read_folder(spark, folder, multiline)
    by, tables = [SOURCE_FILE], []
    files = [spark.createDataFrame([], f"{SOURCE_FILE} string, rows_loaded bigint, rows_output bigint, load_warnings bigint")]
    found = [spark.createDataFrame([], f"{SOURCE_FILE} string, {fnd.SCHEMA}")]
    for layout, raw in batch.tables.items():
        overlong = raw.groupBy(*by).agg(F.max(F.col("overlong").cast("int")).cast("bigint").alias("load_warnings"))
        cleaned = clean(raw.drop("overlong"), keep=by)
        typed = rename_by_rule(cleaned.typed, config.columns)
        missing = [c for c in config.select_columns if c not in typed.columns]
        listed = spark.createDataFrame([(name,) for name in batch.files[layout]], f"{SOURCE_FILE} string")
        # one row per file, read by the findings and by the statuses
        counts = materialized(listed.join(table_counts(typed, by), by, "left").join(overlong, by, "left").fillna(0), "file-counts")
        files.append(counts.select(*by, "rows_loaded", "rows_output", (F.col("load_warnings") + (1 if missing else 0)).alias("load_warnings")))
        names = name_findings(list(layout.header), typed.columns, config.required_columns)
        found.append(data_findings(typed, by, config.null_threshold, config.duplicate_threshold, config.columns, counts.drop("load_warnings")))
        found.append(fnd.known_for_each(listed, by, names))
        table = rename_by_rule(cleaned.table, config.columns)
        tables.append(select_output(table, [*config.select_columns, *by]) if config.select_columns else table)
    findings = fnd.together(found)
    statuses = file_statuses(fnd.together(files), findings, by)
    return FolderRun(tables, statuses, findings, batch_totals(statuses, config.block_export_on_fail, batch.failed))


def export_folder(run: FolderRun, path: str, config: IntakeConfig) -> DataFrame:
    """Write the clean rows of every file below a folder of its own; with the gate on, only of files that did not fail.

    Layouts go to folders of their own, since their columns differ. Returns one row per file: source_file, exported.
    """
    passed = (F.col("status") != "fail") if config.block_export_on_fail else F.lit(True)
    gate = materialized(run.files.select(SOURCE_FILE, passed.alias("exported")), "gate")
    for number, table in enumerate(run.tables):
        kept = table.join(gate.where("exported"), SOURCE_FILE, "left_semi")
        writer = kept.write.mode("overwrite").partitionBy(SOURCE_FILE)
        target = f"{path}/layout-{number}"
        writer.parquet(target) if config.output_format == "parquet" else writer.option("header", True).option("escape", '"').csv(target)
    return gate
