"""Tables for dashboards and BI tools, and the store they are read from."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.numbers import bar_width, card_value, completion_colour
from kpiloom.operators.sets import small_side
from kpiloom.operators.snapshot import READINESS_IDS, at_latest_date, at_level, latest_date
from kpiloom.plans.registry import ConfigError
from kpiloom.sources.versions import VersionedTables

# Display names of requirement categories.
CATEGORY_LABELS = {
    "capacity": "Capacity Clarity",
    "timeline": "Timeline Clarity",
    "technical": "Technical Specs",
    "market": "Market Clarity",
    "power": "Power Strategy",
    "commercial": "Commercial Model",
    "capital": "Capital Readiness",
    "decision": "Decision Alignment",
}
# Segment columns a breakdown may use, and the two metrics it shows.
SEGMENT_COLUMNS = {"category", "market", "provider", "region"}
BREAKDOWN_IDS = ["readiness_completion_pct", "open_gap_count"]
# Card texts of the readiness dashboard.
CARD_LABELS = {
    "readiness_completion_pct": "Readiness Completion",
    "total_requirement_count": "Scoped Requirements",
    "open_gap_count": "Open Gaps",
    "critical_item_count": "Critical Items",
}
CARD_DESCRIPTIONS = {
    "readiness_completion_pct": "Share of scoped requirements marked complete or closed.",
    "total_requirement_count": "Total checklist items included in this readiness snapshot.",
    "open_gap_count": "Requirements still open, in progress, or not started.",
    "critical_item_count": "Requirements marked critical for transaction readiness.",
}


@dataclass(frozen=True)
class Section:
    type: str
    rollup_level: str
    metrics: list[str]
    segment_column: str | None = None
    optional: bool = False

    @property
    def segment(self) -> str:
        return self.segment_column or self.type.removesuffix("_breakdown")


@dataclass(frozen=True)
class Dashboard:
    sections: list[Section]
    kpi_labels: dict[str, str] = field(default_factory=dict)
    kpi_descriptions: dict[str, str] = field(default_factory=dict)
    category_labels: dict[str, str] = field(default_factory=dict)


READINESS_DASHBOARD = Dashboard(
    [
        Section("kpi_cards", "date_only", READINESS_IDS),
        Section("category_breakdown", "date_category", BREAKDOWN_IDS, "category", True),
        Section("market_breakdown", "date_market", BREAKDOWN_IDS, "market", True),
    ],
    CARD_LABELS, CARD_DESCRIPTIONS, CATEGORY_LABELS,
)


def looked_up(table: dict[str, str], key: Column, fallback: Column) -> Column:
    """A declared map as a literal; nothing to join."""
    if not table:
        return fallback
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(known, key), fallback)


def display_order(metric_id: Column, ids: list[str] = READINESS_IDS) -> Column:
    """Position in the declared order, unknown ids last."""
    place = F.array_position(F.array(*[F.lit(i) for i in ids]), metric_id)
    return F.when(place > 0, place - 1).otherwise(999)


def latest_kpis(long: DataFrame) -> DataFrame:
    return at_latest_date(long, "date_only")


def metric_trends(long: DataFrame) -> DataFrame:
    return at_level(long, "date_only").orderBy("metric_id", "date")


def described(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Left join with the metric dictionary, a declared table; a missing description is ''."""
    texts = dictionary.select(F.col("id").alias("metric_id"), "description")
    return rows.join(small_side(texts), "metric_id", "left").withColumn("description", F.coalesce("description", F.lit("")))


def kpi_export(long: DataFrame, dictionary: DataFrame) -> DataFrame:
    chosen = latest_kpis(long).filter(F.col("metric_id").isin(READINESS_IDS))
    return described(chosen, dictionary).orderBy(display_order(F.col("metric_id"))).select(
        "metric_id", "label", "value", "unit", "description"
    )


def _pivoted(rows: DataFrame, segment: str) -> DataFrame:
    cells = [F.max(F.when(F.col("metric_id") == m, F.col("value"))).alias(m) for m in BREAKDOWN_IDS]
    return rows.filter(F.col("metric_id").isin(BREAKDOWN_IDS)).groupBy(segment).agg(*cells)


def segment_export(long: DataFrame, segment: str, labels: dict[str, str] | None = None) -> DataFrame:
    """Completion and gaps per segment at its newest date, one row per segment."""
    rows = _pivoted(at_latest_date(long, f"date_{segment}"), segment)
    return rows.withColumn(segment, looked_up(labels or {}, F.col(segment), F.col(segment))).orderBy(segment)


def category_export(long: DataFrame) -> DataFrame:
    return segment_export(long, "category", CATEGORY_LABELS)


def market_export(long: DataFrame) -> DataFrame:
    return segment_export(long, "market")


def validation_export(summary: DataFrame) -> DataFrame:
    return summary.select("status", "error_count", "warning_count").limit(1)


def dictionary_export(dictionary: DataFrame) -> DataFrame:
    return dictionary.select("id", "label", "type", "unit", "decimals", "description").orderBy("id")


def kpi_rows(long: DataFrame, level: str, metric_ids: list[str]) -> DataFrame:
    return (
        at_latest_date(long, level).filter(F.col("metric_id").isin(metric_ids))
        .select("metric_id", "label", "value", "unit").orderBy("metric_id")
    )


def kpi_cards(long: DataFrame, dictionary: DataFrame, section: Section, dashboard: Dashboard) -> DataFrame:
    """Cards in display order with declared texts over those of the data."""
    rows = described(kpi_rows(long, section.rollup_level, section.metrics), dictionary).filter(F.col("metric_id").isin(READINESS_IDS))
    metric_id = F.col("metric_id")
    return rows.orderBy(display_order(metric_id)).select(
        metric_id, looked_up(dashboard.kpi_labels, metric_id, F.col("label")).alias("label"), "value", "unit",
        card_value(F.col("value"), F.col("unit")).alias("formatted_value"),
        looked_up(dashboard.kpi_descriptions, metric_id, F.col("description")).alias("description"),
        (metric_id == "readiness_completion_pct").alias("is_primary"),
    )


def breakdown_rows(long: DataFrame, level: str, segment: str, metric_ids: list[str]) -> DataFrame:
    if segment not in SEGMENT_COLUMNS:
        raise ConfigError(f"unknown segment column {segment!r}; known: {sorted(SEGMENT_COLUMNS)}")
    return (
        at_latest_date(long, level).filter(F.col("metric_id").isin(metric_ids))
        .select(segment, "metric_id", "label", "value", "unit").orderBy(segment, "metric_id")
    )


def breakdown_table(rows: DataFrame, segment: str, labels: dict[str, str] | None = None) -> DataFrame:
    """Dashboard bars per segment, most complete first; absent figures show as zero."""
    pct, gaps = F.coalesce("readiness_completion_pct", F.lit(0.0)), F.coalesce("open_gap_count", F.lit(0.0))
    return _pivoted(rows, segment).select(
        looked_up(labels or {}, F.col(segment), F.col(segment)).alias("name"), pct.alias("completion_pct"),
        card_value(pct, F.lit("%")).alias("completion_pct_formatted"), gaps.alias("open_gap_count"),
        card_value(gaps, F.lit("count")).alias("open_gap_count_formatted"),
        bar_width(pct).alias("bar_width"), completion_colour(pct).alias("bar_color"),
    ).orderBy(F.desc("completion_pct"))


def section_states(long: DataFrame, dashboard: Dashboard) -> DataFrame:
    """Per declared section whether it has rows, and whether it is skipped for being optional and empty.

    One pass over the latest rows of all sections: each section is a counted condition.
    """
    levels = sorted({s.rollup_level for s in dashboard.sections})
    newest = long.filter(F.col("rollup_level").isin(levels)).groupBy("rollup_level").agg(F.max("date").alias("date"))
    rows = long.join(newest, ["rollup_level", "date"], "left_semi")

    def belongs(s: Section) -> Column:
        return (F.col("rollup_level") == s.rollup_level) & F.col("metric_id").isin(s.metrics)

    counts = rows.agg(*[F.count_if(belongs(s)).alias(f"n{i}") for i, s in enumerate(dashboard.sections)])
    states = F.array(*[
        F.struct(F.lit(s.type).alias("section"), F.col(f"n{i}").alias("n_rows"), (F.col(f"n{i}") > 0).alias("rendered"),
                 ((F.col(f"n{i}") == 0) & F.lit(s.optional and s.type != "kpi_cards")).alias("skipped"))
        for i, s in enumerate(dashboard.sections)
    ])
    return counts.select(F.inline(states))


def as_of_date(long: DataFrame) -> DataFrame:
    return latest_date(long, "date_only")


STORE_TABLES = ["long_metrics", "wide_metrics", "metric_dictionary", "metrics_validation_summary", "report_insights", "report_summary"]


@dataclass
class Store:
    """Tables of one run under a folder, written together as one version; long metrics are partitioned by rollup level."""

    spark: SparkSession
    folder: str

    @property
    def tables(self) -> VersionedTables:
        return VersionedTables(self.spark, self.folder)

    def table(self, name: str) -> DataFrame:
        return self.tables.read(name)

    def write(self, tables: dict[str, DataFrame]) -> list[str]:
        unknown = sorted(set(tables) - set(STORE_TABLES))
        if unknown:
            raise ConfigError(f"the store has no tables {unknown}")
        self.tables.replace(tables, {"long_metrics": ["rollup_level"]})
        return sorted(tables)

    def register(self, prefix: str = "") -> list[str]:
        """Temporary views over the stored tables and the three serving views, for SQL users."""
        views = {name: self.table(name) for name in STORE_TABLES}
        views["v_latest_kpis"] = latest_kpis(views["long_metrics"])
        views["v_metric_trends"] = metric_trends(views["long_metrics"])
        views["v_report_insights"] = views["report_insights"]
        for name, df in views.items():
            df.createOrReplaceTempView(prefix + name)
        return [prefix + name for name in views]


def with_columns(df: DataFrame | None, spark: SparkSession, schema: str) -> DataFrame:
    """The table, or an empty one of the declared schema when there is none."""
    return df if df is not None and df.columns else spark.createDataFrame([], schema)
