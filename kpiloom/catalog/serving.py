"""Dashboard and BI tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.catalog import sql as S
from kpiloom.catalog.insights import long_of, market_long
from kpiloom.catalog.quality import SUMMARY_SQL, summary_of
from kpiloom.catalog.registrar import query
from kpiloom.operators import serving as sv
from kpiloom.operators.sets import small_side
from kpiloom.operators import snapshot as sn
from kpiloom.operators.insights import period_insights
from kpiloom.operators.rollups import metric_dictionary, wide_metrics
from kpiloom.plans import views
from kpiloom.plans.registry import READINESS_METRICS
from kpiloom.session import materialized, scratch_path

IDS = "('readiness_completion_pct', 'total_requirement_count', 'open_gap_count', 'critical_item_count')"
PAIR = "('readiness_completion_pct', 'open_gap_count')"
ROW = "rollup_level, date, category, market, metric_id, label, value, unit"
NEWEST = "date = (SELECT max(date) FROM long WHERE rollup_level = '{0}') AND rollup_level = '{0}'"
DICTIONARY = "dict(id, label, type, unit, decimals, description) AS (VALUES " + ", ".join(
    f"('{m.id}', '{m.label}', '{m.type}', '{m.unit}', {m.decimals}::BIGINT, '{m.description}')" for m in READINESS_METRICS.metrics) + ")"
ORDER = "CASE metric_id WHEN 'readiness_completion_pct' THEN 0 WHEN 'total_requirement_count' THEN 1 WHEN 'open_gap_count' THEN 2 WHEN 'critical_item_count' THEN 3 ELSE 999 END"


def dictionary(spark):
    return metric_dictionary(spark, READINESS_METRICS)


@query("FLT1", S.readiness() + f"SELECT {ROW} FROM long WHERE rollup_level = 'date_market'")
def one_level(spark, folder):
    return sn.at_level(long_of(spark, folder), "date_market")


@query("FLT2", S.readiness() + f"SELECT {ROW} FROM long WHERE {NEWEST.format('date_category')}")
def newest_rows(spark, folder):
    return sn.at_latest_date(long_of(spark, folder), "date_category")


@query("FLT3", S.readiness() + f"SELECT {ROW} FROM long WHERE metric_id IN {PAIR}")
def chosen_metrics(spark, folder):
    return long_of(spark, folder).filter(F.col("metric_id").isin(sv.BREAKDOWN_IDS))


@query("FLT4", f"WITH {S.REQUIREMENTS} SELECT market, count(*) FILTER (category IN ('power', 'capital')) AS hits, count(*) FILTER (category IS NULL OR category NOT IN ('power', 'capital')) AS misses FROM req GROUP BY market")
def membership(spark, folder):
    hit = F.when(F.col("category").isin("power", "capital"), 1).otherwise(0)
    grouped = views.requirements(spark, folder).groupBy("market")
    return grouped.agg(F.sum(hit).alias("hits"), F.sum(1 - hit).alias("misses"))


@query("SRT1", S.readiness() + f"SELECT {ROW} FROM long WHERE rollup_level = 'date_only' ORDER BY metric_id, date")
def trend_order(spark, folder):
    return sv.metric_trends(long_of(spark, folder))


@query("SRT3", S.readiness() + f"SELECT metric_id, {ORDER}::INTEGER AS place, count(*) AS n FROM long GROUP BY metric_id ORDER BY place")
def display_order(spark, folder):
    place = sv.display_order(F.col("metric_id")).cast("int").alias("place")
    return long_of(spark, folder).groupBy("metric_id", place).agg(F.count(F.lit(1)).alias("n")).orderBy("place")


_LABELS = "CASE {0} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sv.CATEGORY_LABELS.items()) + " ELSE {0} END"


def _breakdown_sql(level: str, segment: str, label: str) -> str:
    return S.readiness() + f""", p AS (SELECT {segment}, coalesce(max(value) FILTER (metric_id = 'readiness_completion_pct'), 0) AS pct, coalesce(max(value) FILTER (metric_id = 'open_gap_count'), 0) AS gaps
  FROM long WHERE {NEWEST.format(level)} GROUP BY {segment})
SELECT {label} AS name, pct AS completion_pct, format('{{:.1f}}', pct) || '%' AS completion_pct_formatted, gaps AS open_gap_count, round_even(gaps, 0)::BIGINT::VARCHAR AS open_gap_count_formatted,
  least(100, greatest(0, round_even(pct, 0)))::INTEGER AS bar_width, CASE WHEN pct >= 70 THEN '#27ae60' WHEN pct >= 50 THEN '#f39c12' ELSE '#e74c3c' END AS bar_color FROM p ORDER BY pct DESC"""


def _bars(spark, folder, segment, labels=None):
    rows = sv.breakdown_rows(long_of(spark, folder), f"date_{segment}", segment, sv.BREAKDOWN_IDS)
    return sv.breakdown_table(rows, segment, labels)


@query("SRT4", _breakdown_sql("date_market", "market", "market"))
def bars_by_market(spark, folder):
    return _bars(spark, folder, "market")


@query("RSH5", _breakdown_sql("date_category", "category", _LABELS.format("category")))
def bars_by_category(spark, folder):
    return _bars(spark, folder, "category", sv.CATEGORY_LABELS)


@query("LIM2", SUMMARY_SQL + " LIMIT 1")
def first_validation(spark, folder):
    return sv.validation_export(summary_of(spark, folder))


@query("JN1", S.readiness() + f", {DICTIONARY} SELECT {', '.join('l.' + c for c in ROW.split(', '))}, coalesce(description, '') AS description FROM long l LEFT JOIN dict d ON d.id = l.metric_id AND d.id <> 'open_gap_count'")
def dictionary_joined(spark, folder):
    return sv.described(long_of(spark, folder), dictionary(spark).filter(F.col("id") != "open_gap_count"))


@query("JN2", S.readiness() + f", {DICTIONARY} SELECT metric_id, d.label, d.unit, count(*) AS n FROM long JOIN dict d ON d.id = metric_id GROUP BY ALL")
def labels_looked_up(spark, folder):
    """Counts of bare metric rows meet the dictionary, where labels and units come from."""
    counted = long_of(spark, folder).groupBy("metric_id").agg(F.count(F.lit(1)).alias("n"))
    named = dictionary(spark).select(F.col("id").alias("metric_id"), "label", "unit")
    return counted.join(small_side(named), "metric_id").select("metric_id", "label", "unit", "n")


@query("JN7", S.readiness() + f"SELECT category, {_LABELS.format('category')} AS label, count(*) AS n FROM long WHERE rollup_level = 'date_category' GROUP BY category")
def labels_overlaid(spark, folder):
    counted = sn.at_level(long_of(spark, folder), "date_category").groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("label", sv.looked_up(sv.CATEGORY_LABELS, F.col("category"), F.col("category")))


def _export_sql(level: str, segment: str, label: str) -> str:
    return S.readiness() + (f"SELECT {label} AS {segment}, max(value) FILTER (metric_id = 'readiness_completion_pct') AS readiness_completion_pct, "
                            f"max(value) FILTER (metric_id = 'open_gap_count') AS open_gap_count FROM long WHERE {NEWEST.format(level)} GROUP BY {segment}")


@query("RSH4", _export_sql("date_category", "category", "category"))
def pair_pivoted(spark, folder):
    return sv.segment_export(long_of(spark, folder), "category")


@query("SRV6", _export_sql("date_category", "category", _LABELS.format("category")))
def by_category(spark, folder):
    return sv.category_export(long_of(spark, folder))


@query("SRV7", _export_sql("date_market", "market", "market"))
def by_market(spark, folder):
    return sv.market_export(long_of(spark, folder))


@query("SRV2", S.readiness() + f"SELECT {ROW} FROM long WHERE {NEWEST.format('date_only')}")
def latest_kpis(spark, folder):
    return sv.latest_kpis(long_of(spark, folder))


@query("SRV3", S.market(changes=True) + "SELECT rollup_level, date, provider, region, metric_id, label, value, unit, prior_period_value, period_change, period_change_pct FROM long WHERE rollup_level = 'date_only' ORDER BY metric_id, date")
def trends(spark, folder):
    return sv.metric_trends(market_long(spark, folder))


@query("SRV5", S.readiness() + f", {DICTIONARY} SELECT metric_id, l.label, value, l.unit, coalesce(description, '') AS description FROM long l LEFT JOIN dict d ON d.id = metric_id WHERE {NEWEST.format('date_only')} AND metric_id IN {IDS} ORDER BY {ORDER}")
def kpi_table(spark, folder):
    return sv.kpi_export(long_of(spark, folder), dictionary(spark))


@query("SRV8", SUMMARY_SQL)
def validation_table(spark, folder):
    return sv.validation_export(summary_of(spark, folder))


@query("SRV9", S.readiness() + f", {DICTIONARY} SELECT dict.* FROM dict WHERE id IN (SELECT metric_id FROM long) ORDER BY id")
def dictionary_table(spark, folder):
    used = long_of(spark, folder).select(F.col("metric_id").alias("id")).distinct()
    return sv.dictionary_export(dictionary(spark).join(used, "id", "left_semi"))


@query("SRV10", S.readiness() + "SELECT metric_id, CASE metric_id " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sv.CARD_LABELS.items()) + " END AS label, value, unit, "
       "CASE WHEN unit = '%' THEN format('{:.1f}', value) || '%' ELSE round_even(value, 0)::BIGINT::VARCHAR END AS formatted_value, CASE metric_id "
       + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sv.CARD_DESCRIPTIONS.items()) + f" END AS description, metric_id = 'readiness_completion_pct' AS is_primary FROM long WHERE {NEWEST.format('date_only')}")
def cards(spark, folder):
    board = sv.READINESS_DASHBOARD
    return sv.kpi_cards(long_of(spark, folder), dictionary(spark), board.sections[0], board)


@query("SRV11", S.readiness() + f"SELECT category, metric_id, label, value, unit FROM long WHERE {NEWEST.format('date_category')} AND metric_id IN {PAIR}")
def breakdown(spark, folder):
    return sv.breakdown_rows(long_of(spark, folder), "date_category", "category", sv.BREAKDOWN_IDS)


@query("SRV12", S.readiness() + ", states AS (" + " UNION ALL ".join(
    f"SELECT '{s.type}' AS section, count(*) FILTER ({NEWEST.format(s.rollup_level)} AND metric_id IN ({', '.join(repr(m) for m in s.metrics)})) AS n_rows FROM long" for s in sv.READINESS_DASHBOARD.sections)
    + ") SELECT section, CASE WHEN section = 'market_breakdown' THEN 0 ELSE n_rows END AS n_rows, section <> 'market_breakdown' AS rendered, section = 'market_breakdown' AS skipped FROM states")
def sections(spark, folder):
    """Without the market rollup its optional section is skipped."""
    long = long_of(spark, folder).filter(F.col("rollup_level") != "date_market")
    return sv.section_states(long, sv.READINESS_DASHBOARD)


def _store(spark, folder) -> sv.Store:
    """All six tables of a run written as one version and opened again; what is made from the long metrics reads them once stored."""
    long = materialized(long_of(spark, folder, changes=True), "long")
    store = sv.Store(spark, scratch_path(spark, "store"))
    sentences = period_insights(long)
    store.write({
        "long_metrics": long, "wide_metrics": wide_metrics(long, READINESS_METRICS), "metric_dictionary": dictionary(spark),
        "metrics_validation_summary": summary_of(spark, folder), "report_insights": sentences,
        "report_summary": sn.report_summary(long),
    })
    return store


@query("SRV1", S.readiness(changes=True) + """, n AS (SELECT count(*) AS long_rows, count(DISTINCT (rollup_level, date, category, market)) AS wide_rows FROM long),
i AS (SELECT metric_id, last(period_change_pct ORDER BY date) FILTER (period_change_pct IS NOT NULL) AS p FROM long WHERE rollup_level = 'date_only' GROUP BY metric_id)
SELECT 'long_metrics' AS table_name, long_rows AS n FROM n UNION ALL SELECT 'wide_metrics', wide_rows FROM n UNION ALL SELECT 'metric_dictionary', 4
UNION ALL SELECT 'metrics_validation_summary', 1 UNION ALL SELECT 'report_insights', count(p) FROM i UNION ALL SELECT 'report_summary', 1""")
def store_tables(spark, folder):
    store = _store(spark, folder)
    counts = [store.table(t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n") for t in sv.STORE_TABLES]
    result = counts[0]
    for c in counts[1:]:
        result = result.unionByName(c)
    return result


@query("SRV4", S.market(changes=True) + """, snap AS (SELECT metric_id, last(label ORDER BY date) AS label, max(date)::VARCHAR AS date,
  last(period_change_pct ORDER BY date) FILTER (period_change_pct IS NOT NULL) AS period_change_pct FROM long WHERE rollup_level = 'date_only' GROUP BY metric_id)
SELECT metric_id, label, date, round_even(period_change_pct, 4) AS period_change_pct, CASE WHEN period_change_pct > 0 THEN 'up' WHEN period_change_pct < 0 THEN 'down' ELSE 'flat' END AS direction FROM snap""")
def insights_view(spark, folder):
    return period_insights(market_long(spark, folder)).select("metric_id", "label", "date", "period_change_pct", "direction")
