"""Schema normalisation, metric roll-ups, reshaping and prior periods."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.catalog import sql as S
from kpiloom.catalog.registrar import query
from kpiloom.operators import cleaning as cl
from kpiloom.operators import rollups
from kpiloom.operators import schema as sc
from kpiloom.operators.snapshot import latest_date, report_summary
from kpiloom.plans import views
from kpiloom.plans.metrics import published_long
from kpiloom.plans.registry import MARKET_METRICS, MARKET_SCHEMA, READINESS_METRICS, READINESS_SCHEMA, FactSchema

LONG = "rollup_level, date, category, market, metric_id, label, value, unit"
MARKET_LONG = "rollup_level, date, provider, region, metric_id, label, value, unit"


def unrounded(spark, folder):
    return rollups.long_metrics(views.requirements(spark, folder), READINESS_METRICS)


def market_unrounded(spark, folder):
    return rollups.long_metrics(views.market_facts(spark, folder), MARKET_METRICS)


def aliased(spark, folder):
    """Facts under the names a sender might use, with columns nobody asked for."""
    return views.market_facts(spark, folder).select(
        F.col("date").alias("Period"), F.col("revenue").alias("REV"), F.col("capacity_mw").alias("cap mw"),
        F.col("leased_mw").alias("LeasedMW"), F.col("contracted_kw").alias("kw-contracted"), F.col("region").alias("Geo"),
        F.col("provider").alias("Vendor"), F.lit("x").alias("notes"), F.lit(1).alias("market_tier"),
    )


def one_metric(source, metric_id):
    return lambda spark, folder: source(spark, folder).filter(F.col("metric_id") == metric_id)


for _id, _metric in (("AGG1", "total_revenue"), ("AGG2", "utilization_pct"), ("AGG3", "avg_price_per_kw")):
    query(_id, S.market(rounding=False) + f"SELECT {MARKET_LONG} FROM long WHERE metric_id = '{_metric}'")(one_metric(market_unrounded, _metric))
for _id, _metric in (("AGG4", "total_requirement_count"), ("AGG5", "open_gap_count"), ("AGG6", "readiness_completion_pct")):
    query(_id, S.readiness(rounding=False) + f"SELECT {LONG} FROM long WHERE metric_id = '{_metric}'")(one_metric(unrounded, _metric))


@query("AGG7", S.readiness(rounding=False) + f"SELECT {LONG} FROM long")
def rollup_family(spark, folder):
    return unrounded(spark, folder)


@query("AGG8", S.market(rounding=False) + "SELECT rollup_level, count(*) AS n FROM long GROUP BY rollup_level")
def rollup_labels(spark, folder):
    return market_unrounded(spark, folder).groupBy("rollup_level").agg(F.count(F.lit(1)).alias("n"))


@query("AGG9", f"WITH {S.FACTS}, " + S.long(S.MARKET, "facts", ["region"], [[], ["region"]]) + " SELECT rollup_level, date, region, metric_id, label, value, unit FROM long")
def rollups_skipped(spark, folder):
    return published_long(views.market_facts(spark, folder).drop("provider"), MARKET_METRICS)


@query("AGG10", f"""WITH {S.REQUIREMENTS} SELECT 'date_category' AS rollup_level, count(*) FILTER (category IS NOT NULL)::DOUBLE AS rows_in FROM req
UNION ALL SELECT 'date_market', count(*)::DOUBLE FROM req UNION ALL SELECT 'date_only', count(*)::DOUBLE FROM req
UNION ALL SELECT 'date_category_market', count(*) FILTER (category IS NOT NULL)::DOUBLE FROM req""")
def null_segments(spark, folder):
    counts = unrounded(spark, folder).filter(F.col("metric_id") == "total_requirement_count")
    return counts.groupBy("rollup_level").agg(F.sum("value").alias("rows_in"))


@query("AGG11", f"WITH {S.FACTS}, " + S.long(S.READINESS[:1], "facts", ["region"], [[], ["region"]]) + " SELECT date, value FROM long WHERE rollup_level = 'date_only'")
def inputs_checked(spark, folder):
    facts = views.market_facts(spark, folder)
    rollups.require_inputs(facts, MARKET_METRICS)
    return rollups.long_metrics(
        facts.withColumns({"status": F.lit("open"), "severity": F.lit("low")}), READINESS_METRICS
    ).filter((F.col("rollup_level") == "date_only") & (F.col("metric_id") == "total_requirement_count")).select("date", "value")


@query("AGG17", S.readiness() + "SELECT min(date) AS date_min, max(date) AS date_max, count(DISTINCT metric_id) AS metric_count, "
       "list_sort(list(DISTINCT rollup_level))::VARCHAR AS rollup_levels FROM long")
def summary(spark, folder):
    report = report_summary(published_long(views.requirements(spark, folder), READINESS_METRICS))
    return report.withColumn("rollup_levels", F.concat(F.lit("["), F.array_join("rollup_levels", ", "), F.lit("]")))


@query("AGG18", S.readiness() + "SELECT max(date) AS date FROM long WHERE rollup_level = 'date_only'")
def as_of(spark, folder):
    return latest_date(published_long(views.requirements(spark, folder), READINESS_METRICS))


@query("SET3", f"WITH {S.REQUIREMENTS}, {S.FACTS}, " + S.long(S.READINESS, "req", ["category", "market"], S.READINESS_ROLLUPS, name="a") + ", "
       + S.long(S.MARKET, "facts", ["provider", "region"], S.MARKET_ROLLUPS, name="b")
       + f" SELECT {LONG}, NULL::VARCHAR AS provider, NULL::VARCHAR AS region FROM a UNION ALL SELECT rollup_level, date, NULL, NULL, metric_id, label, value, unit, provider, region FROM b")
def union_of_segments(spark, folder):
    return published_long(views.requirements(spark, folder), READINESS_METRICS).unionByName(
        published_long(views.market_facts(spark, folder), MARKET_METRICS), allowMissingColumns=True)


@query("RSH1", S.market(rounding=False) + f"SELECT {MARKET_LONG} FROM long")
def melted(spark, folder):
    return rollups.melt(rollups.rollup_parts(views.market_facts(spark, folder), MARKET_METRICS), MARKET_METRICS)


@query("RSH2", S.readiness() + "SELECT rollup_level, date, category, market, " + ", ".join(
    f"max(CASE WHEN metric_id = '{m[0]}' THEN value END) AS {m[0]}" for m in S.READINESS) + " FROM long GROUP BY ALL")
def wide(spark, folder):
    return rollups.wide_metrics(published_long(views.requirements(spark, folder), READINESS_METRICS), READINESS_METRICS)


@query("RSH3", S.market() + f"SELECT {MARKET_LONG} FROM long")
def ordered(spark, folder):
    return rollups.ordered_long(rollups.rounded(market_unrounded(spark, folder), MARKET_METRICS))


@query("RSH8", S.readiness() + "SELECT metric_id AS id, any_value(label) AS label, any_value(unit) AS unit, count(*) AS n_values FROM long GROUP BY metric_id")
def dictionary(spark, folder):
    long = published_long(views.requirements(spark, folder), READINESS_METRICS)
    entries = rollups.metric_dictionary(spark, READINESS_METRICS).select("id", "label", "unit")
    counts = long.groupBy(F.col("metric_id").alias("id")).agg(F.count(F.lit(1)).alias("n_values"))
    return counts.join(entries, "id")


@query("RSH9", S.market() + f"SELECT {MARKET_LONG} FROM long")
def rounded(spark, folder):
    return rollups.rounded(market_unrounded(spark, folder), MARKET_METRICS)


_CHANGES = "prior_period_value, period_change, period_change_pct"


@query("WIN1", S.readiness(changes=True) + "SELECT rollup_level, date, category, market, metric_id, value, prior_period_value FROM long")
def prior(spark, folder):
    long = published_long(views.requirements(spark, folder), READINESS_METRICS, changes=True)
    return long.select("rollup_level", "date", "category", "market", "metric_id", "value", "prior_period_value")


@query("WIN2", S.market(changes=True) + "SELECT rollup_level, date, provider, region, metric_id, value, period_change FROM long")
def change(spark, folder):
    long = published_long(views.market_facts(spark, folder), MARKET_METRICS, changes=True)
    return long.select("rollup_level", "date", "provider", "region", "metric_id", "value", "period_change")


@query("WIN3", S.readiness(changes=True) + f"SELECT {LONG}, {_CHANGES} FROM long")
def change_percent(spark, folder):
    return published_long(views.requirements(spark, folder), READINESS_METRICS, changes=True)


@query("SCH1", f"WITH {S.FACTS} SELECT date, revenue::DOUBLE AS revenue, capacity_mw::DOUBLE AS capacity_mw, leased_mw::DOUBLE AS leased_mw, "
       "contracted_kw::DOUBLE AS contracted_kw, region, provider FROM facts")
def aliases_resolved(spark, folder):
    return _doubles(sc.normalize(aliased(spark, folder), MARKET_SCHEMA).facts)


def _doubles(facts):
    amounts = [c for c, t in facts.dtypes if t.startswith("decimal")]
    return facts.withColumns({c: F.col(c).cast("double") for c in amounts})


@query("SCH2", f"WITH {S.FACTS} SELECT date, count(*) AS n, 'notes,market_tier' AS dropped FROM facts GROUP BY date")
def unknown_dropped(spark, folder):
    done = sc.normalize(aliased(spark, folder), MARKET_SCHEMA)
    return done.facts.groupBy("date").agg(F.count(F.lit(1)).alias("n")).withColumn("dropped", F.lit(",".join(done.dropped)))


@query("SCH3", f"WITH {S.REQUIREMENTS} SELECT status, severity, count(*) AS n, 'market' AS missing FROM req GROUP BY status, severity")
def segments_missing(spark, folder):
    raw = views.requirements(spark, folder).select("date", F.col("category").alias("Track"), F.col("status").alias("requirement_status"), F.col("severity").alias("Criticality"))
    done = sc.normalize(raw, READINESS_SCHEMA)
    return done.facts.groupBy("status", "severity").agg(F.count(F.lit(1)).alias("n")).withColumn("missing", F.lit(",".join(done.missing_segments)))


@query("SCH4", f"""WITH {S.MESSY_TEXT} SELECT try_strptime(order_date, {S.PARSED_STYLES})::DATE AS date, try_cast(total_price AS DOUBLE) AS revenue,
  CASE WHEN regexp_full_match(ship_note, '[0-9.]+') THEN ship_note::DOUBLE END AS capacity_mw FROM standard""")
def casts(spark, folder):

    raw = cl.standardize(cl.null_sentinels(views.messy_orders(spark, folder).drop("source_file")))
    facts = raw.select(F.col("order_date").alias("Date"), F.col("total_price").alias("rev"), F.col("ship_note").alias("capacity_mw"))
    schema = FactSchema(tuple(s for s in MARKET_SCHEMA.base if s.name in ("date", "revenue", "capacity_mw")))
    return sc.normalize(facts, schema, check_values=False).facts


@query("SCH4_failures", f"""WITH {S.MESSY_TEXT} SELECT count(order_date) - count(try_strptime(order_date, {S.PARSED_STYLES})) AS date,
  count(total_price) - count(try_cast(total_price AS DOUBLE)) AS revenue,
  count(ship_note) - count(CASE WHEN regexp_full_match(ship_note, '[0-9.]+') THEN 1 END) AS capacity_mw FROM standard""")
def cast_failures(spark, folder):

    raw = cl.standardize(cl.null_sentinels(views.messy_orders(spark, folder).drop("source_file")))
    facts = raw.select(F.col("order_date").alias("date"), F.col("total_price").alias("revenue"), F.col("ship_note").alias("capacity_mw"))
    return sc.failed_casts(facts, FactSchema(tuple(s for s in MARKET_SCHEMA.base if s.name in facts.columns)))
