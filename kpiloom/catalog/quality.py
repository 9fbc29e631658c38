"""Checks of fact tables before metrics, and of keys."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.catalog import sql as S
from kpiloom.catalog.registrar import query
from kpiloom.operators import metric_checks as mc
from kpiloom.operators import sets
from kpiloom.operators.ordering import iqr_outliers, quartiles
from kpiloom.operators.schema import Normalized, normalize
from kpiloom.plans import views
from kpiloom.plans.metrics import published_long
from kpiloom.plans.registry import MARKET_METRICS, MARKET_SCHEMA, READINESS_METRICS
from kpiloom.session import materialized

AMOUNTS = ["capacity_mw", "contracted_kw", "leased_mw", "revenue"]

# Facts with flaws: some nulls, zero capacity, negative revenue, rows repeated.
_FLAWED = f"""WITH {S.FACTS}, flawed AS (
  SELECT CASE WHEN date = DATE '1996-05-01' THEN NULL ELSE date END AS date,
    CASE WHEN provider = 'MACHINERY' AND capacity_mw > 45 THEN NULL WHEN capacity_mw = 7 THEN -revenue ELSE revenue END AS revenue,
    CASE WHEN capacity_mw = 3 THEN 0 ELSE capacity_mw END::DECIMAL(12,2) AS capacity_mw, leased_mw, contracted_kw, region, provider
  FROM facts, generate_series(1, CASE WHEN capacity_mw = 11 THEN 2 ELSE 1 END) AS copies(i)
)"""


def flawed(spark, folder):
    facts = views.market_facts(spark, folder)
    copied = facts.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.when(F.col("capacity_mw") == 11, 2).otherwise(1)))).drop("copy")
    mw = F.col("capacity_mw")
    return copied.withColumns({
        "date": F.when(F.col("date") != F.lit("1996-05-01").cast("date"), F.col("date")),
        "revenue": F.when((F.col("provider") == "MACHINERY") & (mw > 45), None).when(mw == 7, -F.col("revenue")).otherwise(F.col("revenue")),
        "capacity_mw": F.when(mw == 3, 0).otherwise(mw).cast("decimal(12,2)"),
    })


def found(spark, folder, *checks):
    rows = mc.value_findings(flawed(spark, folder), MARKET_METRICS)
    return rows.filter(F.col("check").isin(*checks)) if checks else rows


def _finding(check: str, severity: str, column: str, n: str, message: str) -> str:
    return f"SELECT '{check}' AS \"check\", '{severity}' AS severity, '{column}' AS \"column\", ({n})::BIGINT AS n, {message} AS message FROM flawed HAVING {n} > 0"


@query("MVL1", f"""WITH {S.FACTS} SELECT 'missing_input' AS "check", 'leased_mw' AS "column", 'Missing required metric input column: ''leased_mw''' AS message, count(*) AS n_rows FROM facts
UNION ALL SELECT 'missing_input', 'revenue', 'Missing required metric input column: ''revenue''', count(*) FROM facts""")
def missing_columns(spark, folder):
    facts = views.market_facts(spark, folder).drop("revenue", "leased_mw")
    findings = mc.column_findings(Normalized(facts), MARKET_METRICS)
    return findings.select("check", "column", "message").withColumn("n_rows", facts.agg(F.count(F.lit(1))).scalar())


@query("MVL2", f"{_FLAWED} " + _finding("null_input", "error", "revenue", "count(*) - count(revenue)", "'Null values found in metric input column: ''revenue'''"))
def null_inputs(spark, folder):
    return found(spark, folder, "null_input")


@query("MVL3", f"{_FLAWED} " + _finding("null_date", "error", "date", "count(*) - count(date)", "'Null/unparseable values found in ''date'' column'"))
def null_dates(spark, folder):
    return found(spark, folder, "null_date")


@query("MVL4", f"{_FLAWED} " + _finding("zero_denominator", "error", "capacity_mw", "count(*) FILTER (capacity_mw = 0)", "'Zero values in denominator column: ''capacity_mw'''"))
def zero_denominators(spark, folder):
    return found(spark, folder, "zero_denominator")


@query("MVL5", f"""WITH {S.FACTS} SELECT 'dropped_column' AS "check", 'notes' AS "column", 'Column ''notes'' was dropped (not recognized by schema)' AS message, count(*) AS n_rows FROM facts
UNION ALL SELECT 'missing_segment', 'provider', 'Optional segment column ''provider'' is missing from data; rollup(s) [[''provider''], [''region'', ''provider'']] will be skipped', count(*) FROM facts""")
def dropped_and_missing(spark, folder):
    done = normalize(views.market_facts(spark, folder).drop("provider").withColumn("notes", F.lit("x")), MARKET_SCHEMA)
    findings = mc.column_findings(done, MARKET_METRICS)
    return findings.select("check", "column", "message").withColumn("n_rows", done.facts.agg(F.count(F.lit(1))).scalar())


@query("MVL6", f"{_FLAWED}, n AS (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM flawed)) AS n FROM flawed) SELECT n, n || ' duplicate row(s) found (exact match)' AS message FROM n")
def duplicates(spark, folder):
    return mc.duplicate_findings(flawed(spark, folder)).select("n", "message")


@query("MVL7", f"{_FLAWED}, k AS (" + " UNION ALL ".join(
    f"SELECT '{'_'.join(['date', *r]) if r else 'date_only'}' AS rollup_level, 'the same date{'+' + '+'.join(r) + ' key' if r else ''}' AS key_text, "
    f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(['date', *r])} FROM flawed)) AS n FROM flawed" for r in S.MARKET_ROLLUPS)
    + ") SELECT rollup_level AS \"column\", n, n || ' additional row(s) share ' || key_text || ' for rollup ' || rollup_level || '; values will be aggregated.' AS message FROM k WHERE n > 0")
def shared_keys(spark, folder):
    return mc.key_findings(flawed(spark, folder), MARKET_METRICS).select("column", "n", "message")


@query("MVL8", f"""{_FLAWED} SELECT count(*) AS n, count(*) || ' row(s) where leased_mw exceeds capacity_mw' AS message FROM flawed WHERE leased_mw > capacity_mw""")
def overleased(spark, folder):
    return found(spark, folder, "leased_over_capacity").select("n", "message")


@query("MVL9", f"""{_FLAWED} SELECT count(*) AS n, count(*) || ' row(s) with negative revenue' AS message FROM flawed WHERE revenue < 0""")
def negative_revenue(spark, folder):
    return found(spark, folder, "negative_revenue").select("n", "message")


_QUARTILES = ", ".join(f"quantile_cont({c}::DOUBLE, {q}) AS {c}_{n}" for c in AMOUNTS for n, q in (("q1", 0.25), ("q3", 0.75)))
_OUTLIERS = f"{_FLAWED}, q AS (SELECT {_QUARTILES} FROM flawed), o AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", any_value({c}_q1 - 1.5 * ({c}_q3 - {c}_q1)) AS low, any_value({c}_q3 + 1.5 * ({c}_q3 - {c}_q1)) AS high, "
    f"count(*) FILTER ({c}::DOUBLE < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) OR {c}::DOUBLE > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1)) AS n FROM flawed, q" for c in AMOUNTS) + ")"


@query("MVL10", _OUTLIERS + " SELECT \"column\", round_even(low, 4) AS low, round_even(high, 4) AS high, n, "
       "CASE WHEN n > 0 THEN n || ' outlier value(s) in ''' || \"column\" || ''' (outside [' || format('{:.2f}', low) || ', ' || format('{:.2f}', high) || '])' END AS message FROM o")
def outliers(spark, folder):
    fences = materialized(iqr_outliers(flawed(spark, folder), AMOUNTS), "fences")
    texts = mc.outlier_texts(fences).select("column", "message")
    return fences.join(texts, "column", "left").withColumns({c: F.rint(F.col(c) * 10000) / 10000 for c in ("low", "high")})


@query("MVL10_quartiles", f"{_FLAWED}, q AS (SELECT {_QUARTILES} FROM flawed) " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS total, round_even(any_value({c}_q1), 4) AS q1, round_even(any_value({c}_q3), 4) AS q3 FROM flawed, q" for c in AMOUNTS))
def exact_quartiles(spark, folder):
    found = quartiles(flawed(spark, folder), AMOUNTS)
    table = spark.createDataFrame([(c, *values) for c, values in found.items()], "column string, total bigint, q1 double, q3 double")
    return table.withColumns({c: F.rint(F.col(c) * 10000) / 10000 for c in ("q1", "q3")})


def findings_of(spark, folder):
    return mc.metric_findings(Normalized(flawed(spark, folder)), MARKET_METRICS)


def summary_of(spark, folder):
    return mc.validation_summary(findings_of(spark, folder))


SUMMARY_SQL = _OUTLIERS + """, counts AS (SELECT
  (count(*) > count(revenue))::INT + (count(*) > count(date))::INT + (count(*) FILTER (capacity_mw = 0) > 0)::INT AS error_count,
  (count(*) FILTER (leased_mw > capacity_mw) > 0)::INT + (count(*) FILTER (revenue < 0) > 0)::INT + 1 + 4 + (SELECT count(*) FROM o WHERE n > 0) AS warning_count
  FROM flawed)
SELECT CASE WHEN error_count > 0 THEN 'failed' WHEN warning_count > 0 THEN 'passed_with_warnings' ELSE 'passed' END AS status,
  error_count::BIGINT AS error_count, warning_count::BIGINT AS warning_count FROM counts"""


@query("MVL11", SUMMARY_SQL)
def status(spark, folder):
    return summary_of(spark, folder)


@query("SRV13", f"""WITH {S.REQUIREMENTS}, n AS (SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM req)) > 0)::BIGINT + 4 AS warning_count FROM req)
SELECT 'passed_with_warnings' AS status, 0::BIGINT AS error_count, warning_count FROM n""")
def validation_row(spark, folder):
    return mc.validation_summary(mc.metric_findings(Normalized(views.requirements(spark, folder)), READINESS_METRICS))


@query("CHK1", f"WITH {S.SALES} SELECT order_id, product_id, count(*) AS n FROM sales GROUP BY order_id, product_id HAVING count(*) > 1")
def repeated_keys(spark, folder):
    return sets.repeated_keys(views.sales_orders(spark, folder, by_order=True), ["order_id", "product_id"])


@query("CHK1_single", "SELECT 'orders' AS table_name, count(*) - count(DISTINCT o_orderkey) AS n FROM orders UNION ALL SELECT 'part', count(*) - count(DISTINCT p_partkey) FROM part "
       "UNION ALL SELECT 'lineitem', (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1))")
def repeated_single_keys(spark, folder):
    def count(name, key):
        bad = sets.repeated_keys(views.table(spark, folder, name), [key])
        return bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")

    return count("orders", "o_orderkey").unionByName(count("part", "p_partkey")).unionByName(count("lineitem", "l_orderkey"))


@query("JN6", f"WITH {S.SALES} SELECT order_id, customer_id FROM sales WHERE customer_id NOT IN (SELECT customer_id FROM customers WHERE region <> 'ASIA')")
def orphaned(spark, folder):
    present = views.customers(spark, folder).filter(F.col("region") != "ASIA")
    return sets.orphans(views.sales_orders(spark, folder).select("order_id", "customer_id"), "customer_id", present, "customer_id")


@query("MVL11_stops", S.readiness() + "SELECT count(*) AS n, 'stopped' AS flawed_run FROM long")
def failed_stops(spark, folder):
    """Errors stop a run; sound facts go on to metrics."""
    try:
        mc.stop_if_failed(mc.value_findings(flawed(spark, folder), MARKET_METRICS))
        outcome = "went on"
    except mc.ValidationFailed:
        outcome = "stopped"
    facts = views.requirements(spark, folder)
    mc.stop_if_failed(mc.value_findings(facts, READINESS_METRICS))
    long = published_long(facts, READINESS_METRICS)
    return long.agg(F.count(F.lit(1)).alias("n")).withColumn("flawed_run", F.lit(outcome))
