"""Snapshots, insights, recommendations and display values."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.catalog import sql as S
from kpiloom.catalog.registrar import query
from kpiloom.functions import numbers as nb
from kpiloom.operators import insights as ins
from kpiloom.operators import snapshot as sn
from kpiloom.plans import views
from kpiloom.plans.metrics import published_long
from kpiloom.plans.registry import MARKET_METRICS, READINESS_METRICS

KEY = ["portfolio"]


def long_of(spark, folder, keys=None, changes=False):
    return published_long(views.requirements(spark, folder), READINESS_METRICS, keys, changes)


def market_long(spark, folder):
    return published_long(views.market_facts(spark, folder), MARKET_METRICS, changes=True)


def fixed_decimals(expr: str) -> str:
    """Percent text of values that carry at most two decimals and stay below one million."""
    return f"regexp_replace(regexp_replace(format('{{:.2f}}', round_even({expr}, greatest(0, 5 - floor(log10(greatest(abs({expr}), 1)))::INT))), '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '') || '%'"


# The newest known value of each column, one column at a time.
_SNAP = """, dated AS (SELECT * FROM long WHERE rollup_level = 'date_only'),
snap AS (SELECT portfolio, metric_id, max(date) AS date, last(label ORDER BY date) AS label, last(unit ORDER BY date) AS unit,
  last(value ORDER BY date) FILTER (value IS NOT NULL) AS value,
  last(period_change_pct ORDER BY date) FILTER (period_change_pct IS NOT NULL) AS period_change_pct FROM dated GROUP BY portfolio, metric_id)"""
_WITH_SNAP = S.readiness(KEY, changes=True) + _SNAP


@query("WIN5", _WITH_SNAP + " SELECT portfolio, metric_id, date, label, unit, value, period_change_pct FROM snap")
def latest_known(spark, folder):
    table = sn.snapshot(long_of(spark, folder, KEY, True), KEY)
    return table.select("portfolio", "metric_id", "date", "label", "unit", "value", "period_change_pct")


@query("INS1", _WITH_SNAP + " SELECT portfolio, metric_id, label, date, value, unit FROM snap ORDER BY portfolio, label")
def snapshot_sorted(spark, folder):
    return ins.sorted_snapshot(long_of(spark, folder, KEY, True), KEY)


@query("INS2", _WITH_SNAP + f""", p AS (SELECT *, {fixed_decimals("abs(period_change_pct)")} AS size FROM snap WHERE period_change_pct IS NOT NULL)
SELECT portfolio, metric_id, label, date::VARCHAR AS date, round_even(period_change_pct, 4) AS period_change_pct,
  CASE WHEN period_change_pct > 0 THEN 'up' WHEN period_change_pct < 0 THEN 'down' ELSE 'flat' END AS direction,
  CASE WHEN period_change_pct > 0 THEN label || ' increased ' || size || ' vs prior period'
       WHEN period_change_pct < 0 THEN label || ' decreased ' || size || ' vs prior period' ELSE label || ' remained flat vs prior period' END AS text FROM p""")
def change_sentences(spark, folder):
    return ins.period_insights(long_of(spark, folder, KEY, True), KEY)


@query("INS3", S.readiness(KEY) + """, dated AS (SELECT * FROM long WHERE rollup_level = 'date_only'
  AND (portfolio NOT IN ('NATION_3', 'NATION_7') OR metric_id = 'open_gap_count') AND (portfolio <> 'NATION_7')
  UNION ALL SELECT portfolio, rollup_level, date, category, market, 'other_' || metric_id, label, value, unit FROM long WHERE rollup_level = 'date_only' AND portfolio IN ('NATION_3', 'NATION_7'))
SELECT portfolio, metric_id, last(label ORDER BY date) AS label, max(date) AS date, last(value ORDER BY date) AS value, last(unit ORDER BY date) AS unit
FROM dated WHERE portfolio = 'NATION_7' OR NOT starts_with(metric_id, 'other_') GROUP BY portfolio, metric_id""")
def readiness_or_all(spark, folder):
    """Two portfolios carry foreign metrics; one of them carries nothing else and falls back to all it has."""
    long = long_of(spark, folder, KEY)
    odd = F.col("portfolio").isin("NATION_3", "NATION_7")
    foreign = long.filter(odd).withColumn("metric_id", F.concat(F.lit("other_"), F.col("metric_id")))
    kept = long.filter((F.col("portfolio") != "NATION_7") & (~odd | (F.col("metric_id") == "open_gap_count")))
    return ins.readiness_snapshot(kept.unionByName(foreign), KEY)


_STANDING = _SNAP + f""",
headline AS (SELECT portfolio, max(value) FILTER (metric_id = 'readiness_completion_pct') AS pct, max(value) FILTER (metric_id = 'open_gap_count')::BIGINT AS gaps,
  max(value) FILTER (metric_id = 'critical_item_count')::BIGINT AS crit FROM snap GROUP BY portfolio),
newest AS (SELECT portfolio, max(date) AS date FROM long WHERE rollup_level = 'date_category' GROUP BY portfolio),
matrix AS (SELECT portfolio, category, max(value) FILTER (metric_id = 'open_gap_count') AS gaps, max(value) FILTER (metric_id = 'readiness_completion_pct') AS pct,
  max(value) FILTER (metric_id = 'critical_item_count') AS crit
  FROM long JOIN newest USING (portfolio, date) WHERE rollup_level = 'date_category' AND category IS NOT NULL GROUP BY portfolio, category),
top AS (SELECT portfolio, category AS gap_category, gaps::BIGINT AS gap_category_count FROM (SELECT *, row_number() OVER (PARTITION BY portfolio ORDER BY gaps DESC, category) AS place FROM matrix) WHERE place = 1),
low AS (SELECT portfolio, category AS weakest_category, pct AS weakest_pct FROM (SELECT *, row_number() OVER (PARTITION BY portfolio ORDER BY pct, category) AS place FROM matrix) WHERE place = 1),
standing AS (SELECT * FROM headline LEFT JOIN top USING (portfolio) LEFT JOIN low USING (portfolio))"""
_WITH_STANDING = S.readiness(KEY, changes=True) + _STANDING


def _advice_sql(column: str, table: dict[str, str], other: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items())
    return f"CASE lower({column}) {cases} ELSE {other} END"


_GAP = _advice_sql("gap_category", ins.GAP_ADVICE, "'Address open gaps in the ' || gap_category || ' category to improve overall readiness.'")
_LOW = _advice_sql("weakest_category", ins.COMPLETION_ADVICE, "'Focus on the ' || weakest_category || ' category, which has the lowest readiness completion rate.'")
_PLURAL = "CASE WHEN crit <> 1 THEN 's' ELSE '' END"
_RULES = f""", fired AS (
  SELECT portfolio, 1 AS place, 'critical_blockers' AS rule, NULL AS category, 'critical' AS severity,
    'Resolve ' || crit || ' critical blocker' || {_PLURAL} || ' before advancing to project gate review.' AS recommendation,
    crit || ' critical item' || {_PLURAL} || ' must be closed before milestone progression.' AS rationale FROM standing WHERE crit > 0
  UNION ALL SELECT portfolio, 2, 'top_gap', gap_category, 'high', {_GAP}, gap_category || ' has the highest open gap count (' || gap_category_count || ').' FROM standing WHERE gap_category_count > 0
  UNION ALL SELECT portfolio, 3, 'lowest_completion', weakest_category, 'high', {_LOW}, weakest_category || ' has the lowest completion rate (' || {fixed_decimals("weakest_pct")} || ').' FROM standing WHERE weakest_category IS NOT NULL
  UNION ALL SELECT portfolio, 4, 'hold', NULL, 'medium', 'Hold transaction and RFP outreach until overall readiness improves.',
    'Overall readiness is ' || {fixed_decimals("pct")} || ', below the 60% threshold for external engagement.' FROM standing WHERE pct < 60
  UNION ALL SELECT portfolio, 5, 'prepare', NULL, 'low', 'Prepare market-facing materials and investor outreach packages.',
    'Overall readiness is ' || {fixed_decimals("pct")} || ' with no critical blockers.' FROM standing WHERE pct >= 80 AND crit = 0
), ranked AS (SELECT portfolio, row_number() OVER (PARTITION BY portfolio ORDER BY place)::INTEGER AS priority, rule, category, severity, recommendation, rationale FROM fired)"""


@query("WIN6", _WITH_STANDING + " SELECT portfolio, gap_category, gap_category_count FROM top")
def most_gaps(spark, folder):
    return ins.top_gap_category(long_of(spark, folder, KEY), KEY)


@query("WIN7", _WITH_STANDING + " SELECT portfolio, weakest_category, weakest_pct FROM low")
def least_complete(spark, folder):
    return ins.lowest_completion_category(long_of(spark, folder, KEY), KEY)


@query("WIN8", _WITH_STANDING + _RULES + " SELECT * FROM ranked")
def all_recommendations(spark, folder):
    return ins.recommendations(long_of(spark, folder, KEY), KEY)


for _id, _rule in (("INS5", "critical_blockers"), ("INS6", "top_gap"), ("INS7", "lowest_completion"), ("INS8", "hold")):
    query(_id, _WITH_STANDING + _RULES + f" SELECT * FROM ranked WHERE rule = '{_rule}'")(
        lambda spark, folder, rule=_rule: ins.recommendations(long_of(spark, folder, KEY), KEY, {rule}))


@query("INS4", f"""WITH {S.FACTS} SELECT provider AS client, 1 AS priority, 'low' AS severity, 'Review readiness metrics to identify gaps and priorities.' AS recommendation,
  'Readiness data is incomplete or unavailable.' AS rationale FROM facts GROUP BY provider""")
def no_readiness_data(spark, folder):
    """Market metrics hold no readiness metric, so every client gets the generic row."""
    facts = views.market_facts(spark, folder).withColumnRenamed("provider", "client")
    long = published_long(facts, MARKET_METRICS, ["client"]).withColumn("category", F.col("region"))
    return ins.recommendations(long, ["client"]).select("client", "priority", "severity", "recommendation", "rationale")


# Requirements where most are complete and nothing is critical, to reach the remaining rules.
_CALM = "WITH " + S.REQUIREMENTS.replace("req AS (", "base AS (") + """,
req AS (SELECT date, project_id, portfolio, category, market, CASE WHEN market IN ('ASIA', 'EUROPE') AND status <> 'open' THEN 'closed' WHEN market = 'AFRICA' THEN 'complete' ELSE status END AS status,
  CASE WHEN market <> 'AMERICA' AND severity = 'critical' THEN 'high' ELSE severity END AS severity FROM base),
""" + S.long(S.READINESS, "req", ["category", "market"], S.READINESS_ROLLUPS, KEY, changes=True) + _STANDING + _RULES


def calm_long(spark, folder):
    req = views.requirements(spark, folder)
    market, status = F.col("market"), F.col("status")
    return published_long(req.withColumns({
        "status": F.when(market.isin("ASIA", "EUROPE") & (status != "open"), "closed").when(market == "AFRICA", "complete").otherwise(status),
        "severity": F.when((market != "AMERICA") & (F.col("severity") == "critical"), "high").otherwise(F.col("severity")),
    }), READINESS_METRICS, KEY)


@query("INS9", _CALM + " SELECT * FROM ranked WHERE rule = 'prepare'")
def ready_to_go(spark, folder):
    return ins.recommendations(calm_long(spark, folder), KEY, {"prepare"})


@query("INS10", _CALM + """ SELECT portfolio, 1 AS priority, 'none_fired' AS rule, 'Review readiness metrics to identify gaps and priorities.' AS recommendation,
  'No specific recommendations apply given the current readiness data.' AS rationale FROM standing WHERE NOT coalesce(crit > 0, FALSE) AND NOT coalesce(pct < 60, FALSE) AND NOT coalesce(pct >= 80 AND crit = 0, FALSE)""")
def nothing_fired(spark, folder):
    """Without category rows only the headline rules are left; portfolios in between get the generic row."""
    long = calm_long(spark, folder).filter(F.col("rollup_level") == "date_only")
    return ins.recommendations(long, KEY, {"none_fired"}).select("portfolio", "priority", "rule", "recommendation", "rationale")


_POSTURE = f""" SELECT portfolio,
  CASE WHEN crit > 0 AND (pct IS NULL OR pct < 60) THEN 'Not RFP-Ready' WHEN crit > 0 THEN 'At Risk' WHEN pct IS NULL THEN 'Insufficient Data'
       WHEN pct >= 80 THEN 'RFP-Ready' WHEN pct >= 60 THEN 'Progressing' ELSE 'Not RFP-Ready' END AS posture,
  'This readiness snapshot shows ' || {fixed_decimals("pct")} || ' completion, with ' || gaps || ' open gap' || CASE WHEN gaps <> 1 THEN 's' ELSE '' END
    || ' and ' || crit || ' critical item' || {_PLURAL} || ' unresolved.' AS summary,
  'The most material weakness is ' || CASE weakest_category WHEN 'site_control' THEN 'Site Control' ELSE upper(weakest_category[1]) || weakest_category[2:] END
    || ' readiness (' || {fixed_decimals("weakest_pct")} || ' completion).' AS weakness_note,
  CASE WHEN pct < 60 THEN 'Hold transaction and RFP outreach until overall readiness improves.' WHEN crit > 0 THEN 'Resolve critical blockers before advancing to external engagement.'
       WHEN pct >= 80 THEN 'Proceed — prepare market-facing materials and investor outreach packages.'
       ELSE 'Continue gap resolution to advance toward the RFP readiness threshold.' END AS transaction_posture,
  pct AS overall_pct, gaps AS gap_count, crit AS crit_count, weakest_category, weakest_pct FROM standing"""


@query("INS11", _CALM + _POSTURE)
def postures(spark, folder):
    return ins.assessment(calm_long(spark, folder), KEY)


_CELLS = "CASE segment WHEN 'site_control' THEN 'Site Control' ELSE upper(segment[1]) || segment[2:] END AS label"


@query("INS12", _WITH_STANDING + f", s AS (SELECT portfolio, category AS segment, crit FROM matrix) SELECT portfolio, segment, {_CELLS}, crit::BIGINT AS n, coalesce(crit::BIGINT::VARCHAR, '—') AS cell FROM s")
def critical_by_category(spark, folder):
    return ins.category_counts(long_of(spark, folder, KEY), "critical_item_count", KEY)


@query("FLT5", _WITH_STANDING + f", s AS (SELECT portfolio, category AS segment, gaps FROM matrix) SELECT portfolio, segment, {_CELLS}, gaps::BIGINT AS n, gaps::BIGINT::VARCHAR AS cell FROM s WHERE gaps <> 0")
def open_gaps(spark, folder):
    return ins.category_counts(long_of(spark, folder, KEY), "open_gap_count", KEY, nonzero=True)


def display_sql(value: str, unit: str = "unit") -> str:
    whole = f"format('{{:,.0f}}', {value})"
    part = f"regexp_replace(regexp_replace(format('{{:,.4f}}', {value}), '0+$', ''), '\\.$', '')"
    return (f"CASE WHEN {value} IS NULL THEN '' WHEN {unit} = 'USD' THEN '$' || format('{{:,.2f}}', {value}) WHEN {unit} = '%' THEN {fixed_decimals(value)} "
            f"WHEN {value} = floor({value}) THEN {whole} ELSE {part} END")


_LISTED = ", ".join(f"{display_sql(c)} AS {c}" for c in ("value", "prior_period_value", "period_change"))


@query("INS13", S.market(changes=True) + f"SELECT date, metric_id, label, unit, {_LISTED}, CASE WHEN period_change_pct IS NULL THEN '' ELSE {fixed_decimals('period_change_pct')} END AS period_change_pct "
       "FROM long WHERE rollup_level = 'date_only' ORDER BY date, metric_id")
def listing(spark, folder):
    return ins.metrics_listing(market_long(spark, folder))


@query("SRT2", S.readiness() + f"SELECT date, metric_id, label, unit, {display_sql('value')} AS value FROM long WHERE rollup_level = 'date_only' ORDER BY date, metric_id")
def listing_sorted(spark, folder):
    return ins.metrics_listing(long_of(spark, folder))


@query("FMT1", S.market() + f"SELECT rollup_level, date, provider, region, metric_id, {display_sql('value')} AS shown FROM long")
def displayed(spark, folder):
    long = published_long(views.market_facts(spark, folder), MARKET_METRICS)
    return long.select("rollup_level", "date", "provider", "region", "metric_id", nb.display_value(F.col("value"), F.col("unit")).alias("shown"))


@query("FMT2", S.market() + "SELECT rollup_level, date, provider, region, metric_id, CASE WHEN value IS NULL THEN '—' WHEN unit = '%' THEN format('{:.1f}', value) || '%' "
       "ELSE round_even(value, 0)::BIGINT::VARCHAR END AS shown FROM long")
def carded(spark, folder):
    long = published_long(views.market_facts(spark, folder), MARKET_METRICS)
    return long.select("rollup_level", "date", "provider", "region", "metric_id", nb.card_value(F.col("value"), F.col("unit")).alias("shown"))


@query("FMT3", f"WITH {S.REQUIREMENTS}, s AS (SELECT category AS segment FROM req UNION SELECT market FROM req) SELECT segment, CASE WHEN segment = upper(segment) THEN segment "
       "WHEN segment = 'site_control' THEN 'Site Control' ELSE upper(segment[1]) || segment[2:] END AS label FROM s WHERE segment IS NOT NULL")
def segment_labels(spark, folder):
    req = views.requirements(spark, folder)
    names = req.select(F.col("category").alias("segment")).union(req.select("market")).filter(F.col("segment").isNotNull()).distinct()
    return names.withColumn("label", nb.segment_label(F.col("segment")))


@query("FMT4", S.readiness() + "SELECT date, category, market, value, CASE WHEN value >= 70 THEN '#27ae60' WHEN value >= 50 THEN '#f39c12' ELSE '#e74c3c' END AS color, "
       "least(100, greatest(0, round_even(value, 0)))::INTEGER AS width FROM long WHERE metric_id = 'readiness_completion_pct'")
def coloured(spark, folder):
    pct = long_of(spark, folder).filter(F.col("metric_id") == "readiness_completion_pct")
    return pct.select("date", "category", "market", "value", nb.completion_colour(F.col("value")).alias("color"), nb.bar_width(F.col("value")).alias("width"))


@query("RSH6", S.readiness(KEY) + ", newest AS (SELECT portfolio, max(date) AS date FROM long WHERE rollup_level = 'date_category' GROUP BY portfolio) SELECT portfolio, category AS segment, "
       + ", ".join(f"max(value) FILTER (metric_id = '{m[0]}') AS {m[0]}, coalesce(max(unit) FILTER (metric_id = '{m[0]}'), '') AS {m[0]}_unit" for m in S.READINESS)
       + " FROM long JOIN newest USING (portfolio, date) WHERE rollup_level = 'date_category' AND category IS NOT NULL GROUP BY portfolio, category")
def matrix(spark, folder):
    return sn.segment_matrix(long_of(spark, folder, KEY), "date_category", "category", KEY)
