"""Roll-ups, prior periods, checks, ranks and quantiles against hand-computed and brute-force values."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.functions.numbers import ratio_in_cents
from kpiloom.operators import metric_checks as mc
from kpiloom.operators import ordering, rollups, sets
from kpiloom.operators.periods import with_prior_period
from kpiloom.operators.schema import Normalized, normalize
from kpiloom.plans import sales as sa
from kpiloom.plans.metrics import metric_tables, published_long
from kpiloom.plans.registry import (
    ConfigError, MARKET_METRICS, MARKET_SCHEMA, READINESS_METRICS, READINESS_SCHEMA, fact_schema, intake_config, metric, registry,
)

JAN, FEB = dt.date(2024, 1, 1), dt.date(2024, 2, 1)

# Capacity and leased figures of four site-months; revenue and contracted power scale with them.
FACTS = [
    (JAN, "EMEA", "P1", 1000.0, 100.0, 80.0, 5000.0), (JAN, "NAM", "P2", 500.0, 50.0, 40.0, 2500.0),
    (FEB, "EMEA", "P1", 1200.0, 100.0, 90.0, 5000.0), (FEB, None, "P2", 800.0, 50.0, 45.0, 2500.0),
]
FACT_SCHEMA = "date date, region string, provider string, revenue double, capacity_mw double, leased_mw double, contracted_kw double"
NEEDS = [
    ("power", "NAM", "complete", "high"), ("power", "NAM", "closed", "low"), ("power", "EMEA", "open", "critical"),
    ("fiber", "NAM", "not_started", "critical"), ("fiber", None, "complete", "low"), (None, "EMEA", "in_progress", "medium"),
]


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(FACTS, FACT_SCHEMA)


@pytest.fixture
def needs(spark):
    return spark.createDataFrame([(JAN, *n) for n in NEEDS], "date date, category string, market string, status string, severity string")


def table(long, *columns):
    return {tuple(r[c] for c in columns): r["value"] for r in long.collect()}


def test_market_metrics(facts):
    got = table(published_long(facts, MARKET_METRICS), "rollup_level", "date", "region", "provider", "metric_id")
    assert got["date_only", JAN, None, None, "total_revenue"] == 1500.0
    assert got["date_only", JAN, None, None, "utilization_pct"] == 80.0
    assert got["date_only", JAN, None, None, "avg_price_per_kw"] == 0.2
    assert got["date_region", FEB, "EMEA", None, "utilization_pct"] == 90.0
    assert ("date_region", FEB, None, None, "total_revenue") not in got  # unknown region leaves region roll-ups only
    assert got["date_only", FEB, None, None, "total_revenue"] == 2000.0
    assert got["date_provider", FEB, None, "P2", "total_revenue"] == 800.0
    assert len(got) == 6 * (2 + 3 + 4 + 3)


def test_readiness_metrics(needs):
    got = table(published_long(needs, READINESS_METRICS), "rollup_level", "category", "market", "metric_id")
    assert [got["date_only", None, None, m] for m in READINESS_METRICS.ids] == [6.0, 3.0, 2.0, 50.0]
    assert got["date_category", "power", None, "readiness_completion_pct"] == 66.7
    assert got["date_category", "fiber", None, "open_gap_count"] == 1.0
    assert got["date_market", None, "EMEA", "total_requirement_count"] == 2.0
    assert ("date_category", None, None, "open_gap_count") not in got


def test_missing_segment_skips_its_rollups(needs):
    levels = {r.rollup_level for r in published_long(needs.drop("market"), READINESS_METRICS).collect()}
    assert levels == {"date_only", "date_category"}


def test_all_null_sum_is_zero_and_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(JAN, None, 0.0, 5.0, None)], "date date, revenue double, capacity_mw double, leased_mw double, contracted_kw double")
    got = table(published_long(df, MARKET_METRICS), "metric_id")
    assert got[("total_revenue",)] == 0.0 and got[("utilization_pct",)] is None


def test_all_faults_of_a_metric_are_named():
    with pytest.raises(ConfigError) as error:
        metric({"id": "m", "label": "M", "type": "sum", "unit": "u", "decimals": 0, "numerator": "a", "complete_values": []})
    for fault in ("lacks description", "lacks source_col", "must not set numerator", "complete_values"):
        assert fault in str(error.value)
    with pytest.raises(ConfigError, match="none of"):
        metric({"id": "m", "label": "M", "type": "mean", "unit": "u", "decimals": 0, "description": ""})


def test_missing_input_is_refused(facts):
    with pytest.raises(ConfigError):
        published_long(facts.drop("revenue"), MARKET_METRICS)


def test_keys_do_not_mix(facts):
    both = facts.withColumn("client", F.lit("a")).union(facts.withColumn("client", F.lit("b")))
    got = table(published_long(both, MARKET_METRICS, ["client"]), "client", "rollup_level", "date", "region", "provider", "metric_id")
    assert got["a", "date_only", JAN, None, None, "total_revenue"] == got["b", "date_only", JAN, None, None, "total_revenue"] == 1500.0
    with pytest.raises(ConfigError):
        published_long(facts, MARKET_METRICS, ["provider"]).count()


def test_wide_keeps_null_segments_and_dictionary(facts):
    tables = metric_tables(facts, MARKET_METRICS, changes=True)
    assert tables.wide.columns == ["rollup_level", "date", "provider", "region", *MARKET_METRICS.ids]
    assert tables.wide.count() == 12 and tables.wide.filter("rollup_level = 'date_only'").count() == 2
    assert [r.id for r in tables.dictionary.collect()] == MARKET_METRICS.ids
    assert tables.long.columns[-3:] == rollups.CHANGE_COLUMNS


def test_change_against_prior_period(facts):
    long = published_long(facts, MARKET_METRICS, changes=True).filter("rollup_level = 'date_only' and metric_id = 'total_revenue'")
    first, second = long.orderBy("date").collect()
    assert (first.prior_period_value, first.period_change, first.period_change_pct) == (None, None, None)
    assert (second.prior_period_value, second.period_change, second.period_change_pct) == (1500.0, 500.0, 33.33)


def test_zero_prior_gives_no_percent_and_null_segments_group(spark):
    rows = [("date_only", JAN, None, "m", "M", 0.0, "u"), ("date_only", FEB, None, "m", "M", 5.0, "u"), ("date_region", FEB, "x", "m", "M", 7.0, "u")]
    long = spark.createDataFrame(rows, "rollup_level string, date date, region string, metric_id string, label string, value double, unit string")
    got = {(r.rollup_level, r.date): (r.prior_period_value, r.period_change, r.period_change_pct) for r in with_prior_period(long).collect()}
    assert got == {("date_only", JAN): (None, None, None), ("date_only", FEB): (0.0, 5.0, None), ("date_region", FEB): (None, None, None)}


@pytest.mark.parametrize("change", [
    {"type": "median"}, {"source_col": None}, {"numerator": "x"}, {"unit": None},
])
def test_bad_metrics_are_refused(change):
    good = {"id": "m", "label": "M", "type": "sum", "unit": "u", "decimals": 0, "description": "d", "source_col": "c"}
    bad = {k: v for k, v in (good | change).items() if v is not None}
    with pytest.raises(ConfigError):
        registry({"segment_rollups": [[]], "metrics": [bad]})
    assert registry({"segment_rollups": [[]], "metrics": [good]}).ids == ["m"]


@pytest.mark.parametrize("declared", [
    {"metrics": []}, {"segment_rollups": [[]], "metrics": []}, {"segment_rollups": ["region"], "metrics": [1]}, {"segment_rollups": [[1]], "metrics": [1]},
])
def test_bad_registries_are_refused(declared):
    with pytest.raises(ConfigError):
        registry(declared)


def test_duplicate_ids_and_empty_lists_are_refused():
    m = {"id": "m", "label": "M", "type": "conditional_count", "unit": "u", "decimals": 0, "description": "d", "source_col": "c", "condition_values": ["x"]}
    for metrics in ([m, m], [m | {"condition_values": []}], [m | {"condition_values": "x"}]):
        with pytest.raises(ConfigError):
            registry({"segment_rollups": [[]], "metrics": metrics})


def test_schema_aliases(spark):
    raw = spark.createDataFrame([("1/2/2024", "1500", 10.0, 8.0, 100.0, "EMEA", "z")], "Period string, REV string, `cap mw` double, leasedmw double, `kw-contracted` double, geo string, extra string")
    done = normalize(raw, MARKET_SCHEMA)
    assert done.dropped == ["extra"] and done.missing_segments == ["provider"]
    assert tuple(done.facts.select("date", "revenue", "region").first()) == (dt.date(2024, 1, 2), 1500.0, "EMEA")
    with pytest.raises(ConfigError):
        normalize(raw.withColumnRenamed("extra", "region"), MARKET_SCHEMA)
    with pytest.raises(ConfigError):
        normalize(raw.drop("REV"), MARKET_SCHEMA)
    with pytest.raises(ConfigError):
        normalize(raw.withColumn("REV", F.lit("abc")), MARKET_SCHEMA)
    with pytest.raises(ConfigError):
        normalize(raw.select(F.col("Period")), READINESS_SCHEMA)


def checks(facts, **lists):
    return {(r.check, r.column): r.n for r in mc.metric_findings(Normalized(facts, **lists), MARKET_METRICS).collect()}


def test_metric_checks(spark, facts):
    clean = facts.limit(1)
    assert checks(clean) == {}
    assert mc.validation_summary(mc.metric_findings(Normalized(clean), MARKET_METRICS)).first().status == "passed"
    found = checks(facts.union(facts.limit(1)), dropped=["x"], missing_segments=["region"])
    assert found[("duplicate_rows", None)] == 1 and found[("shared_key", "date_only")] == 3 and found[("shared_key", "date_region_provider")] == 1
    assert ("dropped_column", "x") in found and ("missing_segment", "region") in found
    broken = facts.withColumns({"leased_mw": F.col("capacity_mw") + 1, "revenue": -F.col("revenue"), "contracted_kw": F.lit(0.0)})
    found = checks(broken)
    assert found[("leased_over_capacity", "leased_mw")] == 4 and found[("negative_revenue", "revenue")] == 4 and found[("zero_denominator", "contracted_kw")] == 4
    holed = facts.withColumns({"contracted_kw": F.when(F.col("revenue") > 900, 0.0), "date": F.lit(None).cast("date")})
    found = checks(holed)
    assert ("null_input", "contracted_kw") in found and ("null_date", "date") in found and ("zero_denominator", "contracted_kw") not in found
    with pytest.raises(mc.ValidationFailed):
        mc.stop_if_failed(mc.value_findings(holed, MARKET_METRICS))


def test_outlier_needs_four_values_and_a_spread(spark):
    def outliers(values):
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        return [(r.n, r.low, r.high) for r in ordering.iqr_outliers(df, ["x"]).collect()]

    assert outliers([1, 2, 100]) == [] and outliers([5, 5, 5, 5, 90]) == []
    assert outliers([1, 2, 3, 4, 100]) == [(1, -1.0, 7.0)]


def test_quartiles_against_numpy_with_a_hot_value(spark):
    rng = random.Random(7)
    values = [round(rng.lognormvariate(3, 2), 2) if i % 3 else 10.0 for i in range(20000)]  # a third of all rows share one value
    df = spark.createDataFrame([(v, -v if i % 5 else None) for i, v in enumerate(values)], "x double, y double")
    got = ordering.quartiles(df.union(spark.createDataFrame([(float("nan"), None)] * 9, df.schema)), ["x", "y"])
    other = [-v for i, v in enumerate(values) if i % 5]
    for column, series in (("x", values), ("y", other)):
        total, q1, q3 = got[column]
        assert total == len(series)
        assert math.isclose(q1, np.quantile(series, 0.25), rel_tol=1e-12) and math.isclose(q3, np.quantile(series, 0.75), rel_tol=1e-12)


def test_images_keep_the_order_of_doubles(spark):
    inf = float("inf")
    values = [-inf, -1.7e308, -2.5, -1.0, -2.3e-308, -5e-324, 0.0, 5e-324, 1e-310, 0.1, 1.0, 1.0000000000000002, 3.5, 1.7e308, inf]
    df = spark.createDataFrame([(v, -0.0) for v in values] + [(float("nan"), None)], "`a b` double, y double")
    got = sorted(r.i0 for r in ordering.value_images(df, ["a b", "y"]).collect() if r.i0 is not None)
    assert got == [ordering.image_of(v) for v in values] and [ordering.value_of(i) for i in got] == values
    found = ordering.quartiles(df, ["a b", "y"])
    assert found["a b"] == (15, (values[3] + values[4]) / 2, (values[10] + values[11]) / 2)
    assert found["y"] == (15, 0.0, 0.0) and ordering.quartiles(df.limit(0), ["y"]) == {}
    endless = spark.createDataFrame([(v,) for v in (-inf, -inf, 1.0, 2.0, 3.0, inf, inf, inf)], "x double")
    assert ordering.iqr_outliers(endless, ["x"]).collect() == []


def test_one_value_and_ties_at_a_quartile(spark):
    for values in ([4.0], [1.0, 2.0], [1.0, 1.0, 1.0, 9.0], [-3.0, -2.0, -2.0, 7.0, 7.0, 8.0]):
        n, q1, q3 = ordering.quartiles(spark.createDataFrame([(v,) for v in values], "x double"), ["x"])["x"]
        assert n == len(values) and (q1, q3) == (np.quantile(values, 0.25), np.quantile(values, 0.75))


def test_rank_against_brute_force(spark):
    rng = random.Random(3)
    values = [rng.randint(0, 3000) if i % 3 else 500 for i in range(9000)]
    values += [None] * 70
    df = spark.createDataFrame(list(enumerate(values)), "k int, v int")
    ranked = sorted(values, key=lambda v: -10**9 if v is None else -v)
    first = {}
    for place, v in enumerate(ranked, start=1):
        first.setdefault(v, place)
    got = ordering.with_rank_descending(df, "v", "place").collect()
    assert len(got) == len(values) and all(r.place == first[r.v] for r in got)


def test_sets(spark):
    df = spark.createDataFrame([(1, "b", 5), (1, "b", 5), (1, "a", 9), (2, None, 1)], "k int, v string, n int")
    assert sets.duplicate_rows(df).first().n == 1
    assert sorted(tuple(r) for r in sets.one_per_key(df, ["k"]).collect()) == [(1, "a", 9), (2, None, 1)]
    assert [tuple(r) for r in sets.one_per_key(df, ["k"], ["n"]).filter("k = 1").collect()] == [(1, "b", 5)]
    target = spark.createDataFrame([(2, "z", 0)], df.schema)
    assert [r.k for r in sets.insert_ignore(df, target, ["k"]).collect()] == [1]
    assert [(r.k, r.n) for r in sets.repeated_keys(df, ["k"]).collect()] == [(1, 3)]
    assert sorted(r.k for r in sets.orphans(df, "k", target, "k").collect()) == [1, 1, 1]
    lone = spark.createDataFrame([(None, "x", 1), (7, None, 2), (7, None, 2), (2, "y", 3)], df.schema)
    assert [tuple(r) for r in sets.orphans(lone, "k", target, "k").collect()] == [(7, None, 2)] * 2
    assert sets.orphans(lone, "k", target.limit(0), "k").count() == 3 and sets.orphans(lone.limit(0), "k", target, "k").count() == 0
    order = spark.createDataFrame([("x", 3), ("x", 1), ("y", 2)], "v string, row int")
    assert sorted(tuple(r) for r in sets.first_occurrences(order, "row").collect()) == [("x", 1), ("y", 2)]


def test_sales_buckets(spark):
    rows = [(i, JAN, 1, 1, s, d, p) for i, (s, d, p) in enumerate([("10", "0", "5"), ("20", "0.2", "1"), ("30", "0.4", "-3"), ("40", "0.41", "-9.005")])]
    orders = spark.createDataFrame(rows, "order_id int, order_date date, customer_id int, product_id int, sales string, discount string, profit string")
    orders = sa.typed_orders(orders.withColumns({"order_date": F.date_format("order_date", "MM/dd/yyyy"), "quantity": F.lit("3")}))
    got = {r.discount_bucket: (r.order_count, r.avg_profit) for r in sa.discount_impact(orders).collect()}
    assert got == {"No Discount": (1, 5.0), "Low Discount": (1, 1.0), "Medium Discount": (1, -3.0), "High Discount": (1, -9.01)}
    totals = sa.revenue_totals(orders).first()
    assert (totals.total_revenue, totals.total_profit, totals.profit_margin_pct) == (100.0, -6.01, -6.01)
    assert sa.revenue_totals(orders.filter("sales < 0")).first().profit_margin_pct is None
    assert [tuple(r) for r in sa.repeat_customers(orders).collect()] == [("Repeat Customer", 1)]


def test_not_a_number_is_a_missing_value(spark):
    raw = spark.createDataFrame([(JAN, "a", 1.0), (JAN, "a", float("nan")), (JAN, "b", 2.0)], "date date, region string, revenue double")
    schema = fact_schema({"base_columns": [{"name": "date", "type": "date"}, {"name": "revenue", "type": "float"}], "segment_columns": [{"name": "region"}]})
    declared = registry({"segment_rollups": [[]], "metrics": [{"id": "total", "label": "T", "type": "sum", "unit": "USD", "decimals": 0, "description": "", "source_col": "revenue"}]})
    facts = normalize(raw, schema).facts
    assert facts.where("revenue IS NULL").count() == 1
    assert rollups.long_metrics(facts, declared).first().value == 3.0
    assert [r.n for r in mc.value_findings(facts, declared).where("column = 'revenue'").collect()] == [1]


def test_year_first_dates(spark):
    schema = fact_schema({"base_columns": [{"name": "date", "type": "date"}]})
    facts = normalize(spark.createDataFrame([("2024/03/05",), ("2024-03-06",)], "date string"), schema).facts
    assert sorted(r.date for r in facts.collect()) == [dt.date(2024, 3, 5), dt.date(2024, 3, 6)]


def test_rollups_over_the_same_segments_keep_their_labels(spark):
    facts = spark.createDataFrame([(JAN, "x", "y", 1.0), (JAN, "x", "z", 2.0)], "date date, a string, b string, v double")
    metric = {"id": "total", "label": "T", "type": "sum", "unit": "USD", "decimals": 0, "description": "", "source_col": "v"}
    declared = registry({"segment_rollups": [["a", "b"], ["b", "a"], []], "metrics": [metric]})
    got = {(r.rollup_level, r.b): r.value for r in rollups.long_metrics(facts, declared).collect()}
    assert got == {("date_a_b", "y"): 1.0, ("date_a_b", "z"): 2.0, ("date_b_a", "y"): 1.0, ("date_b_a", "z"): 2.0, ("date_only", None): 3.0}
    assert {r.rollup_level: r.n for r in mc.shared_keys(facts, declared).collect()} == {"date_a_b": 0, "date_b_a": 0, "date_only": 1}
    none = registry({"segment_rollups": [["q"]], "metrics": [metric]})
    assert rollups.long_metrics(facts, none).collect() == [] and mc.shared_keys(facts, none).collect() == []


def test_quotients_are_rounded_once(spark):
    rows = spark.createDataFrame([("1", "3"), ("1993006.65", "10"), ("-0.01", "2"), ("0.0049999996", "1"), ("5", "0"), (None, "1"), ("99999999999999999.99", "3")], "a string, b string")
    got = [r[0] for r in rows.select(ratio_in_cents(F.col("a").cast("decimal(28,2)"), F.col("b").cast("decimal(20,2)"), 2)).collect()]
    assert got == [0.33, 199300.67, -0.01, 0.0, None, None, 33333333333333333.33]


def test_configuration_of_a_command_line_is_accepted():
    config = intake_config({"db_mode": "append", "output_dir": "x", "run_validate": True, "run_profile": True, "sheet": None, "columns": {"a": {"rename": "b"}}})
    assert config.table_mode == "append" and config.columns["a"].rename == "b"
    with pytest.raises(ConfigError):
        intake_config({"no_such_key": 1})
