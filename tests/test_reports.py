"""Insights, serving tables, requirement resolution and report files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kpiloom.operators import findings as fnd
from kpiloom.operators import insights as ins
from kpiloom.operators import metric_checks as mc
from kpiloom.operators import requirements as rq
from kpiloom.operators import serving as sv
from kpiloom.operators import snapshot as sn
from kpiloom.operators.rollups import metric_dictionary
from kpiloom.plans.metrics import published_long
from kpiloom.plans.registry import READINESS_METRICS, ConfigError
from kpiloom.sources import reports as rp
from kpiloom.sources import sinks as sk
from kpiloom.sources.delimited import LoadError

DAY = dt.date(2024, 3, 1)
# Twenty requirements: category, market, status, severity.
NEEDS = (
    [("power", "NAM", "complete", "high")] * 2 + [("power", "EMEA", "closed", "low"), ("power", "NAM", "open", "critical")]
    + [("fiber", "NAM", "complete", "high"), ("fiber", "EMEA", "complete", "low"), ("fiber", "NAM", "in_progress", "medium")]
    + [("permitting", "NAM", "complete", "low"), ("permitting", "NAM", "open", "critical"), ("permitting", "EMEA", "not_started", "high")]
    + [("site_control", "NAM", "complete", "low"), ("site_control", "EMEA", "closed", "high"), ("site_control", "NAM", "open", "critical")]
    + [("commercial", "NAM", "complete", "low"), ("commercial", "NAM", "open", "critical"), ("commercial", "NAM", "open", "high"), ("commercial", "EMEA", "open", "low")]
    + [("capital", "NAM", "complete", "low"), ("capital", "NAM", "open", "high"), ("capital", "NAM", "in_progress", "low")]
)
LONG = "rollup_level string, date date, category string, metric_id string, label string, value double, unit string"


@pytest.fixture(scope="module")
def long(spark):
    needs = spark.createDataFrame([(DAY, *n) for n in NEEDS], "date date, category string, market string, status string, severity string")
    return published_long(needs, READINESS_METRICS, changes=True).cache()


def headline(spark, pct=None, crit=None, gaps=None, categories=()):
    rows = [("date_only", DAY, None, m, m, float(v), "u") for m, v in
            (("readiness_completion_pct", pct), ("critical_item_count", crit), ("open_gap_count", gaps)) if v is not None]
    for name, done, open_gaps in categories:
        rows += [("date_category", DAY, name, "readiness_completion_pct", "c", float(done), "%"), ("date_category", DAY, name, "open_gap_count", "g", float(open_gaps), "gaps")]
    return spark.createDataFrame(rows, LONG)


def test_twenty_requirements(long):
    values = {r.metric_id: r.value for r in ins.sorted_snapshot(long).collect()}
    assert values == {"total_requirement_count": 20.0, "open_gap_count": 10.0, "critical_item_count": 4.0, "readiness_completion_pct": 50.0}
    rows = ins.recommendations(long).orderBy("priority").collect()
    assert [(r.priority, r.rule, r.category) for r in rows] == [
        (1, "critical_blockers", None), (2, "top_gap", "commercial"), (3, "lowest_completion", "commercial"), (4, "hold", None)]
    assert rows[0].recommendation == "Resolve 4 critical blockers before advancing to project gate review."
    assert rows[2].rationale == "commercial has the lowest completion rate (25%)."
    verdict = ins.assessment(long).first()
    assert verdict.posture == "Not RFP-Ready" and verdict.weakness_note == "The most material weakness is Commercial readiness (25% completion)."
    assert verdict.summary == "This readiness snapshot shows 50% completion, with 10 open gaps and 4 critical items unresolved."


@pytest.mark.parametrize("pct, crit, rules, posture", [
    (85, 0, ["prepare"], "RFP-Ready"), (70, 0, ["none_fired"], "Progressing"), (50, 0, ["hold"], "Not RFP-Ready"),
    (85, 1, ["critical_blockers"], "At Risk"), (85, None, ["none_fired"], "RFP-Ready"), (None, 2, ["critical_blockers"], "Not RFP-Ready"),
    (None, 0, ["none_fired"], "Insufficient Data"), (80, 0, ["prepare"], "RFP-Ready"), (60, 0, ["none_fired"], "Progressing"),
])
def test_thresholds(spark, pct, crit, rules, posture):
    long = headline(spark, pct, crit)
    assert [r.rule for r in ins.recommendations(long).orderBy("priority").collect()] == rules
    assert ins.assessment(long).first().posture == posture


def test_singular_unknown_category_and_zero_gaps(spark):
    rows = ins.recommendations(headline(spark, 90, 1, 1, [("cooling", 90, 0)])).orderBy("priority").collect()
    assert [r.rule for r in rows] == ["critical_blockers", "lowest_completion"]
    assert rows[0].recommendation.startswith("Resolve 1 critical blocker before")
    assert rows[1].recommendation == "Focus on the cooling category, which has the lowest readiness completion rate."
    assert ins.assessment(headline(spark, 90, 1, 1)).first().summary.endswith("with 1 open gap and 1 critical item unresolved.")


def test_no_data_at_all(spark):
    empty = spark.createDataFrame([], LONG)
    assert [r.rule for r in ins.recommendations(empty).collect()] == ["no_data"]
    verdict = ins.assessment(empty).first()
    assert (verdict.posture, verdict.summary, verdict.weakness_note) == ("Insufficient Data", "Readiness data is insufficient for assessment.", None)


def test_ties_go_to_the_first_name(spark):
    long = headline(spark, 70, 0, 4, [("b", 50, 2), ("a", 50, 2), ("c", 90, 0)])
    assert ins.top_gap_category(long).first().gap_category == "a" and ins.lowest_completion_category(long).first().weakest_category == "a"


def test_snapshot_takes_last_known_value_per_column(spark):
    old, new = dt.date(2024, 1, 1), dt.date(2024, 2, 1)
    rows = [("date_only", old, "m", "M", 5.0, "u", 10.0), ("date_only", new, "m", "M", 7.0, "u", None)]
    long = spark.createDataFrame(rows, "rollup_level string, date date, metric_id string, label string, value double, unit string, period_change_pct double")
    row = sn.snapshot(long).first()
    assert (row.date, row.value, row.period_change_pct) == (new, 7.0, 10.0)
    sentence = ins.period_insights(long).first()
    assert (sentence.direction, sentence.text) == ("up", "M increased 10% vs prior period")


def test_readiness_snapshot_falls_back(spark):
    other = headline(spark, 50).withColumn("metric_id", F.lit("revenue"))
    assert [r.metric_id for r in ins.readiness_snapshot(other).collect()] == ["revenue"]
    both = other.union(headline(spark, 50))
    assert [r.metric_id for r in ins.readiness_snapshot(both).collect()] == ["readiness_completion_pct"]


def test_serving_tables(spark, long):
    kpis = sv.kpi_export(long, metric_dictionary(spark, READINESS_METRICS)).collect()
    assert [r.metric_id for r in kpis] == sn.READINESS_IDS and all(r.description for r in kpis)
    categories = sv.category_export(long).collect()
    assert [r.category for r in categories][:2] == ["Capital Readiness", "Commercial Model"] and len({r.category for r in categories}) == 6
    board = sv.READINESS_DASHBOARD
    cards = sv.kpi_cards(long, metric_dictionary(spark, READINESS_METRICS), board.sections[0], board).collect()
    assert [(c.label, c.formatted_value, c.is_primary) for c in cards][:2] == [("Readiness Completion", "50.0%", True), ("Scoped Requirements", "20", False)]
    bars = sv.breakdown_table(sv.breakdown_rows(long, "date_market", "market", sv.BREAKDOWN_IDS), "market").collect()
    assert [(b.name, b.completion_pct_formatted, b.bar_width, b.bar_color) for b in bars] == [("EMEA", "60.0%", 60, "#f39c12"), ("NAM", "46.7%", 47, "#e74c3c")]
    with pytest.raises(ConfigError):
        sv.breakdown_rows(long, "date_market", "status", sv.BREAKDOWN_IDS)
    states = {r.section: (r.rendered, r.skipped) for r in sv.section_states(long.filter("rollup_level <> 'date_market'"), board).collect()}
    assert states == {"kpi_cards": (True, False), "category_breakdown": (True, False), "market_breakdown": (False, True)}


def test_store_views(spark, long, tmp_path):
    store = sv.Store(spark, str(tmp_path / "store"))
    one = spark.createDataFrame([("passed", 0, 1)], "status string, error_count bigint, warning_count bigint")
    empty = sv.with_columns(None, spark, "metric_id string, label string, date string, period_change_pct double, direction string, text string")
    store.write({"long_metrics": long, "wide_metrics": long.select("date"), "metric_dictionary": metric_dictionary(spark, READINESS_METRICS),
                 "metrics_validation_summary": one, "report_insights": empty, "report_summary": sn.report_summary(long)})
    assert len(store.register("t_")) == 9
    assert spark.sql("SELECT count(*) AS n FROM t_v_latest_kpis").first().n == 4
    assert spark.table("t_v_report_insights").count() == 0
    with pytest.raises(ConfigError):
        store.write({"other": one})


def test_requirements(spark):
    rows = [
        {"requirement_name": "A", "category": "c", "severity": "high", "intake_field": "asked", "answer_yes_status": "complete", "answer_no_status": "open",
         "answer_partial_status": "in_progress", "default_status": "not_started", "default_notes": "todo", "market_scope": "Global"},
        {"requirement_name": "B", "category": "c", "severity": "low", "intake_field": "", "default_status": "open"},
        {"requirement_name": "C", "category": "c", "severity": "low", "intake_field": "never_asked", "default_status": "open", "answer_yes_status": "complete"},
    ]
    answers = spark.createDataFrame([
        ("P1", "45292", "NAM", "Yes"), ("P2", "2024-05-06", "NAM, EMEA", "no"), (" ", "x", None, "partial"), ("P4", "5/6/2024", "", "n/a"), ("P5", "2024/05/06", "NAM", "Signed"),
    ], "project_id string, assessment_date string, preferred_markets string, asked string")
    got = {(r.project_id, r.requirement_name): r for r in rq.resolve(answers, rq.requirement_map(spark, rows), F.lit("2000-01-01").cast("date")).collect()}
    assert len(got) == 15 and rq.resolve(answers, rq.requirement_map(spark, rows)).columns == rq.RESOLVED_COLUMNS
    assert [(got[p, "A"].status, got[p, "A"].notes, got[p, "A"].market) for p in ("P1", "P2", "", "P4", "P5")] == [
        ("complete", "Yes", "NAM"), ("open", "todo", "Global"), ("in_progress", "partial", "Global"), ("not_started", "todo", "Global"), ("complete", "Signed", "NAM")]
    assert [str(got[p, "B"].date) for p in ("P1", "P2", "", "P4", "P5")] == ["2024-01-01", "2024-05-06", "2000-01-01", "2024-05-06", "2024-05-06"]
    assert (got["P1", "C"].status, got["P1", "C"].notes) == ("open", "") and got["P4", "B"].market == ""
    with pytest.raises(ConfigError, match="row 3"):
        rq.require_complete_map(rq.requirement_map(spark, [rows[0], rows[1] | {"severity": None}]))


def test_client_context(spark):
    row = rq.client_context(spark.createDataFrame([("P1", 0.0, 250.0, dt.date(2027, 12, 31), "45292")],
                            "project_id string, future_expansion_mw double, target_capacity_mw double, target_live_date date, prepared_date string")).first()
    assert len(row) == 29 and row.future_expansion_mw == "" and row.client_name == "" and row.target_capacity_mw == "250.0"
    assert (row.target_live_date, row.prepared_date) == ("2027-12-31", "2024-01-01")


def test_report_files(spark, tmp_path, text_file):
    (tmp_path / "bundle").mkdir()
    folder = tmp_path / "bundle"
    with pytest.raises(LoadError):
        rp.load_bundle(spark, str(folder))
    text_file("validation_report.json", json.dumps({"status": "passed", "errors": [], "warnings": ["w"]}, indent=2), folder)
    text_file("long_metrics.csv", "rollup_level,date,metric_id,label,value,unit\ndate_only,2024-01-01,m,M,1.5,u\n", folder)
    bundle = rp.load_bundle(spark, str(folder))
    assert bundle.long.first().value == 1.5 and bundle.dictionary.count() == 0 and bundle.status.first().warnings == ["w"]
    path = text_file("insights.json", json.dumps({"has_insights": True, "insights": [{"metric_id": "m", "label": "M", "text": "t"}]}, indent=2))
    assert [r.metric_id for r in rp.load_insights(spark, path).collect()] == ["m"]
    assert rp.load_insights(spark, str(tmp_path / "absent.json")).count() == 0
    path = text_file("summary.json", json.dumps({"metric_count": 4, "date_range": {"min": "2024-01-01"}}, indent=2))
    assert tuple(rp.load_summary(spark, path).first()) == ("", 0, 0, "", 4, "2024-01-01", "")


@pytest.mark.parametrize("name", ["SNK6", "SRC6"])
def test_written_status_holds_the_messages(spark, monkeypatch, name):
    written = []
    monkeypatch.setattr(sk, "write_json", lambda df, path, write=sk.write_json: written.append(write(df, path)) or path)
    entry.queries()[name](spark, "/root/testdata/sf0.001").first()
    report = rp.load_status(spark, written[0]).first()
    assert report.status == ("failed" if name == "SNK6" else "passed_with_warnings")
    assert "Null values found in metric input column: 'revenue'" in report.errors or name == "SRC6" and report.errors == []
    assert report.warnings and all("share the same date" in w or "row(s)" in w or "outlier value(s)" in w for w in report.warnings)


def test_report_of_no_findings(spark):
    empty = spark.createDataFrame([], fnd.SCHEMA)
    assert tuple(mc.validation_report(empty).first()) == ("passed", [], [])


def test_fact_files(spark, tmp_path, text_file):
    with pytest.raises(LoadError):
        rp.read_facts(spark, text_file("empty.csv", "a,b\n"))
    with pytest.raises(LoadError):
        rp.read_facts(spark, text_file("x.xlsx", "a"))
    path = sk.write_parquet(spark.range(3), str(tmp_path / "f.parquet"))
    assert rp.read_facts(spark, path).count() == 3


def test_project_ids_and_false_answers(spark):
    rows = [{"requirement_id": "R1", "requirement_name": "n", "category": "c", "severity": "low", "intake_field": "x", "default_status": "open"}]
    answers = spark.createDataFrame([("0", "yes"), (" P ", "no"), ("", None), (None, "a"), ("  ", "b")], "project_id string, x string")
    got = sorted(r.project_id for r in rq.resolve(answers, rq.requirement_map(spark, rows), F.lit("2000-01-01").cast("date")).collect())
    assert got == ["", "0", "P", "UNKNOWN", "UNKNOWN"]
    numbers = spark.createDataFrame([(0, "yes"), (7, "no")], "project_id int, x string")
    assert sorted(r.project_id for r in rq.resolve(numbers, rq.requirement_map(spark, rows)).collect()) == ["7", "UNKNOWN"]
    context = rq.client_context(spark.createDataFrame([(False,), (True,)], "ready_for_cbre boolean"))
    assert sorted(r.ready_for_cbre for r in context.collect()) == ["", "True"]


def test_answers_are_not_shuffled_by_field(spark):
    rows = [{"requirement_id": "R1", "requirement_name": "n", "category": "c", "severity": "low", "intake_field": "x", "default_status": "open"}]
    answers = spark.createDataFrame([("1", "yes", "unasked")], "project_id string, x string, y string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rq.resolve(answers, rq.requirement_map(spark, rows))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan and "unasked" not in plan
