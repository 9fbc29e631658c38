"""Requirement statuses resolved from intake answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpiloom.catalog.registrar import query
from kpiloom.functions.dates import answer_date
from kpiloom.operators import requirements as rq
from kpiloom.plans import views
from kpiloom.plans.views import REQUIREMENT_ROWS

NO_DATE = "2000-01-01"

_DAY = "(DATE '2021-01-01' + (c_custkey % 900)::INTEGER)"
ANSWERS = f"""answers AS (SELECT c_custkey,
  CASE c_custkey % 6 WHEN 0 THEN (c_custkey % 3000 + 43000)::VARCHAR WHEN 1 THEN {_DAY}::VARCHAR WHEN 2 THEN strftime({_DAY}, '%m/%d/%Y')
    WHEN 3 THEN strftime({_DAY}, '%d/%m/%Y') WHEN 4 THEN strftime({_DAY}, '%Y/%m/%d') ELSE 'soon' END AS assessment_date,
  CASE WHEN c_custkey % 50 = 7 THEN '' ELSE ' P' || c_custkey || ' ' END AS project_id, c_name AS client_name,
  CASE c_custkey % 5 WHEN 0 THEN 'NAM' WHEN 1 THEN 'NAM, EMEA' WHEN 2 THEN ' ' WHEN 3 THEN NULL ELSE ' APAC ' END AS preferred_markets,
  CASE c_custkey % 8 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' WHEN 2 THEN 'In Progress' WHEN 3 THEN 'N/A' WHEN 4 THEN 'Board approved' WHEN 5 THEN '0'
    WHEN 6 THEN NULL ELSE 'Closed' END AS decision_makers_identified,
  CASE WHEN c_custkey % 9 = 0 THEN 0.0::DOUBLE ELSE c_acctbal END AS initial_critical_it_mw, c_custkey % 4 = 0 AS power_secured,
  {_DAY} AS target_live_date, c_mktsegment AS use_case FROM customer)"""
_PARSE = ("CASE WHEN regexp_full_match({0}, '[0-9]+') THEN DATE '1899-12-30' + {0}::INTEGER "
          "ELSE try_strptime({0}, ['%Y-%m-%d', '%m/%d/%Y', '%d/%m/%Y', '%Y/%m/%d'])::DATE END")
PARSED = _PARSE.format("assessment_date")


def kind_sql(c: str) -> str:
    word = f"lower(trim({c}))"
    return (f"CASE WHEN {c} IS NULL OR {word} IN ('', '0', 'none', 'n/a', 'na') THEN 'blank' WHEN {word} IN ('yes', 'y', 'true', 'complete', 'closed', 'done', '1') THEN 'yes' "
            f"WHEN {word} IN ('no', 'n', 'false', 'open', 'not_started', 'not started') THEN 'no' WHEN {word} IN ('partial', 'in progress', 'in_progress') THEN 'partial' ELSE 'yes' END")


def _value(row: dict, name: str) -> str:
    return "NULL" if row.get(name) is None else f"'{row[name]}'"


MAP = "map(" + ", ".join(rq.MAP_COLUMNS) + ") AS (VALUES " + ", ".join(
    "(" + ", ".join(_value(r, c) for c in rq.MAP_COLUMNS) + ")" for r in REQUIREMENT_ROWS) + ")"
_ANSWER = """CASE trim(intake_field) WHEN 'decision_makers_identified' THEN decision_makers_identified
  WHEN 'initial_critical_it_mw' THEN initial_critical_it_mw::VARCHAR WHEN 'power_secured' THEN CASE WHEN power_secured THEN 'True' ELSE 'False' END
  WHEN 'use_case' THEN use_case END"""
_RESOLVED = f"""WITH {ANSWERS}, {MAP}, paired AS (SELECT *, {_ANSWER} AS answer FROM answers, map), kinds AS (SELECT *, {kind_sql("answer")} AS kind FROM paired),
resolved AS (SELECT coalesce({PARSED}, DATE '{NO_DATE}') AS date, CASE WHEN trim(project_id) = '' THEN 'UNKNOWN' ELSE trim(project_id) END AS project_id,
  trim(category) AS category, trim(coalesce(CASE WHEN preferred_markets NOT LIKE '%,%' THEN nullif(trim(preferred_markets), '') END, market_scope, '')) AS market,
  trim(requirement_name) AS requirement_name,
  coalesce(CASE WHEN trim(coalesce(intake_field, '')) <> '' THEN nullif(CASE kind WHEN 'yes' THEN answer_yes_status WHEN 'no' THEN answer_no_status WHEN 'partial' THEN answer_partial_status END, '') END, default_status) AS status,
  trim(severity) AS severity,
  trim(CASE WHEN trim(coalesce(intake_field, '')) <> '' AND kind IN ('yes', 'partial') THEN answer ELSE coalesce(default_notes, '') END) AS notes FROM kinds)"""


def resolved(spark, folder):
    requirements = rq.require_complete_map(rq.requirement_map(spark, REQUIREMENT_ROWS))
    return rq.resolve(views.answers(spark, folder), requirements, F.lit(NO_DATE).cast("date"))


@query("REQ1", f"WITH {ANSWERS} SELECT client_name, decision_makers_identified AS answer, {kind_sql('decision_makers_identified')} AS kind FROM answers")
def answers_normalized(spark, folder):
    return views.answers(spark, folder).select(
        "client_name", F.col("decision_makers_identified").alias("answer"), rq.answer_kind(F.col("decision_makers_identified")).alias("kind"))


@query("REQ2", _RESOLVED + " SELECT requirement_name, status, notes, count(*) AS n FROM resolved GROUP BY ALL")
def statuses_resolved(spark, folder):
    return resolved(spark, folder).groupBy("requirement_name", "status", "notes").agg(F.count(F.lit(1)).alias("n"))


@query("REQ3", f"WITH {ANSWERS} SELECT client_name, assessment_date, {PARSED} AS date FROM answers")
def dates_read(spark, folder):
    return views.answers(spark, folder).select("client_name", "assessment_date", answer_date(F.col("assessment_date")).alias("date"))


@query("REQ4", _RESOLVED + " SELECT requirement_name, market, count(*) AS n FROM resolved GROUP BY ALL")
def markets(spark, folder):
    return resolved(spark, folder).groupBy("requirement_name", "market").agg(F.count(F.lit(1)).alias("n"))


@query("REQ5", _RESOLVED + " SELECT project_id, count(*) AS n FROM resolved GROUP BY ALL")
def projects(spark, folder):
    return resolved(spark, folder).groupBy("project_id").agg(F.count(F.lit(1)).alias("n"))


@query("REQ6", _RESOLVED + " SELECT * FROM resolved")
def resolved_table(spark, folder):
    return resolved(spark, folder)


@query("JN5", f"WITH {ANSWERS}, {MAP} SELECT requirement_id, client_name, {_ANSWER} AS answer FROM answers, map")
def map_joined(spark, folder):
    """Each requirement of each client with its raw answer; unasked fields have none."""
    requirements = rq.requirement_map(spark, REQUIREMENT_ROWS)
    return rq.with_answers(views.answers(spark, folder), ["client_name"], requirements).select("requirement_id", "client_name", "answer")


@query("RSH7", f"""WITH {ANSWERS} SELECT client_name, field, answer FROM (SELECT client_name, unnest(['assessment_date', 'project_id', 'preferred_markets', 'decision_makers_identified',
  'initial_critical_it_mw', 'power_secured', 'target_live_date', 'use_case']) AS field, unnest([assessment_date, project_id, preferred_markets, decision_makers_identified,
  initial_critical_it_mw::VARCHAR, CASE WHEN power_secured THEN 'True' ELSE 'False' END, target_live_date::VARCHAR, use_case]) AS answer FROM answers)""")
def answers_unpivoted(spark, folder):
    return rq.unpivot_answers(views.answers(spark, folder), ["client_name"])


@query("REQ7", """WITH m AS (SELECT p_partkey::INTEGER AS map_row, CASE WHEN p_size > 3 THEN p_name END AS requirement_name, CASE WHEN p_size = 7 THEN '' ELSE p_type END AS category,
  CASE WHEN p_size <> 9 THEN p_brand END AS severity, CASE WHEN p_size > 2 THEN 'open' END AS default_status FROM part),
f AS (SELECT map_row, CASE WHEN coalesce(requirement_name, '') = '' THEN 'requirement_name' WHEN coalesce(category, '') = '' THEN 'category' WHEN coalesce(severity, '') = '' THEN 'severity'
  WHEN coalesce(default_status, '') = '' THEN 'default_status' END AS field FROM m)
SELECT map_row, field, 'requirement map row ' || map_row || ' lacks required field ''' || field || '''' AS message FROM f WHERE field IS NOT NULL""")
def map_checked(spark, folder):
    size = F.col("p_size")
    requirements = views.table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("map_row"), F.when(size > 3, F.col("p_name")).alias("requirement_name"),
        F.when(size == 7, "").otherwise(F.col("p_type")).alias("category"), F.when(size != 9, F.col("p_brand")).alias("severity"),
        F.when(size > 2, "open").alias("default_status"),
    )
    return rq.map_findings(requirements)


_FILLED = {
    "assessment_date": f"coalesce({PARSED}::VARCHAR, assessment_date)", "project_id": "trim(project_id)", "client_name": "client_name",
    "preferred_markets": "coalesce(trim(preferred_markets), '')", "use_case": "use_case", "target_live_date": "target_live_date::VARCHAR",
    "initial_critical_it_mw": "CASE WHEN initial_critical_it_mw = 0 THEN '' ELSE initial_critical_it_mw::VARCHAR END",
}


@query("REQ8", f"WITH {ANSWERS} SELECT " + ", ".join(f"{_FILLED.get(c, repr(''))} AS {c}" for c in rq.CONTEXT_COLUMNS) + " FROM answers")
def context(spark, folder):
    return rq.client_context(views.answers(spark, folder))


@query("REQ9", f"WITH {ANSWERS} SELECT client_name, assessment_date, decision_makers_identified, 'Midwest' AS preferred_markets, 'v0.1' AS version, 250 AS target_capacity_mw FROM answers")
def overlaid(spark, folder):
    merged = rq.overlay(views.answers(spark, folder), {"preferred_markets": "Midwest", "version": "v0.1", "target_capacity_mw": 250})
    return merged.select("client_name", "assessment_date", "decision_makers_identified", "preferred_markets", "version", "target_capacity_mw")
