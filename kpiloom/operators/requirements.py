"""Requirement statuses resolved from intake answers, for any number of projects at once.

Answers arrive as one wide row per project, requirements as a map with one row per requirement.
Unpivoted answers join the map on the field name, an ordinary equi-join. Each project also carries one
unnamed answer; requirements that ask for no field, or for one nobody was asked, join on that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.functions.dates import answer_date
from kpiloom.functions.text import number_text
from kpiloom.operators.sets import small_side
from kpiloom.plans.registry import ConfigError

# Columns of the requirement map, of the resolved table and of the client context.
MAP_COLUMNS = [
    "requirement_id", "requirement_name", "category", "severity", "intake_field", "answer_yes_status",
    "answer_no_status", "answer_partial_status", "default_status", "default_notes", "market_scope",
]
RESOLVED_COLUMNS = ["date", "project_id", "category", "market", "requirement_name", "status", "severity", "notes"]
CONTEXT_COLUMNS = [
    "assessment_date", "project_id", "client_name", "project_name", "project_type", "use_case", "primary_use_case",
    "project_stage", "readiness_stage", "target_market", "target_region", "target_capacity_mw",
    "target_rack_density_kw", "target_live_date", "target_decision_date", "initial_critical_it_mw",
    "future_expansion_mw", "buyer_profile", "preferred_markets", "commercial_model", "ready_for_cbre",
    "recommended_next_step", "prepared_for", "prepared_by", "prepared_date", "version", "confidentiality",
    "executive_summary", "key_decision_question",
]
CONTEXT_DATES = {"assessment_date", "target_decision_date", "target_live_date", "prepared_date"}
REQUIRED_MAP_FIELDS = ["requirement_name", "category", "severity", "default_status"]

# Answer words and what they mean; any other text counts as yes.
BLANK_WORDS = ["", "0", "none", "n/a", "na"]
YES_WORDS = ["yes", "y", "true", "complete", "closed", "done", "1"]
NO_WORDS = ["no", "n", "false", "open", "not_started", "not started"]
PARTIAL_WORDS = ["partial", "in progress", "in_progress"]

NO_FIELD = ""


def requirement_map(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """A declared map as a table; ``map_row`` is the sheet row, the header being row 1."""
    values = [(i, *[r.get(c) for c in MAP_COLUMNS]) for i, r in enumerate(rows, start=2)]
    return spark.createDataFrame(values, "map_row int, " + ", ".join(f"{c} string" for c in MAP_COLUMNS))


def map_findings(requirements: DataFrame) -> DataFrame:
    """Map rows that lack a required field: map_row, field, message. Only the first lack of a row counts."""
    lacking = F.filter(
        F.array(*[F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(c)) for c in REQUIRED_MAP_FIELDS]), lambda c: c.isNotNull()
    )
    field = F.try_element_at(lacking, F.lit(1))
    return requirements.select("map_row", field.alias("field")).filter(F.col("field").isNotNull()).withColumn(
        "message", F.concat(F.lit("requirement map row "), F.col("map_row").cast("string"),
                            F.lit(" lacks required field '"), F.col("field"), F.lit("'"))
    )


def require_complete_map(requirements: DataFrame) -> DataFrame:
    first = map_findings(requirements).orderBy("map_row").first()
    if first:
        raise ConfigError(first.message)
    return requirements


def answer_kind(c: Column) -> Column:
    """yes, no, partial or blank."""
    word = F.lower(F.trim(c))
    return (
        F.when(c.isNull() | word.isin(BLANK_WORDS), "blank").when(word.isin(YES_WORDS), "yes").when(word.isin(NO_WORDS), "no")
        .when(word.isin(PARTIAL_WORDS), "partial").otherwise("yes")
    )


def as_answer_text(c: Column, kind: T.DataType) -> Column:
    """A cell as the text a person would see."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        text = number_text(c.cast("double"))
        return F.when(text.contains("."), text).otherwise(F.concat(text, F.lit(".0")))
    if isinstance(kind, T.BooleanType):
        return F.initcap(c.cast("string"))
    return c.cast("string")


def _filled(name: str, fallback: str | None = None) -> Column:
    value = F.nullif(F.col(name), F.lit(""))
    return F.coalesce(value, F.lit(fallback)) if fallback is not None else value


def unpivot_answers(answers: DataFrame, ids: list[str], fields: list[str] | None = None, unnamed: bool = False) -> DataFrame:
    """ids, field, answer — one row per project and answered column, of the given fields only if any are given.

    unnamed: each project also carries one answer of no field, which is null.
    """
    names = [f for f in answers.schema.fields if f.name not in ids and (fields is None or f.name in fields)]
    cells = [F.struct(F.lit(f.name).alias("field"), as_answer_text(F.col(f.name), f.dataType).alias("answer")) for f in names]
    if unnamed:
        cells.append(F.struct(F.lit(NO_FIELD).alias("field"), F.lit(None).cast("string").alias("answer")))
    return answers.select(*ids, F.inline(F.array(*cells)))


def with_answers(answers: DataFrame, ids: list[str], requirements: DataFrame) -> DataFrame:
    """Each requirement of each project with its raw answer: ids, answer and the map's columns; none where nothing is asked.

    Only fields that some requirement asks for are unpivoted. The map is a declared table: it goes to every task, so
    no answer is shuffled; beyond the checked size the join is an ordinary one on the field.
    """
    wanted = F.trim(F.coalesce(F.col("intake_field"), F.lit("")))
    own = [c for c in answers.columns if c not in ids]
    keyed = requirements.withColumn("field", F.when(wanted.isin(own), wanted).otherwise(NO_FIELD))
    asked = [r.field for r in keyed.select("field").distinct().collect()]  # at most one per answer column
    return unpivot_answers(answers, ids, asked, unnamed=True).join(small_side(keyed), "field")


def resolved_status(answer: Column) -> tuple[Column, Column]:
    """Status and notes of one requirement given the raw answer (columns of the map in scope)."""
    default = _filled("default_status", "open")
    notes = _filled("default_notes", "")
    kind = answer_kind(answer)
    asked = F.trim(F.coalesce(F.col("intake_field"), F.lit(""))) != ""
    by_kind = (
        F.when(kind == "yes", _filled("answer_yes_status")).when(kind == "no", _filled("answer_no_status"))
        .when(kind == "partial", _filled("answer_partial_status"))
    )
    return (
        F.when(asked, F.coalesce(by_kind, default)).otherwise(default),
        F.when(asked & kind.isin("yes", "partial"), answer).otherwise(notes),
    )


def client_market(preferred: Column) -> Column:
    """The one market a client named; null when blank or several."""
    return F.when(~preferred.contains(","), F.nullif(F.trim(preferred), F.lit("")))


def project_heads(answers: DataFrame, default_date: Column | None = None) -> DataFrame:
    """Answers with the resolved date, project id and client market beside them."""
    types = {f.name: f.dataType for f in answers.schema.fields}

    def text(name: str) -> Column:
        return as_answer_text(F.col(name), types[name]) if name in types else F.lit(None).cast("string")

    def given(name: str) -> Column:
        """The trimmed text of an answer; none where it is null, the empty text, or a number or boolean equal to zero."""
        if name not in types:
            return F.lit(None).cast("string")
        none = F.col(name) == "" if isinstance(types[name], T.StringType) else F.col(name).cast("double") == 0 if isinstance(types[name], (T.NumericType, T.BooleanType)) else F.lit(False)
        return F.when(~F.coalesce(none, F.lit(True)), F.trim(text(name)))

    return answers.withColumns({
        "head_date": F.coalesce(answer_date(text("assessment_date")), default_date if default_date is not None else F.current_date()),
        "head_project": F.coalesce(given("project_id"), F.lit("UNKNOWN")),
        "head_market": client_market(given("preferred_markets")),
    })


def resolve(answers: DataFrame, requirements: DataFrame, default_date: Column | None = None) -> DataFrame:
    """One row per requirement and project, eight columns."""
    heads = project_heads(answers, default_date)
    status, notes = resolved_status(F.col("answer"))
    market = F.coalesce(F.col("head_market"), _filled("market_scope", ""))
    return with_answers(heads, ["head_date", "head_project", "head_market"], requirements).select(
        F.col("head_date").alias("date"), F.col("head_project").alias("project_id"), F.trim("category").alias("category"),
        F.trim(market).alias("market"), F.trim("requirement_name").alias("requirement_name"),
        F.trim(status).alias("status"), F.trim("severity").alias("severity"), F.trim(notes).alias("notes"),
    )


def client_context(answers: DataFrame) -> DataFrame:
    """29 text columns per project: absent, null, zero and false become '', dates ISO."""
    types = {f.name: f.dataType for f in answers.schema.fields}

    def cell(name: str) -> Column:
        if name not in types:
            return F.lit("")
        text = as_answer_text(F.col(name), types[name])
        empty = text.isNull()
        if isinstance(types[name], (T.NumericType, T.BooleanType)):
            empty = empty | (F.col(name).cast("double") == 0)
        shown = F.coalesce(answer_date(text).cast("string"), text) if name in CONTEXT_DATES else F.trim(text)
        return F.when(empty, "").otherwise(shown)

    return answers.select(*[cell(c).alias(c) for c in CONTEXT_COLUMNS])


def overlay(answers: DataFrame, values: dict) -> DataFrame:
    """Set the given answers for every project; all other columns stay."""
    return answers.withColumns({name: F.lit(value) for name, value in values.items()})
