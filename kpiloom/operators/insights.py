"""Deterministic insights, recommendations and assessments from long metrics.

Everything works per project or portfolio key; with no key there is a single answer. Each rule is a
Column over one row per key, so scoring many keys is one aggregate and one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.numbers import counted, display_value, percent_text, round_even, segment_label
from kpiloom.functions.text import title_text
from kpiloom.operators.rollups import CHANGE_COLUMNS
from kpiloom.operators.snapshot import READINESS_IDS, at_level, segment_matrix, snapshot

# Advice per requirement category.
GAP_ADVICE = {
    "power": "Resolve power interconnection requirements to unblock the grid-connection milestone.",
    "fiber": "Advance fiber routing and backhaul agreements to close fiber gaps.",
    "permitting": "Expedite permit applications and agency approvals to address permitting gaps.",
    "site_control": "Finalize lease or purchase agreements to resolve site control gaps.",
    "commercial": "Complete commercial negotiations and off-take agreements to close commercial gaps.",
    "capital": "Confirm capital commitments and financial close requirements to address capital gaps.",
}
COMPLETION_ADVICE = {
    "power": "Focus on power-related requirements; this category has the lowest completion rate.",
    "fiber": "Prioritize fiber planning and procurement; this category has the lowest completion rate.",
    "permitting": "Accelerate permitting activities; this category has the lowest completion rate.",
    "site_control": "Drive site control negotiations to completion; this category has the lowest completion rate.",
    "commercial": "Advance commercial workstreams; this category has the lowest completion rate.",
    "capital": "Advance capital formation activities; this category has the lowest completion rate.",
}
# Per rule its recommendation and its rationale; braces take figures and names.
RULE_TEXTS = {
    "critical_blockers": ("Resolve {} before advancing to project gate review.", "{} must be closed before milestone progression."),
    "top_gap": ("Address open gaps in the {} category to improve overall readiness.", "{} has the highest open gap count ({})."),
    "lowest_completion": ("Focus on the {} category, which has the lowest readiness completion rate.", "{} has the lowest completion rate ({})."),
    "hold": ("Hold transaction and RFP outreach until overall readiness improves.", "Overall readiness is {}, below the 60% threshold for external engagement."),
    "prepare": ("Prepare market-facing materials and investor outreach packages.", "Overall readiness is {} with no critical blockers."),
    "no_data": ("Review readiness metrics to identify gaps and priorities.", "Readiness data is incomplete or unavailable."),
    "none_fired": ("Review readiness metrics to identify gaps and priorities.", "No specific recommendations apply given the current readiness data."),
}
# Sentences and names of the assessment.
SUMMARY_TEXTS = {
    "completion": "This readiness snapshot shows {} completion{}.",
    "counts": "Current data shows {}.",
    "nothing": "Readiness data is insufficient for assessment.",
    "weakness": "The most material weakness is {} readiness ({} completion).",
}
POSTURES = {"not_ready": "Not RFP-Ready", "at_risk": "At Risk", "unknown": "Insufficient Data", "ready": "RFP-Ready", "progressing": "Progressing"}
OUTREACH = {
    "hold": "Hold transaction and RFP outreach until overall readiness improves.",
    "blocked": "Resolve critical blockers before advancing to external engagement.",
    "ready": "Proceed — prepare market-facing materials and investor outreach packages.",
    "progressing": "Continue gap resolution to advance toward the RFP readiness threshold.",
    "unknown": "Review readiness metrics to determine transaction posture.",
}
# Completion percent below which outreach waits, and from which it may start.
HOLD_BELOW, READY_FROM = 60, 80


def _filled(text: str, *columns: Column) -> Column:
    """The text with the columns in place of its braces; null where one of them is null."""
    first, *rest = text.split("{}")
    return F.concat(F.lit(first), *[part for column, after in zip(columns, rest, strict=True) for part in (column, F.lit(after))])


def sorted_snapshot(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Newest value per metric, by label."""
    keys = keys or []
    return snapshot(long, keys).select(*keys, "metric_id", "label", "date", "value", "unit").orderBy(*keys, "label")


def period_insights(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """A sentence per metric about its change against the prior period; metrics without one are left out."""
    keys = keys or []
    pct = F.col("period_change_pct")
    size = percent_text(F.abs(pct))

    def sentence(verb: str) -> Column:
        return F.concat(F.col("label"), F.lit(f" {verb} "), size, F.lit(" vs prior period"))

    text = (
        F.when(pct > 0, sentence("increased")).when(pct < 0, sentence("decreased"))
        .otherwise(F.concat(F.col("label"), F.lit(" remained flat vs prior period")))
    )
    direction = F.when(pct > 0, "up").when(pct < 0, "down").otherwise("flat")
    return (
        snapshot(long, keys).filter(pct.isNotNull() & ~F.isnan(pct))
        .select(*keys, "metric_id", "label", F.col("date").cast("string").alias("date"),
                round_even(pct, 4).alias("period_change_pct"), direction.alias("direction"), text.alias("text"))
        .orderBy(*keys, "metric_id")
    )


def readiness_snapshot(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Snapshot rows of readiness metrics; a key that has none shows all its metrics.

    The window group holds one row per declared metric.
    """
    keys = keys or []
    mine = F.col("metric_id").isin(READINESS_IDS)
    any_mine = F.max(mine).over(Window.partitionBy(*keys))
    rows = snapshot(long, keys).withColumns({"mine": mine, "any_mine": any_mine})
    return rows.filter(F.col("mine") | ~F.col("any_mine")).select(*keys, "metric_id", "label", "date", "value", "unit")


def _headline(long: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: overall percent, gap and critical counts, and whether any readiness metric exists."""
    def value_of(metric_id: str) -> Column:
        return F.max(F.when(F.col("metric_id") == metric_id, F.col("value")))

    latest = snapshot(long, keys)
    grouped = latest.groupBy(*keys) if keys else latest.groupBy()
    return grouped.agg(
        value_of("readiness_completion_pct").alias("overall_pct"),
        value_of("open_gap_count").cast("bigint").alias("gap_count"),
        value_of("critical_item_count").cast("bigint").alias("crit_count"),
        F.coalesce(F.max(F.col("metric_id").isin(READINESS_IDS)), F.lit(False)).alias("has_readiness"),
    )


def _extremes(long: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the category with most gaps and the one least complete, ties by name."""
    rows = segment_matrix(long, "date_category", "category", keys)
    gaps, pct = F.col("open_gap_count"), F.col("readiness_completion_pct")
    most_gaps = F.min(F.when(gaps.isNotNull(), F.struct((-gaps).alias("key"), F.col("segment").alias("name"))))
    least_done = F.min(F.when(pct.isNotNull(), F.struct(pct.alias("key"), F.col("segment").alias("name"))))
    grouped = rows.groupBy(*keys) if keys else rows.groupBy()
    return grouped.agg(most_gaps.alias("g"), least_done.alias("l")).select(
        *keys, F.col("g.name").alias("gap_category"), (-F.col("g.key")).cast("bigint").alias("gap_category_count"),
        F.col("l.name").alias("weakest_category"), F.col("l.key").alias("weakest_pct"),
    )


def standing(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Headline figures and category extremes, one row per key."""
    keys = keys or []
    headline = _headline(long, keys)
    if keys:
        return headline.join(_extremes(long, keys), keys, "left")
    extremes = _extremes(long, keys)
    whole = extremes.select(F.struct(*extremes.columns)).scalar()
    return headline.withColumn("extremes", whole).select(*headline.columns, "extremes.*")


def top_gap_category(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or []
    return _extremes(long, keys).filter(F.col("gap_category").isNotNull()).select(*keys, "gap_category", "gap_category_count")


def lowest_completion_category(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or []
    return _extremes(long, keys).filter(F.col("weakest_category").isNotNull()).select(*keys, "weakest_category", "weakest_pct")


def _advice(table: dict[str, str], category: Column, fallback: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(category)), fallback)


def _rule(name: str, when: Column, severity: str, recommendation: Column, rationale: Column, category: Column | None = None) -> Column:
    return F.when(when, F.struct(
        F.lit(name).alias("rule"), (category if category is not None else F.lit(None).cast("string")).alias("category"),
        F.lit(severity).alias("severity"), recommendation.alias("recommendation"), rationale.alias("rationale"),
    ))


def _rules() -> list[Column]:
    crit, pct = F.col("crit_count"), F.col("overall_pct")
    gap, low = F.col("gap_category"), F.col("weakest_category")
    advice, why = ({rule: texts[i] for rule, texts in RULE_TEXTS.items()} for i in (0, 1))
    return [
        _rule(
            "critical_blockers", crit > 0, "critical",
            _filled(advice["critical_blockers"], counted(crit, "critical blocker")), _filled(why["critical_blockers"], counted(crit, "critical item")),
        ),
        _rule(
            "top_gap", F.col("gap_category_count") > 0, "high",
            _advice(GAP_ADVICE, gap, _filled(advice["top_gap"], gap)), _filled(why["top_gap"], gap, F.col("gap_category_count").cast("string")), gap,
        ),
        _rule(
            "lowest_completion", low.isNotNull(), "high",
            _advice(COMPLETION_ADVICE, low, _filled(advice["lowest_completion"], low)), _filled(why["lowest_completion"], low, percent_text(F.col("weakest_pct"))), low,
        ),
        _rule("hold", pct < HOLD_BELOW, "medium", F.lit(advice["hold"]), _filled(why["hold"], percent_text(pct))),
        _rule("prepare", (pct >= READY_FROM) & (crit == 0), "low", F.lit(advice["prepare"]), _filled(why["prepare"], percent_text(pct))),
    ]


def recommendations(long: DataFrame, keys: list[str] | None = None, rules: set[str] | None = None) -> DataFrame:
    """Ranked recommendations per key: priority, rule, category, severity, recommendation, rationale.

    Priorities number the rules that fired, in rule order. A key without readiness metrics, or with
    no rule fired, gets one generic row.
    """
    keys = keys or []
    no_data, none_fired = (_rule(name, F.lit(True), "low", *map(F.lit, RULE_TEXTS[name])) for name in ("no_data", "none_fired"))
    fired = F.filter(F.array(*_rules()), lambda r: r.isNotNull())
    chosen = (
        F.when(~F.col("has_readiness"), F.array(no_data)).when(F.size(F.col("fired")) == 0, F.array(none_fired)).otherwise(F.col("fired"))
    )
    rows = standing(long, keys).withColumn("fired", fired).select(*keys, F.posexplode(chosen).alias("place", "row"))
    result = rows.select(*keys, (F.col("place") + 1).alias("priority"), "row.*")
    return result.filter(F.col("rule").isin(sorted(rules))) if rules else result


def assessment(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Posture, summary sentence, weakest category and transaction posture, one row per key."""
    keys = keys or []
    pct, crit, gaps = F.col("overall_pct"), F.col("crit_count"), F.col("gap_count")
    blocked = crit > 0
    posture = (
        F.when(blocked & (pct.isNull() | (pct < HOLD_BELOW)), POSTURES["not_ready"]).when(blocked, POSTURES["at_risk"])
        .when(pct.isNull(), POSTURES["unknown"]).when(pct >= READY_FROM, POSTURES["ready"])
        .when(pct >= HOLD_BELOW, POSTURES["progressing"]).otherwise(POSTURES["not_ready"])
    )
    details = F.concat_ws(" and ", counted(gaps, "open gap"), F.concat(counted(crit, "critical item"), F.lit(" unresolved")))
    also = F.when(details != "", F.concat(F.lit(", with "), details)).otherwise("")
    summary = (
        F.when(pct.isNotNull(), _filled(SUMMARY_TEXTS["completion"], percent_text(pct), also))
        .when(details != "", _filled(SUMMARY_TEXTS["counts"], details)).otherwise(SUMMARY_TEXTS["nothing"])
    )
    weakest = title_text(F.replace(F.col("weakest_category"), F.lit("_"), F.lit(" ")))
    note = _filled(SUMMARY_TEXTS["weakness"], weakest, percent_text(F.col("weakest_pct")))
    outreach = (
        F.when(pct < HOLD_BELOW, OUTREACH["hold"]).when(blocked, OUTREACH["blocked"]).when(pct >= READY_FROM, OUTREACH["ready"])
        .when(pct.isNotNull(), OUTREACH["progressing"]).otherwise(OUTREACH["unknown"])
    )
    return standing(long, keys).select(
        *keys, posture.alias("posture"), summary.alias("summary"),
        F.when(F.col("weakest_pct").isNotNull(), note).alias("weakness_note"), outreach.alias("transaction_posture"),
        "overall_pct", "gap_count", "crit_count", "weakest_category", "weakest_pct",
    )


def category_counts(long: DataFrame, metric_id: str, keys: list[str] | None = None, nonzero: bool = False) -> DataFrame:
    """Open gaps or critical items per category; with ``nonzero`` only categories that have some."""
    keys = keys or []
    rows = segment_matrix(long, "date_category", "category", keys)
    count = F.col(metric_id).cast("bigint")
    rows = rows.filter(count != 0) if nonzero else rows
    return rows.select(*keys, "segment", segment_label(F.col("segment")).alias("label"), count.alias("n"),
                       F.coalesce(count.cast("string"), F.lit("—")).alias("cell"))


def metrics_listing(long: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """date_only rows as display text by date and metric, with the change columns if present."""
    keys = keys or []
    changes = [c for c in CHANGE_COLUMNS if c in long.columns]
    shown = {c: display_value(F.col(c), F.col("unit")) for c in ["value", *changes] if c != "period_change_pct"}
    if "period_change_pct" in changes:
        shown["period_change_pct"] = percent_text(F.col("period_change_pct"))
    rows = at_level(long, "date_only").select(*keys, "date", "metric_id", "label", "value", "unit", *changes)
    return rows.withColumns(shown).orderBy(*keys, "date", "metric_id")
