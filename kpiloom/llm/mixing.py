"""Mixing sources to target weights by entropy balancing.

Each source has a target number of words. Among all rates 0 <= r <= 2 whose words sum up to the target, the one
closest to 1 in relative entropy is r = min(2, exp(lambda * size)), one multiplier per source. The dual is convex
in lambda; safeguarded Newton steps solve it for all sources at once, each step one join and one aggregate over
(source, size, documents), which is far smaller than the documents.

Rates become copies by one threshold per source: a document's copies are floor(r + u + shift), u a digest of the
document in [0, 1). The words taken only grow with the shift, by one document at a time, so the shift at which they
meet the target is a weighted quantile; histograms of the steps, refined until a bin is a single document, find it.
Several u are tried and the closest kept. No sort and no window over documents is needed.

Defined results: null sources are a source of their own, last in order; texts without words have size 0, rate 1
and one copy that adds nothing; a target of twice the source takes every document twice. Rows equal in id and
size share their copies. An empty table gives an empty result. Columns of the caller may have any names; one named like an
added column gives way to it. A source whose multiplier can't be settled is an error, never a mix off its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.session import materialized

WEIGHTS = (5, 2, 1)
SHARE = 1.5
#: No document is taken more often than this.
MOST = 2
NEWTON_STEPS = 30
#: Halvings of the bracket for sources that Newton steps leave unsettled; so many exhaust the precision of a double.
HALVINGS = 66
TOLERANCE = 1e-9
STEPS_PER_JOB = 3
#: The bracket of the multipliers; at HIGH a document of one word is at its cap, at LOW none is left.
LOW, HIGH = -60.0, 0.7
TRIALS = 4
#: Columns that mixed() adds.
ADDED = ("source_size", "target", "rate", "copies")
#: Steps are whole numbers below 2^43; histograms narrow them down to these shifts in turn.
RANGE_BITS, SHIFTS = 43, (33, 22, 11, 0)


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.regexp_count(spaced, F.lit("[^ ]+")).cast("long")


def targets(sizes: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source its size and target, from one row (source, source_size) each.

    Weights repeat along the sources in code-point order, null last. A target stops at `most` times the source;
    what is above is shared anew by weight. The end of that is target = min(cap, weight * level): sources are full
    in order of cap / weight, so the level follows from running sums over one row per source.
    """
    everything, by_name = Window.partitionBy(), Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * float(most)).alias("cap"),
        (F.sum("source_size").over(everything) * share).alias("wanted"),
    ).withColumn("full_at", F.col("cap") / F.col("weight"))
    fills = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    earlier, later = fills.rowsBetween(Window.unboundedPreceding, -1), fills.rowsBetween(0, Window.unboundedFollowing)
    levels = ranked.withColumn("level", (F.col("wanted") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) / F.sum("weight").over(later))
    # the first source in that order that its level does not fill settles the level of all that follow
    settled = levels.withColumn("at", F.row_number().over(fills)).withColumn(
        "final", F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("at", "level"))).over(everything)["level"])
    return settled.select("source", "source_size", F.least("cap", F.coalesce(F.col("final") * F.col("weight"), F.col("cap"))).alias("target"))


def rate(size: Column, multiplier: Column, most: int = MOST) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.least(F.lit(700.0), multiplier * size)))


def source_key(source: Column) -> Column:
    """The source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit(""))


def multipliers(counts: DataFrame, wanted: DataFrame, most: int = MOST) -> DataFrame:
    """Per source the multiplier at which the rates take its target.

    counts: (key, size, documents), the sizes above 0; wanted: (key, source_size, target). Sizes are 1 or more, so
    every rate is at its cap at ln(most) and next to none is left at LOW.
    """
    full = (F.col("target") >= F.col("source_size") * most * (1 - 1e-12)) | (F.col("source_size") <= 0)
    state = materialized(wanted.select(
        "key", "target", F.when(full, F.lit(HIGH)).otherwise(F.lit(0.0)).alias("multiplier"),
        F.lit(LOW).alias("low"), F.lit(HIGH).alias("high"), full.alias("done")), "multipliers")
    for job in range((NEWTON_STEPS + HALVINGS) // STEPS_PER_JOB):
        for _ in range(STEPS_PER_JOB):
            state = _step(counts, state, most, halve=job >= NEWTON_STEPS // STEPS_PER_JOB)
        state = materialized(state, "multipliers")
        if state.where(~F.col("done")).isEmpty():
            return state.select("key", "multiplier")
    open_keys = [r["key"][1:] or None for r in state.where(~F.col("done")).select("key").limit(10).collect()]
    raise RuntimeError(f"the multipliers of these sources do not settle: {open_keys}")


def _step(counts: DataFrame, state: DataFrame, most: int, halve: bool) -> DataFrame:
    """One Newton step of every source that is not settled; one that leaves the bracket becomes a bisection, as do all if `halve`.

    A source is settled when it takes its target, or when no double lies within its bracket any more.
    """
    at = rate(F.col("size"), F.col("multiplier"), most)
    words = F.col("documents") * F.col("size")
    sums = counts.join(state.where(~F.col("done")).select("key", "multiplier"), "key").groupBy("key").agg(
        F.sum(words * at).alias("taken"), F.sum(F.when(at < most, words * F.col("size") * at).otherwise(0.0)).alias("slope"))
    over = F.col("taken") - F.col("target")
    low = F.when(over < 0, F.col("multiplier")).otherwise(F.col("low"))
    high = F.when(over > 0, F.col("multiplier")).otherwise(F.col("high"))
    newton = F.col("multiplier") - over / F.when(F.col("slope") > 0, F.col("slope"))
    middle = (low + high) / 2
    step = middle if halve else F.when((newton > low) & (newton < high), newton).otherwise(middle)
    spent = (middle <= low) | (middle >= high)
    held = F.col("done") | F.coalesce(F.abs(over) <= F.col("target") * TOLERANCE, F.lit(True)) | spent
    return state.join(sums, "key", "left").select(
        "key", "target", F.when(held, F.col("multiplier")).otherwise(step).alias("multiplier"),
        F.when(held, F.col("low")).otherwise(low).alias("low"), F.when(held, F.col("high")).otherwise(high).alias("high"), held.alias("done"))


def mixed(rows: DataFrame, share: float = SHARE, weights: tuple[int, ...] = WEIGHTS, seed: int = 7) -> DataFrame:
    """One row per row of `rows`, which has source and size besides the columns that tell documents apart.

    Adds source_size, target, rate and copies (0 to 2). Equal rows are counted first and expanded again with a number
    each, so that they are rounded one by one. The caller's columns travel in one struct, so no name can clash.
    """
    alike = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")).groupBy("row").agg(F.count(F.lit(1)).alias("alike"))
    alike = materialized(alike.select("row", "alike", F.col("row.size").alias("size"), source_key(F.col("row.source")).alias("key")), "mix_rows")
    counts = materialized(alike.where("size > 0").groupBy("key", "size").agg(F.sum("alike").alias("documents")), "mix_sizes")
    sizes = alike.groupBy(F.col("row.source").alias("source")).agg(F.sum(F.col("size") * F.col("alike")).alias("source_size"))
    wanted = materialized(targets(sizes, share, weights).withColumn("key", source_key(F.col("source"))).drop("source"), "mix_targets")
    settled = wanted.join(multipliers(counts, wanted), "key")
    expanded = alike.select("row", "size", "key", F.explode(F.sequence(F.lit(1).cast("long"), F.col("alike"))).alias("number"))
    rated = materialized(expanded.join(settled, "key").select(
        "row", "size", "key", "number", "source_size", "target", rate(F.col("size"), F.col("multiplier")).alias("rate")), "mix_rates")
    chosen = rated.join(_cuts(rated, wanted, seed), "key", "left")
    taken = sum(F.when(_step_at(m, F.col("trial"), seed) < F.col("cut"), 1).otherwise(0) for m in range(1, MOST + 1))
    copies = F.when(F.col("size") > 0, taken).otherwise(1).cast("int").alias("copies")
    given = [F.col("row")[c].alias(c) for c in rows.columns if c.lower() not in ADDED]
    return chosen.select(*given, "source_size", "target", "rate", copies)


def _step_at(copies: int, trial: Column, seed: int) -> Column:
    """The shift, as a whole number of 2^-40, at which a document gets that many copies."""
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(seed), trial, F.col("number"), F.col("row")), 24)
    return F.floor((F.lit(copies + 2.0) - F.col("rate")) * float(1 << 40)).cast("long") - unit


def _cuts(rated: DataFrame, wanted: DataFrame, seed: int) -> DataFrame:
    """Per source the trial and the cut: steps below it are taken."""
    trial = F.explode(F.array(*[F.lit(t) for t in range(TRIALS)])).alias("trial")
    steps = rated.where("size > 0").select("*", trial).select(
        "key", "size", "trial", F.explode(F.array(*[_step_at(m, F.col("trial"), seed) for m in range(1, MOST + 1)])).alias("at"))
    state = wanted.select("key", "target", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    state = state.select("*", trial)
    held = RANGE_BITS
    for shift in SHIFTS:
        inside = steps.join(state, ["key", "trial"]).where(F.shiftright("at", held) == F.col("prefix"))
        bins = inside.groupBy("key", "trial", F.shiftright("at", shift).alias("bin")).agg(
            F.sum("size").alias("words"), F.first("below").alias("below"), F.first("target").alias("target"))
        running = Window.partitionBy("key", "trial").orderBy("bin")
        bins = bins.withColumn("upto", F.col("below") + F.sum("words").over(running.rowsBetween(Window.unboundedPreceding, 0)))
        # the first bin that reaches the target, or the last one where rounding keeps all below it
        found = bins.groupBy("key", "trial").agg(
            F.first("target").alias("target"),
            F.coalesce(F.min(F.when(F.col("upto") >= F.col("target"), F.struct("bin", "upto", "words"))), F.max(F.struct("bin", "upto", "words"))).alias("at"))
        state = materialized(found.select(
            "key", "trial", "target", F.col("at.bin").alias("prefix"), (F.col("at.upto") - F.col("at.words")).alias("below"), F.col("at.upto").alias("upto")), "mix_cuts")
        held = shift
    without, with_it = F.abs(F.col("target") - F.col("below")), F.abs(F.col("upto") - F.col("target"))
    return state.select(
        "key", F.struct(F.least(without, with_it).alias("miss"), "trial", (F.col("prefix") + F.when(with_it < without, 1).otherwise(0)).alias("cut")).alias("best"),
    ).groupBy("key").agg(F.min("best").alias("best")).select("key", F.col("best.trial").alias("trial"), F.col("best.cut").alias("cut"))
