"""Exact ranks and quartiles over any number of rows without one task seeing them all."""

from __future__ import annotations

import math
import struct
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.session import materialized

FRACTIONS = (0.25, 0.75)
#: Bits of a value's image that one pass of the refinement settles; a pass counts at most 2 ** STEP bins a place.
STEP = 13
_ALL_BUT_SIGN = (1 << 63) - 1


def with_weight_before(values: DataFrame, value: str, weight: str) -> DataFrame:
    """Adds ``before``: the weight of all smaller values. ``values`` holds one row per value.

    Values are dealt to partitions by range, which are written down with their number; each is summed on its own and
    shifted by the total of the partitions before it, one row per partition.
    """
    dealt = values.repartitionByRange(value).withColumn("part", F.spark_partition_id())
    dealt = materialized(dealt, "ranges")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("part").agg(F.sum(weight).alias("part_weight"))
    offsets = totals.select("part", F.coalesce(F.sum("part_weight").over(earlier), F.lit(0)).alias("offset"))
    running = Window.partitionBy("part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition of the shuffle
    placed = dealt.join(F.broadcast(offsets), "part")
    return placed.select(*values.columns, (F.col("offset") + F.coalesce(F.sum(weight).over(running), F.lit(0))).alias("before"))


def with_rank_descending(rows: DataFrame, value: str, rank: str) -> DataFrame:
    """SQL rank over the whole table, largest first, equal values sharing a rank; nulls come first and rank 1.

    Ranks are worked out on distinct values with their counts, so a value shared by many rows is one row there, and
    joined back on the value.
    """
    rows = materialized(rows, "ranked")
    tallied = rows.groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    unknown = tallied.where(F.col(value).isNull()).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    falling = tallied.where(F.col(value).isNotNull()).withColumn("falling", -F.col(value))
    known = with_weight_before(falling, "falling", "n").select(F.col(value).alias("__value"), (F.col("before") + 1).alias("__place"))
    ranked = materialized(known.select("__value", (F.col("__place") + unknown.scalar()).cast("bigint").alias(rank)), "places")
    placed = rows.join(ranked, rows[value] == ranked["__value"], "left")
    return placed.select(*rows.columns, F.coalesce(F.col(rank), F.lit(1).cast("bigint")).alias(rank))


def _image(value: Column) -> Column:
    """A double as a whole number of the same order: its bits, those below the sign turned over for negative values."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + 0.0).cast("bigint")
    return F.when(value.isNotNull(), bits.bitwiseXOR(F.shiftrightunsigned(F.shiftright(bits, 63), 1)))


def image_of(value: float) -> int:
    """`_image` of one value."""
    bits = struct.unpack(">q", struct.pack(">d", value + 0.0))[0]
    return bits if bits >= 0 else bits ^ _ALL_BUT_SIGN


def value_of(image: int) -> float:
    """The value that has this image."""
    return struct.unpack(">d", struct.pack(">q", image if image >= 0 else image ^ _ALL_BUT_SIGN))[0]


def value_images(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The images of the columns' values as i0, i1, ..., written once; a NaN is a missing value."""
    numbers = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)]
    return materialized(rows.select(*numbers).select(*[_image(F.col(f"v{i}")).alias(f"i{i}") for i in range(len(columns))]), "images")


def _counts(images: DataFrame, prefixes: dict[int, set[int]], held: int, shift: int) -> dict[int, dict[int, int]]:
    """Per column and bin (image >> shift) the number of values, of those whose image >> held is one of the prefixes."""
    image = F.col("image")
    cells = images.select(F.posexplode(F.array(*[f"i{i}" for i in range(len(images.columns))])).alias("column", "image")).where(image.isNotNull())
    if held < 64:
        among = [(F.col("column") == i) & F.shiftright(image, held).isin(*found) for i, found in prefixes.items()]
        cells = cells.where(reduce(Column.__or__, among))
    found = cells.groupBy("column", F.shiftright(image, shift).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    bins: dict[int, dict[int, int]] = {i: {} for i in prefixes}
    for row in found.collect():  # at most four places a column, 2 ** STEP bins each
        bins[row["column"]][row["bin"]] = row["n"]
    return bins


def _quartiles(images: DataFrame, columns: int) -> dict[int, tuple[int, float, float]]:
    """Per column with values: their number and the quartiles, by refining the images of the values at their places."""
    held, shift = 64, 64 - STEP
    bins = _counts(images, {i: set() for i in range(columns)}, held, shift)
    totals = {i: sum(found.values()) for i, found in bins.items()}
    places = {i: {math.floor((n - 1) * f) for f in FRACTIONS} | {math.ceil((n - 1) * f) for f in FRACTIONS} for i, n in totals.items() if n}
    # per place the prefix of its value's image, and how many values lie below all values with that prefix
    state = {(i, place): (0, 0) for i, wanted in places.items() for place in wanted}
    while state:
        for (i, place), (prefix, below) in state.items():
            for at in sorted(b for b in bins[i] if held == 64 or b >> (held - shift) == prefix):
                if below + bins[i][at] > place:
                    state[i, place] = (at, below)
                    break
                below += bins[i][at]
        if shift == 0:
            break
        most = max(bins[i][prefix] for (i, _), (prefix, _) in state.items())
        held, shift = shift, 0 if most <= 1 << STEP else max(0, shift - STEP)
        bins = _counts(images, {i: {state[i, place][0] for place in wanted} for i, wanted in places.items()}, held, shift)

    def quartile(i: int, fraction: float) -> float:
        place = (totals[i] - 1) * fraction
        low, high = (value_of(state[i, step(place)][0]) for step in (math.floor, math.ceil))
        return low if low == high else low + (high - low) * (place - math.floor(place))

    return {i: (totals[i], *(quartile(i, f) for f in FRACTIONS)) for i in places}


def quartiles(rows: DataFrame, columns: list[str]) -> dict[str, tuple[int, float, float]]:
    """Per column with values: their number and the exact quartiles, linearly interpolated.

    Values become 64-bit images of the same order, written once. At most five passes over them settle the places of all
    columns at once, 13 bits each: a pass counts the images with the prefixes found so far by their next bits, on the
    map side. Once no prefix has more than 2 ** 13 values, the next pass takes all bits left. Counts are all that is
    shuffled, at most 2 ** 13 a place, whatever the values and however they repeat.
    """
    return {columns[i]: found for i, found in _quartiles(value_images(rows, columns), len(columns)).items()}


def iqr_outliers(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows outside 1.5 interquartile ranges: column, low, high, n. Needs four values and a non-zero range.

    Quartiles between which infinity lies give no range and no row.
    """
    images = value_images(rows, columns)
    found = _quartiles(images, len(columns))
    fences = {i: (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)) for i, (n, q1, q3) in found.items() if n >= 4 and q1 != q3}
    fences = {i: ends for i, ends in fences.items() if not any(math.isnan(end) for end in ends)}
    schema = "column string, low double, high double, n bigint"
    if not fences:
        return rows.sparkSession.createDataFrame([], schema)
    counts = images.agg(*[F.count_if((F.col(f"i{i}") < image_of(low)) | (F.col(f"i{i}") > image_of(high))).alias(f"n{i}") for i, (low, high) in fences.items()])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(columns[i]).alias("column"), F.lit(low).alias("low"), F.lit(high).alias("high"), F.col(f"n{i}").alias("n")) for i, (low, high) in fences.items()])))
