"""A reproducible shuffle into shards: a keyed permutation of global row numbers.

Rows are numbered 0..N-1 in the order of a digest of their columns. A Feistel network over just enough bits to
hold N permutes the numbers, walking along its cycle until it is below N again; the place p gives the shard
p mod shards and the slot p div shards, so shard sizes differ by one at most and slots have no gaps. Both ways
can be computed from the number, the count and the seed alone.

Numbering needs no global sort: the digest's leading bits are the bucket, buckets are counted (one row each),
and a row's number is the rows of earlier buckets plus its place in its own. Equal rows are counted before they
are shuffled and expanded at the end, so a row repeated a billion times is one row until then.

Defined results: nulls are a value of their own; equal rows are interchangeable and get consecutive numbers; an
empty table gives an empty result; columns called row_number, shard or slot are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one task numbers, on average.
ROWS_PER_BUCKET = 250_000
ROUNDS = 6
#: Multipliers and offsets of the round function are drawn from this sequence by the seed.
_STEP = 0x9E3779B97F4A7C15
DIGEST_BITS = 60


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    """An odd 30-bit multiplier and a 30-bit offset per round."""
    keys, state = [], seed & (2**64 - 1)
    for _ in range(rounds):
        pair = []
        for _ in range(2):
            state = (state + _STEP) & (2**64 - 1)
            mixed = ((state ^ (state >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
            pair.append((mixed ^ (mixed >> 27)) >> 34)
        keys.append((pair[0] | 1, pair[1]))
    return keys


def halves(count: int) -> tuple[int, int]:
    """Bits of the right and of the left part of the smallest domain that holds `count` numbers."""
    bits = max(2, (max(count, 2) - 1).bit_length())
    return bits // 2, bits - bits // 2


def permuted(number: Column, count: int, seed: int) -> Column:
    """One pass of the network over the domain of `count`: a bijection of 0..2^bits-1."""
    low, high = halves(count)
    rounds = []
    for multiplier, offset in round_keys(seed):
        rounds.append(F.struct(
            F.lit(multiplier).cast("long").alias("multiplier"), F.lit(offset).cast("long").alias("offset"), F.lit(low).alias("low"), F.lit(high).alias("high"),
            F.lit((1 << low) - 1).cast("long").alias("right"), F.lit((1 << high) - 1).cast("long").alias("left")))
        low, high = high, low

    def turn(value: Column, key: Column) -> Column:
        # the left part takes up a digest of the right one; then the parts change places
        right = value.bitwiseAND(key["right"])
        mixed = right * key["multiplier"] + key["offset"]
        mixed = mixed.bitwiseXOR(F.shiftrightunsigned(mixed, 15)).bitwiseAND((1 << 31) - 1) * key["multiplier"]
        left = F.call_function("shiftrightunsigned", value, key["low"]).bitwiseXOR(F.shiftrightunsigned(mixed, 13).bitwiseAND(key["left"]))
        return F.call_function("shiftleft", right, key["high"]).bitwiseOR(left)

    return F.aggregate(F.array(*rounds), number, turn)


def place(number: Column, count: int, seed: int) -> Column:
    """The number's place among `count`: the network again and again until it falls below `count`."""
    step = F.aggregate(
        F.sequence(F.lit(1), F.lit(64)),
        permuted(number, count, seed),
        lambda at, _: F.when(at < count, at).otherwise(permuted(at, count, seed)),
    )
    return F.when(step < count, step).otherwise(F.raise_error(F.lit("cycle walk longer than 64 steps")).cast("long"))


def numbered(df: DataFrame) -> DataFrame:
    """All rows with a global row_number from 0, in the order of a digest of all columns."""
    columns = [c for c in df.columns if c not in ("row_number", "shard", "slot")]
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])
    leading = F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGEST_BITS // 4), 16, 10).cast("long")
    groups = df.select(*columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("__copies")).withColumn("__digest", leading)
    total = df.count()
    bits = max(4, (total // ROWS_PER_BUCKET).bit_length() + 1)
    groups = groups.withColumn("__bucket", F.shiftright("__digest", DIGEST_BITS - bits))
    sums = groups.groupBy("__bucket").agg(F.sum("__copies").alias("__rows"))
    # one row per bucket, a count of 2^bits that does not depend on the rows' content
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("__bucket", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy("__bucket").orderBy("__digest", *columns).rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.withColumn("__before", F.coalesce(F.sum("__copies").over(within), F.lit(0)))
    first = F.col("__start") + F.col("__before")
    return placed.join(F.broadcast(starts), "__bucket").select(
        *columns, F.explode(F.sequence(first, first + F.col("__copies") - 1)).alias("row_number"))


def shuffled_shards(df: DataFrame, shards: int, seed: int) -> DataFrame:
    """All rows with row_number, shard and slot."""
    rows = numbered(df)
    at = place(F.col("row_number"), df.count(), seed)
    return rows.withColumn("__place", at).select(
        *rows.columns, F.pmod("__place", F.lit(shards)).cast("int").alias("shard"),
        F.floor(F.col("__place") / F.lit(shards)).cast("long").alias("slot"))
