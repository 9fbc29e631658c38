"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are centred on the mean of all and turned by a random orthogonal matrix; a vector's code is the sign of each
of its coordinates, packed into bits, with two scalars: its distance from the centre, and how well the code stands
for its direction. From code and scalars follow an estimate of the inner product with any query and a bound of its
error, so a block of vectors is searched by codes alone; only vectors whose lower bound of the distance does not
exceed the k-th smallest upper bound of the block are measured exactly, in double precision on the vectors as given.

Every query meets every block of vectors once: queries and vectors are dealt into blocks of bounded size, and a pair
of blocks is one task's group. A pair of blocks returns at most k rows per query, the best of all blocks count.

Defined results: vectors that are null, zero, of another length than most, or hold null or non-finite components take
no part, neither as queries nor as candidates. Rows that share an id are rows of their own; a query never finds its own
row. Ties go to the smaller id. With fewer than k candidates all are returned. No rows, no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.session import materialized

#: Vectors and queries per block.
BLOCK_VECTORS, BLOCK_QUERIES = 20_000, 4_000
#: Width of the error bound in standard deviations of the code's error.
DEVIATIONS = 4.0
SEED = 11


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distances from the centre, and each code's inner product with its direction."""
    moved = vectors - centre
    norm = np.sqrt((moved**2).sum(axis=1))
    direction = (moved / np.where(norm > 0, norm, 1.0)[:, None]) @ turn.T
    bits = direction > 0
    aligned = np.abs(direction).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(bits, axis=1), norm, aligned


def estimate(codes: np.ndarray, norm: np.ndarray, aligned: np.ndarray, queries: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of all queries (rows) to all vectors (columns) and the bounds of their errors."""
    size = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1
    moved = queries - centre
    reach = np.sqrt((moved**2).sum(axis=1))
    direction = ((moved / np.where(reach > 0, reach, 1.0)[:, None]) @ turn.T).astype(np.float32)
    safe = np.where(aligned > 0, aligned, 1.0)
    cosine = (direction @ signs.T) / np.sqrt(size) / safe
    error = DEVIATIONS * np.sqrt(np.maximum(0.0, 1 - safe**2)) / safe / np.sqrt(max(1, size - 1)) + 1e-5
    both = 2 * reach[:, None] * norm[None]
    return reach[:, None] ** 2 + norm[None] ** 2 - both * cosine, both * error[None]


def _matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def distance(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed component after component."""
    total = np.zeros(len(rows))
    for i in range(rows.shape[1]):
        total += (rows[:, i] - query[i]) ** 2
    return np.sqrt(total)


def usable(vectors: DataFrame) -> DataFrame:
    """The rows that take part, with a row number `at` that is written down with them."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where(F.col("embedding").isNotNull() & ~bad)
    whole = whole.where(F.exists("embedding", lambda x: x != 0))
    return materialized(whole.select(F.monotonically_increasing_id().alias("at"), "vec_id", "embedding"), "vectors")


def build(vectors: DataFrame) -> tuple[DataFrame, np.ndarray, int]:
    """The index: every usable vector with code, norm and aligned; the centre; the vectors' length."""
    rows = usable(vectors)
    sizes = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = sizes["size"] if sizes else 0
    rows = rows.where(F.size("embedding") == size)
    means = rows.select(F.posexplode("embedding").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("mean")).orderBy("i").collect()
    centre, turn = np.array([r["mean"] for r in means]), rotation(max(1, size))

    def code(batches):
        for batch in batches:
            codes, norm, aligned = encode(_matrix(batch.column("embedding"), size), centre, turn)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm), pa.array(aligned)], ["at", "vec_id", "embedding", "code", "norm", "aligned"])

    coded = rows.mapInArrow(code, "at long, vec_id long, embedding array<double>, code binary, norm double, aligned double")
    return materialized(coded, "codes"), centre, size


def search(index: DataFrame, queries: DataFrame, centre: np.ndarray, size: int, k: int) -> DataFrame:
    """The k nearest rows of the index to each query row (at, vec_id, embedding), without itself."""
    turn = rotation(max(1, size))
    blocks, sheets = max(1, -(-index.count() // BLOCK_VECTORS)), max(1, -(-queries.count() // BLOCK_QUERIES))
    left = index.withColumn("block", F.pmod(F.xxhash64("at"), F.lit(blocks))).withColumn("sheet", F.explode(F.sequence(F.lit(0), F.lit(sheets - 1))))
    right = queries.select("at", "vec_id", "embedding", F.pmod(F.xxhash64("at"), F.lit(sheets)).cast("int").alias("sheet")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def meet(vectors: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_at": [], "query_id": [], "vec_id": [], "score": []}
        if vectors.num_rows and asked.num_rows:
            own, exact = vectors["at"].to_numpy(), _matrix(vectors["embedding"], size)
            names = vectors["vec_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
            codes = np.frombuffer(b"".join(vectors["code"].to_pylist()), np.uint8).reshape(len(own), -1)
            norm, aligned = vectors["norm"].to_numpy(), vectors["aligned"].to_numpy()
            wanted, wanted_at, wanted_id = _matrix(asked["embedding"], size), asked["at"].to_numpy(), asked["vec_id"].to_pylist()
            for first in range(0, len(wanted), 128):
                part = slice(first, first + 128)
                near, error = estimate(codes, norm, aligned, wanted[part], centre, turn)
                low, high = near - error, near + error
                for row, at in enumerate(wanted_at[part]):
                    low[row, own == at] = high[row, own == at] = np.inf
                kth = min(k, high.shape[1]) - 1
                bound = np.partition(high, kth, axis=1)[:, kth]
                for row, at in enumerate(wanted_at[part]):
                    at_most = np.flatnonzero((low[row] <= bound[row]) & np.isfinite(low[row]))
                    score = distance(exact[at_most], wanted[first + row])
                    best = np.lexsort((own[at_most], names[at_most], score))[:k]
                    out["query_at"] += [int(at)] * best.size
                    out["query_id"] += [wanted_id[first + row]] * best.size
                    out["vec_id"] += [vectors["vec_id"][int(i)].as_py() for i in at_most[best]]
                    out["score"] += score[best].tolist()
        return pa.table(out, schema=pa.schema([("query_at", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    found = left.groupBy("block", "sheet").cogroup(right.groupBy("block", "sheet")).applyInArrow(meet, "query_at long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_at").orderBy("score", F.col("vec_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
