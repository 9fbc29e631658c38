"""Packing token sequences by vector best-fit.

A document's ids, with an end id, are cut into pieces of at most the sequence length, only where they are longer.
A sequence has three capacities: tokens, documents and attention cost (the sum of squared piece lengths). Pieces go in
order of falling length into the open sequence that the weighted measure likes best among those where all three fit:
the smallest norm of what stays free, or the smallest dot product of the piece with what is free. If none fits, a new
one is opened. Pieces that fill a sequence alone open and close one at once.

Pieces are dealt at random into blocks of a bounded number of rows, each packed in one task; a block leaves a
sequence or two partly filled among thousands. Neither texts nor ids are shuffled: only lengths and checksums.

Defined results: null and empty texts are one end id; repeated rows are packed each on its own; an empty table gives
an empty result; columns named like a result column are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.tokens import encoder, with_end
from kpiloom.session import materialized

#: Pieces packed together in one task.
BLOCK_PIECES = 20_000
WEIGHTS = (1.0, 1e-3, 1e-3)
PIECES = "at long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, separator: str, leading_space: bool, end_id: int, length: int, text_column: str = "text") -> DataFrame:
    """One row per piece of each document, with the document's other columns."""
    made = {"piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    kept = [c for c in docs.columns if c not in made and c != text_column]
    rows = docs.select(*kept, F.col(text_column).alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text"), "piece int", "start long", "length long", "ids_crc32 long"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = encoder(tokenizer, separator, leading_space).encode(batch.column("__text"))
            ids, counts = with_end(ids, counts, end_id)
            ends = np.cumsum(counts)
            per_doc = -(-counts // length)
            doc = np.repeat(np.arange(counts.size), per_doc)
            piece = np.arange(doc.size) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
            start = piece * length
            size = np.minimum(length, counts[doc] - start)
            first = (ends - counts)[doc] + start
            raw = memoryview(ids.astype("<u4").tobytes())
            sums = np.fromiter((zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), size.tolist(), strict=True)), np.int64, doc.size)
            others = batch.select(kept).take(pa.array(doc)) if kept else None
            columns = [*(others.columns if others is not None else []), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(size), pa.array(sums)]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacities: tuple[int, int, int], weights: tuple[float, float, float] = WEIGHTS, choose: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; lengths must be in falling order."""
    tokens, documents, cost = (float(c) for c in capacities)
    scale = np.array([weights[0] / tokens**2, weights[1] / documents**2, weights[2] / cost**2])
    bins, offsets = np.zeros(lengths.size, np.int64), np.zeros(lengths.size, np.int64)
    free, name, used = np.zeros((3, lengths.size + 1)), np.zeros(lengths.size + 1, np.int64), np.zeros(lengths.size + 1, np.int64)
    smallest = float(lengths[-1]) if lengths.size else 0.0
    width, made = 0, 0
    for i, n in enumerate(lengths.tolist()):
        item = np.array([n, 1.0, float(n) * n])
        room = free[:, :width]
        fits = np.flatnonzero((room[0] >= n) & (room[1] >= 1.0) & (room[2] >= item[2]))
        if fits.size:
            left = room[:, fits]
            score = scale @ (left - item[:, None]) ** 2 if choose == "norm" else (scale * item) @ left
            at = fits[np.argmin(score)]
        else:
            if n > tokens or item[2] > cost or documents < 1:
                raise ValueError(f"a piece of {n} tokens fits no sequence")
            at, width = width, width + 1
            free[:, at], name[at], used[at] = (tokens, documents, cost), made, 0
            made += 1
        bins[i], offsets[i] = name[at], used[at]
        free[:, at] -= item
        used[at] += n
        if free[0, at] < smallest or free[1, at] < 1.0:
            # closed: the last open one takes its place
            width -= 1
            free[:, at], name[at], used[at] = free[:, width], name[width], used[width]
    return bins, offsets


def packed(rows: DataFrame, length: int, documents: int | None = None, cost: int | None = None, weights: tuple[float, float, float] = WEIGHTS, choose: str = "norm") -> DataFrame:
    """The pieces with sequence_id and offset. Without a given capacity, documents and cost never bind."""
    capacities = (length, documents or length, cost or length * length)
    columns = [c for c in rows.columns if c not in ("sequence_id", "offset")]
    kept = materialized(rows.select(*columns, F.monotonically_increasing_id().alias("__at")), "pieces")
    blocks = max(1, -(-kept.count() // BLOCK_PIECES))
    dealt = kept.withColumn("__block", F.pmod(F.xxhash64("__at"), F.lit(blocks)))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "__at"], ascending=[False, True], kind="stable")
        bins, offsets = best_fit(block["length"].to_numpy(), capacities, weights, choose)
        block["sequence_id"], block["offset"] = (block["__block"].to_numpy() << 32) + bins, offsets
        return block[[*columns, "sequence_id", "offset"]]

    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), "sequence_id long", "offset long"])
    return dealt.groupBy("__block").applyInPandas(pack, schema)
