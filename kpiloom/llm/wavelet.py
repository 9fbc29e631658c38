"""Token ids in wavelet matrix files, one per shard.

A shard holds a run of documents in ascending doc_id order. Its ids are stored bit-plane by bit-plane, from the
highest bit; after each plane the ids are parted stably into those with a 0 and those with a 1. With the ranks of
every plane one file answers: the id at a place (`access`), how often an id occurs before a place (`rank`, `count`),
and where its k-th occurrence is (`select`, `occurrences`); `decode` gives all ids back. Planes are packed bits with
one running count per 512, and every section is compressed on its own.

Documents are dealt to shards by ranges of (doc_id, digest of the text, place in the input), so that neither many rows with
one doc_id nor many equal rows meet in one shard. Spark stores the files, one row (shard, file, documents, tokens) each, so any
folder that Spark can open serves, and a repeated task leaves nothing behind.

Defined results: a null text is an empty one, which has only the end id; a null doc_id comes first; repeated rows are
stored each on its own; an empty table gives no shards and an empty result. Other columns are not stored.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.tokens import encoder, with_end
from kpiloom.session import materialized

MAGIC = b"WVMX0001"
BLOCK_BITS = 512
#: Bytes of text per shard, on average.
SHARD_BYTES = 24_000_000
LEVEL = 1
#: Ids that are parted at once, a multiple of eight.
PART = 65_536


class BitPlane:
    """Packed bits, little end first, with the ones before every block of 512."""

    def __init__(self, packed: np.ndarray, blocks: np.ndarray, size: int):
        self.packed, self.blocks, self.size = packed, blocks, size

    @classmethod
    def of(cls, bits: np.ndarray) -> BitPlane:
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros(-(-packed.size // (BLOCK_BITS // 8)) * (BLOCK_BITS // 8), np.uint8)
        padded[: packed.size] = packed
        ones = np.bitwise_count(padded.view(np.uint64)).reshape(-1, BLOCK_BITS // 64).sum(axis=1, dtype=np.int64)
        return cls(padded, np.concatenate([[0], np.cumsum(ones)]).astype(np.uint64), bits.size)

    def bits(self, start: int, stop: int) -> np.ndarray:
        """The bits from start, a multiple of eight, up to stop or the last."""
        stop = min(stop, self.size)
        return np.unpackbits(self.packed[start >> 3 : -(-stop // 8)], count=stop - start, bitorder="little").view(bool)

    def get(self, i: int) -> int:
        return int(self.packed[i >> 3] >> (i & 7)) & 1

    @property
    def ones(self) -> int:
        return int(self.blocks[-1])

    def rank1(self, i: int) -> int:
        """Ones among the first i bits."""
        block = i // BLOCK_BITS
        if block * BLOCK_BITS == i:
            return int(self.blocks[block])
        part = np.unpackbits(self.packed[block * (BLOCK_BITS // 8) : (block + 1) * (BLOCK_BITS // 8)], bitorder="little")
        return int(self.blocks[block]) + int(part[: i % BLOCK_BITS].sum())

    def select(self, bit: int, k: int) -> int:
        """Place of the k-th (from 0) bit of that kind."""
        before = self.blocks.astype(np.int64) if bit else np.arange(self.blocks.size) * BLOCK_BITS - self.blocks.astype(np.int64)
        block = int(np.searchsorted(before, k, side="right")) - 1
        part = np.unpackbits(self.packed[block * (BLOCK_BITS // 8) : (block + 1) * (BLOCK_BITS // 8)], bitorder="little")
        return block * BLOCK_BITS + int(np.flatnonzero(part == bit)[k - int(before[block])])


class WaveletMatrix:
    def __init__(self, planes: list[BitPlane], size: int):
        self.planes, self.size = planes, size

    @classmethod
    def of(cls, ids: np.ndarray, width: int | None = None) -> WaveletMatrix:
        """The matrix of unsigned ids, over `width` bits or as many as the largest needs."""
        width = width or max(1, int(ids.max(initial=0)).bit_length())
        held = ids.astype(np.uint16 if width <= 16 else np.uint32)
        planes = []
        ones = np.empty_like(held)
        bits = np.empty(held.size, bool)
        for level in reversed(range(width)):
            np.not_equal(held & held.dtype.type(1 << level), 0, out=bits)
            planes.append(BitPlane.of(bits))
            # by places, as a mask of random bits costs several times as much, and by parts that stay in the processor's cache
            zero = one = 0
            for at in range(0, held.size, PART):
                part, own = held[at : at + PART], bits[at : at + PART]
                lower, upper = part.take(np.flatnonzero(~own)), part.take(np.flatnonzero(own))
                held[zero : zero + lower.size], ones[one : one + upper.size] = lower, upper
                zero, one = zero + lower.size, one + upper.size
            held[zero:] = ones[:one]
        return cls(planes, ids.size)

    def decode(self) -> np.ndarray:
        """All ids, from the lowest plane upwards: each parting is undone."""
        held = np.zeros(self.size, np.uint16 if len(self.planes) <= 16 else np.uint32)
        before = np.empty_like(held)
        for level, plane in enumerate(reversed(self.planes)):
            zero, one = 0, self.size - plane.ones
            held[one:] |= held.dtype.type(1 << level)
            for at in range(0, self.size, PART):
                bits, part = plane.bits(at, at + PART), before[at : at + PART]
                lower, upper = np.flatnonzero(~bits), np.flatnonzero(bits)
                part[lower], part[upper] = held[zero : zero + lower.size], held[one : one + upper.size]
                zero, one = zero + lower.size, one + upper.size
            held, before = before, held
        return held.astype(np.uint32)

    def access(self, i: int) -> int:
        value = 0
        for plane in self.planes:
            bit = plane.get(i)
            value = value << 1 | bit
            ones = plane.rank1(i)
            i = self.size - plane.ones + ones if bit else i - ones
        return value

    def _range(self, symbol: int, start: int, stop: int) -> tuple[int, int]:
        for level, plane in zip(reversed(range(len(self.planes))), self.planes, strict=True):
            a, b = plane.rank1(start), plane.rank1(stop)
            zeros = self.size - plane.ones
            start, stop = (zeros + a, zeros + b) if symbol >> level & 1 else (start - a, stop - b)
        return start, stop

    def count(self, symbol: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of an id among the places start to stop - 1."""
        if symbol >> len(self.planes):
            return 0
        a, b = self._range(symbol, start, self.size if stop is None else stop)
        return b - a

    def rank(self, symbol: int, stop: int) -> int:
        return self.count(symbol, 0, stop)

    def select(self, symbol: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence of an id."""
        if not 0 <= k < self.count(symbol):
            raise IndexError(k)
        at = self._range(symbol, 0, self.size)[0] + k
        for level, plane in enumerate(reversed(self.planes)):
            bit = symbol >> level & 1
            at = plane.select(bit, at - (self.size - plane.ones) if bit else at)
        return at

    def occurrences(self, symbol: int) -> list[int]:
        return [self.select(symbol, k) for k in range(self.count(symbol))]


class Shard:
    """Documents of one file: their ids' wavelet matrix, doc_ids and lengths."""

    def __init__(self, matrix: WaveletMatrix, doc_ids: np.ndarray, known: np.ndarray, lengths: np.ndarray):
        self.matrix, self.doc_ids, self.known, self.lengths = matrix, doc_ids, known, lengths
        self.starts = np.cumsum(lengths) - lengths

    def to_bytes(self) -> bytes:
        """Magic, length of the head, the head as JSON (sizes of the sections), then the compressed sections."""
        sections = [self.doc_ids.astype("<i8").tobytes(), np.packbits(self.known).tobytes(), self.lengths.astype("<i8").tobytes()]
        for plane in self.matrix.planes:
            sections += [plane.packed.tobytes(), plane.blocks.astype("<u8").tobytes()]
        press = zstandard.ZstdCompressor(level=LEVEL)
        packed = [press.compress(s) for s in sections]
        head = json.dumps({"tokens": self.matrix.size, "documents": int(self.lengths.size), "planes": len(self.matrix.planes), "sections": [len(p) for p in packed]}).encode()
        return b"".join([MAGIC, struct.pack("<I", len(head)), head, *packed])

    @classmethod
    def from_bytes(cls, raw: bytes) -> Shard:
        if raw[: len(MAGIC)] != MAGIC:
            raise ValueError("not a wavelet shard")
        size = struct.unpack_from("<I", raw, len(MAGIC))[0]
        at = len(MAGIC) + 4 + size
        head = json.loads(raw[at - size : at])
        expand, sections = zstandard.ZstdDecompressor(), []
        for n in head["sections"]:
            sections.append(expand.decompress(memoryview(raw)[at : at + n]))
            at += n
        known = np.unpackbits(np.frombuffer(sections[1], np.uint8), count=head["documents"]).view(bool)
        planes = [BitPlane(np.frombuffer(sections[k], np.uint8), np.frombuffer(sections[k + 1], "<u8"), head["tokens"]) for k in range(3, 3 + 2 * head["planes"], 2)]
        return cls(WaveletMatrix(planes, head["tokens"]), np.frombuffer(sections[0], "<i8"), known, np.frombuffer(sections[2], "<i8"))


def write_shards(docs: DataFrame, folder: str, tokenizer: str, separator: str, leading_space: bool, end_id: int, text_column: str = "text") -> DataFrame:
    """Writes one file per shard to the folder; returns one row per shard: shard, file, documents, tokens, start."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    keyed = rows.select("doc_id", F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("at"), "text")
    dealt = keyed.repartitionByRange(shards, F.col("doc_id").asc_nulls_first(), "digest", "at")
    ordered = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "digest", "at").select(F.spark_partition_id().alias("shard"), "doc_id", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, names, shard = [], [], [], None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            shard = batch.column("shard")[0].as_py()
            found, sizes = with_end(*encoder(tokenizer, separator, leading_space).encode(batch.column("text")), end_id)
            ids.append(found)
            counts.append(sizes)
            names.append(batch.column("doc_id"))
        if shard is None:
            return
        own = pa.chunked_array(names).combine_chunks()
        made = Shard(WaveletMatrix.of(np.concatenate(ids)), own.fill_null(0).to_numpy(), own.is_valid().to_numpy(zero_copy_only=False), np.concatenate(counts))
        ids.clear()
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "documents": pa.array([made.lengths.size], pa.int64()), "tokens": pa.array([made.matrix.size], pa.int64()),
            "file": pa.array([made.to_bytes()], pa.binary())})

    schema = "shard int, documents long, tokens long, file binary"
    ordered.mapInArrow(write, schema).write.parquet(folder)
    written = docs.sparkSession.read.schema(schema).parquet(folder)
    # one row per shard
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    starts = written.select(F.col("shard").alias("of"), "tokens").select("of", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    # stored, so that the planner knows how small it is beside the files
    return written.join(materialized(starts, "starts"), F.col("shard") == F.col("of")).drop("of")


def read_documents(shards: DataFrame) -> DataFrame:
    """Every document of the shard files: doc_id, start, n_tokens, ids_crc32, shard."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (shard, start) in enumerate(zip(batch.column("shard").to_pylist(), batch.column("start").to_pylist(), strict=True)):
                held = Shard.from_bytes(batch.column("file")[k].as_py())
                raw = memoryview(held.matrix.decode().astype("<u4").tobytes())
                sums = np.fromiter((zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(held.starts.tolist(), held.lengths.tolist(), strict=True)), np.int64, held.lengths.size)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(held.doc_ids, mask=~held.known), "start": pa.array(held.starts + start), "n_tokens": pa.array(held.lengths),
                    "ids_crc32": pa.array(sums), "shard": pa.array(np.full(sums.size, shard, np.int32))})

    return shards.select("shard", "start", "file").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int")
