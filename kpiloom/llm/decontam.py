"""Benchmark decontamination by suffix arrays of the training texts.

Documents are cut into shards of a bounded number of words, each inside a task. A shard's suffixes are sorted by prefix
doubling, as far as the longest benchmark item reaches; then every suffix of the benchmark is binary-searched in it, word by
word: the range of the array that begins with its first k words narrows as k grows. The range at the window's length holds all
places of that window, and a range that can grow no longer is the longest verbatim match with its locations.

The benchmark is dealt into blocks of bounded size; each block goes to all tasks, one block at a time, and findings of a document
from several blocks are merged by its row. Documents are not shuffled for one block.

Defined results
- Words are runs of digits, letters a-z and characters beyond ASCII, once A-Z is lower-cased. A window is 10 consecutive words of
  an item; an item of fewer words, but not none, is one window. Null or wordless texts have no windows and no hits.
- Rows of equal item_id are one item, listed once; a null item_id is the empty name. Equal documents each get their row.
- A document longer than a shard is cut into overlapping segments whose findings are joined, so nothing is missed at a cut.
- Columns of the documents pass through; one that has the name of a result column is replaced by it. Empty tables on either side:
  no rows, or rows without hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.session import materialized, ship_package

WINDOW = 10
#: Words of a shard, and bytes of benchmark text that go to a task at a time.
SHARD_WORDS = 1_000_000
BLOCK_BYTES = 8 << 20

#: Lower-cases A-Z and turns every other ASCII character that is no digit or letter into a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("longest", T.StructType([T.StructField("length", T.LongType()), T.StructField("doc_word", T.LongType()), T.StructField("item_id", T.StringType()), T.StructField("item_word", T.LongType())])),
])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(_FOLD).split()


@dataclass(frozen=True)
class Block:
    """Benchmark items as one sequence of word numbers; a test is a suffix with room for its item's window."""

    names: list[str]
    vocabulary: dict[bytes, int]
    words: np.ndarray  # all items, one after the other
    item: np.ndarray  # per word: its item, its place there, the words from it to the item's end, and the item's window
    place: np.ndarray
    room: np.ndarray
    window: np.ndarray

    @property
    def longest(self) -> int:
        return int(self.room.max(initial=0))


def block_of(items: list[tuple[str, str | None]], window: int = WINDOW) -> Block:
    names = sorted({name for name, _ in items})
    number, vocabulary = {n: i for i, n in enumerate(names)}, {}
    parts, item, place, room, windows = [], [], [], [], []
    for name, text in items:
        found = words_of(text)
        n = len(found)
        if n:
            parts.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in found), np.int64, n))
            item.append(np.full(n, number[name]))
            place.append(np.arange(n))
            room.append(n - np.arange(n))
            windows.append(np.full(n, min(window, n)))
    joined = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (parts, item, place, room, windows)]
    return Block(names, vocabulary, *joined)


def suffix_array(values: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes in the order of their first `depth` values at least. Negative values must occur once each; the last one is negative."""
    order = np.argsort(values)
    fresh = np.append(True, values[order[1:]] != values[order[:-1]]) if len(order) else np.zeros(0, bool)
    slots = np.arange(len(order))
    rank = np.empty(len(order), np.int64)
    reach = 1
    while True:
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(slots)), 0)) if len(slots) else slots
        rank[order[slots]] = slots[first]
        tied = ~(fresh & np.append(fresh[1:], True))
        slots = slots[tied]
        if not len(slots) or reach >= depth:
            return order
        # values in a tie are no negative ones, so a suffix reaches past them
        at = order[slots]
        key = rank[at] * len(order) + rank[at + reach]
        by = np.argsort(key, kind="stable")
        order[slots] = at[by]
        key = key[by]
        fresh = np.append(True, key[1:] != key[:-1])
        reach *= 2


def _narrowed(values: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of the ranges whose suffixes have the wanted value after `depth` values, by binary search of all ranges at once."""
    ends = []
    for above in (False, True):
        a, b = low.copy(), high.copy()
        while True:
            open_ = np.flatnonzero(a < b)
            if not len(open_):
                break
            middle = (a[open_] + b[open_]) // 2
            seen = values[order[middle] + depth]
            right = seen <= wanted[open_] if above else seen < wanted[open_]
            a[open_] = np.where(right, middle + 1, a[open_])
            b[open_] = np.where(right, b[open_], middle)
        ends.append(a)
    return ends[0], ends[1]


def _searched(values: np.ndarray, block: Block) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """The suffix array; per length of window the tests found with their ranges; and (test, length, low, high) of maximal matches."""
    order = suffix_array(values, block.longest)
    tests = np.flatnonzero(block.room >= block.window)
    low, high = np.zeros(len(tests), np.int64), np.full(len(tests), len(order))
    found, longest = [], []
    depth = 0
    while len(tests):
        new_low, new_high = _narrowed(values, order, low, high, depth, block.words[tests + depth])
        if depth:
            met = block.window[tests] <= depth
            # a test that follows its neighbour wherever that one goes adds no longer match
            follows = np.zeros(len(tests), bool)
            follows[1:] = (tests[1:] == tests[:-1] + 1) & (block.item[tests[1:]] == block.item[tests[:-1]]) & ((new_high - new_low)[:-1] == (high - low)[1:])
            ended = met & ~follows & (new_high - new_low < high - low)
            longest.append(np.stack([tests[ended], np.full(ended.sum(), depth), low[ended], high[ended]]))
            alive = (new_low < new_high) & ~(met & follows)
        else:
            alive = new_low < new_high
        depth += 1
        tests, low, high = tests[alive], new_low[alive], new_high[alive]
        full = block.window[tests] == depth
        if full.any():
            found.append((tests[full], low[full], high[full]))
        done = block.room[tests] == depth
        if done.any():
            longest.append(np.stack([tests[done], np.full(done.sum(), depth), low[done], high[done]]))
            tests, low, high = tests[~done], low[~done], high[~done]
    return order, found, np.concatenate(longest, axis=1) if longest else np.zeros((4, 0), np.int64)


def _spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All slots of the ranges, and the number of the range each comes from."""
    sizes = high - low
    owner = np.repeat(np.arange(len(low)), sizes)
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner], owner


class Shard:
    """Segments of documents, searched together."""

    def __init__(self, block: Block):
        self.block, self.parts, self.owners, self.offsets, self.size = block, [], [], [], 0

    def add(self, document: int, offset: int, ids: np.ndarray) -> None:
        self.parts.append(np.append(ids, -1))
        self.owners.append(document)
        self.offsets.append(offset)
        self.size += len(ids) + 1

    def search(self, hits: dict[int, list], items: dict[int, set], best: dict[int, tuple]) -> None:
        """Adds to hits (places and lengths of windows), items (their numbers) and best (longest match) per document."""
        if not self.parts:
            return
        values = np.concatenate(self.parts)
        starts = np.cumsum([0] + [len(p) for p in self.parts])[:-1]
        absent = np.flatnonzero(values < 0)
        values[absent] = -1 - np.arange(len(absent))
        owners, shift = np.array(self.owners), np.array(self.offsets) - starts

        def located(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            place = order[slots]
            segment = np.searchsorted(starts, place, "right") - 1
            return owners[segment], place + shift[segment]

        order, found, longest = _searched(values, self.block)
        sharers: dict[tuple, tuple] = {}
        for tests, low, high in found:
            # equal windows share a range, so a place is listed once per length of window
            ranges, group = np.unique(np.stack([low, high]), axis=1, return_inverse=True)
            slots, of = _spread(ranges[0], ranges[1])
            document, word = located(slots)
            length = self.block.window[tests[0]]
            by = np.argsort(document, kind="stable")
            document, word, of = document[by], word[by], of[by]
            group = group.ravel()
            members = np.unique(np.stack([group, self.block.item[tests]]), axis=1)
            first = np.searchsorted(members[0], np.arange(ranges.shape[1] + 1))
            cuts = np.flatnonzero(np.append(True, document[1:] != document[:-1])) if len(document) else []
            for a, b in zip(cuts, [*cuts[1:], len(document)]):
                key = (int(length), np.unique(of[a:b]).tobytes())
                if key not in sharers:
                    sharers[key] = tuple({int(i) for g in np.unique(of[a:b]) for i in members[1, first[g] : first[g + 1]]})
                hits.setdefault(int(document[a]), []).append((word[a:b], int(length)))
                items.setdefault(int(document[a]), set()).update(sharers[key])
        slots, of = _spread(longest[2], longest[3])
        document, word = located(slots)
        test, length = longest[0][of], longest[1][of]
        by = np.lexsort((self.block.place[test], self.block.item[test], word, -length, document))
        for k in by[np.append(True, document[by][1:] != document[by][:-1])] if len(by) else []:
            entry = (int(length[k]), -int(word[k]), -int(self.block.item[test[k]]), -int(self.block.place[test[k]]))
            best[int(document[k])] = max(best.get(int(document[k]), entry), entry)


def _merged(hits: list[tuple[np.ndarray, int]]) -> list[dict[str, int]]:
    """Windows' places and lengths as the spans of words that they cover."""
    start = np.concatenate([w for w, _ in hits])
    end = np.concatenate([w + n for w, n in hits])
    by = np.argsort(start, kind="stable")
    start, reach = start[by], np.maximum.accumulate(end[by])
    opens = np.append(True, start[1:] > reach[:-1])
    return [{"start": int(a), "end": int(b)} for a, b in zip(start[opens], reach[np.append(opens[1:], True)])]


def _documents(texts: list[str | None], block: Block, shard_words: int) -> list[dict]:
    """The findings of each text."""
    hits, items, best, sizes = {}, {}, {}, []
    overlap = max(block.longest, 1) - 1
    shard, number = Shard(block), block.vocabulary
    for document, text in enumerate(texts):
        found = words_of(text)
        sizes.append(len(found))
        ids = np.fromiter((number.get(w, -1) for w in found), np.int64, len(found))
        for offset in range(0, max(1, len(ids) - overlap), shard_words):
            segment = ids[offset : offset + shard_words + overlap]
            if shard.size and shard.size + len(segment) > shard_words:
                shard.search(hits, items, best)
                shard = Shard(block)
            shard.add(document, offset, segment)
    shard.search(hits, items, best)
    names = block.names
    return [{
        "n_words": n, "spans": _merged(hits[d]) if d in hits else [], "items": sorted((names[i] for i in items.get(d, ())), key=lambda s: s.encode()),
        "longest": dict(zip(("length", "doc_word", "item_id", "item_word"), (best[d][0], -best[d][1], names[-best[d][2]], -best[d][3]))) if d in best else None,
    } for d, n in enumerate(sizes)]


def _block_findings(docs: DataFrame, text_column: str, keep: list[str], block: Block, shard_words: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    schema = T.StructType([docs.schema[c] for c in keep] + list(RESULT.fields))
    arrow = [pa.field("n_words", pa.int64()), pa.field("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.field("items", pa.list_(pa.string())),
             pa.field("longest", pa.struct([("length", pa.int64()), ("doc_word", pa.int64()), ("item_id", pa.string()), ("item_word", pa.int64())]))]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _documents(batch.column(text_column).to_pylist(), shared.value, shard_words)
            made = [pa.array([r[f.name] for r in rows], f.type) for f in arrow]
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(kept + made, names=[*keep, *(f.name for f in arrow)])

    wanted = list(dict.fromkeys([*keep, text_column]))
    return docs.select(*[F.col(f"`{c}`") for c in wanted]).mapInArrow(search, schema)


def overlaps(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", keep: list[str] | None = None, item_id: str = "item_id", item_text: str = "text",
             block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Every document with n_words, spans (of words inside any window), items (that have a window in it) and longest (verbatim match).

    ``keep`` names the columns to carry along (all by default).
    """
    ship_package(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in RESULT.names]
    items = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("name"), F.col(f"`{item_text}`").alias("text"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = 1 + total // block_bytes
    if count == 1:
        return _block_findings(docs, text_column, keep, block_of([tuple(r) for r in items.collect()]), shard_words)
    # no block is much above the bound, unless a single item is; each is held by the driver one at a time
    dealt = materialized(items.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(count))), "items")
    rows = materialized(docs.withColumn("__row", F.monotonically_increasing_id()), "documents")
    found = None
    for b in range(count):
        block = block_of([tuple(r) for r in dealt.where(F.col("block") == b).select("name", "text").collect()])
        part = materialized(_block_findings(rows, text_column, ["__row"], block, shard_words), "findings")
        found = part if found is None else found.union(part)
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    joined = F.aggregate(spans, F.slice(spans, 1, 0), lambda done, span: F.when(
        (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= span["start"]),
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], span["end"]).alias("end")))),
    ).otherwise(F.concat(done, F.array(span))))
    best = F.max(F.when(F.col("longest").isNotNull(), F.struct(F.col("longest.length"), (-F.col("longest.doc_word")).alias("doc_word"), "longest")))
    merged = found.groupBy(F.col("__row").alias("__of")).agg(
        F.max("n_words").alias("n_words"), joined.alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), best["longest"].alias("longest"))
    return rows.join(merged, F.col("__row") == F.col("__of")).select(*[F.col(f"`{c}`") for c in keep], *RESULT.names)


def covered(spans: Column) -> Column:
    """Words inside the spans."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The documents, with their own columns, that hold no window of any benchmark item."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__document"), F.col(f"`{text_column}`").alias("__text"))
    return overlaps(packed, benchmark, "__text", ["__document"], **options).where(F.size("spans") == 0).select("__document.*")
