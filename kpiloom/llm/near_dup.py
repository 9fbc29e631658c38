"""Near duplicates: a Jaccard join over word 5-grams by a MinHash LSH forest, verified exactly.

1. Every text becomes the set of its 5-grams of words (lower case; letters, digits and underscores make words), hashed
   to 64 bits. Texts with equal sets are copies: one of them stands for all, the others only count.
2. A representative's MinHash signature gives TREES labels of DEPTH levels, 16 bits each. Every tree is a prefix trie: its
   labels sorted, so that the rows below a node are neighbours. Spark deals them by tree and the first SHORTEST
   levels, the node above which no row has to climb, and sorts by the rest.
3. Rows meet at their longest common prefix. Prefixes then shorten level by level, for every row as far as the target
   recall asks: to the longest depth at which the least similar partner that a set of its size can have, at the
   threshold or more, shares a prefix with it in some tree. A set of seven grams has none below 6/7 and stops at
   depth 6, one of three has only copies, most stop at SHORTEST. A node whose rows are connected from below is done.
   Rows that meet are compared by signature, in blocks, and joined into families; of a node only a spanning forest is
   emitted, never its pairs. Connected families follow by passing on the smallest label. Pairs with less than LIKELY
   equal signature bytes are not joined here.
4. Within a family every pair is verified exactly on the sets rebuilt from the texts; a large family is split into
   blocks, and each pair of blocks is a group of its own. A group emits one row per document: how many links it has,
   and a representative that it is connected to. Classes are the connected components of the verified links.

So links are counted, not listed: a group of n near copies costs n rows per block, though n^2 comparisons.

The result is not exact: a pair at the threshold meets in no tree with probability 3.2e-6, and has less than LIKELY
equal signature bytes with probability 2.7e-6; it is lost unless others join its family. More similar pairs are lost less.

Defined results: null and empty texts, and texts without words, have no 5-grams and no links and are classes of their
own; a text of one to four words has one gram of all its words; a null doc_id stays null, in a class named by the
smallest other id if there is one; repeated rows are copies. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiloom.session import materialized

GRAM = 5
THRESHOLD = 0.8
TREES, DEPTH = 24, 6
TARGET_RECALL = 0.99999
#: Sets of so many hashes and more have partners as good as at the threshold.
_LARGE = 64
#: Share of equal signature bytes from which two representatives may be one family; links have 0.8 and more of them.
LIKELY = 0.6
#: Representatives compared with each other in one group; larger groups are split into pairs of blocks.
BLOCK = 300
SEED = 5
#: Odd multipliers of the rolling hash and of the mixing steps.
_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15 | 1), (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_OTHER = re.compile(r"[^\w\x00-\x7f]")
#: Hashes that are permuted at once.
_PIECE = 1 << 12


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


_LETTER = _mixed(np.arange(1, 257, dtype=np.uint64))
_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash per word of the text, in order."""
    text = text.lower()
    if not text.isascii():
        text = _OTHER.sub(" ", text)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.concatenate([[False], _IS_WORD[raw], [False]])
    starts, stops = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    if starts.size == 0:
        return np.zeros(0, np.uint64)
    # letters of a word weighed by powers of the base that restart with it
    inner = np.arange(raw.size) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [raw.size]])))
    longest = int((stops - starts).max())
    powers = np.cumprod(np.full(longest + 1, _BASE, np.uint64))
    terms = np.where(inside[1:-1], _LETTER[raw] * powers[np.minimum(inner, longest)], np.uint64(0))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    return _mixed(sums[stops] - sums[starts])


def grams(text: str | None) -> np.ndarray:
    """The sorted set of hashes of the text's 5-grams."""
    words = word_hashes(text) if text else np.zeros(0, np.uint64)
    if words.size == 0:
        return words
    n = min(GRAM, words.size)
    total = np.zeros(words.size - n + 1, np.uint64)
    for i in range(n):
        total = _mixed(total * _BASE + words[i : words.size - n + 1 + i])
    return np.unique(total)


def depth_for(recall: float = TARGET_RECALL, threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which a pair at the threshold meets in some tree with the recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


#: No row's prefix has to be shorter; Spark deals rows by this much of their labels.
SHORTEST = depth_for()


def least_similarity(size: int, threshold: float = THRESHOLD) -> float:
    """The smallest similarity, at the threshold or more, of a set of this size with another that is not equal; 1 if none."""
    least = 1.0
    for union in range(size, int(size / threshold + 1e-9) + 1):
        common = math.ceil(threshold * union - 1e-9)
        if common <= size and common < union:
            least = min(least, common / union)
    return least


_DEPTHS = np.array([SHORTEST if n >= _LARGE else depth_for(threshold=least_similarity(n)) for n in range(_LARGE + 1)])


def depths(sizes: np.ndarray) -> np.ndarray:
    """Per set size the depth to which prefixes are shortened."""
    return _DEPTHS[np.minimum(sizes, _LARGE)]


def _seeds(count: int) -> tuple[np.ndarray, np.ndarray]:
    made = np.random.default_rng(SEED).integers(1, 2**63, size=(2, count), dtype=np.uint64)
    return made[0] | np.uint64(1), made[1]


def signature(items: np.ndarray, count: int) -> np.ndarray:
    """The smallest of `count` permutations' values over a set of hashes."""
    multiply, add = _seeds(count)
    out = np.full(count, np.uint64(2**64 - 1))
    for i in range(0, items.size, _PIECE):
        out = np.minimum(out, (items[None, i : i + _PIECE] * multiply[:, None] + add[:, None]).min(axis=1))
    return out


def _by_key(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a stream that is sorted by the keys, one table each."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if table.num_rows == 0:
            continue
        columns = [table[k].combine_chunks().to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(table.num_rows, bool)
        for k, values in zip(keys, columns, strict=True):
            change[1:] |= values[1:] != values[:-1]
            if held and held[-1][k][-1].as_py() != values[0]:
                change[0] = True
        cuts = np.flatnonzero(change).tolist()
        at = 0
        for cut in cuts:
            if cut > at or held:
                part = [*held, table.slice(at, cut - at)] if cut > at else held
                held = []
                yield pa.concat_tables(part)
            at = cut
        held.append(table.slice(at))
    if held:
        yield pa.concat_tables(held)


def _grouped(rows: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.Table | None], schema: str, then: list[str] | None = None) -> DataFrame:
    """`work` on each group of rows with equal keys, sorted by `then`, streamed through sorted partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for group in _by_key(batches, keys):
            made = work(group)
            if made is not None and made.num_rows:
                held.append(made)
                size += made.num_rows
            if size > 20_000:
                yield from pa.concat_tables(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.concat_tables(held).combine_chunks().to_batches()

    return rows.repartition(*keys).sortWithinPartitions(*keys, *(then or [])).mapInArrow(run, schema)


def _roots(close: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links: the first member of each member's component."""
    root, todo = np.full(len(close), -1), np.ones(len(close), bool)
    for first in range(len(close)):
        if not todo[first]:
            continue
        front = np.zeros(len(close), bool)
        front[first] = True
        while front.any():
            todo &= ~front
            root[front] = first
            front = close[front].any(axis=0) & todo
    return root


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node connected to each node of the links (a, b).

    In every round a node takes the smallest node next to it, and links shrink to links between the nodes taken;
    links within one are dropped. Rounds end when none is left, after about the logarithm of the longest path.
    """
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    edges, placed = materialized(links.where("a <> b").select(*ends).distinct(), "edges"), None
    while True:
        turned = edges.union(edges.select("b", "a"))
        near = materialized(turned.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")).select("node", "label"), "near")
        jump = near.select(F.col("node").alias("label"), F.col("label").alias("far"))
        near = materialized(near.join(jump, "label").select("node", F.least("label", "far").alias("label")), "near")
        left = near.select(F.col("node").alias("a"), F.col("label").alias("la"))
        right = near.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        met = edges.join(left, "a").join(right, "b").where("la <> lb")
        edges = materialized(met.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(), "edges")
        if placed is None:
            placed = near
        else:
            later = near.select(F.col("node").alias("label"), F.col("label").alias("later"))
            placed = materialized(placed.join(later, "label", "left").select("node", F.coalesce("later", "label").alias("label")), "labels")
        if edges.isEmpty():
            return placed


def _labels(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per tree its label of a signature, 16 bits a level: the first SHORTEST levels as one number, those below as another."""
    levels = (_mixed(values) & np.uint64(0xFFFF)).reshape(TREES, DEPTH)
    top, below = np.zeros(TREES, np.uint64), np.zeros(TREES, np.uint64)
    for level in range(SHORTEST):
        top = top << np.uint64(16) | levels[:, level]
    for level in range(SHORTEST, DEPTH):
        below = below << np.uint64(16) | levels[:, level]
    # two levels at most lie below SHORTEST
    return top.view(np.int64), below.astype(np.uint32).view(np.int32)


def signed(docs: DataFrame) -> DataFrame:
    """Every row with `at` (its number), the digest of its gram set, and its signature: the labels of its trees (trees, tails)
    and one byte per hash of the first SHORTEST levels (marks).

    Columns besides text are kept in the struct `row`.
    """
    count = TREES * DEPTH

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, trees, tails, marks, sizes = [], [], [], [], []
            for text in batch.column("text"):
                items = grams(text.as_py())
                sizes.append(items.size)
                if items.size == 0:
                    digests.append(uuid.uuid4().bytes)
                    trees.append([])
                    tails.append([])
                    marks.append(b"")
                    continue
                digests.append(np.array([_mixed(items).sum(), _mixed(items ^ _MIX[1]).sum()], np.uint64).tobytes())
                values = signature(items, count)
                top, below = _labels(values)
                trees.append(top)
                tails.append(below)
                upper = _mixed(values.reshape(TREES, DEPTH)[:, :SHORTEST]) >> np.uint64(16)
                marks.append((upper & np.uint64(255)).astype(np.uint8).tobytes())
            made = [pa.array(digests, pa.binary()), pa.array(trees, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int32())), pa.array(marks, pa.binary()), pa.array(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, "digest", "trees", "tails", "marks", "grams"])

    row = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    numbered = docs.select(F.monotonically_increasing_id().alias("at"), F.col("doc_id").cast("long").alias("doc_id"), "text", row)
    schema = T.StructType([*numbered.schema.fields, T.StructField("digest", T.BinaryType()), T.StructField("trees", T.ArrayType(T.LongType())), T.StructField("tails", T.ArrayType(T.IntegerType())), T.StructField("marks", T.BinaryType()), T.StructField("grams", T.IntegerType())])
    return materialized(numbered.mapInArrow(sign, schema), "signed")


def _paired(rows: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Rows of groups larger than BLOCK dealt to pairs of blocks (low, high); `mine` says which block a row is of."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64(member), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    return rows.withColumn("mine", own).withColumn("other", other).withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other")).drop("other")


def _likely(marks: np.ndarray) -> np.ndarray:
    """Which rows are to be one family, as a matrix."""
    close = np.empty((len(marks), len(marks)), bool)
    step = max(1, 8_000_000 // marks.size)
    for i in range(0, len(marks), step):
        close[i : i + step] = np.count_nonzero(marks[i : i + step, None] == marks[None], axis=2) >= LIKELY * marks.shape[1]
    return close


def climbed(tails: np.ndarray, depth: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """For the rows below one node of a trie, sorted by what follows of their labels: the first row of each row's family.

    From the leaves up: at every level the rows of a node meet that still have to climb so far, unless they are
    connected already.
    """
    root, label = np.arange(tails.size), tails.astype(np.int64) & 0xFFFFFFFF
    for level in range(DEPTH, SHORTEST - 1, -1):
        node = label >> (16 * (DEPTH - level))
        cuts = np.flatnonzero(node[1:] != node[:-1]) + 1
        for first, last in zip([0, *cuts], [*cuts, tails.size], strict=True):
            met = np.arange(first, last)[depth[first:last] <= level]
            if met.size < 2 or (root[met] == root[met[0]]).all():
                continue
            for mine, other in zip(met, met[_roots(_likely(marks[met]))], strict=True):
                if root[mine] != root[other]:
                    low, high = sorted((root[mine], root[other]))
                    root[root == high] = low
    return root


def families(representatives: DataFrame) -> DataFrame:
    """at, family: representatives that may have links, by connected candidates. representatives: at, trees, tails, marks, grams."""

    def join_likely(group: pa.Table) -> pa.Table | None:
        if group.num_rows < 2:
            return None
        at = group["at"].to_numpy()
        marks = np.frombuffer(b"".join(group["marks"].to_pylist()), np.uint8).reshape(at.size, -1)
        root = climbed(group["tail"].to_numpy(), depths(group["grams"].to_numpy()), marks)
        child = root != np.arange(at.size)
        return pa.table({"a": at[child], "b": at[root[child]]}) if child.any() else None

    labels = F.posexplode(F.arrays_zip("trees", "tails")).alias("tree", "label")
    placed = representatives.select("at", labels).select("at", "tree", F.col("label.trees").alias("prefix"), F.col("label.tails").alias("tail"))
    # nodes of two and more rows; one row per node is counted on the map side
    crowded = placed.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    inside = placed.join(crowded, ["tree", "prefix"]).join(representatives.select("at", "marks", "grams"), "at")
    dealt = _paired(inside, ["tree", "prefix"], "at").select("tree", "prefix", "low", "high", "tail", "at", "marks", "grams")
    links = _grouped(dealt, ["tree", "prefix", "low", "high"], join_likely, "a long, b long", ["tail"])
    return components(links).select(F.col("node").alias("at"), F.col("label").alias("family"))


def verified(rows: DataFrame) -> DataFrame:
    """at, root, links: per representative and group of its family the links to others, and one that it is connected to.

    rows: family, members (representatives of the family), at, copies, text.
    """
    threshold = THRESHOLD

    def verify(group: pa.Table) -> pa.Table | None:
        if group.num_rows < 2:
            return None
        at, copies, mine = group["at"].to_numpy(), group["copies"].to_numpy(), group["mine"].to_numpy()
        sets = [grams(t) for t in group["text"].to_pylist()]
        size = np.array([s.size for s in sets])
        owner = np.repeat(np.arange(at.size), size)
        every, column = np.unique(np.concatenate(sets), return_inverse=True)
        uses = np.bincount(column, minlength=every.size)
        # grams of one document alone add to no intersection
        shared = np.cumsum(uses > 1) - 1
        kept = uses[column] > 1
        owner, column = owner[kept], shared[column[kept]]
        common = np.zeros((at.size, at.size), np.float32)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        last = int(column[-1]) + 1 if column.size else 0
        width = max(1, min(last, 16_000_000 // at.size))
        for first in range(0, last, width):
            a, b = np.searchsorted(column, [first, first + width])
            dense = np.zeros((at.size, width), np.float32)
            dense[owner[a:b], column[a:b] - first] = 1
            common += dense @ dense.T
        # in whole numbers, so that a similarity of exactly the threshold counts
        close = common.astype(np.float64) * (1 + threshold) >= threshold * (size[:, None] + size[None]) - 1e-6
        np.fill_diagonal(close, False)
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        root = _roots(close)
        if low != high:
            # pairs within one block are counted where the block meets itself
            close = close & (mine[:, None] != mine[None])
        return pa.table({"at": at, "root": at[root], "links": close @ copies.astype(np.int64)})

    dealt = _paired(rows, ["family"], "at")
    return _grouped(dealt.select("family", "low", "high", "mine", "at", "copies", "text"), ["family", "low", "high"], verify, "at long, root long, links long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of documents: doc_id, class_id, class_size, n_links and kept."""
    return classified(signed(docs)).drop("at")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of documents that stay: one of each class, with the smallest doc_id."""
    rows = signed(docs)
    kept = materialized(classified(rows).where("kept").select("at"), "kept")
    return rows.join(kept, "at", "left_semi").select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def classified(rows: DataFrame) -> DataFrame:
    """Per row of signed(): at, doc_id, class_id (the smallest doc_id of its class), class_size, n_links and kept.

    n_links: other rows whose similarity is the threshold or more; kept: the first row of its class.
    """
    groups = rows.groupBy("digest").agg(F.min("at").alias("rep"), F.count(F.lit(1)).alias("copies"))
    groups = materialized(groups, "copies")
    members = materialized(rows.select("at", "doc_id", "digest").join(groups, "digest").select("at", "doc_id", "rep", "copies"), "members")
    firsts = groups.select(F.col("rep").alias("at"), "copies")
    heads = materialized(rows.where("grams > 0").select("at", "trees", "tails", "marks", "grams").join(firsts, "at"), "representatives")
    family = materialized(families(heads.select("at", "trees", "tails", "marks", "grams")), "families")
    sizes = family.groupBy("family").agg(F.count(F.lit(1)).alias("members"))
    texts = family.join(sizes, "family").join(firsts, "at").join(rows.select("at", "text"), "at")
    found = materialized(verified(texts), "verified")
    counted = found.groupBy("at").agg(F.sum("links").alias("links"))
    linked = components(found.select(F.col("at").alias("a"), F.col("root").alias("b")))
    known = materialized(counted.join(linked, counted["at"] == linked["node"], "left").select(F.col("at").alias("rep"), "links", "label"), "linked")
    placed = materialized(members.join(known, "rep", "left").select(
        "at", "doc_id", F.coalesce("label", "rep").alias("class"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "at")).alias("first")
    classes = materialized(placed.groupBy("class").agg(first, F.count(F.lit(1)).alias("class_size")), "class_sizes")
    return placed.join(classes, "class").select(
        "at", "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", "n_links", (F.col("at") == F.col("first.at")).alias("kept"))
