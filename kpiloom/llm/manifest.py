"""A Merkle manifest of a dataset: levels of digests stored as parent-linked rows, climbed by a recursive query.

Every row is a leaf: the SHA-256 of its fields, each written as its byte count, a colon and its value (`-` for null).
The leaves of a branch (say, of a source) are ordered by id and numbered; every 16 consecutive nodes are hashed to
their parent until one is left, the branch's root. These roots, in the order of the branches, are hashed likewise to
the root of the dataset. Built levels are rows (node, parent, slot, digest, kids), one row per inner node.

A check climbs them with WITH RECURSIVE: a step meets the parent's row, appends the siblings and folds the digest at
hand with them. All leaves of one lowest run share their way from there on, so a row of the climb is one run with its
leaves: each leaf keeps a folded digest of its own, while siblings above the run are held once.

At scale
- Numbers come from a range partitioning, a place in the partition and the counts of the partitions before it.
- The rows above are a sixteenth of the leaves at each level. Every step of the climb joins on node and chunk, a chunk
  being 4,096 runs of a branch; nodes above several chunks are repeated once per chunk (one row in 65,536 leaves
  per level), so that the root, which every run climbs to, is no hot key.

Defined results
- A null id comes first and is an id of its own. Rows equal in branch and id are ordered by their digests; rows equal in
  all fields are interchangeable. A null branch is a branch, ordered first; branches are ordered by their UTF-8 bytes.
- A branch with one leaf has that leaf as its root; with one branch its root is that of the dataset. No rows: no result.
- Only the named fields count; other columns, whatever their names, neither matter nor pass through.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpiloom.session import materialized

#: Children of a node.
FAN = 16
#: Runs of a branch that climb together in one key of the joins; a power of FAN.
CHUNK = 4096


def _hash(parts: list[Column]) -> Column:
    return F.sha2(F.concat(*parts), 256)


def row_digest(values: list[Column]) -> Column:
    """SHA-256 of the values' texts, each led by its number of bytes; `-` stands for a null."""
    texts = [v.cast("string") for v in values]
    return _hash([F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def leaves_of(docs: DataFrame, fields: list[str], id_column: str, branch: str, presented: Mapping[str, Column] | None = None) -> DataFrame:
    """id, branch, leaf, presented: the digests of each row as it was stored, and as it is presented for a check.

    ``presented`` names columns that differ in the copy to be checked, as expressions over the stored row.
    """
    changed = {c: F.col(f"`{c}`") for c in fields} | dict(presented or {})
    return docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{branch}`").cast("string").alias("branch"), row_digest([F.col(f"`{c}`") for c in fields]).alias("leaf"),
        row_digest([changed[c] for c in fields]).alias("presented"))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds number, from 0 within each group in the given order, and total, the rows of the group."""
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(group, *order, "tie").sortWithinPartitions(group, *order, "tie").drop("tie")
    dealt = materialized(dealt.withColumn("at", F.monotonically_increasing_id()), "dealt")
    part = F.shiftrightunsigned("at", 33).alias("part")
    # one row per group and partition; a group's rows lie side by side in a partition
    spans = dealt.groupBy(part, F.col(group).alias("of")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("of")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("part", "of", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("total"))
    met = dealt.withColumn("in_part", part).join(spans, (F.col("in_part") == F.col("part")) & F.col(group).eqNullSafe(F.col("of")))
    return met.select(*rows.columns, (F.col("at") + F.col("shift")).alias("number"), "total")


def _node(tree: Column, level: int, number: Column) -> Column:
    return F.concat(tree, F.lit(f"/{level}/"), number.cast("string"))


def _above(number: Column) -> Column:
    return F.floor(number / F.lit(FAN)).cast("long")


def _levels(bottom: DataFrame, level: int, widest: int) -> list[DataFrame]:
    """The levels over rows (tree, number, width, digest) of a level, `width` nodes wide per tree, until each tree has one."""
    found = []
    while widest > 1:
        level, widest = level + 1, -(-widest // FAN)
        gathered = bottom.where("width > 1").groupBy("tree", _above(F.col("number")).alias("number"), "width").agg(
            F.array_sort(F.collect_list(F.struct("number", "digest"))).alias("kids"))
        bottom = _level(gathered.withColumn("kids", F.col("kids.digest")), level)
        found.append(bottom)
    return found


def _level(gathered: DataFrame, level: int) -> DataFrame:
    """Nodes of a level from (tree, number, width of the level below, kids)."""
    rows = gathered.select(
        "tree", F.lit(level).alias("level"), "number", F.ceil(F.col("width") / F.lit(FAN)).cast("long").alias("width"), "kids",
        F.sha2(F.array_join("kids", ""), 256).alias("digest"))
    return materialized(rows, "level")


@dataclass(frozen=True)
class Manifest:
    """runs: one row per lowest run, where a climb starts. nodes: node, chunk, parent, slot, is_top, kids, digest."""

    runs: DataFrame
    nodes: DataFrame


def build(leaves: DataFrame) -> Manifest:
    """Numbers the leaves, hashes the levels and links them; both tables lie in the shared folder."""
    leaves = materialized(leaves, "leaves")
    placed = numbered(leaves, "branch", ["id", "leaf", "presented"])
    tree = F.when(F.col("branch").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), F.col("branch")))
    runs = placed.groupBy("branch", tree.alias("tree"), _above(F.col("number")).alias("number"), F.col("total").alias("width")).agg(
        F.array_sort(F.collect_list(F.struct("number", "id", "leaf", "presented"))).alias("leaves"))
    runs = materialized(runs, "runs")
    widest = runs.agg(F.max("width")).first()[0] or 0
    first = _level(runs.where("width > 1").select("tree", "number", "width", F.col("leaves.leaf").alias("kids")), 1)
    levels = [first, *_levels(first, 1, -(-widest // FAN))]
    names = ("tree", "level", "number", "width", "kids", "digest")
    inner = reduce(DataFrame.union, [x.select(*names) for x in levels])

    # the roots of the branches are the lowest level of the tree of branches
    branches = runs.where("number = 0").select("branch", "tree", F.ceil(F.col("width") / F.lit(FAN * CHUNK)).cast("long").alias("chunks"), (F.col("width") == 1).alias("single"),
                                               F.col("leaves")[0]["leaf"].alias("only"))
    tops = branches.join(inner.where("width = 1").select(F.col("tree").alias("of"), "digest"), F.col("tree") == F.col("of"), "left")
    tops = tops.select(F.lit(0).alias("all"), "branch", "tree", "chunks", F.when(F.col("single"), F.col("only")).otherwise(F.col("digest")).alias("digest"))
    tops = materialized(numbered(tops, "all", ["branch"]).withColumnsRenamed({"number": "rank", "total": "width"}), "tops")
    count = tops.count()
    upper = _levels(tops.select(F.lit("all").alias("tree"), F.col("rank").alias("number"), "width", "digest"), 0, count)

    # parents: in the branch, else in the tree of branches, else none
    joined = inner.join(tops.select(F.col("tree").alias("of"), "rank"), (F.col("tree") == F.col("of")) & (F.col("width") == 1), "left")
    branch_nodes = joined.select(
        _node_of("tree").alias("node"), F.explode(_chunks_below()).alias("chunk_number"), "tree",
        F.when(F.col("width") > 1, _parent_of("tree")).otherwise(_top_parent(count)).alias("parent"),
        F.when(F.col("width") > 1, F.col("number") % FAN).when(F.lit(count > 1), F.col("rank") % FAN).cast("int").alias("slot"),
        (F.col("width") == 1).alias("is_top"), "kids", "digest",
    ).withColumn("chunk", _chunk(F.col("tree"), F.col("chunk_number")))
    linked = [branch_nodes]
    chunks = tops.select("rank", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk_number"), F.col("tree").alias("of"))
    for at, nodes in enumerate(upper, 1):
        below = chunks.select(F.floor(F.col("rank") / F.lit(FAN**at)).cast("long").alias("over"), _chunk(F.col("of"), F.col("chunk_number")).alias("chunk"))
        last = at == len(upper)
        linked.append(nodes.join(below, F.col("number") == F.col("over")).select(
            _node(F.col("tree"), at, F.col("number")).alias("node"), "chunk", F.lit(None).cast("string").alias("parent") if last else _node(F.col("tree"), at + 1, _above(F.col("number"))).alias("parent"),
            F.lit(None).cast("int").alias("slot") if last else (F.col("number") % FAN).cast("int").alias("slot"), F.lit(False).alias("is_top"), "kids", "digest"))
    columns = ("node", "chunk", "parent", "slot", "is_top", "kids", "digest")
    nodes = materialized(reduce(DataFrame.union, [x.select(*columns) for x in linked]), "nodes")

    # a branch of a single leaf has no node of its own: its run starts at the tree of branches
    lone = runs.where("width = 1").join(tops.select(F.col("tree").alias("of"), "rank"), F.col("tree") == F.col("of")).select(
        "tree", "number", "leaves", _top_parent(count).alias("parent"), (F.col("rank") % FAN if count > 1 else F.lit(None)).cast("int").alias("slot"), F.lit(True).alias("lone"))
    others = runs.where("width > 1").select("tree", "number", "leaves", _node(F.col("tree"), 1, F.col("number")).alias("parent"), F.lit(None).cast("int").alias("slot"), F.lit(False).alias("lone"))
    starts = others.union(lone).withColumn("chunk", _chunk(F.col("tree"), F.floor(F.col("number") / F.lit(CHUNK))))
    return Manifest(starts, nodes)


def _node_of(tree: str) -> Column:
    return F.concat(F.col(tree), F.lit("/"), F.col("level").cast("string"), F.lit("/"), F.col("number").cast("string"))


def _parent_of(tree: str) -> Column:
    return F.concat(F.col(tree), F.lit("/"), (F.col("level") + 1).cast("string"), F.lit("/"), _above(F.col("number")).cast("string"))


def _top_parent(branches: int) -> Column:
    """Where a branch's root hangs: the first level of the tree of branches, if there is more than one branch."""
    return _node(F.lit("all"), 1, _above(F.col("rank"))) if branches > 1 else F.lit(None).cast("string")


def _chunk(tree: Column, number: Column) -> Column:
    return F.concat(tree, F.lit("#"), number.cast("long").cast("string"))


def _chunks_below() -> Column:
    """The chunks of runs under a node of a branch: a node of level l has 16^(l-1) runs, and there are at most 16^(l-1) x width of them.

    The last node of a level may span fewer; chunk numbers beyond the last run meet no run.
    """
    runs = F.pow(F.lit(float(FAN)), F.col("level") - 1)
    first = F.floor(F.col("number") * runs / CHUNK).cast("long")
    last = F.floor(((F.col("number") + 1) * runs - 1) / CHUNK).cast("long")
    # a node that is filled in part has fewer runs: its kids bound their number
    most = F.floor((F.col("number") * runs + F.size("kids") * runs / FAN - 1) / CHUNK).cast("long")
    return F.sequence(first, F.greatest(first, F.least(last, most)))


_CLIMB = """
    WITH RECURSIVE climb AS (
      SELECT tree, number, chunk, leaves, '' AS above, subroot, reached, parent, slot FROM {start}
      UNION ALL
      SELECT tree, number, chunk, transform(leaves, x -> named_struct('id', x.id, 'leaf', x.leaf, 'folded', sha2(concat(earlier, x.folded, later), 256))) AS leaves,
        concat(above, earlier, later) AS above, subroot, reached, parent, slot
      FROM (SELECT c.tree, c.number, c.chunk, c.leaves, c.above, array_join(slice(n.kids, 1, c.slot), '') AS earlier, array_join(slice(n.kids, c.slot + 2, {fan}), '') AS later,
          CASE WHEN n.is_top THEN n.digest ELSE c.subroot END AS subroot, n.digest AS reached, n.parent, n.slot
        FROM climb c JOIN {nodes} n ON c.chunk = n.chunk AND c.parent = n.node))
    SELECT tree, number, leaves, above, subroot, reached AS root FROM climb WHERE parent IS NULL"""


def climbed(manifest: Manifest) -> DataFrame:
    """Per leaf: id, leaf, subroot, root, proof (the siblings' digests upward, joined), folded_root (from the presented digest) and verified."""
    spark: SparkSession = manifest.nodes.sparkSession
    starts = manifest.runs
    # the first step: inside a lowest run every leaf has its own slot
    before = "array_join(slice(leaves.leaf, 1, i), '')"
    after = f"array_join(slice(leaves.leaf, i + 2, {FAN}), '')"
    folds = F.expr(f"transform(leaves, (x, i) -> named_struct('id', x.id, 'leaf', x.leaf, 'folded', CASE WHEN lone THEN x.presented ELSE sha2(concat({before}, x.presented, {after}), 256) END))")
    first = starts.select("tree", "number", "chunk", folds.alias("leaves"), "parent", "slot", "lone")
    met = first.join(manifest.nodes.select(F.col("node").alias("at"), F.col("parent").alias("next"), F.col("slot").alias("next_slot"), "is_top", F.col("digest").alias("sum")),
                     ~F.col("lone") & (F.col("parent") == F.col("at")), "left")
    lone_leaf = F.col("leaves")[0]["leaf"]
    start = materialized(met.select(
        "tree", "number", "chunk", "leaves", F.when(F.col("lone"), lone_leaf).when(F.col("is_top"), F.col("sum")).alias("subroot"),
        F.when(F.col("lone"), lone_leaf).otherwise(F.col("sum")).alias("reached"), F.when(F.col("lone"), F.col("parent")).otherwise(F.col("next")).alias("parent"),
        F.when(F.col("lone"), F.col("slot")).otherwise(F.col("next_slot")).alias("slot")), "starts")
    # Spark stops a recursion at a million rows unless told otherwise; it ends by itself where no node has a parent
    limit = "spark.sql.cteRecursionRowLimit"
    earlier = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        done = materialized(spark.sql(_CLIMB.replace("{fan}", str(FAN)), start=start, nodes=manifest.nodes), "climbed")
    finally:
        spark.conf.unset(limit) if earlier is None else spark.conf.set(limit, earlier)
    each = done.select("subroot", "root", "above", F.col("leaves.leaf").alias("run"), F.posexplode("leaves").alias("at", "own"))
    siblings = F.concat(F.expr("array_join(slice(run, 1, at), '')"), F.expr(f"array_join(slice(run, at + 2, {FAN}), '')"), F.col("above"))
    return each.select(
        F.col("own.id").alias("id"), F.col("own.leaf").alias("leaf"), "subroot", "root", siblings.alias("proof"), F.col("own.folded").alias("folded_root"),
        (F.col("own.folded") == F.col("root")).alias("verified"))
