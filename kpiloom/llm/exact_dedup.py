"""Exact duplicates by a persistent digest index.

The index is a Parquet table bucketed and sorted by digest: (digest, keep_id, batch), one row per distinct text ever
seen. A batch is reduced to one row per digest before it is shuffled, meets the index in a sort-merge anti-join
that leaves the index where it lies, and what the index does not know is appended.

Every batch has a name. Rows that the index has from a batch of that name count as unknown, so a batch that was interrupted
after its texts were appended is added again under its name and gets the answers it got at first.

Defined results
- Texts are equal when identical after each run of ASCII white space becomes one space; null counts as empty.
- Of equal rows in one batch the smallest doc_id stays; a null doc_id is larger than any other, and of rows that
  also share the doc_id one stays (the first as the batch was read).
- A text the index knows from another batch is never kept again; its keep_id is the one stored.
- An empty batch gives an empty result. Other columns pass through; a column that has the name of a result
  column is replaced by it.
- The number of buckets is stored beside the index; opening it with another one is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.session import materialized
from kpiloom.sources.reports import exists


def normalised(text: Column) -> Column:
    """The text with every run of ASCII white space as one space; null as empty."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.regexp_replace(spaced, " {2,}", " ")


class DigestIndex:
    """A digest table at a path, known to the planner under a name while it is open."""

    def __init__(self, spark: SparkSession, table: str, path: str, buckets: int | None = None):
        """Opens the index at the path, or makes an empty one. `buckets` only matters when it is made."""
        self.spark, self.table = spark, table
        layout = f"{path}/layout"
        stored = spark.read.schema("buckets int").json(layout).first()["buckets"] if exists(spark, layout) else None
        if stored and buckets and stored != buckets:
            raise ValueError(f"the index at {path} has {stored} buckets, not {buckets}")
        self.buckets = stored or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if not stored:
            spark.range(1).select(F.lit(self.buckets).alias("buckets")).write.json(layout)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} (digest BINARY, keep_id BIGINT, batch STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}/rows'"
        )

    def __enter__(self) -> DigestIndex:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Takes the name out of the catalog; the files stay, and results of add() stay readable."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, docs: DataFrame, batch: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
        """Each row of the batch with keep_id, group_size (rows of the batch with its text), kept and text_sha256.

        `batch` names the batch; a rerun of it has the same name, and no other batch has.
        """
        made = ("keep_id", "group_size", "kept", "text_sha256")
        own = [c for c in docs.columns if c not in made]
        keyed = materialized(
            docs.select(
                F.struct(*own).alias("row"),
                F.unhex(F.sha2(normalised(F.col(text_column)).cast("binary"), 256)).alias("digest"),
                F.struct(F.col(id_column).isNull(), F.col(id_column).cast("long").alias("id"), F.monotonically_increasing_id().alias("at")).alias("place"),
            ),
            "keyed",
        )
        groups = materialized(keyed.groupBy("digest").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("group_size")), "groups")
        index = self.entries().hint("merge")
        elsewhere, before = index.where(F.col("batch") != batch), index.where(F.col("batch") == batch)
        fresh = groups.join(elsewhere, "digest", "left_anti").select(
            "digest", "group_size", F.col("first.at").alias("first_at"), F.col("first.id").alias("keep_id"), F.lit(True).alias("is_new"))
        old = groups.join(elsewhere, "digest").select("digest", "group_size", F.lit(None).cast("long").alias("first_at"), "keep_id", F.lit(False).alias("is_new"))
        settled = materialized(fresh.union(old), "settled")
        self._append(settled.where("is_new").join(before, "digest", "left_anti").select("digest", "keep_id", F.lit(batch).alias("batch")))
        return keyed.join(settled, "digest").select(
            "row.*", "keep_id", "group_size",
            F.coalesce(F.col("place.at") == F.col("first_at"), F.lit(False)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def _append(self, rows: DataFrame) -> None:
        rows.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table)


def in_two_batches(docs: DataFrame, id_column: str = "doc_id") -> dict[str, DataFrame]:
    """The rows up to the middle of the ids, and those beyond it or without an id, by batch name: an id to be kept comes no later than its copies."""
    ends = docs.agg(F.min(id_column).alias("low"), F.max(id_column).alias("high")).first()
    if ends["low"] is None:
        return {"all": docs}
    early = F.coalesce(F.col(f"`{id_column}`") <= (ends["low"] + ends["high"]) // 2, F.lit(False))
    return {"early": docs.where(early), "late": docs.where(~early)}
