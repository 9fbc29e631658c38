"""Documents to packed training sequences: drop toxic ones, exact copies and near copies, mix the sources, pack.

Every stage takes the documents that the one before kept and returns documents, the last one packed pieces. Stages are
written as Parquet under the shared folder and read again, so a stage that fails is repeated from its own input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import exact_dedup, mixing, near_dup, packing, queries, toxicity
from kpiloom.session import materialized, scratch_path, ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; learned from the labels of the documents given."""
    model = queries.toxicity_model(spark, docs, sf_dir)
    return toxicity.scored(docs, model).where("NOT toxic").select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the smallest doc_id."""
    path = scratch_path(spark, "digests")
    with exact_dedup.DigestIndex(spark, "digests_" + path.rsplit("-", 1)[1], path) as index:
        added = [index.add(batch, name) for name, batch in exact_dedup.in_two_batches(docs).items()]
    return reduce(DataFrame.union, added).where("kept").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the smallest doc_id."""
    ship_package(spark)
    return near_dup.without_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once or twice."""
    keyed = docs.withColumn("__row", F.xxhash64("doc_id", "source", "text"))
    rows = keyed.select("doc_id", "__row", "source", mixing.word_count(F.col("text")).alias("size"))
    # documents equal in id, source and text share a decision, so that every row of them is met once
    taken = mixing.mixed(rows).groupBy(F.col("doc_id").alias("__id"), F.col("__row").alias("__other")).agg(F.max("copies").alias("__copies"))
    taken = materialized(taken.where("__copies > 0"), "copies")
    met = keyed.join(taken, (F.col("__row") == F.col("__other")) & F.col("doc_id").eqNullSafe(F.col("__id")))
    return met.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__copy")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with the sequence they are packed into and their offset there."""
    ship_package(spark)
    rows = docs.select("doc_id", "source", "lang", "text")
    cut = packing.pieces(rows, queries.vocabulary("word_bpe_49k.json"), "<|startoftext|>", False, end_id=0, length=queries.SEQUENCE)
    return packing.packed(cut, queries.SEQUENCE)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The first stage applies a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
