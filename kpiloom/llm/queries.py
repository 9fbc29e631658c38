"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.llm import ann, decontam, exact_dedup, expected, html_extract, langid, manifest, mixing, near_dup, packing, runs, sharding, toxicity, wavelet
from kpiloom.session import materialized, scratch_path, ship_package

SHARDS = 8
SEED = 20240601
#: Tokens of a packed sequence.
SEQUENCE = 2048


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_shards(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = table(spark, folder, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.shuffled_shards(rows, SHARDS, SEED).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op2_mix(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    return mixing.mixed(rows).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "source", "rate", "copies")


def op3_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    return html_extract.extracted(pages, html_extract.default_model())


def toxicity_model(spark: SparkSession, docs: DataFrame, folder: str) -> toxicity.SeverityModel:
    grades = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("grade"))
    return toxicity.fit(docs, grades, graded_by_count=True)


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.scored(docs, toxicity_model(spark, docs, folder)).select("doc_id", "severity", "toxicity", "toxic")


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op6_wavelet(spark: SparkSession, folder: str) -> DataFrame:
    shards = wavelet.write_shards(table(spark, folder, "documents"), scratch_path(spark, "wavelet"), vocabulary("byte_bpe_50k.json"), "<|endoftext|>", True, end_id=2)
    return wavelet.read_documents(shards)


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    network = langid.fit(docs.select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "text")
    return langid.identified(rows, network)


def op8_pack(spark: SparkSession, folder: str) -> DataFrame:
    rows = packing.pieces(table(spark, folder, "documents").select("doc_id", "text"), vocabulary("word_bpe_49k.json"), "<|startoftext|>", False, end_id=0, length=SEQUENCE)
    return packing.packed(rows, SEQUENCE)


def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    index, centre, size = ann.build(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    return ann.search(index, index.where(F.col("vec_id") % 100 == 0), centre, size, k=10)


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The documents come in two batches; copies are counted over both."""
    path = scratch_path(spark, "digests")
    with exact_dedup.DigestIndex(spark, "digests_" + path.rsplit("-", 1)[1], path) as index:
        batches = exact_dedup.in_two_batches(table(spark, folder, "documents").select("doc_id", "text"))
        added = [index.add(docs, name).drop("text", "group_size") for name, docs in batches.items()]
    rows = materialized(reduce(DataFrame.union, added), "deduplicated")
    sizes = rows.groupBy(F.col("text_sha256").alias("of")).agg(F.count(F.lit(1)).alias("group_size"))
    return rows.join(sizes, F.col("text_sha256") == F.col("of")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def planted_runs(docs: DataFrame) -> DataFrame:
    """Documents whose id's checksum is divisible by ten repeat their words from some place on, with some period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        start = F.pmod(g, n)
        period = 1 + F.floor((n - start) / (3 + F.pmod(g, F.lit(8))))
        place = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < start, i).otherwise(start + F.pmod(i - start, period)).cast("int"))
        return F.when(n > 0, F.array_join(F.transform(place, lambda i: F.get(words, i)), " "))

    # the words are bound by a lambda, so that they are cut once a text and not once a word
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    changed = F.transform(F.array(words), repeated)[0]
    return docs.withColumn("text", F.when(h % 10 == 0, F.coalesce(changed, F.col("text"))).otherwise(F.col("text")))


def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = planted_runs(table(spark, folder, "documents").select("doc_id", "text"))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    return runs.with_runs(docs, keep=["doc_id"]).withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"), (-F.col("longest.less")).alias("length"), F.col("longest.period").alias("period"),
        F.expr("-longest.less * 1000 div longest.period").alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontam.overlaps(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark"), keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", decontam.covered(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    shown = F.when(tampered, F.translate("text", ascii_uppercase, ascii_lowercase)).otherwise(F.col("text"))
    leaves = manifest.leaves_of(docs, ["doc_id", "source", "lang", "n_chars", "text"], "doc_id", "source", {"text": shown})
    return manifest.climbed(manifest.build(leaves)).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shards": op1_shards,
    "op2_mix": op2_mix,
    "op3_main_text": op3_main_text,
    "op4_toxicity": op4_toxicity,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_wavelet": op6_wavelet,
    "op7_language": op7_language,
    "op8_pack": op8_pack,
    "op9_neighbours": op9_neighbours,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_runs": op11_runs,
    "op12_decontaminate": op12_decontaminate,
    "op13_manifest": op13_manifest,
}


def _network_sql(inner: str) -> str:
    """One pass of the permutation over the column v of a relation that has low, high and n."""
    for multiplier, offset in sharding.round_keys(SEED):
        inner = (
            f"SELECT row_number, n, (r << high) | xor(v >> low, (m2 >> 13) & ((1::BIGINT << high) - 1)) AS v, high AS low, low AS high FROM ("
            f"SELECT *, (xor(m1, m1 >> 15) & 2147483647) * {multiplier} AS m2 FROM (SELECT *, r * {multiplier} + {offset} AS m1 FROM ("
            f"SELECT *, v & ((1::BIGINT << low) - 1) AS r FROM ({inner}))))")
    return inner


#: CRC-32 byte by byte over a table of 256 remainders, the order by digest, and the walk as a recursion.
_SHARDS_SQL = f"""
    WITH RECURSIVE remainders AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
          lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
    raw AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS size, hex(encode(coalesce(text, ''))) AS x FROM documents),
    bytes AS (SELECT doc_id, size, list_transform(range(size), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT) AS b FROM raw),
    sums AS (SELECT doc_id, size + 1 AS size, xor(list_reduce(list_prepend(4294967295, b), lambda a, y: xor(a >> 8, t[(xor(a, y) & 255) + 1])), 4294967295)::BIGINT AS text_crc32
      FROM bytes, remainders),
    keyed AS (SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '~') || '|' || size || '|' || text_crc32), 1, 15))::BIGINT AS digest FROM sums),
    ranked AS (SELECT *, row_number() OVER (ORDER BY digest, doc_id NULLS FIRST, size, text_crc32) - 1 AS row_number, count(*) OVER () AS n FROM keyed),
    domain AS (SELECT row_number, n, row_number AS v, b // 2 AS low, b - b // 2 AS high FROM (SELECT *, greatest(2, ceil(log2(greatest(n, 2)))::BIGINT) AS b FROM ranked)),
    walk AS ({_network_sql("SELECT row_number, n, v, low, high FROM domain")}
      UNION ALL {_network_sql("SELECT row_number, n, v, low, high FROM walk WHERE v >= n")})
    SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (v % {SHARDS})::INTEGER AS shard, v // {SHARDS} AS slot, NULL::INTEGER AS grown_shard, row_number
    FROM ranked JOIN walk USING (row_number) WHERE v < ranked.n"""

ORACLES: dict[str, str] = {
    "op1_shards": _SHARDS_SQL,
    "op9_neighbours": """
        WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        d AS (SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda p: (p[2] - p[1]) * (p[2] - p[1])), lambda a, b: a + b)) AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM d)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op10_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
        FROM d WINDOW w AS (PARTITION BY text_sha256)""",
    "op12_decontaminate": expected.decontamination(decontam.WINDOW),
    "op13_manifest": expected.manifest(manifest.FAN),
}
