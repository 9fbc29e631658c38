"""Toxicity as severity grades by cumulative-link ordinal regression.

P(grade >= k) = sigmoid(w.x - theta_k) with ordered thresholds theta and one weight vector shared by all of them; the
expected severity is the sum of those probabilities over the grades. Features are sparse: words and word beginnings
that occur in graded documents of grade 1 and above far more often than in others. Each counts as log2(1 + n).

The model is fitted on a bounded sample: at most SAMPLE_TOXIC documents with a grade above 0 and SAMPLE_CLEAN with
grade 0, those with the smallest digests of their ids; of several rows with one id, the text with the smallest digest.
Of the features that qualify in it, the MOST_FEATURES that tell most about the grade are used. Everything else covers whole texts of
all documents.

A word of a document that was copied often looks typical of its label. So a feature must also occur between enough
different neighbouring words: copies repeat their neighbours.

Defined results: null and empty texts have no features and the lowest severity; without graded documents of both
kinds the model has no features and nothing is toxic; rows whose grade or id is null are not learned from; repeated
labels count once, the highest; other columns pass through.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.session import materialized

SAMPLE_TOXIC, SAMPLE_CLEAN = 4000, 8000
#: A feature must be in that many toxic documents, between that many pairs of neighbours, and that share of the sampled
#: documents it is in must be toxic; that this share differs from the sample's must gain that much log likelihood, which
#: less than one of a million features does by chance.
LEAST_DOCUMENTS, LEAST_CONTEXTS, LEAST_SHARE, LEAST_GAIN = 4, 4, 0.75, 13.0
#: Of more features than this, those with the highest scores are taken.
MOST_FEATURES = 20_000
PREFIXES = (4, 5, 6)
#: Occurrences of typical words from which a document of a two-valued label has grade 2, and grade 3.
GRADE_STEPS = (3, 6)
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def features(word: str) -> list[str]:
    """The word, and beginnings of longer words, marked by a star."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


@dataclass
class SeverityModel:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=lambda: [30.0])

    def severity(self, text: str | None) -> tuple[float, float]:
        """Expected severity and the probability of a grade of 1 or more."""
        score = 0.0
        if self.weights:
            found = _counts(text, self.weights)
            score = sum(self.weights[f] * np.log2(1 + n) for f, n in found.items())
        above = [1 / (1 + np.exp(min(500.0, t - score))) for t in self.thresholds]
        return float(sum(above)), float(above[0])


def _counts(text: str | None, known) -> Counter:
    found: Counter = Counter()
    for word, n in Counter(words(text)).items():
        for f in features(word):
            if f in known:
                found[f] += n
    return found


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str | None, int]]:
    for batch in batches:
        yield from zip(batch.column("text").to_pylist(), batch.column("grade").to_pylist(), strict=True)


def sample(docs: DataFrame, grades: DataFrame) -> DataFrame:
    """Bounded sample of graded documents: text, grade; one row for each id. grades: doc_id, grade."""
    graded = grades.where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = graded.where("grade > 0").orderBy(*order).limit(SAMPLE_TOXIC).union(graded.where("grade <= 0").orderBy(*order).limit(SAMPLE_CLEAN))
    # at most SAMPLE_TOXIC + SAMPLE_CLEAN rows of two numbers
    met = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    # copies of an id are combined on the map side
    return met.groupBy("doc_id").agg(F.min_by("text", F.sha2("text", 256)).alias("text"), F.max("grade").alias("grade")).select("text", "grade")


def fit(docs: DataFrame, grades: DataFrame, graded_by_count: bool = False) -> SeverityModel:
    """Fits on documents (doc_id, text) and grades (doc_id, grade).

    graded_by_count: the grades only say 0 or 1; a document with grade 1 then gets 1, 2 or 3 by how often typical words
    occur in it.
    """
    spark = docs.sparkSession
    learned = materialized(sample(docs, grades).repartition(spark.sparkContext.defaultParallelism), "graded")
    totals = {bool(r["bad"]): r["n"] for r in learned.groupBy((F.col("grade") > 0).alias("bad")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        return SeverityModel()

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, good = Counter(), Counter()
        for text, grade in _rows(batches):
            (bad if grade > 0 else good).update({f for w in set(words(text)) for f in features(w)})
        known = list(bad.keys() | good.keys())
        yield pa.RecordBatch.from_pydict({"feature": pa.array(known, pa.string()), "bad": pa.array([bad[f] for f in known], pa.int64()), "good": pa.array([good[f] for f in known], pa.int64())})

    counted = learned.mapInArrow(document_counts, "feature string, bad long, good long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    bad, good = F.col("bad"), F.col("good")
    share = totals[True] / (totals[True] + totals[False])
    gain = bad * F.log(bad / ((bad + good) * share)) + F.when(good > 0, good * F.log(good / ((bad + good) * (1 - share)))).otherwise(0.0)
    often = counted.where((bad >= LEAST_DOCUMENTS) & (bad >= LEAST_SHARE * (bad + good)))
    ranked = often.withColumn("gain", gain).where(F.col("gain") >= LEAST_GAIN).orderBy(F.desc("gain"), "feature").limit(MOST_FEATURES)
    typical = {r["feature"] for r in ranked.select("feature").collect()}

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = set()
        for text, grade in _rows(batches):
            if grade > 0:
                own = ["", *words(text), ""]
                rows |= {(f, own[i - 1] + " " + own[i + 1]) for i in range(1, len(own) - 1) for f in features(own[i]) if f in typical}
        yield pa.RecordBatch.from_pydict({"feature": pa.array([r[0] for r in rows], pa.string()), "context": pa.array([r[1] for r in rows], pa.string())})

    spread = learned.mapInArrow(neighbours, "feature string, context string").distinct().groupBy("feature").count().where(F.col("count") >= LEAST_CONTEXTS)
    known = {r["feature"]: i for i, r in enumerate(spread.orderBy("feature").collect())}

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, grade in _rows(batches):
            counts = _counts(text, known)
            occurrences = sum(n for w, n in Counter(words(text)).items() if any(f in known for f in features(w))) if counts else 0
            yield pa.RecordBatch.from_pydict({
                "grade": pa.array([grade], pa.int32()), "at": pa.array([[known[f] for f in counts]], pa.list_(pa.int32())),
                "n": pa.array([[float(np.log2(1 + v)) for v in counts.values()]], pa.list_(pa.float64())), "occurrences": pa.array([occurrences], pa.int64())})

    rows = learned.mapInArrow(found, "grade int, at array<int>, n array<double>, occurrences long").collect()
    rows.sort(key=lambda r: (r["grade"], r["at"], r["n"]))
    level = np.array([r["grade"] for r in rows])
    if graded_by_count:
        seen = np.array([r["occurrences"] for r in rows])
        level = np.where(level > 0, 1 + sum((seen >= s).astype(int) for s in GRADE_STEPS), 0)
    weights, thresholds = ordinal_fit([r["at"] for r in rows], [r["n"] for r in rows], level, len(known))
    return SeverityModel({f: float(weights[i]) for f, i in known.items()}, [float(t) for t in thresholds])


def ordinal_fit(at: list[list[int]], values: list[list[float]], grades: np.ndarray, size: int, penalty: float = 1e-4, steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by Adam on the mean negative log likelihood with an L2 penalty.

    Thresholds are a first one and the exponentials of their gaps, so they stay in order.
    """
    row = np.repeat(np.arange(len(at)), [len(a) for a in at])
    column, value = np.array([c for a in at for c in a], np.int64), np.array([v for vs in values for v in vs], float)
    top = max(1, int(grades.max(initial=1)))
    say = 1.0 / max(1, len(at))
    x = np.zeros(size + top)
    x[size] = 2.0
    mean, square = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, steps + 1):
        thresholds = _ordered(x[size:])
        score = np.bincount(row, x[:size][column] * value, len(at))
        upper = 1 / (1 + np.exp(np.clip(thresholds[None] - score[:, None], -60, 60)))
        # P(grade = g) = P(>= g) - P(>= g+1), with 1 below the first and 0 above the last
        edge = np.concatenate([np.ones((len(at), 1)), upper, np.zeros((len(at), 1))], axis=1)
        slope = np.concatenate([np.zeros((len(at), 1)), upper * (1 - upper), np.zeros((len(at), 1))], axis=1)
        pick = np.arange(len(at))
        chance = np.maximum(edge[pick, grades] - edge[pick, grades + 1], 1e-12)
        by_score = -(slope[pick, grades] - slope[pick, grades + 1]) / chance * say
        by_threshold = np.zeros(top + 2)
        np.add.at(by_threshold, grades, slope[pick, grades] / chance * say)
        np.add.at(by_threshold, grades + 1, -slope[pick, grades + 1] / chance * say)
        by_gap = np.cumsum(by_threshold[1:-1][::-1])[::-1].copy()
        by_gap[1:] *= np.exp(x[size + 1 :])
        gradient = np.concatenate([np.bincount(column, by_score[row] * value, size) + penalty * x[:size], by_gap])
        mean, square = 0.9 * mean + 0.1 * gradient, 0.999 * square + 0.001 * gradient**2
        x = x - rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-9)
    return x[:size], _ordered(x[size:])


def _ordered(raw: np.ndarray) -> np.ndarray:
    return raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def scored(docs: DataFrame, model: SeverityModel, limit: float = 0.5) -> DataFrame:
    """Each row with severity (expected grade), toxicity (chance of a grade above 0) and toxic (toxicity >= limit)."""
    made = ("severity", "toxicity", "toxic")
    kept = [c for c in docs.columns if c not in made]

    rows = docs.select(*kept, F.col("text").alias("__text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "__text"), "severity double, toxicity double"])

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.severity(t) for t in batch.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64())], [*kept, "severity", "toxicity"])

    return rows.mapInArrow(grade, schema).withColumn("toxic", F.col("toxicity") >= limit)
