"""Language identification by a bidirectional gated recurrent network over bytes.

Two gated recurrent layers (update gate, reset gate, candidate) read a text's UTF-8 bytes from either end; a softmax
over both states labels every position, and a document's probabilities are the mean of its positions'. Long texts are
read in segments of SEGMENT bytes, all of them. The network is trained here in numpy by backpropagation through time
(Adam on the cross-entropy of every position), on a bounded sample: SAMPLE_PER_LANGUAGE documents of each language,
those with the smallest digests of their ids, SEGMENTS_PER_DOCUMENT pieces of TRAIN_CHARACTERS characters each, learned from
whole whatever their bytes; of several rows with one id and language, the text with the smallest digest. Its only input
are bytes.

Defined results: texts that are null or have no letter are `und` with score 0; rows without a language or an id are
not learned from; without any language to learn everything is `und`; repeated rows get equal results; columns that
have the name of a result column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.session import materialized

UNKNOWN = "und"
HIDDEN = 8
SEGMENT = 192
#: Segments read side by side.
BATCH = 4096
SAMPLE_PER_LANGUAGE, SEGMENTS_PER_DOCUMENT, TRAIN_CHARACTERS = 300, 3, 64
#: Parts of a language that are ranked on their own before their best are ranked together.
SAMPLE_PARTS = 64
TRAIN_STEPS, TRAIN_BATCH, RATE = 350, 192, 0.02
SEED = 3
_LETTER = re.compile(r"[^\W\d_]")
#: Order of one direction's parameters.
_NAMES = ("tz", "tr", "tc", "uz", "ur", "uc")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place: half of tanh of the half, shifted."""
    x *= np.float32(0.5)
    np.tanh(x, out=x)
    x *= np.float32(0.5)
    x += np.float32(0.5)
    return x


@dataclass
class ByteNetwork:
    languages: list[str]
    forward: dict[str, np.ndarray]
    backward: dict[str, np.ndarray]
    out_forward: np.ndarray
    out_backward: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, languages: list[str], hidden: int = HIDDEN, seed: int = SEED) -> ByteNetwork:
        rng = np.random.default_rng(seed)
        layer = lambda: {n: rng.normal(0, 0.3, (256, hidden) if n[0] == "t" else (hidden, hidden)).astype(np.float32) for n in _NAMES}
        out = lambda: rng.normal(0, 0.3, (hidden, len(languages))).astype(np.float32)
        return cls(languages, layer(), layer(), out(), out(), np.zeros(len(languages), np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [*(self.forward[n] for n in _NAMES), *(self.backward[n] for n in _NAMES), self.out_forward, self.out_backward, self.bias]

    def positions(self, data: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Sum over each segment's positions of the probabilities of every language. data, mask: steps x segments."""
        steps, width = data.shape
        logits = np.empty((steps, width, len(self.languages)), np.float32)
        for layer, out, order, first in ((self.forward, self.out_forward, range(steps), True), (self.backward, self.out_backward, range(steps - 1, -1, -1), False)):
            h = np.zeros((width, layer["uz"].shape[0]), np.float32)
            for t in order:
                at = data[t]
                z = layer["tz"].take(at, axis=0)
                z += h @ layer["uz"]
                _sigmoid(z)
                r = layer["tr"].take(at, axis=0)
                r += h @ layer["ur"]
                _sigmoid(r)
                r *= h
                c = layer["tc"].take(at, axis=0)
                c += r @ layer["uc"]
                np.tanh(c, out=c)
                c -= h
                c *= z
                # past the end of a text the state stays; before it, none has formed
                c *= mask[t][:, None]
                h += c
                if first:
                    np.matmul(h, out, out=logits[t])
                else:
                    logits[t] += h @ out
        logits += self.bias
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        logits *= mask[:, :, None]
        return logits.sum(axis=0, dtype=np.float64)

    def gradients(self, data: np.ndarray, mask: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross-entropy over all positions, and its gradient for every parameter, through time."""
        steps, width = data.shape
        saved, states = [], []
        for layer, order in ((self.forward, range(steps)), (self.backward, range(steps - 1, -1, -1))):
            h = np.zeros((width, layer["uz"].shape[0]), np.float32)
            held, all_h = [None] * steps, np.empty((steps, width, h.shape[1]), np.float32)
            for t in order:
                z = _sigmoid(layer["tz"][data[t]] + h @ layer["uz"])
                r = _sigmoid(layer["tr"][data[t]] + h @ layer["ur"])
                c = np.tanh(layer["tc"][data[t]] + (r * h) @ layer["uc"])
                held[t] = (h, z, r, c)
                h = h + mask[t][:, None] * z * (c - h)
                all_h[t] = h
            saved.append(held)
            states.append(all_h)
        logits = states[0] @ self.out_forward + states[1] @ self.out_backward + self.bias
        logits -= logits.max(axis=2, keepdims=True)
        chance = np.exp(logits)
        chance /= chance.sum(axis=2, keepdims=True)
        total = max(1.0, float(mask.sum()))
        picked = np.take_along_axis(chance, np.broadcast_to(labels[None, :, None], (steps, width, 1)), axis=2)[:, :, 0]
        loss = float(-(np.log(np.maximum(picked, 1e-12)) * mask).sum() / total)
        error = chance.copy()
        error[:, np.arange(width), labels] -= 1
        error *= mask[:, :, None] / np.float32(total)
        flat = error.reshape(-1, error.shape[2])
        outs = [s.reshape(-1, s.shape[2]).T @ flat for s in states]
        found = []
        for layer, out, held, order in ((self.forward, self.out_forward, saved[0], range(steps - 1, -1, -1)), (self.backward, self.out_backward, saved[1], range(steps))):
            g = {n: np.zeros_like(layer[n]) for n in _NAMES}
            down = np.zeros((width, layer["uz"].shape[0]), np.float32)
            for t in order:
                h, z, r, c = held[t]
                dh = down + error[t] @ out.T
                live = dh * mask[t][:, None]
                dz = live * (c - h) * z * (1 - z)
                dc = live * z * (1 - c * c)
                through = dc @ layer["uc"].T
                dr = through * h * r * (1 - r)
                down = dh - live * z + through * r + dz @ layer["uz"].T + dr @ layer["ur"].T
                g["uz"] += h.T @ dz
                g["ur"] += h.T @ dr
                g["uc"] += (r * h).T @ dc
                for n, d in (("tz", dz), ("tr", dr), ("tc", dc)):
                    np.add.at(g[n], data[t], d)
            found += [g[n] for n in _NAMES]
        return loss, [*found, *outs, flat.sum(axis=0)]

    def train(self, segments: list[bytes], labels: np.ndarray, steps: int = TRAIN_STEPS, batch: int = TRAIN_BATCH, rate: float = RATE, seed: int = SEED) -> list[float]:
        """Adam over random batches; returns the losses."""
        rng, losses = np.random.default_rng(seed), []
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.parameters()]
        for t in range(1, steps + 1):
            chosen = rng.integers(0, len(segments), batch)
            data, mask = _laid([segments[i] for i in chosen])
            loss, gradients = self.gradients(data, mask, labels[chosen])
            losses.append(loss)
            norm = np.sqrt(sum(float((g**2).sum()) for g in gradients))
            step = rate * min(1.0, 2 * (1 - t / (steps + 1)))
            for p, g, (m, v) in zip(self.parameters(), gradients, moments, strict=True):
                g = g * np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
                m += np.float32(0.1) * (g - m)
                v += np.float32(0.01) * (g * g - v)
                p -= np.float32(step) * (m / np.float32(1 - 0.9**t)) / (np.sqrt(v / np.float32(1 - 0.99**t)) + np.float32(1e-6))
        return losses

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities per text; zeros for an empty one."""
        sums = np.zeros((len(texts), len(self.languages)))
        sizes = np.array([len(t) for t in texts])
        counts = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), counts)
        start = (np.arange(owner.size) - np.repeat(np.cumsum(counts) - counts, counts)) * SEGMENT
        length = np.minimum(SEGMENT, sizes[owner] - start)
        joined = np.frombuffer(b"".join(texts), np.uint8)
        begin = (np.cumsum(sizes) - sizes)[owner] + start
        # short segments side by side with short ones, so that few steps are idle
        order = np.argsort(-length, kind="stable")
        for i in range(0, order.size, BATCH):
            part = order[i : i + BATCH]
            steps = np.arange(int(length[part[0]]))
            mask = steps[:, None] < length[part][None]
            data = joined[np.where(mask, begin[part][None] + steps[:, None], 0)]
            np.add.at(sums, owner[part], self.positions(data, mask.astype(np.float32)))
        return sums / np.maximum(sizes, 1)[:, None]


def _laid(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and mask, steps x segments."""
    steps = max(1, max(len(s) for s in segments))
    data = np.frombuffer(b"".join(s.ljust(steps, b"\0") for s in segments), np.uint8).reshape(len(segments), steps).T
    mask = np.arange(steps)[:, None] < np.array([len(s) for s in segments])[None]
    return np.ascontiguousarray(data), mask.astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame) -> DataFrame:
    """Bounded sample of the documents that are not held out: doc_id, lang, text; one row for each id and language."""
    usable = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").where(~held_out(F.col("doc_id")))
    ids = usable.select("doc_id", "lang").distinct().withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE_PARTS)))
    # the best of a language are among the best of its parts, so no task ranks all ids of one
    for keys in (["lang", "part"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id"))
        ids = ids.withColumn("place", place).where(F.col("place") <= SAMPLE_PER_LANGUAGE).drop("place")
    ids = ids.select("doc_id", "lang")
    # at most SAMPLE_PER_LANGUAGE rows a language; copies of an id are combined on the map side
    met = usable.join(F.broadcast(ids), ["doc_id", "lang"], "left_semi")
    return met.groupBy("doc_id", "lang").agg(F.min_by("text", F.sha2("text", 256)).alias("text"))


def fit(docs: DataFrame) -> ByteNetwork | None:
    """Trains on the documents (doc_id, text, lang) that are not held out."""
    offset = lambda i: F.pmod(F.xxhash64("doc_id", F.lit(i)), F.greatest(F.lit(1), F.length("text") - TRAIN_CHARACTERS)).cast("int") + 1
    pieces = sample(docs).select("doc_id", "lang", F.explode(F.array(*[F.substring(F.col("text"), offset(i), F.lit(TRAIN_CHARACTERS)) for i in range(SEGMENTS_PER_DOCUMENT)])).alias("piece"))
    rows = sorted(((r["lang"], r["doc_id"], r["piece"]) for r in pieces.collect() if r["piece"] and _LETTER.search(r["piece"])))
    languages = sorted({r[0] for r in rows})
    if not languages:
        return None
    network = ByteNetwork.new(languages)
    network.train([r[2].encode("utf-8", "surrogatepass") for r in rows], np.array([languages.index(r[0]) for r in rows]))
    return network


def identified(docs: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """Each row with lang_pred and score. Texts are read from the column text, which is left out of the result."""
    kept = [c for c in docs.columns if c not in ("text", "lang_pred", "score")]
    rows = docs.select(*kept, "text")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text"), "lang_pred string", "score double"])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            known = [bool(network and t and _LETTER.search(t)) for t in texts]
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            spoken = [i for i, k in enumerate(known) if k]
            at = 0
            while at < len(spoken):
                part, size = [], 0
                while at < len(spoken) and size < BATCH * SEGMENT:
                    part.append(spoken[at])
                    size += len(texts[spoken[at]])
                    at += 1
                chances = network.documents([texts[i].encode("utf-8", "surrogatepass") for i in part])
                for i, row, best in zip(part, chances, chances.argmax(axis=1), strict=True):
                    names[i], scores[i] = network.languages[best], float(min(1.0, max(0.0, row[best])))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*kept, "lang_pred", "score"])

    return rows.mapInArrow(predict, schema)
