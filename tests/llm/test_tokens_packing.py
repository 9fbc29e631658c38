"""Token ids, wavelet shards and packing."""

import random
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import packing, queries, tokens, wavelet

TOKENIZERS = [("byte_bpe_50k.json", "<|endoftext|>", True), ("word_bpe_49k.json", "<|startoftext|>", False)]
ODD = ["", " ", "  a", "a  b", "a   b\n \nc", "x \n y", " lead", "trail ", "it's don't  I'LL", "foo<|endoftext|>bar <|endoftext|> z", "<|startoftext|> q<|startoftext|>r",
       "\n\n a\tb", "ÀÉ Σας ΟΔΟΣ İx", "é ́x", "a\x00b c", "123 456a7", "日本 語   b", "Ġ ĠĠ a", "one " * 3000]


def documents(spark, folder="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.mark.parametrize("name,separator,leading", TOKENIZERS)
def test_cached_ids_are_the_library_s(spark, name, separator, leading, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 500)
    monkeypatch.setattr(tokens, "BATCH_BYTES", 20_000)
    encoder = tokens.TextEncoder(queries.vocabulary(name), separator, leading)
    texts = ODD + [r["text"] for r in documents(spark).limit(60).collect()] + ODD
    for _ in range(2):
        ids, counts = encoder.encode(pa.array([*texts, None]))
        ends = np.cumsum(counts)
        for text, want, a, b in zip([*texts, None], encoder.plain([*texts, ""]), ends - counts, ends, strict=True):
            assert np.array_equal(ids[a:b], want), repr(text)[:80]


@pytest.mark.parametrize("name,separator,leading", TOKENIZERS)
def test_a_word_is_learnt_once_whatever_mark_is_beside_it(name, separator, leading):
    encoder = tokens.TextEncoder(queries.vocabulary(name), separator, leading)
    words = [f"{a}{b}{c}" for a in ("wor", "tön", "мир") for b in ("a", "é", "и") for c in ("l", "ß", "7")]
    marks = [".", ",", "!", "?", ";", ":", ")", "%", "&&", ".\nNext"]
    texts = [" ".join(["x", *(w + m for w in words), "y"]) for m in marks]
    ids, counts = encoder.encode(pa.array(texts))
    for text, want, e, c in zip(texts, encoder.plain(texts), np.cumsum(counts), counts, strict=True):
        assert np.array_equal(ids[e - c : e], want), text
    assert len(encoder.slots) <= len(words) + len(marks) + 5


@pytest.mark.parametrize("name,separator,leading", TOKENIZERS)
def test_finer_cuts_are_exact(name, separator, leading):
    encoder = tokens.TextEncoder(queries.vocabulary(name), separator, leading)
    rng = random.Random(4)
    parts = ["a", "B", "é", "ß", "×", "÷", "ї", "İ", "Σ", "ŉ", "ǰ", "\u0338", "<|startoftext|>", "=", "文", "ʹ", "7", "٣", ".", "'", "'s", "'ll", "|", "<", ">", "<|endoftext|>", "-", "\n", "\t", "\r", "\x85", "\u00a0", "\u0301", "\U0001f600", "\x00", " a", " .", " 7", " é", " ", " \n"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(6000)] + ["", "\n", "\nA", ".\nA", "\n\nA", "a.\n\nB", " ", ".", "é."]
    # safe and unsafe texts, in one slice that does not begin at the first
    for given in (pa.array(["before\n", *texts]).slice(1), pa.array([t.replace(" ", "") for t in texts]), pa.array(["", None])):
        ids, counts = encoder.encode(given)
        for text, want, e, c in zip(given.to_pylist(), encoder.plain([t or "" for t in given.to_pylist()]), np.cumsum(counts), counts, strict=True):
            assert np.array_equal(ids[e - c : e], want), repr(text)


@pytest.mark.parametrize("part", [8, 64, 4096])
@pytest.mark.parametrize("size,top", [(0, 1), (1, 2), (8, 3), (63, 300), (64, 300), (65, 300), (5000, 70000)])
def test_planes_are_parted_alike_in_any_parts(part, size, top, monkeypatch):
    ids = np.random.default_rng(size).integers(0, top, size).astype(np.uint32)
    whole = wavelet.WaveletMatrix.of(ids)
    monkeypatch.setattr(wavelet, "PART", part)
    matrix = wavelet.WaveletMatrix.of(ids)
    assert len(matrix.planes) == len(whole.planes) and all(np.array_equal(a.packed, b.packed) and np.array_equal(a.blocks, b.blocks) for a, b in zip(matrix.planes, whole.planes, strict=True))
    assert np.array_equal(whole.decode(), ids) and np.array_equal(matrix.decode(), ids)


def test_parting_needs_no_places_of_a_whole_plane():
    ids = np.random.default_rng(6).integers(0, 1 << 16, 2_000_000, np.uint16).astype(np.uint32)

    def peak(work):
        tracemalloc.start()
        made = work()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return made, most / ids.size

    matrix, built = peak(lambda: wavelet.WaveletMatrix.of(ids))
    decoded, read = peak(matrix.decode)
    assert np.array_equal(decoded, ids) and built < 10.2 and read < 9.1, (built, read)


def test_parting_a_plane_costs_less_than_by_masks():
    ids = np.random.default_rng(5).integers(0, 1 << 16, 1_000_000, np.uint16).astype(np.uint32)

    def by_masks():
        held = ids.astype(np.uint16)
        for level in reversed(range(16)):
            bits = (held >> level & 1).astype(bool)
            held = np.concatenate([held[~bits], held[bits]])

    def seconds(work):
        began = time.process_time()
        work()
        return time.process_time() - began

    masks = min(seconds(by_masks) for _ in range(3))
    matrix = wavelet.WaveletMatrix.of(ids)
    assert np.array_equal(matrix.decode(), ids)
    assert min(seconds(lambda: wavelet.WaveletMatrix.of(ids)) for _ in range(3)) < 0.8 * masks
    assert min(seconds(matrix.decode) for _ in range(3)) < 0.8 * masks


@pytest.mark.parametrize("size,top", [(0, 1), (1, 1), (5, 1), (700, 3), (5000, 50257), (2049, 70000)])
def test_wavelet_matrix_answers(size, top):
    ids = np.random.default_rng(size).integers(0, top, size).astype(np.uint32)
    shard = wavelet.Shard(wavelet.WaveletMatrix.of(ids), np.arange(1), np.ones(1, bool), np.array([size]))
    matrix = wavelet.Shard.from_bytes(shard.to_bytes()).matrix
    assert np.array_equal(matrix.decode(), ids)
    rng = random.Random(size)
    for _ in range(60 if size else 0):
        i, a = rng.randrange(size), rng.randrange(size + 1)
        symbol = int(ids[i])
        assert matrix.access(i) == symbol and matrix.rank(symbol, a) == int((ids[:a] == symbol).sum())
        k = int((ids[:i] == symbol).sum())
        assert matrix.select(symbol, k) == i
    if size:
        assert matrix.occurrences(int(ids[0])) == np.flatnonzero(ids == ids[0]).tolist()
        assert matrix.count(1 << 20) == 0
        with pytest.raises(IndexError):
            matrix.select(int(ids[0]), size + 1)


def expected(rows, name, end):
    encoder = tokens.TextEncoder(queries.vocabulary(name), *next(t[1:] for t in TOKENIZERS if t[0] == name))
    return [(i, [*x.tolist(), end]) for i, x in zip([r[0] for r in rows], encoder.plain([r[1] or "" for r in rows]), strict=True)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ROWS = [(3, "b c"), (1, None), (2, ""), (3, "a"), (None, "null id"), (3, "b c"), (7, "word " * 5000)]


def test_shards_round_trip(spark, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD_BYTES", 3000)
    docs = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, shard string")
    folder = queries.scratch_path(spark, "wavelet")
    shards = wavelet.write_shards(docs, folder, queries.vocabulary("byte_bpe_50k.json"), "<|endoftext|>", True, 2)
    got = wavelet.read_documents(shards).orderBy("start").collect()
    want = expected(ROWS, "byte_bpe_50k.json", 2)
    assert sorted(str((r["doc_id"], r["n_tokens"], r["ids_crc32"])) for r in got) == sorted(str((i, len(x), crc(x))) for i, x in want)
    ids = [r["doc_id"] for r in got]
    assert ids == [None, *sorted(i for i in ids if i is not None)]
    assert [r["start"] for r in got] == np.cumsum([0, *[r["n_tokens"] for r in got]])[:-1].tolist()
    empty = wavelet.write_shards(docs.limit(0), queries.scratch_path(spark, "wavelet"), queries.vocabulary("byte_bpe_50k.json"), "<|endoftext|>", True, 2)
    assert wavelet.read_documents(empty).collect() == []


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_shards_in_any_folder_that_spark_opens(spark, tmp_path, scheme):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    shards = wavelet.write_shards(docs, f"{scheme}{tmp_path}/shards", queries.vocabulary("byte_bpe_50k.json"), "<|endoftext|>", True, 2)
    assert wavelet.read_documents(shards).count() == len(ROWS)
    stored = wavelet.Shard.from_bytes(bytes(shards.first()["file"]))
    assert stored.matrix.count(2) >= 1 and stored.matrix.decode()[-1] == 2


def test_equal_rows_are_dealt_to_several_shards(spark, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD_BYTES", 300)
    docs = spark.createDataFrame([(1, "the same words")] * 200, "doc_id long, text string")
    shards = wavelet.write_shards(docs, queries.scratch_path(spark, "wavelet"), queries.vocabulary("byte_bpe_50k.json"), "<|endoftext|>", True, 2)
    assert shards.count() > 3 and wavelet.read_documents(shards).select("start").distinct().count() == 200


def check_packing(got, want, length):
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    pieces = sorted(str((i, k, k * length, len(x[k * length : (k + 1) * length]), crc(x[k * length : (k + 1) * length]))) for i, x in want for k in range(-(-len(x) // length)))
    assert sorted(str((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in got) == pieces
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == np.cumsum([0, *[r["length"] for r in rows]])[:-1].tolist()
        assert sum(r["length"] for r in rows) <= length
    return len(by_sequence)


def test_packing_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_PIECES", 4)
    docs = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, sequence_id string")
    cut = packing.pieces(docs, queries.vocabulary("word_bpe_49k.json"), "<|startoftext|>", False, 0, 64)
    check_packing(packing.packed(cut, 64).collect(), expected(ROWS, "word_bpe_49k.json", 0), 64)
    none = packing.pieces(docs.limit(0), queries.vocabulary("word_bpe_49k.json"), "<|startoftext|>", False, 0, 64)
    assert packing.packed(none, 64).collect() == []


def test_pack_query_is_tight(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    want = expected(rows, "word_bpe_49k.json", 0)
    made = check_packing(queries.op8_pack(spark, folder).collect(), want, 2048)
    assert made <= sum(len(x) for _, x in want) / 2048 * 1.02 + 1


def test_wavelet_query_against_the_library(spark):
    folder = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"]) for r in documents(spark).collect())
    want, start = [], 0
    for i, x in expected(rows, "byte_bpe_50k.json", 2):
        want.append((i, start, len(x), crc(x)))
        start += len(x)
    got = queries.op6_wavelet(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want


@pytest.mark.parametrize("choose", ["norm", "dot"])
def test_best_fit_keeps_every_capacity(choose):
    rng = random.Random(1)
    lengths = np.array(sorted((rng.randint(1, 100) for _ in range(500)), reverse=True))
    bins, offsets = packing.best_fit(lengths, (100, 5, 4000), (1.0, 0.5, 0.5), choose) if lengths[0] ** 2 <= 4000 else packing.best_fit(np.minimum(lengths, 60), (100, 5, 4000), (1.0, 0.5, 0.5), choose)
    lengths = np.minimum(lengths, 60)
    for b in np.unique(bins):
        own = lengths[bins == b]
        assert own.sum() <= 100 and own.size <= 5 and (own**2).sum() <= 4000
        order = np.argsort(offsets[bins == b])
        assert np.array_equal(np.sort(offsets[bins == b]), np.cumsum([0, *own[order]])[:-1])
    with pytest.raises(ValueError):
        packing.best_fit(np.array([101]), (100, 5, 40000))


def test_plain_packing_matches_best_fit_decreasing():
    rng = random.Random(2)
    lengths = sorted((rng.randint(1, 2047) for _ in range(800)), reverse=True)
    free: list[int] = []
    for n in lengths:
        fits = [i for i, f in enumerate(free) if f >= n]
        at = min(fits, key=lambda i: free[i]) if fits else len(free)
        if not fits:
            free.append(2048)
        free[at] -= n
    assert packing.best_fit(np.array(lengths), (2048, 2048, 2048**2))[0].max() + 1 <= len(free) * 1.01 + 1


def test_pieces_keep_other_columns(spark):
    docs = documents(spark).limit(5).withColumn("tags", F.array(F.lit("x")))
    cut = packing.pieces(docs, queries.vocabulary("word_bpe_49k.json"), "<|startoftext|>", False, 0, 2048)
    assert cut.columns == ["doc_id", "lang", "source", "n_chars", "tags", "piece", "start", "length", "ids_crc32"] and cut.count() >= 5
