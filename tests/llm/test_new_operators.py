"""Periodic runs, benchmark decontamination and the Merkle manifest."""

import hashlib
import random
import re
import zlib
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pytest

from kpiloom.llm import decontam, manifest, queries, runs

SMALL = "/root/testdata/sf0.001"


def plain_runs(words):
    """Every run by comparing all words at every distance."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                part = words[i : j + q]
                if not any(part[p:] == part[:-p] for p in range(1, q)):
                    found.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def periodic_text(rng):
    vocabulary = [f"w{i}" for i in range(rng.choice([1, 2, 3, 50]))]
    words = []
    for _ in range(rng.randrange(1, 6)):
        piece = [rng.choice(vocabulary) for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 16, 17]))]
        words += (piece * 8)[: rng.randrange(1, len(piece) * 7 + 2)] if rng.random() < 0.6 else [rng.choice(vocabulary) for _ in range(rng.randrange(30))]
    return " ".join(words)


@pytest.mark.parametrize("block", [200_000, 60])
def test_runs_against_all_distances(block):
    rng = random.Random(7)
    pool = [periodic_text(rng) for _ in range(30)]
    texts = [None, "", " \n\t ", "one"] + pool + [f"{rng.choice(pool)}\n{rng.choice(pool)}" for _ in range(300)]
    for text, got in zip(texts, runs._found(texts, block), strict=True):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        want = plain_runs(words)
        assert [(r["start"], r["length"], r["period"]) for r in got["runs"]] == want, text
        assert got["n_words"] == len(words) and got["collapsed"] == collapsed(words, want)


def test_long_runs_and_long_texts():
    texts = ["a " * 100_000, " ".join([f"x{i}" for i in range(1000)] * 100), " ".join(f"z{i}" for i in range(100_000))]
    got = [[tuple(r.values()) for r in x["runs"]] for x in runs._found(texts, runs.BLOCK_WORDS)]
    assert got == [[(0, 100_000, 1)], [(0, 100_000, 1000)], []]


def test_grammar_derives_the_text():
    rng = np.random.default_rng(3)
    values = np.append(np.tile(rng.integers(0, 5, 400), 3), -1)
    grammar = runs.grammar_of(values)
    assert (np.bincount(grammar.symbol) > 1).all() and len(grammar.rest) < 500
    for symbol in range(len(grammar.size)):
        places = grammar.place[grammar.symbol == symbol]
        expansions = {tuple(values[p : p + grammar.size[symbol]]) for p in places}
        assert len(expansions) == 1 and 0 < grammar.left[symbol] < grammar.size[symbol]


def test_runs_keep_rows_and_replace_clashing_columns(spark):
    rows = [(1, "a a a a a a", "x"), (1, "a a a a a a", "x"), (None, None, "y"), (2, "b", None)]
    got = runs.with_runs(spark.createDataFrame(rows, "doc_id long, text string, runs string"))
    assert got.columns == ["doc_id", "text", "n_words", "runs", "collapsed"]
    assert sorted(str((r.doc_id, len(r.runs), r.collapsed)) for r in got.collect()) == sorted(map(str, [(1, 1, "a"), (1, 1, "a"), (None, 0, ""), (2, 0, "b")]))
    assert runs.with_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_runs_query_against_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.op11_runs(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id] or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        found = plain_runs(words) if n < 3000 else None
        if found is None:
            continue
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (best[1] * 1000 // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, found).encode()).hexdigest()


def plain_overlap(text, items):
    words = decontam.words_of(text)
    hit, names, best = [0] * len(words), set(), 0
    for name, item in items:
        item = decontam.words_of(item)
        k = min(10, len(item))
        if not k:
            continue
        windows = {tuple(item[i : i + k]) for i in range(len(item) - k + 1)}
        for p in range(len(words) - k + 1):
            if tuple(words[p : p + k]) in windows:
                names.add(name or "")
                hit[p : p + k] = [1] * k
        for p in range(len(words)):
            for i in range(len(item)):
                n = 0
                while p + n < len(words) and i + n < len(item) and words[p + n] == item[i + n]:
                    n += 1
                best = max(best, n if n >= k else 0)
    return len(words), sum(hit), sorted(names), best


def overlapping(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(rng.choice([2, 3, 40]))]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(f"i{j % 9}" if j else None, text(rng.choice([0, 1, 3, 9, 10, 11, 14, 30]))) for j in range(12)] + [("n", None), ("Ü", "Ein Wörtchen")]
    texts = [None, "", "?!", "EIN wörtchen, ja"] + [text(rng.randrange(60)) for _ in range(6)]
    texts += [f"{items[rng.randrange(12)][1]} x-{rng.choice(vocabulary)} {(items[rng.randrange(12)][1] or '').upper()}" for _ in range(8)]
    return texts + texts[-3:], items


@pytest.mark.parametrize("shard", [1000, 17])
def test_windows_and_longest_matches_against_all_places(shard):
    for seed in range(40):
        texts, items = overlapping(seed)
        block = decontam.block_of([(n or "", t) for n, t in items])
        for text, got in zip(texts, decontam._documents(texts, block, shard), strict=True):
            assert (got["n_words"], sum(s["end"] - s["start"] for s in got["spans"]), got["items"], got["longest"]["length"] if got["longest"] else 0) == plain_overlap(text, items)
            if got["longest"]:
                at = got["longest"]
                part = decontam.words_of(text)[at["doc_word"] : at["doc_word"] + at["length"]]
                assert any(part == decontam.words_of(t)[at["item_word"] : at["item_word"] + at["length"]] for n, t in items if (n or "") == at["item_id"])


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(5)
    values = np.where(rng.random(500) < 0.05, -1, rng.integers(0, 3, 500))
    values[-1] = -1
    values[values < 0] = -1 - np.arange((values < 0).sum())
    order = decontam.suffix_array(values, 500)
    suffixes = [tuple(values[i:]) for i in order]
    assert suffixes == sorted(suffixes)


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_blocks_of_the_benchmark_give_the_same(spark, block_bytes):
    texts, items = overlapping(3)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = {r.doc_id: r for r in decontam.overlaps(docs, benchmark, block_bytes=block_bytes).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, sum(s.end - s.start for s in r.spans), r["items"], r.longest.length if r.longest else 0) == plain_overlap(text, items)
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))
    clean = decontam.decontaminated(docs.withColumn("items", docs.doc_id), benchmark, block_bytes=block_bytes)
    assert clean.columns == ["doc_id", "text", "items"]
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, t in enumerate(texts) if not plain_overlap(t, items)[1]]


def test_decontamination_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [(r.n_words, r.spans, r["items"], r.longest) for r in decontam.overlaps(docs, none).collect()] == [(2, [], [], None)]
    assert decontam.overlaps(docs.limit(0), none).collect() == [] and decontam.decontaminated(docs, none).count() == 1


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows, changed):
    """(id, leaf, subroot, root, proof, folded root) of every row, by walking up node by node."""
    def leaf(row):
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def levels(nodes):
        found = [nodes]
        while len(found[-1]) > 1:
            below = found[-1]
            found.append([digest(*below[i : i + 16]) for i in range(0, len(below), 16)])
        return found

    branches = sorted({r[1] for r in rows}, key=lambda b: (b is not None, (b or "").encode()))
    trees = {}
    for b in branches:
        own = sorted(((r, leaf(r), leaf(changed(r))) for r in rows if r[1] == b), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1], x[2]))
        trees[b] = (own, levels([x[1] for x in own]))
    top = levels([trees[b][1][-1][0] for b in branches])
    out = []
    for rank, b in enumerate(branches):
        own, tree = trees[b]
        for i, (row, plain, shown) in enumerate(own):
            proof, folded = "", shown
            for nodes, at in [*((x, i // 16**k) for k, x in enumerate(tree[:-1])), *((x, rank // 16**k) for k, x in enumerate(top[:-1]))]:
                run = nodes[at // 16 * 16 : at // 16 * 16 + 16]
                before, after = "".join(run[: at % 16]), "".join(run[at % 16 + 1 :])
                proof, folded = proof + before + after, digest(before, folded, after)
            out.append((row[0], plain, tree[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


FIELDS = ["doc_id", "source", "text"]
SHAPES = {
    "one": [(5, "s", "Text")],
    "one branch": [(i, "s", f"T{i}") for i in range(17)],
    "many branches": [(i, f"s{i % 300}", "Tie" if i % 3 else None) for i in range(900)],
    "mixed": [(i, "hot", f"Row {i}") for i in range(600)] + [(None, None, None), (None, None, "B"), (7, None, "é"), (7, "é", ""), (7, "é", ""), (3, "Z", "x"), (1, "", "q")] + [(9, "é", "Same")] * 40,
}


@pytest.mark.parametrize("shape", sorted(SHAPES))
@pytest.mark.parametrize("chunk", [4096, 2])
def test_manifest_against_a_walk(spark, monkeypatch, shape, chunk):
    monkeypatch.setattr(manifest, "CHUNK", chunk)
    rows = SHAPES[shape]
    docs = spark.createDataFrame([(*r, "ignored") for r in rows], "doc_id long, source string, text string, leaf string")
    odd = docs.doc_id % 2 == 1
    shown = {"text": manifest.F.when(odd, manifest.F.translate("text", ascii_uppercase, ascii_lowercase)).otherwise(docs.text)}
    got = manifest.climbed(manifest.build(manifest.leaves_of(docs, FIELDS, "doc_id", "source", shown)))

    def changed(row):
        return (*row[:2], row[2].translate(str.maketrans(ascii_uppercase, ascii_lowercase)) if row[2] and row[0] is not None and row[0] % 2 else row[2])

    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_manifest(rows, changed)


def test_manifest_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert manifest.climbed(manifest.build(manifest.leaves_of(docs, FIELDS, "doc_id", "source"))).collect() == []


def test_recursion_limit_is_put_back(spark):
    limit = "spark.sql.cteRecursionRowLimit"
    spark.conf.set(limit, "12345")
    try:
        docs = spark.createDataFrame(SHAPES["one branch"], "doc_id long, source string, text string")
        manifest.climbed(manifest.build(manifest.leaves_of(docs, FIELDS, "doc_id", "source")))
        assert spark.conf.get(limit) == "12345"
    finally:
        spark.conf.unset(limit)
