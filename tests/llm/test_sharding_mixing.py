"""Keyed shuffle into shards, and mixing to target weights."""

import collections
import math
import re

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import mixing, queries, sharding


def shards_of(spark, rows, schema="doc_id long, size long, slot string", shards=3):
    return sharding.shuffled_shards(spark.createDataFrame(rows, schema), shards, 5).collect()


@pytest.mark.parametrize("rows", [
    [(i, i % 7, "x") for i in range(101)],
    [(1, 2, "x")] * 40 + [(None, None, None)] * 11 + [(2, 2, None)],
    [(1, 1, "x")],
])
def test_shards_are_even_and_slots_gapless(spark, rows):
    got = shards_of(spark, rows)
    assert sorted(r["row_number"] for r in got) == list(range(len(rows)))
    by_shard = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in range(3)}
    sizes = [len(v) for v in by_shard.values()]
    assert max(sizes) - min(sizes) <= 1 and all(v == list(range(len(v))) for v in by_shard.values())
    assert sorted((str(r["doc_id"]), str(r["size"])) for r in got) == sorted((str(a), str(b)) for a, b, _ in rows)


def test_shards_of_nothing_and_again(spark):
    assert shards_of(spark, []) == []
    rows = [(i, 1, "x") for i in range(50)]
    assert sorted(map(tuple, shards_of(spark, rows))) == sorted(map(tuple, shards_of(spark, rows[::-1])))


@pytest.mark.parametrize("count", [1, 2, 3, 64, 1000, 1025])
def test_place_is_a_bijection(spark, count):
    places = [r[0] for r in spark.range(count).select(sharding.place(F.col("id"), count, 9)).collect()]
    assert sorted(places) == list(range(count)) and (count < 64 or places != sorted(places))


def shared_targets(sizes, share=1.5, weights=(5, 2, 1), most=2):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), share * sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / open_weight for s in names}
        more = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not more:
            return target
        full |= more


def test_targets_against_repeated_sharing(spark):
    sizes = {"a": 100, "b": 5, "ä": 900, "Z": 1, "c": 40, None: 300, "z": 0}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    want = shared_targets(sizes)
    assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9) for s in want)


def test_mix_meets_targets_and_solves_the_dual(spark):
    rows = [(i, ["a", "b", "c", None][i % 4], 1 + (i * i) % (900 if i % 4 else 90)) for i in range(2000)] + [(7, "a", 3)] * 500 + [(None, None, 0), (None, "e", 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long")
    got = mixing.mixed(df).collect()
    assert sorted((str(r["doc_id"]), str(r["source"]), r["size"]) for r in got) == sorted((str(a), str(b), c) for a, b, c in rows)
    want = shared_targets({s: sum(z for _, t, z in rows if t == s) for s in {r[1] for r in rows}})
    for source, target in want.items():
        own = [r for r in got if r["source"] == source]
        taken, rated = sum(r["copies"] * r["size"] for r in own), sum(r["rate"] * r["size"] for r in own)
        assert all(r["copies"] in (0, 1, 2) for r in own)
        assert abs(taken - target) <= max((r["size"] for r in own), default=0) / 2 + 1
        assert target == 0 or abs(rated - target) <= 1e-6 * target
        logs = {round(math.log(r["rate"]) / r["size"], 9) for r in own if r["size"] and 1e-9 < r["rate"] < 2}
        assert not logs or max(logs) - min(logs) <= 1e-6
    again = mixing.mixed(df).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_with_clashing_names_and_repeated_rows(spark):
    names = "`key` string, `row` int, `number` string, `trial` int, `cut` long, `__key` string, `a.b` int, target string, Rate int, source string, size long"
    sources = ["x"] * 40 + ["y"] * 20 + [None] * 30
    rows = [("k", 1 if i % 4 else None, None, i // 2, 5, "", 3, "t", 9, s, i % 7) for i, s in enumerate(sources)]
    got = mixing.mixed(spark.createDataFrame(rows, names))
    assert got.columns == ["key", "row", "number", "trial", "cut", "__key", "a.b", "source", "size", "source_size", "target", "rate", "copies"]
    got = got.collect()
    assert sorted(map(repr, (r[:7] + r[7:9] for r in got))) == sorted(map(repr, (r[:7] + r[9:] for r in rows)))
    for s in ("x", "y", None):
        mine = [r for r in got if r["source"] == s]
        assert abs(sum(r["size"] * r["copies"] for r in mine) - mine[0]["target"]) <= 6 and all(r["copies"] in (0, 1, 2) for r in mine)


def test_mix_query_takes_its_targets(spark):
    """The query beside its own account of sizes and targets, made in plain Python."""
    folder = "/root/testdata/sf0.001"
    got = queries.op2_mix(spark, folder).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sizes = {d: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for d, r in docs.items()}
    totals = collections.Counter()
    for d, r in docs.items():
        totals[r["source"]] += sizes[d]
    left, target, wanted = sorted(totals, key=lambda s: (s is None, s)), {}, 1.5 * sum(totals.values())
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(left)}
    while left:
        level = (wanted - sum(target.values())) / sum(weight[s] for s in left)
        full = [s for s in left if weight[s] * level >= 2 * totals[s]]
        target |= {s: 2 * totals[s] if s in full else weight[s] * level for s in (full or left)}
        left = [s for s in left if s not in full] if full else []
    assert len(got) == len(docs)
    taken, longest = collections.Counter(), max(sizes.values())
    for r in got:
        assert r["size"] == sizes[r["doc_id"]] and r["source_size"] == totals[docs[r["doc_id"]]["source"]]
        assert r["target"] == pytest.approx(target[docs[r["doc_id"]]["source"]]) and 0 <= r["taken"] <= 2 * r["size"]
        taken[docs[r["doc_id"]]["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= longest for s in totals)


def test_sources_that_do_not_settle_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "NEWTON_STEPS", 0)
    monkeypatch.setattr(mixing, "HALVINGS", 3)
    df = spark.createDataFrame([(i, "a" if i % 3 else "b", i % 50 + 1) for i in range(200)], "doc_id long, source string, size long")
    with pytest.raises(RuntimeError, match="do not settle"):
        mixing.mixed(df)


def test_mix_of_nothing(spark):
    assert mixing.mixed(spark.createDataFrame([], "doc_id long, source string, size long")).collect() == []


def test_word_count(spark):
    texts = [None, "", " \t\n", "a", "a  b\x0bc\r\n d ", " x y"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    assert [r[0] for r in rows.select(mixing.word_count(F.col("t"))).collect()] == [0, 0, 0, 1, 4, 2]


def test_shard_query_covers_its_table(spark):
    folder = "/root/testdata/sf0.001"
    got, docs = queries.op1_shards(spark, folder), spark.read.parquet(f"{folder}/documents.parquet")
    wrong = got.join(docs, "doc_id").where((F.col("size") != F.octet_length("text") + 1) | (F.col("text_crc32") != F.crc32(F.col("text").cast("binary"))))
    assert got.count() == docs.count() and wrong.isEmpty()
