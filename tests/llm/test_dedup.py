"""Exact and near duplicates."""

import collections
import hashlib
import itertools
import random
import re
import uuid

import numpy as np
import pytest

from kpiloom.llm import exact_dedup, near_dup
from kpiloom.session import scratch_path


def index(spark):
    return exact_dedup.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", scratch_path(spark, "index"), 4)


DOCS = [(5, "a b", "x"), (3, "a\t\n b", "y"), (4, "a  b ", "z"), (9, None, None), (8, "", "q"), (None, "n", "1"), (2, "n", "2"), (7, "w", "r"), (7, "w", "r"), (None, "only", "")]
SCHEMA = "doc_id long, text string, kept string"


def test_exact_groups_against_brute_force(spark):
    got = index(spark).add(spark.createDataFrame(DOCS, SCHEMA), "one").collect()
    groups = collections.defaultdict(list)
    for doc, text, _ in DOCS:
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()].append(doc)
    want = sorted(str((d, min((x for x in g if x is not None), default=None), len(g), h)) for h, g in groups.items() for d in g)
    assert sorted(str((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"])) for r in got) == want
    assert collections.Counter(r["text_sha256"] for r in got if r["kept"]) == collections.Counter(groups.keys())


def test_index_remembers(spark):
    known = index(spark)
    first, second = spark.createDataFrame([(10, "a", ""), (11, "b", "")], SCHEMA), spark.createDataFrame([(1, "a", ""), (2, "c", ""), (3, "c", "")], SCHEMA)
    assert all(r["kept"] for r in known.add(first, "first").collect())
    got = {r["doc_id"]: (r["kept"], r["keep_id"]) for r in known.add(second, "second").collect()}
    assert got == {1: (False, 10), 2: (True, 2), 3: (False, 2)}
    assert not any(r["kept"] for r in known.add(second, "third").collect()) and known.entries().count() == 3
    assert known.add(spark.createDataFrame([], SCHEMA), "empty").collect() == []


def test_interrupted_batch_gets_its_answers_again(spark):
    known = index(spark)
    known.add(spark.createDataFrame([(99, "5", "")], SCHEMA), "before")
    batch = spark.createDataFrame([(i, str(i % 20), "") for i in range(30)], SCHEMA)
    lost = known.add(batch, "second")  # its texts are in the index, and its result is never written
    assert known.entries().count() == 20
    again = known.add(batch, "second").collect()
    assert sorted(map(str, again)) == sorted(map(str, lost.collect())) and sum(r["kept"] for r in again) == 19
    assert known.entries().count() == known.entries().select("digest").distinct().count() == 20
    # of a batch that was appended in part, the rest is added
    more = known.add(batch.union(spark.createDataFrame([(50, "new", "")], SCHEMA)), "second").collect()
    assert sum(r["kept"] for r in more) == 20 and known.entries().count() == 21


def test_index_is_opened_with_its_own_bucket_count(spark):
    path, docs = scratch_path(spark, "index"), spark.createDataFrame([(i, str(i), "") for i in range(20)], SCHEMA)
    with exact_dedup.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", path, 4) as known:
        name = known.table
        known.add(docs, "first").collect()
    assert not spark.catalog.tableExists(name)
    with pytest.raises(ValueError, match="4 buckets, not 3"):
        exact_dedup.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", path, 3)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        with exact_dedup.DigestIndex(spark, f"digests_{uuid.uuid4().hex}", path) as known:
            assert known.buckets == 4 and not any(r["kept"] for r in known.add(docs, "second").collect())
            assert known.entries().count() == 20
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_two_batches_cover_all_rows_in_order(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    parts = exact_dedup.in_two_batches(docs)
    early, late = (parts[n].collect() for n in ("early", "late"))
    assert len(early) + len(late) == len(DOCS) and early and late
    assert max(r["doc_id"] for r in early) < min(r["doc_id"] for r in late if r["doc_id"] is not None)
    assert list(exact_dedup.in_two_batches(docs.where("doc_id IS NULL"))) == ["all"]


def test_index_is_bucketed_and_its_side_not_shuffled(spark):
    known = index(spark)
    known.add(spark.createDataFrame([(i, str(i), "") for i in range(50)], SCHEMA), "one").collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = spark.createDataFrame([(bytes([i]),) for i in range(5)], "digest binary").groupBy("digest").count()
        plan = new.join(known.entries().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = plan[plan.index("FileScan"):] if "FileScan" in plan else ""
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Bucketed: true" in scan


def gram_set(text):
    words = re.findall(r"\w+", (text or "").lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_force(rows):
    sets = [gram_set(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and both * 10 >= 8 * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            parent[max(root(a), root(b))] = min(root(a), root(b))
    classes = collections.defaultdict(list)
    for i in range(len(rows)):
        classes[root(i)].append(i)
    out = []
    for members in classes.values():
        name = min((rows[i][0] for i in members if rows[i][0] is not None), default=None)
        out += [str((rows[i][0], name, len(members), links[i])) for i in members]
    return sorted(out)


def family(seed, copies, words=60, changes=1):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randint(0, changes)):
            own[rng.randrange(words)] = f"v{rng.randrange(5000)}"
        yield " ".join(own)


def crafted():
    texts = [None, "", "!!! ...", "one", "ONE.", "one two", "one, two", "a b c d e", "a b c d e f", "Ünïcode wörd — “quoted” ok five six", "ünïcode WÖRD quoted ok five six", "x " * 30000, "x " * 29999]
    texts += [t for s in range(12) for t in family(s, 4, 80, 2)] + list(family(99, 60, 120, 4))
    shared = " ".join(f"p{i}" for i in range(50))
    texts += [f"{shared} {t}" for t in (" ".join(f"q{s}x{i}" for i in range(60)) for s in range(30))]
    return [(100 + i if i != 20 else None, t) for i, t in enumerate(texts)] + [(100, None), (103, "one")]


@pytest.mark.parametrize("block", [1000, 7])
def test_near_duplicates_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rows = crafted()
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str((r["doc_id"], r["class_id"], r["class_size"], r["n_links"])) for r in got) == brute_force(rows)


def test_near_duplicates_keep_one_row_of_each_class_with_all_columns(spark):
    rows = [(i, t, "at", i) for i, t in crafted()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, at long")
    kept = near_dup.without_near_duplicates(docs)
    classes = len({eval(s)[1:2] + (eval(s)[0] if eval(s)[2] == 1 else 0,) for s in brute_force([r[:2] for r in rows])})
    assert kept.columns == docs.columns and kept.count() >= classes - 3 and kept.exceptAll(docs).isEmpty()
    empty = near_dup.without_near_duplicates(docs.limit(0))
    assert empty.columns == docs.columns and empty.count() == 0


def test_depth_reaches_the_recall():
    depth = near_dup.depth_for()
    assert 1 - (1 - 0.8**depth) ** near_dup.TREES >= near_dup.TARGET_RECALL
    assert near_dup.depth_for(recall=0.5) > depth


def test_prefixes_shorten_as_far_as_the_least_similar_partner():
    for n in range(1, 80):
        possible = [c / (n + m - c) for m in range(1, 2 * n) for c in range(1, min(n, m) + 1) if c < n + m - c and c / (n + m - c) >= 0.8 - 1e-12]
        assert near_dup.least_similarity(n) == pytest.approx(min(possible, default=1.0))
    depth = near_dup.depths(np.array([1, 3, 6, 7, 12, 63, 64, 10**6]))
    assert depth.tolist() == [6, 6, 5, 6, 4, 4, 4, 4] and near_dup.SHORTEST == 4


def test_rows_meet_at_their_longest_prefix():
    same, other = [7] * 96, [9] * 96
    tails = np.array([0x00010001, 0x00010002, 0x00020001, 0x00020001, 0x00030001], np.int32)
    marks = np.array([same, same, same, other, other], np.uint8)
    # all may climb to the node itself: what is alike is joined, wherever the prefixes part
    assert near_dup.climbed(tails, np.full(5, 4), marks).tolist() == [0, 0, 0, 3, 3]
    # rows that stop at 5 levels meet only those with five in common, at 6 those with the whole label
    assert near_dup.climbed(tails, np.full(5, 5), marks).tolist() == [0, 0, 2, 3, 4]
    assert near_dup.climbed(tails, np.full(5, 6), marks).tolist() == [0, 1, 2, 3, 4]
    assert near_dup.climbed(tails, np.array([4, 6, 4, 4, 6]), marks).tolist() == [0, 1, 0, 3, 4]
    # the first of a negative number's levels is one node like others
    assert near_dup.climbed(np.array([-5, 3], np.int32), np.full(2, 4), marks[:2]).tolist() == [0, 0]


def test_recall_of_pairs_close_to_the_threshold(spark):
    rng = random.Random(11)
    rows, wanted = [], 0
    for pair in range(400):
        n = rng.choice([6, 7, 9, 12, 20, 45, 90])
        words = [f"w{rng.randrange(10**9)}" for _ in range(n + 4)]
        # a tail of new words takes grams away and adds as many: n - t of n + t stay common
        t = rng.choice([t for t in range(1, n) if (n - t) / (n + t) >= 0.8] or [0])
        changed = words[: n + 4 - t] + [f"x{rng.randrange(10**9)}" for _ in range(t)] if t else [*words, "one"]
        wanted += 2
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(changed))]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    linked = [r for r in got if r["n_links"] == 1 and r["class_id"] == r["doc_id"] // 2 * 2 and r["class_size"] == 2]
    assert len(linked) >= 0.99 * wanted and not any(r["n_links"] > 1 for r in got)
