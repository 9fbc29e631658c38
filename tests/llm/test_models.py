"""Neighbour search, extraction, toxicity and language: the models trained here."""

import itertools
import math
import re
import zlib

import numpy as np
import pytest

from kpiloom.llm import ann, html_extract, html_pages, langid, queries, toxicity

SMALL = "/root/testdata/sf0.001"


def nearest(rows, queries_, k):
    good = {i: np.array(v, float) for i, (_, v) in enumerate(rows) if v is not None and len(v) == 6 and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for i in queries_:
        if i in good:
            found = sorted((math.sqrt(((good[i] - x) ** 2).sum()), rows[j][0]) for j, x in good.items() if j != i)[:k]
            out += [(rows[i][0], n + 1, name, round(d, 9)) for n, (d, name) in enumerate(found)]
    return sorted(out)


def test_neighbours_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_VECTORS", 60)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 20)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).round(3).tolist()) for i in range(250)]
    rows += [(300 + i, rows[5][1]) for i in range(40)] + [(400, None), (401, [0.0] * 6), (402, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (403, [float("nan")] * 6), (404, [float("inf")] * 6), (405, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    index, centre, size = ann.build(df)
    asked = index.where("vec_id % 5 = 0")
    got = ann.search(index, asked, centre, size, 10).collect()
    single = [(i, [float(np.float32(x)) if x is not None else None for x in v] if v else v) for i, v in rows]
    want = nearest(single, [j for j, r in enumerate(rows) if r[0] % 5 == 0], 10)
    assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got) == want


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (100, [2.0, 2.0]), (7, [5.0, 2.0])], "vec_id long, embedding array<double>")
    index, centre, size = ann.build(df)
    got = ann.search(index, index, centre, size, 10).collect()
    assert len(got) == 6 and {(r["query_id"], r["rank"]): r["vec_id"] for r in got}[0, 1] == 100
    index, centre, size = ann.build(df.limit(0))
    assert ann.search(index, index, centre, size, 10).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(400, 64)), rng.normal(size=(20, 64))
    turn, centre = ann.rotation(64), x.mean(axis=0)
    assert np.allclose(turn @ turn.T, np.eye(64))
    near, error = ann.estimate(*ann.encode(x, centre, turn), q, centre, turn)
    true = ((q[:, None] - x[None]) ** 2).sum(axis=2)
    assert (np.abs(near - true) <= error).mean() > 0.999 and np.corrcoef(near.ravel(), true.ravel())[0, 1] > 0.8


def enumerated(model, forest):
    n, total, marginal = forest.parent.size, 0.0, np.zeros(forest.parent.size)
    unary = np.bincount(forest.row, model.own[forest.column], n)
    for states in itertools.product((0, 1), repeat=n):
        score = sum(unary[i] for i in range(n) if states[i]) + sum(model.pair[forest.kind[i], states[forest.parent[i]], states[i]] for i in range(n) if forest.parent[i] >= 0)
        total += math.exp(score)
        marginal += math.exp(score) * np.array(states)
    return marginal / total, math.log(total)


def test_messages_are_exact():
    rng = np.random.default_rng(3)
    model = html_extract.TreeModel(rng.normal(size=len(html_extract.FEATURES)), rng.normal(size=(len(html_extract.KINDS), 2, 2)))
    forest = html_extract.Forest([html_extract.Tree("<body><nav><ul><li>a<li>b</ul></nav><article><h1>t</h1><p>x <b>y</b><p class=ad>z</article>")])
    single, both, total = model.passed(forest)
    want, log_total = enumerated(model, forest)
    assert np.allclose(single[:, 1], want) and math.isclose(total, log_total)
    child = np.flatnonzero(forest.parent >= 0)
    assert np.allclose(both[child].sum(axis=1)[:, 1], want[child]) and np.allclose(both[child].sum(axis=2)[:, 1], want[forest.parent[child]])


@pytest.fixture(scope="module")
def extractor():
    return html_extract.default_model()


PAGES = {
    "<html><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>One\n  two<br>three <b>four</b><p>Five&nbsp;six &eacute;<script>var x = '</p>';</script></p></article><footer>&copy; me</footer>": "A & B\n\nOne two three four\n\nFive six é",
    "<div class='cookie-notice'>We use cookies</div><main><p>Text of some length that says a thing.</p><div class='ad'>Buy now</div><p>More text of it.</p></main><section id='comments'><p>First!</p></section>": "Text of some length that says a thing.\n\nMore text of it.",
    "<header class='site-header'><a href='/'>Site</a></header><article><p>Body text here.</p><form><label>Name</label><input></form></article><aside><h3>Related</h3><ul><li><a href=x>y</a></li></ul></aside>": "Body text here.",
    "": "", None: "", "<p": "", "<nav><a href=x>y</a></nav>": "", "<!-- c --><style>p{}</style><title>t</title>": "",
}


def test_pages_by_hand(extractor):
    assert html_extract.main_texts(extractor, list(PAGES)) == list(PAGES.values())


OPEN_HEADS = {
    "<html><head><title>T</title><article><h1>Name</h1><p>One two three four five six.</p></article>": "Name\n\nOne two three four five six.",
    "<html><head><title>T</title><meta charset=utf-8><noscript><img src=x></noscript><style>p{}</style><main><p>One two three four five six.</p></main>": "One two three four five six.",
    "<html><head><title>T</title></head><body><article><p>One two three four five six.</p></article>": "One two three four five six.",
}
PARTS = {
    "<p>The law <math><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></math> holds in every frame.</p>": "The law E=mc2 holds in every frame.",
    "<p>The law <math class='wide' display='block'><mi>E</mi><mo>=</mo><mn>1</mn></math> holds in every frame.</p>": "The law E=1 holds in every frame.",
    "<p>A drawing <svg width=9><style>g{}</style><title>tip</title><g><path d=M0><text>of a</text><text>house</text></g></svg> stands here.</p>": "A drawing of a house stands here.",
    "<p>An icon <svg><path d=M0>left open.</p><p>The next one.</p>": "An icon left open.\n\nThe next one.",
    "<p>Shown as <object data=x>a table of words</object> and <canvas>a curve of them</canvas> here.</p>": "Shown as a table of words and a curve of them here.",
    "<p>Heard as <audio src=x>a song of old</audio>, seen as <video src=x>a film of it</video>.</p>": "Heard as a song of old, seen as a film of it.",
    "<noscript><p>Words for all who run no scripts.</p></noscript><p>More words for them.</p>": "Words for all who run no scripts.\n\nMore words for them.",
    "<object data=x><p>First <b>of two.</p><p>Second of two.</object><p>After them both.</p>": "First of two.\n\nSecond of two.\n\nAfter them both.",
}


def test_head_without_end(extractor):
    assert html_extract.main_texts(extractor, list(OPEN_HEADS)) == list(OPEN_HEADS.values())
    text = html_extract.Tree("<head><title>T</title> <meta charset=utf-8> bare words <p>and more")
    assert text.extracted(np.ones(len(text.parent), bool)) == "bare words\n\nand more"


def test_formulas_drawings_and_fallbacks_are_text(extractor):
    pages = [f"<html><head><title>T</title></head><body><article><h1>Name</h1><p>Words before it.</p>{p}</article></body></html>" for p in PARTS]
    assert html_extract.main_texts(extractor, pages) == [f"Name\n\nWords before it.\n\n{t}" for t in PARTS.values()]


def test_held_out_pages(extractor):
    pages = html_pages.marked_pages(150, 77)
    trees = [html_extract.Tree(p) for p in pages]
    forest = html_extract.Forest(trees)
    want = [t.extracted(forest.label[a:b].astype(bool)) for t, a, b in zip(trees, forest.first[:-1], forest.first[1:], strict=True)]
    got = html_extract.main_texts(extractor, pages)
    assert np.mean([a == b for a, b in zip(got, want, strict=True)]) > 0.95


def test_page_query_takes_articles_whole(spark):
    import html

    def article(page):
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", page, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        return "\n\n".join(b for b in blocks if b)

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = queries.op3_main_text(spark, SMALL).collect()
    assert len(got) == len(pages) and all(r["text"] == article(pages[r["page_id"]]) and r["n_chars"] == len(r["text"]) for r in got)


def test_extracted_rows_keep_columns(spark, extractor):
    rows = spark.createDataFrame([(1, "<p>Some text of a page.</p>", "old", "u"), (2, None, None, None)], "page_id long, html string, text string, url string")
    got = html_extract.extracted(rows, extractor).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == [(1, "u", "Some text of a page.", 20), (2, None, "", 0)]
    assert html_extract.extracted(rows.limit(0), extractor).collect() == []


def test_ordinal_fit_orders_thresholds_and_learns():
    rng = np.random.default_rng(4)
    truth = np.array([3.0, 1.5, 0.0, 2.0])
    at = [[int(c) for c in rng.choice(4, rng.integers(0, 4), replace=False)] for _ in range(3000)]
    score = np.array([truth[a].sum() for a in at]) + rng.logistic(size=3000)
    grades = (score[:, None] >= np.array([2.0, 3.5, 5.5])).sum(axis=1)
    weights, thresholds = toxicity.ordinal_fit(at, [[1.0] * len(a) for a in at], grades, 4)
    assert np.all(np.diff(thresholds) > 0) and np.allclose(weights, truth, atol=0.4) and np.allclose(thresholds, [2.0, 3.5, 5.5], atol=0.5)


def toxic_rows():
    rng = np.random.default_rng(5)
    plain = lambda: [f"w{rng.integers(400)}" for _ in range(rng.integers(5, 80))]
    rows = []
    for i in range(600):
        words, bad = plain(), i % 6 == 0
        for _ in range(rng.integers(1, 8) if bad else 0):
            words.insert(rng.integers(0, len(words) + 1), str(rng.choice(["Badword", "nasties!", "uglything"])))
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxic_documents_are_found_and_others_left(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, None, "x"), (900, "", "x"), (901, "clean w1 " * 20000 + "nasties", "x")], "doc_id long, text string, toxic string")
    grades = spark.createDataFrame([(i, g) for i, _, g in rows if i % 5] + [(1, None), (None, 1)], "doc_id long, grade int")
    model = toxicity.fit(docs, grades, graded_by_count=True)
    got = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    assert len(got) == 603 and all(got[i]["toxic"] == bool(g) for i, _, g in rows)
    assert got[901]["toxic"] and not got[900]["toxic"] and not got[None]["toxic"]
    assert all(0 <= r["severity"] <= 3 for r in got.values())
    mild, severe = model.severity("w1 badword")[0], model.severity("badword nasties uglything " * 4)[0]
    assert mild < severe


def test_toxicity_query_beside_a_plain_account(spark):
    """The query's rows follow from the fitted weights and thresholds by the formula of the cumulative link, word by word."""
    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    model = queries.toxicity_model(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert model.weights and model.thresholds == sorted(model.thresholds)
    got = queries.op4_toxicity(spark, folder).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        seen = {}
        for word in re.split(r"[\W\d_]+", (docs[r["doc_id"]] or "").lower()):
            for feature in {word} | {word[:n] + "*" for n in (4, 5, 6) if len(word) > n}:
                seen[feature] = seen.get(feature, 0) + 1
        score = sum(model.weights.get(f, 0.0) * math.log2(1 + n) for f, n in seen.items() if f)
        above = [1 / (1 + math.exp(t - score)) for t in model.thresholds]
        assert math.isclose(r["severity"], sum(above), abs_tol=1e-9) and math.isclose(r["toxicity"], above[0], abs_tol=1e-9)
        assert r["toxic"] == (r["toxicity"] >= 0.5)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic").collect()}
    assert not [r["doc_id"] for r in got if r["toxic"] and labels.get(r["doc_id"]) == 0]


def test_graded_null_texts_and_tied_labels(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(700, None), (701, "")], "doc_id long, text string")
    grades = [(i, g) for i, _, g in rows] + [(700, 1), (701, 1), (0, 0), (0, 1), (3, 0)]
    model = toxicity.fit(docs, spark.createDataFrame(grades, "doc_id long, grade int"), graded_by_count=True)
    got = {r["doc_id"]: r for r in toxicity.scored(docs, model).collect()}
    assert not got[700]["toxic"] and not got[701]["toxic"] and all(got[i]["toxic"] == bool(g) for i, _, g in rows)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, grade int"))
    assert [r["toxic"] for r in toxicity.scored(docs, model).collect()] == [False, False]
    assert toxicity.scored(docs.limit(0), model).collect() == []


def test_samples_hold_one_row_of_an_id(spark):
    copies = [(1, f"words of copy {i}", "en") for i in range(50)] + [(1, None, "en")]
    docs = spark.createDataFrame(copies + [(i, f"text {i}", "en") for i in range(2, 40)], "doc_id long, text string, lang string").repartition(4)
    grades = spark.createDataFrame([(i, i % 2) for i in range(1, 30)], "doc_id long, grade int")
    got = [r["text"] for r in toxicity.sample(docs, grades).collect()]
    assert len(got) == 29 and sum(t.startswith("words of copy") for t in got) == 1
    got = [r["doc_id"] for r in langid.sample(docs).collect()]
    want = {r["doc_id"] for r in docs.where(~langid.held_out(docs["doc_id"])).collect()}
    assert sorted(got) == sorted(want) and 1 in want


def test_a_repeated_id_takes_one_place_of_its_language(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_PER_LANGUAGE", 5)
    docs = spark.createDataFrame([(i, "text", "en") for i in range(40) for _ in range(10)], "doc_id long, text string, lang string")
    assert langid.sample(docs).count() == 5


def test_gradients_through_time():
    rng = np.random.default_rng(6)
    network = langid.ByteNetwork.new(["a", "b", "c"], hidden=3)
    for layer in (network.forward, network.backward):
        for name in layer:
            layer[name] = layer[name].astype(float)
    network.out_forward, network.out_backward, network.bias = (p.astype(float) for p in (network.out_forward, network.out_backward, network.bias))
    data, mask = langid._laid([bytes(rng.integers(97, 103, n).tolist()) for n in (1, 5, 9)])
    labels = np.array([0, 2, 1])
    _, gradients = network.gradients(data, mask, labels)
    for p, g in zip(network.parameters(), gradients, strict=True):
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        kept, step = p[at], 1e-4
        p[at] = kept + step
        up = network.gradients(data, mask, labels)[0]
        p[at] = kept - step
        down = network.gradients(data, mask, labels)[0]
        p[at] = kept
        assert math.isclose((up - down) / (2 * step), g[at], rel_tol=0.02, abs_tol=1e-5)


def plain_chances(network, text):
    """Mean probabilities of one text, byte by byte and segment by segment."""
    def states(layer, part):
        h, out = np.zeros(layer["uz"].shape[0]), []
        for byte in part:
            z, r = (1 / (1 + np.exp(-(layer["t" + g][byte] + h @ layer["u" + g]))) for g in "zr")
            h = (1 - z) * h + z * np.tanh(layer["tc"][byte] + (r * h) @ layer["uc"])
            out.append(h)
        return out

    total = np.zeros(len(network.languages))
    for at in range(0, len(text), langid.SEGMENT):
        part = text[at : at + langid.SEGMENT]
        for f, b in zip(states(network.forward, part), states(network.backward, part[::-1])[::-1], strict=True):
            e = np.exp(f @ network.out_forward + b @ network.out_backward + network.bias)
            total += e / e.sum()
    return total / len(text)


def test_inference_beside_a_plain_forward_pass():
    network = langid.ByteNetwork.new(["a", "b", "c"])
    texts = [t.encode() for t in ("x", "Words of one text. " * 3, "é中文字 " * 60, "y" * langid.SEGMENT, "z" * (2 * langid.SEGMENT + 1))]
    got = network.documents(texts)
    assert np.allclose(got, [plain_chances(network, t) for t in texts], atol=1e-5)


def test_the_sample_in_parts_is_that_of_the_whole(spark, monkeypatch):
    docs = spark.range(4000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'en', 'zh') AS lang", "'text' AS text")
    monkeypatch.setattr(langid, "SAMPLE_PER_LANGUAGE", 20)
    want = []
    for lang in ("en", "zh"):
        rows = docs.where(~langid.held_out(docs["doc_id"])).where(docs["lang"] == lang).selectExpr("doc_id", "xxhash64(doc_id) AS digest").collect()
        want += [r["doc_id"] for r in sorted(rows, key=lambda r: (r["digest"], r["doc_id"]))[:20]]
    assert sorted(r["doc_id"] for r in langid.sample(docs).collect()) == sorted(want)


def test_scripts_of_three_bytes_are_learned_whole(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid.ByteNetwork, "train", lambda self, segments, labels: seen.extend(segments))
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    langid.fit(spark.createDataFrame([(i, "字" * 100, "zh") for i in ids], "doc_id long, text string, lang string"))
    assert len(seen) == len(ids) * langid.SEGMENTS_PER_DOCUMENT and {s.decode() for s in seen} == {"字" * langid.TRAIN_CHARACTERS}


def test_language_query_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = queries.op7_language(spark, SMALL).collect()
    assert len(got) == len(truth) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) >= 0.95 and all(0 <= r["score"] <= 1 for r in got)


def test_languages_of_odd_texts(spark):
    network = langid.ByteNetwork.new(["xx", "yy"])
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "123 !? \n"), (4, "a"), (5, "word " * 20000)], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identified(rows, network).collect()}
    assert [got[i] for i in (1, 2, 3)] == ["und"] * 3 and {got[4], got[5]} <= {"xx", "yy"}
    assert {r["lang_pred"] for r in langid.identified(rows, None).collect()} == {"und"}
    assert langid.fit(spark.createDataFrame([], "doc_id long, text string, lang string")) is None
