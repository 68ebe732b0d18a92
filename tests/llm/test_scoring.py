import re
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from condoflow.llm import language_id, toxicity
from condoflow.llm.language_id import op8_language_id
from condoflow.llm.toxicity import op2_toxicity
from tests.llm import brute

SF = "/root/testdata/sf0.1"


def test_toxicity_of_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = op2_toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic = [r.score for r in out if r.toxic == 1]
    clean = [r.score for r in out if r.toxic == 0]
    assert sum(s >= 0.5 for s in clean) / len(clean) < 0.03
    assert np.mean([[t > c for c in clean] for t in toxic]) > 0.95


def test_toxicity_of_awkward_rows(spark):
    data = brute.awkward()
    docs = spark.createDataFrame(data, brute.SCHEMA)
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (7, None), (9, 0), (11, 0), (99, 1)], "doc_id long, toxic int")
    out = op2_toxicity(docs, labels).collect()
    assert len(out) == len(data) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 5 == 0) for r in out)
    assert op2_toxicity(docs.limit(0), labels).collect() == []
    assert len(op2_toxicity(docs, labels.limit(0)).collect()) == len(data)


def test_models_agree_on_what_the_counts_do_not_tell():
    words = np.array([5, 9, 12], np.uint64)
    pair = np.array([4 * 5 + 1, 1 * 5 + 2, 1 * 5 + 3])  # start-a, a-b, a-c
    of_word = np.array([[0, 500, 1, 1, 0], [0, 500, 1, 90, 0], [0, 1, 1, 1, 0]], float)
    context = np.array([[0, 2, 0, 0, 500], [0, 91, 0, 0, 500], [0, 2, 0, 0, 1], [0, 2, 0, 0, 1]], float)
    tested = toxicity.of_words(of_word, context)
    model = toxicity.model_of(words, tested, *toxicity.telling(tested, pair, np.array([[500, 500], [1, 1], [1, 90]])))
    assert words[1] not in model["vocabulary"] and words[2] in model["vocabulary"]
    assert model["word"][1 + list(model["vocabulary"]).index(words[2])] > 1 and model["word"][0] == 0


def plain_continuations(texts, sample):
    """Different left neighbours of each beginning of the sample in all texts, counted by a plain loop."""
    def tokens(text):
        return [w[:5] for w in re.findall(rb"[a-z\x80-\xff]+", (text or "").encode().translate(bytes(toxicity.LOWER.tolist())))]

    vocabulary = {t for text in sample for t in tokens(text)}
    found = {}
    for text in texts:
        before = "start"
        for t in tokens(text):
            t = t if t in vocabulary else "unknown"
            found.setdefault(t, set()).add(before)
            before = t
    return sorted(len(v) for t, v in found.items() if t != "unknown")


def test_contexts_are_counted_over_all_documents(spark):
    rng = np.random.default_rng(3)
    words = np.array("Ab house houses Straße x longerword longerwords z9z unseen".split())
    texts = [" ".join(rng.choice(words if k % 3 else words[:6], 12)) for k in range(60)] + [None, "", "a" * 70_000]
    sample = [t for k, t in enumerate(texts) if k % 3 == 0]
    code = np.unique(toxicity.letters(*toxicity.text_bytes(pa.array(sample)))[0])
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(5)
    pairs = frame.mapInArrow(toxicity.see_contexts(SimpleNamespace(value=code)), "pair long").distinct()
    found = pairs.groupBy((F.col("pair") % (len(code) + 2)).alias("word")).count().where("word > 0").collect()
    assert sorted(r["count"] for r in found) == plain_continuations(texts, sample)


def test_order_of_rows_changes_no_score(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    copies = docs.unionByName(docs.where("doc_id % 3 = 0").withColumn("doc_id", F.col("doc_id") + 10**9))
    marks = labels.unionByName(labels.where("doc_id % 3 = 0").withColumn("doc_id", F.col("doc_id") + 10**9))
    one, two = ({r.doc_id: r.score for r in op2_toxicity(copies.repartition(n, F.rand(n)), marks.repartition(n + 1)).collect()} for n in (3, 7))
    assert one == two


def test_gradients_of_the_network():
    rng = np.random.default_rng(0)
    steps = rng.integers(0, 256, (5, 3))
    y = np.array([0, 1, 1])

    def loss(w):
        return -np.log(language_id.probabilities(w, steps)[:, np.arange(3), y]).mean()

    x, u = (rng.normal(0, 0.5, (n, 3 * language_id.HIDDEN)) for n in (256, language_id.HIDDEN))
    target = rng.normal(size=(5, 3, language_id.HIDDEN))
    keep, gx, gu = [], np.zeros_like(x), np.zeros_like(u)
    language_id.read(x, u, steps, keep)
    language_id.read_back(x, u, steps, keep, target, gx, gu)
    for a, g, at in ((u, gu, (2, 3)), (u, gu, (1, 20)), (x, gx, (int(steps[1, 0]), 30)), (x, gx, (int(steps[0, 2]), 4))):
        old, side = a[at], []
        for d in (1e-2, -1e-2):
            a[at] = old + d
            side.append((language_id.read(x, u, steps).astype(float) * target).sum())
        a[at] = old
        assert abs((side[0] - side[1]) / 2e-2 - g[at]) < 2e-2 * max(1, abs(g[at]))
    assert loss(language_id.start_weights(2)) > 0


def test_gates_lie_apart_and_give_the_plain_network():
    rng = np.random.default_rng(5)
    h, w, steps = language_id.HIDDEN, language_id.start_weights(3), rng.integers(0, 256, (9, 31)).astype(np.uint8)
    keep = []
    language_id.read(w["xf"], w["uf"], steps, keep)
    # gates cut out of wider rows made every numpy call of a step walk over pieces of 12 numbers
    assert all(gate.flags.c_contiguous for step in keep for gate in step)
    assert np.moveaxis(language_id.probabilities(w, steps), -1, 0).flags.c_contiguous

    def plain(x, u, steps):
        state, states = np.zeros((steps.shape[1], h)), []
        for byte in steps:
            given, own = np.split(x[byte].astype(float), 3, axis=1), np.split(state @ u, 3, axis=1)
            z, r = (1 / (1 + np.exp(-a - b)) for a, b in zip(given[:2], own[:2], strict=True))
            n = np.tanh(given[2] + r * own[2])
            state = z * state + (1 - z) * n
            states.append(state)
        return np.array(states)

    both = np.concatenate([plain(w["xf"], w["uf"], steps), plain(w["xb"], w["ub"], steps[::-1])[::-1]], axis=2)
    likely = np.exp(both @ w["o"] + w["c"])
    assert np.abs(language_id.probabilities(w, steps) - likely / likely.sum(axis=-1, keepdims=True)).max() < 1e-5
    assert np.abs(language_id.read(w["xf"], w["uf"], steps) - both[:, :, :h]).max() < 1e-5


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = op8_language_id(docs).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in out]) > 0.97


def test_language_of_awkward_rows(spark):
    data = brute.awkward()
    docs = spark.createDataFrame(data, brute.SCHEMA)
    out = op8_language_id(docs).collect()
    assert len(out) == len(data) and all(0 <= r.score <= 1 for r in out)
    assert sum(r.lang_pred == "und" for r in out) == sum(not any(c.isalpha() for c in t or "") for _, t, *_ in data)
    assert {r.lang_pred for r in op8_language_id(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert op8_language_id(docs.limit(0)).collect() == []


def test_rows_without_id_are_learned_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").limit(120).withColumn("doc_id", F.lit(None).cast("long"))
    model = language_id.fit(docs, F.lit(True), rows=20)
    assert model and len(model[1]) == docs.select("lang").where("lang is not null").distinct().count()


def test_rare_language_is_learned(spark):
    words = {"en": "the of and house water which their would people".split(), "fi": "ja yksi talo vesi hyvää päivää kiitos että".split()}
    docs = [(k, lang, " ".join(words[lang][(k * 7 + j * (k % 5 + 1) + j // 3) % len(words[lang])] for j in range(600 if lang == "fi" else 60)))
            for k in range(6000) for lang in ["fi" if k % 750 == 3 else "en"]]
    frame = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    learn = F.col("doc_id") % 1500 != 3  # half of the eight rare rows
    model = language_id.fit(frame, learn, rows=500)
    assert model[1] == ["en", "fi"]
    out = language_id.identify(frame, model).collect()
    assert np.mean([r.lang == ("fi" if r.doc % 750 == 3 else "en") for r in out]) > 0.99
    assert all(r.lang == "fi" for r in out if r.doc % 750 == 3)


def test_pieces_cover_the_texts_of_a_rare_language():
    batch = language_id.pa.record_batch([["aa", "bb"], language_id.pa.array([1000, 4], language_id.pa.int32()), ["x" * 960, "y" * 960]], names=["lang", "pieces", "text"])
    (out,) = language_id.cut_pieces()([batch])
    assert out.column("lang").to_pylist() == ["aa"] * 20 + ["bb"] * 4


def test_rare_words_and_bigrams_that_tell_are_kept(spark):
    words = [a + b + c for a in "bcdfghkl" for b in "bcdfghkl" for c in "bcdfghklm"][:520]
    pairs = [" ".join(f"{w} {v}" for v in words) for w in words]  # more than 2 ** 18 bigrams, each met more often than the one that tells
    plain = [f"{k} {text}" for k in range(12) for text in pairs] + [f"{k} zz aa qq" for k in range(800)]
    toxic = [f"12 {text}" for text in pairs] + [f"{k} zz aa qq" for k in range(60)] + [f"{k} zz qq" for k in range(8)] + [f"{k} rare" for k in range(6)]
    rows = [(k, int(k >= len(plain)), text) for k, text in enumerate(plain + toxic)]
    frame = spark.createDataFrame(rows, "doc_id long, toxic int, text string").repartition(8)
    shared, _ = toxicity.fit(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), F.lit(True))
    m = shared.value
    rare, zz, qq = (toxicity.numbers(m["vocabulary"], toxicity.letters(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[0])[0] for w in (b"rare", b"zz", b"qq"))
    assert rare and m["word"][rare] > 1
    place = np.searchsorted(m["pair"], zz * (len(m["vocabulary"]) + 2) + qq)
    assert m["pair"][place] == zz * (len(m["vocabulary"]) + 2) + qq and m["ratio"][place] > 1


def test_held_out_toxic_rows_reach_the_threshold(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = op2_toxicity(docs, labels).join(labels, "doc_id").where("held_out and toxic = 1").collect()
    assert np.mean([r.predicted for r in out]) > 0.9
