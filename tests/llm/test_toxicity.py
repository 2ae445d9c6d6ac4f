import random

import numpy as np

from tidemark.llm import toxicity
from tidemark.llm.common import crc_mod

BAD = ["grubby", "vile", "rotten"]


def corpus(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        text = [[rng.choice(words) for _ in range(rng.randint(3, 12))] for _ in range(rng.randint(2, 9))]
        if toxic:
            text[rng.randrange(len(text))].insert(1, rng.choice(BAD))
        docs.append((i, " ".join(" ".join(s).capitalize() + "." for s in text), "fr", "x", 0.5))
        labels.append((i, 1, int(toxic), "label column"))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, score double"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string"),
    )


def test_held_out_accuracy_and_located_sentences(spark):
    docs, labels = corpus(900)
    d, lab = frames(spark, docs, labels)
    model = toxicity.train(d, lab, crc_mod("id", 3) != 1)
    rows = toxicity.score(d, model, ("doc_id", "text")).withColumn("held_out", crc_mod("doc_id", 3) == 1).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 200
    right = [(r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in held]
    assert np.mean(right) > 0.98
    for r in held:
        if r["doc_id"] % 4 == 0 and r["score"] >= 0.7:
            assert any(b in r["text"][o["start"] : o["end"]].lower() for o in r["offending"] for b in BAD)


def test_noisy_or_matches_brute_force(spark):
    model = toxicity.Model(-2.0, {toxicity.bucket("vile"): 3.0, toxicity.bucket("calm"): -1.0})
    texts = [None, "", "...", "vile", "Vile vile calm. nothing here\nvile!", "é" * 50000 + " vile"]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity.score(d, model).collect()}
    p = lambda s: 1 / (1 + np.exp(-s))
    want = [0, 0, 0, p(1), 1 - (1 - p(0)) * (1 - p(-2)) * (1 - p(1)), p(1)]
    assert np.allclose([got[i] for i in range(6)], want)


def test_labels_with_nulls_repeats_and_strangers(spark):
    docs, labels = corpus(40)
    odd = [(None, 1, 1, ""), (5, None, None, ""), (999, 1, 1, ""), (0, 1, 0, ""), (0, 1, 1, "")]
    d, lab = frames(spark, docs + [docs[3], (None, None, None, None, None)], labels + odd)
    rows = toxicity.sample(d, lab).collect()
    assert len({r["id"] for r in rows if r["toxic"] == 0}) == 30 and len({r["id"] for r in rows if r["toxic"] == 1}) == 10
    assert len(rows) == 41  # the repeated document is there twice


def test_sample_is_bounded_in_bytes(spark, monkeypatch):
    docs, labels = corpus(40)
    d, lab = frames(spark, docs + [(40, "w " * 3000, "fr", "x", 0.5)], labels + [(40, 1, 1, "")])
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 2000)
    monkeypatch.setattr(toxicity, "LONGEST", 5000)
    rows = toxicity.sample(d, lab).collect()
    assert 40 not in {r["id"] for r in rows} and {r["toxic"] for r in rows} == {0, 1}
    for c in (0, 1):
        assert 0 < sum(len(r["text"].encode()) for r in rows if r["toxic"] == c) <= 1000


def test_slope_of_the_fit_by_differences():
    docs, labels = corpus(60)
    bags = toxicity.Bags((t[2], d[1]) for d, t in zip(docs, labels, strict=True))
    rng = np.random.default_rng(3)
    w, bias = rng.normal(0, 0.3, len(bags.held)), -2.0
    _, slope = bags.loss_and_slope(w, bias)
    by_hand = -sum(
        wt * (np.log(1 - q) if t else np.log(q))
        for (_, text, *_), (_, _, t, _), wt in zip(docs, labels, bags.weight, strict=True)
        for q in [none(text, dict(zip(bags.held.tolist(), w, strict=True)), bias)]
    )
    assert np.isclose(bags.loss_and_slope(w, bias)[0], by_hand)
    for k in [*rng.choice(len(w), 20, replace=False), len(w)]:
        step = np.zeros(len(w) + 1)
        step[k] = 1e-5
        up, down = (bags.loss_and_slope(w + s * step[:-1], bias + s * step[-1])[0] for s in (1, -1))
        assert np.isclose((up - down) / 2e-5, slope[k], rtol=1e-4, atol=1e-9)


def none(text, weights, bias):
    """Probability that no sentence of a text is toxic."""
    out = 1.0
    for s in text.lower().replace("\n", ".").split("."):
        words = set(s.split())
        if words:
            z = bias + sum(weights.get(f, 0.0) for w in words for f in toxicity.features(w))
            out *= 1 - 1 / (1 + np.exp(-z))
    return out


def test_forms_of_a_stem_that_training_never_saw(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(900):
        text = rng.choices(words, k=30)
        if i % 4 == 0:
            text[5:5] = [f"grombel{rng.randrange(10_000)}", f"grombel{rng.randrange(10_000)}"]
        docs.append((i, " ".join(text) + ".", "de", "x", 0.5))
        labels.append((i, 1, int(i % 4 == 0), ""))
    d, lab = frames(spark, docs, labels)
    model = toxicity.train(d, lab, crc_mod("id", 3) != 1)
    held = [r for r in toxicity.score(d, model).where(crc_mod("doc_id", 3) == 1).collect()]
    assert np.mean([(r["score"] >= 0.7) == (r["doc_id"] % 4 == 0) for r in held]) > 0.97


def test_one_class_or_nothing_scores_zero(spark):
    docs, labels = corpus(20)
    d, lab = frames(spark, docs, [x for x in labels if not x[2]])
    assert {r["score"] for r in toxicity.score(d, toxicity.train(d, lab)).collect()} == {0.0}
    e, none = frames(spark, [], [])
    assert toxicity.score(e, toxicity.train(e, none)).count() == 0


def test_drop_keeps_columns(spark):
    d, _ = frames(spark, corpus(8)[0], [])
    model = toxicity.Model(-9.0, {toxicity.bucket(b): 20.0 for b in BAD})
    kept = toxicity.drop_toxic(d, model)
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 5, 6, 7]
