import random

import numpy as np
import pytest

from tidemark.llm import orderhash as O


def labelled(text):
    w = O.token_ids([text], O._Ids())[0].tolist()
    seen, out = {}, []
    for i in range(len(w) - 4):
        s = tuple(w[i : i + 5])
        seen[s] = seen.get(s, 0) + 1
        out.append((s, seen[s]))
    return out


def similarity(a, b):
    """Longest common subsequence by dynamic programming over labelled shingles."""
    if not a or not b:
        return 0.0
    row = np.zeros(len(b) + 1, int)
    for x in a:
        new = row.copy()
        for j, y in enumerate(b, 1):
            new[j] = max(row[j - 1] + 1 if x == y else 0, row[j], new[j - 1])
        row = new
    m = int(row[-1])
    return m / (len(a) + len(b) - m)


def brute(rows):
    texts = sorted({t or "" for _, t in rows})
    label = {t: i for i, t in enumerate(texts)}
    seq = [labelled(t) for t in texts]
    group = list(range(len(texts)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if min(len(seq[i]), len(seq[j])) >= 0.8 * max(len(seq[i]), len(seq[j])) and similarity(seq[i], seq[j]) >= 0.8:
                group[root(i)] = root(j)
    least = {}
    for i, t in rows:
        r = root(label[t or ""])
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return sorted(((i, least.get(root(label[t or ""]))) for i, t in rows), key=str)


def corpus(seed=0):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(500)]
    rows = [(None, None), (0, ""), (1, "a b c"), (2, "A b, c"), (None, "only nameless text of some words here")]
    i = 3
    for _ in range(8):
        origin = rng.choices(words, k=rng.randint(20, 120))
        for k in range(rng.randint(1, 7)):
            text = list(origin)
            for _ in range(k // 2 * len(text) // 60):
                text[rng.randrange(len(text))] = rng.choice(words)
            if k == 5:
                text = text[: len(text) // 2]
            if k == 6:
                text = text[len(text) // 2 :] + text[: len(text) // 2]
            rows.append((i, " ".join(text)))
            i += 1
    rows += [(i, rows[9][1]), (i + 1, rows[9][1]), (3, rows[5][1]), (9, "For " * 900), (10_000, "For " * 901), (10_001, "The end. " * 700)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, digest string, class_id int").repartition(3)


def test_against_brute_force(spark):
    rows = corpus()
    got = sorted(((r["doc_id"], r["class_id"]) for r in O.classes(frame(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_many_near_copies_of_one_text_meet_in_one_class(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(900)]
    origin = rng.choices(words, k=150)
    rows = []
    for i in range(250):
        text = list(origin)
        for _ in range(rng.randint(0, 3)):
            text[rng.randrange(150)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    assert {r["class_id"] for r in O.classes(frame(spark, rows)).collect()} == {0}


def branches(seed=0, count=25, copies=60):
    """Copies of one text, and copies of some of the copies that are near to that one copy only."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(5000)]
    origin = rng.choices(words, k=64)
    out = [list(origin) for _ in range(copies)]
    for text in out[1:]:
        text[rng.randrange(2)] = rng.choice(words)
    for _ in range(count):
        near = list(origin)
        near[-1] = rng.choice(words)
        far = list(near)
        far[8], far[0] = rng.choice(words), rng.choice(words)
        out += [near, far]
    rng.shuffle(out)
    return [(i, " ".join(t)) for i, t in enumerate(out)]


def candidates(rows):
    """Classes by brute force over all pairs of texts that share a key."""
    texts = sorted({t for _, t in rows})
    with np.errstate(over="ignore"):
        keys = [set(O.sketches(*O.shingles(*O.token_ids([t], O._Ids())))[0].tolist()) for t in texts]
    seq = [labelled(t) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if group[i] != group[j] and keys[i] & keys[j] and similarity(seq[i], seq[j]) >= 0.8:
                group = [group[j] if g == group[i] else g for g in group]
    of = {t: g for t, g in zip(texts, group, strict=True)}
    least = {}
    for i, t in rows:
        least[of[t]] = min(least.get(of[t], i), i)
    return sorted((i, least[of[t]]) for i, t in rows)


def test_copies_of_copies_in_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(O, "BLOCK", 3000, raising=False)
    rows = branches()
    got = sorted((r["doc_id"], r["class_id"]) for r in O.classes(frame(spark, rows)).collect())
    assert got == candidates(rows)


@pytest.mark.parametrize("full", [1, 1000])
def test_same_classes_whatever_counts_as_a_large_bucket(spark, monkeypatch, full):
    monkeypatch.setattr(O, "FULL", full)
    rows = branches(1, 8, 10)
    got = sorted((r["doc_id"], r["class_id"]) for r in O.classes(frame(spark, rows)).collect())
    assert got == candidates(rows)


def test_keep_one(spark):
    rows = corpus(3)
    d = frame(spark, rows)
    kept = O.keep_one(d)
    assert kept.columns == d.columns
    got = sorted((r["doc_id"] for r in kept.collect()), key=str)
    want = {c for _, c in brute(rows) if c is not None}
    assert got == sorted([*want, *[None for i, c in brute(rows) if c is None]], key=str)


def test_labelled_alignment():
    rng = random.Random(2)
    with np.errstate(over="ignore"):
        for _ in range(60):
            a = [f"w{rng.randrange(30)}" for _ in range(rng.randint(5, 60))]
            b = list(a)
            for _ in range(rng.randint(0, 4)):
                b[rng.randrange(len(b))] = "z"
            x, y = " ".join(a), " ".join(b)
            got = O.aligned(*(O.shingles(*O.token_ids([t], O._Ids()))[0] for t in (x, y)))
            want = similarity(labelled(x), labelled(y))
            assert (got >= 0.8) == (want >= 0.8)
            if want >= 0.8:
                assert abs(got - want) < 1e-12


def test_empty(spark):
    assert O.classes(frame(spark, [])).count() == 0
    assert O.keep_one(frame(spark, [])).count() == 0
