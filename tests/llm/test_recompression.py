import random

import numpy as np

from tidemark.llm import recompression as R


def brute(rows, window):
    first = {}
    for i, t in rows:
        if i is not None:
            w = (t or "").encode().split()
            for p in range(len(w) - window + 1):
                key = tuple(w[p : p + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone |= set(range(p, p + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def corpus(seed, window):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["For"] * 5
    passages = [rng.choices(words, k=rng.randint(window - 2, 3 * window)) for _ in range(5)] + [["For"] * (3 * window), ["a", "b"] * (2 * window)]
    rows = [(None, "For " * 100), (0, None), (1, ""), (2, " \n ")]
    for i in range(3, 60):
        text = []
        for _ in range(rng.randint(0, 4)):
            text += rng.choices(words, k=rng.randint(0, 30))
            p = rng.choice(passages)
            text += p[rng.randrange(5) : len(p) - rng.randrange(5)]
        rows.append((i, rng.choice([" ", "\n"]).join(text)))
    rows += [(60, rows[10][1]), (61, rows[10][1]), (10, rows[10][1]), (10, "other " * 70 + rows[12][1]), (62, "x\x1cy é " * 80), (63, "x\x1cy é " * 90)]
    rng.shuffle(rows)
    return rows


def check(spark, seed, window):
    rows = corpus(seed, window)
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, at int, digest string").repartition(3)
    got = sorted((tuple(r) for r in R.drop_repeats(d, window).collect()), key=str)
    assert got == brute(rows, window)


def test_against_brute_force(spark):
    check(spark, 1, 50)


def test_small_packs_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(R, "PACK_BYTES", 2000)
    monkeypatch.setattr(R, "BUCKET_WINDOWS", 300)
    monkeypatch.setattr(R, "SLICE_WORDS", 100)
    check(spark, 2, 20)


def test_equal_windows_have_equal_symbols():
    rng = np.random.default_rng(0)
    for trial in range(30):
        core = rng.integers(0, [3, 50, 2][trial % 3], 120).astype(np.uint64) + np.uint64(7)
        with np.errstate(over="ignore"):
            seen = {}
            for _ in range(3):
                w = np.concatenate([rng.integers(0, 9, rng.integers(0, 30)).astype(np.uint64), core, rng.integers(0, 9, rng.integers(0, 30)).astype(np.uint64)])
                key, starts = R.window_symbols(w, np.array([len(w)]))
                for p in np.flatnonzero(starts):
                    assert key[p] != R.NONE
                    assert seen.setdefault(w[p : p + R.WINDOW].tobytes(), key[p]) == key[p]


def test_empty(spark):
    d = spark.createDataFrame([], "doc_id long, text string")
    assert R.drop_repeats(d).count() == 0
