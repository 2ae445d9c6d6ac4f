import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import suffixes as S


def brute(rows, length):
    count = Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, t in texts:
        count.update(t[p : p + length] for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if count[t[p : p + length]] > 1:
                gone[p : p + length] = True
        spans = int((gone[:-1] & ~np.append(False, gone[:-2])).sum()) if len(t) else 0
        out.append((i, len(t), int(gone.sum()), spans, bytes(b for k, b in enumerate(t) if not gone[k])))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh é\x00", k=rng.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(25, 120)) for _ in range(6)]
    rows = [(None, None), (0, ""), (1, "short"), (2, "short"), (3, "a" * 150), (4, "a" * 199), (5, "a" * 450), (6, "ab" * 300)]
    for i in range(7, 60):
        text = prose(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            text += p[rng.randrange(20) : len(p) - rng.randrange(20)] + prose(rng.randint(0, 8))
        rows.append((i, text))
    rows += [(100, rows[20][1]), (20, rows[20][1]), (101, rows[21][1][:-1] + "!"), (102, prose(3000) + passages[0]), (103, "xyz" * 99)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, digest string").repartition(3)


@pytest.mark.parametrize("limits", [None, (500, 3000, 40)])
def test_against_brute_force(spark, monkeypatch, limits):
    if limits:
        for name, x in zip(("SLICE_BYTES", "PACK_BYTES", "BUCKET_ANCHORS"), limits, strict=True):
            monkeypatch.setattr(S, name, x)
    rows = corpus(1 if limits else 2)
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in S.drop_repeats(frame(spark, rows)).collect()), key=str)
    want = brute(rows, S.LENGTH)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert got == want
    assert sum(w[2] for w in want) > 0


def test_deep_shallow_order():
    rng = np.random.default_rng(3)
    for alphabet, width in ((2, 200), (250, 200), (1, 64), (3, 20)):
        rows = rng.integers(0, alphabet, (400, width)).astype(np.uint8)
        rows[100:200] = rows[0]
        rows[150:200, width // 2 :] = rng.integers(0, 2, (50, width - width // 2))
        group = rng.integers(0, 7, 400)
        order = S.deep_shallow(rows, group)
        strings = [(int(group[i]), rows[i].tobytes()) for i in order]
        assert strings == sorted(strings) and sorted(order) == list(range(400))
        lcp = S.common(rows, order, group)
        for k in range(1, 400):
            a, b = strings[k - 1], strings[k]
            same = next((j for j in range(width) if a[1][j] != b[1][j]), width)
            assert lcp[k] == (same if a[0] == b[0] else -1)


def test_long_texts_in_pieces():
    data = np.random.default_rng(1).integers(0, 256, 3000).astype(np.uint8)
    with np.errstate(over="ignore"):
        h, _, a, p, n = S.anchors(data, np.array([3000]))
        assert n.sum() == 3000 - S.LENGTH + 1
        assert (a >= p + n - 1).all() and (a + S.GRAM <= p + S.LENGTH).all()


def test_empty(spark):
    assert S.drop_repeats(frame(spark, [])).count() == 0
