import numpy as np

from tidemark.llm import hnsw


def brute(ids, x, q, v, k):
    d = np.sqrt(((x - v) ** 2).sum(1))
    return [(i, e) for e, i in sorted((float(e), int(i)) for e, i in zip(d, ids, strict=True) if i != q)][:k]


def frame(spark, ids, x):
    rows = [(int(i), [float(c) for c in v] if v is not None else None, 0, "s") for i, v in zip(ids, x, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, shard int, block string")


def test_recall_over_shards(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD_ROWS", 500)
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(1500, 16)), rng.normal(size=(700, 16)) * 0.05 + rng.normal(size=(7, 16)).repeat(100, 0)]).astype(np.float32)
    ids = np.arange(len(x))
    df = frame(spark, ids, x)
    got = hnsw.search(hnsw.index(df, 500), df.where("vec_id % 20 = 0")).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q in range(0, len(x), 20):
        want = brute(ids, x.astype(float), q, x[q].astype(float), 10)
        mine = sorted(by[q])
        assert [r for r, _, _ in mine] == list(range(1, 11))
        assert mine == sorted(mine, key=lambda m: (m[2], m[1]))
        hits += len({i for i, _ in want} & {v for _, v, _ in mine})
    assert hits / (10 * len(by)) >= 0.97


def test_copies_nulls_and_ties(spark):
    x = [[1.0, 2.0]] * 40 + [None, [0.0, 0.0], [float("nan"), 1.0], [float("inf"), 1.0], [3.0, 2.0], [1.0, 2.0, 3.0]]
    df = frame(spark, range(len(x)), x).unionByName(frame(spark, [44], [[3.0, 2.0]]))
    got = sorted(tuple(r) for r in hnsw.nearest_neighbours(df, df.where("vec_id in (0, 44, 45, 40, 41)")).collect())
    assert [g for g in got if g[0] == 0] == [(0, r, r, 0.0) for r in range(1, 11)]
    assert [g[2] for g in got if g[0] == 44] == list(range(10)) and all(g[3] == 2.0 for g in got if g[0] == 44)
    assert {g[0] for g in got} == {0, 44}


def test_empty(spark):
    df = frame(spark, [], [])
    assert hnsw.nearest_neighbours(df, df).count() == 0


def test_components_whose_squares_overflow_or_vanish(spark):
    for unit in (1e160, 1e-170):
        x = [[unit, 0.0], [2 * unit, 0.0], [4 * unit, 0.0], [8 * unit, unit]]
        df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
        got = sorted(tuple(r) for r in hnsw.nearest_neighbours(df, df.where("vec_id = 0")).collect())
        assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
        assert np.allclose([g[3] / unit for g in got], [1, 3, np.sqrt(50)])


def test_many_lengths_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "MOST_LENGTHS", 2)
    rows = [(10 * n + i, [1.0 + i] * n) for n in range(1, 6) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = hnsw.nearest_neighbours(df, df).collect()
    assert len(got) == 5 * 3 * 2 and all(r["query_id"] // 10 == r["vec_id"] // 10 for r in got)
