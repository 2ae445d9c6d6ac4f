import itertools
import random
import zlib

import pandas as pd

from tidemark.llm import resharding as S


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 3, "b") for i, t in rows], "doc_id long, text string, shard int, block string").repartition(3)


def corpus(n=700, seed=1):
    rng = random.Random(seed)
    rows = [(i, "x" * rng.choice([3, 40, 900]) + str(rng.randrange(400))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (5, rows[5][1]), (None, "nameless")]


def test_law_bytes(spark):
    rows = corpus()
    got = S.reshard(frame(spark, rows), 8, 6).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == want
    sizes, slots, homes = {}, {}, {}
    for r in got:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        homes.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(sizes) == 8 and max(sizes.values()) - min(sizes.values()) <= 0.02 * sum(sizes.values()) / 8
    assert all(len(h) == 1 for h in homes.values())


def test_one_text_with_a_third_of_all_rows_is_divided(spark):
    rows = corpus(400) + [(1000 + i, "the same long text " * 20) for i in range(600)]
    sizes = {}
    for r in S.reshard(frame(spark, rows), 8, 6).collect():
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert max(sizes.values()) <= 1.05 * sum(sizes.values()) / 8


def test_a_heavy_block_keeps_equal_texts_together(spark):
    rng = random.Random(2)
    rows = [(i, f"text {rng.randrange(30)} " * 20) for i in range(600)]
    homes, sizes = {}, {}
    for r in S.reshard(frame(spark, rows), 4, 3, n_blocks=2).collect():
        homes.setdefault(r["text_crc32"], set()).add(r["shard"])
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + r["size"]
    assert all(len(h) == 1 for h in homes.values()) and len(sizes) == 4


def test_ids_of_any_type(spark):
    docs = spark.createDataFrame([("a", "x"), (None, "y"), ("a", "x")], "doc_id string, text string")
    assert sorted(r["slot"] for r in S.reshard(docs, 1, 1).collect()) == [0, 1, 2]


def test_flow_moves_the_fewest_bytes():
    rng = random.Random(3)
    for _ in range(40):
        a, b = rng.randint(1, 4), rng.randint(1, 4)
        supply = [rng.randint(0, 9) for _ in range(a)]
        total = sum(supply)
        capacity = [total // b + (j < total % b) for j in range(b)]
        flow = S.min_cost_flow(supply, capacity)
        assert [sum(f for (i, _), f in flow.items() if i == k) for k in range(a)] == supply
        assert [sum(f for (_, j), f in flow.items() if j == k) for k in range(b)] == capacity
        stay = sum(min(supply[k], capacity[k]) for k in range(min(a, b)))  # nothing can stay beyond this
        assert sum(f for (i, j), f in flow.items() if i != j) == total - stay


def test_blocks_against_every_placement():
    blocks = pd.DataFrame({"old": [0, 0, 0, 1, 1], "size": [5, 4, 3, 6, 2]})
    shard = S.place_blocks(blocks, 3)
    spread = lambda s: max(x := [sum(z for z, t in zip(blocks["size"], s) if t == k) for k in range(3)]) - min(x)  # noqa: E731, B905
    assert spread(shard) <= min(spread(s) for s in itertools.product(range(3), repeat=5)) + 1


def test_rewrite_keeps_untouched_shards_and_all_columns(spark, tmp_path):
    docs = frame(spark, corpus())
    touched = S.rewrite_affected(docs, 8, 6, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert set(docs.columns) <= set(back.columns)
    assert sorted(r[0] for r in back.select("_shard").distinct().collect()) == touched
    assert back.count() == S.reshard(docs, 8, 6).count() and len(touched) == 8


def test_empty(spark):
    assert S.reshard(frame(spark, []), 8, 6).count() == 0
