"""Minimum-cost-flow resharding.

Rows are grouped into blocks and parts of blocks by the hash of their text, so equal texts travel
together.  The driver sees only the table of parts (at most ``2 * n_blocks * SPLIT`` rows, whatever the
input), solves a
minimum-cost flow from the old shards' sizes to the new shards' capacities (a byte that stays costs
nothing, a byte that moves costs one) and realises the flow with whole blocks.  Block placement
goes back to the rows as a broadcast of that bounded table.

Defined results: null text counts as empty (size 1); empty table gives an empty result; repeated
rows and ids are kept and get slots of their own; ids of any type are accepted; texts of any length
count whole; a block above a quarter of a shard's capacity is divided into its parts, which keeps
equal texts together; only a part that alone is above a shard's capacity (in effect one text with
very many copies) is divided further, by the hash of doc_id, so that sizes stay near equal.
Other columns of the input play no part.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

N_BLOCKS = 2048
#: Parts of each block; they bound the rows that one slot-numbering task sees.
SPLIT = 64


def min_cost_flow(supply: Sequence[int], capacity: Sequence[int], keep: dict[int, int] | None = None) -> dict[tuple[int, int], int]:
    """Bytes to send from each old to each new shard, moving as few as possible.

    ``keep`` maps an old shard to the new shard that is the same place (identity by default);
    only those arcs are free.  Successive shortest augmenting paths on the residual network.
    """
    keep = {i: i for i in range(len(supply))} if keep is None else keep
    a, b = len(supply), len(capacity)
    source, sink = a + b, a + b + 1
    left: dict[tuple[int, int], int] = defaultdict(int)
    cost: dict[tuple[int, int], int] = {}
    near: dict[int, set[int]] = defaultdict(set)

    def arc(u: int, v: int, cap: int, c: int) -> None:
        left[u, v] += cap
        cost[u, v], cost[v, u] = c, -c
        near[u].add(v)
        near[v].add(u)

    for i, s in enumerate(supply):
        arc(source, i, s, 0)
        for j in range(b):
            arc(i, a + j, s, 0 if keep.get(i) == j else 1)
    for j, c in enumerate(capacity):
        arc(a + j, sink, c, 0)
    while True:
        dist, back, queue, queued = {source: 0}, {}, deque([source]), {source}
        while queue:
            u = queue.popleft()
            queued.discard(u)
            for v in near[u]:
                if left[u, v] > 0 and dist[u] + cost[u, v] < dist.get(v, 1 << 60):
                    dist[v], back[v] = dist[u] + cost[u, v], u
                    if v not in queued:
                        queue.append(v)
                        queued.add(v)
        if sink not in dist:
            break
        path, v = [], sink
        while v != source:
            path.append((back[v], v))
            v = back[v]
        push = min(left[e] for e in path)
        for u, v in path:
            left[u, v] -= push
            left[v, u] += push
    return {(i, j): f for i in range(a) for j in range(b) if (f := left[a + j, i]) > 0}


def place_blocks(blocks: pd.DataFrame, n_new: int) -> np.ndarray:
    """New shard of each block (columns old, size): whole blocks realise the flow, then sizes are levelled."""
    old, size = blocks["old"].to_numpy(), blocks["size"].to_numpy()
    n_old = int(old.max(initial=-1)) + 1
    total = int(size.sum())
    capacity = [total // n_new + (j < total % n_new) for j in range(n_new)]
    supply = [int(size[old == i].sum()) for i in range(n_old)]
    flow = min_cost_flow(supply, capacity)
    shard = np.where(old < n_new, old, -1)
    for i in range(n_old):
        mine = [k for k in np.argsort(-size, kind="stable") if old[k] == i]
        for j, need in sorted(((j, f) for (x, j), f in flow.items() if x == i and j != i), key=lambda x: -x[1]):
            rest = []
            for k in mine:
                if size[k] <= need:
                    shard[k], need = j, need - int(size[k])
                else:
                    rest.append(k)
            mine = rest
        for k in mine:
            if shard[k] < 0:  # the old shard goes away: what the flow left over goes to the emptiest
                now = np.bincount(shard[shard >= 0], size[shard >= 0], n_new)
                shard[k] = int(np.argmin(now))
    now = np.bincount(shard, size, n_new).astype(np.int64) if len(shard) else np.zeros(n_new, np.int64)
    for _ in range(4 * len(size)):  # level: the block nearest to half of the widest gap goes over
        hi, lo = int(np.argmax(now)), int(np.argmin(now))
        gap = now[hi] - now[lo]
        mine = np.flatnonzero((shard == hi) & (size < gap))
        if gap <= 1 or not len(mine):
            break
        k = mine[np.argmin(np.abs(2 * size[mine] - gap))]
        shard[k] = lo
        now[hi] -= size[k]
        now[lo] += size[k]
    return shard


def with_blocks(docs: DataFrame, n_blocks: int = N_BLOCKS, whole: bool = False) -> DataFrame:
    """doc_id, size, text_crc32 and the block and part that each row belongs to; the whole row too, if asked for."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        *([F.struct("*").alias("row")] if whole else []),
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.pmod(F.xxhash64(text), F.lit(n_blocks)).cast("int").alias("block"),
        F.pmod(F.xxhash64(text, F.lit(1)), F.lit(SPLIT)).cast("int").alias("part"),
        F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(SPLIT)).cast("int").alias("sub"),
    )


def reshard(docs: DataFrame, n_new: int, n_old: int, n_blocks: int = N_BLOCKS, whole: bool = False) -> DataFrame:
    """Moves documents from ``n_old`` shards (block number modulo ``n_old``) to ``n_new`` near-equal ones.

    Returns doc_id, size, text_crc32, old_shard, shard, slot (and row, the whole row, if asked for): slots
    run from 0 without gaps in each shard.
    """
    spark = docs.sparkSession
    rows, own = with_blocks(docs, n_blocks, whole), with_blocks(docs, n_blocks)
    count = [F.count("*").alias("rows"), F.sum("size").alias("size")]
    parts = own.groupBy("block", "part").agg(*count).toPandas()  # at most n_blocks * SPLIT rows
    # parts of many rows are numbered in sub-parts; fewer than n_blocks parts can be above this share
    large = parts.loc[parts["rows"] > parts["rows"].sum() / n_blocks, ["block", "part"]]
    if len(large):
        marks = F.broadcast(spark.createDataFrame(large.astype("int32").assign(large=True), "block int, part int, large boolean"))
        sub = F.when(F.col("large"), F.col("sub")).otherwise(0).alias("sub")
        with_sub = lambda d: d.join(marks, ["block", "part"], "left").select(*[c for c in d.columns if c != "sub"], sub)
        rows, fine = with_sub(rows), own.join(marks, ["block", "part"]).groupBy("block", "part", "sub").agg(*count).toPandas()  # at most n_blocks * SPLIT rows
        parts = pd.concat([parts.merge(large.assign(large=True), how="left", on=["block", "part"]).query("large.isna()").drop(columns="large").assign(sub=0), fine])
    else:
        rows, parts = rows.withColumn("sub", F.lit(0)), parts.assign(sub=0)
    parts = parts.sort_values(["block", "part", "sub"], ignore_index=True)
    parts["old"] = parts["block"] % n_old
    capacity = parts["size"].sum() / n_new
    block, part = (parts.groupby(k)["size"].transform("sum") for k in (["block"], ["block", "part"]))
    parts["unit"] = (parts["block"].astype("int64") * SPLIT + np.where(block > capacity / 4, parts["part"], 0)) * SPLIT + np.where(part > capacity, parts["sub"], 0)
    units = parts.groupby("unit", as_index=False).agg(old=("old", "first"), size=("size", "sum"))
    units["shard"] = place_blocks(units, n_new)
    parts = parts.merge(units[["unit", "shard"]], on="unit")
    parts["first"] = parts.groupby("shard")["rows"].cumsum() - parts["rows"]
    placed = spark.createDataFrame(
        parts[["block", "part", "sub", "old", "shard", "first"]].astype(dict.fromkeys(["block", "part", "sub", "old", "shard"], "int32") | {"first": "int64"}),
        "block int, part int, sub int, old_shard int, shard int, first long",
    )
    inside = Window.partitionBy("block", "part", "sub").orderBy("doc_id", "text_crc32")
    return (
        rows.withColumn("n", F.row_number().over(inside))
        .join(F.broadcast(placed), ["block", "part", "sub"])  # at most 2 * n_blocks * SPLIT rows of six numbers
        .select(*(["row"] if whole else []), "doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("first") + F.col("n") - 1).alias("slot"))
    )


def rewrite_affected(docs: DataFrame, n_new: int, n_old: int, out_dir: str, n_blocks: int = N_BLOCKS) -> list[int]:
    """Writes the shards whose rows change, one folder ``_shard=N`` each, and returns their numbers.

    A shard that no row leaves or enters keeps its files and is not written.
    """
    placed = reshard(docs, n_new, n_old, n_blocks, whole=True)
    moved = placed.where("old_shard <> shard")
    touched = sorted(r[0] for r in moved.select(F.explode(F.array("old_shard", "shard")).alias("s")).distinct().collect())  # one row per shard
    rows = placed.where(F.col("shard").isin(touched or [-1])).select("row.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    rows.write.mode("overwrite").partitionBy("_shard").parquet(out_dir)
    return touched
