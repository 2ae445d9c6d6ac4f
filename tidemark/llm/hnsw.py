"""Nearest neighbours by a hierarchical navigable small-world graph per shard.

Vectors are dealt to shards of bounded size by the hash of their id.  In a shard equal vectors
become one node.  Nodes enter levels with geometrically falling odds; each level links a node to
diverse near nodes that entered before it, and back.  Neighbours are flat arrays, a row per node and
level, stored as one table row per shard.  A search goes down the levels greedily and spreads on the
lowest one with a beam, for a block of queries at a time; shard results are merged by rank.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no
part, neither as queries nor as candidates; vectors only meet vectors of their own length; ties go to
the smaller id; rows that repeat an id are candidates each; with fewer candidates than asked for all
are returned; components whose squares would overflow or vanish are measured after scaling by a power
of two; texts play no part; an empty table gives an empty result; columns other than vec_id and
embedding play no part, whatever their names.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

SHARD_ROWS, QUERY_BLOCK = 4096, 512
#: Different vector lengths whose table is broadcast; more are joined by a shuffle.
MOST_LENGTHS = 65_536
#: Links per node (twice as many on the lowest level), near nodes looked at per link choice, beam width.
LINKS, LOOKED_AT, BEAM = 16, 96, 96
INDEX = "dim int, shard int, ids binary, starts binary, vectors binary, levels binary, links binary"


def valid(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array of double) of the vectors that take part, and their length."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite & F.exists("embedding", lambda x: x != 0)).withColumn("dim", F.size("embedding"))


def scale_of(*arrays: np.ndarray) -> float:
    """1, or the power of two that brings the largest component near 1 where squares would overflow or vanish."""
    most = max((float(np.abs(a).max()) for a in arrays if a.size), default=1.0)
    return 1.0 if 1e-140 < most < 1e140 or most == 0 else 2.0 ** -max(-1000, min(1000, int(np.frexp(most)[1])))


def _lengths(sizes: DataFrame) -> DataFrame:
    """One row per vector length, marked for broadcast if a count shows that they are few."""
    return F.broadcast(sizes) if sizes.limit(MOST_LENGTHS + 1).count() <= MOST_LENGTHS else sizes


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all rows of b; a and b are small blocks of one shard."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0)


def diverse(x: np.ndarray, near: np.ndarray, dist: np.ndarray, most: int) -> np.ndarray:
    """Of near nodes (rows, nearest first; -1: none) those nearer to the row's node than to any node chosen for it."""
    n, k = near.shape
    points = x[near]
    length = (points * points).sum(2)
    between = length[:, :, None] + length[:, None, :] - 2 * (points @ points.transpose(0, 2, 1))
    chosen = np.zeros((n, k), bool)
    blocked = near < 0
    for j in range(k):
        ok = ~blocked[:, j] & (chosen.sum(1) < most)
        chosen[:, j] = ok
        blocked |= ok[:, None] & (between[:, j] < dist)
    spare = np.cumsum(~chosen & (near >= 0), 1) <= (most - chosen.sum(1))[:, None]
    chosen |= spare & (near >= 0)
    out = np.full((n, most), -1, np.int32)
    row, col = np.nonzero(chosen)
    slot = (np.cumsum(chosen, 1) - 1)[row, col]
    out[row, slot] = near[row, col]
    return out


def link_level(x: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
    """Neighbours (flat array, -1: none) of the nodes of one level; a node links to nodes that entered before it, and they back."""
    n = len(nodes)
    own = x[nodes]
    out = np.full((n, most), -1, np.int32)
    back: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for first in range(0, n, 256):
        rows = np.arange(first, min(first + 256, n))
        d = squared(own[rows], own[: rows[-1] + 1])
        d[np.arange(rows[-1] + 1)[None] >= rows[:, None]] = np.inf
        k = min(LOOKED_AT // 2, d.shape[1])
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        dist = np.take_along_axis(d, near, 1)
        order = np.argsort(dist, axis=1, kind="stable")
        near, dist = np.take_along_axis(near, order, 1), np.take_along_axis(dist, order, 1)
        near = np.where(np.isfinite(dist), near, -1)
        got = diverse(own, near, dist, most // 2)
        out[rows, : most // 2] = got
        r, c = np.nonzero(got >= 0)
        a, b = got[r, c], rows[r]
        back.append((a, b, ((own[a] - own[b]) ** 2).sum(1)))
    if back:  # links back, nearest first, as many as fit
        to, node, dist = (np.concatenate(v) for v in zip(*back, strict=True))
        order = np.lexsort((dist, to))
        to, node = to[order], node[order]
        at = np.arange(len(to)) - np.searchsorted(to, to)
        room = most - (out[to] >= 0).sum(1)
        fits = at < room
        out[to[fits], (out >= 0).sum(1)[to[fits]] + at[fits]] = node[fits]
        lost = ~fits  # a node whose links back were all refused is still found: its nearest takes it in place of the farthest
        held = np.zeros(n, bool)
        held[node[fits]] = True
        for t, v in zip(to[lost], node[lost], strict=True):
            if not held[v]:
                out[t, most - 1 - (v % max(1, most // 4))] = v
                held[v] = True
    return np.where(out >= 0, nodes[np.maximum(out, 0)], -1).astype(np.int32)


def build(ids: np.ndarray, vectors: np.ndarray) -> dict[str, bytes]:
    """Graph of one shard: distinct vectors as nodes, node levels, and per level a flat neighbour array."""
    order = np.lexsort((ids, *vectors.T[::-1]))
    ids, vectors = ids[order], vectors[order]
    new = np.ones(len(ids), bool)
    new[1:] = (vectors[1:] != vectors[:-1]).any(1)
    starts = np.append(np.flatnonzero(new), len(ids)).astype(np.int64)
    x = vectors[starts[:-1]]
    n = len(x)
    near = x * scale_of(x)
    rng = np.random.default_rng(7)
    enter = rng.permutation(n).astype(np.int32)
    level = np.minimum((-np.log(1 - rng.random(n)) / np.log(LINKS)).astype(np.int32), 6)
    links = []
    for h in range(int(level.max(initial=0)) + 1):
        nodes = enter[level[enter] >= h]
        table = np.full((n, 2 * LINKS if h == 0 else LINKS), -1, np.int32)
        table[nodes] = link_level(near, nodes, table.shape[1])
        links.append(table)
    return {
        "ids": ids.astype("<i8").tobytes(),
        "starts": starts.astype("<i8").tobytes(),
        "vectors": x.astype("<f8").tobytes(),
        "levels": level.tobytes(),
        "links": b"".join(t.astype("<i4").tobytes() for t in links),
    }


class Graph:
    def __init__(self, dim: int, ids: bytes, starts: bytes, vectors: bytes, levels: bytes, links: bytes):
        self.ids, self.starts = np.frombuffer(ids, "<i8"), np.frombuffer(starts, "<i8")
        self.x = np.frombuffer(vectors, "<f8").reshape(-1, dim)
        self.level = np.frombuffer(levels, np.int32)
        flat, n = np.frombuffer(links, "<i4"), len(self.x)
        self.links, at = [], 0
        for h in range(int(self.level.max(initial=0)) + 1):
            width = 2 * LINKS if h == 0 else LINKS
            self.links.append(flat[at : at + n * width].reshape(n, width))
            at += n * width

    def search(self, queries: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Nodes (-1: none) and squared distances, nearest first, for a block of queries in step."""
        m, n = len(queries), len(self.x)
        entry = int(np.argmax(self.level))
        at = np.full(m, entry)
        dist = ((self.x[at] - queries) ** 2).sum(1)
        for h in range(len(self.links) - 1, 0, -1):
            while True:
                near = self.links[h][at]
                d = np.where(near >= 0, ((self.x[near] - queries[:, None]) ** 2).sum(2), np.inf)
                best = d.argmin(1)
                less = d[np.arange(m), best] < dist
                if not less.any():
                    break
                at = np.where(less, near[np.arange(m), best], at)
                dist = np.where(less, d[np.arange(m), best], dist)
        width = min(beam, n)
        held = np.full((m, width), -1, np.int64)
        held_d = np.full((m, width), np.inf)
        opened = np.zeros((m, width), bool)
        seen = np.zeros((m, n), bool)
        held[:, 0], held_d[:, 0] = at, dist
        seen[np.arange(m), at] = True
        active = np.arange(m)
        while len(active):
            waiting = np.where(opened[active] | (held[active] < 0), np.inf, held_d[active])
            pick = waiting.argmin(1)
            go = np.isfinite(waiting[np.arange(len(active)), pick])
            active, pick = active[go], pick[go]
            if not len(active):
                break
            opened[active, pick] = True
            near = self.links[0][held[active, pick]]
            fresh = (near >= 0) & ~seen[active[:, None], near]
            seen[active[:, None], np.where(near >= 0, near, held[active, pick][:, None])] = True
            d = np.where(fresh, ((self.x[near] - queries[active][:, None]) ** 2).sum(2), np.inf)
            every = np.concatenate([held_d[active], d], 1)
            best = np.argpartition(every, width - 1, axis=1)[:, :width]
            held_d[active] = np.take_along_axis(every, best, 1)
            held[active] = np.take_along_axis(np.concatenate([held[active], np.where(fresh, near, -1)], 1), best, 1)
            opened[active] = np.take_along_axis(np.concatenate([opened[active], np.zeros_like(fresh)], 1), best, 1)
        held = np.where(np.isfinite(held_d), held, -1)
        order = np.argsort(held_d, axis=1, kind="stable")
        return np.take_along_axis(held, order, 1), np.take_along_axis(held_d, order, 1)

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
        """(query, id, distance) of the k nearest found, each query without itself."""
        scale = scale_of(self.x, queries)
        plain = self.x
        self.x = plain * scale if scale != 1 else plain
        nodes, _ = self.search(queries * scale)
        self.x = plain
        for q, v, found in zip(query_ids, queries, nodes, strict=True):
            found = found[found >= 0]
            exact = np.sqrt((((self.x[found] - v) * scale) ** 2).sum(1)) / scale
            got: list[tuple[float, int]] = []
            for d, node in sorted(zip(exact.tolist(), found.tolist(), strict=True)):
                if len(got) >= k and d > got[k - 1][0]:
                    break
                same = self.ids[self.starts[node] : self.starts[node + 1]]
                got = sorted(got + [(d, int(i)) for i in same[: k + 1 + int((same[: k + 1] == q).sum())] if i != q])
            yield from ((int(q), i, d) for d, i in got[:k])


def _tables(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    held = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(held) if held else None


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).reshape(-1, dim)


def _build(key: tuple, group: pa.Table) -> pa.Table:
    dim, shard = (x.as_py() for x in key)
    made = build(group["vec_id"].to_numpy(), _matrix(group["embedding"], dim))
    return pa.Table.from_pylist(
        [{"dim": dim, "shard": shard} | made],
        schema=pa.schema([("dim", pa.int32()), ("shard", pa.int32()), *((n, pa.binary()) for n in ("ids", "starts", "vectors", "levels", "links"))]),
    )


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard. The number of shards of each vector length follows its count."""
    rows = valid(vectors)
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"))
    dealt = rows.join(_lengths(sizes), "dim")
    shards = F.ceil(F.col("n") / shard_rows)
    keyed = dealt.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.lit(9)), shards).cast("int")).select("dim", "shard", "vec_id", "embedding")
    return keyed.groupBy("dim", "shard").applyInArrow(_build, INDEX)


def _pack(key: tuple, group: pa.Table) -> pa.Table:
    dim, block = (x.as_py() for x in key)
    q, v = group["vec_id"].to_numpy(), _matrix(group["embedding"], dim)
    return pa.Table.from_pylist(
        [{"dim": dim, "block": block, "query_ids": q.astype("<i8").tobytes(), "queries": v.astype("<f8").tobytes()}],
        schema=pa.schema([("dim", pa.int32()), ("block", pa.int32()), ("query_ids", pa.binary()), ("queries", pa.binary())]),
    )


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    last, graph = None, None
    for b in batches:
        for r in b.to_pylist():
            if (r["dim"], r["shard"]) != last:
                last = r["dim"], r["shard"]
                graph = Graph(r["dim"], *(r[n] for n in ("ids", "starts", "vectors", "levels", "links")))
            ids = np.frombuffer(r["query_ids"], "<i8")
            found = [*graph.nearest(ids, np.frombuffer(r["queries"], "<f8").reshape(-1, r["dim"]), k)]
            q, v, d = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(d, pa.float64())], names=["query_id", "vec_id", "score"])


def search(graphs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest of every query over all shards.

    Queries travel in blocks; each block meets each shard of its vector length, by an equality join.
    """
    rows = valid(queries).distinct()
    sizes = rows.groupBy("dim").agg(F.count("*").alias("n"))
    shards = graphs.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    per_dim = _lengths(sizes.join(shards, "dim"))
    block = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.ceil(F.col("n") / QUERY_BLOCK)).cast("int")
    blocks = rows.join(per_dim, "dim").withColumn("block", block).groupBy("dim", "block").applyInArrow(_pack, "dim int, block int, query_ids binary, queries binary")
    spread = blocks.join(per_dim, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("n", "shards")
    met = spread.join(graphs, ["dim", "shard"])
    found = met.mapInArrow(functools.partial(_search, k=k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    return search(stored(index(vectors), "hnsw", "dim"), queries, k)
