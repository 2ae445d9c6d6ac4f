"""Exact substring dedup over suffixes sorted deep and shallow.

Every 200-byte string holds an anchor: the 16-byte gram of least hash in it.  Equal strings hold
equal anchors at equal places, so only anchors that occur twice matter, and only the suffixes that
begin there (and the reversed prefixes that end there) are sorted, anchor by anchor.  The sort is
deep-shallow: a multikey quicksort, all segments at once, up to a shallow depth; what then still
agrees is ordered by blind tries, which keep branching depths only and compare one whole string per
insertion.  Neighbours' common prefixes turn the two orders into classes per depth; two strings of
200 bytes are equal if both their halves, before and after the anchor, are in one class.

Defined results: null and empty texts have no bytes; texts under 200 bytes lose nothing; texts of any
length are treated whole; equal texts of 200 bytes and more lose everything, as does a text repeated
under one id; documents without id are treated like others; an empty table gives an empty result;
column names other than doc_id and text play no part.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, lean, release_shuffles, small_batches, spread_join, stored, utf8

LENGTH, GRAM = 200, 16
#: Bytes up to which the multikey quicksort goes (eight at a time) before blind tries take over.
SHALLOW = 32
SLICE_BYTES, PACK_BYTES, BUCKET_ANCHORS = 1 << 20, 6 << 20, 50_000
ODD = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))
PLACE = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the gram at each byte (the last ones, without a whole gram, are 0)."""
    n = len(data)
    power, back = np.full(n, ODD), np.full(n, INVERSE)
    if n:
        power[0] = back[0] = 1
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * np.cumprod(power))])
    h = np.zeros(n, np.uint64)
    if n >= GRAM:
        x = (total[GRAM:] - total[:-GRAM]) * np.cumprod(back)[: n - GRAM + 1]
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x94D049BB133111EB)
        h[: n - GRAM + 1] = x ^ (x >> np.uint64(32))
    return h


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of x[p : p + width] for each p that has so many."""
    n = len(x)
    if n < width:
        return x[:0]
    pad = -n % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """hash, text, anchor place, first and number of the strings it stands for; places count within the text."""
    end = np.cumsum(sizes)
    h = gram_hashes(data)
    least = sliding_least((h & ~PLACE) | np.arange(len(data), dtype=np.uint64), LENGTH - GRAM + 1)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
    p = np.flatnonzero(np.arange(len(least)) + LENGTH <= end[text])
    a, text = (least[p] & PLACE).astype(np.int64), text[p]
    new = np.ones(len(p), bool)
    new[1:] = (a[1:] != a[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(p)))
    a, text, p = a[first], text[first], p[first]
    begin = (end - sizes)[text]
    return h[a], text, a - begin, p - begin, n


def _slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > SLICE_BYTES:
            yield first, i
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, len(texts)


ANCHOR = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int32()), ("first", pa.int32()), ("n", pa.int32())]))


@lean
def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for b in batches:
            texts = utf8(b["text"])
            for i, j in _slices(texts):
                sizes = np.array([len(t) for t in texts[i:j]], np.int64)
                assert sizes.sum() < len(texts[i]) + SLICE_BYTES < 1 << 24 or j == i + 1
                parts = [*_long_anchors(texts[i])] if j == i + 1 and sizes[0] >= 1 << 24 else [anchors(np.frombuffer(b"".join(texts[i:j]), np.uint8), sizes)]
                h, text, a, p, n = (np.concatenate(x) for x in zip(*parts, strict=True))
                offsets = np.searchsorted(text, np.arange(j - i + 1)).astype(np.int32)
                rows = pa.StructArray.from_arrays([pa.array(h.view(np.int64)), *(pa.array(x.astype(np.int32)) for x in (a, p, n))], ["hash", "at", "first", "n"])
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part["id"], part["digest"], pa.ListArray.from_arrays(pa.array(offsets), rows).cast(ANCHOR)], names=["id", "digest", "anchors"])


def _long_anchors(text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of one very long text, piece by piece; pieces overlap so that each string lies whole in one."""
    step = 8 << 20
    for at in range(0, max(1, len(text) - LENGTH + 1), step):
        data = np.frombuffer(text[at : at + step + LENGTH - 1], np.uint8)
        h, t, a, p, n = anchors(data, np.array([len(data)]))
        yield h, t, a + at, p + at, n


class BlindTrie:
    """Orders strings of one length: inner nodes keep the depth of their branches, leaves the strings."""

    def __init__(self, string: bytes):
        self.root: bytes | list = string

    @staticmethod
    def some_leaf(node) -> bytes:
        while not isinstance(node, bytes):
            node = next(iter(node[1].values()))
        return node

    def insert(self, s: bytes) -> None:
        node = self.root
        while not isinstance(node, bytes):
            step = node[1].get(s[node[0]])
            if step is None:
                break
            node = step
        other = self.some_leaf(node)
        if other == s:
            return
        lo, hi = 0, len(s)  # first byte that differs, by halving
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if s[lo:mid] == other[lo:mid]:
                lo = mid
            else:
                hi = mid
        depth = lo
        above, node = None, self.root
        while not isinstance(node, bytes) and node[0] < depth:
            above, node = (node[1], s[node[0]]), node[1][s[node[0]]]
        if not isinstance(node, bytes) and node[0] == depth:
            node[1][s[depth]] = s
            return
        fork = [depth, {other[depth]: node, s[depth]: s}]
        if above is None:
            self.root = fork
        else:
            above[0][above[1]] = fork

    def ordered(self) -> Iterator[bytes]:
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, bytes):
                yield node
            else:
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]


def deep_shallow(rows: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of equally long byte strings (rows) by group, then content."""
    n, width = rows.shape
    words = np.zeros((n, SHALLOW), np.uint8)
    words[:, : min(width, SHALLOW)] = rows[:, :SHALLOW]
    words = words.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    segment = np.zeros(n, np.int64)  # by place in the order: where its segment begins
    g = group[order]
    new = np.ones(n, bool)
    new[1:] = g[1:] != g[:-1]
    segment = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    depth = np.zeros(n, np.int64)  # words that a segment agrees in
    open_ = np.arange(n)
    while True:
        size = np.bincount(segment[open_], minlength=n)[segment[open_]] if len(open_) else np.zeros(0, np.int64)
        open_ = open_[(size > 1) & (depth[open_] < words.shape[1])]
        if not len(open_):
            break
        key = words[order[open_], depth[open_]]
        seg = segment[open_]
        first = np.ones(len(open_), bool)
        first[1:] = seg[1:] != seg[:-1]
        heads = np.flatnonzero(first)
        count = np.diff(np.append(heads, len(open_)))
        pivot = np.repeat(key[heads + count // 2], count)  # one pivot per segment: less, equal, greater
        side = np.where(key < pivot, 0, np.where(key == pivot, 1, 2))
        by = np.lexsort((side, seg))
        order[open_] = order[open_][by]
        side, seg = side[by], seg[by]
        depth[open_] += side == 1
        cut = np.ones(len(open_), bool)
        cut[1:] = (seg[1:] != seg[:-1]) | (side[1:] != side[:-1])
        segment[open_] = np.maximum.accumulate(np.where(cut, open_, 0))
    if width > SHALLOW:  # deep: segments that agree in all shallow words
        size = np.bincount(segment, minlength=n)
        for head in np.flatnonzero(size > 1):
            members = order[head : head + size[head]]
            held: dict[bytes, list[int]] = {}
            for i in members.tolist():
                held.setdefault(rows[i].tobytes(), []).append(i)
            if len(held) > 1:
                strings = iter(held)
                trie = BlindTrie(next(strings))
                for s in strings:
                    trie.insert(s)
                order[head : head + size[head]] = [i for s in trie.ordered() for i in held[s]]
    return order


def common(rows: np.ndarray, order: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Bytes that each string shares with the one before it in the order; -1 across groups."""
    out = np.full(len(order), -1, np.int64)
    for i in range(1, len(order), 20_000):
        a, b = order[i : i + 20_000], order[i - 1 : i - 1 + len(order[i : i + 20_000])]
        differs = rows[a] != rows[b]
        same = np.where(differs.any(1), differs.argmax(1), rows.shape[1])
        out[i : i + len(a)] = np.where(group[a] == group[b], same, -1)
    return out


def repeated_strings(group: np.ndarray, left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which strings around equal anchors occur more than once: (row, bytes before the anchor) of each.

    left holds the bytes before the anchor, nearest first; right those from the anchor on.  A row stands
    for the strings that begin l bytes before the anchor, LENGTH - n_right <= l <= n_left.
    """
    n = len(group)
    ways = []
    for rows in (left, right):
        order = deep_shallow(rows, group)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        ways.append((rank, common(rows, order, group)))
    (rank_l, lcp_l), (rank_r, lcp_r) = ways
    found = []
    for l in range(int(n_left.max(initial=-1)) + 1):  # noqa: E741
        rows = np.flatnonzero((n_left >= l) & (LENGTH - n_right <= l))
        if len(rows) < 2:
            continue
        before = np.cumsum(lcp_l < l)[rank_l[rows]]
        after = np.cumsum(lcp_r < LENGTH - l)[rank_r[rows]]
        key = before * (n + 1) + after
        order = np.argsort(key, kind="stable")
        same = key[order[1:]] == key[order[:-1]]
        twice = np.zeros(len(rows), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        hit = rows[twice]
        found.append((hit, np.full(len(hit), l)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


SENT = pa.schema([("bucket", pa.int32()), ("pack", pa.int64()), *((c, pa.binary()) for c in ("hash", "shape", "bytes", "doc", "digests"))])


def _row(bucket: int, pack: int, **parts) -> dict:
    return {c: None for c in SENT.names} | {"bucket": bucket, "pack": pack} | parts


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(), np.diff(whole.offsets.to_numpy())


def _send(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """What surrounds repeated anchors, by bucket; columns digest, text, hash, at, first, n.

    Surroundings that are equal in one pack are known to repeat; one of them is sent on.
    """
    pack = TaskContext.get().partitionId() << 32
    squeeze = zstandard.ZstdCompressor(level=1)
    for t in chunks(batches, PACK_BYTES):
        pack += 1
        texts = utf8(t["text"])
        (h, runs), (at, _), (first, _), (n, _) = (_lists(t[c]) for c in ("hash", "at", "first", "n"))
        h = h.view(np.uint64)
        doc = np.repeat(np.arange(len(texts)), runs)
        held: dict[tuple, int] = {}
        sure = np.zeros(len(h), bool)
        sent, parts = [], []
        shapes = np.stack([at - first, n, first], 1).astype(np.int64)
        for i, (d, f, m, before) in enumerate(zip(doc.tolist(), first.tolist(), n.tolist(), (at - first).tolist(), strict=True)):
            key = (texts[d][f : f + m - 1 + LENGTH], before)
            k = held.setdefault(key, i)
            if k == i:
                sent.append(i)
                parts.append(key[0])
            else:
                sure[i] = sure[k] = True
        where = np.stack([doc[sure], first[sure], n[sure]]).astype("<i4")
        rows = [_row(pack % buckets, pack, doc=where.tobytes(), digests=b"".join(t["digest"].to_pylist()))]
        sent_at = np.array(sent, np.int64)
        bucket = ((h[sent_at] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        which, starts = np.unique(bucket[by], return_index=True)
        for b, i, j in zip(which.tolist(), starts, [*starts[1:], len(by)], strict=True):
            k = sent_at[by[i:j]]
            rows.append(
                _row(
                    b, pack, hash=h[k].tobytes(), shape=shapes[k, :2].astype("<u2").tobytes(), bytes=squeeze.compress(b"".join([parts[x] for x in by[i:j].tolist()])),
                    doc=np.stack([doc[k], first[k]]).astype("<i4").tobytes(),
                )
            )
        for r in rows:
            yield pa.RecordBatch.from_pylist([r], schema=SENT)


def _compare(key: tuple, group: pa.Table) -> pa.Table:
    """Of each pack, the runs of strings around the anchors of one bucket that occur more than once."""
    rows = [r for b in group.to_batches(max_chunksize=64) for r in b.to_pylist()]
    out = [(r["pack"], r["doc"], r["digests"]) for r in rows if r["digests"] is not None]
    sent = [r for r in rows if r["digests"] is None]
    if sent:
        h = np.concatenate([np.frombuffer(r["hash"], np.uint64) for r in sent])
        shape = np.concatenate([np.frombuffer(r["shape"], "<u2").reshape(-1, 2) for r in sent]).astype(np.int64)
        n_left, n = shape[:, 0], shape[:, 1]
        size = n + LENGTH - 1
        n_right = size - n_left
        unsqueeze = zstandard.ZstdDecompressor()
        data = np.frombuffer(b"".join([unsqueeze.decompress(r["bytes"]) for r in sent]), np.uint8)
        begin = np.cumsum(size) - size
        wide = LENGTH - GRAM
        shared = _shared(h)  # anchors met only once here (twice in one pack) are settled
        pick = np.flatnonzero(shared)
        begin_p, left_p, size_p = begin[pick], n_left[pick], size[pick]
        left, right = np.zeros((len(pick), wide), np.uint8), np.zeros((len(pick), LENGTH), np.uint8)
        for c in range(wide):
            ok = left_p > c
            left[ok, c] = data[begin_p[ok] + left_p[ok] - 1 - c]
        for c in range(LENGTH):
            ok = left_p + c < size_p
            right[ok, c] = data[begin_p[ok] + left_p[ok] + c]
        # rows that are equal throughout repeat as a whole; one of them stands for all
        whole = np.concatenate([h[pick].view(np.uint8).reshape(-1, 8), shape[pick].astype("<u2").view(np.uint8).reshape(-1, 4), left, right], 1)
        seen: dict[bytes, int] = {}
        stand, twin = [], np.zeros(len(pick), bool)
        for i in range(len(pick)):
            k = seen.setdefault(whole[i].tobytes(), i)
            if k == i:
                stand.append(i)
            else:
                twin[i] = twin[k] = True
        del whole, seen
        stand = np.array(stand, np.int64)
        row, back = repeated_strings(h[pick][stand], left[stand], right[stand], left_p[stand], n_right[pick][stand])
        single = ~twin[stand[row]]
        row, back = pick[stand[row[single]]], back[single]
        pack_of = np.repeat(np.arange(len(sent)), [len(r["hash"]) // 8 for r in sent])
        doc, first = (np.concatenate([np.frombuffer(r["doc"], "<i4").reshape(2, -1)[c] for r in sent]) for c in (0, 1))
        all_of = pick[np.flatnonzero(twin)]
        runs = [(doc[all_of], first[all_of], n[all_of], pack_of[all_of])]
        if len(row):
            order = np.lexsort((-back, row))
            row, at = row[order], (first[row] + n_left[row] - back)[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
            head = np.flatnonzero(new)
            runs.append((doc[row[head]], at[head], np.diff(np.append(head, len(row))), pack_of[row[head]]))
        doc, at, n, pack_of = (np.concatenate(x) for x in zip(*runs, strict=True))
        for k in np.unique(pack_of):
            mine = pack_of == k
            out.append((sent[k]["pack"], np.stack([doc[mine], at[mine], n[mine]]).astype("<i4").tobytes(), None))
    packs, docs, digests = zip(*out, strict=True) if out else ((), (), ())
    return pa.table({"pack": pa.array(packs, pa.int64()), "doc": pa.array(docs, pa.binary()), "digests": pa.array(digests, pa.binary())})


def _shared(h: np.ndarray) -> np.ndarray:
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    out = np.zeros(len(h), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def _gather(key: tuple, group: pa.Table) -> pa.Table:
    """Bytes to remove of each text of one pack: maximal runs."""
    rows = [r for b in group.to_batches(max_chunksize=64) for r in b.to_pylist()]
    head = next(r for r in rows if r["digests"] is not None)
    doc, at, n = np.concatenate([np.frombuffer(r["doc"], "<i4").reshape(3, -1) for r in rows], 1).astype(np.int64)
    order = np.lexsort((at, doc))
    doc, at, end = doc[order], at[order], (at + n + LENGTH - 1)[order]
    shift = doc << 32
    reach = np.maximum.accumulate(shift + end)
    new = np.ones(len(doc), bool)
    new[1:] = shift[1:] + at[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1 if len(first) else first
    used, starts = np.unique(doc[first], return_index=True)
    offsets = pa.array(np.append(starts, len(first)).astype(np.int32))
    begin, end = at[first], reach[last] - shift[last] if len(first) else at[first]
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (begin, end)]
    digests = [head["digests"][16 * i : 16 * i + 16] for i in used.tolist()]
    return pa.table({"digest": pa.array(digests, pa.binary()), "begin": lists[0], "end": lists[1]})


@lean
def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        copies, begins, ends = (b[c].to_pylist() for c in ("copies", "begin", "end"))
        sizes, gone, spans, kept = [], [], [], []
        for t, copy, begin, end in zip(utf8(b["text"]), copies, begins, ends, strict=True):
            runs = [(0, len(t))] if copy and len(t) >= LENGTH else [*zip(begin or [], end or [], strict=True)]
            parts, at = [], 0
            for i, j in runs:
                parts.append(t[at:i])
                at = j
            parts.append(t[at:])
            rest = b"".join(parts)
            sizes.append(len(t))
            gone.append(len(t) - len(rest))
            spans.append([{"start": i, "end": j} for i, j in runs])
            kept.append(rest)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [b["doc_id"], pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def drop_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (byte runs removed) and the kept bytes of every text."""
    release_shuffles(docs.sparkSession)
    small_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    given = docs.select("doc_id", text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("digest"))
    kind = given.schema["doc_id"].dataType.simpleString()
    source = given.select(F.col("doc_id").alias("id"), "digest", "text")
    anchored = stored(source.mapInArrow(_anchors, f"id {kind}, digest binary, anchors array<struct<hash:bigint,at:int,first:int,n:int>>"), "anchors")
    known = stored(anchored.groupBy("digest").agg(F.min("id").alias("id"), (F.count("*") > 1).alias("copies")), "texts")
    same = (anchored["digest"] == known["digest"]) & anchored["id"].eqNullSafe(known["id"])
    once = anchored.join(known, same, "left_semi").dropDuplicates(["digest"])
    places = stored(once.select("digest", F.inline("anchors")), "places")
    shared = stored(places.groupBy("hash").count().where("count > 1"), "shared")
    lists = [F.collect_list(c).alias(c) for c in ("hash", "at", "first", "n")]  # a text's own anchors
    suspects = stored(spread_join(places, shared, "hash", "count").groupBy("digest").agg(*lists).join(known.select("digest", "id"), "digest"), "suspects")
    total = suspects.agg(F.sum(F.size("hash"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_ANCHORS))
    asked = source.join(suspects.withColumnRenamed("id", "own"), "digest").where(F.col("id").eqNullSafe(F.col("own")))
    sent = asked.select("digest", "text", "hash", "at", "first", "n").mapInArrow(
        functools.partial(_send, buckets=buckets), "bucket int, pack long, hash binary, shape binary, bytes binary, doc binary, digests binary"
    )
    told = sent.groupBy("bucket").applyInArrow(_compare, "pack long, doc binary, digests binary")
    gone = stored(told.groupBy("pack").applyInArrow(_gather, "digest binary, begin array<int>, end array<int>").dropDuplicates(["digest"]), "gone")
    marked = given.join(known.select("digest", "copies"), "digest").join(gone, "digest", "left").select("doc_id", "text", "copies", "begin", "end")
    return marked.mapInArrow(_cut, f"doc_id {kind}, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept binary")
