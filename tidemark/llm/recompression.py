"""Substring dedup by recompression.

Rounds rename a text's words: first runs of one symbol become one, then neighbours of which the left
one falls into one half of all symbols and the right one into the other half.  A name is the hash of
what it stands for, so names agree in all texts and tasks without a table of names to exchange.
Every symbol knows the stretch of words that its making looked at; a window of words that contains
this stretch holds the symbol wherever it occurs.  Each window is known by the symbol of the
highest round that it surely holds (of several, the one with the least name), so equal windows have
equal symbols.  Symbols shared by texts reveal where windows may repeat; only those windows are then
compared, by the hash of all their words.

Defined results: null and empty texts have no words; texts shorter than a window stay as they are;
documents without id stay, and take nothing from others; repeated rows of one id take nothing from
each other; exact copies are treated by their smallest id; texts of any length are treated whole; an
empty table gives an empty result; ids are whole numbers; column names other than doc_id and text play
no part.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, lean, release_shuffles, small_batches, spread_join, stored, utf8

WINDOW, ROUNDS = 50, 3
SLICE_WORDS = 150_000
#: Bytes of text whose windows travel together, and windows per bucket.
PACK_BYTES, BUCKET_WINDOWS = 8 << 20, 2_000_000
ODD = np.uint64(0x9E3779B97F4A7C15)
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        v = self[word] = xxhash.xxh3_64_intdigest(word)
        return v


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_ids(texts: list[bytes], ids: _Ids) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row and the number of words of each."""
    get, parts = ids.__getitem__, []
    for t in texts:
        words = t.split()
        parts.append(np.fromiter(map(get, words), np.uint64, len(words)))
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.array([len(p) for p in parts], np.int64)


def recompress(ids: np.ndarray, doc: np.ndarray, begin: np.ndarray, end: np.ndarray, rounds: int) -> list[tuple[np.ndarray, ...]]:
    """Per round: names, first and one past the last word that the making of each symbol looked at, and its text.

    begin and end: first and one past the last word of each text.  Beyond a text there is no
    neighbour; as elsewhere there may be one, what looks there belongs to no window.
    """
    sym, lo = ids, np.arange(len(ids))
    hi = lo + 1
    out = [(sym, lo, hi, doc)]
    for r in range(1, rounds + 1):
        salt = np.uint64(2 * r + 1) * ODD
        n = len(sym)
        border = np.ones(n, bool)
        border[1:] = (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(border)
        length = np.diff(np.append(first, n))
        last = first + length - 1
        name = np.where(length > 1, mix(sym[first] * ODD + length.astype(np.uint64) * salt), sym[first])
        d = doc[first]
        left, right = np.maximum(first - 1, 0), np.minimum(last + 1, n - 1)
        a = np.minimum(lo[first], np.where((first > 0) & (doc[left] == d), lo[left], begin[d] - 1))
        z = np.maximum(hi[last], np.where((last < n - 1) & (doc[right] == d), hi[right], end[d] + 1))
        sym, lo, hi, doc = name, a, z, d
        n = len(sym)
        in_left = (mix(sym + salt) >> np.uint64(63)) == 0
        same = np.zeros(n, bool)
        same[:-1] = doc[1:] == doc[:-1]
        pair = np.zeros(n, bool)
        pair[:-1] = in_left[:-1] & ~in_left[1:] & same[:-1]
        second = np.zeros(n, bool)
        second[1:] = pair[:-1]
        after = np.append(sym[1:], np.uint64(0)), np.append(lo[1:], 0), np.append(hi[1:], 0)
        before_lo, before = np.append(0, lo[:-1]), np.append(False, same[:-1])
        name = np.where(pair, mix(mix(sym + salt) * ODD + after[0]), sym)
        z = np.where(pair, after[2], np.where(in_left, np.maximum(hi, np.where(same, after[2], end[doc] + 1)), hi))
        a = np.where(~pair & ~in_left, np.minimum(lo, np.where(before, before_lo, begin[doc] - 1)), lo)
        keep = ~second
        sym, lo, hi, doc = name[keep], a[keep], z[keep], doc[keep]
        out.append((sym, lo, hi, doc))
    return out


def window_symbols(ids: np.ndarray, sizes: np.ndarray, window: int = WINDOW, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The symbol that each window is known by, at the window's first word, and which words begin a window."""
    n = len(ids)
    end = np.cumsum(sizes)
    begin = end - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.arange(n) + window <= end[doc] if n else np.zeros(0, bool)
    steps = window.bit_length() - 1
    least = np.full((steps + 1, n), NONE)
    for level, (sym, lo, hi, d) in enumerate(recompress(ids, doc, begin, end, rounds)):
        key = (mix(sym) >> np.uint64(3)) | np.uint64((rounds - level) << 61)
        a, z = np.maximum(hi - window, begin[d]), np.minimum(lo, end[d] - window)
        ok = (a <= z) & (lo >= begin[d]) & (hi <= end[d])
        a, z, key = a[ok], z[ok], key[ok]
        k = np.log2(z - a + 1).astype(np.int64) if len(a) else a
        flat = least.reshape(-1)
        np.minimum.at(flat, k * n + a, key)
        np.minimum.at(flat, k * n + z - (1 << k) + 1, key)
    for k in range(steps, 0, -1):
        half = 1 << (k - 1)
        np.minimum(least[k - 1], least[k], out=least[k - 1])
        np.minimum(least[k - 1, half:], least[k, :-half] if half else least[k], out=least[k - 1, half:])
    return least[0], starts


def _slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > 6 * SLICE_WORDS:
            yield first, i
            first, size = i, 0
        size += len(t)
    if texts:
        yield first, len(texts)


@lean
def _symbols(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """doc_id, digest and, run by run, the symbols of the windows of each text."""
    ids = _Ids()
    kind = pa.list_(pa.struct([("symbol", pa.int64()), ("at", pa.int32()), ("n", pa.int32())]))
    with np.errstate(over="ignore"):
        for b in batches:
            texts = utf8(b["text"])
            for i, j in _slices(texts):
                w, sizes = word_ids(texts[i:j], ids)
                key, starts = window_symbols(w, sizes, window)
                doc = np.repeat(np.arange(len(sizes)), sizes)
                at = np.flatnonzero(starts)
                new = np.ones(len(at), bool)
                new[1:] = (key[at[1:]] != key[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(at)))
                at = at[first]
                begin = np.cumsum(sizes) - sizes
                offsets = np.searchsorted(doc[at], np.arange(len(sizes) + 1)) if len(at) else np.zeros(len(sizes) + 1, np.int64)
                runs = pa.StructArray.from_arrays(
                    [pa.array(key[at].view(np.int64)), pa.array((at - begin[doc[at]]).astype(np.int32)), pa.array(n.astype(np.int32))], ["symbol", "at", "n"]
                )
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["digest"], pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), runs).cast(kind)], names=["doc_id", "digest", "runs"]
                )


def _expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all runs, one after another."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and how many each row has."""
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(), np.diff(whole.offsets.to_numpy())


SENT = pa.schema([("bucket", pa.int32()), ("pack", pa.int64()), ("hash", pa.binary()), ("doc", pa.binary()), ("at", pa.binary()), ("ids", pa.binary()), ("digests", pa.binary())])


def _send_windows(batches: Iterator[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Hashes of the windows in question, by bucket; columns doc_id, digest, text, at, n.

    Of equal windows of one pack only those of the least document are sent; the others are gone already.
    """
    ids, pack = _Ids(), TaskContext.get().partitionId() << 32
    inverse = np.uint64(pow(int(ODD), -1, 1 << 64))
    with np.errstate(over="ignore"):
        for t in chunks(batches, PACK_BYTES):
            pack += 1
            w, sizes = word_ids(utf8(t["text"]), ids)
            n = len(w)
            power, back = np.full(n + 1, ODD), np.full(n + 1, inverse)
            power[0] = back[0] = 1
            power, back = np.cumprod(power), np.cumprod(back)
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(w) * power[:n])])
            (at, runs), (length, _) = _lists(t["at"]), _lists(t["n"])
            doc_of_run = np.repeat(np.arange(len(sizes)), runs)
            begin = np.cumsum(sizes) - sizes
            p = _expand(begin[doc_of_run] + at, length)
            doc = np.repeat(doc_of_run, length).astype(np.uint32)
            h = mix((total[p + window] - total[p]) * back[p])
            place = (p - begin[doc]).astype(np.uint32)
            name = t["doc_id"].to_numpy()
            order = np.argsort(h, kind="stable")
            first = np.ones(len(h), bool)
            first[1:] = h[order[1:]] != h[order[:-1]]
            heads = np.flatnonzero(first)
            least = np.minimum.reduceat(name[doc[order]], heads) if len(h) else name[:0]
            gone = np.zeros(len(h), bool)
            gone[order] = name[doc[order]] > np.repeat(least, np.diff(np.append(heads, len(h))))
            digests = b"".join(t["digest"].to_pylist())
            rows = [(pack % buckets, b"", doc[gone], place[gone], name.astype("<i8").tobytes(), digests)]
            rest = order[~gone[order]]
            bucket = ((h[rest] >> np.uint64(40)) % np.uint64(buckets)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            which, starts = np.unique(bucket[by], return_index=True)
            for b, i, j in zip(which.tolist(), starts, [*starts[1:], len(by)], strict=True):
                k = rest[by[i:j]]
                rows.append((b, h[k].tobytes(), doc[k], place[k], name[doc[k]].astype("<i8").tobytes(), None))
            for b, hs, d, a, i, x in rows:
                yield pa.RecordBatch.from_pylist([dict(zip(SENT.names, (b, pack, hs, d.tobytes(), a.tobytes(), i, x), strict=True))], schema=SENT)


def _compare(key: tuple, group: pa.Table) -> pa.Table:
    """Of each pack, the windows of one bucket that also begin in a document of smaller id."""
    rows = [r for b in group.to_batches(max_chunksize=64) for r in b.to_pylist()]
    sent = [r for r in rows if r["digests"] is None]
    out = [r for r in rows if r["digests"] is not None]
    if sent:
        h = np.concatenate([np.frombuffer(r["hash"], np.uint64) for r in sent])
        name = np.concatenate([np.frombuffer(r["ids"], "<i8") for r in sent])
        order = np.argsort(h, kind="stable")
        first = np.ones(len(h), bool)
        first[1:] = h[order[1:]] != h[order[:-1]]
        heads = np.flatnonzero(first)
        least = np.minimum.reduceat(name[order], heads)
        gone = np.zeros(len(h), bool)
        gone[order] = name[order] > np.repeat(least, np.diff(np.append(heads, len(h))))
        start = 0
        for r in sent:
            k = np.flatnonzero(gone[start : start + len(r["hash"]) // 8])
            start += len(r["hash"]) // 8
            if len(k):
                d, a = (np.frombuffer(r[c], np.uint32)[k].tobytes() for c in ("doc", "at"))
                out.append(r | {"hash": None, "doc": d, "at": a, "ids": None})
    return pa.Table.from_pylist([{c: r[c] for c in ("pack", "doc", "at", "ids", "digests")} for r in out], schema=pa.schema([SENT.field(c) for c in ("pack", "doc", "at", "ids", "digests")]))


def _gather(key: tuple, group: pa.Table) -> pa.Table:
    """The windows to remove of each document of one pack, as runs."""
    rows = [r for b in group.to_batches(max_chunksize=64) for r in b.to_pylist()]
    head = next(r for r in rows if r["digests"] is not None)
    name = np.frombuffer(head["ids"], "<i8")
    doc, at = (np.concatenate([np.frombuffer(r[c], np.uint32) for r in rows]).astype(np.int64) for c in ("doc", "at"))
    flat = np.unique(doc << 32 | at)
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1] + 1
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(flat)))
    doc = flat[first] >> 32
    used = np.unique(doc)
    offsets = pa.array(np.append(np.searchsorted(doc, used), len(doc)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (flat[first] & 0xFFFFFFFF, n)]
    digests = [head["digests"][16 * i : 16 * i + 16] for i in used.tolist()]
    return pa.table({"doc_id": pa.array(name[used]), "digest": pa.array(digests, pa.binary()), "at": lists[0], "n": lists[1]})


@lean
def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """doc_id, text, copy and at, n (runs of first words of windows to remove) to words, removed words and kept text."""
    for b in batches:
        copies, ats, ns = (b[c].to_pylist() for c in ("copy", "at", "n"))
        sizes, gone, kept = [], [], []
        for t, copy, at, n in zip(utf8(b["text"]), copies, ats, ns, strict=True):
            words = t.split()
            size = len(words)
            if copy and size >= window:
                words = []
            elif at:
                parts, end = [], 0
                for a, m in sorted(zip(at, n, strict=True)):
                    parts += words[end:a] if a > end else []
                    end = max(end, a + m + window - 1)
                words = parts + words[end:]
            sizes.append(size)
            gone.append(size - len(words))
            kept.append(b" ".join(words).decode())
        yield pa.RecordBatch.from_arrays(
            [b["doc_id"], pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"]
        )


def drop_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept text: without the words of windows that begin in a document of smaller id."""
    release_shuffles(docs.sparkSession)
    small_batches(docs.sparkSession)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    given = given.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    named = given.where("doc_id is not null")
    runs = "array<struct<symbol:bigint,at:int,n:int>>"
    symbols = stored(named.mapInArrow(functools.partial(_symbols, window=window), f"doc_id long, digest binary, runs {runs}"), "symbols")
    least = symbols.groupBy("digest").agg(F.min("doc_id").alias("least"))
    copies = symbols.select("doc_id", "digest").distinct().join(least, "digest").where(F.col("doc_id") > F.col("least")).select("doc_id", "digest", F.lit(True).alias("copy"))
    firsts = symbols.join(least.withColumnRenamed("least", "doc_id"), ["digest", "doc_id"], "left_semi").dropDuplicates(["digest", "doc_id"])
    places = stored(firsts.select("doc_id", "digest", F.inline("runs")), "places")
    shared = places.groupBy("symbol").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z"), F.count("*").alias("rows"))
    shared = stored(shared.where("a < z").select("symbol", "rows"), "shared")
    suspects = stored(
        spread_join(places, shared, "symbol", "rows").groupBy("doc_id", "digest").agg(F.collect_list("at").alias("at"), F.collect_list("n").alias("n"), F.sum("n").alias("windows")),  # a text's own
        "suspects",
    )
    windows = suspects.agg(F.sum("windows")).first()[0] or 0
    buckets = max(1, -(-windows // BUCKET_WINDOWS))
    asked = named.join(suspects.drop("windows"), ["doc_id", "digest"]).select("doc_id", "digest", "text", "at", "n")
    sent = asked.mapInArrow(functools.partial(_send_windows, window=window, buckets=buckets), "bucket int, pack long, hash binary, doc binary, at binary, ids binary, digests binary")
    told = sent.groupBy("bucket").applyInArrow(_compare, "pack long, doc binary, at binary, ids binary, digests binary")
    gone = stored(told.groupBy("pack").applyInArrow(_gather, "doc_id long, digest binary, at array<int>, n array<int>"), "gone")
    gone = gone.groupBy("doc_id", "digest").agg(F.flatten(F.collect_list("at")).alias("at"), F.flatten(F.collect_list("n")).alias("n"))
    told = given.join(gone, ["doc_id", "digest"], "left").join(copies, ["doc_id", "digest"], "left").select("doc_id", "text", "copy", "at", "n")
    return told.mapInArrow(functools.partial(_cut, window=window), "doc_id long, n_words long, n_removed long, kept string")
