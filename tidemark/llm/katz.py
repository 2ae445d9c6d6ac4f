"""Katz backoff scoring of texts.

A bigram model: counts under Good-Turing discounts, and per context a backoff weight that makes the
probabilities of all words, known or not, sum to exactly one.  A token is scored recursively: by its
pair if the table of pairs has it, else it goes on, with its context's weight, to the table of words,
and there it takes the word's own probability or, if unknown, the mass that the discounted known words
leave.  Every pair seen in training, once or more, is in the table.

Words are known by 64-bit hashes.  Texts are read three times: to count words, to count pairs, to
score.  Pairs travel by the hash of their context, the distinct ones of a large pack once, so a token
costs a few bytes.  The table of pairs is stored in buckets of the same hash and never moves again: the
words' counts come to it for the backoff weights, the texts' pairs for the scores.  Contexts with more
than a bounded share of all tokens (at most ``HOT`` of them) are spread by the hash of the whole pair,
and pairs above that share are scored where they are read: no task sees more than such a share of one key.

Defined results: null and empty texts are one end token; texts of any length are scored whole;
repeated rows count and are scored each; without training texts every token is unknown with
probability one; an empty table gives an empty result; a kept column that is named like one of the
added ones is left to the caller to rename; other columns play no part.
"""

from __future__ import annotations

import functools
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, give_back, lean, release_shuffles, shared_dir, small_batches, stored, thrifty, utf8

BEGIN, END = 1, 2
#: Counts up to K are discounted; every counted pair is in the model.
K, LEAST_COUNT = 5, 1
#: Most words, and most pairs, that are treated as frequent; tokens per bucket of pairs; bytes of text per pack; words per bucket of words.
HOT, LEAST_HOT = 65_536, 200_000
BUCKET_TOKENS, PACK_BYTES, BUCKET_WORDS = 2_000_000, 11 << 20, 300_000
#: Keys that are looked up at a time.
BLOCK = 65_536
#: Buckets of the stored table of pairs, at most.
MOST_BUCKETS = 4096
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
ODD = np.uint64(0x9E3779B97F4A7C15)
#: The bits of a sort key that come from the context; the rest come from the pair.
CONTEXT_BITS = np.uint64(0xFFFFFFFFFF000000)
SENT = "bucket int, pack long, h binary, n binary, w binary, m binary, doc binary, head binary"
PAIRS = "bucket int, h binary, n binary, w binary, r binary, kinds array<long>"
TOLD = "pack long, place int, docs binary, sums binary, head binary, w binary"


class _Ids(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        v = self[word] = xxhash.xxh3_64_intdigest(word)
        return v


def tokens(texts: list[bytes], ids: _Ids) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, an end after each, and each text's number of tokens."""
    get, parts, sizes = ids.__getitem__, [], []
    end = np.array([END], np.uint64)
    for t in texts:
        words = t.translate(LOWER).split()
        parts += [np.fromiter(map(get, words), np.uint64, len(words)), end]
        sizes.append(len(words) + 1)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64), np.array(sizes, np.int64)


def contexts(w: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    h = np.empty_like(w)
    h[1:] = w[:-1]
    starts = np.cumsum(sizes) - sizes
    h[starts] = BEGIN
    return h


def mixed(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """One key for a pair."""
    x = w >> np.uint64(31)
    x ^= w
    x += h * ODD
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def found_in(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Place of each key in a sorted array, -1 if it isn't there; no more memory than the places take."""
    out = np.full(len(keys), -1)
    for i in range(0, len(keys), BLOCK) if len(sorted_keys) else ():
        k = keys[i : i + BLOCK]
        at = np.minimum(np.searchsorted(sorted_keys, k), len(sorted_keys) - 1)
        np.copyto(out[i : i + BLOCK], at, where=sorted_keys[at] == k)
    return out


def bucket_of(h: np.ndarray, mix: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a pair: by its context, or by the pair if the context is frequent."""
    key = np.where(found_in(hot, h) >= 0, mix, h * ODD)
    return ((key >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


@lean
def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    thrifty()
    ids = _Ids()
    for t in chunks(batches, PACK_BYTES):
        w, _ = tokens(utf8(t["text"]), ids)
        words, n = np.unique(w, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], names=["w", "c"])


def _fields(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[t]) for n, t in (x.split(" ") for x in schema.split(", "))])


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    names = _fields(schema).names
    return pa.RecordBatch.from_pylist([dict.fromkeys(names) | r for r in rows], schema=_fields(schema))


def _table(rows: list[dict], schema: str) -> pa.Table:
    return pa.Table.from_batches([_batch(rows, schema)])


def _split(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket.astype(np.uint16) if len(bucket) and bucket.max() < 65_536 else bucket, kind="stable")
    which, starts = np.unique(bucket[order], return_index=True)
    for b, i, j in zip(which.tolist(), starts, [*starts[1:], len(order)], strict=True):
        yield b, order[i:j]


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places and lengths of runs of equal values."""
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(x)))


def _by_context(h: np.ndarray, w: np.ndarray, mix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that brings equal pairs together, and (in almost all cases) the pairs of a context; first places and numbers of equal pairs."""
    key = h * ODD
    key &= CONTEXT_BITS
    key |= mix >> np.uint64(40)
    order = np.argsort(key)
    del key
    new = np.zeros(len(h), bool)
    new[:1] = True
    for x in (h, w):  # one sorted copy at a time
        x = x[order]
        new[1:] |= x[1:] != x[:-1]
        del x
    first = np.flatnonzero(new)
    n = np.empty_like(first)
    np.subtract(first[1:], first[:-1], out=n[:-1])
    n[-1:] = len(h) - first[-1:]
    return order, first, n


def _listed(h: np.ndarray, w: np.ndarray) -> dict[str, bytes]:
    """Pairs as runs of contexts."""
    first, n = _runs(h)
    return {"h": h[first].tobytes(), "n": n.astype("<u4").tobytes(), "w": w.tobytes()}


def _unlisted(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(r["h"], np.uint64), np.frombuffer(r["n"], "<u4").astype(np.int64), np.frombuffer(r["w"], np.uint64)


def _packed(x: np.ndarray) -> bytes:
    return zstandard.compress(x.astype("<u4").tobytes(), 1)


def _unpacked(x: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(x), "<u4").astype(np.int64)


def _of_bucket(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A row of the stored table of pairs: contexts, their numbers of words, words, counts."""
    return np.frombuffer(row["h"], np.uint64), _unpacked(row["n"]), np.frombuffer(row["w"], np.uint64), _unpacked(row["r"])


@lean
def _count_pairs(batches: Iterator[pa.RecordBatch], hot: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    thrifty()
    ids = _Ids()
    with np.errstate(over="ignore"):
        for t in chunks(batches, PACK_BYTES):
            w, sizes = tokens(utf8(t["text"]), ids)
            del t
            h = contexts(w, sizes)
            mix = mixed(h, w)
            order, first, n = _by_context(h, w, mix)
            at = order[first]
            h, w, mix = h[at], w[at], mix[at]
            del order, first, at
            for b, k in _split(bucket_of(h, mix, hot, buckets)):
                yield _batch([{"bucket": b, "pack": 0, "m": n[k].astype("<u4").tobytes()} | _listed(h[k], w[k])], SENT)


def _sum_pairs(key: tuple, group: pa.Table) -> pa.Table:
    """The pairs of one bucket by context, with their counts, and how many have each count up to K + 1."""
    thrifty()
    with np.errstate(over="ignore"):
        hs, ws, ns = [], [], []
        for r in _rows(group):
            h, n, w = _unlisted(r)
            hs.append(np.repeat(h, n))
            ws.append(w)
            ns.append(np.frombuffer(r["m"], "<u4"))
        h, w, n = (np.concatenate(x) for x in (hs, ws, ns))
        del hs, ws, ns
        order = np.argsort(mixed(h, w))
        h, w, n = h[order], w[order], n[order].astype(np.int64)
        del order
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (w[1:] != w[:-1])
    first = np.flatnonzero(new)
    r, h, w = np.add.reduceat(n, first), h[first], w[first]
    del n, new, first
    order = np.argsort(h, kind="stable")
    r, h, w = r[order], h[order], w[order]
    del order
    kinds = np.bincount(np.minimum(r, K + 2), minlength=K + 2)[1 : K + 2].tolist()
    first, n = _runs(h)
    row = {"bucket": key[0].as_py(), "h": h[first].tobytes(), "n": _packed(n), "w": w.tobytes(), "r": _packed(r), "kinds": kinds}
    del h, w, r, first, n
    give_back()
    return _table([row], PAIRS)


def _rows(group: pa.Table) -> Iterator[dict]:
    for b in group.to_batches(max_chunksize=16):
        yield from b.to_pylist()


def discounts(kinds: dict[int, int]) -> list[float]:
    """Katz's factor for each count from 0 to K (index 0 unused); 1 where Good-Turing gives none between 0 and 1."""
    out, n1 = [1.0], kinds.get(1, 0)
    cut = (K + 1) * kinds.get(K + 1, 0) / n1 if n1 else 1.0
    for r in range(1, K + 1):
        d = 1.0
        if n1 and kinds.get(r, 0) and cut < 1:
            d = ((r + 1) * kinds.get(r + 1, 0) / (r * kinds[r]) - cut) / (1 - cut)
        out.append(d if 0 < d < 1 else 1.0)
    return out


def discounted(count: Column, factors: list[float]) -> Column:
    value = count.cast("double")
    for r, d in enumerate(factors[1:], 1):
        value = F.when(count == r, F.lit(d * r)).otherwise(value) if d != 1 else value
    return value


def values(count: np.ndarray, factors: list[float]) -> np.ndarray:
    """Discounted counts."""
    by = np.array([d * r for r, d in enumerate(factors)])
    return np.where(count <= K, by[np.minimum(count, K)], count.astype(float))


def word_bucket(w: np.ndarray, buckets: int) -> np.ndarray:
    return ((w >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


class Words:
    """What a word's own count says: its probability. Plain numbers, sent with the tasks."""

    def __init__(self, n: int, v: int, factors: list[float], scale: float, unknown: float):
        self.n, self.v, self.factors, self.scale, self.unknown = n, v, factors, scale, unknown

    def p(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, values(count, self.factors) / max(1, self.n) * self.scale, self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1.0) / (self.n + self.v + 1))


def weights(sd: np.ndarray, sp: np.ndarray, ch: np.ndarray, unknown: float) -> tuple[np.ndarray, np.ndarray]:
    """log10 of a context's backoff weight, and of what its discounted counts are multiplied by.

    sd, sp: sums of the discounted counts and of the own probabilities of the words seen after it; ch: its count.
    What a context leaves is at least one part in its count and one.
    """
    seen = np.minimum(sd / ch, ch / (ch + 1.0))
    return np.log10((1 - seen) / np.maximum(1 - sp, unknown * 0.5)), np.log10(seen / sd)


class Model:
    """A trained model: stored tables of words, pairs and backoff weights, and what is bounded as numbers.

    words: w, c.  pairs: a row per bucket, see ``seen``.  backoff: a row per bucket, the weights of its
    contexts in order.  hot: contexts of very many tokens (h, count, weight, factor).  top: pairs of very many.
    """

    def __init__(self, words: DataFrame, pairs: DataFrame, backoff: DataFrame, hot: tuple, top: tuple, buckets: int, word_buckets: int, own: Words, factors: list[float], numbers: dict[str, float]):
        self.words, self.pairs, self.backoff, self.hot, self.top = words, pairs, backoff, hot, top
        self.buckets, self.word_buckets, self.own, self.factors, self.numbers = buckets, word_buckets, own, factors, numbers

    def seen(self) -> DataFrame:
        """The table of pairs row by row: h, w, r."""
        return self.pairs.mapInArrow(_rows_of_pairs, "h long, w long, r long")


def _rows_of_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            h, n, w, r = _of_bucket(row)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(h, n).view(np.int64)), pa.array(w.view(np.int64)), pa.array(r)], names=["h", "w", "r"])


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    """Stores a table in buckets by its column bucket, so that it need not move to meet others.

    Its hashes don't compress and its numbers are packed: a codec would only hold copies of whole buckets beside the heap.
    """
    spark = df.sparkSession
    name = f"katz_pairs_{uuid.uuid4().hex}"
    df.write.option("compression", "none").bucketBy(min(buckets, MOST_BUCKETS), "bucket").option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


def train(docs: DataFrame) -> Model:
    """Counts words and pairs of ``text`` and stores the model, see ``Model``."""
    spark = docs.sparkSession
    release_shuffles(spark)
    small_batches(spark)
    text = docs.select("text")
    words = stored(text.mapInArrow(_count_words, "w long, c long").groupBy("w").agg(F.sum("c").alias("c")), "words")
    kinds = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"), *[F.count_if(F.col("c") == r).alias(f"n{r}") for r in range(1, K + 2)]).first()
    n, v = kinds["n"], kinds["v"]
    buckets, word_buckets = max(1, -(-n // BUCKET_TOKENS)), max(1, -(-v // BUCKET_WORDS))
    numbers: dict[str, float] = {"n": n, "v": v, "docs": 0}
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    if not n:
        pairs, backoff = spark.createDataFrame([], PAIRS), spark.createDataFrame([], "bucket int, la binary")
        return Model(words, pairs, backoff, none, none[:3], 1, 1, Words(0, 0, [1.0] * (K + 1), 1.0, 1.0), [1.0] * (K + 1), numbers)
    factors = discounts({r: kinds[f"n{r}"] for r in range(1, K + 2)})
    left = 1 - words.agg(F.sum(discounted(F.col("c"), factors) / n)).first()[0]
    least = 1 / (n + v + 1)
    own = Words(n, v, factors, 1.0 if left >= least else (1 - least) / (1 - left), max(left, least))
    numbers["docs"] = words.where(F.col("w") == END).first()["c"]
    frequent = max(n // HOT, LEAST_HOT)
    hot = np.sort(np.array([BEGIN] + [r[0] for r in words.where((F.col("c") > frequent) & (F.col("w") != END)).select("w").collect()], np.int64).view(np.uint64))  # at most HOT words
    packed = text.mapInArrow(functools.partial(_count_pairs, hot=hot, buckets=buckets), SENT)
    pairs = _bucketed(packed.groupBy("bucket").applyInArrow(_sum_pairs, PAIRS), buckets)
    told = pairs.select(F.posexplode("kinds").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect()  # K + 1 rows
    pair_factors = discounts({r["k"] + 1: r["n"] for r in told})
    asked = pairs.mapInArrow(functools.partial(_distinct_words, word_buckets=word_buckets), "place int, bucket int, ids binary")
    place = (F.shiftrightunsigned("w", 33) % word_buckets).cast("int")
    counts = asked.groupBy("place").cogroup(words.withColumn("place", place).groupBy("place")).applyInArrow(_look_up, "bucket int, place int, c binary")
    finish = functools.partial(_weigh, hot=hot, own=own, factors=pair_factors, frequent=frequent, word_buckets=word_buckets)

    def weigh(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return finish(key, left, right)

    partial = "array<struct<h:bigint,ch:bigint,sd:double,sp:double>>"
    kind = f"bucket int, la binary, hot {partial}, top array<struct<h:bigint,w:bigint,r:bigint>>"
    backoff = stored(counts.groupBy("bucket").cogroup(pairs.groupBy("bucket")).applyInArrow(weigh, kind), "backoff")
    sums = backoff.select(F.inline("hot")).groupBy("h").agg(*[F.sum(c).alias(c) for c in ("ch", "sd", "sp")]).collect()  # at most HOT rows
    sums = sorted((int(np.int64(r["h"]).view(np.uint64)), r["ch"], r["sd"], r["sp"]) for r in sums)
    h, ch, sd, sp = (np.array([r[i] for r in sums], t) for i, t in enumerate((np.uint64, np.int64, float, float)))
    la, ls = weights(sd, sp, ch, own.unknown)
    top = backoff.select(F.inline("top")).collect()  # at most HOT rows
    th, tw = (np.array([r[c] for r in top], np.int64).view(np.uint64) for c in ("h", "w"))
    with np.errstate(over="ignore"):
        tk = mixed(th, tw)
    order = np.argsort(tk)
    value = np.log10(values(np.array([r["r"] for r in top], np.int64), pair_factors)) + ls[found_in(h, th)] if len(top) else np.zeros(0)
    return Model(words, pairs, backoff.select("bucket", "la"), (h, ch, la, ls), (tk[order], th[order], value[order]), buckets, word_buckets, own, pair_factors, numbers)


@lean
def _distinct_words(batches: Iterator[pa.RecordBatch], word_buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct words of each bucket of pairs, by bucket of words."""
    kind = pa.schema([("place", pa.int32()), ("bucket", pa.int32()), ("ids", pa.binary())])
    for b in batches:
        for row in b.select(["bucket", "w"]).to_pylist():
            ids = np.unique(np.frombuffer(row["w"], np.uint64))
            for p, k in _split(word_bucket(ids, word_buckets)):
                yield pa.RecordBatch.from_pylist([{"place": p, "bucket": row["bucket"], "ids": ids[k].tobytes()}], schema=kind)


def _counts_of(words: pa.Table, ids: np.ndarray, held: list) -> np.ndarray:
    """Counts of some words, 0 for unknown ones; held keeps the sorted table of the group."""
    if not held:
        w, c = words["w"].to_numpy().view(np.uint64), words["c"].to_numpy()
        order = np.argsort(w)
        held += [w[order], c[order]]
    at = found_in(held[0], ids)
    return np.where(at >= 0, held[1][at], 0) if len(held[1]) else np.zeros(len(ids), np.int64)


def _look_up(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    held: list = []
    rows = [{"bucket": r["bucket"], "place": key[0].as_py(), "c": _counts_of(right, np.frombuffer(r["ids"], np.uint64), held).astype("<i8").tobytes()} for r in _rows(left)]
    return pa.Table.from_pylist(rows, schema=pa.schema([("bucket", pa.int32()), ("place", pa.int32()), ("c", pa.binary())]))


def _weigh(key: tuple, left: pa.Table, right: pa.Table, hot: np.ndarray, own: Words, factors: list[float], frequent: int, word_buckets: int) -> pa.Table:
    """Backoff weights of the contexts of one bucket; of frequent contexts the bucket's share of the sums."""
    partial = pa.list_(pa.struct([("h", pa.int64()), ("ch", pa.int64()), ("sd", pa.float64()), ("sp", pa.float64())]))
    pair = pa.list_(pa.struct([("h", pa.int64()), ("w", pa.int64()), ("r", pa.int64())]))
    out = []
    for row in _rows(right):
        h, n, w, r = _of_bucket(row)
        ids, at = np.unique(w, return_inverse=True)
        count = np.zeros(len(ids), np.int64)
        told = sorted((x["place"], x["c"]) for x in _rows(left))
        count[np.argsort(word_bucket(ids, word_buckets), kind="stable")] = np.concatenate([np.frombuffer(c, "<i8") for _, c in told])
        first = np.cumsum(n) - n
        sp, sd, ch = np.add.reduceat(own.p(count)[at], first), np.add.reduceat(values(r, factors), first), np.add.reduceat(r, first)
        la, _ = weights(sd, sp, ch, own.unknown)
        k = np.flatnonzero(found_in(hot, h) >= 0)
        sums = [{"h": a, "ch": b, "sd": c, "sp": d} for a, b, c, d in zip(h[k].view(np.int64).tolist(), ch[k].tolist(), sd[k].tolist(), sp[k].tolist(), strict=True)]
        t = np.flatnonzero(r > frequent)
        hs = np.repeat(h, n)[t].view(np.int64).tolist()
        tops = [{"h": a, "w": b, "r": c} for a, b, c in zip(hs, w[t].view(np.int64).tolist(), r[t].tolist(), strict=True)]
        out.append({"bucket": key[0].as_py(), "la": la.astype("<f8").tobytes(), "hot": sums, "top": tops})
    return pa.Table.from_pylist(out, schema=pa.schema([("bucket", pa.int32()), ("la", pa.binary()), ("hot", partial), ("top", pair)]))


def _doc_sums(doc: np.ndarray, n: int, *values: np.ndarray) -> list[np.ndarray]:
    return [np.bincount(doc, v, n) for v in values]


@lean
def _ship(batches: Iterator[pa.RecordBatch], told, buckets: int) -> Iterator[pa.RecordBatch]:
    """Sums what the frequent contexts and pairs tell, and sends the other pairs by bucket."""
    thrifty()
    ids, pack = _Ids(), TaskContext.get().partitionId() << 32
    (hot_h, hot_c, _, _), (top_keys, top_h, top_v), own, docs = told.value
    end = (float(own.base(np.int64(docs))), float(docs > 0))
    with np.errstate(over="ignore"):
        for t in chunks(batches, PACK_BYTES):
            pack += 1
            w, sizes = tokens(utf8(t["text"]), ids)
            t = t.drop(["text"])
            n = len(sizes)
            doc = np.repeat(np.arange(n, dtype=np.uint32), sizes)
            h = contexts(w, sizes)
            at = found_in(hot_h, h)
            hit = (at >= 0) & (h != np.uint64(BEGIN))  # a text's begin is no token
            base, known = _doc_sums(doc[hit], n, own.base(hot_c[at[hit]]) if len(hot_c) else np.zeros(0), np.ones(int(hit.sum())))
            mix = mixed(h, w)
            at = found_in(top_keys, mix)
            hit = at >= 0
            hit[hit] = top_h[at[hit]] == h[hit]
            score = _doc_sums(doc[hit], n, top_v[at[hit]] if len(top_v) else np.zeros(0))[0]
            head = np.stack([score, base + end[0], known + end[1], sizes.astype(float)])
            held = pa.BufferOutputStream()
            with pa.ipc.new_stream(held, t.schema) as out:
                out.write_table(t)
            yield _batch([{"bucket": pack % buckets, "pack": pack, "doc": head.tobytes(), "head": held.getvalue().to_pybytes()}], SENT)
            del at, t, held, head
            if hit.any():
                h, w, mix, doc = h[~hit], w[~hit], mix[~hit], doc[~hit]
            order, first, many = _by_context(h, w, mix)
            doc = doc[order].astype("<u2" if n <= 65_536 else "<u4")
            at = order[first]
            h, w, mix = h[at], w[at], mix[at]
            del order, at, hit, score, base, known
            for b, k in _split(bucket_of(h, mix, hot_h, buckets)):
                places = np.repeat(first[k] - np.cumsum(many[k]) + many[k], many[k]) + np.arange(many[k].sum())
                yield _batch([{"bucket": b, "pack": pack, "m": many[k].astype("<u4").tobytes(), "doc": doc[places].tobytes(), "head": n.to_bytes(4, "little")} | _listed(h[k], w[k])], SENT)


def _told(pack: int, n: int, doc: np.ndarray, score: np.ndarray, base: np.ndarray, known: np.ndarray) -> dict:
    """Sums per document of a pack, for the documents concerned."""
    used = np.flatnonzero(np.bincount(doc, minlength=n))
    sums = _doc_sums(doc, n, score, base, known)
    return {"pack": pack, "docs": used.astype("<u2" if n <= 65_536 else "<u4").tobytes(), "sums": sums[0][used].tobytes() + sums[1][used].tobytes() + sums[2][used].astype("<u4").tobytes()}


def _meet(key: tuple, left: pa.Table, right: pa.Table, told, factors: list[float], word_buckets: int) -> pa.Table:
    """Scores the pairs of one bucket; tokens whose pair the model has not go on to the words' buckets, with the weight of their context."""
    thrifty()
    (hot_h, _, hot_la, hot_ls), _, own, _ = told.value
    empty = np.zeros(0, np.uint64)
    ctx, keys, pair_h, pair_w, pair_v, la, ls, base = empty, empty, empty, empty, np.zeros(0), np.zeros(0), np.zeros(0), np.zeros(0)
    out: list[dict] = []
    with np.errstate(over="ignore"):
        for row in _rows(right):  # one
            ctx, n, pair_w, r = _of_bucket(row)
            la = np.concatenate([np.frombuffer(x["w"], "<f8") for x in _rows(left) if x["pack"] == -1])
            first = np.cumsum(n) - n
            d = values(r, factors)
            ch = np.add.reduceat(r, first)
            ls = weights(np.add.reduceat(d, first), np.zeros(len(ctx)), ch, 1.0)[1]
            base = own.base(ch)
            pair_h = np.repeat(ctx, n)
            keys = mixed(pair_h, pair_w)
            order = np.argsort(keys)
            keys, pair_h, pair_w, pair_v = keys[order], pair_h[order], pair_w[order], np.log10(d)[order]
            del order, d, r
        for row in _rows(left):
            if row["pack"] == -1:
                continue
            if row["h"] is None:
                out.append({"pack": row["pack"], "sums": row["doc"], "head": row["head"]})
                continue
            hs, n, w = _unlisted(row)
            docs = int.from_bytes(row["head"], "little")
            doc = np.frombuffer(row["doc"], "<u2" if docs <= 65_536 else "<u4")
            many = np.frombuffer(row["m"], "<u4").astype(np.int64)
            at, hot = found_in(ctx, hs), found_in(hot_h, hs)
            cold = hot < 0
            there = at >= 0
            pick = lambda mine, frequent: np.where(cold, np.where(there, mine[at] if len(mine) else 0.0, 0.0), frequent[hot] if len(frequent) else 0.0)  # noqa: E731, B023
            h_la, h_ls = pick(la, hot_la), pick(ls, hot_ls)
            h_base = np.where(cold, np.where(there, base[at] if len(base) else 0.0, own.base(np.int64(0))), 0.0)
            h_known = (cold & there).astype(float)
            of = np.repeat(np.arange(len(hs)), n)
            place = found_in(keys, mixed(hs[of], w))
            seen = place >= 0
            seen[seen] = (pair_h[place[seen]] == hs[of][seen]) & (pair_w[place[seen]] == w[seen])
            score = np.where(seen, (pair_v[place] if len(pair_v) else 0.0) + h_ls[of], h_la[of])
            each = np.repeat(np.arange(len(w)), many)
            out.append(_told(row["pack"], docs, doc, score[each], h_base[of][each], h_known[of][each]))
            rest = np.flatnonzero(~seen[each])
            for p, k in _split(word_bucket(w[each[rest]], word_buckets)) if len(rest) else ():
                k = rest[k]
                out.append({"pack": row["pack"], "place": p, "docs": doc[k].tobytes(), "head": row["head"], "w": w[each[k]].tobytes()})
    del keys, pair_h, pair_w, pair_v
    give_back()
    return _table(out, TOLD)


def _back_off(key: tuple, left: pa.Table, right: pa.Table, told) -> pa.Table:
    """Own probabilities of the tokens that have come from the pairs."""
    own, held, out = told.value[2], [], []
    for row in _rows(left):
        docs = int.from_bytes(row["head"], "little")
        doc = np.frombuffer(row["docs"], "<u2" if docs <= 65_536 else "<u4")
        p = np.log10(own.p(_counts_of(right, np.frombuffer(row["w"], np.uint64), held)))
        none = np.zeros(len(doc))
        out.append(_told(row["pack"], docs, doc, p, none, none))
    return _table(out, TOLD)


def _gather(key: tuple, group: pa.Table) -> pa.Table:
    rows = [*_rows(group)]
    head = next(r for r in rows if r["head"] is not None)
    total = np.frombuffer(head["sums"]).reshape(4, -1).copy()
    for r in rows:
        if r["head"] is None:
            at = np.frombuffer(r["docs"], "<u2" if total.shape[1] <= 65_536 else "<u4")
            total[:2, at] += np.frombuffer(r["sums"], "<f8", 2 * len(at)).reshape(2, -1)
            total[2, at] += np.frombuffer(r["sums"], "<u4", offset=16 * len(at))
    out = pa.ipc.open_stream(head["head"]).read_all()
    for name, x in (("n_tokens", total[3].astype(np.int64)), ("n_known", np.rint(total[2]).astype(np.int64)), ("base_score", total[1]), ("score", total[0])):
        out = out.append_column(name, pa.array(x))
    return out


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, n_tokens, n_known, base_score and score (log10) of every text."""
    spark = docs.sparkSession
    small_batches(spark)
    told = spark.sparkContext.broadcast((model.hot, model.top, model.own, int(model.numbers["docs"])))  # at most HOT contexts and HOT pairs
    given = docs.select(*keep, "text")
    packed = given.mapInArrow(functools.partial(_ship, told=told, buckets=model.buckets), SENT)
    none = lambda *names: [F.lit(None).cast("binary").alias(c) for c in names]
    weighed = model.backoff.select("bucket", F.lit(-1).cast("long").alias("pack"), *none("h", "n"), F.col("la").alias("w"), *none("m", "doc", "head"))
    factors, word_buckets = model.factors, model.word_buckets

    def meet(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _meet(key, left, right, told, factors, word_buckets)

    def back_off(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _back_off(key, left, right, told)

    met = stored(packed.unionByName(weighed).groupBy("bucket").cogroup(model.pairs.groupBy("bucket")).applyInArrow(meet, TOLD), "scored")
    place = (F.shiftrightunsigned("w", 33) % word_buckets).cast("int")
    on = met.where("place is not null").groupBy("place").cogroup(model.words.withColumn("place", place).groupBy("place")).applyInArrow(back_off, TOLD)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1])
    return met.where("place is null").unionByName(on).groupBy("pack").applyInArrow(_gather, f"{types}, n_tokens long, n_known long, base_score double, score double")
