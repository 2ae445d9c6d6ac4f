"""Near-duplicate classes by Order MinHash.

A text is the sequence of its five-word shingles, each labelled with how often it has occurred
before, so all are distinct.  Per table the few shingles with the least hashes are taken and kept in
text order; their sequence is the table's key.  Texts sharing a key are candidates: each is compared
with a leader of its bucket, the text that shares most keys with others.  Buckets that then still
hold several classes are compared in full: small ones pair by pair; in larger ones every text outside
the main class meets the whole bucket, block by block, and is aligned with what shares enough
shingles and is of another class.  A pair counts as near if an alignment
within a band around the diagonal matches m of its n and o shingles with m / (n + o - m) >= 0.8; as
labelled shingles are distinct, the best alignment is a longest increasing run of match places.
Classes are the connected components of verified pairs; equal texts are one node throughout.

Defined results: null and empty texts are equal texts; texts under five words have no shingle and are
only ever duplicates of equal texts; texts of any length are treated whole; an empty table gives an
empty result; documents without id belong to classes but name none; repeated rows share
a class; column names other than doc_id and text play no part.
"""

from __future__ import annotations

import bisect
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, release_shuffles, small_batches, stored
from tidemark.llm.decontamination import _Ids, token_ids

SHINGLE, SIMILAR = 5, 0.8
#: Tables, and shingles whose order makes a table's key. A pair of similarity 0.8 shares no key with odds of 1 in 95,000.
TABLES, ORDERED = 16, 3
#: Texts up to which a bucket of several classes is compared pair by pair, and shingles per block of larger ones.
FULL, BLOCK = 24, 1 << 19
SLICE_CHARS = 3 << 20
#: Rows of 16 bytes that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labelled shingles of all texts in a row, and where each text's begin (one more entry for the end)."""
    sizes = np.maximum(np.diff(starts) - SHINGLE + 1, 0)
    out = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=out[1:])
    text = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(out[-1]) - out[text] + starts[text] if len(text) else np.zeros(0, np.int64)
    h = np.zeros(len(at), np.uint64)
    for j in range(SHINGLE):
        h = mix(h * ODD + ids[at + j])
    key = h ^ mix(text.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(at), bool)
    again[1:] = key[order[1:]] == key[order[:-1]]
    place = np.arange(len(at))
    label = place - np.maximum.accumulate(np.where(again, 0, place)) if len(at) else place
    times = np.zeros(len(at), np.uint64)
    times[order] = label.astype(np.uint64)
    return np.where(times > 0, mix(h + times * ODD), h), out


def sketches(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Keys (texts by tables): hash of the least ``ORDERED`` shingles in text order. Texts without shingles get 0."""
    n = len(starts) - 1
    keys = np.zeros((n, TABLES), np.uint64)
    full = np.flatnonzero(np.diff(starts) > 0)
    if not len(full):
        return keys
    begin = starts[full]
    text = np.repeat(np.arange(len(full)), np.diff(starts)[full])
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    for t in range(TABLES):
        v = mix(h ^ mix(np.uint64(t + 1) * ODD))
        at = np.full((len(full), ORDERED), len(h), np.int64)
        for k in range(ORDERED):
            least = np.minimum.reduceat(v, begin)
            hit = np.flatnonzero((v == least[text]) & (v != top))
            at[text[hit], k] = hit
            v[hit] = top
        at.sort(axis=1)
        key = np.full(len(full), np.uint64(t + 1))
        for k in range(ORDERED):
            key = mix(key * ODD + np.where(at[:, k] < len(h), h[np.minimum(at[:, k], len(h) - 1)], np.uint64(0)))
        keys[full, t] = key
    return keys


def aligned(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sequences of distinct shingles by banded alignment."""
    n, o = len(a), len(b)
    if not n or not o or min(n, o) < SIMILAR * max(n, o):
        return 0.0
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = (n + o) * (1 - SIMILAR) / (1 + SIMILAR)  # a similar pair has no more unmatched shingles than this
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    if len(i) < SIMILAR / (1 + SIMILAR) * (n + o):
        return len(i) / (n + o - len(i))
    j = j[np.argsort(i)]
    if len(j) > 1 and not (j[1:] > j[:-1]).all():
        run: list[int] = []
        for x in j.tolist():
            k = bisect.bisect_left(run, x)
            run[k : k + 1] = [x]
        m = len(run)
    else:
        m = len(j)
    return m / (n + o - m)


def _slices(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > first and size + n > SLICE_CHARS:
            yield first, i
            first, size = i, 0
        size += n
    if texts:
        yield first, len(texts)


@lean
def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Ids()
    with np.errstate(over="ignore"):
        for b in batches:
            texts = b["text"].to_pylist()
            for i, j in _slices(texts):
                h, starts = shingles(*token_ids(texts[i:j], words))
                keys = sketches(h, starts)
                sizes = np.diff(starts)
                offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, TABLES, 0))]).astype(np.int32)
                flat = pa.array(keys[sizes > 0].reshape(-1).view(np.int64))
                part = b.slice(i, j - i)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["digest"], pa.array(sizes.astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), flat)], names=["doc_id", "digest", "n", "keys"]
                )


@lean
def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Ids()
    with np.errstate(over="ignore"):
        for b in batches:
            ta, tb = b["ta"].to_pylist(), b["tb"].to_pylist()
            good, last, held = [], None, None
            for x, y in zip(ta, tb, strict=True):
                if last is None or y != last:  # pairs of one leader come together
                    last, held = y, shingles(*token_ids([y], words))[0]
                good.append(aligned(shingles(*token_ids([x], words))[0], held))
            keep = pa.array([g >= SIMILAR for g in good], pa.bool_())
            yield pa.RecordBatch.from_arrays([b["a"], b["b"], pa.array(good, pa.float64())], names=["a", "b", "similarity"]).filter(keep)


@lean
def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _Ids()
    with np.errstate(over="ignore"):
        for b in batches:
            texts = b["text"].to_pylist()
            for i, j in _slices(texts):
                h, starts = shingles(*token_ids(texts[i:j], words))
                held = pa.array([h[x:y].tobytes() for x, y in zip(starts[:-1], starts[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays([b["digest"].slice(i, j - i), held], names=["digest", "h"])


def _across(key: tuple, group: pa.Table) -> pa.Table:
    """Near pairs of two classes, of a block's outside texts with its members; pairs that join no further classes are left out."""
    outside = group["outside"].to_numpy()
    at, to = np.flatnonzero(outside), np.flatnonzero(~outside)
    digests, held = group["digest"].to_pylist(), [np.frombuffer(x, np.uint64) for x in group["h"].to_pylist()]
    number: dict[bytes, int] = {}
    kind = np.array([number.setdefault(c, len(number)) for c in group["class"].to_pylist()], np.int64)
    sizes = np.array([len(held[j]) for j in to], np.int64)
    flat = np.concatenate([np.zeros(0, np.uint64), *(held[j] for j in to)])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], np.repeat(np.arange(len(to)), sizes)[order]
    rows: list[tuple[bytes, bytes, float]] = []
    for i in at:
        a = held[i]
        first = np.searchsorted(flat, a)
        times = np.searchsorted(flat, a, "right") - first
        if np.count_nonzero(times) < SIMILAR * len(a) - 1e-6:  # a near text shares this many
            continue
        place = np.repeat(first - np.cumsum(times) + times, times) + np.arange(times.sum())
        common = np.bincount(owner[place], minlength=len(to))
        enough = common * (1 + SIMILAR) >= SIMILAR * (len(a) + sizes) - 1e-6
        rest = np.flatnonzero(enough & (kind[to] != kind[i]))
        for j in to[rest[np.argsort(-common[rest], kind="stable")]]:
            if kind[j] != kind[i] and (near := aligned(a, held[j])) >= SIMILAR:
                rows.append((min(digests[i], digests[j]), max(digests[i], digests[j]), near))
                kind[kind == kind[j]] = kind[i]
    a, b, near = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "similarity": pa.array(near, pa.float64())})


def across(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between the classes of large buckets: all that is outside the main class meets all members, in blocks of about ``BLOCK`` shingles."""
    weight, outside = F.col("n") + 64, F.col("class") != F.col("main")
    count = lambda w: F.ceil(F.sum(w) / BLOCK).cast("int")
    rows = rows.join(rows.groupBy("key").agg(count(weight).alias("wide"), count(F.when(outside, weight)).alias("deep")), "key")
    own = lambda n, k: F.pmod(F.xxhash64("digest", F.lit(k)), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.where(outside).select("key", "digest", "class", F.lit(True).alias("outside"), own("deep", 1).alias("i"), each("wide").alias("j"))
    right = rows.select("key", "digest", "class", F.lit(False).alias("outside"), own("wide", 2).alias("j"), each("deep").alias("i"))
    held = texts.join(rows.select("digest").distinct(), "digest", "left_semi").select("digest", "text").mapInArrow(_shingled, "digest binary, h binary")
    return left.unionByName(right).join(held, "digest").groupBy("key", "i", "j").applyInArrow(_across, "a binary, b binary, similarity double")


def components(links: DataFrame) -> DataFrame:
    """(node, class): each node of the links and the least node it is connected to."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("class")), "labels")
    while True:
        heard = both.join(labels.select(F.col("node").alias("b"), "class"), "b").groupBy("a").agg(F.min("class").alias("m"))
        near = labels.join(heard.withColumnRenamed("a", "node"), "node").select("node", F.col("class").alias("old"), F.least("class", "m").alias("class"))
        far = labels.select(F.col("node").alias("class"), F.col("class").alias("further"))
        new = stored(near.join(far, "class", "left").select("node", "old", F.least("class", F.coalesce("further", "class")).alias("class")), "labels")
        labels = new.select("node", "class")
        if new.where(F.col("old") != F.col("class")).isEmpty():
            return labels


def _small(df: DataFrame) -> DataFrame:
    """The rows, marked for broadcast if a count shows that they are few."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def with_digest(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("digest"))


def _pairs(rows: DataFrame, lead: DataFrame) -> DataFrame:
    """Texts of a bucket with its leaders, where the classes differ and the lengths allow a near pair."""
    met = rows.join(lead, "key").where((F.col("class") != F.col("x.c")) & (F.least("n", "x.o") >= SIMILAR * F.greatest("n", "x.o")))
    return met.select(F.least("digest", F.col("x.d")).alias("a"), F.greatest("digest", F.col("x.d")).alias("b")).distinct()


def _near(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    both = pairs.join(texts.select(F.col("digest").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("digest").alias("b"), F.col("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(_verify, "a binary, b binary, similarity double")


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Distinct texts (digest, least doc_id), verified near pairs (a, b, similarity) of digests, and their components."""
    spark = docs.sparkSession
    release_shuffles(spark)
    small_batches(spark)
    given = with_digest(docs)
    kind = given.schema["doc_id"].dataType.simpleString()
    drawn = given.mapInArrow(_sketch, f"doc_id {kind}, digest binary, n int, keys array<bigint>")
    nodes = stored(drawn.groupBy("digest").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("keys").alias("keys")), "nodes")
    entries = nodes.select("digest", "n", F.explode("keys").alias("key"))
    shared = entries.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    entries = entries.join(shared, "key")
    central = entries.groupBy("digest").agg(F.sum("members").alias("central"))  # texts whose shingles many others kept
    entries = stored(entries.join(central, "digest"), "entries")
    wanted = _small(stored(entries.select("digest").distinct(), "wanted"))
    texts = stored(given.select("digest", "text").join(wanted, "digest").groupBy("digest").agg(F.first("text").alias("text")), "texts")
    other = F.struct(F.col("digest").alias("d"), F.col("n").alias("o"), F.col("class").alias("c"))
    rows = entries.withColumn("class", F.col("digest"))
    lead = rows.groupBy("key").agg(F.min_by(other, F.struct(-F.col("central"), F.xxhash64("digest"))).alias("x"))
    tested = stored(_pairs(rows, lead), "pairs")
    found = stored(_near(tested, texts), "links")
    known = components(found)
    rows = entries.join(known.withColumnRenamed("node", "digest"), "digest", "left").withColumn("class", F.coalesce("class", "digest"))
    main = rows.groupBy("key", "class").agg(F.count("*").alias("m")).groupBy("key").agg(F.max_by("class", "m").alias("main"), F.sum("m").alias("all"), F.max("m").alias("most"))
    rows = stored(rows.join(main.where(F.col("all") > F.col("most")), "key"), "split")
    # what two classes of a bucket may still have in common: after this every pair that shares a key is tested or of one class
    more = []
    small, large = rows.where(F.col("all") <= FULL), rows.where(F.col("all") > FULL)
    if not small.isEmpty():
        pairs = stored(_pairs(small, small.select("key", other.alias("x"))).join(tested, ["a", "b"], "left_anti"), "pairs")
        more.append(stored(_near(pairs, texts), "links"))
    if not large.isEmpty():
        more.append(stored(across(large, texts), "across"))
    more = [x for x in more if not x.isEmpty()]
    for x in more:
        found = found.unionByName(x)
    return nodes.select("digest", "least"), found, components(found) if more else known


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, digest and class_id of every row: the least doc_id among the texts it is connected to."""
    nodes, _, known = links(docs)
    joined = nodes.join(known.withColumnRenamed("node", "digest"), "digest", "left").withColumn("class", F.coalesce("class", "digest"))
    least = joined.groupBy("class").agg(F.min("least").alias("class_id"))
    of = stored(joined.join(least, "class").select("digest", "class_id"), "classes")
    return with_digest(docs).select("doc_id", "digest").join(of, "digest")


def keep_one(docs: DataFrame) -> DataFrame:
    """The row of the least doc_id of each class, with all columns; of repeated rows of that id one stays.

    Documents without id stay if their whole class has none.
    """
    known = stored(classes(docs), "classed")
    stays = known.where(F.col("doc_id") == F.col("class_id")).groupBy("doc_id").agg(F.min("digest").alias("digest"), F.lit(True).alias("stays"))
    named = known.where("class_id is not null").select("doc_id", "digest").distinct()
    gone = named.join(stays, (named["doc_id"].eqNullSafe(stays["doc_id"])) & (named["digest"] == stays["digest"]), "left_anti")
    gone = _small(stored(gone.select(F.col("doc_id").alias("i"), F.col("digest").alias("d")), "gone"))
    names = docs.columns
    digest = F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("i"), digest.alias("d"))
    kept = rows.join(gone, rows["i"].eqNullSafe(gone["i"]) & (rows["d"] == gone["d"]), "left_anti")
    repeated = stored(known.where("doc_id = class_id").groupBy("doc_id", "digest").count().where("count > 1").select(F.col("doc_id").alias("i"), F.col("digest").alias("d")), "repeated")
    if not repeated.isEmpty():
        once = kept.join(repeated, ["i", "d"], "left_semi").dropDuplicates(["i", "d"])
        kept = kept.join(repeated, ["i", "d"], "left_anti").unionByName(once)
    return kept.select(*[F.col("row")[c].alias(c) for c in names])
