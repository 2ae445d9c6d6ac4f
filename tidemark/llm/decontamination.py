"""Benchmark decontamination by spaced-seed hashing.

Texts become lower-case word tokens.  Each mask hashes the tokens at its marked positions and
ignores the others.  Hashes of the benchmark meet hashes of the documents; around each hit the
benchmark item and the document are compared token by token on the same diagonal, and the best
stretch of at least four fifths equal tokens is kept.  The masks leave nothing out: every window of
10 tokens with two substitutions, and of 8 with one, shares a hash under one of them, and a stretch
of four fifths equal tokens has such a window.

The benchmark is dealt to blocks by its size in bytes; a block (``BLOCK_BYTES`` of text on average)
is what a task holds at a time, so a benchmark of any size is served, in more passes.

Defined results: null and empty texts hit nothing; texts and items of any length are compared whole;
benchmark items of 5 to 7 tokens must occur whole and unchanged; shorter ones (``SHORTEST``) are no
evidence and not looked for; equal items are reported each, items without id with a null id; ids of
any type stay as they are; repeated rows are judged each; an empty benchmark hits nothing, an empty
table gives an empty result; ``drop_contaminated`` keeps all columns, whatever their names.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filtered, lean, small_batches, stored

MASKS = ("111011", "11001011", "11111")
#: Equal tokens that one other token may stand against: 4 for a share of four fifths.
SHARE_ODDS = 4
LEAST_TOKENS, LEAST_SHARE, SHORTEST = 13, SHARE_ODDS / (SHARE_ODDS + 1), 5
BLOCK_BYTES = 4 << 20
SLICE_CHARS = 3 << 20
WORD = re.compile(r"\w+")
ODD = np.uint64(0x9E3779B97F4A7C15)
BITS = 22


class _Ids(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        v = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return v


def token_ids(texts: list[str | None], ids: _Ids) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts in a row, and where each text starts (one more entry for the end)."""
    get, parts = ids.__getitem__, []
    for t in texts:
        words = WORD.findall(t.lower()) if t else []
        parts.append(np.fromiter(map(get, words), np.uint64, len(words)))
    starts = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=starts[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), starts


def masked_hashes(ids: np.ndarray, mask: str) -> np.ndarray:
    """Hash of every window of the mask's length (windows across text borders included)."""
    n = len(ids) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, factor = np.zeros(n, np.uint64), np.uint64(1)
    for j, c in enumerate(mask):
        if c == "1":
            factor = factor * ODD + np.uint64(2)
            h += ids[j : j + n] * factor
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def within(starts: np.ndarray, length: int) -> np.ndarray:
    """Positions at which a window of this length stays inside its text."""
    n = int(starts[-1])
    ok = np.ones(n + 1, bool)
    for back in range(1, length):
        at = starts[1:] - back
        ok[at[at >= 0]] = False
    return np.flatnonzero(ok[:n])


class Block:
    """Hashes of some benchmark items, sorted, with a bit table in front."""

    def __init__(self, item_ids: list, texts: list[str | None]):
        with np.errstate(over="ignore"):
            self.item_ids = item_ids
            self.ids, self.starts = token_ids(texts, _Ids())
            length = np.diff(self.starts)
            self.item_of = np.repeat(np.arange(len(length)), length)
            self.tables = []
            for mask in (*MASKS, "1" * SHORTEST):
                at = within(self.starts, len(mask))
                if mask == "1" * SHORTEST:  # for the short items only, at their start
                    at = at[(length[self.item_of[at]] < 8) & (at == self.starts[self.item_of[at]])]
                else:
                    at = at[length[self.item_of[at]] >= 8]
                h = masked_hashes(self.ids, mask)[at] if len(at) else np.zeros(0, np.uint64)
                order = np.argsort(h, kind="stable")
                bits = np.zeros(1 << BITS, bool)
                bits[h >> np.uint64(64 - BITS)] = True
                self.tables.append((mask, h[order], at[order], bits))

    def hits(self, ids: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, start token, tokens, equal tokens) of the verified overlaps."""
        found = []
        for mask, keys, places, bits in self.tables:
            if not len(keys) or len(ids) < len(mask):
                continue
            h = masked_hashes(ids, mask)
            p = np.flatnonzero(bits[h >> np.uint64(64 - BITS)])
            lo, hi = np.searchsorted(keys, h[p], "left"), np.searchsorted(keys, h[p], "right")
            p, lo, n = p[hi > lo], lo[hi > lo], (hi - lo)[hi > lo]
            q = places[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            found.append(np.stack([np.repeat(p, n), q], 1))
        if not found or not sum(map(len, found)):
            return []
        pq = np.concatenate(found)
        text = np.searchsorted(starts, pq[:, 0], "right") - 1
        item = self.item_of[pq[:, 1]]
        seen = np.unique(np.stack([text, item, pq[:, 0] - (pq[:, 1] - self.starts[item])], 1), axis=0)
        out = []
        for t, b, first in seen.tolist():
            o = self.verify(ids, int(starts[t]), int(starts[t + 1]), b, first)
            if o:
                out.append((t, b, *o))
        return out

    def verify(self, ids: np.ndarray, begin: int, end: int, item: int, first: int) -> tuple[int, int, int] | None:
        """Best stretch of the item laid on the text with its first token at position ``first``."""
        a, z = int(self.starts[item]), int(self.starts[item + 1])
        n = z - a
        lo, hi = max(first, begin), min(first + n, end)
        same = self.ids[a + lo - first : a + hi - first] == ids[lo:hi]
        if n < 8:
            return (lo - begin, n, n) if hi - lo == n and same.all() else None
        need = min(LEAST_TOKENS, int(np.ceil(LEAST_SHARE * n)))
        # a stretch from i to j has its share of equal tokens if total[j] >= total[i]; for each j the first such i
        total = np.concatenate([[0], np.cumsum(np.where(same, 1, -SHARE_ODDS))])
        equal = np.concatenate([[0], np.cumsum(same)])
        begins = np.searchsorted(-np.minimum.accumulate(total), -total, "left")
        stop = int(np.argmax(equal - equal[begins]))
        start, got = int(begins[stop]), int(equal[stop] - equal[begins[stop]])
        return (lo - begin + start, stop - start, got) if got >= need else None


def _searched(texts: list[str | None], words: _Ids, block: Block) -> Iterator[tuple[int, int, int, int, int]]:
    """The verified overlaps of some texts, slice by slice."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last] or "") < SLICE_CHARS):
            size += len(texts[last] or "")
            last += 1
        for t, *hit in block.hits(*token_ids(texts[first:last], words)):
            yield first + t, *hit
        first = last


@lean
def _find(batches: Iterator[pa.RecordBatch], block) -> Iterator[pa.RecordBatch]:
    words, b = _Ids(), block.value
    with np.errstate(over="ignore"):
        for batch in batches:
            hits = [list(x) if x else [] for x in batch.column(batch.num_columns - 1).to_pylist()]
            for t, item, at, n, equal in _searched(batch["text"].to_pylist(), words, b):
                hits[t].append({"item_id": b.item_ids[item], "start": at, "tokens": n, "matched": equal})
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(hits, batch.schema.types[-1])], names=batch.schema.names)


def _clean(texts: Iterator[list[str | None]], block) -> Iterator[list[bool]]:
    words, b = _Ids(), block.value
    for part in texts:
        with np.errstate(over="ignore"):
            hit = {t for t, *_ in _searched(part, words, b)}
        yield [t not in hit for t in range(len(part))]


def _blocks(benchmark: DataFrame) -> Iterator[tuple[int, object]]:
    """Blocks of the benchmark, broadcast, and how many are still to come; a block is released when the next one is asked for."""
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k).collect()  # BLOCK_BYTES on average
        part.sort(key=lambda r: (r[0] is not None, r[0], r[1]))
        block = spark.sparkContext.broadcast(Block([r[0] for r in part], [r[1] for r in part]))
        yield n - 1 - k, block
        if k < n - 1:
            block.destroy()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, the benchmark items found (ascending) and the longest overlap, of each row."""
    small_batches(docs.sparkSession)
    kind = benchmark.schema["item_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.array().cast(f"array<struct<item_id:{kind},start:int,tokens:int,matched:int>>").alias("hits"))
    schema = rows.schema
    for left, block in _blocks(benchmark):
        rows = rows.mapInArrow(functools.partial(_find, block=block), schema)
        if left:
            rows = stored(rows, "decontaminated")
    hits = F.col("hits")
    return rows.select(
        "doc_id",
        (F.size(hits) > 0).alias("contaminated"),
        F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["item_id"]))).alias("items"),
        F.coalesce(F.array_max(F.transform(hits, lambda h: h["matched"])), F.lit(0)).alias("longest"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without overlaps, with all their columns."""
    for left, block in _blocks(benchmark):
        docs = filtered(docs, functools.partial(_clean, block=block))
        if left:
            docs = stored(docs, "decontaminated")
    return docs
