"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence has a probability from its distinct words: a word
weighs as much as itself and its beginnings of ``PREFIXES`` letters together, so that forms of one
stem share what is learnt.  The document's probability is the noisy-or of its sentences,
1 - prod(1 - p).  Weights are fitted to document labels only, through the noisy-or, and then tell
which sentences offend.

The fit uses at most ``SAMPLE`` labelled documents of each class, those with the smallest hashes
of doc_id, of these at most ``SAMPLE_BYTES`` of text, and no document of more than ``LONGEST``
bytes (documented bounds of the fit alone; both classes weigh alike in it).  Scoring covers all
documents and whole texts.

Defined results: null and empty texts have no sentence and score 0; texts of any length are scored
whole; several labels of one doc_id count as toxic if one is; labels without document, null labels
and null ids are left out; without labels of both classes every score is 0; repeated rows are scored
each; an empty table gives an empty result; clashing column names of labels or documents play no part.
"""

from __future__ import annotations

import functools
import math
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import filtered, give_back, lean, small_batches

#: Labelled documents per class that the fit looks at, at most; bytes of their texts in all, and of each.
SAMPLE, SAMPLE_BYTES, LONGEST = 3000, 64 << 20, 1 << 20
#: Feature buckets, documents a feature must occur in, passes, step width, shrinkage.
BUCKETS, LEAST_DOCS, PASSES, STEP, SHRINK = 1 << 20, 3, 200, 0.1, 1e-3
#: What a weight must reach in the first round of passes to stay.
LEAST_WEIGHT = 0.5
#: Letters of the beginnings that words are known by beside themselves.
PREFIXES = (3, 4, 5, 6, 7)
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")
OFFENDING = 0.5


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


def features(word: str) -> list[int]:
    """Buckets of a word and of its beginnings (marked by a star, which no word holds)."""
    return [bucket(word), *(bucket(word[:n] + "*") for n in PREFIXES if len(word) >= n)]


@dataclass(frozen=True)
class Model:
    bias: float
    words: dict[int, float]

    def scorer(self):
        return _Weights(self.words)


class _Weights(dict):
    """Weights of words met so far."""

    def __init__(self, by_bucket: dict[int, float]):
        super().__init__()
        self.by_bucket = by_bucket

    def __missing__(self, word: str) -> float:
        if len(self) > 200_000:
            self.clear()
        get = self.by_bucket.get
        w = self[word] = sum([get(f, 0.0) for f in features(word)])
        return w


def sample(docs: DataFrame, labels: DataFrame, usable: Column | None = None, most: int = SAMPLE) -> DataFrame:
    """toxic, id and text of the bounded sample."""
    ids = docs.select(F.col("doc_id").alias("id")).distinct()
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic")).join(ids, "id", "left_semi")
    first = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("id"), "id").limit(most) for c in (0, 1)]
    chosen = F.broadcast(first[0].unionByName(first[1]))  # at most 2 * most rows
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    texts = docs.select(F.col("doc_id").alias("id"), "text").where(size <= LONGEST).join(chosen, "id")
    so_far = F.sum(size).over(Window.partitionBy("toxic").orderBy(F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0))  # over the sample only
    return texts.withColumn("so_far", so_far).where(F.col("so_far") <= SAMPLE_BYTES // 2).select("toxic", "id", "text")


class Bags:
    """Labelled documents as arrays: words of sentences, sentences of documents, features of words."""

    def __init__(self, docs: Iterable[tuple[int, str | None]]):
        number: dict[str, int] = {}
        words, sizes, doc_of, toxic, until = array("q"), array("q"), array("q"), [], [0]
        for i, (label, text) in enumerate(docs):
            toxic.append(label)
            for s in SENTENCE.findall(text or ""):
                found = set(WORD.findall(s.lower()))
                if found:
                    words.extend(sorted([number.setdefault(w, len(number)) for w in found]))
                    sizes.append(len(found))
                    doc_of.append(i)
            until.append(len(words))
        self.toxic, self.n_words = np.array(toxic, float), len(number)
        self.doc_of, words = np.frombuffer(doc_of, np.int64), np.frombuffer(words, np.int64)
        own, count = array("i"), array("q")
        for w in number:
            f = features(w)
            own.extend(f)
            count.append(len(f))
        del number
        buckets, count = np.frombuffer(own, np.int32), np.frombuffer(count, np.int64)
        self.held = np.flatnonzero(_documents(words, until, buckets, count) >= LEAST_DOCS)
        place = np.full(BUCKETS, -1, np.int32)
        place[self.held] = np.arange(len(self.held))
        use = place[buckets] >= 0
        self.of_word, self.feature = np.repeat(np.arange(self.n_words), count)[use], place[buckets[use]].astype(np.int64)
        known = (np.bincount(self.of_word, minlength=self.n_words) > 0)[words] if len(words) else np.zeros(0, bool)
        self.words, self.sentence_of = words[known], np.repeat(np.arange(len(sizes)), np.frombuffer(sizes, np.int64))[known]
        self.weight = np.where(self.toxic == 1, 1 / max(1.0, self.toxic.sum()), 1 / max(1.0, (1 - self.toxic).sum()))
        self.weight /= max(1e-300, self.weight.sum())

    def keep(self, chosen: np.ndarray) -> None:
        """Forgets all other features, and the words that have none."""
        use = chosen[self.feature]
        self.of_word, self.feature, self.held = self.of_word[use], (np.cumsum(chosen) - 1)[self.feature[use]], self.held[chosen]
        known = (np.bincount(self.of_word, minlength=self.n_words) > 0)[self.words]
        self.words, self.sentence_of = self.words[known], self.sentence_of[known]

    def loss_and_slope(self, w: np.ndarray, bias: float) -> tuple[float, np.ndarray]:
        """Weighted negative log likelihood of the labels, and its slope by each weight and the bias (last)."""
        n, m = len(self.doc_of), len(self.toxic)
        by_word = np.bincount(self.of_word, w[self.feature], self.n_words)
        s = bias + np.bincount(self.sentence_of, by_word[self.words], n)
        p = np.clip(1 / (1 + np.exp(-np.clip(s, -30, 30))), 1e-12, 1 - 1e-9)
        none = np.exp(np.bincount(self.doc_of, np.log1p(-p), m))
        some = np.maximum(1 - none, 1e-12)
        loss = -np.where(self.toxic == 1, np.log(some), np.log(none)) @ self.weight
        slope = np.where(self.toxic == 1, -none / some, 1.0) * self.weight
        at = slope[self.doc_of] * p
        each = np.bincount(self.words, at[self.sentence_of], self.n_words)
        return float(loss), np.append(np.bincount(self.feature, each[self.of_word], len(self.held)), at.sum())


def _documents(words: np.ndarray, until: list[int], buckets: np.ndarray, count: np.ndarray) -> np.ndarray:
    """How many documents each feature occurs in; document by document, so that memory follows one document."""
    first, out = np.cumsum(count) - count, np.zeros(BUCKETS, np.int32)
    for i, j in zip(until[:-1], until[1:], strict=True):
        own = np.unique(words[i:j])
        n = count[own]
        out[np.unique(buckets[np.repeat(first[own] - np.cumsum(n) + n, n) + np.arange(n.sum())])] += 1
    return out


def fit(docs: Iterable[tuple[int, str | None]]) -> Model:
    """Weights that maximise the likelihood of document labels under the noisy-or."""
    bags = Bags(docs)
    if not len(bags.doc_of) or bags.toxic.min() == bags.toxic.max():
        return Model(-math.inf, {})
    w, bias = np.zeros(len(bags.held)), -5.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, 2 * PASSES + 1):
        if step == PASSES + 1:  # chosen features are fitted again, almost without shrinkage
            chosen = np.abs(w) > LEAST_WEIGHT
            bags.keep(chosen)
            w, m, v = w[chosen], m[np.append(chosen, True)], v[np.append(chosen, True)]
        shrink = SHRINK if step <= PASSES else SHRINK / 10
        _, g = bags.loss_and_slope(w, bias)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        rate = STEP / (np.sqrt(v / (1 - 0.999**step)) + 1e-4)
        move = rate * m / (1 - 0.9**step)
        w, bias = w - move[:-1], bias - move[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - rate[:-1] * shrink, 0)  # chance features of few documents stay at 0
    return Model(float(bias), {int(b): float(x) for b, x in zip(bags.held, w, strict=True) if abs(x) > 1e-3})


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None) -> Model:
    rows = sample(docs, labels, usable).toArrow().sort_by([("toxic", "ascending"), ("id", "ascending"), ("text", "ascending")])  # at most 2 * SAMPLE documents of SAMPLE_BYTES in all
    model = fit(zip(rows["toxic"].to_pylist(), (x.as_py() for x in rows["text"]), strict=True))
    del rows
    give_back()
    return model


class Scorer:
    """Score and offending sentences of one text after another."""

    def __init__(self, model: Model):
        self.bias, self.weights = model.bias, model.scorer()

    def __call__(self, text: str | None) -> tuple[float, list[dict]]:
        none, where, get = 0.0, [], self.weights.__getitem__
        if text and self.bias > -math.inf:
            for m in SENTENCE.finditer(text):
                found = set(WORD.findall(m[0].lower()))
                if found:
                    s = self.bias + sum(map(get, found))
                    p = 1 / (1 + math.exp(-min(30.0, max(-30.0, s))))
                    none += math.log1p(-p)
                    if p >= OFFENDING:
                        where.append({"start": m.start(), "end": m.end(), "score": p})
        return 1 - math.exp(none), where


@lean
def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    scored = Scorer(model)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    for b in batches:
        scores, located = zip(*map(scored, b.column(b.num_columns - 1).to_pylist()), strict=True) if b.num_rows else ((), ())
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:-1], pa.array(scores, pa.float64()), pa.array(located, kind)], names=[*b.schema.names[:-1], "score", "offending"]
        )


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, score and the offending sentences (start, end, score; code points, end exclusive)."""
    small_batches(docs.sparkSession)
    given = docs.select(*keep, "text")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields[:-1])
    return given.mapInArrow(functools.partial(_score, model=model), f"{types}, score double, offending array<struct<start:int,end:int,score:double>>")


def _clean(texts: Iterator[list[str | None]], model: Model, at: float) -> Iterator[list[bool]]:
    scored = Scorer(model)
    for part in texts:
        yield [scored(x)[0] < at for x in part]


def drop_toxic(docs: DataFrame, model: Model, at: float = 0.7) -> DataFrame:
    """Documents whose score is below ``at``, with all their columns."""
    return filtered(docs, functools.partial(_clean, model=model, at=at))
