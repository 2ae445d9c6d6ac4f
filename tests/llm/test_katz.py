import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tidemark.llm import katz

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return [w.translate(katz.LOWER) for w in WORD.findall((text or "").encode())] + ["</end>"]


def brute(train, texts):
    """The model by dictionaries; also every probability of every context, to check the sums."""
    uni, bi, ctx = Counter(), Counter(), Counter()
    for t in train:
        last = "<begin>"
        for w in words(t):
            uni[w] += 1
            bi[last, w] += 1
            ctx[last] += 1
            last = w
    n, v = sum(uni.values()), len(uni)
    d1, d2 = (katz.discounts(Counter(c.values())) for c in (uni, bi))
    disc = lambda d, r: d[r] * r if r <= katz.K else float(r)
    p = {w: disc(d1, c) / n for w, c in uni.items()}
    left, least = 1 - sum(p.values()), 1 / (n + v + 1)
    if left < least:
        p = {w: x * (1 - least) / (1 - left) for w, x in p.items()}
    unknown = max(left, least)
    by = defaultdict(dict)
    for (h, w), r in bi.items():
        if r >= katz.LEAST_COUNT:
            by[h][w] = disc(d2, r)

    def prob(h, w):
        own = p.get(w, unknown)
        if h not in ctx:
            return own
        seen = by.get(h, {})
        share = min(sum(seen.values()) / ctx[h], ctx[h] / (ctx[h] + 1))
        if w in seen:
            return seen[w] * share / sum(seen.values())
        return own * (1 - share) / (1 - sum(p[x] for x in seen))

    for h in list(ctx)[:30]:
        assert abs(sum(prob(h, w) for w in uni) + prob(h, "<never seen>") - 1) < 1e-9
    out = []
    for t in texts:
        s, b, last = 0.0, 0.0, "<begin>"
        for w in words(t):
            s += math.log10(prob(last, w))
            b += math.log10((uni[w] + 1) / (n + v + 1))
            last = w
        out.append((len(words(t)), sum(uni[w] > 0 for w in words(t)), b, s))
    return n, out


def corpus(n=120, seed=1):
    rng = random.Random(seed)
    vocab = ["the", "of", "a", *(f"W{i}" for i in range(60)), "élan", "x\x1cy"]
    weights = [30, 20, 10, *(1 + 60 / (i + 1) for i in range(60)), 2, 2]
    return [None, "", " \t\n", *(rng.choice([" ", "\n", "  "]).join(rng.choices(vocab, weights, k=rng.randint(1, 60))) for _ in range(n)), "the of " * 4000]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, 7, "z") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int, score string").repartition(3)


@pytest.mark.parametrize("limits", [(200_000, 4_000_000, 24 << 20), (40, 900, 3000)])
def test_against_dictionaries(spark, monkeypatch, limits):
    monkeypatch.setattr(katz, "LEAST_HOT", limits[0])
    monkeypatch.setattr(katz, "BUCKET_TOKENS", limits[1])
    monkeypatch.setattr(katz, "PACK_BYTES", limits[2])
    texts = corpus()
    train = [t for i, t in enumerate(texts) if i % 7 != 2]
    d = frame(spark, texts)
    model = katz.train(d.where("doc_id % 7 <> 2"))
    got = {r["doc_id"]: r for r in katz.score(d, model).collect()}
    n, want = brute(train, texts)
    assert model.numbers["n"] == n and len(got) == len(texts)
    for i, (size, known, base, score) in enumerate(want):
        assert (got[i]["n_tokens"], got[i]["n_known"]) == (size, known)
        assert got[i]["base_score"] == pytest.approx(base, rel=1e-9)
        assert got[i]["score"] == pytest.approx(score, rel=1e-9)
    assert sum(w[3] for w in want) > sum(w[2] for w in want)


def test_nothing_to_learn_from(spark):
    d = frame(spark, ["a b", None])
    got = {r["doc_id"]: r for r in katz.score(d, katz.train(d.limit(0))).collect()}
    assert (got[0]["n_tokens"], got[0]["n_known"], got[0]["score"]) == (3, 0, 0.0)
    assert katz.score(d.limit(0), katz.train(d)).count() == 0


def test_pairs_seen_once_are_in_the_model(spark):
    texts = ["a b", "a c", "d b", "a b"]
    model = katz.train(frame(spark, texts))
    ids = katz._Ids()
    held = {(r["h"], r["w"]): r["r"] for r in model.seen().collect()}
    signed = lambda w: ids[w] - (1 << 64) if ids[w] >> 63 else ids[w]
    a, b, c, d = map(signed, (b"a", b"b", b"c", b"d"))
    once = {(a, c), (d, b), (c, katz.END), (katz.BEGIN, d)}
    assert {k for k, n in held.items() if n == 1} == once
    assert {k for k, n in held.items() if n > 1} == {(katz.BEGIN, a), (a, b), (b, katz.END)}


def test_lookups_and_orders_hold_few_arrays():
    """A pack's tokens are looked up and sorted beside few copies of themselves."""
    import tracemalloc

    import numpy as np

    h, w = np.random.default_rng(1).integers(0, 1 << 63, (2, 1_000_000), dtype=np.uint64)
    known = np.sort(h[:50_000])
    with np.errstate(over="ignore"):
        for f, most in ((lambda: katz.found_in(known, h), 1.3), (lambda: katz.mixed(h, w), 2.2), (lambda: katz._by_context(h, w, w), 3.2)):
            tracemalloc.start()
            f()
            peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            assert peak < most * h.nbytes
    at = katz.found_in(known, h)
    assert (known[at[:50_000]] == h[:50_000]).all() and (at[50_000:] == -1).all()


def test_stored_pairs_need_no_codec(spark):
    """A codec would hold copies of whole buckets beside the heap."""
    import pyarrow.parquet as pq

    docs = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    model = katz.train(docs)
    for f in model.pairs.inputFiles():
        meta = pq.ParquetFile(f.removeprefix("file://")).metadata
        assert {meta.row_group(0).column(i).compression for i in range(meta.num_columns)} == {"UNCOMPRESSED"}
    assert model.seen().count() == 8
