import itertools
import random

from tidemark.llm import decontamination as D


def brute(doc, item):
    """Longest stretch on any diagonal with four fifths equal tokens and enough of them."""
    a, b = D.WORD.findall((doc or "").lower()), D.WORD.findall((item or "").lower())
    n = len(b)
    if n < 5:
        return False
    for shift in range(-n + 1, len(a)):
        same = [0 <= shift + j < len(a) and a[shift + j] == b[j] for j in range(n)]
        if n < 8:
            if all(same) and len(same) == n:
                return True
            continue
        need = min(13, -(-4 * n // 5))
        for i in range(n):
            for j in range(i + need, n + 1):
                if sum(same[i:j]) >= need and 5 * sum(same[i:j]) >= 4 * (j - i):
                    return True
    return False


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(3000)]
    items = [" ".join(rng.choices(words, k=n)) for n in (3, 5, 7, 8, 12, 14, 20, 30, 40, 40, 60)]
    docs = [None, "", "word1 word2"]
    for k in range(60):
        item = rng.choice(items).split()
        i = rng.randrange(max(1, len(item) - 20))
        part = item[i : i + rng.randint(6, 30)] if k % 2 else item
        part = [rng.choice(words) if rng.random() < 0.12 * (k % 3) else w for w in part]
        text = rng.choices(words, k=rng.randint(0, 60)) + part + rng.choices(words, k=rng.randint(0, 60))
        docs.append(" ".join(text).upper() if k % 5 == 0 else ", ".join(text))
    docs.append(" ".join(rng.choices(words, k=20000)) + " " + items[7])
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(docs)], "doc_id long, text string, hits int, row string")
    return d, spark.createDataFrame([*enumerate(items)], "item_id long, text string")


def test_against_brute_force(spark):
    docs, items = corpus()
    d, b = frames(spark, docs, [*items, None, items[5]])
    got = {r["doc_id"]: r for r in D.contaminated(d, b).collect()}
    for i, doc in enumerate(docs[:-1]):
        want = [k for k, it in enumerate([*items, None, items[5]]) if brute(doc, it)]
        assert set(got[i]["items"]) == set(want), (i, want)
    assert got[len(docs) - 1]["items"] == [7]
    assert not got[0]["contaminated"] and not got[1]["contaminated"]


def test_two_substitutions_in_thirteen_are_always_found(spark):
    rng = random.Random(2)
    item = [f"q{i}" for i in range(13)] + [f"z{i}" for i in range(4)]
    docs = []
    for i in range(13):
        for j in range(i):
            part = list(item)
            part[i] = part[j] = "other"
            docs.append(" ".join(rng.choices("abcdef", k=5) + part))
    d, b = frames(spark, docs, [" ".join(item)])
    assert D.contaminated(d, b).where("contaminated").count() == len(docs)


def test_masks_leave_no_allowed_pattern_out():
    for n, k in ((8, 1), (9, 1), (10, 2), (11, 2), (12, 2), (13, 2), (14, 2)):
        for subs in itertools.combinations(range(n), k):
            assert any(
                all(c == "0" or i + j not in subs for j, c in enumerate(m)) for m in D.MASKS for i in range(n - len(m) + 1)
            ), (n, subs)


def test_many_blocks_and_dropping(spark, monkeypatch):
    docs, items = corpus(4)
    d, b = frames(spark, docs, items)
    want = sorted((r["doc_id"], r["items"]) for r in D.contaminated(d, b).collect())
    monkeypatch.setattr(D, "BLOCK_BYTES", 300)
    assert sorted((r["doc_id"], r["items"]) for r in D.contaminated(d, b).collect()) == want
    kept = D.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, x in want if not x]


def test_empty_tables(spark):
    d, b = frames(spark, [], [])
    assert D.contaminated(d, b).count() == 0
    d, _ = frames(spark, ["a b c d e f g h"], [])
    assert not D.contaminated(d, b).first()["contaminated"]
