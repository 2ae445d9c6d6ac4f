import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import bpe

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None, "", " ", "Hello World's end, isn't it? 123", "a" * 3000, "ÀÉÎ straße İstanbul ΣΑΣ", "tab\there\r\nnew\x0bline\x1cx",
    "x<|endoftext|>y <|startoftext|>", "日本語のテキスト 한국어 école", " nbsp em", "!!!???...###", "hello hello Hello HELLO", "aaaa aaab aaaaab abab",
]


def expected(texts):
    lib = tokenizers.Tokenizer.from_file(PATH)
    lib.no_truncation(), lib.no_padding()
    ids = [lib.encode(x or "", add_special_tokens=False).ids for x in texts]
    return ids, [lib.decode(i, skip_special_tokens=False) for i in ids]


def random_texts(n=300):
    rng = random.Random(5)
    return ["".join(rng.choice("abeéthingrs ETHIN'-19.ß") for _ in range(rng.randint(1, 120))) for _ in range(n)]


def test_matches_the_library():
    texts = TEXTS[1:] + random_texts()
    ids, decoded = bpe.Encoder(PATH).run(texts)
    want, back = expected(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == want
    assert decoded == back


def test_every_vocabulary_token_alone():
    coder = bpe.Encoder(PATH)
    words = sorted(coder.merges.last)
    want = expected(words)[0]
    coded = coder.run(words)[0]
    assert [np.frombuffer(x, "<u4").tolist() for x in coded] == want


def test_query_digests(spark):
    rows = [(i, x, "en") for i, x in enumerate(TEXTS)] + [(3, TEXTS[3], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").drop("ids").withColumnRenamed("text", "text")
    got = sorted(tuple(r) for r in bpe.digests(bpe.encode_decode(docs, PATH)).collect())
    ids, decoded = expected([r[1] for r in rows])
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert got == sorted((r[0], len(i), sha(np.array(i, "<u4").tobytes()), sha(d.encode())) for r, i, d in zip(rows, ids, decoded))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(bpe.encode_decode(docs, PATH)).count() == 0
