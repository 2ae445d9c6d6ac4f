"""Filters a corpus stage by stage; each stage's table is written and read again by the next.

Toxic documents go; of near-duplicate classes one document stays; documents that quote benchmark
items go; secrets are blotted out of the texts; what is left is encoded.

Defined results: documents with null or empty texts are never toxic or contaminated, are duplicates of
each other, and have no tokens; texts of any length are treated whole; of repeated rows and of equal
texts one row stays; documents without id are left out of the toxicity fit only; an empty table passes
every stage as an empty table; further columns pass through all stages, and where one is named like a
column that the last stage adds, the added one's name ends in underscores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontamination, orderhash, secrets, toxicity
from tidemark.llm.common import crc_mod, free_name, stored, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), crc_mod("id", 3) != 1)
    return toxicity.drop_toxic(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return orderhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs, secrets.train(secrets.samples(docs)))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    kept = tuple(c for c in docs.columns if c != "text")
    ids, decoded, n_tokens, digest = (free_name(docs.select(*kept), c) for c in ("ids", "decoded", "n_tokens", "ids_sha256"))
    coded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"), kept)
    return coded.select(*kept, (F.octet_length(ids) / 4).cast("long").alias(n_tokens), F.sha2(ids, 256).alias(digest), ids, decoded)


STAGES = [
    ("toxicity", without_toxic),
    ("near-duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("encoding", encoded),
]
#: Classifiers, sketches and tokenizers aren't SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
