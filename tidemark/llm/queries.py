"""Queries over the driver's tables: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontamination, hnsw, katz, orderhash, recompression, resharding, secrets, suffixes, toxicity
from tidemark.llm.common import crc_mod, table

#: Strings of 200 bytes that start in two places, by their digests; runs of what they cover; the bytes between the runs.
OP3_SQL = r"""
with texts as (
  select row_number() over () as line, doc_id, encode(coalesce(text, '')) as body from documents
), starts as (
  select line, body, unnest(range(0, octet_length(body) - 199)) as pos from texts
), strings as materialized (
  select line, pos, md5(body[pos + 1:pos + 200]) as digest from starts
), gone as (
  select line, pos from strings join (select digest from strings group by digest having count(*) > 1) using (digest)
), steps as (
  select line, pos, coalesce(pos > lag(pos) over (partition by line order by pos) + 200, true) as first from gone
), numbered as (
  select line, pos, sum(first::int) over (partition by line order by pos) as span from steps
), spans as (
  select line, span, min(pos) as a, max(pos) + 200 as z from numbered group by line, span
), between_spans as (
  select line, a, z, coalesce(lag(z) over (partition by line order by a), 0) as before from spans
), told as (
  select line, count(*) as n_spans, sum(z - a) as n_removed, max(z) as last,
    string_agg(hex(body[before + 1:a]), '' order by a) as kept
  from between_spans join texts using (line) group by line
)
select doc_id, (octet_length(body))::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(case when told.line is null then body else unhex(kept || hex(body[last + 1:])) end) as kept_sha256
from texts left join told using (line)
"""
#: Windows of 50 words whose sequence begins in a document of smaller id, by their digests; the words that none of them covers.
OP5_SQL = r"""
with texts as (
  select row_number() over () as line, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), starts as (
  select line, doc_id, words, unnest(range(1, len(words) - 48)) as pos from texts
), windows as materialized (
  select line, doc_id, pos, md5(array_to_string(words[pos:pos + 49], ' ')) as digest from starts
), firsts as (
  select digest, min(doc_id) as least from windows group by digest
), gone as (
  select line, pos from windows join firsts using (digest) where least < doc_id
), places as (
  select line, unnest(words) as word, unnest(range(1, len(words) + 1)) as pos from texts
), marked as (
  select line, pos, word, max(gone.pos is not null) over (partition by line order by pos rows between 49 preceding and current row) as covered
  from places left join gone using (line, pos)
), told as (
  select line, count(*) as n_words, count_if(covered) as n_removed, string_agg(word, ' ' order by pos) filter (where not covered) as kept from marked group by line
)
select doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from texts left join told using (line)
"""

ORACLE_SQL: dict[str, str] = {"op3_deep_shallow": OP3_SQL, "op5_recompression": OP5_SQL}


def op8_mil_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), crc_mod("id", 3) != 1)
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(crc_mod("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )


def op9_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return hnsw.nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0"))


def op10_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = resharding.reshard(table(spark, sf_dir, "documents"), n_new=8, n_old=6)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard"
    )


def op1_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod("doc_id", 7) == 2, F.lit(False))
    model = katz.train(docs.where(~held_out))
    return katz.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", F.lit(model.numbers["n"]).cast("long").alias("train_tokens"), "base_score", "score"
    )


def op2_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_deep_shallow(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.drop_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op5_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = recompression.drop_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op7_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.digests(bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_katz_backoff, op2_spaced_seeds, op3_deep_shallow, op4_markov_secrets, op5_recompression, op6_order_minhash, op7_trie_bpe, op8_mil_toxicity, op9_hnsw, op10_flow_resharding)
}
