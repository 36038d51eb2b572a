"""The registered queries of this subpackage, and their SQL where SQL can state the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from issuelab.llm import bpe, chat, conv_trie, nearest, ngram_join, packing, pii, quality, secret_scan, sharding
from issuelab.llm import toxicity, warc, whitening
from issuelab.llm.common import read_table
from issuelab.llm.quality_sql import quality_sql
from issuelab.llm.spans import count_kind, listed
from issuelab.session import stage


def _span_digests(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    return found.select(
        "doc_id",
        *[count_kind(F.col("base"), kind).alias(f"n_{kind}") for kind in kinds],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    back = bpe.decoded(bpe.encoded(docs, path, public_tokenizers.PATTERN), path)
    return back.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return _span_digests(pii.with_spans(docs), pii.KINDS)


#: Fixed value: what both turns of conversation -7 say.
CONTROL = "</s>[INST] ok [/INST]"


def op3_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = spark.createDataFrame([(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], tables.schema)
    back = chat.read_back(chat.build_tree(tables.unionByName(fixed)))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return _span_digests(secret_scan.with_spans(docs), secret_scan.KINDS)


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.with_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Bytes of text in a shard of ``op7_sharding``.
SHARD_BYTES = 1 << 20


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign(docs, "doc_id", "text", SHARD_BYTES).drop("text")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoder = packing.word_tokens(public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(read_table(spark, sf_dir, "documents"), encoder).drop("ids")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.drop("text")


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conv_trie.turn_rows(read_table(spark, sf_dir, "conversations"))
    return conv_trie.trie(conv_trie.rebuilt(stage(turns, "turns")))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    done = whitening.transform(vectors, whitening.fit(vectors))
    return done.withColumn("deviation", whitening.as_long(F.col("deviation")))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(read_table(spark, sf_dir, "pages"))
    back = warc.read_records(warc.read_chunks(manifest, with_payload=False))
    number = lambda c: F.col(c).cast("bigint").alias(c)
    back = back.withColumnRenamed("page", "page_id")
    return back.select(number("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to"))


QUERIES = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_pii": op2_pii,
    "op3_chat_tree": op3_chat_tree,
    "op4_secret_scan": op4_secret_scan,
    "op5_nearest": op5_nearest,
    "op6_ngram_join": op6_ngram_join,
    "op7_sharding": op7_sharding,
    "op8_packing": op8_packing,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_warc": op13_warc,
}

SQL = {
    "op3_chat_tree": chat.chat_sql(f"(-7, 0, 'user', '{CONTROL}'), (-7, 1, 'assistant', '{CONTROL}')"),
    "op7_sharding": sharding.sharding_sql(SHARD_BYTES),
    "op10_quality_rules": quality_sql(),
    "op11_conversation_trie": conv_trie.trie_sql(),
    "op13_warc": warc.warc_sql(),
}
