"""One query per operator over the driver's tables, and the SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm import (
    ann,
    bpe,
    chat,
    divergence,
    html,
    licenses,
    lm,
    mixing,
    negatives,
    pii,
    quality,
    simhash,
    urls,
)
from pulse.llm.common import read_table
from pulse.llm.sql import ORACLES

TOKENIZER = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(read_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = urls.filter_urls(pages, rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op3_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = lm.train(docs.where(~lm.held_out(F.col("doc_id"))))
    return lm.score(docs, model)


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    extracted = html.extract_text(pages, html.train(pages))
    return extracted.select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars")
    )


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).select("doc_id", "digest", "license_id")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("spans")

    def count(kind: str):
        return F.size(F.filter(spans, lambda span: span["kind"] == kind)).cast("bigint")

    base = F.filter(spans, lambda span: span["kind"].isin(pii.BASE_KINDS))
    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
        pii.spans_text(spans).alias("spans"),
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.decode(bpe.encode(docs, TOKENIZER, PATTERN), TOKENIZER, PATTERN)
    return decoded.select(
        "doc_id",
        bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.search(vectors, F.col("vec_id") % 50 == 0, k=5)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read_table(spark, sf_dir, "embeddings").withColumn("label", shifted)
    return negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    planted = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    table = read_table(spark, sf_dir, "conversations").select(*columns)
    examples = chat.format_chats(table.unionByName(planted))
    lines = F.transform(
        chat.read_turns(F.col("text")), lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n"))
    )
    read = examples.select(
        "conv_id",
        "n_turns",
        chat.loss_text().alias("reply"),
        F.when(F.col("whole"), lines).alias("lines"),
        F.length("text").alias("chars"),
    ).withColumn("turns", F.when(F.col("lines").isNotNull(), F.struct(F.size("lines"), F.sha2(F.array_join("lines", ""), 256))))
    replies = F.array_sort(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("n_turns", "reply"))))
    joined = F.array_join(F.transform("replies", lambda one: one["reply"]), "")
    grouped = read.groupBy("conv_id").agg(
        F.max("turns").alias("turns"), replies.alias("replies"), F.sum("chars").alias("formatted_chars")
    )
    return grouped.withColumn("loss", joined).select(
        "conv_id",
        F.col("turns.col1").cast("bigint").alias("n_turns"),
        F.col("turns.col2").alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_url_filters": op2_url_filters,
    "op3_class_lm": op3_class_lm,
    "op4_html_text": op4_html_text,
    "op5_licenses": op5_licenses,
    "op6_pii": op6_pii,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_nearest": op8_nearest,
    "op9_simhash": op9_simhash,
    "op10_quality": op10_quality,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_chat_format": op12_chat_format,
    "op13_source_divergence": op13_source_divergence,
    "pipeline": pipeline,
}

__all__ = ["ORACLES", "QUERIES"]
