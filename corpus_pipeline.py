"""From raw documents to token ids: five stages, each written and read again.

Quality rules drop the documents that they reject; near-duplicate detection keeps one document of
each group; personal data is masked; sources are mixed to their target weights, a document coming
back as often as the mix takes it; what is left is encoded and checked by decoding.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and returns
the columns of documents; the last returns ids instead.

Defined results: a null or empty text has too few words and goes with the first stage; of rows that share
an id or are equal, or have null ids, one of each near-duplicate group stays, the one with the smallest
id, null last, ties by a hash of the row; ids and sources may be null after that; columns beyond those
of documents pass through the first four stages; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.llm import bpe, mixing, pii, quality, simhash
from pulse.llm.common import read_table
from pulse.llm.queries import PATTERN, TOKENIZER
from pulse.session import bound_batches, scratch_path
from pulse.sinks.paths import remove_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines that the rules remove."""
    bound_batches(spark)
    judged = quality.quality_rules(docs).where("kept")
    text = F.when(F.col("lost_words") > 0, F.col("clean_text")).otherwise(F.col("text"))
    cleaned = {"text": text, "n_chars": F.length(text).cast("bigint")}
    # Verdict columns have names of their own; a column of the documents with such a name is theirs.
    own = docs.select([c for c in docs.columns if c not in quality.FIELDS]).columns
    return judged.select(*(cleaned.get(c, F.col(f"`{c}`")).alias(c) for c in own))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest id."""
    bound_batches(spark)
    return simhash.drop_near_duplicates(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and their length put right."""
    return pii.mask_pii(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's share takes it; not at all if it doesn't."""
    kept = [c for c in docs.columns if c not in mixing.ADDED]
    return mixing.emit_copies(mixing.mix_sources(docs), kept)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed token ids of every row; `exact` tells whether decoding gives the text back."""
    bound_batches(spark)
    decoded = bpe.decode(bpe.encode(docs, TOKENIZER, PATTERN), TOKENIZER, PATTERN)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return decoded.select(
        "doc_id",
        "source",
        bpe.n_tokens(F.col("ids")).alias("n_tokens"),
        "ids",
        (F.col("decoded") == text).alias("exact"),
    )


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("pii", pii_stage),
    ("mix", mix_stage),
    ("encode", encode_stage),
]

# Word shingles hashed to fingerprints, and merges of byte pairs, are not SQL: the stages are tested
# against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what lies between them goes to the shared folder, and from there
    as soon as the next stage is written."""
    docs, last = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if last:
            remove_path(spark, last)
        last = path
    return docs
