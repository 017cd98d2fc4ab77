"""Mixing sources to target sizes by systematic sampling.

Sources, ordered by code point with null last, weigh 1, 2, 3, 1, ... and share the total size in
proportion to their weights. A source's target stops at `max_copies` times its size; what it
can't take is shared again by weight until no target is above its stop. Every document of a source
expects target / size copies. Documents stand in order of size, then of a hash of their id, then
of the id; the running sum of their expected copies, moved by one random offset per source, gives
a copy for every integer boundary it crosses. As the order is by size, the words taken differ
from the target by no more than about the longest document.

The running sum is position times rate. Documents are counted by source, size and a bucket of their id's
hash; the counts, dealt by range of that order, are summed up in slices, so that a large source or a
size that many documents share is numbered by many tasks. Rows are then numbered within a bucket. Sources
are ranked, and stops summed up, in slices as well.

Only DataFrame functions are used. The offset comes from a hash of the seed and the source, so
reruns agree.

Defined results: a null text has size 0 and is taken at its source's rate, which adds no words; a
source without words has target 0 and gives no copies; a null source is a source of its own; of
repeated rows each is a document; documents that share an id and a size stand in the order of a hash of
the whole row, so that only rows equal in every column are interchangeable; no rows give no rows. Other
columns pass through whatever their names; those with the name of an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.common import WORD, free_name, row_hash, stored, sums_before, text_or_empty

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
BUCKET_DIGITS = 3
SEED = "mix"
ADDED = ["size", "source_size", "target", "copies", "taken"]


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def source_targets(sources: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """From (missing, name, source_size, rows), one row per source: target, rate of copies, and the
    documents of the sources before it.

    A source stops if its share would pass `max_copies` times its size. Ordered by stop per
    weight, the stopped sources come first, so the level that the others reach is the first one
    that does not pass the next source's stop."""
    by_name = ["missing", "name"]
    ranked = sums_before(
        sources, by_name, {"place": F.lit(1).cast("bigint"), "rows_before": F.col("rows")}
    )
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int") + 1
    )
    weighed = (
        ranked.withColumn("weight", weight.cast("bigint"))
        .withColumn("stop", F.col("source_size") * max_copies)
        .withColumn("ratio", F.col("stop").cast("double") / F.col("weight"))
    )
    summed = sums_before(
        weighed, ["ratio", *by_name], {"stops": F.col("stop"), "weights": F.col("weight")}
    )
    summed = stored(summed)
    size, total = summed.agg(F.sum("source_size"), F.sum("weight")).first()
    left = (F.lit(size) - F.col("stops")).cast("double") / (F.lit(total) - F.col("weights"))
    reached = summed.withColumn("level", left).where("level <= ratio")
    level = reached.agg(F.min_by("level", F.struct("ratio", *by_name))).first()[0]
    target = F.least(F.lit(level).cast("double") * F.col("weight"), F.col("stop").cast("double"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        summed.withColumn("target", target)
        .withColumn("rate", F.least(rate, F.lit(float(max_copies))))
        .select(*by_name, "source_size", "target", "rate", "rows_before")
    )


def source_offset(missing: Column, name: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the source alone."""
    digest = F.md5(F.concat(F.lit(seed), missing.cast("string"), name))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def mix_sources(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights=WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """Adds size, source_size, target, copies and taken to every row."""
    names = ["missing", "name", "bucket", "tie", "place", "start", "rate"]
    missing, name, bucket, tie, place, start, rate = (free_name(docs, n, *ADDED) for n in names)
    kept = [c for c in docs.columns if c not in ADDED]
    digits = F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, BUCKET_DIGITS)
    sized = docs.select(
        *(F.col(f"`{c}`") for c in kept),
        F.col(source).isNull().cast("int").alias(missing),
        F.coalesce(F.col(source), F.lit("")).alias(name),
        word_count(text_or_empty(text)).alias("size"),
        digits.alias(bucket),
        row_hash(docs).alias(tie),
    )
    keys = [missing, name, "size", bucket]
    buckets = stored(
        sized.groupBy(*(F.col(k).alias(n) for k, n in zip(keys, ("missing", "name", "size", "bucket"), strict=True)))
        .agg(F.count("*").alias("rows"))
    )
    sources = buckets.groupBy("missing", "name").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("rows")
    )
    targets = source_targets(sources, weights, max_copies)
    order = ["missing", "name", "size", "bucket"]
    starts = (
        sums_before(buckets, order, {"before": F.col("rows")})
        .join(targets, ["missing", "name"])
        .select(
            F.col("missing").alias(missing),
            F.col("name").alias(name),
            "size",
            F.col("bucket").alias(bucket),
            (F.col("before") - F.col("rows_before")).alias(start),
            F.col("rate").alias(rate),
            "source_size",
            "target",
        )
    )
    numbered = sized.withColumn(
        place, F.row_number().over(Window.partitionBy(*keys).orderBy(doc_id, tie))
    )
    position = F.col(start) + F.col(place)
    offset = source_offset(F.col(missing), F.col(name), seed)

    def passed(documents: Column) -> Column:
        return F.floor(documents * F.col(rate) + offset)

    return (
        numbered.join(starts, keys)
        .withColumn("copies", (passed(position) - passed(position - 1)).cast("bigint"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select(*(F.col(f"`{c}`") for c in kept), *ADDED)
    )


def emit_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Every row as often as the mix takes it."""
    copy = free_name(mixed, "copy")
    copies = F.when(F.col("copies") > 0, F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return mixed.select(*(F.col(f"`{c}`") for c in columns), F.explode(copies).alias(copy)).drop(copy)
