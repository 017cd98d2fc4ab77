"""How far sources diverge within a language, by count-cell ranking.

Terms are runs of letters and of anything beyond ASCII, lower-cased in A-Z. A language keeps the terms
of at least `min_documents` of its documents. A group is a language and a source; its share of a term,
and the language's, is an integer: 1 + floor(SCALE (count + PRIOR) / (N + PRIOR V)).

Part `term` ranks the terms that a group uses more than its language. Terms are grouped by cell, their
count in the group and in the language, and the difference is evaluated once per cell. Cells of equal
difference merge, the merged ones are ranked by cumulative multiplicity, and only those that reach the
first `top` ranks are expanded to terms, in UTF-8 order. As every value has at least one term, no more
than `top` values of a group matter, and no more than `top` terms of a value, so all orders are limited
in every task before they are shuffled.

Part `pair` gives the sum of differences over all kept terms between a group and every other group of
its language. Terms are dealt into tiles of bounded size; a tile holds a matrix of shares, terms by
sources, for two blocks of sources, and adds differences column against column. Terms that no source
of a tile uses contribute the difference of the shares of a zero count, which is added once.

Term counts are summed within every task before they are shuffled, by language, source and term.

Defined results: null texts, languages and sources are empty strings; a group without kept terms has
pairs but no terms; a language without kept terms has pairs of value zero; repeated rows count each
by itself; no rows give no rows; other columns are not read. Counts are exact up to the range of a long.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.common import stored, text_or_empty

MIN_DOCUMENTS = 30
TOP = 50
PRIOR = 5
SCALE = 1_000_000_000
FLUSH_TERMS = 200_000
FLUSH_BYTES = 1 << 26
CHUNK_BYTES = 1 << 20
ROWS_AT_ONCE = 256
BLOCK_SOURCES = 1024
CHUNK_CELLS = 1 << 18
# A byte's term character, or a blank where it ends a term.
TERM_BYTES = bytes(
    byte if byte >= 0x80 or chr(byte).islower() else ord(chr(byte).lower()) if chr(byte).isupper() else 0x20
    for byte in range(256)
)


def term_chunks(text: str):
    """The terms of a text, a stretch of it at a time."""
    data = text.encode().translate(TERM_BYTES)
    start = 0
    while start < len(data):
        stop = data.find(b" ", start + CHUNK_BYTES)
        stop = len(data) if stop < 0 else stop
        yield data[start:stop].split()
        start = stop


class TermCounts:
    """Occurrences and documents of terms by group, until they are flushed."""

    SCHEMA = pa.schema([
        ("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
        ("n", pa.int64()), ("documents", pa.int64()),
    ])

    def __init__(self):
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.terms = self.bytes = 0

    def add(self, group: tuple[str, str], text: str) -> None:
        occurrences, documents = self.groups.setdefault(group, (Counter(), Counter()))
        known, seen = len(occurrences), set()
        for terms in term_chunks(text):
            occurrences.update(terms)
            seen.update(terms)
        documents.update(seen)
        self.terms += len(occurrences) - known
        self.bytes += sum(map(len, seen))

    def full(self) -> bool:
        return self.terms > FLUSH_TERMS or self.bytes > FLUSH_BYTES

    def flush(self):
        """One batch a group; its first row, an empty term, says that the group occurs."""
        for (lang, source), (occurrences, documents) in self.groups.items():
            terms = [b"", *occurrences]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(terms), pa.string()),
                pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array([0, *occurrences.values()], pa.int64()),
                pa.array([0, *map(documents.__getitem__, occurrences)], pa.int64()),
            ], schema=self.SCHEMA)
        self.groups.clear()
        self.terms = self.bytes = 0


def count_terms(batches):
    counts = TermCounts()
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(start, ROWS_AT_ONCE)
            for lang, source, text in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                counts.add((lang, source), text)
                if counts.full():
                    yield from counts.flush()
    yield from counts.flush()


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """(lang, source, term, n, documents); every group has a row with an empty term and no counts."""
    parts = docs.select(
        text_or_empty(lang).alias("lang"),
        text_or_empty(source).alias("source"),
        text_or_empty(text).alias("text"),
    ).mapInArrow(count_terms, "lang string, source string, term string, n bigint, documents bigint")
    return parts.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("documents").alias("documents")
    )


def share(count: Column, total: Column, terms: Column) -> Column:
    """A term's integer share of `total` occurrences of `terms` kept terms; null without any."""
    seen = (count + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    every = (total + PRIOR * terms).cast("decimal(20,0)")
    return F.call_function("div", seen, every) + 1


def term_part(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """The first `top` terms of every group that it uses more than its language."""
    cell = ["lang", "source", "n", "lang_n"]
    excess = share(F.col("n"), F.col("total"), F.col("terms")) - share(
        F.col("lang_n"), F.col("lang_total"), F.col("terms")
    )
    cells = (
        kept.groupBy(*cell)
        .agg(F.count("*").alias("members"))
        .join(groups, ["lang", "source"])
        .select(*cell, "members", excess.alias("value"))
        .where("value > 0")
    )
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = (
        cells.groupBy("lang", "source", "value")
        .agg(F.sum("members").alias("members"))
        .withColumn("place", F.row_number().over(group))
        .where(F.col("place") <= top)
    )
    earlier = F.sum("members").over(group.rowsBetween(Window.unboundedPreceding, -1))
    reached = (
        values.withColumn("above", F.coalesce(earlier, F.lit(0)))
        .where(F.col("above") < top)
        .select("lang", "source", "value", "above")
    )
    chosen = cells.drop("members").join(reached, ["lang", "source", "value"])
    by_term = Window.partitionBy("lang", "source", "value").orderBy("term")
    return (
        kept.join(chosen, cell)
        .withColumn("place", F.row_number().over(by_term))
        .where(F.col("place") <= top)
        .withColumn("rank", F.col("above") + F.col("place"))
        .where(F.col("rank") <= top)
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", F.col("rank").cast("int"))
    )


PAIRS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def tile_sums(shares: pa.Table, sources: pa.Table, block_sources: int) -> pa.Table:
    """Summed differences between the sources of a tile's two blocks, over its terms."""
    sources = sources.sort_by("place")
    place = sources.column("place").to_numpy()
    zero = sources.column("zero").to_numpy()
    if not len(place):
        return PAIRS.empty_table()
    block = place // block_sources
    left = np.flatnonzero(block == block[0])
    right = np.flatnonzero(block == block[-1])
    base = np.abs(zero[left][:, None] - zero[right])
    sums = np.zeros(base.shape, np.int64)
    if shares.num_rows:
        encoded = pc.dictionary_encode(shares.column("term").combine_chunks())
        term = encoded.indices.to_numpy()
        order = np.argsort(term, kind="stable")
        term = term[order]
        column = np.searchsorted(place, shares.column("place").to_numpy()[order])
        value = shares.column("share").to_numpy()[order]
        n_terms = len(encoded.dictionary)
        at_once = max(1, CHUNK_CELLS // len(place))
        for start in range(0, n_terms, at_once):
            stop = min(start + at_once, n_terms)
            rows = slice(*np.searchsorted(term, [start, stop]))
            matrix = np.repeat(zero[:, None], stop - start, axis=1)
            matrix[column[rows], term[rows] - start] = value[rows]
            theirs = matrix[right]
            for at, mine in enumerate(left):
                sums[at] += np.abs(theirs - matrix[mine]).sum(axis=1)
        sums -= n_terms * base
    if sources.column("bucket")[0].as_py() == 0:
        sums += sources.column("terms")[0].as_py() * base
        wanted = np.ones(sums.shape, bool)
    else:
        wanted = sums != 0
    wanted &= left[:, None] < right
    a, b = np.nonzero(wanted)
    names = sources.column("source")
    return pa.table([
        pa.array([sources.column("lang")[0].as_py()] * len(a), pa.string()),
        names.take(pa.array(left[a])),
        names.take(pa.array(right[b])),
        pa.array(sums[a, b]),
    ], schema=PAIRS)


def pair_part(
    kept: DataFrame,
    groups: DataFrame,
    tile_rows: int | None = None,
    block_sources: int = BLOCK_SOURCES,
) -> DataFrame:
    """Every other source of a group's language, by the summed difference."""
    order = Window.partitionBy("lang").orderBy("source")
    zero = F.coalesce(
        F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"))), F.lit(0)
    )
    placed = groups.select(
        "lang", "source", "total", "terms", zero.cast("bigint").alias("zero"),
        (F.row_number().over(order) - 1).cast("bigint").alias("place"),
    )
    rows = kept.count()
    widest = placed.agg(F.coalesce(F.max("place"), F.lit(0))).first()[0] + 1
    # A tile has more rows than it gives pairs, as far as its memory goes.
    tile_rows = tile_rows or min(1 << 20, max(1 << 14, 4 * widest * widest))
    buckets, blocks = -(-rows // tile_rows) or 1, -(-widest // block_sources)

    def in_tiles(df: DataFrame) -> DataFrame:
        """A row for every tile that its source's block is part of."""
        own = F.floor(F.col("place") / block_sources)
        others = F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))
        pairs = F.transform(
            others, lambda x: F.struct(F.least(x, own).alias("low"), F.greatest(x, own).alias("high"))
        )
        return df.withColumn("pair", F.explode(pairs)).select("pair.low", "pair.high", *df.columns)

    tile = ["lang", "bucket", "low", "high"]
    shares = kept.join(placed, ["lang", "source"]).select(
        "lang", "term", "place", share(F.col("n"), F.col("total"), F.col("terms")).alias("share"),
        F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int").alias("bucket"),
    )
    numbers = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    sources = placed.select("lang", "source", "terms", "zero", "place", numbers.alias("bucket"))

    def grouped(df: DataFrame, *columns: str):
        return in_tiles(df).select(*(F.col(c).alias(c) for c in (*tile, *columns))).groupBy(*tile)

    sums = (
        grouped(shares, "term", "place", "share")
        .cogroup(grouped(sources, "source", "terms", "zero", "place"))
        .applyInArrow(
            lambda shares, sources: tile_sums(shares, sources, block_sources),
            "lang string, source string, item string, value bigint",
        )
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )
    both = F.array(
        F.struct(F.col("source").alias("source"), F.col("item").alias("item")),
        F.struct(F.col("item").alias("source"), F.col("source").alias("item")),
    )
    directed = sums.select("lang", F.explode(both).alias("pair"), "value").select("lang", "pair.*", "value")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return directed.select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value",
        F.row_number().over(by_value).cast("int").alias("rank"),
    )


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    top: int = TOP,
    tile_rows: int | None = None,
    block_sources: int = BLOCK_SOURCES,
) -> DataFrame:
    """(lang, source, part, item, value, rank) of both parts.

    `tile_rows` is taken from the data unless given; it changes no result."""
    counts = stored(term_counts(docs, text, lang, source))
    frequent = (
        counts.where("term <> ''")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("documents").alias("documents"))
        .where(F.col("documents") >= min_documents)
    )
    kept = stored(
        counts.join(frequent.drop("documents"), ["lang", "term"]).select("lang", "source", "term", "n", "lang_n")
    )
    langs = (
        kept.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
        .groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    )
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    nothing = F.lit(0).cast("bigint")
    groups = stored(
        counts.where("term = ''")
        .select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .select(
            "lang", "source",
            *(F.coalesce(c, nothing).alias(c) for c in ("total", "terms", "lang_total")),
        )
    )
    return pair_part(kept, groups, tile_rows, block_sources).unionByName(term_part(kept, groups, top))
