"""SimHash near duplicates: segment popcounts, a grid join on them, an exact check, components.

A fingerprint takes one bit per position by majority over the XXH64 hashes of a text's word
shingles. Its 64 bits form 32 segments of two bits; the vector of the segments' bit counts is its
embedding, and the Manhattan distance of two embeddings never exceeds the Hamming distance of the
fingerprints. The segments form six bands, so two embeddings at distance three or less agree
wholly on at least three bands: the grid has one axis per band, a cell is the embedding on three
of them, and every link is found in one of 20 cells. Within a cell the Manhattan distance is
tested first, then the exact Hamming distance.

Copies share a fingerprint and count once. A cell gives only links enough to connect its members,
never all its pairs. A cell of more than `cell_rows` fingerprints is not compared pairwise: each
of its fingerprints is posted under all values that differ from it in up to two bits, and under
each value all are linked to one that differs in at most one bit. Those links are within three
bits, and any two fingerprints within three bits meet that way, so the components are the same.

Joins on a fingerprint, a cell or a node that may be hot shuffle both sides for themselves, so that
adaptive execution can split the hot key.

Defined results: a null text counts as empty, and a text without words has fingerprint zero, which
links like any other; a null doc_id names no component unless its whole group has none, then the
component is null; repeated rows come back as often as they were given; no rows give no rows; columns
other than the id and the text are not read, but for `drop_near_duplicates`, which passes them through
whatever their names.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.common import cut, free_name, in_parts, row_hash, text_or_empty
from pulse.operators.enrich import lookup, require

SEED = 42
SHINGLE = 3
MAX_BITS = 3
CELL_ROWS = 8192
BANDS = 6
SEGMENT_MASK = 0x5555555555555555


def band_masks() -> list[int]:
    """Bit masks of the grid's cells: three of six runs of two-bit segments each."""
    edges = [2 * round(i * 32 / BANDS) for i in range(BANDS + 1)]
    bands = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [x | y | z for x, y, z in combinations(bands, BANDS - MAX_BITS)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """The text's fingerprint as an unsigned integer."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    stops = ends[width - 1 :] if len(words) >= width else ends[-1:]
    starts = np.concatenate([[0], ends[: len(stops) - 1] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (
            digest(joined[a:b], SEED)
            for a, b in zip(starts.tolist(), stops.tolist(), strict=True)
        ),
        np.uint64,
        len(stops),
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        block = hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprint(
    docs: DataFrame, text: str = "text", name: str = "fp", width: int = SHINGLE
) -> DataFrame:
    """Adds the fingerprint of every row as a signed bigint."""
    @F.arrow_udf("bigint")
    def fingerprints(texts: pa.Array) -> pa.Array:
        values = [signed(fingerprint(value, width)) for part in in_parts(texts) for value in part]
        return pa.array(values, pa.int64())

    return docs.withColumn(name, fingerprints(text_or_empty(text)))


def embedding(fp):
    """Bit counts of the 32 two-bit segments, two bits each."""
    mask, half = F.lit(SEGMENT_MASK), F.shiftrightunsigned(fp, 1)
    ones = fp.bitwiseXOR(half).bitwiseAND(mask)
    twos = fp.bitwiseAND(half).bitwiseAND(mask)
    return F.shiftleft(twos, 1).bitwiseOR(ones)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of segment counts held two bits each: bits that differ, by segment."""
    low = np.uint64(SEGMENT_MASK)
    ones_a, ones_b, twos_a, twos_b = a & low, b & low, (a >> np.uint64(1)) & low, (b >> np.uint64(1)) & low
    # Counts are 0, 1 or 2: they differ by two exactly where one is 0 and the other 2.
    two_apart = (twos_a ^ twos_b) & ~(ones_a | ones_b)
    one_apart = ones_a ^ ones_b
    return np.bitwise_count(one_apart) + 2 * np.bitwise_count(two_apart)


def connect(values: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect all of `values` within MAX_BITS of each other, at most one per value."""
    values = values.view(np.uint64)
    counts = values - ((values >> np.uint64(1)) & np.uint64(SEGMENT_MASK))
    left = np.ones(len(values), bool)
    links = []
    while left.any():
        start = int(np.argmax(left))
        left[start] = False
        queue = [start]
        while queue:
            at = queue.pop()
            rest = np.flatnonzero(left)
            rest = rest[manhattan(counts[rest], counts[at]) <= MAX_BITS]
            near = rest[np.bitwise_count(values[rest] ^ values[at]) <= MAX_BITS]
            left[near] = False
            links.extend((int(at), int(other)) for other in near)
            queue.extend(near.tolist())
    signed_values = values.view(np.int64)
    return [(int(signed_values[a]), int(signed_values[b])) for a, b in links]


def cell_links(batches):
    """Links of each cell; rows come sorted by cell, and no cell is over the row bound."""
    key, members = None, []

    def flush():
        if len(members) > 1:
            yield from connect(np.array(members, np.int64))

    def batch(links):
        a, b = zip(*links, strict=True) if links else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
        )

    for rows in batches:
        links = []
        columns = (rows.column(i).to_pylist() for i in range(3))
        for table, cell, fp in zip(*columns, strict=True):
            if (table, cell) != key:
                links.extend(flush())
                key, members = (table, cell), []
            members.append(fp)
        yield batch(links)
    yield batch(list(flush()))


def near_keys(fps: pa.Array) -> pa.Array:
    """For each fingerprint all values up to two bits away, and how many bits."""
    bits = [1 << i for i in range(64)]
    flips = [0, *bits, *(x | y for x, y in combinations(bits, 2))]
    masks = np.array(flips, np.uint64)
    values = fps.to_numpy(zero_copy_only=False).view(np.uint64)
    keys = (values[:, None] ^ masks[None, :]).view(np.int64)
    offsets = np.arange(len(values) + 1, dtype=np.int32) * len(masks)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel()))


def fingerprint_links(fps: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(a, b): links within MAX_BITS that connect what all such links connect; `fps` is distinct."""
    cells = fps.select(
        "fp",
        F.posexplode(
            F.array(
                *(
                    embedding(F.col("fp")).bitwiseAND(F.lit(signed(mask)))
                    for mask in band_masks()
                )
            )
        ).alias("grid", "cell"),
    )
    sizes = cells.groupBy("grid", "cell").count().where("count > 1")
    shared = cut(
        require(cells, sizes, ["grid", "cell"], split_hot=True).select("grid", "cell", "fp", "count")
    )
    links = (
        shared.where(F.col("count") <= cell_rows)
        .select("grid", "cell", "fp")
        .repartition("grid", "cell")
        .sortWithinPartitions("grid", "cell")
        .mapInArrow(cell_links, "a bigint, b bigint")
    )
    crowded = shared.where(F.col("count") > cell_rows).select("fp").distinct()
    posted = crowded.select(
        "fp", F.posexplode(F.arrow_udf(near_keys, "array<bigint>")("fp")).alias("at", "key")
    )
    # The first 65 keys of a fingerprint are itself and those one bit away.
    centres = posted.groupBy("key").agg(F.min(F.when(F.col("at") <= 64, F.col("fp"))).alias("a"))
    stars = (
        posted.join(centres.where("a is not null"), "key")
        .where("a <> fp")
        .select("a", F.col("fp").alias("b"))
        .distinct()
    )
    return links.union(stars)


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of a link with a smaller one.

    Every round links larger neighbours to a node's smallest one, then all smaller neighbours to
    the smallest, until nothing changes. Rounds are cut in the checkpoint folder."""
    edges = cut(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )

    def state(df: DataFrame):
        return df.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()

    before = state(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("low"))
        large = (
            require(both, least, "u", split_hot=True)
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("low", "u").alias("v"))
            .union(least.where("low < u").select("u", F.col("low").alias("v")))
            .distinct()
        )
        large = cut(large)
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = (
            require(large, low, "u", split_hot=True)
            .select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")), "low")
            .toDF("u", "v")
            .where("u <> v")
            .distinct()
        )
        edges = cut(small)
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def with_roots(groups: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Adds to one row per fingerprint the root of its component, a fingerprint too."""
    roots = components(fingerprint_links(groups.select("fp"), cell_rows))
    found = lookup(groups, roots.withColumnRenamed("node", "fp"), "fp")
    return found.withColumn("root", F.coalesce("root", "fp"))


def component_ids(prints: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Adds component_id to rows with doc_id and fp: the smallest doc_id reachable."""
    groups = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    rooted = with_roots(groups, cell_rows)
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = require(rooted.select("fp", "root"), lowest, "root").select("fp", "component_id")
    return require(prints, named, "fp", split_hot=True)


def simhash_components(
    docs: DataFrame, text: str = "text", width: int = SHINGLE, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """One row per document: doc_id, fp and component_id."""
    prints = cut(with_fingerprint(docs.select("doc_id", text), text, width=width).select("doc_id", "fp"))
    return component_ids(prints, cell_rows)


def drop_near_duplicates(docs: DataFrame, text: str = "text", width: int = SHINGLE) -> DataFrame:
    """One document of every component stays, the one with the smallest doc_id.

    Null ids come last, so a component without any id keeps one document as well. Of rows that
    share the id, the one with the smallest hash of the whole row stays."""
    tie, fp = free_name(docs, "tie"), "fp"
    hashed = docs.withColumn(tie, row_hash(docs))
    rank = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id").alias("id"), F.col(tie).alias("tie"))
    ranked = hashed.select(F.col(text).alias("text"), rank.alias("rank"))
    prints = with_fingerprint(ranked, "text", fp, width).select(fp, "rank")
    groups = cut(prints.groupBy(fp).agg(F.min("rank").alias("rank")))
    stay = with_roots(groups).groupBy("root").agg(F.min("rank").alias("rank"))
    # Rows equal in every column are one; each task keeps one of them before the shuffle. Ids are
    # compared as texts with a mark for null, so that the join needs no shuffle beyond the window's.
    row = free_name(docs, "row", tie)
    missing = free_name(docs, "missing", tie, row)
    name = free_name(docs, "name", tie, row, missing)
    keys = [missing, name, tie]

    def as_text(doc_id: Column) -> Column:
        return F.coalesce(doc_id.cast("string"), F.lit(""))

    order = Window.partitionBy(*keys).orderBy(F.lit(0))
    single = (
        hashed.withColumns({missing: F.col("doc_id").isNull(), name: as_text(F.col("doc_id"))})
        .withColumn(row, F.row_number().over(order))
        .where(F.col(row) == 1)
    )
    wanted = stay.select(
        F.col("rank.missing").alias(missing), as_text(F.col("rank.id")).alias(name), F.col("rank.tie").alias(tie)
    )
    return single.join(wanted, keys, "left_semi").select(*(F.col(f"`{c}`") for c in docs.columns))
