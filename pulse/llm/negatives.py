"""Hard negatives by rotated one-bit codes with stored alignments.

Components become integers, floor(scale x), and scores are integer inner products. A vector is turned
by a pseudo-random rotation; its signs are a one-bit code. The signs of what is left over, when half the
largest coordinate is taken off by sign, are the next code, and so on for a few levels, the step halving
each time. The vector is projected on its codes; their alignments, the weights of the codes in the
projection, are stored, and the lengths of the projection and of the rest. The inner product of two
vectors is that of their coded parts, which popcounts of differing bits give, plus terms that hold a
rest; by Cauchy and Schwarz these lie within

    |anchor| |rest of row| + |rest of anchor| |coded part of row|

so every pair has an interval that holds its score for certain. Only rows whose interval can reach the
list asked for are scored, by integers: those whose upper end is not below the k-th largest lower end.
The filter loses nothing, whatever the levels; they only decide how many rows are scored.

For every anchor the best rows of its own label are its positives. For each positive the best rows of
other labels follow, among those whose score is at least `low` and at most `high` percent of the
positive's. Blocks of rows meet blocks of anchors, each of bounded size, so that a hot label is spread
over tasks like any other; a meeting gives at most k rows an anchor or positive.

Defined results: rows with a null id, label or vector, or a vector with a null or non-finite component (by
itself or times the scale) take no part; rows equal in id, label and vector count once; rows that share an
id are never each other's positive or negative; vectors meet only those of their own length; ties go to the
smaller id; a window below a negative score is empty; scores outside the range of a long become its
nearest end; no rows give no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.ann import by_length, hadamard
from pulse.llm.common import stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
ROW_LEVELS = 6
ANCHOR_LEVELS = 8
ROUNDS = 3
SEED = 29
LEAST_BITS = 64
BLOCK_COMPONENTS = 1 << 17
COMPARED_WORDS = 1 << 18
LONG = (-(1 << 63), (1 << 63) - 1)

CODE = "struct<bits: binary, alignments: array<double>, norm: double, coded: double, rest: double>"
ROW = ["vec_id", "label", "vector", "code"]


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(scale x), as whole doubles."""
    return np.floor(SCALE * vectors)


def rotated(vectors: np.ndarray) -> np.ndarray:
    """Rows turned by sign flips and Hadamard transforms, padded to a power of two."""
    n, d = vectors.shape
    size = max(LEAST_BITS, 1 << max(0, d - 1).bit_length())
    turned = np.zeros((n, size))
    turned[:, :d] = vectors
    for flip in np.random.default_rng(SEED).choice([-1.0, 1.0], (ROUNDS, size)):
        turned = hadamard(turned * flip)
    return turned


class Codes:
    """Codes of many vectors of one length: bits by row and level, alignments, and lengths."""

    def __init__(self, bits: np.ndarray, alignments: np.ndarray, norm, coded, rest):
        self.bits, self.alignments = bits, alignments
        self.norm, self.coded, self.rest = norm, coded, rest

    @classmethod
    def of(cls, vectors: np.ndarray, levels: int) -> Codes:
        with np.errstate(over="ignore", invalid="ignore"):
            turned = rotated(vectors)
            left, step = turned, np.abs(turned).max(axis=1, keepdims=True) / 2
            bits, codes = [], []
            for _ in range(levels):
                signs = left > 0
                bits.append(np.packbits(signs, axis=1).view(np.uint64))
                codes.append(np.where(signs, 1.0, -1.0))
                left, step = left - step * codes[-1], step / 2
            unit = np.stack(codes, axis=1) / math.sqrt(turned.shape[1])
            between = np.linalg.pinv(unit @ unit.transpose(0, 2, 1), hermitian=True)
            along = between @ (unit @ turned[:, :, None])
            coded = (unit.transpose(0, 2, 1) @ along)[:, :, 0]
            lengths = (np.sqrt((x * x).sum(axis=1)) for x in (turned, coded, turned - coded))
            return cls(np.stack(bits, axis=1), along[:, :, 0], *lengths)

    @classmethod
    def read(cls, codes: pa.StructArray) -> Codes:
        fields = {name: codes.field(name) for name in ("bits", "alignments", "norm", "coded", "rest")}
        n, levels = len(codes), len(fields["alignments"][0])
        bits = np.frombuffer(b"".join(fields["bits"].to_pylist()), np.uint64)
        alignments = fields["alignments"].flatten().to_numpy().reshape(n, levels)
        lengths = (fields[name].to_numpy() for name in ("norm", "coded", "rest"))
        return cls(bits.reshape(n, levels, -1), alignments, *lengths)

    def take(self, at) -> Codes:
        return Codes(self.bits[at], self.alignments[at], self.norm[at], self.coded[at], self.rest[at])

    def arrays(self) -> pa.StructArray:
        n, levels = self.alignments.shape
        offsets = np.arange(n + 1, dtype=np.int32) * levels
        return pa.StructArray.from_arrays(
            [
                pa.array([row.tobytes() for row in self.bits], pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(self.alignments.ravel())),
                *map(pa.array, (self.norm, self.coded, self.rest)),
            ],
            ["bits", "alignments", "norm", "coded", "rest"],
        )


def intervals(anchors: Codes, rows: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the interval of every anchor's score with every row."""
    n_words = rows.bits.shape[2]
    middle = np.zeros((len(anchors.norm), len(rows.norm)))
    at_once = max(1, COMPARED_WORDS // max(1, len(rows.norm) * n_words))
    with np.errstate(over="ignore", invalid="ignore"):
        for start in range(0, len(middle), at_once):
            part = slice(start, start + at_once)
            for i in range(anchors.bits.shape[1]):
                for j in range(rows.bits.shape[1]):
                    differing = np.bitwise_count(
                        anchors.bits[part, None, i] ^ rows.bits[None, :, j]
                    ).sum(axis=2, dtype=np.int64)
                    cosine = 1 - differing / (32 * n_words)
                    middle[part] += cosine * anchors.alignments[part, i, None] * rows.alignments[None, :, j]
        around = anchors.norm[:, None] * rows.rest + anchors.rest[:, None] * rows.coded
        # Rounding of the estimate is far below this.
        around += 1e-9 * (1 + anchors.norm[:, None] * rows.norm)
        low, high = middle - around, middle + around
    # Without a finite interval a score may be anything; beyond the range of a long all are equal.
    low = np.where(np.isfinite(low), low, -np.inf)
    high = np.where(np.isfinite(high), high, np.inf)
    return np.clip(low, *map(float, LONG)), np.clip(high, *map(float, LONG))


def exact_scores(anchor: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products of one anchor and some rows."""
    most = float(np.abs(anchor).max(initial=0)) * float(np.abs(rows).max(initial=0)) * len(anchor)
    if most < 2**53:
        return (rows @ anchor).astype(np.int64)
    whole = [int(x) for x in anchor]
    sums = [sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in rows]
    return np.array([min(max(s, LONG[0]), LONG[1]) for s in sums], np.int64)


def reaching(low: np.ndarray, high: np.ndarray, keep: int, sure=None) -> np.ndarray:
    """Which rows may be among the best `keep`; only `sure` ones raise the bar."""
    bars = low if sure is None else low[sure]
    if len(bars) < keep:
        return np.ones(len(high), bool)
    return high >= np.partition(bars, len(bars) - keep)[len(bars) - keep]


def best(ids: np.ndarray, scores: np.ndarray, keep: int) -> list[tuple[int, int]]:
    """(id, score) of the best `keep`, higher scores and then smaller ids first."""
    # The bitwise complement falls as the score rises, and has no overflow.
    order = np.lexsort((ids, ~scores))[:keep]
    return [(int(ids[at]), int(scores[at])) for at in order]


class Block:
    """Rows of one vector length that meet anchors."""

    def __init__(self, table: pa.Table, at: np.ndarray, matrix: np.ndarray):
        part = table.take(pa.array(at))
        self.table = part
        self.ids = part.column("vec_id").to_numpy()
        self.labels = part.column("label").to_numpy()
        self.vectors = integers(matrix)
        self.codes = Codes.read(part.column("code").combine_chunks())


def blocks_by_length(table: pa.Table) -> dict[int, Block]:
    if not table.num_rows:
        return {}
    vectors = table.column("vector").combine_chunks()
    return {matrix.shape[1]: Block(table, at, matrix) for at, matrix in by_length(vectors)}


def meetings(anchors: pa.Table, rows: pa.Table, same_label: bool):
    """Anchors, one at a time, with the rows of like or unlike label and their intervals."""
    row_blocks = blocks_by_length(rows)
    for length, asking in blocks_by_length(anchors).items():
        block = row_blocks.get(length)
        if block is None:
            continue
        for label in np.unique(asking.labels):
            mine = np.flatnonzero(asking.labels == label)
            theirs = np.flatnonzero((block.labels == label) == same_label)
            at_once = max(1, (1 << 20) // max(1, len(theirs)))
            for start in range(0, len(mine) if len(theirs) else 0, at_once):
                some = mine[start : start + at_once]
                lows, highs = intervals(asking.codes.take(some), block.codes.take(theirs))
                for anchor, low, high in zip(some.tolist(), lows, highs, strict=True):
                    other = block.ids[theirs] != asking.ids[anchor]
                    yield asking, anchor, block, theirs[other], low[other], high[other]


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


FOUND = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])
MINED = pa.schema([("anchor", pa.int64()), ("anchor_id", pa.int64()), ("positive_score", pa.int64()), ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def positives_of(anchors: pa.Table, rows: pa.Table, keep: int) -> pa.Table:
    """The best rows of a block with an anchor's label, for every anchor."""
    found = []
    for asking, anchor, block, at, low, high in meetings(anchors, rows, True):
        at = at[reaching(low, high, keep)]
        scores = exact_scores(asking.vectors[anchor], block.vectors[at])
        key, anchor_id = asking.table.column("anchor")[anchor].as_py(), int(asking.ids[anchor])
        found.extend((key, anchor_id, *row) for row in best(block.ids[at], scores, keep))
    return table_of(found, FOUND)


def negatives_of(anchors: pa.Table, rows: pa.Table, keep: int, low_percent: int, high_percent: int) -> pa.Table:
    """The best rows of a block with other labels within the window of every positive score."""
    found = []
    for asking, anchor, block, at, low, high in meetings(anchors, rows, False):
        key, anchor_id = asking.table.column("anchor")[anchor].as_py(), int(asking.ids[anchor])
        windows, wanted = [], np.zeros(len(at), bool)
        for score in asking.table.column("targets")[anchor].as_py():
            # Least and greatest whole scores within the percentages.
            least, most = -(-low_percent * score // 100), high_percent * score // 100
            if least > most:
                continue
            windows.append((score, least, most))
            sure = (low >= least) & (high <= most)
            wanted |= (high >= least) & (low <= most) & reaching(low, high, keep, sure)
        at = at[wanted]
        scores = exact_scores(asking.vectors[anchor], block.vectors[at])
        for score, least, most in windows:
            inside = (scores >= least) & (scores <= most)
            rows_found = best(block.ids[at][inside], scores[inside], keep)
            found.extend((key, anchor_id, score, *row) for row in rows_found)
    return table_of(found, MINED)


def proper(vector: Column) -> Column:
    """Whether a vector's components are numbers that have integers."""
    scaled = F.transform(vector, lambda x: F.abs(x.cast("double") * F.lit(float(SCALE))))
    fine = F.forall(scaled, lambda x: x.isNotNull() & (x < float("inf")) & ~F.isnan(x))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False))


def with_code(df: DataFrame, levels: int) -> DataFrame:
    """Adds the code of every vector."""

    @F.arrow_udf(CODE)
    def code(vectors: pa.Array) -> pa.Array:
        places, parts = [], []
        for at, matrix in by_length(vectors):
            for start in range(0, len(at), 1024):
                places.append(at[start : start + 1024])
                parts.append(Codes.of(integers(matrix[start : start + 1024]), levels).arrays())
        joined = pa.concat_arrays(parts)
        return joined.take(pa.array(np.argsort(np.concatenate(places), kind="stable")))

    return df.withColumn("code", code("vector"))


def meet(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], columns: list[str], use, schema: str) -> DataFrame:
    """`use` on every block of anchors and every block of rows."""
    row_blocks, anchor_blocks = blocks

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def part(n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(n)).cast("int")

    asking = anchors.withColumn("anchor_block", part(anchor_blocks)).withColumn("row_block", every(row_blocks))
    asked = rows.withColumn("row_block", part(row_blocks)).withColumn("anchor_block", every(anchor_blocks))
    tile = ["row_block", "anchor_block"]

    def grouped(df: DataFrame, names: list[str]):
        # Aliases tell the columns of the two sides, which share a source, apart.
        return df.select(*(F.col(c).alias(c) for c in (*tile, *names))).groupBy(*tile)

    return grouped(asking, [*ROW, *columns]).cogroup(grouped(asked, ROW)).applyInArrow(use, schema)


def first_of(found: DataFrame, by: list[str], score: str, other: str, keep: int) -> DataFrame:
    """The best `keep` of every group, ranked from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), other)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block_components: int = BLOCK_COMPONENTS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    spark = vectors.sparkSession
    proper_rows = vectors.where(
        F.col(vec_id).isNotNull() & F.col(label).isNotNull() & proper(F.col(vector))
    ).select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(label).cast("bigint").alias("label"),
        F.col(vector).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    distinct = proper_rows.groupBy("vec_id", "label", "vector").agg(F.max("asks").alias("asks"))
    index = stored(with_code(distinct, ROW_LEVELS))
    key = F.xxhash64("vec_id", "label", "vector")
    anchors = stored(with_code(index.where("asks").drop("code"), ANCHOR_LEVELS).withColumn("anchor", key))
    # An empty vector is a component as well.
    size = F.greatest(F.size("vector"), F.lit(1))
    total, asking = index.agg(
        F.coalesce(F.sum(size), F.lit(0)),
        F.coalesce(F.sum(F.when(F.col("asks"), size)), F.lit(0)),
    ).first()
    # Several blocks a task even out the tasks.
    least = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(least, -(-total // block_components)), max(1, -(-asking // block_components))
    found = meet(
        anchors, index, blocks, ["anchor"],
        lambda a, rows: positives_of(a, rows, positives),
        "anchor bigint, anchor_id bigint, positive_id bigint, positive_score bigint",
    )
    chosen = stored(first_of(found, ["anchor", "anchor_id"], "positive_score", "positive_id", positives).drop("rank"))
    targets = chosen.groupBy("anchor").agg(F.collect_set("positive_score").alias("targets"))
    mined = meet(
        anchors.join(targets, "anchor"), index, blocks, ["anchor", "targets"],
        lambda a, rows: negatives_of(a, rows, negatives, low, high),
        "anchor bigint, anchor_id bigint, positive_score bigint, negative_id bigint, negative_score bigint",
    )
    ranked = first_of(mined, ["anchor", "anchor_id", "positive_score"], "negative_score", "negative_id", negatives)
    return chosen.join(ranked, ["anchor", "anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score"
    )
