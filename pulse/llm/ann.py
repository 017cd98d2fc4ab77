"""Nearest neighbours by cross-polytope hashing, then exact cosines.

A unit vector is rotated by sign flips and fast Hadamard transforms, three rounds a time; its hash is
the signed axis nearest to it, the coordinate of largest size. A table joins the hashes of several
rotations to a bucket; how many follows from the number of vectors, so that a query meets an ever smaller
share of a table as it grows. A query looks into its own bucket of each table and into others, in the order
of how far their axes lag behind the nearest ones, squared and summed.

No table holds copies of the vectors. They are dealt into blocks once, coded in a byte a component with their
buckets of all tables; a task has one block and all queries, or a large part of them. The queries that look
into a bucket are compared with all of its rows at once, by a matrix product of codes. How far a code is from
its vector bounds the error, so what may be near enough is known for sure, and only that is compared by the
exact cosine, in double precision on the original vectors.

The nearer a neighbour, the surer it is met, and the longer the vectors, the less sure: how many buckets a
query needs follows from the score of its k-th neighbour found, which the true one is not below, and from
the length. Pairs drawn at random give the number at which such a neighbour is met with probability
`recall`. Queries first look into few buckets, which gives that score; those that seem to need all look into
four times as many, again and again. Then all look into the buckets they need, for what is no farther than
that score.

Equal vectors count once: a vector keeps its `k` + 1 smallest ids, which are all that can be among
the k nearest of anything. A query that meets fewer than k candidates is compared with every vector, in
blocks, and so is one that would need as many buckets as there are vectors or buckets.

Defined results: vectors that are null, empty, all zero, or hold a null or non-finite component take
no part, as query or candidate; vectors meet only those of their own length; ties go to the smaller
id; a null id takes no part; rows that repeat an id with its vector count once; an id with several
vectors is a candidate with its nearest and, as a query, searches with each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from pulse.llm.common import cut, stored
from pulse.operators.enrich import require

TABLES = 8
PROBES = 10
PROBES_GROW = 6
ROUNDS = 3
SEED = 17
# Queries that are compared with all vectors.
BLOCK_ROWS = 16384
BLOCK_QUERIES = 4096
# Queries that look into buckets: the rows and queries of a tile, and the rows below which a small table is
# not cut further, nor into more than TILES.
TILE_ROWS = 3 << 18
TILE_QUERIES = 1 << 19
PLACE_ROWS = 4096
TILES = 6
# Rows that go into one packed row, of at most so many values.
PACK_ROWS = 1 << 14
PACK_VALUES = 1 << 20
# Buckets of fewer rows than this on average are compared pair by pair.
FEW_ROWS = 4
# So many products at once, and so many finds until the best of them are sorted out.
PRODUCTS = 1 << 20
CROWDED = 32
FINDS = 1 << 19
# More than single precision moves the product of two unit vectors.
ROUGH = 1e-4
# Steps of the second byte in one of the first, which is off by half a step at most.
FINER = 254
# From the third hash of a bucket on, so many rows count as one.
CROWD = 64
# So many values tell a batch of queries how far the axes of a hash lag.
BATCH_LAGS = 1 << 22
# So many hashes of equal vectors are looked up in every task.
FEW_AGAIN = 1 << 14
PAIRS_AT_ONCE = 1 << 15
TIE = 1e-9
RECALL = 0.97
# Scores are rounded down to so many steps from 0 to 1 before the probes they need are looked up.
STEPS = 50
WHOLE = 1 << 30
# Below every cosine.
ANY = -2.0


@lru_cache
def hadamard_matrix(size: int) -> np.ndarray:
    matrix = np.ones((1, 1))
    while len(matrix) < size:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return matrix


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows times the normalised Hadamard matrix; their length is a power of two."""
    n, d = x.shape
    half = 1
    while half < d:
        size = min(64, d // half)
        x = hadamard_matrix(size) @ x.reshape(n, d // (half * size), size, half)
        half *= size
        x = x.reshape(n, d)
    return x / np.sqrt(d)


def padded_size(length: int) -> int:
    """The power of two that vectors of this length are padded to."""
    return 1 << max(1, (length - 1).bit_length())


def joined_hashes(size: int, rows: int) -> int:
    """How many hashes make a bucket: as many as leave about a row to four buckets."""
    hashes = 1
    while (2 * size) ** (hashes + 1) <= 4 * rows:
        hashes += 1
    return hashes


def bucket_hashes(size: int, rows: int) -> int:
    """How many hashes make a bucket. Rows are compared bucket by bucket, so that a third hash pays only
    where the buckets of two are crowds."""
    return min(joined_hashes(size, rows), max(2, joined_hashes(size, rows // CROWD)))


def turned_by_rounds(padded: np.ndarray, count: int, seed: int, first: int = 0) -> Iterator[np.ndarray]:
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (count, ROUNDS, padded.shape[1]))
    for flips in signs[first:]:
        turned = padded
        for flip in flips:
            turned = hadamard(turned * flip)
        yield turned


@lru_cache(maxsize=8)
def turning(size: int, count: int, seed: int) -> list[np.ndarray]:
    """The rotations of short vectors, each as one matrix."""
    return list(turned_by_rounds(np.eye(size), count, seed))


def rotations(vectors: np.ndarray, count: int, seed: int, first: int = 0):
    """Pseudo-random rotations, from `first` to before `count`, of the unit vectors of the rows, padded to a
    power of two."""
    n, d = vectors.shape
    size = padded_size(d)
    padded = np.zeros((n, size))
    padded[:, :d] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    if size > 256:
        yield from turned_by_rounds(padded, count, seed, first)
    else:
        yield from (padded @ matrix for matrix in turning(size, count, seed)[first:])


def axes(turned: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest `most` signed axes of every row, nearest first, and how far they lag, squared."""
    both = np.concatenate([turned, -turned], axis=1)
    order = both.argmax(axis=1)[:, None] if most == 1 else np.argsort(-both, axis=1, kind="stable")[:, :most]
    sizes = np.take_along_axis(both, order, axis=1)
    return order, (sizes[:, :1] - sizes) ** 2


@lru_cache(maxsize=64)
def low_ranks(hashes: int, most: int, size: int) -> np.ndarray:
    """Ranks of axes, a row a choice of one per hash, among which the first `most` choices must be.

    A choice is preceded by all with no larger rank anywhere: the product of ranks, from 1, is no
    larger than its place."""
    chosen = np.arange(min(most, 2 * size))[:, None]
    for _ in range(hashes - 1):
        room = most // np.prod(chosen + 1, axis=1)
        counts = np.minimum(room, 2 * size)
        starts = np.repeat(np.cumsum(counts) - counts, counts)
        last = np.arange(counts.sum()) - starts
        chosen = np.concatenate([np.repeat(chosen, counts, axis=0), last[:, None]], axis=1)
    return chosen


def buckets(vectors: np.ndarray, tables: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """(rows, tables, probes): the first `probes` buckets of every table, its number included."""
    size = padded_size(vectors.shape[1])
    base = 2 * size
    probes = min(probes, base**hashes)
    turned = rotations(vectors, tables * hashes, seed)
    ranks = low_ranks(hashes, probes, size)
    found = np.zeros((len(vectors), tables, probes), np.int64)
    for table in range(tables):
        codes = np.zeros((len(vectors), len(ranks)), np.int64)
        lags = np.zeros(codes.shape)
        for rank in ranks.T:
            order, lag = axes(next(turned), int(rank.max()) + 1)
            codes = codes * base + order[:, rank]
            lags += lag[:, rank]
        first = np.argsort(lags, axis=1, kind="stable")[:, :probes]
        found[:, table] = table * base**hashes + np.take_along_axis(codes, first, axis=1)
    return found


@lru_cache
def probes_needed(
    size: int, hashes: int, tables: int, rows: int, recall: float, seed: int = SEED
) -> tuple[int, ...]:
    """Probes a table, by steps of the score, that find a neighbour with that score with probability
    `recall`, from random pairs of padded length `size`; WHOLE where they cost all comparisons."""
    pairs = min(1000, max(200, (1 << 22) // (2 * size) ** max(1, hashes - 1)))
    rng = np.random.default_rng(seed)
    ranks = np.zeros((STEPS, pairs))
    for pair in range(pairs):
        x, other = rng.normal(size=(2, hashes, size))
        lag = (np.abs(x).max(axis=1, keepdims=True) - np.concatenate([x, -x], axis=1)) ** 2
        sums = np.zeros(1)
        for line in lag[:-1]:
            sums = (sums[:, None] + line).ravel()
        sums.sort()
        for step in range(STEPS):
            score = step / STEPS
            y = score * x + np.sqrt(1 - score * score) * other
            at = np.abs(y).argmax(axis=1)[:, None]
            own = np.where(np.take_along_axis(y, at, axis=1) > 0, at, at + size)
            total = np.take_along_axis(lag, own, axis=1).sum()
            ranks[step, pair] = np.searchsorted(sums, total - lag[-1]).sum() + 1
    # Every table meets the neighbour by itself.
    single = 1 - (1 - recall) ** (1 / tables)
    needed = np.ceil(np.quantile(ranks, single, axis=1, method="higher")).astype(np.int64)
    needed[needed * tables >= min((2 * size) ** hashes, max(rows, 2 * size))] = WHOLE
    return tuple(np.minimum.accumulate(needed).tolist())


def by_length(arrays: pa.Array):
    """Positions and matrix of the rows of each length."""
    lengths = np.asarray(arrays.value_lengths())
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        flat = arrays.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
        yield at, flat.astype(np.float64).reshape(len(at), length)


def in_runs(stops: np.ndarray, tables: int) -> Iterator[np.ndarray]:
    """Positions of rows that look into like many buckets, a run of bounded size at a time."""
    order = np.argsort(stops, kind="stable")
    done = 0
    while done < len(order):
        most = int(stops[order[min(done + 255, len(order) - 1)]])
        few = order[done : done + max(1, min(256, (1 << 20) // (most * tables)))]
        done += len(few)
        yield few


def bucket_lists(
    vectors: pa.Array, starts: np.ndarray, stops: np.ndarray, tables: int, hashes: dict[int, int], seed: int
):
    """For every vector its buckets, those from `starts` to before `stops` of every table."""
    rows: list = [None] * len(vectors)
    for at, matrix in by_length(vectors):
        joined = hashes[padded_size(matrix.shape[1])]
        for few in in_runs(stops[at], tables):
            found = buckets(matrix[few], tables, joined, int(stops[at[few]].max()), seed)
            for i, row in zip(at[few].tolist(), found, strict=True):
                rows[i] = row[:, starts[i] : stops[i]].ravel()
    return rows


def radii(vectors: np.ndarray, stops: np.ndarray, tables: int, hashes: int, seed: int) -> np.ndarray:
    """(rows, tables): how far, squared and summed, the last of the first `stops` buckets lags."""
    size = padded_size(vectors.shape[1])
    stops = np.minimum(stops, (2 * size) ** hashes)
    found = np.empty((len(vectors), tables))
    for few in in_runs(stops, tables):
        turned = rotations(vectors[few], tables * hashes, seed)
        ranks = low_ranks(hashes, int(stops[few].max()), size)
        last = stops[few] - 1
        for table in range(tables):
            lags = np.zeros((len(few), len(ranks)))
            for rank in ranks.T:
                lags += axes(next(turned), int(rank.max()) + 1)[1][:, rank]
            lags.partition(np.unique(last), axis=1)
            found[few, table] = lags[np.arange(len(few)), last]
    return found


def proper(vector: Column) -> Column:
    """Whether a vector takes part."""
    values = vector.cast("array<double>")
    most, least, infinite = F.array_max(values), F.array_min(values), F.lit(float("inf"))
    # Not a number is above infinity; where a null is, a value that is not found may be anywhere.
    fine = (most < infinite) & (least > -infinite) & F.coalesce(~F.array_contains(values, infinite), F.lit(False))
    return vector.isNotNull() & fine & ((most > 0) | (least < 0))


FOUND = pa.schema([("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
NEAR = pa.schema([("query", pa.int64()), ("key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
BYTES = pa.binary()
TYPES = {pa.int32(): "int", pa.int64(): "bigint", pa.float64(): "double", BYTES: "binary"}
ROWS_PACKED = pa.schema(
    [("dim", pa.int32()), ("block", pa.int64())]
    + [(name, BYTES) for name in ("keys", "firsts", "coarse", "scales", "slacks", "codes", "fine", "rests")]
)
QUERIES_PACKED = pa.schema(
    [("dim", pa.int32()), ("part", pa.int64())]
    + [(name, BYTES) for name in ("queries", "leasts", "vectors", "radii")]
)


def matrix_of(table: pa.Table) -> np.ndarray:
    return next(by_length(table.column("vector").combine_chunks()))[1]


def found_table(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, FOUND, strict=True)], schema=FOUND)


def ddl(kind: pa.Schema) -> str:
    return ", ".join(f"{field.name} {TYPES[field.type]}" for field in kind)


def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """The rows of a task by the length of their vectors, many at a time."""

    def cut_up(held: list[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
        table = pa.Table.from_batches(held)
        dims = table.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            yield dim, table.take(pa.array(np.flatnonzero(dims == dim)))

    held: list[pa.RecordBatch] = []
    rows = values = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        values += int(np.asarray(batch.column("dim")).sum())
        if rows >= PACK_ROWS or values >= PACK_VALUES:
            yield from cut_up(held)
            held, rows, values = [], 0, 0
    if held:
        yield from cut_up(held)


def dealt(dim: int, group: np.ndarray, kind: pa.Schema, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A packed row for every group that rows of these columns belong to."""
    order = np.argsort(group, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(group[order])) + 1)
    packed = [[np.ascontiguousarray(column[part]).tobytes() for part in parts] for column in columns]
    groups = [int(group[part[0]]) for part in parts]
    yield pa.RecordBatch.from_arrays(
        [pa.array(x, field.type) for x, field in zip([[dim] * len(parts), groups, *packed], kind, strict=True)],
        schema=kind,
    )


def unpacked(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(value.as_buffer(), kind) for value in table.column(name)])


def unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def code_type(size: int, hashes: int) -> np.dtype:
    """The smallest type that the buckets of a table fit in."""
    return np.min_scalar_type((2 * size) ** hashes - 1)


def row_packer(tables: int, hashes: dict[int, int], blocks: dict[int, int], seed: int):
    """Packs rows of key, first, dim and vector: a byte a component, how far that is off, buckets, and another
    byte a component for what is left, with how far both are off."""

    def packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, table in packs(batches):
            size = padded_size(dim)
            keys, matrix = table.column("key").to_numpy(), unit(matrix_of(table))
            codes = np.empty((len(keys), tables), code_type(size, hashes[size]))
            for at in range(0, len(keys), 2048):
                found = buckets(matrix[at : at + 2048], tables, hashes[size], 1, seed)[:, :, 0]
                codes[at : at + 2048] = found % (2 * size) ** hashes[size]
            scales = np.abs(matrix).max(axis=1).astype(np.float32) / np.float32(127)
            coarse = np.clip(np.rint(matrix / scales[:, None]), -127, 127).astype(np.int8)
            left = matrix - coarse * scales[:, None].astype(float)
            steps = scales[:, None].astype(float) / FINER
            fine = np.clip(np.rint(left / steps), -127, 127).astype(np.int8)
            slacks, rests = (np.linalg.norm(x, axis=1).astype(np.float32) for x in (left, left - fine * steps))
            firsts = table.column("first").to_numpy()
            columns = (keys, firsts, coarse, scales, slacks, codes, fine, rests)
            yield from dealt(dim, keys % blocks[size], ROWS_PACKED, *columns)

    return packer


def query_packer(tables: int, hashes: dict[int, int], parts: int, seed: int):
    """Packs rows of query, dim, vector, least and stop: single precision, and how far they look."""

    def packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, table in packs(batches):
            keys, stops = table.column("query").to_numpy(), table.column("stop").to_numpy().astype(np.int64)
            vectors = unit(matrix_of(table)).astype(np.float32)
            far = radii(vectors, stops, tables, hashes[padded_size(dim)], seed)
            leasts = table.column("least").to_numpy().astype(np.float64)
            yield from dealt(dim, keys % parts, QUERIES_PACKED, keys, leasts, vectors, far.astype(np.float32))

    return packer


class Table:
    """The rows of a block in the order of their buckets in one table."""

    def __init__(self, block: Block, table: int):
        codes = block.codes[:, table]
        self.order = np.argsort(codes, kind="stable").astype(np.int32)
        self.codes = codes[self.order].astype(np.int64)
        self.scales, self.slacks = block.scales[self.order], block.slacks[self.order]
        place = np.empty_like(self.order)
        place[self.order] = np.arange(len(place), dtype=np.int32)
        self.coarse = np.empty((len(place), block.dim), np.int8)
        done = 0
        for rows in block.coarse:
            self.coarse[place[done : done + len(rows)]] = rows
            done += len(rows)
        self.base, self.hashes = block.base, block.hashes


class Look:
    """A batch of queries that look into the buckets of a table.

    They note what may score `least`; with `most`, only the best of that. `lags` has an array a hash of how far
    every axis lags, squared, axes by queries."""

    def __init__(self, block: Block, table: Table, lags: list[np.ndarray], batch: slice, most: int | None):
        self.block, self.table, self.lags, self.batch, self.most = block, table, lags, batch, most
        self.vectors, least = block.vectors[batch], block.least[batch]
        self.low = least.astype(np.float32) - np.float32(ROUGH)
        self.noted, self.full = 0, FINDS
        self.wide = np.concatenate([self.vectors, -self.low[:, None], np.ones((len(least), 1), np.float32)], axis=1)
        # Queries, rows and rough scores.
        self.hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def note(self, who: np.ndarray, rows: np.ndarray, scores: np.ndarray) -> None:
        if not len(who):
            return
        self.hits.append((who.astype(np.int32), self.table.order[rows], scores))
        self.noted += len(who)
        if self.noted > self.full:
            self.hits = self.block.best(self.hits, self.batch, self.most)
            self.noted = sum(len(x[0]) for x in self.hits)
            self.full = self.noted + FINDS
            self.low = self.block.least[self.batch].astype(np.float32) - np.float32(ROUGH)
            self.wide[:, -2] = -self.low

    def singly(self, who: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        """Each of these queries meets its own run of rows."""
        table, counts = self.table, last - first
        ends = np.cumsum(counts)
        start = 0
        while start < len(who):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] - counts[start] + PAIRS_AT_ONCE, "right")))
            few = counts[start:stop]
            asks = np.repeat(who[start:stop], few)
            rows = np.arange(few.sum()) + np.repeat(first[start:stop] - np.cumsum(few) + few, few)
            scores = np.einsum("ij,ij->i", self.vectors[asks], table.coarse[rows].astype(np.float32))
            scores *= table.scales[rows]
            near = np.flatnonzero(scores >= self.low[asks] - table.slacks[rows])
            self.note(asks[near], rows[near], scores[near])
            start = stop

    def within(self, radius: np.ndarray, level: int, who: np.ndarray, first: int, last: int, prefix: int) -> None:
        """Every bucket of the rows `first` to before `last`, which share the axes of the hashes before, that
        lags no farther than `radius`."""
        table, lag = self.table, self.lags[level]
        axis = table.codes[first:last] // table.base ** (table.hashes - level - 1) - prefix * table.base
        starts = np.concatenate([[0], np.flatnonzero(np.diff(axis)) + 1])
        there, starts, ends = axis[starts], first + starts, first + np.append(starts[1:], len(axis))
        if level + 1 < table.hashes:
            for at, start, end in zip(there.tolist(), starts.tolist(), ends.tolist(), strict=True):
                lagging = lag[at] if len(who) == lag.shape[1] else lag[at, who]
                go = np.flatnonzero(lagging <= radius)
                if len(go):
                    left = radius[go] - lagging[go]
                    self.within(left, level + 1, who[go], start, end, prefix * table.base + at)
            return
        near = (lag[there] if len(there) < table.base else lag).take(who, axis=1) <= radius
        asks = near.ravel().nonzero()[0]
        cuts = np.searchsorted(asks, np.arange(len(there) + 1) * len(who))
        if last - first < FEW_ROWS * len(there):
            at = np.repeat(np.arange(len(there)), np.diff(cuts))
            self.singly(who[asks - at * len(who)], starts[at], ends[at])
            return
        # How far a score is above what a query wants, if all that the codes are off is in its favour.
        mine = self.wide[who]
        theirs = np.empty((last - first, mine.shape[1]), np.float32)
        np.multiply(table.coarse[first:last], table.scales[first:last, None], out=theirs[:, :-2])
        theirs[:, -2], theirs[:, -1] = 1, table.slacks[first:last]
        for i, (one, other, start, end) in enumerate(
            zip(cuts[:-1].tolist(), cuts[1:].tolist(), (starts - first).tolist(), (ends - first).tolist(), strict=True)
        ):
            if one == other:
                continue
            # All of these queries meet all rows of the bucket.
            here = asks[one:other] - i * len(who)
            for at in range(0, len(here), 1 << 14):
                few = here[at : at + (1 << 14)]
                some = max(1, PRODUCTS // len(few))
                for row in range(start, end, some):
                    self.meet(who, few, mine, theirs, first, row, min(row + some, end))

    def meet(
        self, who: np.ndarray, here: np.ndarray, mine: np.ndarray, theirs: np.ndarray, first: int, start: int, end: int
    ) -> None:
        asked = mine.take(here, axis=0)
        above = asked @ theirs[start:end].T
        if above.max() < 0:
            return
        best = above.max(axis=1)
        some = (best >= 0).nonzero()[0]
        if len(some) * 2 > len(here) and end - start > CROWDED:
            # A crowd that the codes do not tell apart.
            if self.most is not None:
                above[above < np.partition(above, -self.most, axis=1)[:, -self.most, None]] = -1
            else:
                above += self.finer(who[here], asked, theirs, first, start, end)
        at, row = (above[some] >= 0).nonzero()
        asking, rows = who[here[some[at]]], first + start + row
        slacks = self.table.slacks[rows]
        self.note(asking, rows, above[some[at], row] - asked[some[at], -2] - slacks)

    def finer(self, who: np.ndarray, asked: np.ndarray, theirs: np.ndarray, first: int, start: int, end: int):
        """What the second bytes and what these queries know by now add to how far scores are above."""
        block, table = self.block, self.table
        rows = table.order[first + start : first + end]
        fine = block.fine[rows] * (table.scales[first + start : first + end, None] / np.float32(FINER))
        added = asked[:, :-2] @ fine.T
        added += block.rests[rows] - theirs[start:end, -1]
        added -= (self.low[who] + asked[:, -2])[:, None]
        return added


class Block:
    """The packed rows of a block, and the queries that come to it in batches."""

    def __init__(
        self, rows: pa.Table, queries: pa.Table, dim: int, tables: int, hashes: int, seed: int, keep: int
    ):
        self.dim, self.tables, self.hashes, self.seed, size = dim, tables, hashes, seed, padded_size(dim)
        self.base, self.keep = 2 * size, keep
        if "fine" in rows.column_names:
            self.fine = unpacked(rows, "fine", np.int8).reshape(-1, dim)
            self.rests = unpacked(rows, "rests", np.float32)
        self.coarse = [np.frombuffer(x.as_buffer(), np.int8).reshape(-1, dim) for x in rows.column("coarse")]
        self.starts = np.cumsum([0, *map(len, self.coarse)])
        self.scales, self.slacks = unpacked(rows, "scales", np.float32), unpacked(rows, "slacks", np.float32)
        self.codes = unpacked(rows, "codes", code_type(size, hashes)).reshape(-1, tables)
        self.firsts = unpacked(rows, "firsts", np.int64)
        self.keys, self.least = unpacked(queries, "queries", np.int64), unpacked(queries, "leasts", np.float64).copy()
        self.vectors = unpacked(queries, "vectors", np.float32).reshape(-1, dim)
        step = max(256, BATCH_LAGS // self.base)
        self.batches = [slice(start, start + step) for start in range(0, len(self.keys), step)]

    def lags(self, vectors: np.ndarray, table: int) -> list[np.ndarray]:
        first, lags = table * self.hashes, []
        if self.base <= 512:
            padded = np.zeros((self.base // 2, len(vectors)), np.float32)
            padded[: self.dim] = vectors.T
            matrices = turning(self.base // 2, self.tables * self.hashes, self.seed)
            lines = (matrix.T.astype(np.float32) @ padded for matrix in matrices[first : first + self.hashes])
        else:
            turned = rotations(vectors, first + self.hashes, self.seed, first)
            lines = (line.T.astype(np.float32, order="C") for line in turned)
        for line in lines:
            most = np.abs(line).max(axis=0)
            lags.append(np.concatenate([(most - line) ** 2, (most + line) ** 2]))
        return lags

    def look(self, radius: np.ndarray, tables: int, most: int | None) -> list[list]:
        """What every batch meets in the first tables, as far as (queries, tables) of `radius` says: all that
        may be among the best that score the least, or of a query the first `most`; these raise its least."""
        hits: list[list] = [[] for _ in self.batches]
        for number in range(tables):
            table = Table(self, number)
            for batch, mine in zip(self.batches, hits, strict=True):
                looking = Look(self, table, self.lags(self.vectors[batch], number), batch, most)
                # What rounding may add to a sum of lags.
                far = radius[batch, number] + np.float32(1e-5)
                looking.within(far, 0, np.arange(len(far)), 0, len(table.codes), 0)
                mine += looking.hits
                if most is not None or sum(len(x[0]) for x in mine) > FINDS:
                    mine[:] = self.best(mine, batch, most)
        return hits

    def finer(self, vectors: np.ndarray, who: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Scores by both bytes of a component."""
        scores = np.empty(len(who))
        chunks = np.searchsorted(self.starts, rows, "right") - 1
        order = np.argsort(chunks, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(chunks[order])) + 1):
            chunk = int(chunks[part[0]])
            for at in range(0, len(part), PAIRS_AT_ONCE):
                few = part[at : at + PAIRS_AT_ONCE]
                theirs = self.coarse[chunk][rows[few] - self.starts[chunk]] + self.fine[rows[few]] * np.float32(1 / FINER)
                scores[few] = np.einsum("ij,ij->i", vectors[who[few]], theirs) * self.scales[rows[few]]
        return scores

    def best(self, hits: list, batch: slice, most: int | None) -> list:
        """Of hits those that matter, each pair once, which raise the least of their queries."""
        if not hits:
            return []
        who, rows, scores = (np.concatenate(x) for x in zip(*hits, strict=True))
        _, once = np.unique(who.astype(np.int64) * len(self.slacks) + rows, return_index=True)
        who, rows, scores = who[once], rows[once], scores[once]
        if not len(who):
            return []
        off = self.slacks[rows] + ROUGH
        if most is None:
            scores, off = self.finer(self.vectors[batch], who, rows), self.rests[rows] + ROUGH
        order = np.lexsort((off - scores, who))
        who, rows, scores, off = who[order], rows[order], scores[order], off[order]
        if most is None:
            # Several vectors may share an id: the last of `keep` ids bounds what can matter.
            ids, which = np.unique(self.firsts[rows], return_inverse=True)
            new = np.sort(np.unique(who.astype(np.int64) * len(ids) + which, return_index=True)[1])
            last = new[place_in_run(who[new]) == self.keep - 1]
        else:
            few = place_in_run(who) < most
            who, rows, scores, off = who[few], rows[few], scores[few], off[few]
            last = np.flatnonzero(place_in_run(who) == most - 1)
        whose = batch.start + who[last]
        self.least[whose] = np.maximum(self.least[whose], (scores - off)[last])
        if most is None:
            good = scores + off >= self.least[batch.start + who]
            who, rows, scores = who[good], rows[good], scores[good]
        return [(who, rows, scores)]


def place_in_run(values: np.ndarray) -> np.ndarray:
    """How many of the values before are of the same run of equal ones."""
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])[: len(values)])
    return np.arange(len(values)) - np.repeat(starts, np.diff(np.append(starts, len(values))))


def near_in_tile(
    queries: pa.Table, rows: pa.Table, tables: int, hashes: dict[int, int], seed: int, keep: int, most: int | None
) -> pa.Table:
    """What queries meet in a block, each with a score that it is not below: of every query the first
    `most`, or without that all that may be among the `keep` first ids and score its least."""
    if not queries.num_rows or not rows.num_rows:
        return NEAR.empty_table()
    dim = rows.column("dim")[0].as_py()
    block = Block(rows, queries, dim, tables, hashes[padded_size(dim)], seed, keep)
    radius = unpacked(queries, "radii", np.float32).reshape(-1, tables)
    if most is not None and (block.least == ANY).any():
        # Its own buckets tell a query which scores are worth noting.
        block.look(np.zeros_like(radius), min(2, tables), most)
    keys = unpacked(rows, "keys", np.int64)
    out = [NEAR.empty_table()]
    for batch, hits in zip(block.batches, block.look(radius, tables, most), strict=True):
        for who, at, scores in block.best(hits, batch, most):
            # A score it is not below.
            sure = scores - block.slacks[at].astype(float) - ROUGH
            out.append(pa.table([block.keys[batch.start + who], keys[at], block.firsts[at], sure], schema=NEAR))
    return pa.concat_tables(out)


def best_of_all(queries: pa.Table, block: pa.Table, keep: int) -> pa.Table:
    """The `keep` nearest ids of a block for each query."""
    out: list[tuple] = []
    if not queries.num_rows or not block.num_rows:
        return FOUND.empty_table()
    q, x = matrix_of(queries), matrix_of(block)
    keys, ids = queries.column("query").to_pylist(), block.column("ids").to_pylist()
    q_size, x_size = np.sqrt((q * q).sum(axis=1)), np.sqrt((x * x).sum(axis=1))
    x_unit = (x / x_size[:, None]).T
    for start in range(0, len(q), 256):
        rough = (q[start : start + 256] / q_size[start : start + 256, None]) @ x_unit
        least = rough.min(axis=1)
        if keep < len(x):
            least = np.partition(rough, len(x) - keep, axis=1)[:, len(x) - keep]
        for row, (line, bound) in enumerate(zip(rough, least, strict=True), start):
            near = np.flatnonzero(line >= bound - TIE)
            score = (x[near] * q[row]).sum(axis=1) / (x_size[near] * q_size[row])
            found = sorted(
                (-s, vec_id) for s, at in zip(score.tolist(), near.tolist(), strict=True) for vec_id in ids[at]
            )
            out.extend((keys[row], vec_id, -s) for s, vec_id in found[:keep])
    return found_table(out)


def meet_all(queries: DataFrame, index: DataFrame, keep: int) -> DataFrame:
    """Best ids for queries among all vectors of their length, block by block."""
    sizes = index.groupBy("dim").agg(F.count("*").alias("rows"))
    asked = queries.groupBy("dim").agg(F.count("*").alias("asked"))
    cuts = cut(
        sizes.join(asked, "dim").select(
            "dim",
            F.ceil(F.col("rows") / BLOCK_ROWS).alias("blocks"),
            F.ceil(F.col("asked") / BLOCK_QUERIES).alias("parts"),
        )
    )

    def dealt_out(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        """Tiles of a row: its own block or part, and all of the other side's."""
        numbers = F.sequence(F.lit(0).cast("bigint"), F.col(other) - F.lit(1))
        return (
            require(df, cuts, ["dim"], split_hot=True)
            .withColumn(f"{own}_at", F.pmod(F.xxhash64(key), F.col(own)))
            .withColumn(f"{other}_at", F.explode(numbers))
        )

    tile = ["dim", "blocks_at", "parts_at"]

    def grouped(df: DataFrame, *columns: str):
        # Aliases tell the columns of the two sides, which share a source, apart.
        return df.select(*(F.col(c).alias(c) for c in (*tile, *columns))).groupBy(*tile)

    return (
        grouped(dealt_out(queries, "query", "parts", "blocks"), "query", "vector")
        .cogroup(grouped(dealt_out(index, "key", "blocks", "parts"), "ids", "vector"))
        .applyInArrow(
            lambda q, x: best_of_all(q, x, keep), "query bigint, vec_id bigint, score double"
        )
    )


@F.arrow_udf(DoubleType())
def cosine(first: pa.Array, second: pa.Array) -> pa.Array:
    scores = np.empty(len(first))
    for (at, a), (_, b) in zip(by_length(first), by_length(second), strict=True):
        scores[at] = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
    return pa.array(scores)


def nearest(found: DataFrame, by: str, k: int) -> DataFrame:
    """The first k of every query, ranked; an id met in several buckets counts once."""
    once = found.groupBy(by, "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k)


def prepared(vectors: DataFrame, is_query: Column, k: int, vec_id: str, vector: str):
    """Index of distinct vectors; distinct query vectors; the vectors of every query id."""
    rows = vectors.where(proper(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(vector).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.xxhash64(vector).alias("_hash"),
    )
    # Only vectors whose hash comes again can be equal to others; where these are few, the rest are not
    # shuffled.
    again = stored(rows.groupBy("_hash").count().where("count > 1").select("_hash"))
    single, several = rows.where(F.lit(False)), rows
    if again.count() <= FEW_AGAIN:
        single, several = rows.join(again, "_hash", "left_anti"), rows.join(again, "_hash", "left_semi")
    alone = single.select("vector", F.array("vec_id").alias("ids"), "asks", F.lit(True).alias("alone"))
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    distinct = cut(several.groupBy("vector", "vec_id").agg(F.max("asks").alias("asks")))
    asked = distinct.where("asks").select("vector", F.col("vec_id").alias("query_id"))
    copies = cut(
        distinct.select("vector", "vec_id")
        .withColumn("_place", place)
        .where(F.col("_place") <= k + 1)
        .groupBy("vector")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .join(asked.select("vector").distinct().withColumn("asks", F.lit(True)), "vector", "left")
        .select("vector", "ids", F.coalesce("asks", F.lit(False)).alias("asks"), F.lit(False).alias("alone"))
    )
    # This is read again from the input where it is needed.
    index = (
        alone.unionByName(copies)
        .withColumn("key", F.xxhash64("vector", F.col("ids")[0]))
        .withColumn("dim", F.size("vector"))
    )
    asking = cut(index.where("asks"))
    queries = asking.select(F.col("key").alias("query"), "vector", "dim")
    named = cut(
        asking.where("alone")
        .select(F.col("ids")[0].alias("query_id"), "key", "dim")
        .unionByName(
            asked.join(asking.where("not alone").select("vector", "key", "dim"), "vector").select(
                "query_id", "key", "dim"
            )
        )
    )
    return index, queries, named


def answers(found: DataFrame, named: DataFrame, k: int) -> DataFrame:
    """The k nearest other ids of every query id, from what its vectors found."""
    best = nearest(found, "query", k + 1).select("query", "vec_id", "score")
    other = named.join(best, F.col("key") == F.col("query")).where("query_id <> vec_id")
    return nearest(other, "query_id", k)


def padded_bits() -> Column:
    """Vectors are padded to two to this power."""
    return F.greatest(F.length(F.bin(F.col("dim").cast("bigint") - 1)), F.lit(1))


def by_bits(values: dict[int, object]) -> Column:
    """The value of a row's padded length, given by its power of two."""
    cases = [F.when(padded_bits() == bits, value) for bits, value in values.items()]
    return F.coalesce(*cases) if cases else F.lit(None).cast("int")


class Index:
    """Hashed vectors, with the number of hashes and of tiles that follow from how many there are."""

    def __init__(self, index: DataFrame, tables: int, probes: int, seed: int, recall: float):
        self.index, self.tables, self.seed, self.recall = index, tables, seed, recall
        # Of padded lengths there are few.
        counts = index.groupBy(padded_bits().alias("bits")).count().collect()
        self.rows = {row["bits"]: row["count"] for row in counts}
        self.hashes = {bits: bucket_hashes(1 << bits, rows) for bits, rows in self.rows.items()}
        self.first = {bits: probes * PROBES_GROW ** (n - 1) for bits, n in self.hashes.items()}
        self.blocks = {
            bits: max(-(-rows // TILE_ROWS), min(TILES, -(-rows // PLACE_ROWS))) for bits, rows in self.rows.items()
        }
        self.by_size = {1 << bits: n for bits, n in self.hashes.items()}
        packer = row_packer(tables, self.by_size, {1 << bits: n for bits, n in self.blocks.items()}, seed)
        rows = index.select("key", F.col("ids")[0].alias("first"), "dim", "vector")
        self.packed = cut(rows.mapInArrow(packer, ddl(ROWS_PACKED)))

    def met(self, asking: DataFrame, keep: int, most: bool) -> DataFrame:
        """(query, key, vec_id, score) of what queries meet in the first `stop` buckets of every table, a
        score that it is not below, and the smallest id of the vector: all that may score `least`, or
        with `most` only some of the first `keep`, which for vectors in many blocks are few a block."""
        parts = max(1, -(-asking.count() // TILE_QUERIES))
        tables, hashes, seed = self.tables, self.by_size, self.seed
        few = min(keep, 2 + 2 * keep // max(self.blocks.values(), default=1)) if most else None
        packed = asking.select("query", "dim", "vector", "least", "stop").mapInArrow(
            query_packer(tables, hashes, parts, seed), ddl(QUERIES_PACKED)
        )
        zero = F.lit(0).cast("bigint")
        blocks = by_bits({bits: F.lit(n).cast("bigint") for bits, n in self.blocks.items()})
        asks = packed.withColumn("block", F.explode(F.sequence(zero, blocks - 1)))
        # What only tells near ones from each other is not shuffled where that is not asked.
        rows = (self.packed.drop("fine", "rests") if most else self.packed).withColumn("part", F.explode(F.sequence(zero, F.lit(parts - 1).cast("bigint"))))
        tile = ["dim", "block", "part"]
        return (
            asks.groupBy(*tile)
            .cogroup(rows.groupBy(*tile))
            .applyInArrow(lambda q, x: near_in_tile(q, x, tables, hashes, seed, keep, few), ddl(NEAR))
        )

    def scored(self, pairs: DataFrame, queries: DataFrame) -> DataFrame:
        """(query, vec_id, score) with the exact score, for every id of the vectors met."""
        asked = queries.select("query", F.col("vector").alias("asked"))
        both = pairs.select("query", "key").join(asked, "query").join(self.index.select("key", "ids", "vector"), "key")
        exact = both.select("query", "ids", cosine("asked", "vector").alias("score"))
        return exact.select("query", F.explode("ids").alias("vec_id"), "score")

    def few_probes(self) -> Column:
        """Probes a table that give a first score."""
        return by_bits({bits: F.lit(-(-n // 4)) for bits, n in self.first.items()})

    def first_probes(self) -> Column:
        return by_bits({bits: F.lit(n) for bits, n in self.first.items()})

    def needs(self, named: DataFrame, first: DataFrame, k: int) -> DataFrame:
        """named and `need`: the probes a table that every query's k-th score found asks for."""
        step = F.least(F.floor(F.col("least") * STEPS), F.lit(STEPS - 1)).cast("int")
        steps = {
            bits: F.get(
                F.array(*map(F.lit, probes_needed(1 << bits, n, self.tables, self.rows[bits], self.recall))), step
            )
            for bits, n in self.hashes.items()
        }
        unknown = (F.coalesce("got", F.lit(0)) < k) | (F.col("least") < 0)
        got = first.groupBy("query_id").agg(F.count("*").alias("got"), F.min("score").alias("least"))
        need = F.when(unknown, F.lit(WHOLE)).otherwise(F.coalesce(by_bits(steps), F.lit(WHOLE)))
        return named.join(got, "query_id", "left").withColumn("need", need)

    def compared(self, queries: DataFrame, start: Column, stop: Column) -> int:
        """How many comparisons the probes of queries cost."""
        tables, hashes, seed = self.tables, self.by_size, self.seed

        @F.arrow_udf("array<bigint>")
        def looked(vectors: pa.Array, starts: pa.Array, stops: pa.Array) -> pa.Array:
            found = bucket_lists(vectors, np.asarray(starts), np.asarray(stops), tables, hashes, seed)
            return pa.array(found, pa.list_(pa.int64()))

        own = self.index.select("dim", F.explode(looked("vector", F.lit(0), F.lit(1))).alias("bucket"))
        sizes = own.groupBy("dim", "bucket").agg(F.count("*").alias("rows"))
        probes = queries.select("dim", F.explode(looked("vector", start, stop)).alias("bucket"))
        return probes.join(sizes, ["dim", "bucket"]).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def from_buckets(
    hashed: Index, queries: DataFrame, named: DataFrame, k: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Answers from the buckets alone, the ids of the queries that those don't suffice for, and the
    probes a table that every query has looked into."""


    def best(found: DataFrame) -> DataFrame:
        return cut(nearest(found, "query", k + 1).select("query", "vec_id", "score"))

    def further(known: DataFrame, stops: DataFrame) -> DataFrame:
        after = stops.select(F.col("query").alias("key"), "stop")
        return known.join(after, "key", "left").select(*named.columns, F.coalesce("stop", "done").alias("done"))

    buckets_of = by_bits(
        {
            bits: F.lit(min((2 << bits) ** n, max(hashed.rows[bits], 2 << bits)))
            for bits, n in hashed.hashes.items()
        }
    )
    known = named.withColumn("done", hashed.few_probes())
    # Its own copies a query knows already.
    found = hashed.index.where("asks and not alone").select(
        F.col("key").alias("query"), F.explode("ids").alias("vec_id"), F.lit(1 - ROUGH).alias("score")
    )
    asking = queries.withColumns({"stop": hashed.few_probes(), "least": F.lit(ANY)})
    while True:
        more = hashed.met(asking, k + 1, most=True).select("query", "vec_id", "score")
        found = best(found.unionByName(more))
        judged = cut(hashed.needs(known, answers(found, named, k), k))
        # A first score from few buckets may be low: those that seem to need all look further first.
        wide = F.col("done") * 4
        low = (F.col("got") >= k) & (F.col("need") > wide * 4) & (wide * hashed.tables < buckets_of)
        wider = cut(
            judged.where(low)
            .groupBy(F.col("key").alias("query"))
            .agg(F.max(wide).alias("stop"), F.min("least").alias("least"))
        )
        if wider.isEmpty():
            break
        asking, known = queries.join(wider, "query"), further(known, wider)
    most = F.greatest("done", hashed.first_probes())
    stop = F.when(F.col("need") < WHOLE, F.greatest(F.col("need"), most)).otherwise(most)
    wanted, exact = judged.where(F.col("got") >= k).withColumn("stop", stop), None
    while True:
        stops = cut(
            wanted.groupBy(F.col("key").alias("query")).agg(F.max("stop").alias("stop"), F.min("least").alias("least"))
        )
        if exact is not None and stops.isEmpty():
            break
        known = further(known, stops)
        scored = hashed.scored(cut(hashed.met(queries.join(stops, "query"), k + 1, most=False)), queries)
        exact = best(scored if exact is None else exact.unionByName(scored))
        first = cut(answers(exact, named, k))
        judged = cut(hashed.needs(known, first, k))
        # Exact scores are above those that a query was known to reach, so that it may need fewer buckets.
        wanted = judged.where((F.col("need") > F.col("done")) & (F.col("need") < WHOLE)).withColumn("stop", F.col("need"))
    short = judged.where(F.col("need") > F.col("done")).select("query_id").distinct()
    looked = queries.join(known.groupBy(F.col("key").alias("query")).agg(F.max("done").alias("stop")), "query")
    return first, short, looked


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    tables: int = TABLES,
    probes: int = PROBES,
    seed: int = SEED,
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest other rows of every row with `is_query`."""
    index, queries, named = prepared(vectors, is_query, k, vec_id, vector)
    hashed = Index(index, tables, probes, seed, recall)
    first, short, _ = from_buckets(hashed, queries, named, k)
    if short.isEmpty():
        whole = first
    else:
        again = queries.join(
            named.join(short, "query_id").select(F.col("key").alias("query")).distinct(), "query", "left_semi"
        )
        rest = answers(meet_all(again, index, k + 1), named, k).join(short, "query_id", "left_semi")
        whole = first.join(short, "query_id", "left_anti").unionByName(rest)
    return whole.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
