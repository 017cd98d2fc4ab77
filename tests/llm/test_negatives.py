"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.llm import negatives
from pulse.llm.queries import QUERIES

from .conftest import SMALL

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows, asks, n_positives=5, n_negatives=5, low=80, high=100):
    """Rows of the result by the words of the contract."""
    distinct = {
        (i, label, tuple(v))
        for i, label, v in rows
        if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x * 256) for x in v)
    }
    whole = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in distinct]
    result = []
    for i, label, v in whole:
        if not asks(i):
            continue
        scored = sorted(
            (-min(max(sum(map(int.__mul__, v, w)), -(2**63)), 2**63 - 1), j, other == label)
            for j, other, w in whole if j != i and len(w) == len(v)
        )
        for p, positive, _ in [s for s in scored if s[2]][:n_positives]:
            fitting = [(s, j) for s, j, same in scored if not same and -low * p <= -100 * s <= -high * p]
            for rank, (s, j) in enumerate(fitting[:n_negatives], 1):
                result.append((i, positive, rank, j, -p, -s))
    return sorted(result)


def found(df):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.select(*columns).collect()))


def random_rows(seed, n, dim, labels=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dim)
    x = rng.normal(size=(n, dim)) + centre
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i, int(rng.integers(labels)), [float(c) for c in v]) for i, v in enumerate(x)]


@pytest.mark.parametrize("dim", [1, 8, 100])
def test_random_vectors_in_blocks(spark, dim):
    rows = random_rows(dim, 300, dim)
    df = spark.createDataFrame(rows, SCHEMA)
    result = negatives.mine(df, F.col("vec_id") % 10 == 0, block_components=40 * dim)
    expected = brute(rows, lambda i: i % 10 == 0)
    assert expected
    assert found(result) == expected


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    shifted = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"]) for r in rows]
    assert found(QUERIES["op11_hard_negatives"](spark, SMALL)) == brute(shifted, lambda i: i % 100 == 0)


def test_odd_vectors_ties_copies_and_names(spark):
    base = [0.5, -0.25, 1.0]
    rows = [(i, i % 2, base) for i in range(30)]
    rows += [(i, i % 2, base) for i in range(10)]
    rows += [(10, 0, [1.0, 0.0, 0.0]), (10, 1, [0.0, 1.0, 0.0]), (11, 1, [0.9, 0.1, 0.2])]
    rows += [(40, None, base), (None, 0, base), (41, 0, None), (42, 0, [float("nan")] * 3), (43, 1, [None, 1.0, 1.0])]
    rows += [(44, 1, [float("-inf"), 0.0, 0.0]), (45, 1, [1.7e308, 0.0, 0.0]), (50, 0, []), (51, 1, []), (52, 0, [])]
    rows += [(60, 0, [1.0, 2.0]), (61, 0, [-1.0, -2.0]), (62, 1, [0.0, 0.0]), (63, 0, [0.0, 0.0]), (70, 0, [0.0] * 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    clashing = df.withColumns({name: F.lit("x") for name in ("code", "anchor", "asks", "rank", "row_block", "vector")})
    expected = brute(rows, lambda i: i % 10 == 0)
    assert expected
    assert set(found(negatives.mine(clashing, F.col("vec_id") % 10 == 0))) == set(expected)


def test_huge_components_are_exact_or_at_the_end_of_long(spark):
    rows = [(i, i % 2, [1e9 + i, -3e8 * i, 7.25]) for i in range(12)]
    rows += [(100 + i, i % 2, [1e200, 1e200, float(i)]) for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = brute(rows, lambda i: i % 10 == 0)
    assert expected
    assert found(negatives.mine(df, F.col("vec_id") % 10 == 0)) == expected


def test_few_rows(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.5, 0.0]), (2, 0, [0.5, 0.1])]
    df = spark.createDataFrame(rows, SCHEMA)
    asks = F.col("vec_id") % 100 == 0
    assert found(negatives.mine(df, asks)) == brute(rows, lambda i: i % 100 == 0) != []
    assert found(negatives.mine(df.where("vec_id < 2"), asks)) == []
    assert found(negatives.mine(df.limit(0), asks)) == []


@pytest.mark.parametrize("dim", [3, 64, 300])
def test_intervals_hold_the_score_and_drop_rows(dim):
    rng = np.random.default_rng(dim)
    x = negatives.integers(rng.normal(size=(2000, dim)) / math.sqrt(dim))
    rows, anchors = negatives.Codes.of(x, negatives.ROW_LEVELS), negatives.Codes.of(x[:20], negatives.ANCHOR_LEVELS)
    low, high = negatives.intervals(anchors, rows)
    scores = x[:20] @ x.T
    assert (low <= scores).all() and (scores <= high).all()
    wanted = [negatives.reaching(a, b, 5) for a, b in zip(low, high, strict=True)]
    for line, kept in zip(scores, wanted, strict=True):
        assert kept[np.argsort(-line)[:5]].all()
    if dim == 64:
        assert np.mean(wanted) < 0.02


def test_codes_survive_arrow():
    x = negatives.integers(np.random.default_rng(2).normal(size=(7, 70)))
    codes = negatives.Codes.of(x, 3)
    back = negatives.Codes.read(codes.arrays())
    for name in ("bits", "alignments", "norm", "coded", "rest"):
        assert np.array_equal(getattr(codes, name), getattr(back, name))
