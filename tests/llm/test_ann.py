"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.llm import ann
from pulse.llm.queries import QUERIES

from .conftest import SMALL

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, asks, k=5):
    good = [
        (i, np.array(v, float)) for i, v in rows if v and all(x is not None for x in v) and np.isfinite(v).all() and any(v)
    ]
    result = {}
    for i, v in good:
        if asks(i):
            scores = sorted(
                (-round(float(v @ w / np.sqrt((v @ v) * (w @ w))), 12), j) for j, w in good if j != i and len(w) == len(v)
            )
            result[i] = [(j, -s) for s, j in scores[:k]]
    return result


def found(df):
    result = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        result.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 12)))
        assert r["rank"] == len(result[r["query_id"]])
    return result


def test_recall_and_scores(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    expected = brute(rows, lambda i: i % 50 == 0)
    result = found(QUERIES["op8_nearest"](spark, SMALL))
    assert set(result) == set(expected)
    hits = sum(len({j for j, _ in result[i]} & {j for j, _ in expected[i]}) for i in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))
    by_id = {i: np.array(v, float) for i, v in rows}
    for i, near in result.items():
        assert len(near) == 5
        for j, score in near:
            a, b = by_id[i], by_id[j]
            assert score == pytest.approx(a @ b / np.sqrt((a @ a) * (b @ b)), abs=1e-12)


def recall_of_buckets(df, rows, asks, target=ann.RECALL):
    """Of the answers from buckets alone the recall; the share of queries that those don't suffice
    for; and the share of the table that a query is compared with."""
    index, queries, named = ann.prepared(df, F.col("vec_id") % 50 == 0, 5, "vec_id", "embedding")
    hashed = ann.Index(index, ann.TABLES, ann.PROBES, ann.SEED, target)
    first, short, looked = ann.from_buckets(hashed, queries, named, 5)
    result, left = found(first), {r["query_id"] for r in short.collect()}
    expected = {i: near for i, near in brute(rows, asks).items() if i not in left}
    hits = sum(len({j for j, _ in result[i]} & {j for j, _ in near}) for i, near in expected.items())
    asked = named.select("query_id").distinct().count()
    compared = hashed.compared(looked, F.lit(0), F.col("stop")) / (queries.count() * index.count())
    return hits / max(1, sum(map(len, expected.values()))), len(left) / asked, compared


def clustered(n, dim, seed, queries):
    """Random unit vectors; each of the first queries has eight neighbours at cosine 0.42 to 0.5."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(queries):
        for j in range(1, 9):
            side = x[50 * q + j] - (x[50 * q + j] @ x[50 * q]) * x[50 * q]
            score = rng.uniform(0.42, 0.5)
            x[50 * q + j] = score * x[50 * q] + np.sqrt(1 - score**2) * side / np.linalg.norm(side)
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x.astype(np.float32))]
    return [(i, v) for i, v in rows if i % 50 or i < 50 * queries]


@pytest.mark.parametrize("dim", [64, 256, 768])
def test_recall_from_buckets_by_length(spark, dim):
    """Neighbours at cosine 0.42 to 0.5 among random vectors; the buckets give the answers."""
    rows = clustered(3000, dim, dim, 40)
    recall, short, _ = recall_of_buckets(spark.createDataFrame(rows, SCHEMA), rows, lambda i: i % 50 == 0)
    assert recall >= 0.9
    assert short <= 0.1


@pytest.mark.parametrize("size, target, most_short", [("sf0.001", 0.93, 0.3), ("sf0.1", ann.RECALL, 0.1)])
def test_recall_from_buckets(spark, size, target, most_short):
    """Of 500 vectors with no near ones, most queries have to look at all to reach the usual target."""
    df = spark.read.parquet(SMALL.replace("sf0.001", size) + "/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    recall, short, _ = recall_of_buckets(df, rows, lambda i: i % 50 == 0, target)
    assert recall >= 0.9
    assert short <= most_short


def test_the_share_compared_falls_as_rows_grow(spark):
    shares = []
    for n in (2000, 20_000):
        rows = clustered(n, 64, n, 40)
        recall, short, compared = recall_of_buckets(spark.createDataFrame(rows, SCHEMA), rows, lambda i: i % 50 == 0)
        assert recall >= 0.9 and short <= 0.1
        shares.append(compared)
    assert shares[1] < 0.6 * shares[0]


@pytest.mark.parametrize("hashes", [1, 2, 3])
def test_probes_come_in_the_order_of_their_lag(hashes):
    rng = np.random.default_rng(hashes)
    x = rng.normal(size=(5, 4))
    found = ann.buckets(x, 2, hashes, 40, 3)
    turned = list(ann.rotations(x, 2 * hashes, 3))
    base = 8
    for row in range(5):
        for table in range(2):
            both = [np.concatenate([t[row], -t[row]]) for t in turned[table * hashes : (table + 1) * hashes]]
            lags = {}
            for choice in np.ndindex(*[base] * hashes):
                code = table * base**hashes + int(np.ravel_multi_index(choice, [base] * hashes))
                lags[code] = sum((b.max() - b[c]) ** 2 for b, c in zip(both, choice))
            best = sorted(lags.values())[: found.shape[2]]
            mine = found[row, table].tolist()
            assert len(set(mine)) == len(mine)
            assert np.allclose([lags[code] for code in mine], best)


def test_hashes_grow_with_the_rows():
    assert [ann.joined_hashes(64, n) for n in (0, 500, 2000, 10_000, 100_000, 1_000_000)] == [1, 1, 1, 2, 2, 3]


def test_odd_vectors_ties_and_copies(spark):
    rng = np.random.default_rng(4)
    base = [float(x) for x in rng.normal(size=8).astype(np.float32)]
    rows = [(i, base) for i in range(0, 40)] + [(100 + i, [2 * x for x in base]) for i in range(3)]
    rows += [(200, None), (201, []), (202, [0.0] * 8), (203, [float("nan")] * 8), (204, [float("inf")] + [1.0] * 7)]
    rows += [(205, [None] + [1.0] * 7), (300, [1.0, 2.0, 3.0]), (350, [3.0, 2.0, 1.0]), (301, [1.0, 0.0, 0.0])]
    rows += [(400 + i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(30)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(ann.search(df, F.col("vec_id") % 50 == 0)) == brute(rows, lambda i: i % 50 == 0)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 7)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(ann, "PLACE_ROWS", 11)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=4).astype(np.float32)]) for i in range(120)]
    df = spark.createDataFrame(rows, SCHEMA)
    result = found(ann.search(df, F.col("vec_id") % 5 == 0, tables=2, probes=8))
    assert result == brute(rows, lambda i: i % 5 == 0)


def test_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    asks = F.col("vec_id") % 50 == 0
    assert found(ann.search(df, asks)) == brute(rows, lambda i: i % 50 == 0)
    assert found(ann.search(df.where("vec_id = 0"), asks)) == {}
    assert found(ann.search(df.limit(0), asks)) == {}


def test_rotation_keeps_lengths():
    x = np.random.default_rng(6).normal(size=(5, 13))
    for turned in ann.rotations(x, 2, 1):
        assert turned.shape == (5, 16)
        assert np.allclose(np.linalg.norm(turned, axis=1), 1)


def test_vectors_are_dealt_into_blocks_once(spark):
    """However many tables there are, the index goes to tasks as less than its vectors take."""
    rows = clustered(3000, 64, 3, 10)
    index, _, _ = ann.prepared(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, 5, "vec_id", "embedding")
    packed = ann.Index(index, 16, ann.PROBES, ann.SEED, ann.RECALL).packed.collect()
    assert sum(len(row["keys"]) // 8 for row in packed) == len(rows)
    assert sum(len(value) for row in packed for value in row if isinstance(value, bytes)) < 4 * 64 * len(rows)


def test_crowds_of_near_copies_in_tiles(spark, monkeypatch):
    """Vectors that the first byte of a component does not tell apart, in many small tiles and products."""
    for name, value in {"TILE_ROWS": 300, "TILE_QUERIES": 9, "PRODUCTS": 512, "FINDS": 100, "BATCH_LAGS": 1}.items():
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1000, 16))
    x[:700] = x[0] + 0.02 * rng.normal(size=(700, 16))
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x.astype(np.float32))]
    result = found(ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0))
    expected = brute(rows, lambda i: i % 50 == 0)
    assert set(result) == set(expected)
    near = [i for i in expected if i < 700]
    hits = sum(len({j for j, _ in result[i]} & {j for j, _ in expected[i]}) for i in near)
    assert hits >= 0.9 * 5 * len(near)
