"""Language model: counts and base score by the book, classes that help on held-out texts."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulse.llm import lm
from pulse.llm.queries import QUERIES

from .conftest import SMALL

TINY = lm.Settings(lookup_words=20, unit_words=12, ending_units=8, classes=6, rounds=4)


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def plain(rows):
    lines = [(d, [*(t or "").encode().lower().split(), b"\n"]) for d, t in rows]
    counts = Counter(w for d, line in lines if not is_held_out(d) for w in line)
    total, kinds = sum(counts.values()), len(counts)
    expected = []
    for doc_id, line in lines:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in line)
        known = sum(w in counts for w in line)
        expected.append((repr(doc_id), is_held_out(doc_id), len(line), known, total, round(base, 6)))
    return sorted(expected)


def got(rows):
    return sorted(
        (repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
        for r in rows
    )


def train_and_score(docs, settings=lm.Settings()):
    return lm.score(docs, lm.train(docs.where(~lm.held_out(F.col("doc_id"))), settings=settings)).collect()


def test_query(spark, docs):
    rows = QUERIES["op3_class_lm"](spark, SMALL).collect()
    assert got(rows) == plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    held = [r for r in rows if r["held_out"]]
    tokens = sum(r["n_tokens"] for r in held)
    assert sum(r["score"] for r in held) / tokens > sum(r["base_score"] for r in held) / tokens


def test_odd_texts_by_join_and_lookup(make_docs, odd_texts):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "null id"), (3, "one"), (3, "one"), (3, "two")]
    found = train_and_score(make_docs([(i, t, "s") for i, t in rows]), TINY)
    assert got(found) == plain(rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_nothing_to_learn_from(make_docs):
    held = next(i for i in range(50) if is_held_out(i))
    rows = [(held, "some words"), (held, None)]
    assert got(train_and_score(make_docs([(i, t, "s") for i, t in rows]), TINY)) == plain(rows)
    assert train_and_score(make_docs([]), TINY) == []


def score_by_the_book(model, rows):
    """Scores from the model's classes alone: transitions and emissions are counted here."""
    settings = model.settings
    codes = model.codes()
    class_of = {lm.END: 0}
    lines = []
    for doc_id, text in rows:
        line = [w if len(w) <= lm.MAX_WORD_BYTES else lm.short_name(w) for w in (text or "").encode().lower().split()]
        lines.append((doc_id, [*line, lm.END]))
        class_of |= {w: codes[w] % settings.classes for w in line}
    counts, size, moves = Counter(), Counter(), Counter()
    for doc_id, line in lines:
        if not is_held_out(doc_id):
            counts.update(line)
            size.update(class_of[w] for w in line)
            moves.update(zip([0, *(class_of[w] for w in line)], (class_of[w] for w in line)))
    kinds, before = Counter(class_of[w] for w in counts), Counter()
    for (a, _), n in moves.items():
        before[a] += n
    mass, expected = settings.transition_mass, []
    for doc_id, line in lines:
        total, last = 0.0, 0
        for w in line:
            c = class_of[w]
            total += math.log10((moves[last, c] + mass) / (before[last] + mass * settings.classes))
            total += math.log10((counts[w] + 0.5) / (size[c] + 0.5 * (kinds[c] + 1)))
            last = c
        expected.append((repr(doc_id), round(total, 6)))
    return sorted(expected)


@pytest.mark.parametrize("settings", [TINY, lm.Settings(lookup_words=500, unit_words=100, ending_units=16, classes=9)])
def test_scores_by_the_book(docs, make_docs, odd_texts, settings):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()][:80] + [(1000 + i, t) for i, t in enumerate(odd_texts)]
    table = make_docs([(i, t, "s") for i, t in rows])
    model = lm.train(table.where(~lm.held_out(F.col("doc_id"))), settings=settings)
    found = sorted((repr(r["doc_id"]), round(r["score"], 6)) for r in lm.score(table, model).collect())
    assert found == score_by_the_book(model, rows)


def test_emissions_and_moves_sum_to_one(docs):
    model = lm.train(docs, settings=TINY)
    assert np.allclose((10 ** lm.smoothed(model.transitions, TINY)).sum(axis=1), 1)
    counts = {bytes(r["word"]): r["n"] for r in model.counts.collect()}
    size, kinds, codes = np.zeros(6), np.zeros(6), model.codes()
    for word, n in counts.items():
        cls = 0 if word == lm.END else codes[word] % 6
        size[cls] += n
        kinds[cls] += 1
    assert np.array_equal(model.sizes, size)
    assert np.array_equal(model.kinds, kinds)


def test_the_lookup_table_is_full_however_flat_the_counts(spark):
    rows = [(f"word{i}".encode(), 1) for i in range(30_000)] + [(b"often", 9), (lm.END, 100)]
    counts = spark.createDataFrame(rows, "word binary, n long")
    words = lm.frequent_words(counts, 5000)
    assert 4900 < len(words) <= 5000
    assert next(iter(words)) == b"often" and lm.END not in words
    assert lm.frequent_words(counts.repartition(5), 5000) == words
    assert len(lm.frequent_words(counts, 50_000)) == 30_001
    assert lm.frequent_words(counts, 0) == {}


def test_a_flat_corpus_gets_classes(make_docs):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(6)), "s") for i in range(300)]
    settings = lm.Settings(lookup_words=500, unit_words=100, ending_units=8, classes=5)
    model = lm.train(make_docs(rows), settings=settings)
    assert len(model.looked_up) > 400
    assert len(set(model.word_classes[:100])) > 1
    assert len(set(model.word_classes[100:])) > 1


def test_long_words_are_looked_up_and_told_apart(make_docs):
    long = ["=" * 500, "=" * 499 + "é", "x" * 70_000]
    rows = [(i, " ".join(long + ["short"]) + " " + long[i % 3]) for i in range(40)]
    table = make_docs([(i, t, "s") for i, t in rows])
    model = lm.train(table, settings=TINY)
    assert len(model.looked_up) == 4
    assert max(map(len, model.looked_up)) <= lm.MAX_WORD_BYTES
    found = train_and_score(table, TINY)
    assert got(found) == plain(rows)


def test_words_join_the_class_of_their_neighbours(make_docs):
    """Frequent words alternate between two kinds; rare ones stand where one kind does."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        line = [f"{'ab'[j % 2]}{rng.integers(5)}" for j in range(40)]
        line[2 * int(rng.integers(20))] = f"q{i % 50}z"
        line[2 * int(rng.integers(20)) + 1] = f"r{i % 50}z"
        rows.append((i, " ".join(line), "s"))
    settings = lm.Settings(lookup_words=200, unit_words=10, ending_units=4, classes=4, rounds=6)
    codes = lm.train(make_docs(rows), settings=settings).codes()
    kinds = [Counter(codes[f"{kind}{i}z".encode()] % 4 for i in range(50)).most_common(1)[0] for kind in "qr"]
    assert kinds[0][0] != kinds[1][0]
    assert min(kinds[0][1], kinds[1][1]) >= 45


def test_ids_of_any_type_and_clashing_names(make_docs):
    rows = [(i, f"word{i % 7} and more") for i in range(60)]
    table = make_docs([(i, t, "s") for i, t in rows]).selectExpr(
        "concat('doc', doc_id) as doc_id", "text", "'x' as word", "1 as n", "'y' as key", "2 as tokens", "'z' as text_hash"
    )
    found = lm.score(table, lm.train(table, settings=TINY)).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(f"doc{i}" for i, _ in rows)


def likelihood(table):
    f = lm.xlogx
    return f(table).sum() - f(table.sum(axis=1)).sum() - f(table.sum(axis=0)).sum()


def test_one_exchange_never_lowers_the_likelihood():
    rng = np.random.default_rng(3)
    units, classes_n = 12, 4
    pairs = rng.integers(0, 30, (units, units)).astype(float)
    classes = np.concatenate([[0], 1 + np.arange(units - 1) % (classes_n - 1)])

    def table_of(classes):
        onehot = np.eye(classes_n)[classes]
        return onehot.T @ pairs @ onehot

    for _ in range(4):
        for unit in range(1, units):
            onehot = np.eye(classes_n)[classes]
            beside = np.stack([pairs @ onehot, pairs.T @ onehot])
            moved = lm.exchange(classes, beside, np.diag(pairs), np.array([unit]), classes_n)
            best = max(
                likelihood(table_of(np.where(np.arange(units) == unit, c, classes)))
                for c in range(1, classes_n)
            )
            assert likelihood(table_of(moved)) == pytest.approx(best)
            classes = moved


def test_two_kinds_of_text_get_different_classes(make_docs):
    rng = np.random.default_rng(1)
    left, right = [f"a{i}" for i in range(8)], [f"b{i}" for i in range(8)]
    rows = [(i, " ".join(rng.choice([left, right][i % 2], 60)), "s") for i in range(60)]
    settings = lm.Settings(lookup_words=50, unit_words=40, ending_units=4, classes=4, rounds=6)
    model = lm.train(make_docs(rows), settings=settings)
    kinds = [{model.class_of(w.encode()) for w in words} for words in (left, right)]
    assert not kinds[0] & kinds[1]
