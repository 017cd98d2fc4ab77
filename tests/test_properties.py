"""Properties of the operators over generated tables."""

from collections import Counter, defaultdict

import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulse import operators as op

few = settings(
    max_examples=8, deadline=None, derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
small = st.one_of(st.none(), st.integers(0, 3))


def tables(**columns):
    return st.lists(st.tuples(*columns.values()), max_size=25)


def frame(spark, names, kinds, data):
    fields = list(zip(names, kinds))
    return spark.createDataFrame(
        pa.Table.from_pylist([dict(zip(names, row)) for row in data], schema=pa.schema(fields))
    )


INT, TEXT, BOOL = pa.int64(), pa.string(), pa.bool_()


@few
@given(data=tables(key=small, rank=small, note=st.sampled_from("abc")), seed=st.integers(0, 9))
def test_first_per_key_is_the_smallest_row_in_any_layout(spark, data, seed):
    df = frame(spark, ["key", "rank", "note"], [INT, INT, TEXT], data)
    order = [F.col("rank").desc_nulls_last()]
    groups = defaultdict(list)
    for key, rank, note in data:
        groups[key].append((rank is None, -(rank or 0), note))
    expected = {key: min(rows) for key, rows in groups.items()}
    for layout in (df, df.orderBy(F.rand(seed)).repartition(3)):
        found = op.first_per_key(layout, ["key"], order).collect()
        assert len(found) == len(groups)
        assert {r.key: (r["rank"] is None, -(r["rank"] or 0), r.note) for r in found} == expected


@few
@given(data=tables(month=st.sampled_from("ab"), user=small, owner=small))
def test_split_counts_add_up(spark, data):
    df = frame(spark, ["month", "user", "owner"], [TEXT, INT, INT], data)
    df = df.withColumn("mine", op.flag_owner(F.col("owner"), F.col("user")))
    found = op.split_counts(df, ["month", "user"], "mine", when_true="own", when_false="other")
    expected = {(month, user): [0, 0] for month, user, _ in data}
    for month, user, owner in data:
        if user is not None and owner is not None:
            expected[month, user][user != owner] += 1
    assert {(r.month, r.user): [r.own, r.other] for r in found.collect()} == expected


@few
@given(left=tables(key=small, note=st.sampled_from("ab")), right=tables(key=small, n=small))
def test_attach_many_and_split_hot_equal_plain_joins(spark, left, right):
    spine = frame(spark, ["key", "note"], [INT, TEXT], left)
    many = frame(spark, ["key", "n"], [INT, INT], right)

    def rows(df):
        return Counter(map(tuple, df.collect()))

    outer = Counter()
    for key, note in left:
        partners = [n for other, n in right if key is not None and other == key]
        outer.update([(key, note, n) for n in partners] or [(key, note, None)])
    assert rows(op.lookup(spine, many, "key")) == outer
    assert rows(op.attach_many(spine, many, "key")) == outer
    assert rows(op.lookup(spine, many, "key", split_hot=True)) == outer


@few
@given(data=tables(site=small, device=small, fresh=st.one_of(st.none(), st.booleans())))
def test_distinct_counts(spark, data):
    df = frame(spark, ["site", "device", "fresh"], [INT, INT, BOOL], data)
    found = op.distinct_split(df, ["site"], "device", {"n": None, "n_fresh": F.col("fresh")})
    expected = {
        site: (
            len({d for s, d, _ in data if s == site and d is not None}),
            len({d for s, d, fresh in data if s == site and d is not None and fresh}),
        )
        for site in {row[0] for row in data}
    }
    assert {r.site: (r.n, r.n_fresh) for r in found.collect()} == expected
    plain = op.distinct_by(df, ["site"], "device", "n")
    assert {r.site: r.n for r in plain.collect()} == {s: n for s, (n, _) in expected.items()}


@few
@given(
    pages=st.lists(st.one_of(st.none(), st.sampled_from("abcd")), max_size=20),
    mapping=tables(source=st.sampled_from("abc"), target=st.sampled_from("xyz")),
)
def test_translation_keeps_every_row(spark, pages, mapping):
    df = frame(spark, ["page"], [TEXT], [(page,) for page in pages])
    table = frame(spark, ["source", "target"], [TEXT, TEXT], mapping)
    best = {}
    for source, target in mapping:
        best[source] = min(target, best.get(source, target))
    found = op.translate_labels(df, "page", table, "label").collect()
    assert Counter(map(tuple, found)) == Counter((page, best.get(page, page)) for page in pages)


@few
@given(spine=st.sets(st.integers(0, 5)), metric=st.dictionaries(st.integers(0, 7), st.integers(1, 9)))
def test_metrics_keep_the_spine(spark, spine, metric):
    sites = frame(spark, ["site"], [INT], [(site,) for site in spine])
    counts = frame(spark, ["site", "n"], [INT, INT], list(metric.items()))
    found = op.attach_metrics(sites, [(counts, "site")], ["n"]).collect()
    assert sorted(map(tuple, found)) == sorted((site, metric.get(site, 0)) for site in spine)


@few
@given(left=tables(a=small, b=st.sampled_from("xy")), right=tables(a=small, b=st.sampled_from("xy")))
def test_row_diff_counts_copies(spark, left, right):
    ours = frame(spark, ["a", "b"], [INT, TEXT], left)
    theirs = frame(spark, ["a", "b"], [INT, TEXT], right)
    n_left, n_right = Counter(left), Counter(right)
    expected = {
        row: (n_left[row], n_right[row]) for row in n_left | n_right if n_left[row] != n_right[row]
    }
    found = op.row_diff(ours, theirs).collect()
    assert {(r.a, r.b): (r.n_left, r.n_right) for r in found} == expected
