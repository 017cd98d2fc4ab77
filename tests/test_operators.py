from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulse import operators as op
from pulse.functions import (
    as_boolean, as_long, as_timestamp, month_key, not_before, shift_hours, stamp,
)

AS_OF = datetime(2025, 3, 10, 12)
DAYS2 = timedelta(hours=48)


def table(spark, **columns):
    return spark.createDataFrame(pa.table(columns))


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda row: tuple((v is None, v) for v in row))


# Joins


@pytest.fixture(scope="module")
def sites(spark):
    return table(spark, site_id=[1, 2, 3], name=["a", "b", "c"])


def test_require_drops_and_multiplies(spark, sites):
    visits = table(spark, site=[1, 1, 9, None], who=["x", "y", "z", "n"])
    joined = op.require(visits, sites, {"site": "site_id"})
    assert joined.columns == ["site", "who", "name"]
    assert rows(joined) == [(1, "x", "a"), (1, "y", "a")]


def test_require_on_two_keys(spark):
    left = table(spark, a=[1, 1, 2], b=[1, 2, 1])
    right = table(spark, a=[1, 1, 2], b=[1, 1, 2], n=[10, 11, 12])
    assert rows(op.require(left, right, ["a", "b"])) == [(1, 1, 10), (1, 1, 11)]


def test_split_hot_changes_no_row(spark, sites):
    visits = table(spark, site=pa.array([1, 1, 9, None], pa.int32()), who=["x", "y", "z", "n"])
    for join in (op.require, op.lookup):
        plain = join(visits, sites, {"site": "site_id"})
        split = join(visits, sites, {"site": "site_id"}, split_hot=True)
        assert split.columns == plain.columns
        assert rows(split) == rows(plain)


def test_split_hot_with_keys_of_two_types_stays_a_plain_join(spark, sites):
    visits = table(spark, site=["1", "9"])
    assert rows(op.require(visits, sites, {"site": "site_id"}, split_hot=True)) == [("1", "a")]
    zeros = table(spark, x=[0.0]), table(spark, y=[-0.0])
    assert op.require(*zeros, {"x": "y"}, split_hot=True).count() == 1


def test_lookup_keeps_rows_and_prefixes_the_role(spark, sites):
    visits = table(spark, site_id=[1, 9, None])
    joined = op.lookup(visits, sites, "site_id", prefix="visited_")
    assert joined.columns == ["site_id", "visited_name"]
    assert rows(joined) == [(1, "a"), (9, None), (None, None)]


def test_joins_refuse_a_column_on_both_sides(spark, sites):
    with pytest.raises(ValueError, match="name"):
        op.lookup(sites, sites, "site_id")


def test_require_chain(spark, sites):
    visits = table(spark, visit=[1, 2], site_id=[1, 3])
    people = table(spark, name=["a"], owner=["o"])
    assert rows(op.require_chain(visits, [(sites, "site_id"), (people, "name")])) == [
        (1, 1, "a", "o")
    ]


def test_attach_many_equals_a_left_join(spark, sites):
    spine = sites.unionByName(table(spark, site_id=[None], name=["none"]))
    visits = table(spark, site=[1, 1, 3, 9, None], who=["x", "y", "z", "w", "n"])
    attached = op.attach_many(spine, visits, {"site_id": "site"})
    left = op.lookup(spine, visits, {"site_id": "site"})
    assert attached.columns == left.columns == ["site_id", "name", "who"]
    assert rows(attached) == rows(left)
    assert len(rows(attached)) == 5


def test_cover_adds_the_missing_keys(spark, sites):
    visits = table(spark, site_id=[1, 1, 9], who=["x", "y", "w"])
    assert rows(op.cover(visits, sites, "site_id")) == [
        (1, "x"), (1, "y"), (2, None), (3, None), (9, "w"),
    ]


# Links and recency


def test_open_links_need_an_existing_carrier(spark):
    links = table(
        spark, carrier=[1, 2, 9, 2], device=[5, 5, 6, 7], removed=[None, None, None, "2024-01-01"]
    )
    carriers = table(spark, carrier=[1, 2], site=[10, 20])
    assert rows(op.open_links(links, carriers, "carrier", "removed")) == [(1, 5, 10), (2, 5, 20)]


def test_link_words(spark):
    df = table(spark, id=[1, 2], partner=[3, None])
    words = df.select(
        op.link_state(F.col("partner"), "linked", "unlinked"),
        op.link_status(F.col("partner"), "open", "closed"),
    )
    assert rows(words) == [("linked", "closed"), ("unlinked", "open")]


TIMES = ["2025-03-08 12:00:00", "2025-03-08 11:59:59", "2025-03-11 00:00:00", None, "bad"]


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz"])
def test_recency_bound_is_inclusive_for_every_time_type(spark, kind):
    df = table(spark, id=[1, 2, 3, 4, 5], seen=TIMES).select(
        "id", F.col("seen").try_cast(kind).alias("seen")
    )
    flag = op.recency_flag(df, "seen", AS_OF, DAYS2, "active", "inactive")
    assert [row[0] for row in df.orderBy("id").select(flag).collect()] == [
        "active", "inactive", "active", "inactive", "inactive",
    ]
    assert rows(op.recent(df, "seen", AS_OF, DAYS2).select("id")) == [(1,), (3,)]


def test_recent_distinct_leaves_out_keys_without_recent_rows(spark):
    df = table(
        spark, site=[1, 1, 1, 2], device=[5, 5, 6, 7],
        seen=["2025-03-10", "2025-03-09", "2025-03-10", "2024-01-01"],
    )
    counted = op.recent_distinct(
        df, ["site"], "device", "n", time="seen", as_of=AS_OF, window=DAYS2
    )
    assert rows(counted) == [(1, 2)]


# Counts


@pytest.fixture(scope="module")
def readings(spark):
    return table(
        spark,
        site=[1, 1, 1, 1, 2, 2, None],
        device=[5, 5, 6, None, None, None, 7],
        fresh=[True, False, False, True, True, None, True],
    )


def test_distinct_by(readings):
    assert rows(op.distinct_by(readings, ["site"], "device", "n")) == [(1, 2), (2, 0), (None, 1)]
    skipped = op.distinct_by(readings, ["site"], "device", "n", skip_null=True)
    assert rows(skipped) == [(1, 2), (None, 1)]


def test_distinct_split_counts_each_condition(readings):
    split = op.distinct_split(
        readings, ["site"], "device", {"n_all": None, "n_fresh": F.col("fresh")}
    )
    assert rows(split) == [(1, 2, 1), (2, 0, 0), (None, 1, 1)]


def test_conditional_counts_skip_null_conditions(readings):
    counts = op.conditional_counts(
        readings, ["site"], {"fresh": F.col("fresh"), "no_device": F.col("device").isNull()}
    )
    assert rows(counts) == [(1, 2, 1), (2, 1, 2), (None, 1, 0)]


def test_attach_metrics_fills_only_the_named_columns(spark, sites):
    metric = table(spark, site_id=[1], n=[4], note=["x"])
    attached = op.attach_metrics(sites, [(metric, "site_id")], ["n"])
    assert rows(attached) == [(1, "a", 4, "x"), (2, "b", 0, None), (3, "c", 0, None)]


# First row per key


def test_first_per_key_needs_an_order(readings):
    with pytest.raises(ValueError):
        op.first_per_key(readings, ["site"], [])


def test_first_per_key_does_not_depend_on_the_layout(spark):
    df = table(
        spark,
        key=[1, 1, 1, 2, 2, 3],
        share=[0.5, 0.7, 0.7, None, 0.1, None],
        name=["a", "c", "b", "d", "e", "f"],
        extra=[1, 2, 3, 4, 5, 6],
    )
    order = [F.col("share").desc_nulls_last()]
    expected = [(1, 0.7, "b", 3), (2, 0.1, "e", 5), (3, None, "f", 6)]
    for layout in (df, df.repartition(7, "extra"), df.orderBy(F.col("name").desc()).coalesce(1)):
        assert rows(op.first_per_key(layout, ["key"], order)) == expected


# Classes and labels


def test_class_ladder_null_takes_the_default_or_its_own_label(spark):
    df = table(spark, n=[0, 1, 2, None])
    steps = {0: "none", 1: "first"}
    plain = op.class_ladder(F.col("n"), steps, "multi")
    own = op.class_ladder(F.col("n"), steps, "multi", null_label="unknown")
    assert rows(df.select("n", plain, own)) == [
        (0, "none", "none"), (1, "first", "first"), (2, "multi", "multi"),
        (None, "multi", "unknown"),
    ]


def test_translate_labels_keeps_rows_and_unknown_text(spark):
    df = table(spark, page=["home", "home", "other", None])
    mapping = table(spark, source=["home", "home", "unused"], target=["inicio", "zzz", "u"])
    assert rows(op.translate_labels(df, "page", mapping, "label")) == [
        ("home", "inicio"), ("home", "inicio"), ("other", "other"), (None, None),
    ]


# Accesses


@pytest.fixture(scope="module")
def flagged(spark):
    df = table(
        spark, month=["a", "a", "a", "b", "b"], user=[1, 1, 1, 2, 1], owner=[1, 1, 2, None, None]
    )
    return df.withColumn("mine", op.flag_owner(F.col("owner"), F.col("user")))


def test_split_counts_keeps_keys_with_null_flags_only(flagged):
    counts = op.split_counts(
        flagged, ["month", "user"], "mine", when_true="own", when_false="other"
    )
    assert rows(counts) == [("a", 1, 2, 1), ("b", 1, 0, 0), ("b", 2, 0, 0)]


def test_weighted_split_counts_equal_row_counts(flagged):
    grouped = flagged.groupBy("month", "user", "mine").agg(F.count(F.lit(1)).alias("n"))
    names = {"when_true": "own", "when_false": "other"}
    plain = op.split_counts(flagged, ["month", "user"], "mine", **names)
    weighted = op.split_counts(grouped, ["month", "user"], "mine", weight="n", **names)
    assert rows(weighted) == rows(plain)
    assert weighted.dtypes == plain.dtypes


def test_keep_members_ignores_null_on_both_sides(spark, flagged):
    people = table(spark, id=[1, 2, 3, None])
    assert rows(op.keep_members(people, flagged, {"id": "owner"})) == [(1,), (2,)]


# Casts and calendar


def test_casts_leave_typed_columns_alone_and_null_bad_text(spark):
    df = table(
        spark, t=["2025-01-01 02:00:00", "2025-01-01T02:00:00+03:00", "bad"],
        b=["true", "maybe", None], n=["12", "x", None],
    )
    cast = df.select(
        as_timestamp(df, "t").alias("t"), as_boolean(df, "b").alias("b"), as_long(df, "n").alias("n")
    )
    assert rows(cast) == [
        (datetime(2024, 12, 31, 23), None, None), (datetime(2025, 1, 1, 2), True, 12),
        (None, None, None),
    ]
    for function, name in ((as_timestamp, "t"), (as_boolean, "b"), (as_long, "n")):
        assert "CAST" not in str(function(cast, name)).upper()


def test_shift_crosses_the_month(spark):
    df = table(spark, t=[datetime(2025, 1, 1, 1), datetime(2025, 1, 1, 3)])
    local = shift_hours(F.col("t"), 3)
    assert rows(df.select(local, month_key(local), stamp(AS_OF))) == [
        (datetime(2024, 12, 31, 22), "2024-12", "2025-03-10"),
        (datetime(2025, 1, 1), "2025-01", "2025-03-10"),
    ]


def test_not_before_does_not_depend_on_the_session_zone(spark):
    df = table(spark, t=[datetime(2025, 1, 1, 1)])
    assert df.filter(not_before(df, "t", datetime(2025, 1, 1, 1))).count() == 1
    assert df.filter(not_before(df, "t", datetime(2025, 1, 1, 1, 1))).count() == 0


# Profiles and comparison


def test_observed_counts_without_another_pass(spark, sites):
    df, rows_seen = op.observed(sites, "sites")
    df.write.format("noop").mode("overwrite").save()
    assert rows_seen.get["n_rows"] == 3


def test_require_rows(caplog):
    assert op.require_rows(3, "full") == 3
    op.require_rows(0, "hollow")
    assert "hollow is empty" in caplog.text
    with pytest.raises(ValueError):
        op.require_rows(0, "hollow", strict=True)


def test_profile_values_and_sample(readings):
    assert rows(op.column_profile(readings, ["site", "device"])) == [(7, 2, 3)]
    assert rows(op.column_values(readings, "site")) == [(1,), (2,), (None,)]
    assert op.sample_rows(readings, 2).count() == 2


def test_compare(spark, sites):
    other = table(spark, site_id=[1, 2, 2], name=["a", "b", "b"], more=[1, 1, 1])
    assert op.shape(other) == (3, 3)
    assert op.schema_diff(sites, other) == (set(), {"more"})
    assert rows(op.row_diff(sites, other)) == [(2, "b", 1, 2), (3, "c", 1, 0)]
    assert op.row_diff(sites, sites).count() == 0


# Profiles, samples, pivots, schemas


def test_profile_of_many_columns(spark):
    zero = spark.sql("""
        select * from values (1, 0.0D, array('a, b'), 'x'), (1, -0.0D, array('a', 'b'), null),
          (2, double('NaN'), null, ''), (null, double('NaN'), array(null), 'x') as t(a, b, c, d)""")
    assert rows(op.column_profile(zero, ["a", "b", "c", "d"])) == [(4, 2, 2, 3, 2)]
    assert set(rows(op.profile_rows(zero, ["a", "c", "d"]))) == {
        ("a", 4, 1, 2, 2), ("c", 4, 1, 3, 1), ("d", 4, 1, 2, 2),
    }
    assert rows(op.column_profile(zero.limit(0), ["a", "b"])) == [(0, 0, 0)]
    assert rows(op.column_profile(zero, [])) == [(4,)]
    plan = op.column_profile(zero, ["a", "b", "c", "d"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_profile_counts_like_count_distinct(spark):
    df = spark.range(5000).selectExpr(
        "id % 7 as a", "if(id % 3 = 0, null, id % 1000 / 8) as b", "cast(id % 11 as string) as c",
        "timestamp_seconds(id % 13) as d", "struct(id % 3 as x, null as y) as e",
    )
    expected = df.agg(*(F.count_distinct(c) for c in df.columns)).first()
    assert rows(op.column_profile(df, df.columns)) == [(5000, *expected)]


def test_samples_do_not_depend_on_the_layout(spark):
    df = spark.range(1000).selectExpr("id % 10 as kind", "id % 50 as value", "id", "map(1, id) as m")
    top = [op.sample_rows(df.repartition(n), 7, [F.col("value").desc()]) for n in (1, 5)]
    assert top[0].collect() == top[1].collect()
    assert [row.id for row in top[0].collect()][:3] == [49, 99, 149]
    assert "TakeOrderedAndProject" in top[0]._jdf.queryExecution().executedPlan().toString()
    few = [op.sample_per_key(df.repartition(n), ["kind"], 2, [F.col("value").desc()]) for n in (1, 5)]
    assert sorted(r.id for r in few[0].collect()) == sorted(r.id for r in few[1].collect())
    assert few[0].count() == 20
    plan = few[1]._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan[plan.index("Exchange hashpartitioning"):]


def test_pivot_rules(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "a", 3), (1, "b", 1), (1, None, 9), (2, "z", 4), (None, "b", 2)],
        "key int, kind string, n int",
    )
    assert set(rows(op.pivot_values(df, ["key"], "kind", ["a", "b"]))) == {(1, 2, 1), (2, 0, 0), (None, 0, 1)}
    named = op.pivot_values(df, ["key"], "kind", {"a": "x", None: "empty"}, outside="other")
    assert named.columns == ["key", "x", "empty", "other"]
    assert set(rows(named)) == {(1, 2, 1, 1), (2, 0, 0, 1), (None, 0, 0, 1)}
    sums = op.pivot_values(df, ["key"], "kind", ["a", "q"], op.sum_where("n"), fill=0)
    assert set(rows(sums)) == {(1, 8, 0), (2, 0, 0), (None, 0, 0)}
    first = op.pivot_values(df, ["key"], "kind", ["a", "b"], op.first_where("n"))
    assert set(rows(first)) == {(1, 3, 1), (2, None, None), (None, None, 2)}
    assert rows(op.pivot_values(df.filter("key = 1 and kind = 'a'"), ["key"], "kind", ["a"], outside="error")) == [(1, 2)]
    with pytest.raises(Exception, match="unexpected kind: z"):
        op.pivot_values(df.filter("key = 2"), ["key"], "kind", ["a"], outside="error").collect()
    for bad in ({"outside": "keep"}, {"values": {"a": "key"}}):
        with pytest.raises(ValueError):
            op.pivot_values(df, ["key"], "kind", **({"values": ["a"]} | bad))
    planned = op.pivot_values(df, ["key"], "kind", ["a"], outside="other")
    plan = planned._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" not in plan


def test_schemas_are_compared_in_depth(spark):
    left = spark.sql("select 1 as a, struct(1 as x, array(struct('s' as t)) as y) as b, map('k', 1) as m")
    right = spark.sql("select 1L as a, struct(1 as x, array(struct(2 as t)) as y) as b, map('k', null) as m, 1 as z")
    found = {path: status for path, _, _, status in op.schema_rows(left.schema, right.schema)}
    assert found == {
        "a": "type", "b": "same", "b.x": "same", "b.y": "same", "b.y[]": "same", "b.y[].t": "type",
        "m": "same", "m[key]": "same", "m[value]": "type", "z": "right",
    }
    nullable = StructType.fromDDL("a int not null")
    assert op.schema_rows(nullable, StructType.fromDDL("a int")) == [("a", "int", "int", "nullable")]
    counts = {r.path: (r.n_left, r.n_right) for r in op.compare_columns(left, right).collect()}
    assert counts["a"] == (1, 1) and counts["z"] == (None, 1) and counts["b.x"] == (None, None)


def test_member_counts_are_those_of_members(spark):
    df = spark.range(3000).selectExpr(
        "id % 5 as month", "if(id % 11 = 0, null, id % 40) as user", "if(id % 7 = 0, null, id % 23 + 20) as owner",
        "id % 3 as n",
    ).withColumn("own", F.col("owner") == F.col("user"))
    names = {"when_true": "t", "when_false": "f"}
    expected = op.keep_members(
        op.split_counts(df, ["month", "user"], "own", weight="n", **names), df, {"user": "owner"}
    )
    found = op.member_counts(df, ["month"], "user", "owner", "own", "n", **names)
    assert sorted(rows(found)) == sorted(rows(expected)) != []
