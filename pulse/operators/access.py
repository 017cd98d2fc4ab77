"""Accesses by the owner of a site and by others."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.operators.enrich import key_pairs


def flag_owner(owner: Column, actor: Column) -> Column:
    """Three-valued: null where there is no owner."""
    return owner == actor


def split_counts(
    df: DataFrame,
    keys: Sequence[str],
    flag: str,
    *,
    when_true: str,
    when_false: str,
    weight: str | None = None,
) -> DataFrame:
    """Rows per key where the flag is true and where it is false, in one aggregate; a null flag
    counts in neither but keeps its key. `weight` names a count of rows already grouped."""
    if weight is None:
        picked = {when_true: F.count_if(flag), when_false: F.count_if(~F.col(flag))}
    else:
        zero = F.lit(0).cast("bigint")
        picked = {
            when_true: F.sum(F.when(F.col(flag), F.col(weight)).otherwise(zero)),
            when_false: F.sum(F.when(~F.col(flag), F.col(weight)).otherwise(zero)),
        }
    return df.groupBy(*keys).agg(*(count.alias(out) for out, count in picked.items()))


def member_counts(
    df: DataFrame,
    keys: Sequence[str],
    actor: str,
    owner: str,
    flag: str,
    weight: str,
    *,
    when_true: str,
    when_false: str,
) -> DataFrame:
    """`split_counts` per actor and key, for the actors that are owners anywhere in `df`.

    Every row stands once for its actor, with its counts, and once for its owner, without. Both
    are counted down by key in every task, so the rows are read and shuffled once; an actor's keys and
    its mark as an owner then meet in a window of a few rows."""
    zero = F.lit(0).cast("bigint")
    hit, n = F.col(flag), F.col(weight)
    as_actor = F.struct(
        F.col(actor).alias(actor),
        *(F.col(key).alias(key) for key in keys),
        F.lit(False).alias("__owns"),
        F.when(hit, n).otherwise(zero).alias(when_true),
        F.when(~hit, n).otherwise(zero).alias(when_false),
    )
    as_owner = F.struct(
        F.col(owner).cast(df.schema[actor].dataType).alias(actor),
        *(F.lit(None).cast(df.schema[key].dataType).alias(key) for key in keys),
        F.lit(True).alias("__owns"),
        zero.alias(when_true),
        zero.alias(when_false),
    )
    sides = df.select(F.inline(F.array(as_actor, as_owner))).filter(F.col(actor).isNotNull())
    counted = sides.groupBy(actor, *keys, "__owns").agg(
        F.sum(when_true).alias(when_true), F.sum(when_false).alias(when_false)
    )
    owns = F.max("__owns").over(Window.partitionBy(actor))
    return (
        counted.withColumn("__is_owner", owns)
        .filter(F.col("__is_owner") & ~F.col("__owns"))
        .select(*keys, actor, when_true, when_false)
    )


def pivot_values(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    values: Mapping[object, str] | Sequence[object],
    measure: Callable[[Column], Column] | None = None,
    *,
    fill: object | None = None,
    outside: str = "drop",
) -> DataFrame:
    """One row per key, with a column for each of the given values, in one aggregate.

    `values` maps a value of `column` to the name of its column, or lists values that name
    themselves; None stands for null. `measure` makes the aggregate from the condition that a row
    has the value: by default the count of such rows; `first_where(...)` and `sum_where(...)` give others.
    `fill` replaces a null result. A value that is not given is dropped (its key stays), counted under
    `other` (`outside="other"`), or an error when the plan runs (`outside="error"`)."""
    names = dict(values) if isinstance(values, Mapping) else {
        value: "null" if value is None else str(value) for value in values
    }
    if outside not in ("drop", "other", "error"):
        raise ValueError(f"unknown rule for other values: {outside!r}")
    measure = measure or F.count_if
    kind = df.schema[column].dataType
    hits = {
        name: F.col(column).eqNullSafe(F.lit(value).cast(kind)) for value, name in names.items()
    }
    clash = set(keys) & (set(hits) | ({"other"} if outside == "other" else set()))
    if clash:
        raise ValueError(f"columns of values named like keys: {sorted(clash)}")
    known = reduce(lambda a, b: a | b, hits.values(), F.lit(False))
    if outside == "error":
        message = F.concat(F.lit(f"unexpected {column}: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
        df = df.withColumn(column, F.when(known, F.col(column)).otherwise(F.raise_error(message).cast(kind)))
    if outside == "other":
        hits["other"] = ~known
    picked = {name: measure(hit) for name, hit in hits.items()}
    if fill is not None:
        picked = {name: F.coalesce(found, F.lit(fill)) for name, found in picked.items()}
    return df.groupBy(*keys).agg(*(found.alias(name) for name, found in picked.items()))


def sum_where(column: str) -> Callable[[Column], Column]:
    """The sum of a column over the rows that fit; null without any."""
    return lambda hit: F.sum(F.when(hit, F.col(column)))


def first_where(column: str, order: Sequence[str] = ()) -> Callable[[Column], Column]:
    """The value of a column in the first row that fits, by `order` and then by the value itself, so
    that it does not depend on the layout of the input; null without any."""
    ranked = F.struct(*(F.col(name) for name in (*order, column)))
    return lambda hit: F.min(F.when(hit & F.col(column).isNotNull(), ranked))[column]


def keep_members(df: DataFrame, members: DataFrame, on: str | dict[str, str]) -> DataFrame:
    """Rows whose key occurs among the members; null never does. The members are reduced to
    their distinct values first and never leave the cluster."""
    ((key, member),) = key_pairs(on).items()
    wanted = members.select(F.col(member).alias("__member")).distinct()
    return df.join(wanted, F.col(key) == F.col("__member"), "left_semi")
