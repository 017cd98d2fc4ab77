"""Equi joins by column name.

No join carries a broadcast hint: Spark broadcasts a side whose estimated or measured size is
under `spark.sql.autoBroadcastJoinThreshold` and shuffles otherwise. A hot key on the left is
split by adaptive execution where both sides come straight from a shuffle; `split_hot` makes
them do so. The right side of a left join cannot be split, so rows that may pile up on one key
there go through `attach_many` or `cover`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One column name for both sides, several of them, or {left name: right name}.
Keys = str | Iterable[str] | Mapping[str, str]


def key_pairs(on: Keys) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    if isinstance(on, Mapping):
        return dict(on)
    return {name: name for name in on}


def _width_free(kind: T.DataType) -> T.DataType:
    return T.LongType() if isinstance(kind, T.IntegralType) else kind


def _hashable_alike(left: DataFrame, right: DataFrame, pairs: Mapping[str, str]) -> bool:
    """Whether equal keys have equal hashes: one type on both sides, up to the width of integers,
    and no floating point, where two zeros are equal."""
    kinds = {
        a: (_width_free(left.schema[a].dataType), _width_free(right.schema[b].dataType))
        for a, b in pairs.items()
    }
    return all(x == y and not isinstance(x, T.FractionalType) for x, y in kinds.values())


def _key_hash(df: DataFrame, keys: Iterable[str]) -> Column:
    return F.xxhash64(*(F.col(key).cast(_width_free(df.schema[key].dataType)) for key in keys))


def _join(
    left: DataFrame, right: DataFrame, on: Keys, how: str, split_hot: bool = False
) -> DataFrame:
    """The columns of `left`, then those of `right` but for its keys. `=` semantics: a null key
    matches nothing."""
    pairs = key_pairs(on)
    brought = []
    if how in ("inner", "left"):
        brought = [name for name in right.columns if name not in pairs.values()]
        clash = set(left.columns) & set(brought)
        if clash:
            raise ValueError(f"columns on both sides, rename them first: {sorted(clash)}")
    if split_hot and _hashable_alike(left, right, pairs):
        # The hash says nothing the keys do not say, but no side is partitioned by it yet.
        left = left.withColumn("__hash", _key_hash(left, pairs))
        right = right.withColumn("__hash", _key_hash(right, pairs.values()))
        return _join(left, right, {**pairs, "__hash": "__hash"}, how).drop("__hash")
    renamed = {b: a for a, b in pairs.items() if a != b}
    if renamed:
        right = right.withColumnsRenamed(renamed)
    joined = left.join(right, list(pairs), how)
    # A join on names puts the keys first.
    in_order = left.columns[: len(pairs)] == list(pairs)
    return joined if in_order else joined.select(*left.columns, *brought)


def require(
    left: DataFrame, right: DataFrame, on: Keys, *, split_hot: bool = False
) -> DataFrame:
    """Inner join: rows of `left` without a partner are dropped.

    With `split_hot` both sides are shuffled for this join alone, even where the right side is
    partitioned by the key already, being the result of a join or a grouping on it.
    """
    return _join(left, right, on, "inner", split_hot)


def require_chain(df: DataFrame, steps: Iterable[tuple[DataFrame, Keys]]) -> DataFrame:
    """Inner joins along a hierarchy, each step using columns the one before brought in."""
    return reduce(lambda acc, step: require(acc, *step), steps, df)


def lookup(
    left: DataFrame, right: DataFrame, on: Keys, *, prefix: str = "", split_hot: bool = False
) -> DataFrame:
    """Left join; `prefix` names the role of the right side in its columns. `split_hot` as in
    `require`."""
    if prefix:
        keep = set(key_pairs(on).values())
        right = right.withColumnsRenamed(
            {name: f"{prefix}{name}" for name in right.columns if name not in keep}
        )
    return _join(left, right, on, "left", split_hot)


def _alone(left: DataFrame, rows: DataFrame, on: Keys) -> DataFrame:
    """Rows of `left` without a partner. The keys of `rows` are reduced to their distinct values
    before they are shuffled."""
    present = rows.select(*key_pairs(on).values()).distinct()
    return _join(left, present, on, "left_anti")


def attach_many(spine: DataFrame, rows: DataFrame, on: Keys) -> DataFrame:
    """Left join for a right side with many rows per key, any key of which may be hot.

    Same rows as a left join, written as the inner join, where a hot key of `rows` can be split,
    plus the spine rows without a partner.
    """
    alone = _alone(spine, rows, on)
    return require(spine, rows, on).unionByName(alone, allowMissingColumns=True)


def cover(rows: DataFrame, spine: DataFrame, key: str) -> DataFrame:
    """`rows` plus one row, null but for its key, for every key of `spine` they lack.

    An inner join with covered rows keeps the whole spine. Several such sides can be joined to
    one spine without a left join, in which a hot key of theirs could not be split.
    """
    return rows.unionByName(_alone(spine.select(key), rows, key), allowMissingColumns=True)
