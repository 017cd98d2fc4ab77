"""Class ladders."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def class_ladder(
    column: Column, steps: Mapping[int, str], default: str, null_label: str | None = None
) -> Column:
    """The label of the first step equal to the value, else `default`. Null falls through to
    `default` unless it has a label of its own."""
    branches = [(column == value, label) for value, label in steps.items()]
    if null_label is not None:
        branches.append((column.isNull(), null_label))
    ladder = F.lit(default)
    for condition, label in reversed(branches):
        ladder = F.when(condition, F.lit(label)).otherwise(ladder)
    return ladder
