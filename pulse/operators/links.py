"""Links between devices and their carriers, open until they are removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.operators.enrich import Keys, require


def open_links(links: DataFrame, carriers: DataFrame, on: Keys, removed: str) -> DataFrame:
    """Links without a removal whose carrier exists; several per device are all kept."""
    return require(links.filter(F.col(removed).isNull()).drop(removed), carriers, on)


def link_state(partner: Column, linked: str, unlinked: str) -> Column:
    """Whether a left join found a partner, told by a column that is never null on a match."""
    return F.when(partner.isNull(), F.lit(unlinked)).otherwise(F.lit(linked))


def link_status(removed: Column, active: str, inactive: str) -> Column:
    return F.when(removed.isNull(), F.lit(active)).otherwise(F.lit(inactive))
