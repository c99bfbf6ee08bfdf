"""Several results in one table, told apart by a tag."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tagged_union(parts: dict[str, DataFrame], tag: str = "kind") -> DataFrame:
    """UNION ALL of differently shaped tables; columns a part lacks are NULL."""
    tagged = (df.select(F.lit(name).alias(tag), *df.columns) for name, df in parts.items())
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def demux_tagged(rows: DataFrame, name: str, columns: list[str], tag: str = "kind") -> DataFrame:
    """One part of a tagged union."""
    return rows.filter(F.col(tag) == name).select(*columns)
