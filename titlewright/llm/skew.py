"""Joins by a key of which a few values may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot with more than this part of all rows, so there are fewer hot keys than this, whatever the input.
PARTS = 2048


def keyed_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", n: str = "n") -> DataFrame:
    """left joined with right, whose keys are unique and non-null and whose column n (left out of the result) is how many rows of
    left have the key. Hot keys, fewer than PARTS by their share of the sum, are broadcast, so that their rows stay where they
    are; all others are joined as usual. Both tables are read twice and should be materialised or cheap."""
    total = right.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    limit = total / PARTS
    few = F.broadcast(right.where(F.col(n) > limit).drop(n))
    hot = left.join(few, keys)
    rest = left.join(few.select(*keys), keys, "left_anti").join(right.where(F.col(n) <= limit).drop(n), keys, how)
    return hot.unionByName(rest)
