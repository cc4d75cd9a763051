"""Looking values up by a key that a large part of all rows may share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot that holds at least this part of all rows; so there are at most as many hot keys.
HOT_PART = 1024


def spread_lookup(rows: DataFrame, values: DataFrame, key: str, size: str, n_rows: int) -> DataFrame:
    """``rows`` with the columns of ``values``, which has one row per ``key`` (nulls are one key) and its number of rows in
    ``size``.  The at most ``HOT_PART`` keys with that part of the ``n_rows`` rows are broadcast, so their rows stay
    where they are; the other keys, none of which is large, meet their rows in a shuffle."""
    found, same = values.withColumnRenamed(key, "_key"), F.col(key).eqNullSafe(F.col("_key"))
    hot = found.filter(F.col(size) * HOT_PART >= n_rows)
    near = rows.join(F.broadcast(hot), same).drop("_key", size)
    rest = rows.join(F.broadcast(hot.select("_key")), same, "left_anti")
    return near.unionByName(rest.join(found.filter(F.col(size) * HOT_PART < n_rows), same).drop("_key", size))
