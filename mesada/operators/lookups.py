"""Equi-join lookups.

No side is hinted. Spark broadcasts a lookup whose size it has checked against
spark.sql.autoBroadcastJoinThreshold, before or during the run, and otherwise sorts and
merges, splitting hot keys of the left side (spark.sql.adaptive.skewJoin.enabled).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = "spread"


def with_spread(df: DataFrame, key: str, by: str | None = None) -> DataFrame:
    """Second join key that scatters rows whose first key is NULL.

    Such rows match nothing, but a shuffle by the key alone sends them all to one task.
    The second key is a function of the first where that is set, so matching rows agree
    on it, and a hash of `by` elsewhere.
    """
    sign = F.shiftright(F.col(key), 63)
    return df.withColumn(SPREAD, F.coalesce(sign, F.xxhash64(by)) if by else sign)


def lookup(
    df: DataFrame, dim: DataFrame, left_key: str, right_key: str, how: str = "inner"
) -> DataFrame:
    """Join one row of `dim` by key and drop the dim's key.

    `dim` is selected down to its key and the wanted columns by the caller, under names
    that do not clash with `df`.
    """
    return df.join(dim, F.col(f"`{left_key}`") == F.col(f"`{right_key}`"), how).drop(right_key)


def bridge_lookup(
    df: DataFrame, bridge: DataFrame, dim: DataFrame, left_key: str, bridge_key: str,
    bridge_ref: str, dim_key: str, how: str = "inner",
) -> DataFrame:
    """J9+J10, J15+J16: two hops through a bridge table.

    The hops are joined to each other first, so the fact side is moved once, not twice.
    A left lookup keeps a bridge row without a target, which adds only NULLs.
    """
    hops = bridge.join(
        dim, F.col(f"`{bridge_ref}`") == F.col(f"`{dim_key}`"), how
    ).drop(bridge_ref, dim_key)
    return lookup(df, hops, left_key, bridge_key, how)
