"""Joins the comparisons share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_full_join(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Full outer join on ``key`` in which a null key pairs with a null key:
    the key, then the other columns of both sides."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in key})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return left.join(other, same, "full").select(
        *[F.coalesce(k, f"_{k}").alias(k) for k in key],
        *[c for c in left.columns if c not in key], *[c for c in right.columns if c not in key])
