"""Row-level joins: a one-row aggregate without a join, and a join that matches nulls."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add the columns of the single row of ``row`` to every row of ``df``.

    The row is packed into one struct and read as a scalar subquery, so it is
    computed once and no join is planned; more than one row fails the query
    (the size bound is enforced, not assumed), no row gives nulls."""
    packed = row.select(F.struct(*[F.col(c) for c in row.columns]).alias("__row")).scalar()
    return df.withColumn("__row", packed).select(*df.columns, *[F.col("__row")[c].alias(c) for c in row.columns])


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join that treats nulls in the key as equal: a group keyed by null keeps
    its own summary row."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}" if c in on else c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on])
    return left.join(renamed, same, how).drop(*[f"__r_{c}" for c in on])
