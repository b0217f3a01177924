"""Outcome targets as Column expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Place slots by field size. A field of 8 or more pays the first
# three, a field of 5 to 7 pays the first two, smaller fields have no target.
PLACE_RULES = ((8, 3), (5, 2))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def slots(size, rules=PLACE_RULES) -> Column:
    """Number of paid slots for a field size, null when no rule applies."""
    size = _c(size)
    expr = None
    for min_size, n in rules:
        expr = F.when(size >= min_size, F.lit(n)) if expr is None else expr.when(size >= min_size, F.lit(n))
    return expr


def place_target(finish, size, rules=PLACE_RULES) -> Column:
    """View rule (P2): 1 if 1 <= finish <= slots, 0 otherwise; null when the finish is
    unknown or the field is too small. Integer typed."""
    finish, size = _c(finish), _c(size)
    n = slots(size, rules)
    return (F.when(finish.isNull(), F.lit(None).cast("int"))
             .when(n.isNull(), F.lit(None).cast("int"))
             .when((finish >= 1) & (finish <= n), F.lit(1))
             .otherwise(F.lit(0)))


def place_hit(finish, size, rules=PLACE_RULES) -> Column:
    """Feature rule (P3): double 1.0/0.0 for finish <= slots (no lower bound), null when
    the finish is missing or the field is too small; text finishes coerce to null."""
    finish = F.expr(f"try_cast({finish} as double)") if isinstance(finish, str) else finish
    size = _c(size)
    n = slots(size, rules)
    return F.when(n.isNotNull() & finish.isNotNull(), (finish <= n).cast("double"))
