"""Registry of named queries over the driver tables and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register a (spark, sf_dir) -> DataFrame callable, with its oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from tessera.plans import (cases_betting, cases_core, cases_decode, cases_features,  # noqa: F401
                               cases_history, cases_ml, cases_refresh, cases_stream, cases_time)


def r6(name: str):
    """Output rounding shared with the oracles: via DECIMAL(38,9), then 6 places."""
    from pyspark.sql import functions as F
    return F.round(F.col(name).cast("decimal(38,9)"), 6).cast("double").alias(name)


def r6sql(sql: str) -> str:
    """Rewrite every ``round(x, 6)`` of an oracle into the same decimal rounding."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 1, j + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + 6:k - 1]
        if not inner.rstrip().endswith(", 6"):
            out.append(sql[i:k])
            i = k
            continue
        expr = inner.rstrip()[:-3]
        out.append(sql[i:j])
        out.append(f"CAST(round(CAST({r6sql(expr)} AS DECIMAL(38,9)), 6) AS DOUBLE)")
        i = k


# Queries checked by row count and invariants only (model fits, streams): the
# driver records a rows-only check for them.
ROWS_ONLY: tuple[str, ...] = ("feature_columns", "train_score", "calibrate", "backtest", "compare_models",
                               "walk_forward", "ablate", "predict_day")
