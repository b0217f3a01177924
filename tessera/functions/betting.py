"""Scores, value columns, buy rule and settlement as Columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Default selection thresholds, stakes and the uncertainty step-down.
THRESHOLDS = {"min_expected_value_place": 1.05, "min_value_gap": 0.03,
              "min_bet_score": 0.02, "max_model_uncertainty": 0.10}
STAKES = {"high": 1000, "mid": 500, "low": 300}
STEP_DOWN_ABOVE = 0.06
STEP_DOWN = {1000: 500, 500: 300, 300: 100}
STEP_DOWN_OTHER = 100
MIN_ODDS = 1.01


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clip(x, lo=None, hi=None) -> Column:
    """Null-preserving clip (``greatest``/``least`` skip nulls, so guard)."""
    x = _c(x)
    y = x
    if lo is not None:
        y = F.greatest(y, F.lit(lo))
    if hi is not None:
        y = F.least(y, F.lit(hi))
    return F.when(x.isNotNull(), y)


def market_prob(odds) -> Column:
    """``1 / max(odds, 1.01)``; null odds stay null."""
    return F.when(_c(odds).isNotNull(), 1.0 / F.greatest(_c(odds), F.lit(MIN_ODDS)))


def value_columns(prob, odds, uncertainty) -> dict[str, Column]:
    """P10: market probability, expected value, gap and bet score."""
    m = clip(market_prob(odds), 0.0, 1.0)
    ev = _c(prob) * _c(odds)
    gap = _c(prob) - m
    score = gap * ev * (1 - clip(uncertainty, 0.0, 1.0))
    return {"market_place_prob": m, "expected_value_place": ev, "value_gap": gap, "bet_score": score}


def buy_rule(ev, gap, score, unc, t=THRESHOLDS) -> Column:
    """All four thresholds; a null operand is a SKIP."""
    cond = ((_c(ev) >= t["min_expected_value_place"]) & (_c(gap) >= t["min_value_gap"])
            & (_c(score) >= t["min_bet_score"]) & (_c(unc) <= t["max_model_uncertainty"]))
    return F.coalesce(cond, F.lit(False))


def step_down(stake) -> Column:
    """1000->500, 500->300, 300->100, anything else -> 100."""
    s = _c(stake)
    expr = None
    for k, v in STEP_DOWN.items():
        expr = F.when(s == k, F.lit(v)) if expr is None else expr.when(s == k, F.lit(v))
    return expr.otherwise(F.lit(STEP_DOWN_OTHER))


def row_mean(cols) -> Column:
    """P16 simple average; missing scores are skipped."""
    cs = [_c(c) for c in cols]
    n = reduce(lambda a, b: a + b, [F.when(c.isNotNull(), 1).otherwise(0) for c in cs])
    s = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cs])
    return F.when(n > 0, s / n)


def row_weighted(cols, weights) -> Column:
    """P16 weighted average with weights normalised to sum 1 (no skipping)."""
    if len(cols) != len(weights):
        raise ValueError("one weight per column")
    total = float(sum(weights))
    if total <= 0:
        raise ValueError("the weights add up to nothing")
    return reduce(lambda a, b: a + b, [_c(c) * (w / total) for c, w in zip(cols, weights)])


def row_std(cols) -> Column:
    """P16 population standard deviation across columns (null inputs skipped)."""
    m = row_mean(cols)
    cs = [_c(c) for c in cols]
    n = reduce(lambda a, b: a + b, [F.when(c.isNotNull(), 1).otherwise(0) for c in cs])
    ss = reduce(lambda a, b: a + b, [F.coalesce((c - m) * (c - m), F.lit(0.0)) for c in cs])
    return F.when(n > 0, F.sqrt(ss / n))


def settle_columns(stake, payout, hit) -> dict[str, Column]:
    """return = stake * payout / 100 on a hit, else 0; profit = return - stake."""
    ret = F.when(_c(hit), _c(stake).cast("double") * F.coalesce(_c(payout).cast("double"), F.lit(0.0)) / 100.0
                 ).otherwise(F.lit(0.0))
    return {"return_amount": ret, "profit": ret - _c(stake).cast("double")}
