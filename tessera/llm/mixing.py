"""Mixing to target weights by iterative proportional fitting (operator 7),
DataFrame functions only.

Documents fall into cells of their dimensions (source, language, topic). One
pre-aggregated pass counts the tokens per cell; raking then scales the cells'
weights to each dimension's target shares in turn until all marginals hold.
A document of a cell with T tokens and weight w is kept with probability
min(1, scale * w / T), the scale chosen over all cells so that the expected
tokens are ``keep`` of all tokens: cells that can't supply more saturate and
the others make up for them.

A target is a temperature (share proportional to tokens ** temperature) or a
mapping of category to share; categories it doesn't list get nothing. The
random number of a document is the head of MD5(seed and doc_id), so a run can
be repeated and any engine draws the same sample.

Only the cell table is iterated: its size depends on the categories, not on the
documents. A document meets its cell in a join on all dimensions, which is
broadcast only if Spark measures the cell table below its threshold, and is
otherwise split by skew handling.

Defined cases: a null category is the empty category; a null text has no
tokens; a null doc_id draws by its text; repeated rows draw the same number; a
corpus without tokens keeps every row of probability 1; an empty table gives no
rows; other columns are not read by ``assess`` and pass through ``sample``.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import WORD, fresh, quoted, stage, text_of

TOLERANCE = 1e-9
MOST_ROUNDS = 100


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def form_topic(text: Column, words: Column) -> Column:
    """Topic by the form of a text, for tables without a topic column."""
    return (F.when(F.lit(10) * F.regexp_count(text, F.lit(r"\|")) > words, "tabular")
            .when(words < 100, "brief").when(words < 1000, "article").otherwise("long"))


def draw(key: Column, seed: int) -> Column:
    """Uniform number in [0, 1) from the first 52 bits of an MD5."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _described(docs: DataFrame, dims: dict[str, Column], tokens: Column, id_col: str, text_col: str,
               seed: int) -> tuple[DataFrame, str]:
    """(rows with a struct of categories, tokens and random number, its name)."""
    key = F.coalesce(F.col(quoted(id_col)).cast("string"), F.md5(text_of(docs, text_col).cast("binary")))
    own = [F.coalesce(c.cast("string"), F.lit("")).alias(d) for d, c in dims.items()]
    mix = fresh(docs, "_mix")
    return docs.withColumn(mix, F.struct(*own, tokens.alias("n_tokens"), draw(key, seed).alias("draw"))), mix


def target_shares(cells: DataFrame, targets: dict[str, float | dict[str, float]]) -> DataFrame:
    """Adds a column ``t_<dimension>`` with the target share of the cell's category."""
    for d, target in targets.items():
        if isinstance(target, dict):
            total = sum(target.values())
            if not target or min(target.values()) < 0 or not total:
                raise ValueError(f"the shares of {d} must be positive")
            share = F.create_map(*[F.lit(x) for c, s in sorted(target.items()) for x in (c, s / total)])
            cells = cells.withColumn(f"t_{d}", F.coalesce(F.element_at(share, F.col(d)), F.lit(0.0)))
        else:
            own = F.sum("tokens").over(W.partitionBy(d)).cast("double")
            # each cell carries its part of the category's power, so the parts add up to the whole
            part = F.when(own > 0, F.pow(own, F.lit(float(target))) * F.col("tokens") / own).otherwise(F.lit(0.0))
            cells = cells.withColumn(f"p_{d}", part)
            total = F.sum(f"p_{d}").over(W.partitionBy(F.lit(0)))
            cells = (cells.withColumn(f"t_{d}", F.when(total > 0, F.sum(f"p_{d}").over(W.partitionBy(d)) / total).otherwise(F.lit(0.0)))
                     .drop(f"p_{d}"))
    return cells


def rake(cells: DataFrame, dims: list[str], tolerance: float = TOLERANCE, rounds_per_step: int = 2) -> DataFrame:
    """Iterative proportional fitting of ``weight`` (tokens at first) to t_<dimension>."""
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(0, MOST_ROUNDS, rounds_per_step):
        for _ in range(rounds_per_step):
            for d in dims:
                margin = F.sum("weight").over(W.partitionBy(d))
                now = now.withColumn("weight", F.when(margin > 0, F.col("weight") * F.col(f"t_{d}") / margin).otherwise(F.lit(0.0)))
        now = stage(now, "raked")
        worst = now
        for d in dims[:-1]:  # the last one has just been fitted
            margin = F.sum("weight").over(W.partitionBy(d))
            worst = worst.withColumn(f"e_{d}", F.when(margin > 0, F.abs(margin - F.col(f"t_{d}"))).otherwise(F.lit(0.0)))
        errors = [F.max(f"e_{d}") for d in dims[:-1]] or [F.lit(0.0)]
        error = max((e or 0.0) for e in worst.agg(*errors).first())
        if error <= tolerance:
            break
    else:
        warnings.warn(f"raking has not met its targets in {MOST_ROUNDS} rounds: largest error of a share {error:.3g}")
    return now


def probabilities(raked: DataFrame, keep: float) -> DataFrame:
    """Adds ``probability``: min(1, scale * weight / tokens). Every bound
    (budget - tokens of the k first saturated cells) / (weight of the rest) is at
    most the scale, and the right k attains it, so the scale is their maximum."""
    order = W.orderBy(F.expr("tokens / weight"), *[c for c in raked.columns if c not in ("tokens", "weight")])
    before = order.rowsBetween(W.unboundedPreceding, -1)
    used = raked.filter("weight > 0 AND tokens > 0")
    sums = used.agg(F.sum("tokens").alias("all_tokens"), F.sum("weight").alias("all_weight"))
    total = raked.agg(F.sum("tokens").alias("corpus"))
    bounds = (used.withColumn("tokens_before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
              .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
              .select("tokens_before", "weight_before"))
    found = sums.first()
    corpus = total.first()["corpus"] or 0
    if not found["all_tokens"]:
        return raked.withColumn("probability", F.lit(1.0) if not corpus else F.lit(0.0))
    budget = keep * corpus
    if budget >= found["all_tokens"]:
        return raked.withColumn("probability", F.when(F.col("weight") > 0, 1.0).otherwise(0.0))
    rest = F.lit(found["all_weight"]) - F.col("weight_before")
    scale = bounds.filter(rest > 1e-12).agg(F.max((F.lit(budget) - F.col("tokens_before")) / rest)).first()[0]
    share = F.lit(scale) * F.col("weight") / F.col("tokens")
    return raked.withColumn("probability", F.when((F.col("tokens") > 0) & (F.col("weight") > 0), F.least(share, F.lit(1.0)))
                            .otherwise(F.when(F.col("tokens") > 0, 0.0).otherwise(1.0)))


def _mixed(docs, dims, targets, tokens, keep, id_col, text_col, seed):
    """(rows, the struct of ``_described``, the probability of a row's cell)."""
    names = list(dims)
    rows, mix = _described(docs, dims, tokens, id_col, text_col, seed)
    cells = stage(rows.select(f"{mix}.*").groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), "cells")
    fitted = probabilities(rake(target_shares(cells, targets), names), keep)
    key, chance = {d: fresh(rows, f"_m_{d}") for d in names}, fresh(rows, "_p")
    fitted = stage(fitted.select(*[F.col(d).alias(key[d]) for d in names], F.col("probability").alias(chance)), "mix")
    on = [F.col(mix)[d] == F.col(key[d]) for d in names]
    return rows.join(fitted, on, "left"), F.col(mix), F.col(chance)


def assess(docs: DataFrame, dims: dict[str, Column], targets: dict[str, float | dict[str, float]], tokens: Column,
           keep: float, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """One row per row: doc_id, the categories, n_tokens, probability, kept."""
    rows, mix, chance = _mixed(docs, dims, targets, tokens, keep, id_col, text_col, seed)
    return rows.select(F.col(quoted(id_col)).alias("doc_id"), *[mix[d].alias(d) for d in dims], mix["n_tokens"].alias("n_tokens"),
                       chance.alias("probability"), (mix["draw"] < chance).alias("kept"))


def sample(docs: DataFrame, dims: dict[str, Column], targets: dict[str, float | dict[str, float]], tokens: Column,
           keep: float, id_col: str = "doc_id", text_col: str = "text", seed: int = 1) -> DataFrame:
    """The sampled rows, all columns."""
    rows, mix, chance = _mixed(docs, dims, targets, tokens, keep, id_col, text_col, seed)
    return rows.filter(mix["draw"] < chance).select([F.col(quoted(c)) for c in docs.columns])


def oracle(targets: dict[str, float], keep: float, seed: int = 1, rounds: int = 40) -> str:
    """DuckDB SQL for ``assess`` over ``documents`` with temperatures as targets."""
    dims = list(targets)
    shares = ", ".join(f"pow(m_{d}, {t}) * tokens / m_{d} AS p_{d}" for d, t in targets.items())
    steps, last = [], "t0"
    for k in range(rounds):
        for j, d in enumerate(dims):
            now = f"r{k}_{j}"
            steps.append(f"{now} AS MATERIALIZED (SELECT * REPLACE (w * t_{d} / sum(w) OVER (PARTITION BY {d}) AS w) FROM {last})")
            last = now
    keys = ", ".join(dims)
    return f"""
WITH b AS (
  SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_tokens FROM documents),
d AS (
  SELECT *, CASE WHEN 10 * (length(t) - length(replace(t, '|', ''))) > n_tokens THEN 'tabular' WHEN n_tokens < 100 THEN 'brief'
                 WHEN n_tokens < 1000 THEN 'article' ELSE 'long' END AS topic,
         CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), md5(t))), 1, 13) AS BIGINT) / pow(2, 52) AS u
  FROM b),
c AS (SELECT {keys}, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM d GROUP BY ALL HAVING sum(n_tokens) > 0),
m AS (SELECT *, {", ".join(f"sum(tokens) OVER (PARTITION BY {d}) AS m_{d}" for d in dims)} FROM c),
q AS (SELECT {keys}, tokens, {shares} FROM m),
t0 AS (SELECT {keys}, tokens, tokens AS w,
  {", ".join(f"sum(p_{d}) OVER (PARTITION BY {d}) / sum(p_{d}) OVER () AS t_{d}" for d in dims)} FROM q),
{", ".join(steps)},
s AS (
  SELECT *, tokens / w AS r, sum(tokens) OVER () AS all_tokens, sum(w) OVER () AS all_weight,
         coalesce(sum(tokens) OVER o, 0) AS tb, coalesce(sum(w) OVER o, 0) AS wb
  FROM {last} WINDOW o AS (ORDER BY tokens / w, {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT max(({keep} * all_tokens - tb) / (all_weight - wb)) AS scale FROM s WHERE all_weight - wb > 1e-12),
f AS (SELECT {keys}, least(1.0, scale * w / tokens) AS p FROM s, k)
SELECT doc_id, {keys}, n_tokens, CAST(round(CAST(p AS DECIMAL(38, 9)), 6) AS DOUBLE) AS probability, u < p AS kept
FROM d LEFT JOIN f USING ({keys})"""
