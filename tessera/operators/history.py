"""Leak-free history features: statistics of the rows strictly before each row.

``with_priors`` computes, per entity and in a total order, prior counts (G1),
prior means (G2), prior rolling means over the previous N rows (G3) and the
gap in days to the previous row (G8); an entity key may be widened with
condition columns (G5).

Execution: one shuffle on the entity serves the windows of every key group, since
a group (entity, condition) lies within its entity. An entity with more than
``piece`` rows would be one long task, so it is cut into buckets. ``bucket`` must
be non-decreasing in the order; by default it is the month of the first order
column when that is a date or a timestamp. Rows of such an entity are windowed per
(entity, bucket); each (entity, bucket) is summarised to one row (totals plus the
last ``H`` rows, ``H`` = the largest rolling width), the summaries are scanned per
entity in bucket order, and the offsets are joined back on (entity, bucket).
At most HEAVY entities are cut, the largest ones: any other then has at most
1/HEAVY of all rows, whatever their number, and the list stays bounded.

Nulls: a null entity, condition or bucket is a group like any other (joins are
null-safe), and null order values come last, so an undated row sees the history
and is in nobody's.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from tessera.operators.rows import null_safe_join
from tessera.session import cut_lineage

ColumnLike = "str | Column"
PIECE = 1_000_000  # rows of an entity that one task may hold
HEAVY = 1000       # entities that are cut at most


@dataclass(frozen=True)
class Prior:
    """One history column.

    kind: ``count`` (rows before), ``mean`` (mean of non-null values before),
    ``rolling`` (mean of non-null values among the previous ``n`` rows; a null
    row takes a slot but not the mean), ``gap_days`` (days from the previous
    row's ``value`` date).  ``keys`` widens the entity key (condition history).
    """

    name: str
    kind: str
    value: str | None = None
    n: int | None = None
    keys: tuple[str, ...] = ()

    def __post_init__(self):
        if self.kind not in ("count", "mean", "rolling", "gap_days"):
            raise ValueError(f"unknown prior kind {self.kind!r}")
        if self.kind == "rolling" and (not self.n or self.n < 1):
            raise ValueError("rolling needs n >= 1")
        if self.kind in ("mean", "rolling", "gap_days") and self.value is None:
            raise ValueError(f"{self.kind} needs a value column")


def _sum_type(df: DataFrame, value: str):
    """Decimal inputs stay exact: every partial sum is held at one widened
    decimal type (precision <= 37, so adding two partials keeps the scale);
    doubles are summed as doubles.  The mean divides once, as double."""
    dt = df.schema[value].dataType
    if isinstance(dt, DecimalType):
        return DecimalType(min(37, dt.precision + 10), dt.scale)
    return "double"


def _sum(col: Column, st) -> Column:
    return col.cast(st)


def _mean(s: Column, c: Column) -> Column:
    return F.when(c > 0, s.cast("double") / c)


def default_bucket(df: DataFrame, order: Sequence) -> Column | None:
    """Month of the first order column, if that is a date or a timestamp."""
    first = order[0] if order else None
    if isinstance(first, str) and isinstance(df.schema[first].dataType, (DateType, TimestampType, TimestampNTZType)):
        return F.trunc(F.col(first), "month")
    return None


def heavy_entities(df: DataFrame, entity: Sequence[str], piece: int = PIECE) -> DataFrame | None:
    """The (at most HEAVY) entities with more than ``piece`` rows; None if there is none."""
    sizes = df.groupBy(*entity).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > piece)
    top = sizes.orderBy(F.desc("__n")).limit(HEAVY).drop("__n")
    rows = top.collect()
    return df.sparkSession.createDataFrame(rows, top.schema) if rows else None


def with_priors(df: DataFrame, entity: Sequence[str], order: Sequence, priors: Sequence[Prior],
                bucket: Column | None = None, piece: int = PIECE, sizes: DataFrame | None = None) -> DataFrame:
    """Add one column per ``Prior``; ``order`` must be a total order per entity.
    ``sizes``: a frame with the same rows per entity that costs less to count."""
    entity = list(entity)
    groups: dict[tuple[str, ...], list[Prior]] = {}
    for p in priors:
        groups.setdefault(tuple(entity) + tuple(p.keys), []).append(p)
    bucket = bucket if bucket is not None else default_bucket(df, order)
    order_cols = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    heavy = heavy_entities(df if sizes is None else sizes, entity, piece) if bucket is not None else None
    if heavy is None:
        return _single_level(df, groups, order_cols)
    # read by both parts, and by the windows and the summary of the heavy one
    base = cut_lineage(df)
    same = [F.col(c).eqNullSafe(F.col(f"__h{i}")) for i, c in enumerate(entity)]
    keys = F.broadcast(heavy.toDF(*[f"__h{i}" for i in range(len(entity))]))  # at most HEAVY rows
    light = _single_level(base.join(keys, same, "left_anti"), groups, order_cols)
    base = base.join(keys, same, "left_semi").withColumn("__bkt", bucket)
    out = base
    for i, (keys, ps) in enumerate(groups.items()):
        # the summary reads the cut input, not the columns added so far: the plan
        # grows by one join per key group, and no group is evaluated twice
        out = _segmented(out, base, list(keys), order_cols, ps, f"__g{i}")
    return light.unionByName(out.drop("__bkt"))


def _single_level(df: DataFrame, groups, order_cols) -> DataFrame:
    out = df
    if len(groups) > 1:
        # one hash partitioning on the shared entity key serves every finer
        # (entity, condition) window: one shuffle instead of one per group
        entity = [c for c in next(iter(groups)) if all(c in k for k in groups)]
        common = [c for c in entity if all(k[:len(entity)] == tuple(entity) for k in groups)]
        if common:
            out = out.repartition(*[F.col(c) for c in common])
    # values are cast once, below the windows: the columns of a key group are then one
    # window operator, which reads and holds its rows once
    casts = {v: f"__cast{i}" for i, v in enumerate(dict.fromkeys(
        p.value for ps in groups.values() for p in ps if p.kind in ("mean", "rolling")))}
    out = out.withColumns({name: F.col(v).cast(_sum_type(df, v)) for v, name in casts.items()})
    for keys, ps in groups.items():
        w = Window.partitionBy(*keys).orderBy(*order_cols)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        new = {}
        for p in ps:
            if p.kind == "count":
                new[p.name] = (F.row_number().over(w) - 1).cast("long")
            elif p.kind in ("mean", "rolling"):
                v = F.col(casts[p.value])
                frame = before if p.kind == "mean" else w.rowsBetween(-p.n, -1)
                new[p.name] = _mean(F.sum(v).over(frame), F.count(v).over(frame))
            else:
                d = F.col(p.value)
                new[p.name] = F.datediff(d, F.lag(d).over(w))
        out = out.withColumns(new)
    return out.drop(*casts.values())


def _segmented(df: DataFrame, base: DataFrame, keys: list[str], order_cols, ps: list[Prior], tag: str) -> DataFrame:
    """Two-level scan for one key group; see module docstring."""
    bkt = F.col("__bkt")
    w_in = Window.partitionBy(*keys, bkt).orderBy(*order_cols)
    before_in = w_in.rowsBetween(Window.unboundedPreceding, -1)
    whole = w_in.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    halo = max([p.n for p in ps if p.kind == "rolling"] + [1 if any(p.kind == "gap_days" for p in ps) else 0])
    rn, cnt = f"{tag}_rn", f"{tag}_cnt"
    out = df.withColumn(rn, F.row_number().over(w_in))

    values = []  # (alias, Column) carried into the halo
    aggs = [F.count(F.lit(1)).alias("cnt")]
    sts = {j: _sum_type(df, p.value) for j, p in enumerate(ps) if p.kind in ("mean", "rolling")}
    for j, p in enumerate(ps):
        if p.kind == "mean":
            v = F.col(p.value).cast(sts[j])
            out = (out.withColumn(f"{tag}_s{j}", _sum(F.sum(v).over(before_in), sts[j]))
                      .withColumn(f"{tag}_c{j}", F.count(v).over(before_in)))
            aggs += [_sum(F.sum(v), sts[j]).alias(f"s{j}"), F.count(v).alias(f"c{j}")]
        elif p.kind == "rolling":
            v = F.col(p.value).cast(sts[j])
            frame = w_in.rowsBetween(-p.n, -1)
            out = (out.withColumn(f"{tag}_s{j}", _sum(F.sum(v).over(frame), sts[j]))
                      .withColumn(f"{tag}_c{j}", F.count(v).over(frame)))
            values.append((f"v{j}", v))
        elif p.kind == "gap_days":
            out = out.withColumn(f"{tag}_l{j}", F.lag(F.col(p.value)).over(w_in))
            values.append((f"v{j}", F.col(p.value)))
    if halo:
        tail_row = F.struct(F.col(rn).alias("rn"), *[c.alias(a) for a, c in values])
        aggs.append(F.sort_array(F.collect_list(F.when(F.col(rn) > F.col(cnt) - halo, tail_row))).alias("tail"))

    source = base
    if halo:
        source = base.withColumn(rn, F.row_number().over(w_in)).withColumn(cnt, F.count(F.lit(1)).over(whole))
    summary = source.groupBy(*keys, bkt).agg(*aggs)
    ws = Window.partitionBy(*keys).orderBy(bkt.asc_nulls_last())
    prior_b = ws.rowsBetween(Window.unboundedPreceding, -1)
    cols = [*[F.col(k) for k in keys], bkt,
            F.coalesce(F.sum("cnt").over(prior_b), F.lit(0)).alias(f"{tag}_orows")]
    for j, p in enumerate(ps):
        if p.kind == "mean":
            cols += [_sum(F.coalesce(F.sum(f"s{j}").over(prior_b), F.lit(0)), sts[j]).alias(f"{tag}_os{j}"),
                     F.coalesce(F.sum(f"c{j}").over(prior_b), F.lit(0)).alias(f"{tag}_oc{j}")]
    if halo:
        # Each earlier bucket holds at least one row, so the last `halo` rows
        # before a bucket lie within the `halo` buckets before it.
        merged = F.flatten(F.collect_list("tail").over(ws.rowsBetween(-halo, -1)))
        cols.append(F.slice(merged, F.greatest(F.size(merged) - halo + 1, F.lit(1)), halo).alias(f"{tag}_halo"))
    offsets = summary.select(*cols)
    out = null_safe_join(out, offsets, [*keys, "__bkt"])

    hcol = F.col(f"{tag}_halo") if halo else None
    for j, p in enumerate(ps):
        if p.kind == "count":
            out = out.withColumn(p.name, (F.col(f"{tag}_orows") + F.col(rn) - 1).cast("long"))
        elif p.kind == "mean":
            zero = F.lit(0).cast(sts[j])
            s = F.col(f"{tag}_os{j}") + F.coalesce(F.col(f"{tag}_s{j}"), zero)
            c = F.col(f"{tag}_oc{j}") + F.col(f"{tag}_c{j}")
            out = out.withColumn(p.name, _mean(s, c))
        elif p.kind == "rolling":
            need = F.greatest(F.lit(p.n) - (F.col(rn) - 1), F.lit(0))
            take = F.least(need, F.size(hcol))
            part = F.when(take > 0, F.slice(hcol, F.size(hcol) - take + 1, take))
            st = sts[j]
            zero = F.lit(0).cast(st)
            hs = F.coalesce(F.aggregate(part, zero, lambda acc, x: (acc + F.coalesce(x[f"v{j}"], zero)).cast(st)), zero)
            hc = F.coalesce(F.aggregate(part, F.lit(0), lambda acc, x: acc + F.when(x[f"v{j}"].isNotNull(), 1).otherwise(0)), F.lit(0))
            s = F.coalesce(F.col(f"{tag}_s{j}"), zero) + hs
            c = F.col(f"{tag}_c{j}") + hc
            out = out.withColumn(p.name, _mean(s, c))
        elif p.kind == "gap_days":
            last = F.element_at(hcol, -1)[f"v{j}"]
            prev = F.when(F.col(rn) > 1, F.col(f"{tag}_l{j}")).when(F.size(hcol) > 0, last)
            out = out.withColumn(p.name, F.datediff(F.col(p.value), prev))
    drop = [c for c in out.columns if c.startswith(tag + "_")]
    return out.drop(*drop)


def prior_count(df: DataFrame, entity, order, name: str = "prior_count", bucket=None) -> DataFrame:
    return with_priors(df, entity, order, [Prior(name, "count")], bucket)


def prior_mean(df: DataFrame, value: str, entity, order, name: str | None = None, bucket=None) -> DataFrame:
    return with_priors(df, entity, order, [Prior(name or f"prior_mean_{value}", "mean", value)], bucket)


def prior_rolling_mean(df: DataFrame, value: str, entity, order, n: int, name: str | None = None,
                       bucket=None) -> DataFrame:
    return with_priors(df, entity, order, [Prior(name or f"prior_roll{n}_{value}", "rolling", value, n)], bucket)


def gap_days(df: DataFrame, date: str, entity, order, name: str = "gap_days", bucket=None) -> DataFrame:
    return with_priors(df, entity, order, [Prior(name, "gap_days", date)], bucket)
