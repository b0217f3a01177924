"""As-of joins and day-range aggregates.

Both are linear "union and scan" plans instead of a non-equi join: left and
right rows are tagged, unioned and scanned in time order per key, so the plan
has one shuffle on the key and never a nested-loop join.

Scale: ``range_agg`` first reduces both sides to one row per (key, day), so a
hot key costs at most one row per calendar day.  ``asof_join`` scans per (key,
bucket), where the bucket is monotone in time (the calendar day by default), and
the last right row of earlier buckets is carried in from a one-row-per-(key,
bucket) summary, so a hot key is split across its buckets. ``day_features`` is both
at once at day grain: keys with few enough rows for one task are scanned once, over the
rows as they are, and only larger keys take the way of the other two.

Nulls follow SQL: a null key or a null time matches nothing, on either side.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.history import PIECE, heavy_entities


def asof_join(left: DataFrame, right: DataFrame, key: Sequence[str], left_ts: str, right_ts: str,
              take: Sequence[str], tie: Sequence[str] = (), strict: bool = True,
              bucket_of=F.to_date, prefix: str = "") -> DataFrame:
    """For each left row, the last right row of the same key whose time is
    before (``strict``) or at/before the left time; among right rows at the same
    time the one greatest in ``tie`` wins.  Adds ``prefix + c`` for each ``take``
    column (including ``right_ts`` if listed); no match gives nulls.

    ``bucket_of``: function ts-Column -> bucket Column, non-decreasing in time."""
    key = list(key)
    right = right.where(_known([*key, right_ts]))
    rcols = list(dict.fromkeys([right_ts, *tie, *take]))
    # strict: a left row sorts before right rows of the same time (sees only
    # earlier ones); inclusive: after them.
    l_side, r_side = (0, 1) if strict else (1, 0)
    payload = F.struct(*[F.col(c).alias(c) for c in rcols])
    lcols = left.columns
    lt = left.select(*[F.col(k) for k in key], F.col(left_ts).alias("__ts"), F.lit(l_side).alias("__side"),
                     *[F.lit(None).cast(right.schema[c].dataType).alias(f"__tie{i}") for i, c in enumerate(tie)],
                     F.struct(*[F.col(c) for c in lcols]).alias("__l"),
                     F.lit(None).cast(payload_type(right, rcols)).alias("__r"))
    rt = right.select(*[F.col(k) for k in key], F.col(right_ts).alias("__ts"), F.lit(r_side).alias("__side"),
                      *[F.col(c).alias(f"__tie{i}") for i, c in enumerate(tie)],
                      F.lit(None).cast(left.select(F.struct(*[F.col(c) for c in lcols]).alias("s")).schema["s"].dataType).alias("__l"),
                      payload.alias("__r"))
    u = lt.unionByName(rt)
    order = [F.col("__ts"), F.col("__side"), *[F.col(f"__tie{i}") for i in range(len(tie))]]
    u = u.withColumn("__b", bucket_of(F.col("__ts")))
    w = Window.partitionBy(*key, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = u.withColumn("__in", F.last("__r", ignorenulls=True).over(w))
    rord = F.struct(F.col("__ts"), *[F.col(f"__tie{i}") for i in range(len(tie))])
    # one row for every (key, bucket), also buckets without right rows
    last_in_bucket = (u.groupBy(*key, "__b")
                      .agg(F.max_by("__r", F.when(F.col("__r").isNotNull(), rord)).alias("__lastb")))
    wb = Window.partitionBy(*key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carry = last_in_bucket.select(*key, "__b", F.last("__lastb", ignorenulls=True).over(wb).alias("__carry"))
    found = found.where(F.col("__l").isNotNull()).join(carry, on=[*key, "__b"], how="left")
    # a left row without a key or a time has no match, whatever sorted before it
    usable = _known([*key, "__ts"])
    found = found.withColumn("__m", F.when(usable, F.coalesce("__in", "__carry")))
    res = found.where(F.col("__l").isNotNull())
    return res.select("__l.*", *[F.col(f"__m.{c}").alias(prefix + c) for c in take])


def _known(cols: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


def payload_type(df: DataFrame, cols: Sequence[str]):
    return df.select(F.struct(*[F.col(c) for c in cols]).alias("s")).schema["s"].dataType


def range_agg(left: DataFrame, right: DataFrame, key: Sequence[str], left_day: str, right_day: str,
              windows: dict[str, int], aggs: dict[str, tuple[str, str, int]]) -> DataFrame:
    """Per left row, aggregates of right rows of the same key whose day lies
    in ``[left_day - days, left_day)``.

    ``windows``: output name -> days, a count of right rows.
    ``aggs``: output name -> (function ``min``/``max``/``sum``, right column, days).
    Counts are 0 when nothing is in range, other aggregates null."""
    key = list(key)
    pre = [F.count(F.lit(1)).alias("__n")]
    for name, (fn, col, _) in aggs.items():
        pre.append(getattr(F, fn)(F.col(col)).alias(f"__a_{name}"))
    r = right.where(_known([*key, right_day])).groupBy(*key, F.col(right_day).alias("__day")).agg(*pre)
    l = left.where(_known([*key, left_day])).select(*key, F.col(left_day).alias("__day")).dropDuplicates().withColumn("__marker", F.lit(True))
    r = r.withColumn("__marker", F.lit(False))
    for c in r.columns:
        if c not in l.columns:
            l = l.withColumn(c, F.lit(None).cast(r.schema[c].dataType))
    u = r.unionByName(l.select(*r.columns)).withColumn("__dn", F.unix_date(F.col("__day")))
    base = Window.partitionBy(*key).orderBy("__dn")
    cols = [*key, "__day"]
    for name, days in windows.items():
        cols.append(F.coalesce(F.sum("__n").over(base.rangeBetween(-days, -1)), F.lit(0)).cast("int").alias(name))
    for name, (fn, _, days) in aggs.items():
        cols.append(getattr(F, fn)(F.col(f"__a_{name}")).over(base.rangeBetween(-days, -1)).alias(name))
    stats = u.select(*cols, "__marker").where(F.col("__marker")).drop("__marker")
    out = left.join(stats.withColumnRenamed("__day", left_day), on=[*key, left_day], how="left")
    # a left row without a key or a day joins nothing: its counts are 0 as well
    return out.withColumns({name: F.coalesce(name, F.lit(0)) for name in windows})


def day_asof(left: DataFrame, right: DataFrame, key: Sequence[str], left_day: str, right_day: str,
             take: Sequence[str], tie: Sequence[str] = (), strict: bool = True, prefix: str = "latest_") -> DataFrame:
    """J8 at day grain: the last right row of the key before (``strict``) the left
    day; right rows of one day are reduced to the greatest in ``tie`` first, left
    rows to distinct (key, day), so the scan sees at most one row per side and day."""
    key = list(key)
    cols = list(dict.fromkeys([right_day, *take]))
    per_day = (right.where(_known([*key, right_day])).groupBy(*key, right_day)
               .agg(F.max_by(F.struct(*[F.col(c) for c in cols if c != right_day]),
                             F.struct(*[F.col(c) for c in tie]) if tie else F.lit(0)).alias("__p"))
               .select(*key, right_day, "__p.*"))
    days = left.select(*key, left_day).dropDuplicates()
    found = asof_join(days, per_day, key, left_day, right_day, take, (), strict, lambda d: F.trunc(d, "month"), prefix)
    return left.join(found, on=[*key, left_day], how="left")


def heavy_keys(left: DataFrame, right: DataFrame, key: Sequence[str], piece: int = PIECE) -> DataFrame | None:
    """The keys with more than ``piece`` rows of both sides, at most 1,000; None if there is none."""
    both = left.select(*key).unionByName(right.select(*key))
    return heavy_entities(both.where(_known(key)), list(key), piece)


def day_features(left: DataFrame, right: DataFrame, key: Sequence[str], left_day: str, right_day: str,
                 windows: dict[str, int], aggs: dict[str, tuple[str, str, int]], take: Sequence[str],
                 tie: Sequence[str] = (), prefix: str = "latest_", heavy: DataFrame | None = None) -> DataFrame:
    """``range_agg`` and, before the left day, ``day_asof`` of the same sides.

    Rows of both sides are dealt by key and scanned in day order, in one shuffle; nothing
    is joined back. The keys in ``heavy`` (see ``heavy_keys``) would be long tasks: their
    rows are reduced per day by the other two operators."""
    key, shown = list(key), [*key, left_day, *[c for c in left.columns if c not in (*key, left_day)]]
    if not all(isinstance(df.schema[c].dataType, T.DateType) for df, c in ((left, left_day), (right, right_day))):
        return _by_day(left, right, key, left_day, right_day, windows, aggs, take, tie, prefix)
    usable = _known([*key, left_day])
    names = [*shown, *windows, *aggs, *[prefix + c for c in take]]
    types = {**{c: left.schema[c].dataType for c in shown}, **{name: T.IntegerType() for name in windows},
             **{name: right.select(getattr(F, fn)(F.col(c)).alias(name)).schema[name].dataType for name, (fn, c, _) in aggs.items()},
             **{prefix + c: right.schema[c].dataType for c in take}}
    # a left row without a key or a day has nothing in range and no match
    alone = left.where(~usable).select(*shown, *[F.lit(0).alias(name) for name in windows],
                                       *[F.lit(None).cast(types[name]).alias(name) for name in names[len(shown) + len(windows):]])
    left, right = left.where(usable), right.where(_known([*key, right_day]))
    out = alone.select(*names)
    if heavy is not None:
        same = [F.col(c).eqNullSafe(F.col(f"__h{i}")) for i, c in enumerate(key)]
        few = F.broadcast(heavy.toDF(*[f"__h{i}" for i in range(len(key))]))  # a bounded number of rows
        cut = _by_day(left.join(few, same, "left_semi"), right.join(few, same, "left_semi"), key, left_day, right_day,
                      windows, aggs, take, tie, prefix)
        out = out.unionByName(cut.select(*names))
        left, right = left.join(few, same, "left_anti"), right.join(few, same, "left_anti")
    own = [c for c in shown if c not in (*key, left_day)]
    cols = list(dict.fromkeys([*[c for _, c, _ in aggs.values()], *[c for c in (*take, *tie) if c != right_day]]))
    cols = [c for c in cols if c not in (*key, right_day)]
    nulls = lambda df, cs, p: [F.lit(None).cast(df.schema[c].dataType).alias(f"{p}{i}") for i, c in enumerate(cs)]
    values = lambda cs, p: [F.col(c).alias(f"{p}{i}") for i, c in enumerate(cs)]
    rows = (left.select(*key, F.col(left_day).alias("__day"), F.lit(False).alias("__right"), *values(own, "__l"), *nulls(right, cols, "__r"))
            .unionByName(right.select(*key, F.col(right_day).alias("__day"), F.lit(True).alias("__right"),
                                      *nulls(left, own, "__l"), *values(cols, "__r")))
            .repartition(*key).withColumn("__dn", F.unix_date("__day")))
    at = {**{c: F.col(f"__r{i}") for i, c in enumerate(cols)}, **{k: F.col(k) for k in key}, right_day: F.col("__day")}
    base = Window.partitionBy(*key).orderBy("__dn")
    found = F.max_by(F.struct(*[at[c].alias(f"__t{i}") for i, c in enumerate(take)]),
                     F.when(F.col("__right"), F.struct(F.col("__dn"), *[at[c].alias(f"__o{i}") for i, c in enumerate(tie)])))
    scanned = rows.select(
        *key, "__day", "__right", *[f"__l{i}" for i in range(len(own))],
        *[F.count(F.when(F.col("__right"), 1)).over(base.rangeBetween(-days, -1)).cast("int").alias(name)
          for name, days in windows.items()],
        *[getattr(F, fn)(F.when(F.col("__right"), at[c])).over(base.rangeBetween(-days, -1)).alias(name)
          for name, (fn, c, days) in aggs.items()],
        found.over(base.rangeBetween(Window.unboundedPreceding, -1)).alias("__last"))
    light = scanned.where(~F.col("__right")).select(
        *key, F.col("__day").alias(left_day), *[F.col(f"__l{i}").alias(c) for i, c in enumerate(own)], *windows, *aggs,
        *[F.col(f"__last.__t{i}").alias(prefix + c) for i, c in enumerate(take)])
    return light.unionByName(out)


def _by_day(left: DataFrame, right: DataFrame, key: list[str], left_day: str, right_day: str, windows, aggs, take, tie,
            prefix: str) -> DataFrame:
    out = range_agg(left, right, key, left_day, right_day, windows, aggs)
    found = day_asof(left.select(*key, left_day).dropDuplicates(), right, key, left_day, right_day, list(take), list(tie), True, prefix)
    return out.join(found, on=[*key, left_day], how="left")
