"""Keyed tables written month by month.

A run replaces keys within a half-open range of days. Every month it touches is
written as one new folder (``data/write=<n>/__month=2024-01``) that holds the rows of
the run and, added when their keys have been checked, those older rows of the month whose
keys the run does not bring; then a manifest (``log/v=<n>.json``) names the live folder of every month. Months outside
the range are neither read nor written. Overwriting partitions in place would lose
the kept rows of a month if a job ended between the removal and the rename, so live
folders are never touched: a write that fails leaves the last manifest in force, and
the same range written again gives the same table.

``write`` takes a step's name. A step whose manifest is committed is skipped, so
a long range is cut into steps and a broken run goes on where it ended.

The manifest names one folder a month. There is one writer. A row's month is that of
its ``day`` column; rows without a day are refused, as no range can hold them.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.upsert import dedupe_source
from tessera.sources import files

MONTH = "__month"


def month_steps(start: dt.date, end: dt.date, months: int = 12) -> list[tuple[dt.date, dt.date]]:
    """[start, end) cut at the first of a month into ranges of at most ``months``."""
    out = []
    while start < end:
        n = start.year * 12 + start.month - 1 + months
        stop = min(dt.date(n // 12, n % 12 + 1, 1), end)
        out.append((start, stop))
        start = stop
    return out


class MonthTable:
    """One row per key at ``path``, kept by the month of ``day``."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], day: str):
        self.spark, self.path, self.keys, self.day = spark, path.rstrip("/"), list(keys), day

    def _manifest(self) -> dict | None:
        done = [n for n in files.children(self.spark, f"{self.path}/log", "v=") if n.endswith(".json")]
        return json.loads(files.read_text(self.spark, f"{self.path}/log/{done[-1]}")) if done else None

    def done(self) -> list[str]:
        """Names of the committed steps."""
        return (self._manifest() or {"steps": []})["steps"]

    def read(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame | None:
        """Rows with a day in [start, end), from the folders of those months only; None
        before the first write."""
        m = self._manifest()
        if m is None:
            return None
        first, last = (start or dt.date.min).strftime("%Y-%m"), (end or dt.date.max).strftime("%Y-%m")
        rows = self._load(m, [k for k in m["months"] if first <= k <= last])
        if start:
            rows = rows.where(F.col(self.day) >= F.lit(start))
        return rows.where(F.col(self.day) < F.lit(end)) if end else rows

    def _load(self, manifest: dict, months: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.path}/{manifest['months'][m]}" for m in sorted(months)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def write(self, rows: DataFrame, start: dt.date, end: dt.date, step: str | None = None) -> list[str]:
        """Replace the keys of ``rows``, all of a day in [start, end); the months
        written. Repeated keys are an error, and so is a day out of range."""
        step = step or f"{start}:{end}"
        m = self._manifest()
        if m and (m["keys"], m["day"]) != (self.keys, self.day):
            raise ValueError(f"the table at {self.path} is keyed by {m['keys']} over {m['day']}")
        if m and step in m["steps"]:
            return []
        schema = T.StructType.fromJson(m["schema"]) if m else rows.schema
        day = F.col(self.day)
        inside = F.coalesce((day >= F.lit(start)) & (day < F.lit(end)), F.lit(False))
        new = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        new = new.withColumn(self.day, F.when(inside, day).otherwise(
            F.raise_error(F.concat(F.lit(f"a day outside [{start}, {end}): "), F.coalesce(day.cast("string"), F.lit("null"))))))
        first, last = start.strftime("%Y-%m"), (end - dt.timedelta(days=1)).strftime("%Y-%m")
        held = [k for k in (m["months"] if m else {}) if first <= k <= last]
        version = m["version"] + 1 if m else 1
        folder = f"data/write={version:012d}"
        # the rows are computed once: what asks for their keys reads the new folder
        written = self._put(new, folder, "overwrite")
        if written:
            brought = self._load({"schema": schema.jsonValue(), "months": written}, list(written)).select(*self.keys)
            dedupe_source(brought, self.keys)
            if held:
                gone = brought.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(self.keys)])
                same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(self.keys)]
                written = self._put(self._load(m, held).join(gone, same, "left_anti"), folder, "append")
        elif held:  # no row came: those months stay as they are
            written = self._put(self._load(m, held), folder, "append")
        files.write_text(self.spark, f"{self.path}/log/v={version:012d}.json", json.dumps(
            {"version": version, "keys": self.keys, "day": self.day, "schema": schema.jsonValue(),
             "months": {**(m["months"] if m else {}), **written}, "steps": [*(m["steps"] if m else []), step]}))
        return sorted(written)

    def _put(self, rows: DataFrame, folder: str, mode: str) -> dict[str, str]:
        """Write rows by month; the months of the folder."""
        (rows.withColumn(MONTH, F.date_format(self.day, "yyyy-MM")).hint("rebalance", MONTH)
         .write.mode(mode).partitionBy(MONTH).parquet(f"{self.path}/{folder}"))
        return {n.split("=")[1]: f"{folder}/{n}" for n in files.children(self.spark, f"{self.path}/{folder}", f"{MONTH}=")}

    def clean(self) -> list[str]:
        """Remove folders that the last manifest does not name, and older manifests; the
        removed folders. Call it when no reader of an earlier state is left."""
        m = self._manifest()
        if m is None:
            return []
        live, out = set(m["months"].values()), []
        for write in files.children(self.spark, f"{self.path}/data", "write="):
            if int(write[6:]) > m["version"]:
                continue  # a write that is under way
            for name in files.children(self.spark, f"{self.path}/data/{write}", f"{MONTH}="):
                if f"data/{write}/{name}" not in live:
                    out.append(f"data/{write}/{name}")
        for name in files.children(self.spark, f"{self.path}/log", "v=")[:-1]:
            files.delete(self.spark, f"{self.path}/log/{name}")
        for folder in out:
            files.delete(self.spark, f"{self.path}/{folder}")
        return out
