"""Placement by a permutation-filled lookup table (operator 6).

Every shard has a preference order over the slots of a prime-sized table:
start + k * step modulo the size, with start and step from its name's MD5. The
shards take turns in name order, each claiming its next free slot, until the
table is full, so shares differ by at most one slot and adding or removing a
shard moves few slots between the others. A document goes to the shard of slot
``hash(key) mod size``: one look-up in a table of fixed size, which is
broadcast (``size`` rows, whatever the data).

The hash is the first 60 bits of MD5(key as text), the same in any engine.

Defined cases: a null key is the empty text; repeated keys share a slot; an
empty table gives no rows; other columns are not read by ``place`` and pass
through ``assign``. A hot key would fill one shard, so ``assign`` can spread
the rows of a key over the whole table by a second key (``spread_col``).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import fresh, quoted

LARGEST = 1_048_583  # the first prime above 2**20 bounds every table


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], size: int) -> list[int]:
    """Index of the owning shard for every slot."""
    if not is_prime(size) or size > LARGEST:
        raise ValueError("the table size must be a prime of at most 2**20 + 7")
    if not 0 < len(shards) <= size or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct, and not more than slots")
    order = sorted(range(len(shards)), key=lambda k: shards[k])
    at, step = [0] * len(shards), [0] * len(shards)
    for k, name in enumerate(shards):
        digest = hashlib.md5(name.encode()).digest()
        at[k] = int.from_bytes(digest[:8], "big") % size
        step[k] = int.from_bytes(digest[8:], "big") % (size - 1) + 1 if size > 2 else 1
    owner, free = [-1] * size, size
    while free:
        for k in order:
            while owner[at[k]] >= 0:
                at[k] = (at[k] + step[k]) % size
            owner[at[k]] = k
            free -= 1
            if not free:
                break
    return owner


def table_frame(spark: SparkSession, shards: list[str], size: int) -> DataFrame:
    """(slot, shard) rows of the table."""
    owner = lookup_table(shards, size)
    return spark.createDataFrame([(slot, shards[k]) for slot, k in enumerate(owner)], "slot long, shard string")


def slot_of(key, size: int):
    """Slot of a key column."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(size))


def place(keys: DataFrame, slots: DataFrame, key_col: str, size: int) -> DataFrame:
    """(key, slot, shard) per row; the last two under names that the key leaves free."""
    out = keys.select(F.col(quoted(key_col)))
    slot, shard = fresh(out, "slot"), fresh(out, "shard")
    named = slots.select(F.col("slot").alias(slot), F.col("shard").alias(shard))
    out = out.withColumn(slot, slot_of(F.col(quoted(key_col)), size))
    return out.join(F.broadcast(named), slot).select(quoted(key_col), slot, shard)


def assign(docs: DataFrame, slots: DataFrame, key_col: str, size: int, spread_col: str | None = None) -> DataFrame:
    """All columns plus ``shard`` (under a name that is still free)."""
    slot, shard = fresh(docs, "slot"), fresh(docs, "shard")
    key = F.coalesce(F.col(quoted(key_col)).cast("string"), F.lit(""))
    if spread_col is not None:
        key = F.concat_ws("\x00", key, F.coalesce(F.col(quoted(spread_col)).cast("string"), F.lit("")))
    named = slots.select(F.col("slot").alias(slot), F.col("shard").alias(shard))
    return docs.withColumn(slot, slot_of(key, size)).join(F.broadcast(named), slot).drop(slot)


def write_shards(docs: DataFrame, path: str, slots: DataFrame, key_col: str, size: int, files_per_shard: int = 8,
                 spread_col: str | None = None) -> None:
    """Write one folder per shard, each in at most ``files_per_shard`` files. Rows are
    dealt to these by all their columns, so those of a hot key fill every file of
    its shard; ``spread_col`` spreads them over the shards too, as in ``assign``."""
    placed = assign(docs, slots, key_col, size, spread_col)
    shard = placed.columns[-1]
    dealt = [F.col(quoted(f.name)) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    part = F.pmod(F.xxhash64(*dealt), F.lit(files_per_shard))
    placed.repartition(F.col(quoted(shard)), part).write.partitionBy(shard).parquet(path)
