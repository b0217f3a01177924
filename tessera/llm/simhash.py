"""SimHash near-duplicates by generalised pigeonhole (operator 2).

Fingerprint: lower-case A-Z, words between ASCII white space, shingles of four
words with repeats, XXH64 (seed 42) of each; a bit is set if set in over half
of the hashes. Two fingerprints are linked at ``distance`` or fewer differing
bits; components are taken over all links.

Search, over distinct fingerprints only:

1. Bit statistics over all fingerprints give each pair of bits a correlation;
   correlated bits are put into the same partition, so that one skewed bit
   pattern spoils one partition and not all.
2. For 4, 5 and 6 partitions, the number of fingerprints per partition value is
   counted over all rows. By the generalised pigeonhole principle, two
   fingerprints within ``distance`` agree within t_i in some partition i, for
   any thresholds with sum(t_i) = distance - partitions + 1, where -1 leaves a
   partition out. Dynamic programming over the partitions picks the thresholds
   (and the number of partitions) with the least estimated cost: candidate
   pairs, plus the rows that have to be dealt.
3. Each fingerprint is indexed under its value in every used partition and
   probes the values within t_i. A block (partition, value) is compared inside
   a task by vectorised Hamming distances; every pair is verified on all 64
   bits. A block of over ``BLOCK`` rows is dealt in tiles: its members fall
   into chunks by hash, and a tile compares two chunks, so no task takes a hot
   block whole and no pair is lost. A small block gives its links, a larger
   one a spanning forest of them (breadth-first search), never all pairs.
4. Components by star operations on the links, as tables.

Statistics that reach the driver are of fixed size: 2,080 bit pairs and at
most 4 * 2**16 + 5 * 2**13 + 6 * 2**11 counts.

Defined cases: null and empty texts have fingerprint zero and link like any
other; a null doc_id never represents a component that has a real one; repeated
rows share everything; an empty table gives no rows; other columns are not read
by ``near_duplicates`` and pass through ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh, join_classes, one_of_each, quoted, stage, text_of
from tessera.llm.components import components

SEED = 42
BLOCK = 2048       # most rows of a block that one task compares whole
SMALL = 64         # blocks up to this size give all their links
ROW_COST = 200.0   # a dealt row costs as much as so many compared pairs


# -- fingerprints ----------------------------------------------------------

def fingerprint(data: bytes, width: int = 4) -> int:
    """64-bit SimHash of a text in UTF-8; shingles are hashed in blocks, so a
    very long text needs memory for its words only."""
    from xxhash import xxh64_intdigest
    words = data.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n < width:
        return xxh64_intdigest(joined, SEED)
    del words
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    starts = np.concatenate([[0], gaps + 1])[:n - width + 1]
    ends = np.concatenate([gaps, [len(joined)]])[width - 1:]
    total = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        spans = zip(starts[at:at + (1 << 16)].tolist(), ends[at:at + (1 << 16)].tolist())
        hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(starts), bitorder="little").tobytes(), "little")


def _fingerprints(width: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            prints = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, width: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer."""
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), text_of(docs, text_col).cast("binary").alias("t"))
    return rows.mapInArrow(_fingerprints(width), "doc_id long, fp long")


# -- plan ------------------------------------------------------------------

def _bits(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(prints.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _value(bits: np.ndarray, own: list[int]) -> np.ndarray:
    return bits[:, own].astype(np.int64) @ (1 << np.arange(len(own), dtype=np.int64))


def _pair_counts(batches: Iterator) -> Iterator:
    import pyarrow as pa
    total = np.zeros((64, 64), np.int64)
    for batch in batches:
        bits = _bits(batch.column(0).to_numpy()).astype(np.float32)
        total += np.rint(bits.T @ bits).astype(np.int64)
    a, b = np.triu_indices(64)
    if total.any():
        yield pa.RecordBatch.from_pydict({"a": a.astype(np.int32), "b": b.astype(np.int32), "n": total[a, b]})


def correlation(both: np.ndarray, n: int) -> np.ndarray:
    """|phi| of every two bits, from the counts of rows that have both set."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(p * (1 - p))
    with np.errstate(divide="ignore", invalid="ignore"):
        phi = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    return np.nan_to_num(phi)


def group_bits(phi: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of near-equal size that keep correlated bits together: each
    starts with the most correlated free pair and takes the bit closest to it."""
    sizes = [64 // parts + (k < 64 % parts) for k in range(parts)]
    free, out = set(range(64)), []
    for size in sizes:
        own = list(max(combinations(sorted(free), 2), key=lambda ab: (phi[ab], -ab[0], -ab[1])))
        free -= set(own)
        while len(own) < size:
            best = max(sorted(free), key=lambda x: phi[x, own].mean())
            own.append(best)
            free.discard(best)
        out.append(sorted(own))
    return out


def _value_counts(plans: list[list[list[int]]]):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        keys = [(m, i, own) for m, parts in enumerate(plans) for i, own in enumerate(parts)]
        totals = [np.zeros(1 << len(own), np.int64) for _, _, own in keys]
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy())
            for (_, _, own), total in zip(keys, totals):
                total += np.bincount(_value(bits, own), minlength=len(total))
        for (m, i, _), total in zip(keys, totals):
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"m": np.full(len(at), m, np.int32), "i": np.full(len(at), i, np.int32),
                                              "v": at.astype(np.int64), "n": total[at]})
    return run


def ball(width: int, radius: int) -> np.ndarray:
    """Masks of all values within ``radius`` bits of zero."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)], np.int64)


def cost(counts: np.ndarray, width: int, threshold: int) -> float:
    """Estimated cost of a partition at a threshold: candidate pairs and dealt rows."""
    if threshold < 0:
        return 0.0
    near = sum(counts[np.arange(len(counts)) ^ mask] for mask in ball(width, threshold))
    pairs = float((counts.astype(float) * near).sum()) / (2 if threshold == 0 else 1)
    return pairs + ROW_COST * float(counts.sum()) * (1 if threshold == 0 else 1 + comb(width, 0) + sum(
        comb(width, r) for r in range(1, threshold + 1)))


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds with the given sum and the least cost, by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for part in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (c, chosen) in best.items():
            for t, more in part.items():
                if spent + t not in step or c + more < step[spent + t][0]:
                    step[spent + t] = (c + more, [*chosen, t])
        best = step
    return best.get(total, (float("inf"), []))


def search_plan(points: DataFrame, n: int, distance: int) -> tuple[list[list[int]], list[int], list[np.ndarray]]:
    """(partitions, thresholds, value counts) for a table of distinct fingerprints."""
    both = np.zeros((64, 64), np.int64)
    for r in points.mapInArrow(_pair_counts, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).collect():
        both[r["a"], r["b"]] = both[r["b"], r["a"]] = r["n"]
    phi = correlation(both, n)
    sizes = sorted({max(2, min(16, m)) for m in (distance, distance + 1, distance + 2) if 64 / m <= 16} or {distance + 1})
    plans = [group_bits(phi, m) for m in sizes]
    counts = [[np.zeros(1 << len(own), np.int64) for own in parts] for parts in plans]
    for r in (points.mapInArrow(_value_counts(plans), "m int, i int, v long, n long")
              .groupBy("m", "i", "v").agg(F.sum("n").alias("n")).toLocalIterator()):
        counts[r["m"]][r["i"]][r["v"]] = r["n"]
    best = None
    for parts, own in zip(plans, counts):
        room = max(0, distance - len(parts) + 1)
        table = [{t: cost(c, len(p), t) for t in range(-1, min(room, 2) + 1)} for p, c in zip(parts, own)]
        price, thresholds = allocate(table, distance - len(parts) + 1)
        if thresholds and (best is None or price < best[0]):
            best = (price, parts, thresholds, own)
    if best is None:
        raise ValueError("no thresholds for this distance")
    return best[1], best[2], best[3]


# -- blocks ----------------------------------------------------------------

_BOTH, _INDEX, _PROBE = 0, 1, 2


def _signatures(parts: list[list[int]], thresholds: list[int], hot: list[dict[int, int]]):
    """Rows (part, value, tile, role, fp). ``hot`` gives, per partition, the
    values whose block is dealt in tiles and their number of chunks."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows(part, value, tile, role, fp):
            return pa.RecordBatch.from_pydict({"part": np.full(len(fp), part, np.int32), "value": value, "tile": tile,
                                               "role": np.full(len(fp), role, np.int32), "fp": fp})
        for batch in batches:
            fps = batch.column(0).to_numpy()
            bits = _bits(fps)
            # any fixed mixing will do for the chunk of a fingerprint
            mixed = (fps.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            for i, (own, t) in enumerate(zip(parts, thresholds)):
                if t < 0:
                    continue
                value = _value(bits, own)
                masks = [(0, _BOTH)] if t == 0 else [(0, _INDEX), *((int(m), _PROBE) for m in ball(len(own), t))]
                chunks = np.array([hot[i].get(int(v), 1) for v in range(1 << len(own))], np.int64)
                for mask, role in masks:
                    v = value ^ mask
                    k = chunks[v]
                    cold = k == 1
                    yield rows(i, v[cold], np.zeros(cold.sum(), np.int64), role, fps[cold])
                    for count in np.unique(k[~cold]):
                        at = k == count
                        mine = (mixed[at] % np.uint64(count)).astype(np.int64)
                        for other in range(count):
                            a, b = np.minimum(mine, other), np.maximum(mine, other)
                            yield rows(i, v[at], (a << 31) | b, role, fps[at])
    return run


def forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within a block, by breadth-first search."""
    left, a, b = np.arange(len(fps)), [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            hit = np.bitwise_count(fps[left] ^ fps[at]) <= distance
            found = left[hit]
            if len(found):
                a.append(np.full(len(found), at))
                b.append(found)
                queue += found.tolist()
                left = left[~hit]
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(a), np.concatenate(b)


def block_links(block: np.ndarray, role: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within blocks. Rows are sorted by block and role, so the rows to
    compare with stand first in their block."""
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    size = np.diff(np.concatenate([first, [len(block)]]))
    out_a, out_b = [], []
    for k in np.flatnonzero(size > SMALL):
        own = np.unique(fps[first[k]:first[k] + size[k]])
        a, b = forest(own, distance)
        out_a.append(own[a])
        out_b.append(own[b])
    start = np.repeat(first, size)
    place = np.arange(len(block)) - start
    indexed = np.repeat(np.add.reduceat((role != _PROBE).astype(np.int64), first), size)
    stop = np.where(np.repeat(size, size) > SMALL, 0, np.where(role == _BOTH, place, np.where(role == _PROBE, indexed, 0)))
    rows = np.flatnonzero(stop > 0)
    step = 0
    while len(rows):
        other = fps[start[rows] + step]
        hit = np.bitwise_count(fps[rows] ^ other) <= distance
        out_a.append(fps[rows[hit]])
        out_b.append(other[hit])
        step += 1
        rows = rows[stop[rows] > step]
    if not out_a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(out_a), np.concatenate(out_b)


def _links(distance: int):
    """Rows come sorted by (part, value, tile, role); a batch is cut at its last
    complete block, and a block holds a bounded number of rows."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def work(rows):
            if not len(rows[0]):
                return None
            part, value, tile, role, fps = rows
            new = np.concatenate([[False], (part[1:] != part[:-1]) | (value[1:] != value[:-1]) | (tile[1:] != tile[:-1])])
            a, b = block_links(np.cumsum(new), role, fps.view(np.uint64), distance)
            far = a != b
            both = np.unique(np.stack([np.minimum(a[far], b[far]), np.maximum(a[far], b[far])], axis=1), axis=0)
            return pa.RecordBatch.from_pydict({"u": np.ascontiguousarray(both[:, 0]).view(np.int64),
                                               "v": np.ascontiguousarray(both[:, 1]).view(np.int64)})
        kept = [np.zeros(0, np.int64)] * 5
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [np.concatenate([k, batch.column(c).to_numpy()]) for k, c in zip(kept, range(5))]
            last = np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]) | (rows[2] != rows[2][-1]))
            cut = last[-1] + 1 if len(last) else 0
            kept = [r[cut:] for r in rows]
            got = work([r[:cut] for r in rows])
            if got is not None:
                yield got
        got = work(kept)
        if got is not None:
            yield got
    return run


def links(points: DataFrame, distance: int) -> DataFrame:
    """(u, v) links over a written table of distinct fingerprints ``fp``: enough
    of them to connect whatever is within the distance."""
    n = points.count()
    if n < 2:
        return points.sparkSession.createDataFrame([], "u long, v long")
    parts, thresholds, counts = search_plan(points, n, distance)
    hot = []
    for own, t, c in zip(parts, thresholds, counts):
        near = c if t <= 0 else sum(c[np.arange(len(c)) ^ mask] for mask in ball(len(own), t)) + c
        at = np.flatnonzero(near > BLOCK)
        # two chunks meet in a tile
        hot.append({int(v): int(-(-2 * near[v] // BLOCK)) for v in at})
    keys = ["part", "value", "tile"]
    dealt = points.mapInArrow(_signatures(parts, thresholds, hot), "part int, value long, tile long, role int, fp long")
    return (dealt.repartition(*keys).sortWithinPartitions(*keys, "role", "fp")
            .mapInArrow(_links(distance), "u long, v long").distinct())


# -- operator --------------------------------------------------------------

def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, fp, component_id (least doc_id reachable),
    component_fp and n_same, the rows that have both of these."""
    members = stage(fingerprints(docs, width, id_col, text_col), "fingerprints")
    classes = stage(members.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "classes")
    roots = components(links(classes.select("fp"), distance))
    rooted = (classes.join(roots, classes.fp == roots.node, "left")
              .select("fp", "least", "n", F.coalesce("root", "fp").alias("root")))
    heads = rooted.groupBy("root").agg(
        F.min(F.struct(F.col("least").isNull().alias("u"), F.col("least").alias("id"), F.col("fp").alias("fp"))).alias("h"))
    # components are few where hot ones could be: most classes are their own root
    out = (rooted.join(heads, "root")
           .select("fp", "n", F.col("h.id").alias("component_id"), F.col("h.fp").alias("component_fp")))
    return join_classes(members, stage(out, "components"), "fp", "n", ["doc_id"]).drop("n")


def deduplicate(docs: DataFrame, width: int = 4, distance: int = 4, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns: of each component the row
    with the least doc_id."""
    found = near_duplicates(docs, width, distance, id_col, text_col)
    i, n = fresh(docs, "_near_id"), fresh(docs, "_near_n")
    stays = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("component_fp")))
             .groupBy("doc_id").agg(F.count(F.lit(1)).alias(n)).withColumnRenamed("doc_id", i))
    stays = stage(stays, "near-stays")
    names = [F.col(quoted(c)) for c in docs.columns]
    kept = docs.join(stays, F.col(quoted(id_col)).cast("long").eqNullSafe(F.col(i)))
    if not stays.filter(F.col(n) > 1).limit(1).count():
        return kept.select(names)
    return one_of_each(kept, i, n, names)
