"""Runs of periodic words in whole texts (operator 13).

A run is a stretch of consecutive words with smallest period q and length at
least ``shortest`` and ``power`` * q that no neighbouring word extends. Per
text, a suffix automaton over its words is built, and a link-cut tree over the
automaton's link tree is accessed once per word: the access recolours the path
of all suffixes that end there with the new end. A path segment that an earlier
end e had coloured, and whose deepest state on the path has longest suffix L,
says that the last L words occurred before with end e and never since. With
d = end - e <= L this is a square of period d; the state's longest suffix makes
it L + d words long and not extensible to the left, and d is its smallest period,
since a smaller one would put an occurrence after e. It is a run if the next word
ends it, which is looked up.

Only stretches that can hold a run go through the automaton. A run of period q
has q + L words with L >= max(shortest - q, (power - 1) q), and its last L words
repeat the words q before them. So from its word q + k on (k the least such L),
the k words up to each word have occurred before, at most q back. Stretches
without this property hold no run; the rest is cut with enough margin that
every run lies whole inside one piece, with a word to spare on both sides.

Defined cases: a null or blank text has no word and no run; a null id stays
null; rows that repeat are scored one by one; an empty table gives an empty
result; other columns are not read. A text costs memory in proportion to its
own words.
"""

from __future__ import annotations

from array import array
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import quoted

POWER, SHORTEST = 4, 6
# Odd multipliers that mix the words of a gram into 64 bits.
_MIX = 0x9E3779B97F4A7C15


def suffix_automaton(words: list[int]) -> tuple[array, array, array]:
    """(link, longest, state of each prefix) of the suffix automaton of a word
    sequence. State 1 is the root, 0 stands for none. Most states have one
    transition, kept in two arrays; further ones are in dictionaries."""
    size = 2 * len(words) + 2
    link, longest = array("i", bytes(4 * size)), array("i", bytes(4 * size))
    word, to = array("i", [-1]) * size, array("i", bytes(4 * size))
    more: dict[int, dict[int, int]] = {}
    ends = array("i")
    used = last = 1
    for w in words:
        used += 1
        new = used
        longest[new] = longest[last] + 1
        ends.append(new)
        p, q = last, 0
        while p:
            if word[p] == w:
                q = to[p]
                break
            if word[p] < 0:
                word[p], to[p] = w, new
            else:
                others = more.get(p)
                if others is None:
                    more[p] = {w: new}
                elif w in others:
                    q = others[w]
                    break
                else:
                    others[w] = new
            p = link[p]
        if not p:
            link[new] = 1
        elif longest[q] == longest[p] + 1:
            link[new] = q
        else:
            used += 1
            longest[used], link[used], word[used], to[used] = longest[p] + 1, link[q], word[q], to[q]
            if q in more:
                more[used] = dict(more[q])
            while p:
                if word[p] == w:
                    if to[p] != q:
                        break
                    to[p] = used
                else:
                    others = more.get(p)
                    if others is None or others.get(w) != q:
                        break
                    others[w] = used
                p = link[p]
            link[q] = link[new] = used
        last = new
    return link, longest, ends


class PathColours:
    """Link-cut tree over a fixed parent array. Each preferred path is a splay
    tree ordered by depth; its colour is kept at the splay root."""

    def __init__(self, parent: array):
        n = len(parent)
        self.up = array("i", parent)  # splay parent, or the parent of the path's top
        self.shallow, self.deep = array("i", bytes(4 * n)), array("i", bytes(4 * n))
        self.colour = array("i", bytes(4 * n))  # 0: never accessed

    def _rotate(self, x: int) -> None:
        up, shallow, deep = self.up, self.shallow, self.deep
        y = up[x]
        z = up[y]
        if shallow[z] == y:
            shallow[z] = x
        elif deep[z] == y:
            deep[z] = x
        up[x], up[y] = z, x
        if shallow[y] == x:
            child = shallow[y] = deep[x]
            deep[x] = y
        else:
            child = deep[y] = shallow[x]
            shallow[x] = y
        if child:
            up[child] = y

    def _splay(self, x: int) -> None:
        up, shallow, deep = self.up, self.shallow, self.deep
        while True:
            y = up[x]
            if not y or (shallow[y] != x and deep[y] != x):
                return
            z = up[y]
            if z and (shallow[z] == y or deep[z] == y):
                self._rotate(y if (shallow[y] == x) == (shallow[z] == y) else x)
                top = False
            else:
                top = True
            self._rotate(x)
            if top:
                self.colour[x] = self.colour[y]
                return
            above = up[x]
            if not above or (shallow[above] != x and deep[above] != x):
                self.colour[x] = self.colour[z]
                return

    def access(self, state: int, colour: int) -> list[tuple[int, int]]:
        """Recolour the path from ``state`` to the root; (old colour, deepest
        state of that colour on the path) of each segment, deepest first."""
        segments, below, x = [], 0, state
        while x:
            self._splay(x)
            old = self.colour[x]
            if old:
                segments.append((old, x))
            cut = self.deep[x]
            if cut:
                self.colour[cut] = old
            self.deep[x] = below
            below, x = x, self.up[x]
        self.colour[below] = colour
        return segments


def runs_of_piece(words: list[int], power: int = POWER, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a sequence, by the automaton."""
    link, longest, ends = suffix_automaton(words)
    paths, out, n = PathColours(link), [], len(words)
    for i, state in enumerate(ends):
        for end, x in paths.access(state, i + 1):
            period, repeated = i + 1 - end, longest[x]
            length = repeated + period
            if (repeated >= (power - 1) * period and length >= shortest and repeated
                    and (i + 1 == n or words[i + 1] != words[i + 1 - period])):
                out.append((i + 1 - length, length, period))
    return out


def pieces(words: np.ndarray, power: int = POWER, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """[from, to) of the stretches that can hold a run; see the module's text."""
    n = len(words)
    k = min(max(shortest - q, (power - 1) * q) for q in range(1, shortest + 1))
    if n < shortest:
        return []
    grams = np.zeros(n - k + 1, dtype=np.uint64)
    x = words.astype(np.uint64)
    for j in range(k):
        grams = (grams + x[j:n - k + 1 + j] + np.uint64(1)) * np.uint64(_MIX)
        grams ^= grams >> np.uint64(29)
    order = np.argsort(grams, kind="stable")
    again = np.flatnonzero(grams[order[1:]] == grams[order[:-1]])
    if not len(again):
        return []
    back = np.zeros(len(grams), dtype=np.int64)
    back[order[again + 1]] = order[again + 1] - order[again]
    seen = np.flatnonzero(back)
    first = np.flatnonzero(np.diff(seen, prepend=-2) > 1)
    starts, sizes = seen[first], np.diff(first, append=len(seen))
    widest = (sizes + k - 1) // (power - 1)  # greatest period of a run in the stretch
    near = np.minimum.reduceat(back[seen], first) <= widest
    out: list[tuple[int, int]] = []
    for start, size, q in zip(starts[near].tolist(), sizes[near].tolist(), widest[near].tolist()):
        a, b = max(0, start - q - 1), min(n, start + size + k)
        while out and a <= out[-1][1]:
            a, b = min(a, out[-1][0]), max(b, out.pop()[1])
        out.append((a, b))
    return out


def runs_of(words: list, power: int = POWER, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a word sequence, by start and period."""
    codes: dict = {}
    numbers = [codes.setdefault(w, len(codes)) for w in words]
    out = []
    for a, b in pieces(np.array(numbers, dtype=np.int64), power, shortest):
        out += [(a + s, n, q) for s, n, q in runs_of_piece(numbers[a:b], power, shortest)]
    return sorted(set(out), key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that any run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    inside = np.cumsum(change)
    return [w for w, c in zip(words, inside.tolist()) if not c]


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", power: int = POWER, shortest: int = SHORTEST,
           prepare: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(id, n_words, runs array of (start, length, period), collapsed text) of
    every row. Words are separated by ASCII white space; ``prepare`` may change
    the words of a text before they are searched."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text"))

    def work(batches):
        import pyarrow as pa
        run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            sizes, found, texts = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = (text or "").encode().split()  # bytes: ASCII white space only
                if prepare is not None:
                    words = prepare(key, words)
                runs = runs_of(words, power, shortest)
                sizes.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                texts.append(b" ".join(collapse(words, runs)).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(run)), pa.array(texts, pa.string())],
                ["id", "n_words", "runs", "collapsed"])

    shape = f"id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(work, shape).withColumnRenamed("id", id_col)


def strongest(runs):
    """The run of greatest exact length / period (ties: smallest start, then
    period) of an array column that is in that order; null if it is empty."""
    return F.aggregate(runs, F.get(runs, F.lit(0)),
                       lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))
