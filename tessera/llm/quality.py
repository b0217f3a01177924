"""Quality rules in a short-circuit cascade (operator 4).

A rule names the features it needs, and features are computed once per text,
on first use. On a sample of at most ``sample_rows`` documents every rule is
timed and its rejections counted; the cascade then runs the rules in the order
of rejections per second, and a text that one rule rejects never reaches the
next. The order changes the cost only: a text is kept if no rule rejects it,
and the rules look at whole texts in integer arithmetic.

Defined cases: a null text is the empty text, which fails the base rule; null
and repeated ids go through row by row; an empty table gives no rows; other
columns are not read by ``assess`` and pass through ``filter_rows``. Memory is
that of one text's words at a time.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import fresh, quoted, text_of

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"


class TextFeatures:
    """Features of one text, each computed when first asked for."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode().split()  # bytes split at ASCII white space alone

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, SPACES))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def n_exclamations(self) -> int:
        return self.text.count("!")

    @cached_property
    def case_counts(self) -> tuple[int, int]:
        """(A-Z, a-z) letters."""
        counts = np.bincount(np.frombuffer(self.text.encode(), np.uint8), minlength=256)
        return int(counts[65:91].sum()), int(counts[97:123].sum())

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(SPACES)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def word_ids(self) -> np.ndarray:
        seen: dict[bytes, int] = {}
        return np.fromiter((seen.setdefault(w, len(seen)) for w in self.words), np.int64, self.n_words)

    @cached_property
    def n_repeat_words(self) -> int:
        ids = self.word_ids
        if len(ids) < 3:
            return 0
        size = int(ids.max()) + 1
        _, pair = np.unique(ids[:-2] * size + ids[1:-1], return_inverse=True)  # keeps the code below 2**63
        _, window, count = np.unique(pair * size + ids[2:], return_inverse=True, return_counts=True)
        again = count[window] > 1
        covered = np.zeros(len(ids), bool)
        for k in range(3):
            covered[k:len(ids) - 2 + k] |= again
        return int(covered.sum())

    @cached_property
    def top_word(self) -> int:
        return max(Counter(self.words).values(), default=0)


@dataclass(frozen=True)
class Rule:
    """``rejects`` tells whether a text fails."""
    name: str
    rejects: Callable[[TextFeatures], bool]


def base_failed(t: TextFeatures) -> bool:
    return t.n_words < 50 or 100 * t.n_repeat_words > 50 * t.n_words


RULES = (
    Rule("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    Rule("exclamations", lambda t: 5 * t.n_exclamations > t.n_words),
    Rule("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 15 * t.n_words),
    Rule("upper_case", lambda t: t.case_counts[0] > t.case_counts[1]),
    Rule("dup_lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
    Rule("repeat_words", lambda t: 10 * t.n_repeat_words > 4 * t.n_words),
    Rule("top_word", lambda t: 10 * t.top_word > 3 * t.n_words),
)


def _measure(rules: tuple[Rule, ...]):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        spent, rejected, seen = [0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for value in batch.column(0):
                text, seen = value.as_py(), seen + 1
                for k, rule in enumerate(rules):
                    features = TextFeatures(text)  # each rule pays for all it needs
                    begun = time.perf_counter_ns()
                    rejected[k] += rule.rejects(features)
                    spent[k] += time.perf_counter_ns() - begun
        yield pa.RecordBatch.from_pydict({"rule": pa.array(range(len(rules)), pa.int32()), "ns": pa.array(spent, pa.int64()),
                                          "rejected": pa.array(rejected, pa.int64()), "seen": pa.array([seen] * len(rules), pa.int64())})
    return run


def cascade_order(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000,
                  text_col: str = "text") -> list[tuple[str, float, float]]:
    """(rule, seconds per text, rejected share) in the order to run, from a sample
    of about ``sample_rows`` rows."""
    share = min(1.0, sample_rows / max(1, docs.count()))
    measured = (docs.sample(share, seed=11).select(text_of(docs, text_col).alias("text"))
                .mapInArrow(_measure(rules), "rule int, ns long, rejected long, seen long")
                .groupBy("rule").agg(F.sum("ns").alias("ns"), F.sum("rejected").alias("r"), F.sum("seen").alias("n")).collect())
    found = {r["rule"]: (r["ns"] / 1e9 / max(1, r["n"]), r["r"] / max(1, r["n"])) for r in measured}
    figures = [(rule.name, *found.get(k, (0.0, 0.0))) for k, rule in enumerate(rules)]
    return sorted(figures, key=lambda f: (-f[2] / max(f[1], 1e-9), f[1]))


def first_rejection(features: TextFeatures, rules: list[Rule]) -> str | None:
    """The cascade: name of the first rule that rejects, else None."""
    return next((rule.name for rule in rules if rule.rejects(features)), None)


BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


def _assess(rules: list[Rule]):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            rows = []
            for value in batch.column(1):
                t = TextFeatures(value.as_py())
                failed = base_failed(t)
                why = "base" if failed else first_rejection(t, rules)
                rows.append((t.n_words, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed, why is None, why))
            columns = list(zip(*rows)) or [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"])
    return run


def assess(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, the base counts, base_failed, kept and rejected_by,
    the rule that ended the cascade (which of several depends on the order)."""
    by_name = {r.name: r for r in rules}
    ordered = [by_name[name] for name, _, _ in cascade_order(docs, rules, sample_rows, text_col)]
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))
    return rows.mapInArrow(_assess(ordered), f"doc_id long, {BASE}, kept boolean, rejected_by string")


def filter_rows(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = 2000,
                text_col: str = "text") -> DataFrame:
    """The rows that pass, all columns; here the base rule and the cascade stop
    at the first rejection."""
    by_name = {r.name: r for r in rules}
    ordered = [by_name[name] for name, _, _ in cascade_order(docs, rules, sample_rows, text_col)]

    @F.pandas_udf("boolean")
    def passes(texts):
        return texts.map(lambda t: not base_failed(f := TextFeatures(t)) and first_rejection(f, ordered) is None).astype(bool)
    kept = fresh(docs, "_kept")
    return docs.withColumn(kept, passes(text_of(docs, text_col))).filter(F.col(kept)).drop(kept)
