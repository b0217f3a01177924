"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks (operator 3).

A text is cut into sentences and these into units: its words, every two
neighbouring words of a sentence (three when short), with the space as a character
that a triple can skip, runs of single characters with separators between them
("i - d - i - o - t") put together, and, in scripts written without spaces, every
three characters in a row. A run of separators inside a unit counts as one. Two
units are compared by the gapped subsequence kernel of order three: they share
every ordered triple of characters, discounted by ``DECAY`` per position it
spans, up to ``SPAN``. So an insult stays close to itself when characters are
inserted or left out. The alphabet is every letter and mark of the training
units; any other character is a gap that a triple can skip. With a large alphabet
triples are hashed into ``BUCKETS`` weights.

Fitting is bounded by three parameters: about ``train_rows`` labelled rows,
``most_units`` examples of a kind and ``landmarks``. One row per near-duplicate group is used: each distinct sentence carries the label of its documents, the
clean one if they differ; units far more common under the toxic label than chance allows among that many units are the
positive examples (Chernoff bound over all units), units of clean documents the
negative ones. Evidence of words and of phrases is weighed apart; a phrase with a
word that is positive by itself adds nothing. Landmarks from both, the positive ones
so that they cover the triples of all positive units, give the Nystroem map, and a linear SVM with
squared hinge loss is solved in it; the clean units that it scores highest join
the negative examples for the next of ``ROUNDS`` fits. The result folds back into one weight per character triple, so scoring a unit is a
sum of table look-ups. A sentence scores as its worst unit and a document as
its worst sentence; a logistic curve fitted on the same rows makes it a
probability.

Scores depend on the text alone. Every distinct unit is scored once per batch,
and a bounded table per Python worker remembers those seen before.

Defined cases: null and empty texts score as a text without units, at the
curve's foot; a null doc_id is not held out and has no label; repeated rows
score alike; with no labels, or one class only, every score is 0; other columns
are not read by ``assess`` and pass through ``keep_clean``.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.common import fresh, quoted, stage, text_of

DECAY = 0.6
SPAN = 5           # a triple covers at most SPAN + 1 characters
SHORTEST = 3       # shorter units are never evidence
NOTHING = -1e9     # what they score
LONGEST = 40       # longer units are read in overlapping windows
BUCKETS = 1 << 20  # weights of triples at most
SHORT = 12         # three words of no more characters are a unit too
GROUP = 128        # texts whose phrases are scored together
ROUNDS = 4
OFFSET = -1.0       # score of a unit that shares no triple with a landmark
EVIDENCE = 1.5      # surplus of a positive unit, in logarithms of the number of units
MASS = 1000.0      # weight of the examples of either sign against the ridge
HARD = 10.0         # weight of a clean unit that an earlier round scored highest
GAPS = [(j, k) for k in range(2, SPAN + 1) for j in range(1, k)]

_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_SPELLED = re.compile(r"(?<!\w)(?:\w[^\w\n]{1,5}){3,}\w(?!\w)")
_ALONE, _TOGETHER = re.compile(r"(?<!\w)\w(?!\w)"), re.compile(r"\w\w")
_GAP = re.compile(r"[\W_]{2,}")
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]{4,}")
_TRIM = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum()) + "«»„“”‚‘’…–—¡¿"


class Alphabet:
    """Codes of the letters, then one for any other character and one for the edge."""

    def __init__(self, letters: str):
        self.letters, self.other, self.edge, self.size = letters, len(letters), len(letters) + 1, len(letters) + 2
        self.table = np.full(0x110000, self.other, np.int32)
        for k, c in enumerate(letters):
            self.table[ord(c)] = k
        self.buckets = min(self.size ** 3, BUCKETS)

    def number(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        if self.size ** 3 <= BUCKETS:
            return (a * self.size + b) * self.size + c
        size = np.uint64(self.size)
        mixed = ((a.astype(np.uint64) * size + b.astype(np.uint64)) * size + c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(44)).astype(np.int64)


def learn_alphabet(words: list[str]) -> Alphabet:
    return Alphabet("".join(sorted(c for c in set().union(*words) if c.isalpha() or unicodedata.category(c)[0] == "M")))


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE.split(text) if s.strip()]


def units(text: str) -> set[str]:
    """Distinct words and spelled-out runs of a text (sentence borders don't cut a word)."""
    low = text.lower()
    found = set(low.split())
    for m in _SPELLED.finditer(low):
        found.add("".join(c for c in m[0] if c.isalnum()))
    if not low.isascii():
        for m in _UNSPACED.finditer(low):
            found.update(m[0][k:k + 3] for k in range(len(m[0]) - 2))
    return found


def phrases(text: str) -> set[str]:
    """Distinct pairs of neighbouring words, and short triples of them, within a sentence."""
    found = set()
    for sentence in sentences(text.lower()):
        words = [w for w in (w.strip(_TRIM) for w in sentence.split()) if w]
        found.update(map(" ".join, zip(words, words[1:])))
        found.update(f"{a} {b} {c}" for a, b, c in zip(words, words[1:], words[2:]) if len(a) + len(b) + len(c) <= SHORT)
    return found


def encode(words: list[str], alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, lengths, owner): a padded row of character codes, edges included,
    per window of a word; owner gives the word of a row."""
    rows = gaps_as_one(list(map(str.strip, words, repeat(_TRIM))))
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    owner = np.arange(len(rows))
    if lengths.max(initial=0) > LONGEST:
        cut = [[w] if len(w) <= LONGEST else [w[a:a + LONGEST] for a in range(0, len(w) - LONGEST // 2, LONGEST // 2)] for w in rows]
        owner = np.repeat(owner, np.fromiter(map(len, cut), np.int64, len(cut)))
        rows = [*chain.from_iterable(cut)]
        lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    return edged(rows, lengths, alphabet), lengths + 2, owner


def gaps_as_one(words: list[str]) -> list[str]:
    """A run of separators within a word as one space, by one substitution over all words."""
    whole = "A".join(words)  # a character of words, so no run crosses it; units are lower case
    if not words or whole.count("A") != len(words) - 1:
        return [_GAP.sub(" ", w) for w in words]
    return _GAP.sub(" ", whole).split("A") if _GAP.search(whole) else words


def edged(rows: list[str], lengths: np.ndarray, alphabet: Alphabet) -> np.ndarray:
    """A padded row of character codes, edges included, per string."""
    points = np.frombuffer("".join(rows).encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.full((len(rows), int(lengths.max(initial=0)) + 2), -1, np.int32)
    out[:, 1:-1][np.arange(out.shape[1] - 2) < lengths[:, None]] = alphabet.table[points]
    out[:, 0] = alphabet.edge
    out[np.arange(len(rows)), lengths + 1] = alphabet.edge
    return out


def scale_of(lengths: np.ndarray) -> np.ndarray:
    """Kernel normaliser: energy of the triples a unit of this length has."""
    energy = np.zeros(len(lengths))
    for _, k in GAPS:
        energy += np.maximum(lengths - k, 0) * DECAY ** (2 * k)
    return np.sqrt(np.maximum(energy, DECAY ** (2 * SPAN)))


def triples(codes: np.ndarray, alphabet: Alphabet):
    """(triple number or -1, discount) for every gap pattern, over all positions.
    A triple that uses another character does not count: that one is a gap."""
    valid = (codes >= 0) & (codes != alphabet.other)
    for j, k in GAPS:
        if codes.shape[1] <= k:
            continue
        a, b, c = codes[:, :-k], codes[:, j:j - k], codes[:, k:]
        ok = valid[:, :-k] & valid[:, j:j - k] & valid[:, k:]
        yield np.where(ok, alphabet.number(a, b, c), -1), DECAY ** k


def weighed(codes: np.ndarray, weights: np.ndarray, alphabet: Alphabet):
    """(weights of each row's triples by the place of their first character, its distance
    to the last one, discount) for every gap pattern; -1 is no character."""
    if alphabet.size ** 3 > BUCKETS:
        padded = np.append(weights.astype(np.float32), np.float32(0))  # triple -1 weighs nothing
        patterns = [k for _, k in GAPS if codes.shape[1] > k]
        for k, (number, discount) in zip(patterns, triples(codes, alphabet)):
            yield padded[number], k, np.float32(discount)
        return
    # no landmark has a triple with another character: such entries weigh nothing
    c = np.where(codes < 0, alphabet.other, codes).astype(np.int32)
    b = c * np.int32(alphabet.size)
    a = b * np.int32(alphabet.size)
    for k in range(2, SPAN + 1):
        if c.shape[1] > k:
            ends = a[:, :-k] + c[:, k:]
            for j in range(1, k):
                yield weights[ends + b[:, j:j - k]], k, np.float32(DECAY ** k)


def triple_sums(codes: np.ndarray, weights: np.ndarray, alphabet: Alphabet) -> np.ndarray:
    """Discounted sum of the weights of each row's triples; -1 is no character."""
    total = np.zeros(len(codes), np.float32)
    for values, _, discount in weighed(codes, weights, alphabet):
        total += discount * values.sum(axis=1)
    return total


def edge_sums(codes: np.ndarray, size: np.ndarray, weights: np.ndarray, alphabet: Alphabet) -> tuple[np.ndarray, ...]:
    """``triple_sums`` of rows of ``size`` characters between two edges, and those without
    the right edge and without the left one, from weights that are looked up once."""
    total, left, right = (np.zeros(len(codes), np.float32) for _ in range(3))
    for values, k, discount in weighed(codes, weights, alphabet):
        total += discount * values.sum(axis=1)
        begin = values[:, 0].copy()
        values[:, 0] = 0  # the triples that start at the left edge
        right += discount * values.sum(axis=1)
        values[:, 0] = begin
        rows = np.flatnonzero(size + 1 >= k)
        values[rows, size[rows] + 1 - k] = 0  # the triple that ends at the right edge
        left += discount * values.sum(axis=1)
    return total, left, right


def score_units(words: list[str], weights: np.ndarray, alphabet: Alphabet) -> np.ndarray:
    """Normalised sum over the triples of each word of their weights."""
    out = np.empty(len(words))
    order = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")  # little padding
    for at in range(0, len(words), 4096):
        part = order[at:at + 4096]
        codes, lengths, owner = encode([words[k] for k in part], alphabet)
        best = np.full(len(part), NOTHING)
        long = lengths >= SHORTEST + 2
        np.maximum.at(best, owner[long], (triple_sums(codes, weights, alphabet) / scale_of(lengths))[long])
        out[part] = best
    return out


def kernel(words: list[str], marks: list[str], alphabet: Alphabet) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(kernel of words and marks, triples of the marks, their vectors)."""
    codes, lengths, owner = encode([m.strip(_TRIM)[:LONGEST] for m in marks], alphabet)
    scale, found = scale_of(lengths), list(triples(codes, alphabet))
    used = np.unique(np.concatenate([n[n >= 0] for n, _ in found]))
    vectors = np.zeros((len(used) + 1, len(marks)), np.float32)  # the last row stands for all other triples
    for number, discount in found:
        row, _ = np.nonzero(number >= 0)
        np.add.at(vectors, (np.searchsorted(used, number[number >= 0]), owner[row]), (discount / scale[row]).astype(np.float32))
    place = np.full(alphabet.buckets + 1, len(used), np.int32)
    place[used] = np.arange(len(used))
    out = np.zeros((len(words), len(marks)), np.float32)
    for at in range(0, len(words), 512):
        codes, lengths, _ = encode([w.strip(_TRIM)[:LONGEST] for w in words[at:at + 512]], alphabet)
        for number, discount in triples(codes, alphabet):
            for column in place[number].T:
                out[at:at + 512] += np.float32(discount) * vectors[column]
        out[at:at + 512] /= scale_of(lengths)[:, None]
    return out, used, vectors[:-1]


@dataclass
class Model:
    letters: str = ""
    weights: np.ndarray | None = None  # one per triple
    slope: float = 0.0
    shift: float = 0.0

    def probability(self, margin: float) -> float:
        if self.weights is None:
            return 0.0
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, self.slope * margin + self.shift))))


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    """Weighted squared-hinge SVM by Newton steps on the active examples. The
    offset is fixed at OFFSET: a unit unlike every landmark scores as clean."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        active = y * (x @ w + OFFSET) < 1
        a = x[active]
        new = np.linalg.solve((a * weight[active][:, None]).T @ a + ridge * np.eye(len(w)),
                              a.T @ (weight[active] * (y[active] - OFFSET)))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def fit_curve(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Logistic curve of the margin, with the smoothed targets of Platt's method."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 0.0, math.log((n1 + 1) / (n0 + 1))

    def loss(a, b):
        t = a * margin + b
        return float(np.sum(np.logaddexp(0, t) - target * t))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -50, 50)))
        d, h = p - target, np.maximum(p * (1 - p), 1e-12)
        g = np.array([(d * margin).sum(), d.sum()])
        m = np.array([[(h * margin * margin).sum() + 1e-9, (h * margin).sum()], [(h * margin).sum(), h.sum() + 1e-9]])
        step, size, now = np.linalg.solve(m, g), 1.0, loss(a, b)
        while size > 1e-6 and loss(a - size * step[0], b - size * step[1]) > now:
            size /= 2
        a, b = a - size * step[0], b - size * step[1]
        if abs(size * step).max() < 1e-8:
            break
    return a, b


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _labelled_sentences(batches: Iterator) -> Iterator:
    import pyarrow as pa
    for batch in batches:
        found, label = [], []
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = set(sentences(text))
            found += own
            label += [toxic] * len(own)
        yield pa.RecordBatch.from_pydict({"sentence": pa.array(found, pa.string()), "toxic": pa.array(label, pa.int64())})


def _evidence(batches: Iterator) -> Iterator:
    """Distinct units of labelled sentences."""
    import pyarrow as pa
    for batch in batches:
        words, label = [], []
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            kept = {u for u in (w.strip(_TRIM) for w in units(text)) if SHORTEST <= len(u) <= LONGEST}
            kept |= {u for u in phrases(text) if SHORTEST <= len(u) <= LONGEST}
            words += kept
            label += [toxic] * len(kept)
        yield pa.RecordBatch.from_pydict({"unit": pa.array(words, pa.string()), "toxic": pa.array(label, pa.int64())})


def _margins(model: Model, limit: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            out = _margins_of(batch.column(1).to_pylist(), model, limit)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["key", "margin"])
    return run


_SEEN: dict[bytes, Lexicon] = {}  # per worker: model -> what it has seen
FLOOR = -2.0  # margin of a text without units
_LINE = "\ufdd0\ufdd1\ufdd0"  # noncharacters that stand for a line's end among tokens
_EDGE = SPAN  # characters at a word's edge that a triple over the space can reach


class Lexicon:
    """Tokens that a worker has seen, with all that scoring units of them needs.

    The triples of two words with a space are those of the first word with its
    left edge, those of the second with its right edge, and the few that cross the
    space, which lie in the last and first ``SPAN`` characters. So a pair costs two
    look-ups and the crossing triples. Words with marks inside or at their edges,
    and pairs too long for one window, are scored as strings."""

    def __init__(self, model: Model):
        self.alphabet, self.weights = Alphabet(model.letters), model.weights.astype(np.float32)
        self.ids: dict[str, int] = {}
        self.words: list[str] = []
        self.other: dict[str, float] = {}  # units that are no tokens, and phrases scored as strings
        self.own, self.left, self.right = (np.zeros(0, np.float32) for _ in range(3))
        self.size, self.shown, self.codes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros((0, SHORT), np.int32)
        self.head, self.tail = (np.zeros((0, _EDGE), np.int32) for _ in range(2))
        self.ends, self.plain, self.loose = (np.zeros(0, bool) for _ in range(3))
        self.alone = np.zeros(0, np.int32)
        self.scale = scale_of(np.arange(LONGEST + 3)).astype(np.float32)
        # (columns of tail, space and head, discount) of the triples that cross the space
        span = range(2 * _EDGE + 1)
        self.cross = [(i, j, k, DECAY ** (k - i)) for i in span[:_EDGE] for k in span[_EDGE + 1:] if k - i <= SPAN
                      for j in range(i + 1, k) if j != _EDGE]

    def put(self, name: str, new: np.ndarray) -> None:
        """Write the values of new tokens behind the known ones; arrays grow by doubling."""
        at, old = len(self.ids), getattr(self, name)
        if at + len(new) > len(old):
            grown = np.zeros((max(2 * len(old), at + len(new)), *old.shape[1:]), old.dtype)
            grown[:at] = old[:at]
            setattr(self, name, grown)
        getattr(self, name)[at:at + len(new)] = new

    def learn(self, tokens: list[str]) -> None:
        alphabet, words = self.alphabet, list(map(str.strip, tokens, repeat(_TRIM)))
        whole = list(map(str.isalnum, words))
        plain = np.array([0 < len(w) <= LONGEST and (a or (w[0].isalnum() and w[-1].isalnum() and not _GAP.search(w)))
                          for w, a in zip(words, whole)], bool)
        rows = [w if p else "" for w, p in zip(words, plain.tolist())]
        size = np.fromiter(map(len, rows), np.int64, len(rows))
        codes = edged(rows, size, alphabet)
        n, width = len(tokens), codes.shape[1]
        place = np.arange(_EDGE)
        begin = np.full((n, _EDGE + width), alphabet.other, np.int32)  # padded on the left
        begin[:, _EDGE:] = np.where(codes < 0, alphabet.other, codes)
        tail = begin[np.arange(n)[:, None], _EDGE + 1 + size[:, None] - _EDGE + place]
        after = np.full((n, width + _EDGE), alphabet.other, np.int32)
        after[:, :width] = begin[:, _EDGE:]
        total, left, right = edge_sums(codes, size, self.weights, alphabet)
        short = np.full((n, max(SHORT, width)), alphabet.other, np.int32)
        short[:, :width - 2] = np.where(np.arange(1, width - 1) <= size[:, None], after[:, 1:width - 1], alphabet.other)
        own = np.where(size >= SHORTEST, total / self.scale[size + 2], NOTHING)
        odd = np.flatnonzero(~plain)
        if len(odd):
            own[odd] = score_units([tokens[k] for k in odd], self.weights, alphabet)
        self.put("own", own)
        self.put("left", left)
        self.put("right", right)
        self.put("size", size)
        self.put("codes", short[:, :SHORT])
        self.put("shown", np.fromiter(map(len, words), np.int64, n))
        self.put("head", after[:, 1:1 + _EDGE])
        self.put("tail", tail)
        self.put("ends", np.array([t[-1] in ".!?" for t in tokens], bool))
        self.put("plain", plain)
        # single characters in the token, and whether it has nothing longer
        joint = [a and len(w) > 1 and "_" not in t for t, w, a in zip(tokens, words, whole)]  # one run of letters, marks around it
        self.put("alone", np.fromiter((0 if b else len(_ALONE.findall(t)) for t, b in zip(tokens, joint)), np.int64, n))
        self.put("loose", np.array([not b and _TOGETHER.search(t) is None for t, b in zip(tokens, joint)], bool))
        self.words += words
        for t in tokens:
            self.ids[t] = len(self.ids)

    def strings(self, found: list[str], keep: int) -> list[float]:
        """Scores of units as strings, remembered up to a number."""
        new = list({u for u in found if u not in self.other})
        got = dict(zip(new, score_units(new, self.weights, self.alphabet).tolist())) if new else {}
        out = [self.other[u] if u in self.other else got[u] for u in found]
        self.other.update(list(got.items())[:max(0, keep - len(self.other))])
        return out

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Scores of plain words a and b with a space between."""
        columns = np.concatenate([self.tail[a].T, np.full((1, len(a)), self.alphabet.other, np.int32), self.head[b].T])
        total = self.left[a] + self.right[b]
        if self.alphabet.size ** 3 > BUCKETS:
            padded = np.append(self.weights, np.float32(0))
            valid = columns != self.alphabet.other
            for i, j, k, discount in self.cross:
                number = np.where(valid[i] & valid[j] & valid[k], self.alphabet.number(columns[i], columns[j], columns[k]), -1)
                total += np.float32(discount) * padded[number]
        else:
            middle = columns * np.int32(self.alphabet.size)
            first = middle * np.int32(self.alphabet.size)
            for i, j, k, discount in self.cross:
                total += np.float32(discount) * self.weights[first[i] + middle[j] + columns[k]]
        return total / self.scale[self.size[a] + self.size[b] + 3]

    def threes(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Scores of short plain words a, b and c with spaces between."""
        rows, at = np.arange(len(a))[:, None], np.arange(SHORT)
        codes = np.full((len(a), 3 * SHORT + 4), self.alphabet.other, np.int32)
        codes[:, 0] = self.alphabet.edge
        start = np.ones(len(a), np.int64)
        for w in (a, b, c):  # a later word overwrites the padding of the one before
            codes[rows, start[:, None] + at] = self.codes[w]
            start = start + self.size[w] + 1
        codes[np.arange(len(a)), start - 1] = self.alphabet.edge
        codes = codes[:, :SHORT + 4]
        return triple_sums(codes, self.weights, self.alphabet) / self.scale[start]

    def spelled(self, ids: np.ndarray, owner: np.ndarray) -> list[int]:
        """The texts that can hold a spelled-out run: four single characters from
        one token with something longer to the next, both included."""
        upto = np.concatenate([[0], np.cumsum(self.alone[ids])])
        border = np.concatenate([[0], np.flatnonzero(~self.loose[ids]), [len(ids)]])
        last = np.minimum(border[1:] + 1, len(ids))
        many = np.flatnonzero(upto[last] - upto[border[:-1]] >= 4)
        return sorted({int(k) for i in many for k in np.unique(owner[border[i]:last[i]])})

    def best(self, texts: list[str], limit: int) -> np.ndarray:
        """The highest score of a unit or phrase of each text; NOTHING without any."""
        if len(self.ids) > limit:
            self.__init__(Model(self.alphabet.letters, self.weights))
        lows = [t.lower() for t in texts]
        tokens = [low.replace("\n", f" {_LINE} ").split() if "\n" in low else low.split() for low in lows]
        flat, counts = [*chain.from_iterable(tokens)], np.fromiter(map(len, tokens), np.int64, len(tokens))
        ids = np.fromiter(map(self.ids.get, flat, repeat(-1)), np.int64, len(flat))
        unknown = np.flatnonzero(ids < 0)
        late = [flat[i] for i in unknown.tolist()]
        new = sorted(set(late), key=len)  # little padding
        for at in range(0, len(new), 1024):
            self.learn(new[at:at + 1024])
        ids[unknown] = [*map(self.ids.__getitem__, late)]
        owner = np.repeat(np.arange(len(texts)), counts)
        best = np.full(len(texts), NOTHING)
        extra: list[tuple[int, str]] = []
        for k, low in enumerate(lows):
            if not low.isascii():
                extra += [(k, m[0][i:i + 3]) for m in _UNSPACED.finditer(low) for i in range(len(m[0]) - 2)]
        for k in self.spelled(ids, owner):
            extra += [(k, "".join(c for c in m[0] if c.isalnum())) for m in _SPELLED.finditer(lows[k])]
        line = self.ids.get(_LINE, -1)
        is_word = ids != line
        raise_to(best, owner[is_word], self.own[ids[is_word]])
        # sentences end after a mark, at a line's end and at a text's end; empty words are left out
        sentence = np.zeros(len(ids), np.int64)
        if len(ids):
            cut = self.ends[ids] | ~is_word
            sentence[1:] = np.cumsum(cut[:-1] | (owner[1:] != owner[:-1]))
        full = is_word & (self.shown[ids] > 0)
        w, o, sent = ids[full], owner[full], sentence[full]
        for n in (2, 3):
            if len(w) < n:
                continue
            near = sent[n - 1:] == sent[:len(sent) - n + 1]
            part = [w[k:len(w) - n + 1 + k][near] for k in range(n)]
            own = o[:len(w) - n + 1][near]
            if n == 3:
                short = sum(self.shown[p] for p in part) <= SHORT
                part, own = [p[short] for p in part], own[short]
            if not len(own):
                continue
            simple = np.logical_and.reduce([self.plain[p] for p in part]) & (sum(self.size[p] for p in part) + n - 1 <= LONGEST)
            plain = [p[simple] for p in part]
            if n == 2:  # few pairs repeat within a group: finding them costs more than scoring them
                raise_to(best, own[simple], self.pairs(*plain))
            elif len(plain[0]):
                key = (plain[0] * len(self.ids) + plain[1]) * len(self.ids) + plain[2]
                _, first, back = np.unique(key, return_index=True, return_inverse=True)
                raise_to(best, own[simple], self.threes(*[p[first] for p in plain])[back])
            odd = np.flatnonzero(~simple)
            extra += [(int(own[i]), " ".join(self.words[p[i]] for p in part)) for i in odd]
        if extra:
            np.maximum.at(best, [k for k, _ in extra], self.strings([u for _, u in extra], limit))
        return best


def raise_to(best: np.ndarray, owner: np.ndarray, score: np.ndarray) -> None:
    """The highest score of each owner into ``best``; owners ascend."""
    if len(owner):
        start = np.concatenate([[0], np.flatnonzero(owner[1:] != owner[:-1]) + 1])
        best[owner[start]] = np.maximum(best[owner[start]], np.maximum.reduceat(score, start))


def _margins_of(texts: list[str], model: Model, limit: int) -> list[float]:
    """Margin of each text, GROUP texts at a time."""
    if model.weights is None:
        return [FLOOR] * len(texts)
    key = np.float64([model.weights.sum(), model.weights[::97].sum(), model.slope]).tobytes() + model.letters.encode()
    if key not in _SEEN:
        _SEEN.clear()
        _SEEN[key] = Lexicon(model)
    out: list[float] = []
    for at in range(0, len(texts), GROUP):
        out += np.maximum(_SEEN[key].best(texts[at:at + GROUP], limit) + OFFSET, FLOOR).tolist()
    return out


def _unit_margins(model: Model):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        alphabet = Alphabet(model.letters)
        for batch in batches:
            got = score_units(batch.column(0).to_numpy(zero_copy_only=False).tolist(), model.weights, alphabet) + OFFSET
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got)], names=["unit", "n", "margin"])
    return run


def gapped(word: str, letters: str) -> list[str]:
    """The word with one more character inside, at every place: a mark, and a
    letter that depends on the place only."""
    return [word[:k] + c + word[k:] for k in range(1, len(word)) for c in (".", letters[(7 * k + len(word)) % len(letters)])]


def covering(words: list[str], alphabet: Alphabet, least: int, most: int) -> list[str]:
    """The first ``least`` words, then each word of whose triples over half are in
    none before it, up to ``most``."""
    codes, _, owner = encode(words, alphabet)
    own = [set() for _ in words]
    for number, _ in triples(codes, alphabet):
        for k, n in zip(owner, number):
            own[k].update(n[n >= 0].tolist())
    chosen, known = [], set()
    for k, word in enumerate(words):
        if k < least or 2 * len(own[k] - known) > len(own[k]):
            chosen.append(word)
            known |= own[k]
    return chosen[:most]


def _solve(up: dict[str, float], down: dict[str, float], marks: list[str], alphabet: Alphabet) -> Model:
    """SVM over the Nystroem map of the landmarks, folded into triple weights."""
    gram, used, vectors = kernel(marks, marks, alphabet)
    value, vector = np.linalg.eigh(gram.astype(np.float64))
    keep = value > 1e-6 * value.max()
    whiten = vector[:, keep] / np.sqrt(value[keep])
    near = kernel([*up, *down], marks, alphabet)[0] @ whiten
    mass = [np.array(list(side.values()), float) for side in (up, down)]
    w = fit_svm(near, np.array([1.0] * len(up) + [-1.0] * len(down)), MASS * np.concatenate([m / m.sum() for m in mass]))
    weights = np.zeros(alphabet.buckets, np.float32)
    weights[used] = vectors @ (whiten @ w)
    return Model(alphabet.letters, weights)


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = 20_000, landmarks: int = 512, most_units: int = 4000,
        id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", limit: int = 500_000) -> Model:
    """Fit on about ``train_rows`` labelled rows that are not held out."""
    usable = (labels.select(F.col(quoted(id_col)).alias("k"), F.col(quoted(label_col)).cast("long").alias("toxic"))
              .filter(F.col("k").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("k"))))
    total = usable.count()
    if not total:
        return Model()
    share = min(1.0, train_rows / total)
    mixed = F.pmod(F.xxhash64("k", F.lit(3)), F.lit(1 << 20))
    picked = usable.filter(mixed < int(share * (1 << 20))).groupBy("k").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col(quoted(id_col)).alias("k"), text_of(docs, text_col).alias("text"))
    # at most about train_rows rows of two numbers: a size known before the data is
    train = stage(rows.join(F.broadcast(picked), "k").select(F.col("k").alias("doc_id"), "text", "toxic"), "labelled")
    # near copies of one document are one piece of evidence
    train = stage(simhash.deduplicate(train).select("text", "toxic"), "labelled-once")
    if train.select("toxic").distinct().count() < 2:
        return Model()
    # so are repeated passages, and what a clean document also has is clean
    said = stage(train.mapInArrow(_labelled_sentences, "sentence string, toxic long").groupBy("sentence")
                 .agg(F.min("toxic").alias("toxic")), "sentences")
    size = {r["toxic"]: r["count"] for r in said.groupBy("toxic").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:
        return Model()
    counts = stage(said.mapInArrow(_evidence, "unit string, toxic long").groupBy("unit")
                   .agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")), "units")
    base = n1 / (n1 + n0)
    rate = F.least(F.col("t") / F.col("n"), F.lit(1 - 1e-9))
    surplus = F.col("n") * (rate * F.log(rate / base) + (1 - rate) * F.log((1 - rate) / (1 - base)))
    ranked = counts.withColumn("e", F.when(rate > base, surplus).otherwise(F.lit(0.0)))
    up, down, few, floor = {}, {}, {}, F.lit(0.0)
    phrase = F.col("unit").contains(" ")
    for kind in (~phrase, phrase):
        own = ranked.filter(kind)
        chance = math.log(max(2, own.count()))
        best = own.filter((F.col("t") >= 2) & (2 * F.col("t") > F.col("n"))).orderBy(F.desc("e"), "unit").limit(most_units).collect()
        few = few or {r["unit"]: 1.0 for r in best[:20]}
        up |= {r["unit"]: math.sqrt(r["t"]) for r in best
               if r["e"] > EVIDENCE * chance and not any(w in up for w in r["unit"].split(" "))}
        clean = own.filter((F.col("e") < chance / 2) & (F.col("n") > F.col("t")))
        common = clean.orderBy(F.desc("n"), "unit").limit(most_units).collect()
        random = clean.orderBy(F.xxhash64("unit", F.lit(5)), "unit").limit(most_units).collect()
        down |= {r["unit"]: math.sqrt(r["n"]) for r in [*random, *common]}
        floor = F.when(kind, F.lit(chance / 2)).otherwise(floor)
    up = up or few
    down = {u: m for u, m in down.items() if u not in up}
    clean = ranked.filter((F.col("e") < floor) & (F.col("n") > F.col("t")))
    if not up or not down:
        return Model()
    alphabet = learn_alphabet([*up, *down])
    third = landmarks // 3
    marks = [*covering(list(up), alphabet, third, landmarks), *list(down)[::max(1, len(down) // third)][:third]]
    for u, m in list(up.items())[:most_units // 10]:
        near = [g for g in gapped(u, alphabet.letters) if g not in down]
        up |= {g: m / (2 * len(near)) for g in near if g not in up}
    model = _solve(up, down, marks, alphabet)
    for _ in range(ROUNDS - 1):
        hard = (clean.select("unit", (F.col("n") - F.col("t")).alias("n")).mapInArrow(_unit_margins(model), "unit string, n long, margin double")
                .filter("margin > -1").orderBy(F.desc("margin"), "unit").limit(most_units // 4).collect())
        down |= {r["unit"]: HARD * math.sqrt(r["n"]) for r in hard if r["unit"] not in up}
        marks = list(dict.fromkeys([*marks, *(r["unit"] for r in hard[:third // (ROUNDS - 1)])]))
        model = _solve(up, down, marks, alphabet)
    got = (train.select(F.col("toxic").alias("key"), "text").mapInArrow(_margins(model, limit), "key long, margin double")
           .toPandas())
    a, b = fit_curve(got["margin"].to_numpy(), got["key"].to_numpy())
    return Model(model.letters, model.weights, a, b)


def assess(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", limit: int = 500_000) -> DataFrame:
    """One row per row: doc_id, held_out, score, predicted."""
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), text_of(docs, text_col).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            out = [model.probability(m) for m in _margins_of(batch.column(1).to_pylist(), model, limit)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], names=["doc_id", "score"])
    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", limit: int = 500_000) -> DataFrame:
    """The rows scored below 0.5, all columns."""
    @F.pandas_udf("double")
    def score(texts):
        got = [model.probability(m) for m in _margins_of(texts.tolist(), model, limit)]
        return texts.map(dict(zip(texts, got))).astype(float)
    name = fresh(docs, "_toxicity")
    return docs.withColumn(name, score(text_of(docs, text_col))).filter(F.col(name) < 0.5).drop(name)
