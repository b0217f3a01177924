"""Secret scan with a randomness test battery (operator 9), DataFrame functions only.

Base kinds are found by regular expressions, leftmost and non-overlapping per
kind. The method adds ``random`` spans: runs of 16 or more encoding characters,
at least one a letter, that touch no base span. The encoding of a run is the
smallest of ``ALPHABETS`` that holds all its characters. Two decisions follow:

1. The battery: chi-squared uniformity over the encoding's alphabet, a runs
   test about its middle and lag-one serial correlation, each with its exact
   mean and variance for the token's length, joined by Fisher's method. The
   token must not be rejected as random at ``BATTERY``.
2. Length-aware false-discovery control. The likelihood ratio of a token under
   its uniform alphabet and under the ordinary words of the corpus, divided by
   the number of alphabets to choose from, is an e-value against "ordinary run"
   and grows with length. Within each length band, all candidates of the corpus
   are ranked by it (in a histogram of fixed size) and the e-value form of the
   Benjamini-Hochberg procedure keeps the share of false discoveries at most
   ``RATE``.

Ordinary words are the shorter runs of the texts (2 to 15 characters, every
occurrence), so the strings looked for never shape what counts as ordinary. A
character's probability is that of its class after the class before it
(upper, lower, digit, sign) times that of the character, case aside, after the one
before it; both keep a fixed share of the plainer rule (``SWITCH``, ``SINGLE``), so
that one rare pair or change of case can't make a run.

Positions are code points, ends exclusive. Statistics over the corpus cover
every candidate and every shorter run; what reaches the driver is one count per
pair of the 66 encoding characters.

Defined cases: a null text is the empty text; null and repeated ids go through
row by row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import quoted, stage, text_of

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
# a run is matched whole, so asking for the length here drops the same matches
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}"
KINDS = ("assign", "access", "hex", "random")

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The alphabets of common text encodings, the smaller first
ALPHABETS = {"hex": DIGITS + "ABCDEF", "hex_lower": DIGITS + "abcdef", "upper": UPPER, "lower": LOWER,
             "base32": UPPER + "234567", "base32_lower": LOWER + "234567", "base36": DIGITS + UPPER, "base36_lower": DIGITS + LOWER,
             "letters": UPPER + LOWER, "base58": "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz",
             "base62": UPPER + LOWER + DIGITS, "base64": UPPER + LOWER + DIGITS + "+/", "base64url": UPPER + LOWER + DIGITS + "-_"}
CHARACTERS = UPPER + LOWER + DIGITS + "+/-_"
SWITCH, SINGLE = 0.05, 0.1  # shares of the plainer rule: class by chance, character by itself

BATTERY = 0.01
RATE = 0.01
BANDS = (24, 32, 48, 96)  # upper ends of the length bands; the last is open
BIN, LAST_BIN = 0.25, 800
SCAN = 512


def _before(lengths: Column) -> Column:
    """Exclusive prefix sums of an array, scanned in blocks of SCAN entries so
    that a text with very many matches stays near-linear."""
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")
    starts = F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(SCAN))
    scan = F.transform(starts, lambda i: F.aggregate(
        F.slice(lengths, i, SCAN), F.struct(zero.alias("t"), none.alias("o")),
        lambda a, x: F.struct((a["t"] + x).alias("t"), F.concat(a["o"], F.array(a["t"])).alias("o"))))
    return F.aggregate(
        scan, F.struct(zero.alias("t"), none.alias("o")),
        lambda a, b: F.struct((a["t"] + b["t"]).alias("t"),
                              F.concat(a["o"], F.transform(b["o"], lambda v: v + a["t"])).alias("o")))["o"]


def _spans(text: Column, pattern: str, matches: Column, checked: Column) -> Column:
    """array<struct<start, end, found>> of the matches of a pattern. ``checked``
    holds the part of each match that is passed on."""
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("long"))
    sizes = F.transform(matches, lambda m: F.length(m).cast("long"))
    steps = F.zip_with(F.slice(gaps, 1, F.size(sizes)), sizes, lambda g, s: g + s)
    starts = F.zip_with(_before(steps), F.slice(gaps, 1, F.size(sizes)), lambda b, g: b + g)
    whole = F.zip_with(starts, sizes, lambda b, s: F.struct(b.alias("start"), (b + s).alias("end")))
    out = F.zip_with(whole, checked, lambda w, c: F.struct(w["start"].alias("start"), w["end"].alias("end"), c.alias("found")))
    none = F.array().cast("array<struct<start:bigint,end:bigint,found:string>>")
    return F.when(F.size(matches) > 0, out).otherwise(none)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One written row per row: rid, doc_id, the spans of the base kinds and the
    candidate runs."""
    every = lambda p, g=0: F.regexp_extract_all("t", F.lit(p), F.lit(g))
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), text_of(docs, text_col).alias("t"))
    rows = rows.select("doc_id", "t", every(ASSIGN).alias("m1"), every(ACCESS).alias("m2"), every(HEX).alias("m3"),
                       every(CANDIDATE).alias("m4"))
    text = F.col("t")
    values = F.when(F.size("m1") > 0, every(ASSIGN, 2)).otherwise(F.array().cast("array<string>"))
    spans = {"assign": _spans(text, ASSIGN, F.col("m1"), values), "access": _spans(text, ACCESS, F.col("m2"), F.col("m2")),
             "hex": _spans(text, HEX, F.col("m3"), F.col("m3")), "runs": _spans(text, CANDIDATE, F.col("m4"), F.col("m4"))}
    least = {"assign": 12, "access": 18, "hex": 16}
    out = rows.select("doc_id", *[s.alias(k) for k, s in spans.items()])
    bare = lambda k: F.transform(F.filter(k, lambda s: F.length(s["found"]) >= least[k]),
                                 lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return stage(out.select(F.monotonically_increasing_id().alias("rid"), "doc_id", bare("assign").alias("assign"),
                            bare("access").alias("access"), bare("hex").alias("hex"), "runs"), "spans")


def _log_p(z: Column) -> Column:
    """ln of the two-sided normal tail, by the logistic form of the normal law."""
    a = F.least(F.abs(z), F.lit(20.0))
    return F.lit(math.log(2)) - F.log1p(F.exp(F.lit(1.5976) * a + F.lit(0.070566) * a * a * a))


def battery(tokens: DataFrame) -> DataFrame:
    """Adds n, size (of the alphabet), p_random to rows with ``body`` and ``encoding``."""
    place = F.when(F.lit(False), F.lit(""))
    for name, letters in ALPHABETS.items():
        place = place.when(F.col("encoding") == name, F.lit(letters))
    out = (tokens.withColumn("letters", place).withColumn("size", F.length("letters").cast("double"))
           .withColumn("x", F.transform(F.split("body", ""), lambda c: F.instr(F.col("letters"), c).cast("double") - 1))
           .withColumn("n", F.size("x").cast("double")))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    n, k = F.col("n"), F.col("size")
    squares = total(F.transform(F.array_distinct("x"), lambda v: F.pow(F.size(F.filter("x", lambda y: y == v)).cast("double"), 2.0)))
    next_x = F.slice("x", 2, F.size("x"))
    this_x = F.slice("x", 1, F.size("x") - 1)
    out = (out.withColumn("chi", squares * k / n - n).withColumn("mean", total(F.col("x")) / n)
           .withColumn("high", total(F.transform("x", lambda v: F.when(v >= F.col("size") / 2, 1.0).otherwise(0.0))))
           .withColumn("runs", 1.0 + total(F.zip_with(this_x, next_x, lambda a, b: F.when(
               (a >= F.col("size") / 2) != (b >= F.col("size") / 2), 1.0).otherwise(0.0))))
           .withColumn("lag", total(F.zip_with(this_x, next_x, lambda a, b: (a - F.col("mean")) * (b - F.col("mean")))))
           .withColumn("dev", total(F.transform("x", lambda v: (v - F.col("mean")) * (v - F.col("mean"))))))
    expected = 2 * F.col("high") * (n - F.col("high")) / n + 1
    spread = (expected - 1) * (expected - 2) / (n - 1)
    z1 = (F.col("chi") - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    z2 = F.when(spread > 0, (F.col("runs") - expected) / F.sqrt(spread)).otherwise(F.lit(20.0))
    z3 = F.when(F.col("dev") > 0, (F.col("lag") / F.col("dev") + 1 / n) * F.sqrt(n)).otherwise(F.lit(20.0))
    half = -(_log_p(z1) + _log_p(z2) + _log_p(z3))
    out = out.withColumn("half", half)
    p = F.exp(-F.col("half")) * (1 + F.col("half") + F.col("half") * F.col("half") / 2)
    return out.withColumn("p_random", p).drop("letters", "x", "chi", "mean", "high", "runs", "lag", "dev", "half")


def pair_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(pair, n): how often two encoding characters follow each other in the
    runs of 2 to 15, and (one character) how often a run starts with it. Runs are
    counted per distinct run first, so the pairs of a frequent word are cut once."""
    words = (docs.select(F.explode(F.split(text_of(docs, text_col), "[^A-Za-z0-9+/_-]+")).alias("w"))
             .filter(F.length("w").between(2, 15)).groupBy("w").agg(F.count(F.lit(1)).alias("n")))
    cuts = F.transform(F.sequence(F.lit(0), F.length("w") - 1), lambda i: F.substring(
        F.col("w"), F.greatest(i, F.lit(1)), F.when(i == 0, 1).otherwise(2)))
    return words.select(F.explode(cuts).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))


def ordinary(counts: dict[str, int]) -> tuple[list[float], list[float]]:
    """Minus the log-probability of an ordinary run's first character, and of
    each character after each (row by row of ``CHARACTERS``)."""
    kind = lambda c: 0 if c.isalpha() else 1 if c.isdigit() else 2
    group = lambda c: 3 if c.isupper() else kind(c)
    fold = {c: c.lower() for c in CHARACTERS}
    sizes = Counter(kind(c) for c in set(fold.values()))
    start, single, kinds, switch, follow, context = (Counter() for _ in range(6))
    for pair, n in counts.items():
        a, b = fold.get(pair[:-1]), fold[pair[-1]]
        single[b] += n
        kinds[kind(b)] += n
        if a is None:
            start[group(pair[-1])] += n
        else:
            switch[group(pair[0]), group(pair[1])] += n
            follow[a, b] += n
            context[a, kind(b)] += n
    alone = lambda c: (single[fold[c]] + 1) / (kinds[kind(c)] + sizes[kind(c)])

    def after(a, b):
        out_of = sum(switch[group(a), g] for g in range(4)) + 4
        change = (1 - SWITCH) * (switch[group(a), group(b)] + 1) / out_of + SWITCH / 4
        size = sizes[kind(b)]
        near = (follow[fold[a], fold[b]] + size * alone(b)) / (context[fold[a], kind(b)] + size)
        return -math.log(change * ((1 - SINGLE) * near + SINGLE * alone(b)))
    begun = sum(start.values()) + 4
    return [-math.log((start[group(c)] + 1) / begun * alone(c)) for c in CHARACTERS], [after(a, b) for a in CHARACTERS for b in CHARACTERS]


def discoveries(found: DataFrame, first: list[float], pairs: list[float]) -> DataFrame:
    """(rid, start, end) of the random runs; ``first`` and ``pairs`` as ``ordinary`` gives them."""
    runs = (found.select("rid", F.explode("runs").alias("r"))
            .select("rid", "r.start", "r.end", F.rtrim(F.col("r.found"), F.lit("=")).alias("body")))
    encoding = F.when(~F.col("body").rlike("[A-Za-z]"), F.lit(None).cast("string"))
    for name, letters in ALPHABETS.items():
        encoding = encoding.when(F.translate("body", letters, "") == "", F.lit(name))
    band = F.lit(len(BANDS))
    for k, top in reversed(list(enumerate(BANDS))):
        band = F.when(F.col("n") < top, F.lit(k)).otherwise(band)
    coded = battery(runs.withColumn("encoding", encoding).filter(F.col("encoding").isNotNull()))
    numbers = lambda v: F.split(F.lit(",".join(map(repr, v))), ",").cast("array<double>")
    place = F.transform(F.split("body", ""), lambda c: F.instr(F.lit(CHARACTERS), c))
    steps = F.zip_with(F.slice("place", 1, F.size("place") - 1), F.slice("place", 2, F.size("place")),
                       lambda a, b: F.element_at(numbers(pairs), (a - 1) * len(CHARACTERS) + b))
    own = F.element_at(numbers(first), F.element_at("place", 1)) + F.aggregate(steps, F.lit(0.0), lambda s, v: s + v)
    level = F.floor((own - F.col("n") * F.log("size") - math.log(len(ALPHABETS))) / BIN)
    tested = stage(coded.withColumn("place", place).withColumn("band", band)
                   .withColumn("level", F.greatest(F.lit(0), F.least(level, F.lit(LAST_BIN))).cast("int"))
                   .select("rid", "start", "end", "band", "level", "p_random"), "tested")
    # a run of no known encoding is a candidate whose e-value is 0: it counts, and can't be found
    sizes = (runs.select(F.length("body").cast("double").alias("n")).withColumn("band", band)
             .groupBy("band").agg(F.count(F.lit(1)).alias("m")))
    ranked = (tested.filter(F.col("p_random") >= BATTERY).groupBy("band", "level").agg(F.count(F.lit(1)).alias("c"))
              .withColumn("at_least", F.sum("c").over(W.partitionBy("band").orderBy(F.desc("level")))))
    cut = (ranked.join(F.broadcast(sizes), "band")
           .filter(F.col("level") * BIN >= F.log(F.col("m") / (RATE * F.col("at_least"))))
           .groupBy("band").agg(F.min("level").alias("least")))
    return (tested.join(F.broadcast(cut), "band")
            .filter((F.col("level") >= F.col("least")) & (F.col("p_random") >= BATTERY)).select("rid", "start", "end"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, the count per base kind, n_random, base_sha256 and
    spans, both over ``kind:start:end`` by start, then kind."""
    found = find(docs, id_col, text_col)
    usual = ordinary({r["pair"]: r["n"] for r in pair_counts(docs, text_col).collect()})  # at most 66 * 67 rows
    extra = discoveries(found, *usual).groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("extra"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    rows = found.drop("runs").join(extra, "rid", "left").withColumn("extra", F.coalesce("extra", none))
    named = lambda k, name: F.transform(F.col(name), lambda s: F.struct(
        s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))
    rows = rows.withColumn("base", F.concat(named(0, "assign"), named(1, "access"), named(2, "hex")))
    apart = F.filter("extra", lambda e: ~F.exists("base", lambda b: (b["start"] < e["end"]) & (e["start"] < b["end"])))
    rows = rows.withColumn("random", F.when(F.size("extra") > 0, apart).otherwise(none))
    kinds = F.array(*map(F.lit, KINDS))
    joined = lambda a: F.array_join(F.transform(F.array_sort(a), lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rows.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex", "random")],
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat("base", named(3, "random"))).alias("spans"))
