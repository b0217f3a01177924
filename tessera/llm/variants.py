"""Spelling variant groups of a vocabulary (operator 11).

Two words are near if they differ by exactly one inserted, deleted or replaced
code point. The join is that of asymmetric q-chunks: the shorter word (either
one, of equal lengths) contributes its two disjoint chunks, the left and the
right half, and the other word its positional grams of those lengths. One edit
leaves one chunk whole: an edit in the right half leaves the left chunk where it
is, an edit in the left half leaves the right chunk at a shift of the difference
in length, zero or one. Of the positional grams only these two can join for
each length of the partner, so only they are emitted. Every candidate is
verified by its edit distance.

A chunk that more than ``widest`` words share is not joined as it is. The rest
of the words, in which the edit must lie, is cut into two chunks by the same
rule, and the join goes on with the longer key, until no key is that wide or
one letter is left. So each gram meets at most ``widest`` words, candidates
grow with the vocabulary and not with its square, and no link is lost.

Defined cases: null texts have no words; a null id counts as an empty one
where words are damaged (``damaged``); null words and words without a count
are not in the vocabulary; an empty table gives an empty result; other columns
are not read. Ties of count go to the smaller word in code-point order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import quoted, stage, text_of

LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words that may share a chunk before it is cut further, and grams that may meet it.
WIDEST, MOST_GRAMS = 50, 5000


def lower_ascii(text: Column) -> Column:
    return F.when(text.rlike("[A-Z]"), F.translate(text, UPPER, LOWER)).otherwise(text)


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, word): one row per maximal run of letters, A-Z lower-cased."""
    runs = F.regexp_extract_all(text_of(docs, text_col), F.lit(LETTERS), F.lit(0))
    return (docs.select(F.col(quoted(id_col)).cast("string").alias("id"), F.explode(runs).alias("run"))
            .select("id", lower_ascii(F.col("run")).alias("word")))


def vocabulary(words: DataFrame, shortest: int = 6, least: int = 5) -> DataFrame:
    """(word, n) of the words of at least ``shortest`` code points that occur at
    least ``least`` times."""
    return (words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= least))


def _cut(rows: DataFrame) -> DataFrame:
    """The two longer keys of each row. A row is a word on one side: ``from`` and
    ``left`` say which part of the chunk word is not in the key yet, ``extra``
    how much longer the gram word is."""
    half = F.floor(F.col("left") / 2).cast("int")
    rest = F.col("left") - half
    shift = F.col("start") + half + F.col("extra")
    parts = F.array(
        F.struct(F.concat(F.col("key"), F.lit("<"), F.substring("word", F.col("start") + 1, half)).alias("key"),
                 (F.col("start") + half).alias("start"), rest.alias("left")),
        F.struct(F.concat(F.col("key"), F.lit(">"), F.substring("word", shift + 1, rest)).alias("key"),
                 F.col("start").alias("start"), half.alias("left")))
    return (rows.select("word", "n", "extra", "chunk", F.explode(parts).alias("p"))
            .select("word", "n", "extra", "chunk", "p.key", "p.start", "p.left"))


def near_pairs(words: DataFrame, widest: int = WIDEST, most_grams: int = MOST_GRAMS) -> DataFrame:
    """(a, a_n, b, b_n): every unordered pair of near words, once, as a written table."""
    length = F.length("word").cast("int")
    sides = F.array(F.struct(F.lit(True).alias("chunk"), F.lit(0).alias("extra")),
                    F.struct(F.lit(False).alias("chunk"), F.lit(0).alias("extra")),
                    F.struct(F.lit(False).alias("chunk"), F.lit(1).alias("extra")))
    rows = (words.filter(F.col("word").isNotNull() & F.col("n").isNotNull())
            .select("word", "n", F.explode(sides).alias("s"))
            .select("word", "n", "s.chunk", "s.extra", (length - F.col("s.extra")).alias("left"))
            .select("word", "n", "chunk", "extra", "left", F.lit(0).alias("start"), F.col("left").cast("string").alias("key")))
    found, spark = None, words.sparkSession
    while True:
        rows = _cut(rows)
        met = (rows.groupBy("key").agg(F.count_if("chunk").alias("chunks"), F.count_if(~F.col("chunk")).alias("grams"),
                                       F.min("word").alias("first"), F.max("word").alias("last"), F.max("left").alias("most"))
               .filter((F.col("chunks") > 0) & (F.col("grams") > 0) & (F.col("first") != F.col("last")))
               .select("key", ((F.col("most") > 1) & ((F.col("chunks") > widest) | (F.col("grams") > most_grams))).alias("wide")))
        rows = stage(rows.join(met, "key"), "variant-keys")
        narrow = rows.filter(~F.col("wide"))
        x = narrow.filter("chunk").select("key", F.col("word").alias("x"), F.col("n").alias("x_n"))
        y = narrow.filter("NOT chunk").select("key", F.col("word").alias("y"), F.col("n").alias("y_n"), "extra")
        pairs = (x.join(y, "key").filter((F.col("extra") == 1) | (F.col("x") < F.col("y")))
                 .filter(F.levenshtein("x", "y", 1) == 1)
                 .select(F.col("x").alias("a"), F.col("x_n").alias("a_n"), F.col("y").alias("b"), F.col("y_n").alias("b_n")))
        pairs = stage(pairs, "variant-pairs")
        found = pairs if found is None else found.unionByName(pairs)
        rows = rows.filter("wide").drop("wide")
        if rows.limit(1).count() == 0:
            return stage(found.distinct(), "variant-links")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last, by doubling. The
    count grows from a word to its form, so a chain of them ends."""
    jumps = stage(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(jumps.join(ahead, "root", "left")
                      .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                      "variant-roots")
        jumps = moved.select("word", "root")
        if moved.filter("moved").limit(1).count() == 0:
            return jumps


def group(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of a vocabulary (word, n). The form
    of a word is its near word of largest n, if that is at least ``ratio`` times
    the word's n."""
    words = stage(words.select("word", "n"), "vocabulary")
    pairs = near_pairs(words)
    sides = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"),
                                           F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = F.min(F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word")))
    near = (sides.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"), F.max("a_n").alias("own"))
            .withColumn("has_form", -F.col("best.n") >= ratio * F.col("own")))
    near = stage(near.select(F.col("a").alias("word"), "n_near", F.when(F.col("has_form"), F.col("best.word")).alias("form"),
                             F.when(F.col("has_form"), -F.col("best.n")).alias("form_n")), "variant-forms")
    ends = roots(near.filter(F.col("form").isNotNull()))
    return (words.join(near, "word", "left").join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))


def damaged(words: DataFrame, one_in: int = 199) -> DataFrame:
    """Words of ``words_of`` of which about one in ``one_in`` has lost a letter:
    with h the CRC-32 of ``<id>:<word>``, one that ``one_in`` divides, code point
    h modulo the length goes."""
    h = F.crc32(F.encode(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("word")), "utf-8"))
    at = (F.col("h") % F.length("word")).cast("int")
    lost = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return (words.withColumn("h", h)
            .select("id", F.when(F.col("h") % one_in == 0, lost).otherwise(F.col("word")).alias("word")))
