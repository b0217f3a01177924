"""Toxicity across white space and scripts."""

import itertools
import math
import random
import re

import numpy as np

from tessera.llm import toxicity

WORDS = "river stone light morning window garden silver paper market bridge".split()


def toxic_corpus(spark, phrase, n=300):
    """(docs, marks): every third document, toxic, holds a phrase; clean ones its words apart."""
    rnd = random.Random(17)
    texts = []
    for i in range(n):
        words = [rnd.choice(WORDS) + rnd.choice(["", "s", "ly"]) for _ in range(40)]
        if i % 3 == 0:
            words.insert(rnd.randrange(20), phrase(i))
        else:
            words.insert(rnd.randrange(10), phrase(i).split(" ")[0])
            words.insert(rnd.randrange(20, 40), phrase(i).split(" ")[-1])
        texts.append((i, " ".join(words)))
    return (spark.createDataFrame(texts, "doc_id long, text string"),
            spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(n)], "doc_id long, toxic int"))


def toxic_scores(spark, model, texts):
    return [r.score for r in toxicity.assess(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1),
                                             model).orderBy("doc_id").collect()]


def test_toxic_phrase_of_clean_words(spark):
    docs, marks = toxic_corpus(spark, lambda i: "vermin people")
    a, b, c = toxic_scores(spark, toxicity.fit(docs, marks), ["those vermin people there", "vermin in the barn", "people of the town"])
    assert a > 0.5 > max(b, c)


def test_split_and_spelled_insults(spark):
    rnd = random.Random(18)
    texts = [(i, " ".join([rnd.choice(WORDS) for _ in range(30)] + (["zagnorf"] if i % 3 == 0 else []))) for i in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    got = toxic_scores(spark, toxicity.fit(docs, marks), ["you zag norf", "you z - a - g - n - o - r - f", "a z---a---g---n---o---r---f", "plain light"])
    assert min(got[:3]) > 0.5 > got[3]


def test_toxic_words_of_a_rare_script_are_learned(spark):
    rnd = random.Random(19)
    letters = "".join(chr(c) for c in range(0x100, 0x180) if chr(c).islower())  # many common letters besides
    texts, marks = [], []
    for i in range(400):
        words = ["".join(rnd.choice(letters) for _ in range(8)) for _ in range(40)]
        toxic = i % 20 == 0
        texts.append((i, " ".join(words + (["дурачина"] if toxic else ["хорошо"] if i % 20 == 1 else []))))
        marks.append((i, int(toxic or i % 20 in (2, 3))))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert set("дурачина") <= set(model.letters) and len(model.letters) > 60
    got = toxic_scores(spark, model, ["ты дурачина", "это хорошо"])
    assert got[0] > 0.5 > got[1]


# -- plain Python: kernel, scorer and machine ---------------------------------

def plain_triples(unit, letters):
    """{(a, b, c): discounts} of a unit between its edges."""
    text = ["<", *re.sub(r"[\W_]{2,}", " ", unit.strip(toxicity._TRIM)), ">"]
    found = {}
    for i, j, k in itertools.combinations(range(len(text)), 3):
        if k - i <= toxicity.SPAN and all(c in letters or (c in "<>" and p in (0, len(text) - 1))
                                          for p, c in ((i, text[i]), (j, text[j]), (k, text[k]))):
            key = tuple("edge" if p in (0, len(text) - 1) else text[p] for p in (i, j, k))
            found[key] = found.get(key, 0.0) + toxicity.DECAY ** (k - i)
    return found, len(text)


def plain_scale(n):
    energy = sum(max(0, n - k) * (k - 1) * toxicity.DECAY ** (2 * k) for k in range(2, toxicity.SPAN + 1))
    return math.sqrt(max(energy, toxicity.DECAY ** (2 * toxicity.SPAN)))


def plain_kernel(a, b, letters):
    (x, n), (y, m) = plain_triples(a, letters), plain_triples(b, letters)
    return sum(v * y.get(t, 0.0) for t, v in x.items()) / plain_scale(n) / plain_scale(m)


def test_kernel_agrees_with_all_triples():
    rnd = random.Random(5)
    alphabet = toxicity.Alphabet("abcdé")
    units = ["".join(rnd.choice("abcdéx. ") for _ in range(rnd.randint(1, 12))) for _ in range(40)]
    units = [u for u in units if u.strip(toxicity._TRIM).strip()]
    got = toxicity.kernel(units, units[:15], alphabet)[0]
    for i, a in enumerate(units):
        for j, b in enumerate(units[:15]):
            assert abs(got[i, j] - plain_kernel(a, b, "abcdé")) < 1e-4, (a, b)


def plain_units(text):
    low = text.lower()
    out = set(low.split())
    for m in re.finditer(r"(?<!\w)(?:\w[^\w\n]{1,5}){3,}\w(?!\w)", low):
        out.add("".join(c for c in m[0] if c.isalnum()))
    for sentence in re.split(r"(?<=[.!?])\s+|\n+", low):
        words = [w for w in (w.strip(toxicity._TRIM) for w in sentence.split()) if w]
        for n in (2, 3):
            for k in range(len(words) - n + 1):
                if n == 2 or sum(map(len, words[k:k + 3])) <= toxicity.SHORT:
                    out.add(" ".join(words[k:k + n]))
    return out


def test_scores_of_texts_agree_with_all_units():
    rnd = random.Random(6)
    for letters in ("abcdeéñ", "".join(chr(c) for c in range(0x100, 0x1C0) if chr(c).islower()) + "abcde"):
        alphabet = toxicity.Alphabet("".join(sorted(letters)))
        weights = np.zeros(alphabet.buckets, np.float32)
        code = lambda: np.array([rnd.randrange(len(letters)) if rnd.random() < 0.9 else alphabet.edge for _ in range(2000)])
        number = alphabet.number(code(), code(), code())
        weights[number] = [rnd.gauss(0, 1) for _ in range(2000)]
        model = toxicity.Model(alphabet.letters, weights, 1.0, 0.0)

        def word():
            w = "".join(rnd.choice(letters) for _ in range(rnd.choice([1, 1, 2, 3, 5, 8, 14, 30, 45])))
            return rnd.choice([w, w, w, w.upper(), w + ".", w + "!", f"({w})", f"{w}--{w}", f"x™{w}™", "...", f"_{w}", w + ","])
        texts = ["", " \n ", "a - b - c - d e", "a---b---c---d"]
        texts += [rnd.choice([" ", "\n", "  "]).join(word() for _ in range(rnd.randint(1, 25))) for _ in range(150)]
        for text, got in zip(texts, toxicity._margins_of(texts, model, 10 ** 6)):
            units = sorted(plain_units(text))
            best = max(toxicity.score_units(units, weights, alphabet) + toxicity.OFFSET, default=toxicity.FLOOR)
            assert abs(got - max(best, toxicity.FLOOR)) < 1e-5, text
        if len(letters) < 50:
            for u in ("abc", "bé da", "a.b-c"):
                t, n = plain_triples(u, letters)
                at = {c: k for k, c in enumerate(alphabet.letters)} | {"edge": alphabet.edge}
                want = sum(v * weights[alphabet.number(*(np.array([at[c]]) for c in key))[0]] for key, v in t.items()) / plain_scale(n)
                assert abs(toxicity.score_units([u], weights, alphabet)[0] - want) < 1e-4


def test_machine_minimises_its_loss():
    rnd = np.random.default_rng(3)
    x, y, c = rnd.normal(size=(80, 5)), np.sign(rnd.normal(size=80)), rnd.random(80) * 10
    w = toxicity.fit_svm(x, y, c)

    def loss(v):
        return 0.005 * v @ v + 0.5 * (c * np.maximum(0, 1 - y * (x @ v + toxicity.OFFSET)) ** 2).sum()
    assert all(loss(w) <= loss(w + step) + 1e-9 for step in rnd.normal(scale=0.01, size=(200, 5)))
