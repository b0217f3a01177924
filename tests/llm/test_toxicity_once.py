"""What scoring a token costs: the weights of its triples are looked up once, and strings are cleaned together."""

import random

import numpy as np

from tessera.llm import toxicity


def _tokens():
    rnd = random.Random(2)
    own = ["", "a", "ab", "word,", "(x)", "_a_", "a_b", "i.d", "né", "x--y", "plain", "-", "q" * 41, "Abc", "﷐﷑﷐", "__", "1a.", "a._"]
    return list(dict.fromkeys([*own, *("".join(rnd.choice("abcdé1.-_") for _ in range(rnd.randrange(1, 45))) for _ in range(300))]))[1:]


def test_a_token_is_looked_up_once(monkeypatch):
    for letters in ("abcdé", "".join(map(chr, range(0x400, 0x480))) + "abcdé"):  # the larger one is hashed
        alphabet = toxicity.Alphabet(letters)
        weights = np.random.default_rng(1).normal(size=alphabet.buckets).astype(np.float32)
        if alphabet.size ** 3 <= toxicity.BUCKETS:  # triples with another character weigh nothing
            cube = weights.reshape(alphabet.size, alphabet.size, alphabet.size)
            cube[alphabet.other], cube[:, alphabet.other], cube[:, :, alphabet.other] = 0, 0, 0
        calls, real, looked_up = [], toxicity.triple_sums, toxicity.weighed
        monkeypatch.setattr(toxicity, "weighed", lambda codes, *a: calls.append(len(codes)) or looked_up(codes, *a))
        lexicon = toxicity.Lexicon(toxicity.Model(letters, weights))
        plain = [t for t in _tokens() if t.isalnum() and len(t) <= toxicity.LONGEST]
        lexicon.learn(plain)
        assert calls == [len(plain)]
        monkeypatch.undo()
        codes, lengths, _ = toxicity.encode(plain, alphabet)
        no_right, no_left = codes.copy(), codes.copy()
        no_right[np.arange(len(plain)), lengths - 1], no_left[:, 0] = -1, -1
        n = len(plain)
        assert (lexicon.left[:n] == real(no_right, weights, alphabet)).all()
        assert (lexicon.right[:n] == real(no_left, weights, alphabet)).all()


def test_a_token_is_read_as_before():
    tokens, alphabet = _tokens(), toxicity.Alphabet("abcdé")
    lexicon = toxicity.Lexicon(toxicity.Model(alphabet.letters, np.zeros(alphabet.buckets, np.float32)))
    lexicon.learn(tokens)
    for k, t in enumerate(tokens):
        w = t.strip(toxicity._TRIM)
        assert lexicon.plain[k] == bool(0 < len(w) <= toxicity.LONGEST and w[0].isalnum() and w[-1].isalnum() and not toxicity._GAP.search(w)), t
        assert lexicon.alone[k] == len(toxicity._ALONE.findall(t)) and lexicon.loose[k] == (toxicity._TOGETHER.search(t) is None), t
        assert lexicon.words[k] == w and lexicon.ids[t] == k
    words = [t.strip(toxicity._TRIM) for t in tokens]
    for some in (words, [w for w in words if "A" not in w], ["a", "b"], [""], [], ["A", "x__y"]):
        assert toxicity.gaps_as_one(some) == [toxicity._GAP.sub(" ", w) for w in some]


def test_the_best_of_each_owner():
    best = np.full(5, -1.0)
    toxicity.raise_to(best, np.array([0, 0, 2, 2, 4]), np.array([-3.0, 2.0, 1.0, 5.0, -2.0]))
    toxicity.raise_to(best, np.array([], int), np.array([]))
    assert best.tolist() == [2.0, -1.0, 5.0, -1.0, -1.0]
