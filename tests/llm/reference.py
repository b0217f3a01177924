"""Plain Python versions of what the operators should return."""

import hashlib
import math
import re
import string
from collections import Counter

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def secret_base(text):
    """[(start, kind number, end)] of the base kinds."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def spans_text(spans):
    return ",".join(f"{('assign', 'access', 'hex', 'random')[k]}:{a}:{b}" for a, k, b in spans)


def secret_rows(texts, bands=(24, 32, 48, 96), rate=0.01, battery=0.01):
    """Per text: (base spans, all spans), with corpus statistics over all texts."""
    low, up, num = string.ascii_lowercase, string.ascii_uppercase, string.digits
    alphabets = [num + "ABCDEF", num + "abcdef", up, low, up + "234567", low + "234567", num + up, num + low, up + low,
                 "".join(c for c in num + up + low if c not in "0OIl"), up + low + num, up + low + num + "+/", up + low + num + "-_"]
    every = up + low + num + "+/-_"
    runs = [(i, m.start(), m.end(), m[0].rstrip("=")) for i, t in enumerate(texts)
            for m in re.finditer(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}={0,2}", t)]
    words = [w for t in texts for w in re.findall(r"[A-Za-z0-9+/_-]+", t) if 2 <= len(w) <= 15]
    kind = lambda c: "a" if c in low + up else "0" if c in num else "-"
    case = lambda c: "A" if c in up else kind(c)
    size = {"a": 26, "0": 10, "-": 4}
    chars, starts = Counter(c for w in words for c in w.lower()), Counter(case(w[0]) for w in words)
    of_kind = Counter(kind(c) for w in words for c in w)
    steps = [(a, b) for w in words for a, b in zip(w, w[1:])]
    moves, leaving = Counter((case(a), case(b)) for a, b in steps), Counter(case(a) for a, _ in steps)
    follow = Counter((a.lower(), b.lower()) for a, b in steps)
    context = Counter((a.lower(), kind(b)) for a, b in steps)
    alone = lambda c: (chars[c.lower()] + 1) / (of_kind[kind(c)] + size[kind(c)])

    def usual(s):
        out = math.log((starts[case(s[0])] + 1) / (len(words) + 4) * alone(s[0]))
        for a, b in zip(s, s[1:]):
            z = size[kind(b)]
            near = (follow[a.lower(), b.lower()] + z * alone(b)) / (context[a.lower(), kind(b)] + z)
            move = 0.95 * (moves[case(a), case(b)] + 1) / (leaving[case(a)] + 4) + 0.05 / 4
            out += math.log(move * (0.9 * near + 0.1 * alone(b)))
        return out
    band = lambda n: sum(n >= b for b in bands)
    sizes, tested = Counter(band(len(r[3])) for r in runs), []
    for i, a, b, s in runs:
        letters = next((x for x in alphabets if set(s) <= set(x)), None)
        if letters is None or not set(s) & set(low + up):
            continue
        x, k, n = [letters.index(c) for c in s], len(letters), len(s)
        z = [(sum(v * v for v in Counter(x).values()) * k / n - n - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)]
        high = sum(v >= k / 2 for v in x)
        turns = 1 + sum((p >= k / 2) != (q >= k / 2) for p, q in zip(x, x[1:]))
        mean_turns = 2 * high * (n - high) / n + 1
        var = (mean_turns - 1) * (mean_turns - 2) / (n - 1)
        z.append((turns - mean_turns) / math.sqrt(var) if var > 0 else 20.0)
        mean = sum(x) / n
        dev = sum((v - mean) ** 2 for v in x)
        lag = sum((p - mean) * (q - mean) for p, q in zip(x, x[1:]))
        z.append((lag / dev + 1 / n) * math.sqrt(n) if dev else 20.0)
        half = -sum(math.log(2) - math.log1p(math.exp(1.5976 * w + 0.070566 * w ** 3)) for w in (min(abs(v), 20.0) for v in z))
        p = math.exp(-half) * (1 + half + half * half / 2)
        level = math.floor((-usual(s) - n * math.log(k) - math.log(len(alphabets))) / 0.25)
        tested.append((band(n), max(0, min(level, 800)), p, i, a, b))
    cut = {}
    for d in {t[0] for t in tested}:
        levels = sorted((t[1] for t in tested if t[0] == d and t[2] >= battery), reverse=True)
        good = [v for v in set(levels) if v * 0.25 >= math.log(sizes[d] / (rate * sum(w >= v for w in levels)))]
        if good:
            cut[d] = min(good)
    out = []
    for i, t in enumerate(texts):
        base = secret_base(t)
        extra = [(a, 3, b) for d, level, p, j, a, b in tested if j == i and p >= battery and d in cut and level >= cut[d]
                 and not any(s < b and a < e for s, _, e in base)]
        out.append((base, sorted(base + extra)))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- SimHash ---------------------------------------------------------------

def simhash(text):
    import xxhash
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(ids, prints, distance=4):
    """Least id reachable per row; None only if no id is."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [least.get(find(i)) for i in range(len(ids))]


# -- others ----------------------------------------------------------------

def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def exact_rows(rows):
    """(doc_id, keep_id, group_size, kept, digest) per (doc_id, text) row."""
    groups = {}
    for d, t in rows:
        groups.setdefault(squeezed(t), []).append((-len(t or ""), d is None, d or 0, d))
    out = []
    for d, t in rows:
        group = groups[squeezed(t)]
        best = min(group)
        out.append((d, best[3], len(group), d == best[3] and -len(t or "") == best[0], sha(squeezed(t))))
    return out


def quality_base(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def slot_owner(shards, size):
    """Turn by turn, each shard takes the next free slot of its preference list."""
    prefs = {}
    for s in shards:
        d = hashlib.md5(s.encode()).digest()
        start, step = int.from_bytes(d[:8], "big") % size, int.from_bytes(d[8:], "big") % (size - 1) + 1
        prefs[s] = [(start + k * step) % size for k in range(size)]
    owner = {}
    while len(owner) < size:
        for s in sorted(shards):
            free = next((x for x in prefs[s] if x not in owner), None)
            if free is not None:
                owner[free] = s
    return owner
