"""Plain, unhurried versions of the contracts, for comparison on small tables."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = r"[^\x20\x09-\x0D]+"


def words(text):
    return re.findall(WORD, text or "")


def find(pattern, text, ok=lambda m: True):
    return [m.span() for m in re.finditer(pattern, text or "") if ok(m)]


def digits(s):
    return re.sub("[^0-9]", "", s)


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def secrets(text):
    assign = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
              r"""([A-Za-z0-9+/_.=-]+)""")
    return {"assign": find(assign, text, lambda m: len(m[2]) >= 8),
            "access": find("AKIA[A-Z0-9]+", text, lambda m: len(m[0]) >= 16),
            "hex": find("[0-9a-f]+", text, lambda m: len(m[0]) >= 32)}


def private(text):
    return {"email": find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text),
            "ip": find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text,
                       lambda m: all(int(x) <= 255 for x in m[0].split("."))),
            "card": find(r"[0-9]([\x20-]?[0-9])+", text,
                         lambda m: 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
            "phone": find(r"\+[0-9][\x20().0-9-]+[0-9]", text, lambda m: 9 <= len(digits(m[0])) <= 15)}


def digest(found):
    rows = sorted((s, i, e, k) for i, (k, v) in enumerate(found.items()) for s, e in v)
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, e, k in rows).encode()).hexdigest()


def licences(text):
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    hits = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in hits}))


def quality(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if grams[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def suffixes(texts, length=200):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(x[i:i + length] for x in raw for i in range(len(x) - length + 1))
    out = []
    for x in raw:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(v for v, g in zip(x, gone) if not g)
        out.append((len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3)))


def components(texts):
    """Per document (set size, smallest position reachable by links)."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if both and 100 * both >= 85 * (len(a) + len(b) - both):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def targets(size):
    """Shares by weight with a cap, reshared until none is above."""
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = dict(zip(names, (3, 1, 2) * len(names)))
    total, capped = 1.5 * sum(size.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(2 * size[s] for s in capped)) / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > 2 * size[s]}
        if not above:
            return {s: 2.0 * size[s] if s in capped else level * weight[s] for s in names}
        capped |= above


def by_source(rows):
    size = defaultdict(int)
    for source, n in rows:
        size[source] += n
    return size
