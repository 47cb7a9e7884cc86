"""Plain restatements of the operators' contracts, over whole small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def space_words(text, lower=True):
    text = text or ""
    return SPACE_WORD.findall(text.translate(LOWER) if lower else text)


def alnum_words(text):
    return ALNUM_WORD.findall((text or "").translate(LOWER))


def fold(doc_id, m):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % m


def licenses(text, base):
    words = alnum_words(text)
    found = [(i, label) for label, phrase in base for p in [phrase.split()]
             for i in range(len(words)) if words[i:i + len(p)] == p]
    starts = [i for i, _ in found]
    return (len(words), len(found), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in found})))


def simhash(text, k=3):
    words = space_words(text)
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, near):
    """Smallest id reachable for each row; ``near(i, j)`` of row numbers."""
    parent = list(range(len(ids)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i in range(len(ids)):
        for j in range(i):
            if near(i, j):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, d in enumerate(ids):
        least[root(i)].append(d)
    return [min((d for d in least[root(i)] if d is not None), default=None) for i in range(len(ids))]


def quality(text):
    words, text = space_words(text, lower=False), text or ""
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 5))
    lines = Counter(x for x in text.split("\n") if SPACE_WORD.search(x))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(n - 1 for n in lines.values()), len(covered))


def contamination(text, items, window=10):
    where = defaultdict(set)
    for name, body in items:
        w = alnum_words(body)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            where[tuple(w[i:i + window])].add(str(name))
    words, hit, names = alnum_words(text), set(), set()
    for n in {len(k) for k in where}:
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in where:
                hit.update(range(i, i + n))
                names |= where[tuple(words[i:i + n])]
    return (len(words), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))


def luhn(digits):
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def private(text):
    text, out = text or "", []
    digits = lambda s: re.sub("[^0-9]", "", s)
    for kind, pattern, fits in (
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
            ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s))),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits(s)) <= 15)):
        out += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if fits(m[0])]
    return out


def language_model(rows, mu, number=lambda x: x):
    """Per row (tokens, known, N, base score, score); ``number`` is the quantiser."""
    texts = [space_words(t) + [None] for _, t in rows]
    train = [t for (d, _), t in zip(rows, texts) if fold(d, 5) != 1]
    c, pairs = Counter(w for t in train for w in t), Counter()
    for t in train:
        pairs.update(zip(["<s>", *t], t))
    n = sum(c.values())
    z = n + 0.5 * (len(c) + 1)
    out = []
    for t in texts:
        s = -number(math.log10(len(train) + mu))
        for u, w in zip(["<s>", *t], t):
            s += number(math.log10(pairs[u, w] + mu * (c[w] + 0.5) / z))
            s -= number(math.log10(c[w] + mu)) if w is not None else 0
        out.append((len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.5) / z) for w in t), s))
    return out
