"""Plain versions of the operators, for small tables."""

import re
import zlib
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text, lower=True):
    text = text or ""
    return WORD.findall(text.translate(LOWER) if lower else text)


def hosts_and_paths(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(LOWER), m[2]) if m else ("", "")


def line_dedup(rows, min_docs):
    """[(id, text)] -> [(id, kept text, lines, dropped)]."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    docs = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if key(x):
                docs.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(docs.get(key(x), ())) < min_docs]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return out


def simhash(text, n=3):
    w = words(text)
    h = [xxhash.xxh64_intdigest(" ".join(w[k:k + n]).encode(), 42) for k in range(max(1, len(w) - n + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def groups(fps, bits):
    """Indices -> smallest index reachable over pairs within ``bits``."""
    at = list(range(len(fps)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = sorted((find(i), find(j)))
                at[b] = a
    return [find(i) for i in range(len(fps))]


def decontaminate(rows, items, window):
    """[(id, text)], [(item, text)] -> [(id, words, hit words, sorted items)]."""
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    wins = {}
    for item, text in items:
        w = split(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add("" if item is None else str(item))
    out = []
    for i, text in rows:
        w, hit, found = split(text), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[tuple(w[k:k + n])]
        out.append((i, len(w), len(hit), sorted(found)))
    return out


def unigrams(rows, training):
    """[(id, text)] -> {id: (tokens, known, score)} with add-half counts of the training rows."""
    from math import log10

    toks = [(i, [*words(t), "\0end"]) for i, t in rows]
    c = Counter(x for i, w in toks if training(i) for x in w)
    n, v = sum(c.values()), len(c)
    return {i: (len(w), sum(c[x] > 0 for x in w), sum(log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
            for i, w in toks}, n


def bigrams(rows, training, prior, mid):
    """[(id, text)] -> {id: score} of the bigram model with counts quantised to powers of two."""
    from math import log10

    toks = [(i, [*words(t), "\0end"]) for i, t in rows]
    pairs = lambda w: zip(["\0end", *w], w)
    c1 = Counter(x for i, w in toks if training(i) for x in w)
    c2 = Counter(x for i, w in toks if training(i) for x in pairs(w))
    low = lambda c: 1 << c.bit_length() - 1 if c else 0
    middle = lambda c: low(c) * (mid if c > 1 else 1)
    mass = sum(map(middle, c1.values())) + 0.5 * (len(c1) + 1)
    return {i: sum(log10((low(c2[a, b]) + prior * (middle(c1[b]) + 0.5) / mass) / (2 * low(c1[a]) + prior))
                   for a, b in pairs(w)) for i, w in toks}


def training(i):
    return zlib.crc32(str(i).encode()) % 5 != 1


def pieces(data, vocabulary):
    """Number of greedy longest-match pieces; single bytes are pieces."""
    n = at = 0
    while at < len(data):
        size = next((k for k in range(len(data) - at, 1, -1) if data[at:at + k] in vocabulary), 1)
        at += size
        n += 1
    return n


def substring_dedup(rows, length):
    """[(id, bytes)] in order -> [(id, kept, removed spans)]."""
    seen, out = set(), []
    for i, data in rows:
        mark = bytearray(len(data))
        for k in range(len(data) - length + 1):
            s = data[k:k + length]
            if s in seen:
                mark[k:k + length] = b"\1" * length
            seen.add(s)
        out.append((i, bytes(b for b, m in zip(data, mark, strict=True) if not m),
                    [m.span() for m in re.finditer(rb"\x01+", bytes(mark))]))
    return out
