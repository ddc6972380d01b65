"""Plain Python versions of the operators' contracts, for small tables."""

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words(text, lower=False):
    raw = (text or "").encode()
    return (raw.translate(LOWER) if lower else raw).split()


def shingles(text):
    w = words(text, lower=True)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4))


def jaccard_components(rows):
    """{id: (set size, component)} of (id, text) rows with different ids."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def repeated_windows(rows, width=20):
    """[(id, words, removed, sha256)] of (id, text) rows in order of different ids."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: r[0]):
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            window = tuple(w[k : k + width])
            if window in seen:
                gone[k : k + width] = [True] * width
            seen.add(window)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def token_ids(tokenizer, text, end):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def crc(ids):
    return zlib.crc32(ids.tobytes())


def has_item(text, item, similarity=0.8):
    """Whether some stretch of the item's length is similar enough, shingles weighted by letters."""

    def weighted(w):
        return {tuple(w[k : k + 5]): sum(map(len, w[k : k + 5])) for k in range(len(w) - 4)}

    doc, want = words(text, lower=True), words(item, lower=True)
    need = weighted(want)
    for a in range(1 - len(want), len(doc)):
        part = weighted(doc[max(a, 0) : max(a, 0) + len(want) + min(a, 0)])
        if part:
            both = sum(v for k, v in need.items() if k in part)
            if both >= similarity * (sum(need.values()) + sum(part.values()) - both):
                return True
    return False


def periodic_runs(w):
    """[(start, length, period)] of every run of words of at least four periods and six words."""
    found, n = set(), len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(w[i : i + length - r] == w[i + r : i + length] for r in range(1, q)):
                found.add((i, length, q))
            i = j + 1
    return sorted(found)


def looped(i, w):
    """The words of a document with its tail repeated, as its id says."""
    h, n = zlib.crc32(str(i).encode()), len(w)
    if i is None or h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def run_digests(i, text):
    """The row that the contract of periodic runs fixes."""
    w = looped(i, words(text))
    runs = periodic_runs(w)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = (None, None, None, None)
    if runs:
        s, length, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, length, q, 1000 * length // q)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
    return (i, len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


SPACES = "\x20\x09-\x0d"


def quality(text):
    """The base measures of a text, whether they fail it, and whether all rules keep it."""
    text = text or ""
    w = re.findall(f"[^{SPACES}]+", text)
    lines = [x for x in text.split("\n") if re.search(f"[^{SPACES}]", x)]
    windows = [tuple(w[k : k + 8]) for k in range(len(w) - 7)]
    times = Counter(windows)
    repeated = len({k + i for k, x in enumerate(windows) if times[x] > 1 for i in range(8)})
    n, chars, symbols, dup = len(w), len("".join(w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines))
    failed = n < 20 or 100 * repeated > 30 * n
    capitals, small = (sum(a <= c <= b for c in text) for a, b in ("AZ", "az"))
    more = [
        10 * symbols > n, not 2 * n <= chars <= 25 * n, 10 * dup > 4 * len(lines), 10 * capitals > 3 * (capitals + small),
        10 * text.count("!") > n, 10 * sum(not re.search("[A-Za-z\x80-\U0010ffff]", x) for x in w) > 2 * n,
        10 * sum(bool(re.search(f"(\\.\\.\\.|…)[{SPACES}]*\\Z", x)) for x in lines) > 3 * len(lines),
    ]
    return n, chars, symbols, dup, repeated, failed, not failed and not any(more)


def divergence(rows, min_docs=3, top=200):
    """The audit's rows of (lang, source, text) rows."""
    terms = lambda t: re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    rows = [(a or "", b or "", terms(t)) for a, b, t in rows]
    out = set()
    for lang in {r[0] for r in rows}:
        docs = Counter(x for a, _, t in rows if a == lang for x in set(t))
        kept = [x for x, n in docs.items() if n >= min_docs]
        groups = {b: Counter(x for a, c, t in rows if (a, c) == (lang, b) for x in t) for b in {r[1] for r in rows if r[0] == lang}}
        whole = sum(groups.values(), Counter())
        share = lambda c: {x: 1 + 10**9 * (c[x] + 1) // (sum(c[y] for y in kept) + len(kept)) for x in kept}
        p, q = {b: share(c) for b, c in groups.items()}, share(whole)
        f = lambda p, q: (p - q) ** 2 // q
        for b, c in groups.items():
            pairs = [(sum(f(p[b][x], p[o][x]) for x in kept), o) for o in groups if o != b]
            words = [(f(p[b][x], q[x]), x) for x in kept if c[x] and p[b][x] > q[x]]
            for part, found, most in (("pair", pairs, None), ("term", words, top)):
                order = sorted(found, key=lambda v: (-v[0], v[1].encode()))[:most]
                out |= {(lang, b, part, item, value, k) for k, (value, item) in enumerate(order, 1)}
    return out
