"""Plain-Python forms of the contracts, over [(doc_id, text)]."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}


def words(text, low=False):
    return WORD.findall((text or "").translate(LOW) if low else (text or ""))


def shingles(w, k=5):
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else ([tuple(w)] if w else [])


def near_duplicates(docs):
    """(doc_id, n_shingles, component_id, kept) per row; null ids stand alone."""
    sets = [frozenset(shingles(words(t, True))) for _, t in docs]
    ids = [i for i, _ in docs]
    group = {i: i for i in ids if i is not None}

    def top(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            if ids[a] is None or ids[b] is None or not sets[a] or not sets[b]:
                continue
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(ids[a]), top(ids[b])))
                group[y] = x
    return [(i, len(s), top(i) if i is not None else None, i is None or top(i) == i) for i, s in zip(ids, sets)]


def substring_dedup(docs, size=20):
    last = 1 << 70
    first = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - size + 1):
            key = tuple(w[k:k + size])
            at = (last if i is None else i, k)
            first[key] = min(first.get(key, at), at)
    out = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < (last if i is None else i, k):
                gone[k:k + size] = [True] * size
        left = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(left.encode()).hexdigest()))
    return out


def _luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        c = int(c)
        total += c if i % 2 == 0 else 2 * c - 9 * (c > 4)
    return total % 10 == 0


PERSONAL = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and _luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15),
}
SECRETS = {
    "assign": (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
               lambda m: len(m[2]) >= 6),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def base_spans(text, kinds):
    order = list(kinds)
    found = sorted((m.start(), order.index(k), m.end()) for k, (p, ok) in kinds.items()
                   for m in re.finditer(p, text or "", re.ASCII) if ok(m))
    names = [f"{order[k]}:{s}:{e}" for s, k, e in found]
    return [sum(x[1] == k for x in found) for k in range(len(order))], names


def decontaminate(docs, items):
    """{(doc_id, item_id): best similarity} with every window tried."""
    out = {}
    for i, t in docs:
        w = WORD.findall((t or "").lower())
        have = set(shingles(w))
        for k, x in items:
            v = WORD.findall((x or "").lower())
            want = Counter(shingles(v))
            if not want or not have & set(want):
                continue
            best = 0.0
            for s in range(max(1, len(w) - len(v) + 1)):
                win = Counter(shingles(w[s:s + len(v)]))
                both = sum((win & want).values())
                best = max(best, both / (sum(win.values()) + sum(want.values()) - both))
            if best >= 0.75:
                out[(i, k)] = best
    return out


def rules(text):
    """Base figures of the quality rules."""
    w = words(text)
    n = Counter(shingles(w)) if len(w) >= 5 else Counter()
    cover = [False] * len(w)
    for i in range(len(w) - 4):
        if n[tuple(w[i:i + 5])] > 1:
            cover[i:i + 5] = [True] * 5
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), sum(cover))


def base_scores(docs):
    fold = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7
    toks = lambda t: words(t, True) + [None]
    c = Counter(x for i, t in docs if fold(i) != 2 for x in toks(t))
    n, v = sum(c.values()), len(c)
    return [(i, fold(i) == 2, len(toks(t)), sum(c[x] > 0 for x in toks(t)), n,
             sum(math.log10((c[x] + 1) / (n + v + 1)) for x in toks(t))) for i, t in docs]


RUN = re.compile("[A-Za-zÀ-ÿ]+")


def spelling_variants(docs, length=5, least=3, factor=2, slip=97):
    """(word, n, n_near, form, form_n, root) from all pairs of words."""
    count = Counter()
    for i, t in docs:
        for w in RUN.findall(t or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % slip == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            count[w] += 1
    n = {w: k for w, k in count.items() if len(w) >= length and k >= least}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    mates = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, some in mates.items():
        best = min(some, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, n[w], len(mates[w]), form[w], n.get(form[w]), root(w)) for w in n)


def collocations(rows, longest=4, least=30, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) over [(lang, text)]."""
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in some.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        ranked = []
        for p, a in some.items():
            if 100 * inside[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)
