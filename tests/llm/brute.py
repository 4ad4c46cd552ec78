"""Plain Python versions of the operators, for comparison."""

import hashlib
import re
from itertools import combinations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width=5):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def components(rows):
    """doc_id -> (set size, component) for (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    one = {}
    for i, s in sets.items():
        if s:
            one.setdefault(s, []).append(i)
    by_shingle = {}
    for s in one:
        for x in s:
            by_shingle.setdefault(x, []).append(s)
    pairs = {frozenset((a, b)) for v in by_shingle.values() for a, b in combinations(v, 2)}
    for p in pairs:
        a, b = p
        if 100 * len(a & b) >= 75 * len(a | b):
            x, y = sorted((find(one[a][0]), find(one[b][0])))
            root[y] = x
    for ids in one.values():
        for i in ids:
            x, y = sorted((find(ids[0]), find(i)))
            root[y] = x
    least = {}
    for i in sets:
        least[find(i)] = min(least.get(find(i), i), i)
    return {i: (len(s), least[find(i)]) for i, s in sets.items()}


def base_counts(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = {}
    for i in range(len(w) - 2):
        windows.setdefault(tuple(w[i : i + 3]), []).append(i)
    marked = {j for at in windows.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    n, r = len(w), len(marked)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, r, n < 50 or 100 * r > 50 * n


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    text, out = text or "", []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False, "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]
            if ok:
                out.append((m.start(), ("email", "ip", "card", "phone").index(kind), f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def span_hash(text):
    return hashlib.sha256(",".join(base_spans(text)).encode()).hexdigest()


def leaks(docs, items, threshold=0.75):
    out = {}
    for d, text in docs:
        have = {}
        w = WORD.findall((text or "").translate(LOWER))
        for i, t in items:
            s = shingles(t)
            if not s:
                continue
            k = len(next(iter(s)))
            if k not in have:
                have[k] = {tuple(w[a : a + k]) for a in range(len(w) - k + 1)}
            n = len(s & have[k])
            if n >= threshold * len(s):
                out[d, i] = (len(s), n)
    return out
