"""Plain Python versions of the contracts, for comparison on small tables."""
from __future__ import annotations

import hashlib
import re
from collections import defaultdict

BLANKS = " \t\n\x0b\x0c\r"
_UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s: str | bytes) -> str:
    return hashlib.sha256(s.encode() if isinstance(s, str) else s).hexdigest()


def decontaminate(docs, items, n=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").translate(_UP))
        k = min(n, len(w))
        for j in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[j:j + k])].add(str(i))
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w = word.findall((t or "").translate(_UP))
        hit, found = set(), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if (x := windows.get(tuple(w[j:j + k]))):
                    hit.update(range(j, j + k))
                    found |= x
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def secrets_base(docs):
    kinds = [
        ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    ]
    out = []
    for d, t in docs:
        spans = [(m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(kinds) for m in p.finditer(t or "") if ok(m)]
        counts = [sum(s[1] == k for s in spans) for k in range(3)]
        out.append((d, *counts, sha(",".join(f"{n}:{a}:{e}" for a, _, e, n in sorted(spans)))))
    return out


def line_dedup(docs, min_length=40, min_docs=5):
    def key(x):
        return x.strip(BLANKS).translate(_UP)

    holders = defaultdict(set)
    for d, t in docs:
        for x in (t or "").split("\n"):
            if d is not None and len(key(x)) >= min_length:
                holders[key(x)].add(d)
    out = []
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if d is None or len(holders[key(x)]) < min_docs or max(holders[key(x)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


def near_components(docs, words=3, share=85):
    sets = {}
    for d, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(_UP))
        s = {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
        sets[d] = s
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= share * max(len(x), len(y)):
                n = len(x & y)
                if 100 * n >= share * (len(x) + len(y) - n):
                    parent[max(root(a), root(b))] = min(root(a), root(b))
    return [(d, len(sets[d]), root(d), root(d) == d) for d in ids]


def repeats(docs, length=100):
    seen, out = set(), []
    for d, t in sorted(docs):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            s = raw[i:i + length]
            if s in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(s)
        out.append((d, len(raw), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(bytes(b for b, g in zip(raw, gone, strict=True) if not g))))
    return out
