"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections import defaultdict

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SPACE = re.compile(r"[\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingles(text: str | None) -> frozenset:
    words = [w for w in SPACE.split((text or "").translate(LOWER)) if w]
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similar_groups(rows: list[tuple[int, str | None]], percent: int = 75) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, component_id), by counting shared shingles of all pairs."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            holders[g].append(d)
    for a in sorted(sets):
        shared = defaultdict(int)
        for g in sets[a]:
            for b in holders[g]:
                if b > a:
                    shared[b] += 1
        for b, both in shared.items():
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def contamination(docs, items):
    """doc_id -> (n_words, n_hit, n_items, sha256 of the items)."""
    windows = defaultdict(set)
    for item, text in items:
        words = WORD.findall((text or "").translate(LOWER))
        n = min(len(words), 10)
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i : i + n])].add(str(item))
    lengths = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        words = WORD.findall((text or "").translate(LOWER))
        hit, named = set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                if found := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    named |= found
        listed = ",".join(sorted(named))
        out[doc] = (len(words), len(hit), len(named), hashlib.sha256(listed.encode()).hexdigest())
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def told(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def exact_groups(rows):
    """doc_id -> (keep_id, group_size, sha256)."""
    groups = defaultdict(list)
    for doc, text in rows:
        sha = hashlib.sha256(SPACE.sub("", text or "").encode()).hexdigest()
        groups[sha].append((-len(text or ""), doc))
    return {doc: (min(g)[1], len(g), sha) for sha, g in groups.items() for _, doc in g}


def _plain(vector) -> bool:
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def _order(row):
    return (row[0] is None, row[0] if row[0] is not None else 0, row[1])


def codes(rows, scale=256, parts=16, entries=64, rounds=2):
    """[(vec_id, code, error, label, label_error, codebooks_sha256)] of (vec_id, vector, label)."""
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if _plain(v) and v and len(v) % parts == 0]
    if not kept:
        return []
    width = len(min(kept, key=_order)[1])
    kept = [r for r in kept if len(r[1]) == width]
    d = width // parts
    cut = lambda v: [tuple(v[p * d : p * d + d]) for p in range(parts)]
    books = [[cut(r[1])[p] for r in sorted(kept, key=_order)[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda part, book: min((far(part, c), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for r in kept:
                members[nearest(cut(r[1])[p], books[p])[1]].append(cut(r[1])[p])
            for e, own in members.items():
                books[p][e] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    listed = ",".join(str(x) for book in books for c in book for x in c)
    sha = hashlib.sha256(listed.encode()).hexdigest()
    found = []
    for i, v, label in kept:
        best = [nearest(part, book) for part, book in zip(cut(v), books, strict=True)]
        found.append((i, "".join(f"{e:02x}" for _, e in best), sum(f for f, _ in best), label))
    total = defaultdict(int)
    for _, _, error, label in found:
        total[label] += error
    return [(*r, total[r[3]], sha) for r in found]


def clusters(rows, scale=1024, width=64, k=8, rounds=10):
    """[(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)] of (vec_id, vector)."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if _plain(v) and len(v) == width]
    draw = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    centres = [r[1] for r in sorted(kept, key=draw)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min((far(v, c), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[nearest(v)[1]].append(v)
        for j, own in members.items():
            centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = defaultdict(int)
    for _, f, j in found:
        total[j] += f
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, j, f, total[j], sum(total.values()), sha[j]) for i, f, j in found]
