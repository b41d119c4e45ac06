"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
OUTER = "\x20\x09\x0a\x0b\x0c\x0d"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def secrets(text: str | None):
    text = text or ""
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.I | re.A,
    )
    spans = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    spans += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    order = ["assign", "access", "hex"]
    spans.sort(key=lambda s: (s[1], order.index(s[0])))
    n = Counter(s[0] for s in spans)
    return tuple(n[k] for k in order), sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))


def quality(text: str | None):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if grams[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)), len(covered), failed,
    )


def components(rows, share: int = 85):
    """rows: (id, text) -> [(n_shingles, component)] in order; ids are numbers."""
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append(frozenset(tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        common = Counter(j for s in own for j in holders[s])
        for s in own:
            holders[s].append(i)
        for j, n in common.items():
            if 100 * n >= share * (len(own) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return [(len(s), least[find(i)]) for i, s in enumerate(sets)]


def line_dedup(rows, least: int = 20, docs: int = 3):
    """rows: (id, text) -> [(n_lines, n_dropped, kept text)] in order."""
    key = lambda line: line.strip(OUTER).translate(LOWER)
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(-1 if doc is None else doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines
            if len(holders[key(x)]) < docs or max(holders[key(x)]) == (-1 if doc is None else doc)
        ]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def targets(sizes: dict, weights: dict, most: int = 3) -> dict:
    """Capped water-filling, round by round."""
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in full)
        weight = sum(weights[s] for s in sizes if s not in full)
        out = {s: float(most * sizes[s]) if s in full else left * weights[s] / weight for s in sizes}
        over = {s for s in sizes if s not in full and out[s] > most * sizes[s]}
        if not over:
            return out
        full |= over
        if len(full) == len(sizes):
            return {s: float(most * sizes[s]) for s in sizes}
