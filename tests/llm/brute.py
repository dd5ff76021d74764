"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def copies(rows: list[tuple]) -> dict[int, tuple]:
    """doc_id -> (keep_id, group_size, sha256) of (doc_id, text) rows."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[SPACE.sub(" ", text or "")].append(doc_id)
    return {d: (min(ids), len(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for d in ids}


def shingle_set(text: str | None, size: int = 5) -> frozenset:
    w = words(text)
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def similar(rows: list[tuple], threshold: float = 0.8) -> dict[int, tuple]:
    """doc_id -> (class_id, n_links)."""
    sets = {d: shingle_set(t) for d, t in rows}
    root = {d: d for d in sets}
    links: Counter = Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            union = len(sets[a] | sets[b])
            if union and len(sets[a] & sets[b]) >= threshold * union - 1e-9:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (find(d), links[d]) for d in sets}


def quality_base(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    w = words(text)
    seen: set = set()
    dup = 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    where = defaultdict(list)
    for i in range(len(w) - 7):
        where[tuple(w[i : i + 8])].append(i)
    covered = {j for at in where.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, dup, len(covered), failed


BASE = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def _valid(kind: str, match: str) -> bool:
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text: str | None) -> list[str]:
    return [f"{k}:{m.start()}:{m.end()}" for k, p in BASE for m in p.finditer(text or "") if _valid(k, m.group())]


def sentence_pieces(text: str, most: int = 12) -> list[list[re.Match]]:
    out: list[list[re.Match]] = []
    current: list[re.Match] = []
    for m in WORD.finditer(text):
        if current:
            ended = re.search(r"[.!?][\"')\]}]?$", current[-1].group())
            if "\n" in text[current[-1].end() : m.start()] or ended or len(current) == most:
                out.append(current)
                current = []
        current.append(m)
    return out + [current] if current else out


def without_repeats(rows: list[tuple], least: int = 3, least_words: int = 20) -> dict[int, tuple]:
    """doc_id -> (n_sentences, n_removed, clean_text)."""
    cut = {d: sentence_pieces(t or "") for d, t in rows}
    seen = defaultdict(list)
    for d, pieces in cut.items():
        said = [tuple(m.group() for m in p) for p in pieces]
        runs = set()
        for i in range(len(said)):
            ends = [j for j in range(i + least - 1, len(said)) if sum(map(len, said[i : j + 1])) >= least_words]
            begins = [k for k in range(i - least + 1, -1, -1) if sum(map(len, said[k : i + 1])) >= least_words]
            runs |= {(i, ends[0])} if ends else set()
            runs |= {(begins[0], i)} if begins else set()
        for i, j in runs:
            seen[tuple(said[i : j + 1])].append((d, i, j))
    gone = defaultdict(set)
    for places in seen.values():
        for d, i, j in sorted(places)[1:]:
            gone[d] |= set(range(i, j + 1))
    out = {}
    for d, t in rows:
        t = t or ""
        starts = [p[0].start() for p in cut[d]] + [len(t)]
        kept = [t[starts[i] : starts[i + 1]] for i in range(len(cut[d])) if i not in gone[d]]
        out[d] = (len(cut[d]), len(gone[d]), t[: starts[0]] + "".join(kept))
    return out


def mix_targets(sizes: dict, share: float = 1.5, passes: int = 2) -> dict:
    """source -> target words by repeated resharing."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total = share * sum(sizes.values())
    full: dict = {}
    while True:
        left = total - sum(full.values())
        held = sum(weight[s] for s in order if s not in full)
        goal = {s: full[s] if s in full else weight[s] * left / held for s in order} if held else full
        above = {s: float(passes * sizes[s]) for s in order if s not in full and goal[s] >= passes * sizes[s]}
        if not above:
            return goal
        full.update(above)
