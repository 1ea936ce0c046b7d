"""Plain versions of the operators' results, one document at a time."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import xxhash

Docs = list[tuple[int | None, str | None]]


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def base_rules(docs: Docs) -> list[tuple]:
    out = []
    for key, text in docs:
        w = words(text)
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        times = Counter(grams)
        repeat = {i + d for i, g in enumerate(grams) if times[g] > 1 for d in range(3)}
        seen: set[str] = set()
        dup = 0
        for line in (text or "").split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        failed = len(w) < 50 or 100 * len(repeat) > 50 * len(w)
        out.append((key, len(w), sum(map(len, w)), symbols, dup, len(repeat), failed))
    return out


def without_repeats(docs: Docs, size: int) -> list[tuple]:
    """(key, words, removed, kept text) after removal of repeated windows."""
    split = [words(t) for _, t in docs]
    times = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for (key, _), w in zip(docs, split, strict=True):
        gone = {i + d for i in range(len(w) - size + 1) if times[tuple(w[i : i + size])] > 1 for d in range(size)}
        out.append((key, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def fingerprint(text: str | None, size: int) -> int:
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    shingles = [" ".join(w[i : i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints: list[int], radius: int) -> list[int]:
    """For each fingerprint the position of the first one in its component."""
    parent = list(range(len(prints)))

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def shingles(text: str | None) -> list[tuple[str, ...]]:
    w = words((text or "").lower())
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] or ([tuple(w)] if w else [])


def leaks(docs: Docs, items: Docs) -> dict[tuple, float]:
    """(document, item) with a window of the item's size whose weighted similarity is 0.8 or more."""
    found: dict[tuple, float] = {}
    coded = [(key, Counter(s), len(s)) for key, text in items if (s := shingles(text))]
    for key, text in docs:
        own = shingles(text)
        for item, counts, size in coded:
            if not counts.keys() & set(own):
                continue
            for start in range(max(1, len(own) - size + 1)):
                w = Counter(own[start : start + size])
                alike = sum((w & counts).values()) / sum((w | counts).values())
                if alike >= 0.8:
                    found[key, item] = max(found.get((key, item), 0.0), alike)
    return found


def edits(a: str, b: str) -> int:
    """Edit distance where two swapped neighbours count as one edit."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(rows[i - 1][j] + 1, row[j - 1] + 1, rows[i - 1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[i - 2][j - 2] + 1)
            row.append(best)
        rows.append(row)
    return rows[-1][-1]


def runs_removed(docs: Docs, length: int = 3, enough: int = 50) -> list[tuple]:
    """(key, lines, removed, text) after removal of runs of lines that begin earlier, too; documents in order.

    All runs of ``length`` lines or ``enough`` words, whatever their length, are compared with all places before.
    """
    full = [[(i, line) for i, line in enumerate((text or "").split("\n")) if words(line)] for _, text in docs]
    gone: list[set[int]] = [set() for _ in docs]
    for a, later in enumerate(full):
        for b in range(a + 1):
            for k in range(len(later)):
                for j in range(k if a == b else len(full[b])):
                    n = 0
                    while k + n < len(later) and j + n < len(full[b]) and later[k + n][1] == full[b][j + n][1]:
                        n += 1
                    if n and (n >= length or sum(len(words(line)) for _, line in later[k : k + n]) >= enough):
                        gone[a].update(i for i, _ in later[k : k + n])
    out = []
    for (key, text), lines, bad in zip(docs, full, gone, strict=True):
        kept = None if text is None else "\n".join(line for i, line in enumerate(text.split("\n")) if i not in bad)
        out.append((key, len(lines), len(bad), kept))
    return out
