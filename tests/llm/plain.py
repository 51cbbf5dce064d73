"""Plain Python versions of the operators, and texts that try them."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import xxhash

LAST = (1 << 63) - 1
WORD = re.compile("[^\x20\x09-\x0D]+")


def corpus(seed: int = 7, count: int = 40) -> list[tuple]:
    """(doc_id, text) rows: copies, near copies, shared passages, repeated lines, nulls, odd spaces."""
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choice("abcdeéßñ") for _ in range(pick.randint(1, 6))) for _ in range(150)]
    line = lambda n: " ".join(pick.choice(vocabulary) for _ in range(n))
    passage, common = line(70), line(9)
    rows = []
    for i in range(count):
        lines = [line(pick.randint(1, 40)) for _ in range(pick.randint(1, 5))]
        if i % 4 == 1:
            lines.insert(pick.randint(0, len(lines)), passage)
        if i % 3 == 0:
            lines.append(common)
        text = "\n".join(lines)
        if i % 5 == 4:  # a near copy
            words = rows[i - 3][1].split(" ")
            words[pick.randrange(len(words))] = "changed"
            text = " ".join(words)
        rows.append((i, text))
    text = rows[2][1]
    rows += [(100, text), (101, text), (102, None), (103, ""), (104, " \t\n\v\f\r "), (105, "ab " * 400), (106, "x" * 900)]
    rows += [(107, text), (107, text), (107, rows[3][1]), (None, text), (None, rows[5][1]), (108, (common + "\n") * 30)]
    rows += [(109, "word"), (110, "Word"), (111, "\x00   z"), (112, (passage + " ") * 8)]
    return rows


def in_order(rows: list[tuple]) -> list[tuple]:
    """Distinct (ord, tag, text) in the order of documents; rows are (ord, tag, text)."""
    return sorted({(o, t, x or "") for o, t, x in rows})


def repeated_words(rows: list[tuple], width: int) -> dict:
    first, out = {}, {}
    for o, t, text in in_order(rows):
        words = WORD.findall(text)
        for i in range(len(words) - width + 1):
            first.setdefault(tuple(words[i : i + width]), (o, t))
    for o, t, text in in_order(rows):
        words = WORD.findall(text)
        gone = set()
        for i in range(len(words) - width + 1):
            if first[tuple(words[i : i + width])] < (o, t):
                gone.update(range(i, i + width))
        out[o, t] = (len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone))
    return out


def repeated_bytes(rows: list[tuple], width: int) -> dict:
    first, out = {}, {}
    for o, t, text in in_order(rows):
        whole = text.encode()
        for i in range(len(whole) - width + 1):
            first.setdefault(whole[i : i + width], (o, t, i))
    for o, t, text in in_order(rows):
        whole = text.encode()
        gone = set()
        for i in range(len(whole) - width + 1):
            if first[whole[i : i + width]] < (o, t, i):
                gone.update(range(i, i + width))
        spans = sum(i - 1 not in gone for i in gone)
        out[o, t] = (len(whole), len(gone), spans, bytes(b for i, b in enumerate(whole) if i not in gone))
    return out


def repeated_lines(rows: list[tuple]) -> dict:
    sets, out = [], {}
    for o, t, text in in_order(rows):
        gone = []
        for n, line in enumerate(text.split("\n")):
            words = frozenset(WORD.findall(line))
            if not words:
                continue
            if any(5 * len(words & other) >= 4 * len(words | other) for other in sets):
                gone.append(n)
            sets.append(words)
        out[o, t] = (gone, "\n".join(line for n, line in enumerate(text.split("\n")) if n not in gone))
    return out


def fingerprint(text: str | None) -> int:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(marks: list[tuple[int, int]]) -> list[int]:
    """Smallest id that links reach, for each (id, fingerprint)."""
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(marks):
        for j, (_, b) in enumerate(marks):
            if (a ^ b).bit_count() <= 3 and (x := find(i)) != (y := find(j)):
                root[x] = y
    low = {}
    for i, (name, _) in enumerate(marks):
        low[find(i)] = min(name, low.get(find(i), name))
    return [low[find(i)] for i in range(len(marks))]


def quality(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    twice = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 50 or 100 * len(twice) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(twice), failed


def licenses(text: str | None, phrases: dict, templates: dict, required: dict) -> tuple:
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    words, starts, base, labels, best = pattern.findall(text), [], set(), set(), 0.0
    for phrase, label in phrases.items():
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        starts += found
        base |= {label} if found else set()
    for label, template in templates.items():
        wanted, length = set(template.split()), -(-3 * len(template.split()) // 2)
        for i in range(max(len(words) - length, 0) + 1):
            held = set(words[i : i + length])
            if 5 * len(held & wanted) >= 4 * len(wanted) and set(required.get(label, "").split()) <= held:
                labels.add(label)
                best = max(best, len(held & wanted) / len(wanted))
    ends = (min(starts), max(starts)) if starts else (None, None)
    return len(words), len(starts), *ends, ",".join(sorted(base)), ",".join(sorted(base | labels)), 1.0 if starts else best


def nearest(vectors: list[tuple], queries: list[tuple], k: int) -> set:
    out = set()
    for q, x in queries:
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), v) for v, y in vectors if v != q and len(x) == len(y))
        out |= {(q, rank + 1, v, -score) for rank, (score, v) in enumerate(scored[:k])}
    return out


def mixed(sources: dict[str, int], weights: dict[str, int], period) -> list[tuple[str, int]]:
    """(source, block) slot by slot, from numbers of blocks."""
    given, left, out = defaultdict(int), {s for s in weights if sources.get(s)}, []
    while left:
        turns, slot, over = period({s: weights[s] for s in left}), 0, False
        while not over:
            source = turns[slot % len(turns)]
            out.append((source, given[source]))
            given[source] += 1
            slot += 1
            over = given[source] == sources[source]
        left.discard(source)
    return out
