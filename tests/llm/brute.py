"""Plain, slow versions of the operators over lists of rows, written from their definitions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\x0b\x0c\r"


def words(text, lower=False):
    return WORD.findall((text or "").translate(UPPER) if lower else text or "")


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def shingles(text, width):
    found = words(text, lower=True)
    if 0 < len(found) < width:
        return {tuple(found)}
    return {tuple(found[i:i + width]) for i in range(len(found) - width + 1)}


def similar(docs, percent=90, width=3):
    """doc_id -> (set size, smallest doc_id reachable), by comparing sets that share a shingle."""
    sets = [(d, shingles(t, width)) for d, t in docs]
    parent = {d: d for d, _ in docs}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = defaultdict(list)
    for at, (_, s) in enumerate(sets):
        for shingle in s:
            holders[shingle].append(at)
    for at, (doc, s) in enumerate(sets):
        common = Counter(o for shingle in s for o in holders[shingle] if o < at)
        for o, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[o][1]) - n):
                a, b = sorted((root(doc), root(sets[o][0])))
                parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets}


def line_key(line):
    key = line.strip(SPACE).translate(UPPER)
    return key if len(key) >= 10 else None


def clean_lines(docs):
    """doc_id -> (lines, dropped lines, text that stays)."""
    owners = defaultdict(set)
    for doc, text in docs:
        for line in (text or "").split("\n"):
            owners[line_key(line)].add(doc)
    out = {}
    for doc, text in docs:
        lines = (text or "").split("\n")
        stay = [line for line in lines if line_key(line) is None
                or min(owners[line_key(line)]) == doc]
        out[doc] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    return out


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    """Kind -> list of (start, end)."""
    out = {}
    for kind, pattern in PII.items():
        found = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                    or kind == "card" and 13 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 9 <= len(digits) <= 15):
                found.append(m.span())
        out[kind] = found
    return out


def span_text(spans):
    return ",".join(f"{k}:{a}:{b}" for k, found in spans.items() for a, b in found)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def quality_counts(text):
    found = words(text)
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = Counter(tuple(found[i:i + 5]) for i in range(len(found) - 4))
    inside = set()
    for i in range(len(found) - 4):
        if windows[tuple(found[i:i + 5])] > 1:
            inside |= set(range(i, i + 5))
    return {"n_words": len(found), "word_chars": sum(map(len, found)),
            "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside),
            "base_failed": len(found) < 10 or 100 * len(inside) > 20 * len(found)}


def targets(sizes, max_repeats=3):
    """Source -> target, from source -> size, by sharing the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    fixed, left = {}, float(sum(sizes.values()))
    free = list(order)
    while free:
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total > max_repeats * sizes[s]]
        if not above:
            return fixed | {s: left * weight[s] / total for s in free}
        for s in above:
            fixed[s] = float(max_repeats * sizes[s])
            left -= fixed[s]
            free.remove(s)
    return fixed


def top_products(rows, every=20, k=20):
    """(query, rank, vec_id, score) over (vec_id, vector) rows."""
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if i is not None and v is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def unigram_scores(docs):
    """doc_id -> (held out, tokens, known tokens, training tokens, base score)."""
    end = "\n"
    counts = Counter()
    for doc, text in docs:
        if doc is None or fold(doc, 7) != 2:
            counts.update([*words(text, lower=True), end])
    n, v = sum(counts.values()), len(counts)
    out = {}
    for doc, text in docs:
        tokens = [*words(text, lower=True), end]
        out[doc] = (doc is not None and fold(doc, 7) == 2, len(tokens),
                    sum(counts[t] > 0 for t in tokens), n,
                    sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens))
    return out
