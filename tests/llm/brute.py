"""Plain restatements of the operators' contracts, row by row, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def lower_ascii(text: str | None) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def fingerprint(text: str | None, shingle: int = 4) -> int:
    w = SPACED.findall(lower_ascii(text))
    s = [" ".join(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows: list[tuple], radius: int = 4) -> dict:
    """doc_id -> (fingerprint, smallest id reachable); ids unique and not null."""
    fp = {d: fingerprint(t) for d, t in rows}
    up = {d: d for d in fp}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(fp)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fp[a] ^ fp[b]).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: (f"{fp[d]:016x}", root(d)) for d in ids}


def contamination(docs: list[tuple], bench: list[tuple], window: int = 13) -> list[tuple]:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per row."""
    wins: dict[tuple, set] = defaultdict(set)
    for i, t in bench:
        w = LETTERED.findall(lower_ascii(t))
        n = min(window, len(w))
        for k in range(len(w) - n + 1) if w else []:
            wins[tuple(w[k : k + n])].add(str(i))
    out = []
    for d, t in docs:
        w = LETTERED.findall(lower_ascii(t))
        hit, items = [False] * len(w), set()
        for n in {len(g) for g in wins}:
            for k in range(len(w) - n + 1):
                if (found := wins.get(tuple(w[k : k + n]))) is not None:
                    items |= found
                    hit[k : k + n] = [True] * n
        h = sum(hit)
        out.append((d, len(w), h, len(items), sha(",".join(sorted(items))), h > 0 and 20 * h >= len(w)))
    return out


def repeats(docs: list[tuple], window: int = 50) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256) per row."""
    first: dict[tuple, int] = {}
    for d, t in docs:
        w = SPACED.findall(t or "")
        for k in range(len(w) - window + 1) if d is not None else []:
            g = tuple(w[k : k + window])
            first[g] = min(first.get(g, d), d)
    out = []
    for d, t in docs:
        w = SPACED.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1) if d is not None else []:
            if first[tuple(w[k : k + window])] < d:
                gone[k : k + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((d, len(w), sum(gone), sha(" ".join(kept))))
    return out


PII = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def personal(text: str | None) -> list[tuple[int, int, int]]:
    """Base spans as (start, kind, end), sorted."""
    out = []
    for kind, (name, pattern) in enumerate(PII):
        for m in pattern.finditer(text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=d: 14 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=d: 10 <= len(d) <= 15,
            }[name]()
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def personal_row(doc_id, text) -> tuple:
    spans = personal(text)
    joined = ",".join(f"{PII[k][0]}:{a}:{b}" for a, k, b in spans)
    return (doc_id, *[sum(k == i for _, k, _ in spans) for i in range(4)], sha(joined))


def size(text: str | None) -> int:
    return len(SPACED.findall(text or ""))


def quality_counts(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    w = SPACED.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    count: dict[tuple, int] = defaultdict(int)
    for i in range(len(w) - 7):
        count[tuple(w[i : i + 8])] += 1
    hit = [False] * len(w)
    for i in range(len(w) - 7):
        if count[tuple(w[i : i + 8])] > 1:
            hit[i : i + 8] = [True] * 8
    n = sum(hit)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, n, len(w) < 20 or 100 * n > 30 * len(w))


def targets(rows: list[tuple], weights=(5, 2, 1), most=3) -> dict:
    """source -> target: the excess over the limit is shared again until none is above."""
    sizes: dict = defaultdict(int)
    for s, n in rows:
        sizes[s] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in stopped)
        over = sum(weight[s] for s in order if s not in stopped)
        out = {s: most * sizes[s] if s in stopped else weight[s] * left / over for s in order}
        more = {s for s in order if s not in stopped and out[s] > most * sizes[s]}
        if not more:
            return out
        stopped |= more
