"""The results by the shortest way, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def small(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(text, items, window=10):
    words = WORD.findall(small(text or ""))
    hit, names = set(), set()
    for name, item in items:
        found = WORD.findall(small(item or ""))
        size = min(window, len(found))
        runs = {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in runs:
                hit |= set(range(i, i + size))
                names |= {str(name)} if name is not None else set()
    names = sorted(names)
    return len(words), len(hit), len(names), sha(",".join(names)), bool(hit)


def near(text, item, slop=2, window=10):
    """Whether some window has a start at which each word occurs within ``slop`` of its place."""
    words, found = WORD.findall(small(text or "")), WORD.findall(small(item or ""))
    size = min(window, len(found))
    for at in range(len(found) - size + 1 if found else 0):
        run = found[at : at + size]
        for s in range(-slop, len(words) + slop):
            if all(w in words[max(0, s + i - slop) : max(0, s + i + slop + 1)] for i, w in enumerate(run)):
                return True
    return False


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal(text):
    text = text or ""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    order = ["email", "ip", "card", "phone"]
    return sorted(found, key=lambda s: (s[1], order.index(s[0])))


def fingerprint(text):
    words = SPACED.findall(small(text or ""))
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(r), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fingerprints, ids, radius=2):
    """Smallest id of each row's component, all pairs compared."""
    root = list(range(len(fingerprints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(root)):
        for j in range(i):
            if (fingerprints[i] ^ fingerprints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    groups = {}
    for i, d in enumerate(ids):
        groups.setdefault(find(i), []).append(d)
    smallest = {r: min((d for d in g if d is not None), default=None) for r, g in groups.items()}
    return [smallest[find(i)] for i in range(len(root))]


def quality(text):
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    runs, repeated = {}, set()
    for i in range(len(words) - 4):
        runs.setdefault(tuple(words[i : i + 5]), []).append(i)
    for places in runs.values():
        if len(places) > 1:
            for i in places:
                repeated |= set(range(i, i + 5))
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), failed


def remainder(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m
