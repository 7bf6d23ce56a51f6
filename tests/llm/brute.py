"""Plain, slow versions of the operators' contracts."""

import hashlib
import re
import zlib
from collections import defaultdict

SPACE = re.compile(r"[\x20\x09-\x0D]+")
NOT_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def spaced_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, size):
    w = spaced_words(lower(text))
    return {tuple(w)} if 0 < len(w) < size else {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()


def near_duplicates(docs, size=2, percent=80):
    sets = {i: shingles(t, size) for i, t in docs}
    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        common = defaultdict(int)
        for x in s:
            for j in holders[x]:
                common[j] += j > i
        for j, c in common.items():
            if 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {(i, len(s), find(i), find(i) == i) for i, s in sets.items()}


def exact_duplicates(docs):
    groups = defaultdict(list)
    for i, t in docs:
        groups[SPACE.sub(" ", t or "")].append(i)
    return {(i, min(ids), len(ids), i == min(ids), sha(t)) for t, ids in groups.items() for i in ids}


def substrings(docs, size=50):
    first = {}
    words = {i: spaced_words(t) for i, t in docs}
    for i, w in words.items():
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, i), i)
    out = set()
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        out.add((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def leaks(docs, items, window=10):
    grams = defaultdict(set)
    for k, t in items:
        w = re.findall(NOT_ALNUM, lower(t))
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            grams[tuple(w[i : i + n])].add(str(k))
    lengths = {len(g) for g in grams}
    out = set()
    for i, t in docs:
        w = re.findall(NOT_ALNUM, lower(t))
        hit, names = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (g := tuple(w[k : k + n])) in grams:
                    hit.update(range(k, k + n))
                    names |= grams[g]
        out.add((i, len(w), len(hit), len(names), sha(",".join(sorted(names))), bool(hit)))
    return out


def licence_base(docs):
    out = set()
    for i, t in docs:
        w = re.findall(NOT_ALNUM, lower(t))
        places, labels = [], set()
        for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
            p = phrase.split()
            got = [k for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p]
            places += got
            labels |= {label} if got else set()
        out.add((i, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))))
    return out


def sharded_capacity(docs, cut_order, shards):
    """Loads of the shards by exact search, with groups in the order given and large groups set aside as documented."""
    size = defaultdict(int)
    for i, t in docs:
        size[t or ""] += len((t or "").encode()) + 16
    alone = {}
    while True:
        rest = {t: s for t, s in size.items() if t not in alone}
        left = shards - len(alone)
        large = [t for t, s in rest.items() if s * left > sum(rest.values())] if left > 1 else []
        if not large:
            break
        alone |= {t: size[t] for t in large}
    order = [rest[t] for t in sorted(rest, key=cut_order)]

    def walk(c):
        loads = [0]
        for s in order:
            if s > c:
                return None
            if loads[-1] + s > c:
                loads.append(0)
            loads[-1] += s
        return loads if len(loads) <= left else None

    if not order:
        return sorted(alone.values())
    low, high = 1, sum(order)
    while low < high:
        m = (low + high) // 2
        low, high = (low, m) if walk(m) else (m + 1, high)
    return sorted([*walk(low), *alone.values()])


def crc(text):
    return zlib.crc32((text or "").encode())
