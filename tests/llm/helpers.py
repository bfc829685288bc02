"""Brute-force versions of the llm operators and small tables of awkward rows."""

import collections
import random
import re
import string

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def lower(text):
    return (text or "").translate(_LOWER)


def words(text, pattern=PLAIN):
    return pattern.findall(text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward_rows(seed=1):
    """(doc_id, text): nulls, empty and blank texts, ties, copies, near copies, odd characters."""
    rng = random.Random(seed)
    base = [prose(rng, 120) for _ in range(4)]
    rows = [(1, None), (2, ""), (3, " \t\n "), (4, "one two three"), (5, "One TWO three"), (6, "ümlaut Ünd 漢字 и слово\x0b\x1cx"),
            (7, base[0]), (8, base[0]), (8, base[0]), (9, base[0] + " tail words"), (10, base[1]), (11, base[1].replace(" ", "\n")),
            (12, base[2] + " " + base[2]), (13, "#* $% " * 40), (None, base[3]), (14, base[3]), (15, "a"), (16, "b " * 300)]
    for i in range(12):   # a group of near copies, each changed in its own place
        own = base[1].split()
        own[rng.randrange(len(own))] = f"new{i}"
        rows.append((20 + i, " ".join(own)))
    return rows


def shingles(text, k=5):
    w = words(lower(text))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def jaccard_components(rows, k=5, percent=75):
    """Multiset of (doc_id, n_shingles, component_id)."""
    sets, parent, post = [shingles(t, k) for _, t in rows], list(range(len(rows))), collections.defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        common = collections.Counter(j for g in s for j in post[g])
        for j, o in common.items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                parent[find(i)] = find(j)
        for g in s:
            post[g].append(i)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(sets[i]), low.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def covered(w, length):
    """Words inside windows of ``length`` words that occur twice or more."""
    at = collections.defaultdict(list)
    for i in range(len(w) - length + 1):
        at[tuple(w[i:i + length])].append(i)
    return len({j for p in at.values() if len(p) > 1 for i in p for j in range(i, i + length)})


def longest_repeat(w):
    n = 0
    while n < len(w) and len({tuple(w[i:i + n + 1]) for i in range(len(w) - n)}) < len(w) - n:
        n += 1
    return n


def repetition(text, min_words=8):
    text = text or ""
    w, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, covered(w, 3), covered(w, min_words), longest_repeat(w))


def contamination(text, items, window=13):
    """(n_words, n_hit, sorted items)."""
    w, hit, found = words(lower(text), ALNUM), set(), set()
    for item, t in items:
        own = words(lower(t), ALNUM)
        for i in range(max(len(own) - window, 0) + 1 if own else 0):
            pattern = own[i:i + window]
            for p in range(len(w) - len(pattern) + 1):
                if w[p:p + len(pattern)] == pattern:
                    hit |= set(range(p, p + len(pattern)))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(hit), sorted(found)
