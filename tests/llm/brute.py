"""Plain versions of the operators, one document at a time, to hold the queries against."""

import hashlib
import re
from collections import defaultdict


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def contamination(docs, items, window=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    phrases = defaultdict(set)
    for item, text in items:
        own = words(text)
        for i in range(max(1, len(own) - window + 1) if own else 0):
            phrases[tuple(own[i:i + window])].add("" if item is None else str(item))
    lengths = {len(p) for p in phrases}
    out = []
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for i in range(len(own)):
            for n in lengths:
                key = tuple(own[i:i + n])
                if len(key) == n and key in phrases:
                    hit.update(range(i, i + n))
                    found |= phrases[key]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(found), digest, bool(hit)))
    return out


def similar(docs, width=5, percent=80):
    sets = {}
    for doc_id, text in docs:
        own = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        sets[doc_id] = {tuple(own[i:i + width]) for i in range(len(own) - width + 1)} or ({tuple(own)} if own else set())
    parent = {d: d for d in sets}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    for a, b in {(a, b) for h in holders.values() for a in h for b in h if a < b}:
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            parent[max(top(a), top(b))] = min(top(a), top(b))
    return [(d, len(s), top(d)) for d, s in sets.items()]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def personal_data(text):
    """Spans of each kind, as (start, end)."""
    text = text or ""
    only = lambda m: re.sub("[^0-9]", "", m[0])
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(only(m)) <= 19 and luhn(only(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(only(m)) <= 15)}
    return {k: [m.span() for m in re.finditer(p, text) if good(m)] for k, (p, good) in rules.items()}


def quality(text):
    """Words, characters in words, symbols, repeated lines, words in repeated windows."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i:i + 8])].append(i)
    hit = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit))


def segments(scores):
    """Maximal scoring segments by their definition: the best one, then those left and right of it."""
    if not scores or max(scores) <= 0:
        return []
    best = None
    for i in range(len(scores)):
        total = 0
        for j in range(i, len(scores)):
            total += scores[j]
            if best is None or total > best[0] + 1e-12:
                best = (total, i, j)
    total, i, j = best
    return [*segments(scores[:i]), (i, j, total), *[(a + j + 1, b + j + 1, s) for a, b, s in segments(scores[j + 1:])]]
