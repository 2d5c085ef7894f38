"""The contracts of the results in plain Python, row by row."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import numpy as np
import xxhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
SECRETS = (
    ("assign", re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"),
     lambda m: len(m.group(1)) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m.group()) >= 24),
)


def digits(text):
    return re.sub(r"[^0-9]", "", text)


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


PRIVATE = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda m: True),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda m: all(int(p) <= 255 for p in m.group().split("."))),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), lambda m: 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), lambda m: 10 <= len(digits(m.group())) <= 15),
)


def lower(text):
    return (text or "").encode().lower().decode()


def words(text):
    return WORD.findall(lower(text))


def spans(text, kinds):
    """Base spans sorted by start, then kind as listed, and their number by kind."""
    found = [(m.start(), k, m.end(), name) for k, (name, pattern, fine) in enumerate(kinds)
             for m in pattern.finditer(text or "") if fine(m)]
    joined = ",".join(f"{name}:{a}:{b}" for a, _, b, name in sorted(found))
    return [sum(f[3] == name for f in found) for name, *_ in kinds], joined


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text, size=3):
    own = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    if not own:
        return 0
    shingles = [" ".join(own[i:i + size]) for i in range(max(1, len(own) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def links(fingerprints, bits=2):
    """Position of one row of the same group, for every row."""
    n = len(fingerprints)
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    own = np.array(fingerprints, dtype=np.uint64)
    for i in range(n):
        x = own[i + 1:] ^ own[i]
        for j in np.flatnonzero(np.bitwise_count(x) <= bits):
            root[find(i + 1 + int(j))] = find(i)
    return [find(i) for i in range(n)]


def components(fingerprints, ids, bits=2):
    """Smallest id reachable for every row."""
    linked, least = links(fingerprints, bits), {}
    for i, r in zip(ids, linked):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    return [least.get(r) for r in linked]


def base_licenses(text):
    own = words(text)
    places = []
    for phrase, label in BASE_PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(own) - len(p) + 1) if own[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return len(own), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def contamination(text, items, window=13):
    own = words(text)
    hit, found = set(), set()
    places = {}
    for i, w in enumerate(own):
        places.setdefault(w, []).append(i)
    for item, t in items:
        its = words(t)
        for a in range(max(len(its) - window + 1, 1 if its else 0)):
            phrase = its[a:a + window]
            for i in places.get(phrase[0], ()):
                if own[i:i + len(phrase)] == phrase:
                    hit.update(range(i, i + len(phrase)))
                    found.add(str(item))
    n = len(hit)
    return len(own), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(own)


def held_out(doc_id, parts, part):
    return zlib.crc32(str(doc_id).encode()) % parts == part


def top(vectors, every=50, k=5, scale=256):
    fine = [(i, [math.floor(scale * x) for x in v]) for i, v in vectors
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows = []
    for a, (q, v) in enumerate(fine):
        if q % every == 0:
            scored = sorted(((-sum(x * y for x, y in zip(v, w)), i) for b, (i, w) in enumerate(fine) if b != a))[:k]
            rows += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return rows


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def notices(text, known, error_share):
    """Label, start, end, edits of all runs of words near a notice; of those that overlap, the best of each notice."""
    own, found = words(text), set()
    for notice, label in known:
        k, fits = len(notice) // error_share, []
        for i in range(len(own)):
            for j in range(i + 1, len(own) + 1):
                part = " ".join(own[i:j])
                if len(part) > len(notice) + k:
                    break
                if len(part) >= len(notice) - k and edit_distance(part, notice) <= k:
                    fits.append((edit_distance(part, notice), i, j))
        taken = []
        for edits, i, j in sorted(fits):
            if all(j <= a or b <= i for a, b in taken):
                taken.append((i, j))
                found.add((i, j, label, edits))
    return [(label, i, j, e) for i, j, label, e in sorted(found)]


def plain_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    own = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(own[i:i + 3]) for i in range(len(own) - 2)]
    seen, inside = {}, set()
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    for i, w in enumerate(windows):
        if seen[w] > 1:
            inside |= {i, i + 1, i + 2}
    n, again = len(own), len(inside)
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return n, sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), dup, again, n < 50 or 100 * again > 50 * n


def private_terms(texts, threshold=0.8, least=2):
    """Spans (start, end) of the terms of every text that give one of its entities away; equal texts are one document."""
    import regex

    one = sorted({t or "" for t in texts})
    split = lambda t: {w for w in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if len(w) >= 3}
    entities, context, places = {}, {}, {}
    for t in one:
        found = [(name, m.group().lower(), m.span()) for name, pattern, fine in PRIVATE for m in pattern.finditer(t) if fine(m)]
        entities[t], places[t] = {f[:2] for f in found}, [f[2] for f in found]
        rest = t
        for _, pattern, fine in PRIVATE:
            rest = pattern.sub(lambda m, fine=fine: " " if fine(m) else m.group(), rest)
        context[t] = split(rest)
    n, count = len(one), {}
    for t in one:
        for w in split(t):
            count[w] = count.get(w, 0) + 1
    of = {}
    for t in one:
        for e in entities[t]:
            of.setdefault(e, []).append(t)
    telling = {}
    for e, docs in of.items():
        if not least <= len(docs) < n:
            continue
        for w in set().union(*(context[t] for t in docs)):
            both = sum(w in context[t] for t in docs)
            if both >= least and math.log(n * both / (count[w] * len(docs))) >= threshold * math.log(n / len(docs)):
                for t in docs:
                    if w in context[t]:
                        telling.setdefault(t, set()).add(w)
    spans = {}
    for t in one:
        own = [m.span() for m in regex.finditer(r"[\p{L}\p{N}]+", t) if m.group().lower() in telling.get(t, ())]
        spans[t] = [(a, b) for a, b in own if not any(c < b and a < d for c, d in places[t])]
    return [spans[t or ""] for t in texts]
