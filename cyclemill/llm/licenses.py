"""Licence notices: exact phrases, and fuzzy search for short notices.

A notice that may have k errors is cut into k + 1 pieces; by the pigeonhole
principle at least one piece of any match is free of errors. The pieces are looked
for exactly. Where one stands, the match can begin and end only a few letters from where the
whole notice would: the regex library matches every run of whole words
between such places with at most k edits and counts them. Of matches of one notice that
overlap, the one with the fewest edits stays, then the first, then the shorter one.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import regex
from pyspark.sql import Column

from cyclemill.llm.common import column

# phrase and label pairs of the exact search
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)
# short notices of the fuzzy search, as words in small letters, with their labels
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("apache software foundation", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("creative commons attribution", "cc-by"),
    ("licensed under cc by", "cc-by"),
    ("licensed under cc by nc", "cc-by-nc"),
    ("licensed under cc by sa", "cc-by-sa"),
    ("this work is in the public domain", "public-domain"),
    ("boost software license", "boost"),
    ("isc license", "isc"),
    ("spdx license identifier", "spdx"),
    ("all rights reserved", "reserved"),
)
ERROR_SHARE = 14  # letters of a notice for each error that it may have
KIND = (
    "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, "
    "labels array<string>, score double, spans array<struct<label:string,start:bigint,end:bigint,edits:int>>"
)


def word_table() -> bytes:
    """Letters, digits and non-ASCII bytes as they are, A-Z as small letters, all else as a space."""
    table = bytearray(b"\x20" * 256)
    for c in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
        table[c] = c
    for c in range(0x41, 0x5B):
        table[c] = c + 0x20
    return bytes(table)


TABLE = word_table()


class Notice:
    """A notice with its error bound and the pieces of which one must stand unchanged."""

    def __init__(self, text: str, label: str, error_share: int):
        self.text, self.label = text, label
        self.errors = len(text) // error_share
        parts = self.errors + 1
        cuts = [round(i * len(text) / parts) for i in range(parts + 1)]
        self.pieces = [(text[a:b], a) for a, b in zip(cuts, cuts[1:])]
        self.pattern = regex.compile(rf"(?b)(?:{regex.escape(text, special_only=True)}){{e<={self.errors}}}")

    def edits(self, part: str) -> int | None:
        """Letters changed, missing or added in ``part``; none if they are too many."""
        if part == self.text:
            return 0
        found = self.pattern.fullmatch(part) if self.errors else None
        return found and sum(found.fuzzy_counts)


class Finder:
    def __init__(self, base=BASE, notices=NOTICES, error_share: int = ERROR_SHARE):
        self.base = [(f" {phrase} ", label) for phrase, label in base]
        self.notices = [Notice(text, label, error_share) for text, label in notices]
        pieces: dict[str, list[tuple[Notice, int]]] = {}
        for notice in self.notices:
            for piece, at in notice.pieces:
                pieces.setdefault(piece, []).append((notice, at))
        self.pieces = pieces
        self.shortest = {n.label: min(len(m.text) for m in self.notices if m.label == n.label) for n in self.notices}

    def base_places(self, joined: str) -> list[tuple[int, str]]:
        """First letter and label of every place of an exact phrase, overlapping ones too."""
        places = []
        for phrase, label in self.base:
            at = joined.find(phrase)
            while at >= 0:
                places.append((at, label))
                at = joined.find(phrase, at + 1)
        return places

    def seeds(self, joined: str) -> dict[Notice, set[int]]:
        """Where every notice would begin whose pieces stand in the text."""
        found: dict[Notice, set[int]] = {}
        for piece, owners in self.pieces.items():
            at = joined.find(piece)
            while at >= 0:
                for notice, offset in owners:
                    found.setdefault(notice, set()).add(at - offset)
                at = joined.find(piece, at + 1)
        return found

    def notice_spans(self, joined: str, first: list[int], last: list[int]) -> list[tuple[str, int, int, int]]:
        """Label, first word, end word and edits of every notice with few errors; ``first`` and ``last`` bound the words."""
        spans = set()
        for notice, places in self.seeds(joined).items():
            k, n, tried, found = notice.errors, len(notice.text), set(), []
            for place in places:
                for i in range(bisect_left(first, place - k), bisect_right(first, place + k)):
                    a = first[i]
                    for j in range(max(i, bisect_left(last, a + n - k)), bisect_right(last, a + n + k)):
                        if (i, j) not in tried:
                            tried.add((i, j))
                            edits = notice.edits(joined[a:last[j]])
                            if edits is not None:
                                found.append((edits, i, j + 1))
            taken: list[tuple[int, int]] = []
            for edits, i, j in sorted(found):
                at = bisect_left(taken, (i, j))
                if (at == 0 or taken[at - 1][1] <= i) and (at == len(taken) or taken[at][0] >= j):
                    taken.insert(at, (i, j))
                    spans.add((notice.label, i, j, edits))
        return sorted(spans, key=lambda s: (s[1], s[2], s[0], s[3]))

    def __call__(self, raw: bytes):
        words = raw.translate(TABLE).split()
        if not words:
            return (0, 0, None, None, [], [], 0.0, [])
        joined = (b" " + b" ".join(words) + b" ").decode()
        places = self.base_places(joined)
        if not places and not any(piece in joined for piece in self.pieces):
            return (len(words), 0, None, None, [], [], 0.0, [])
        first, last, at = [], [], 1
        for word in words:
            first.append(at)
            at += len(word.decode())
            last.append(at)
            at += 1
        spans = self.notice_spans(joined, first, last)
        at = [bisect_left(first, p + 1) for p, _ in places]
        base = sorted({label for _, label in places})
        found = [dict(zip(("label", "start", "end", "edits"), span)) for span in spans]
        labels = sorted({*base, *(s["label"] for s in found)})
        score = 1.0 if places else max((1 - s["edits"] / self.shortest[s["label"]] for s in found), default=0.0)
        return (
            len(words), len(places), min(at) if at else None, max(at) if at else None, base, labels, float(score), found,
        )


def licenses(text: str = "text", base=BASE, notices=NOTICES, error_share: int = ERROR_SHARE) -> Column:
    """Struct of exact places, labels, a score and the notices found in a whole text.

    Spans are whole words, counted from 0, end exclusive; ``edits`` is the number of changed,
    missing and added letters, whatever their number of bytes. A null text is empty; one without words has no label
    and score 0. Places may overlap and all count.
    """

    def kernel():
        finder = Finder(base, notices, error_share)
        return lambda texts: [finder(raw) for raw in texts]

    return column(kernel, KIND, text)


