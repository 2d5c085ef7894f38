"""Words of many texts at once, as 64-bit hashes, with NumPy.

A word is a maximal run of bytes of a class; A-Z count as a-z. The hash sums
``T[byte] * P**position`` modulo 2**64, so one running sum gives the hash of every
word and of every prefix of one.
"""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 20


def byte_class(pattern: str) -> np.ndarray:
    """Which bytes belong to words: ``plain`` all but ASCII space and controls 9-13, ``alnum`` letters, digits and non-ASCII."""
    member = np.zeros(256, dtype=bool)
    if pattern == "plain":
        member[:] = True
        member[[0x20, *range(0x09, 0x0E)]] = False
    else:
        member[0x30:0x3A] = member[0x61:0x7B] = member[0x41:0x5B] = member[0x80:] = True
    return member


def tables() -> tuple[np.ndarray, np.ndarray]:
    """T for every byte (capital letters as small ones) and P, an odd multiplier."""
    values = np.random.default_rng(20240917).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[0x41:0x5B] = values[0x61:0x7B]
    return values, np.uint64(0x9E3779B97F4A7C15)


class Hasher:
    """Splits byte strings into words and hashes them; ``prefixes`` asks for hashes of first bytes too."""

    def __init__(self, kind: str = "alnum", prefixes: tuple[int, ...] = ()):
        self.member = byte_class(kind)
        self.values, self.base = tables()
        self.powers = np.ones(1, dtype=np.uint64)
        self.prefixes = prefixes

    def power(self, n: int) -> np.ndarray:
        if len(self.powers) < n:
            with np.errstate(over="ignore"):
                self.powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(2 * n, self.base))), dtype=np.uint64)
        return self.powers

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Hash of every word, first byte of every word in the joined texts, words per text, hashes of prefixes."""
        joined = b"\x20".join(texts) + b"\x20"
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        raw = np.frombuffer(joined, dtype=np.uint8)
        hashes, firsts, heads = [], [], [[] for _ in self.prefixes]
        at = 0
        while at < len(raw):
            end = min(len(raw), at + CHUNK)
            while end < len(raw) and self.member[raw[end - 1]]:  # never cut a word
                end += 1
            part = raw[at:end]
            inside = self.member[part]
            edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
            if inside[0]:
                edge = np.concatenate(([0], edge))
            start, stop = edge[0::2], edge[1::2]
            if len(stop) < len(start):
                stop = np.concatenate((stop, [len(part)]))
            if len(start):
                length = stop - start
                begin = np.zeros(len(part), dtype=np.int64)
                begin[start] = start
                place = np.arange(len(part)) - np.maximum.accumulate(begin)
                power = self.power(int(length.max()) + 1)
                place[~inside] = 0
                total = np.zeros(len(part) + 1, dtype=np.uint64)
                np.cumsum(np.where(inside, self.values[part] * power[place], np.uint64(0)), out=total[1:])
                hashes.append(mix(total[stop] - total[start]))
                firsts.append(start + at)
                for k, n in enumerate(self.prefixes):
                    heads[k].append(mix(total[np.minimum(start + n, stop)] - total[start]))
            at = end
        none = np.zeros(0, dtype=np.uint64)
        hashed = np.concatenate(hashes) if hashes else none
        first = np.concatenate(firsts) if firsts else none.astype(np.int64)
        bounds = np.searchsorted(first, np.concatenate(([0], np.cumsum(lengths))))
        return hashed, first, np.diff(bounds), [np.concatenate(h) if h else none for h in heads]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a sum over all bits."""
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))
