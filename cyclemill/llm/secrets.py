"""Secrets: fixed formats, and strings that zstandard cannot predict from what surrounds them.

A candidate is a long token in a sensitive context. Its novelty is the marginal
number of compressed bytes: the frame of context and candidate less the frame of
the context alone, with a dictionary of identifiers and code as prefix. It is held
against what random strings of the same length and alphabet cost at that place, so
that neither a small alphabet nor a long key looks predictable. Identifiers, paths
and repeated strings cost much less than those; keys and passwords cost as much.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from cyclemill.llm.common import column

KINDS = ("assign", "access", "hex", "novel")
KIND = "spans array<struct<kind:string,start:bigint,end:bigint,novelty:double>>"
# letters of the names stand in either case
ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a shorter run of the class holds no longer match
HEX = re.compile(r"[0-9a-f]{24,}")
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
SENSITIVE = NAMES + (
    b"credential", b"passphrase", b"authorization", b"bearer", b"private", b"access", b"auth", b"pwd", b"signature",
    b"key=", b"key:", b"key =", b"key\"", b"key'",
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~$!@#%^&*-]{12,}")
CONTEXT = 48
AROUND = 256
STRETCH = 1 << 20
NOVELTY = 0.7  # share of a random string's cost
DRAWS = 8  # random strings of which the mean is taken
ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF")
CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key private_key client_secret client_id authorization bearer "
    "credential username user_name login session cookie request response header content_type application json xml "
    "string integer boolean function return import class public private static final void null true false none self "
    "this const var let def lambda async await throw catch except finally try else elif while for each range index "
    "length size count value values item items list array dict map set object config configuration settings options "
    "environment variable default example sample placeholder your_token_here changeme test_key demo development "
    "production staging localhost http https www com org net index html path file name directory home usr local bin "
    "lib src main init version number identifier uuid hash digest signature encrypt decrypt encode decode base64 "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 0123456789abcdef xxxxxxxxxxxxxxxx aaaaaaaaaaaa "
    "getElementById addEventListener toString valueOf hasOwnProperty setTimeout innerHTML appendChild "
)


class Novelty:
    """Marginal compressed bytes against the dictionary and the surroundings."""

    def __init__(self):
        import zstandard

        held = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(
            level=6, dict_data=held, write_content_size=False, write_checksum=False
        )

    def cost(self, around: bytes, candidates: list[bytes]) -> np.ndarray:
        """Extra bytes for each of the candidates after the surroundings."""
        alone = len(self.compressor.compress(around))
        return np.array([max(0, len(self.compressor.compress(around + c)) - alone) for c in candidates])

    def __call__(self, around: bytes, candidate: bytes) -> float:
        """Extra bytes for the candidate after its surroundings, as a share of a random string's, in 0 to 1."""
        letters = np.frombuffer(alphabet(candidate.decode()).encode(), dtype=np.uint8)
        rng = np.random.default_rng(len(candidate))  # the same strings in every task
        drawn = [letters[rng.integers(len(letters), size=len(candidate))].tobytes() for _ in range(DRAWS)]
        own, *others = self.cost(around, [candidate, *drawn])
        return float(min(1.0, own / max(1.0, np.mean(others))))


def alphabet(token: str) -> str:
    """The characters that a random string of this kind is made of: hexadecimal, or classes, with the token's own signs."""
    for whole in ALPHABETS:
        if not token.isdigit() and set(token) <= set(whole):
            return whole
    held = set(token)
    known = "".join(c for c in CLASSES if held & set(c))
    return known + "".join(sorted(held - set(known)))


def base_spans(text: str, low: bytes) -> list[tuple[int, int, str]]:
    """Leftmost matches of the fixed formats, kind by kind."""
    spans = []
    if any(name in low for name in NAMES):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return spans


def varied(token: str) -> bool:
    """Letters and digits mixed, as in a key, or digits alone; words are not."""
    return token.isdigit() or any(c.isdigit() for c in token) and any(c.isalpha() for c in token)


def has_long_hex(raw: bytes, member: np.ndarray) -> bool:
    """Whether 24 bytes of the class stand in a row anywhere."""
    data = np.frombuffer(raw, dtype=np.uint8)
    for at in range(0, len(data) - 23, STRETCH):
        part = member[data[at:at + STRETCH + 23]]
        others = np.flatnonzero(~part)
        if np.diff(others, prepend=-1, append=len(part)).max() > 24:
            return True
    return False


def scan(text: str, low: bytes, novelty: Novelty) -> list[tuple[int, int, str, float]]:
    found = base_spans(text, low)
    taken = sorted((a, b) for a, b, _ in found)
    spans = [(a, b, kind, None) for a, b, kind in found]
    if any(word in low for word in SENSITIVE):
        at = 0
        for m in CANDIDATE.finditer(text):
            while at < len(taken) and taken[at][1] <= m.start():
                at += 1
            if at < len(taken) and taken[at][0] < m.end() or not varied(m.group()):
                continue
            lead = text[max(0, m.start() - CONTEXT):m.start()].lower().encode(errors="ignore")
            if not any(word in lead for word in SENSITIVE):
                continue
            around = text[max(0, m.start() - AROUND):m.start()] + text[m.end():m.end() + AROUND]
            share = novelty(around.encode(), m.group().encode())
            if share >= NOVELTY:
                spans.append((m.start(), m.end(), "novel", share))
    rank = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(spans, key=lambda s: (s[0], rank[s[2]]))


def finder():
    """A function from a text as bytes to its spans."""
    novelty = Novelty()
    member = np.zeros(256, dtype=bool)
    member[0x30:0x3A] = member[0x61:0x67] = True

    def find(raw: bytes) -> list[tuple[int, int, str, float | None]]:
        low = raw.lower()
        if not (b"AKIA" in raw or has_long_hex(raw, member) or any(w in low for w in SENSITIVE)):
            return []
        return scan(raw.decode(), low, novelty)

    return find


def secrets(text: str = "text") -> Column:
    """Struct with the spans of secrets in a whole text, in code points, end exclusive.

    Sorted by start, then kind. A null or empty text has none. ``novelty`` is null
    for fixed formats. Matches of different formats may overlap; a novel string
    overlaps none of them.
    """

    def kernel():
        find = finder()
        return lambda texts: [
            ([{"kind": k, "start": a, "end": b, "novelty": v} for a, b, k, v in find(raw)],) for raw in texts
        ]

    return column(kernel, KIND, text)


MARKER = "[REDACTED]"


def redacted(text: str = "text") -> Column:
    """Struct of the text with every secret replaced by a marker, and their number; a null text stays null."""

    def cut(value: str, spans) -> str:
        made, at = [], 0
        for a, b, _, _ in spans:
            if b > at:
                if a >= at:
                    made += [value[at:a], MARKER]
                at = b
        return "".join([*made, value[at:]])

    def kernel():
        find = finder()

        def work(texts: list[bytes]):
            rows = []
            for raw in texts:
                spans = find(raw)
                value = raw.decode()
                rows.append((cut(value, spans) if spans else value, len(spans)))
            return rows

        return work

    made = column(kernel, "text string, n int", text)
    return F.struct(F.when(F.col(f"`{text}`").isNotNull(), made["text"]).alias("text"), made["n"].alias("n"))
