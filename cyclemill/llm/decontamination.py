"""Benchmark decontamination with an FM-index per shard of the training text.

The words that occur in the benchmark are the alphabet; every other word is the
separator, which no test phrase contains. A shard is a bounded run of whole
documents. Its index holds the runs of alphabet words at least as long as the
shortest phrase, since no other place can hold one. All phrases are searched
backwards at once: a step is two ranks in a wavelet tree. The occurrences are
located from sampled suffix positions and merged to spans of hit words.

The phrases go to the executors in blocks of ``BLOCK_WORDS`` benchmark words. A
benchmark of one block, the usual case, takes one pass without a shuffle; with
more, each document meets each block and the spans are merged by document row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string

from cyclemill.llm.common import fresh, segments, slices, written
from cyclemill.llm.words import Hasher

WINDOW = 13
SHARD_BYTES = 4 << 20
BLOCK_WORDS = 1 << 20
SAMPLE = 8


class Wavelet:
    """Ranks of symbols in a sequence, by one bit vector for each bit of the alphabet (a wavelet matrix)."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            ones = (symbols >> bit) & 1 == 1
            before = np.zeros(len(symbols) + 1, dtype=np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, len(symbols) - int(before[-1])))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        low, at = np.zeros_like(at), at.copy()
        for bit, before, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            low_ones, at_ones = before[low], before[at]
            low = np.where(one, zeros + low_ones, low - low_ones)
            at = np.where(one, zeros + at_ones, at - at_ones)
        return at - low


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by doubling; only suffixes that still tie are sorted again."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    key = symbols[order]
    rank = np.empty(n, dtype=np.int64)
    group = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    rank[order] = np.repeat(group, np.diff(np.append(group, n)))
    step = 1
    while True:
        sizes = np.diff(np.append(group, n))
        open_ = np.repeat(sizes > 1, sizes)
        at = np.flatnonzero(open_)
        if not len(at):
            return order
        tied = order[at]
        after = tied + step
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
        first = rank[tied]
        sort = np.lexsort((second, first))
        tied, first, second = tied[sort], first[sort], second[sort]
        order[at] = tied
        new = np.concatenate(([True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])))
        rank[tied] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        # a start of a group is where the rank equals the place
        group = np.flatnonzero(rank[order] == np.arange(n))
        step *= 2


class FMIndex:
    """Backward search and location in a sequence of symbols; symbol 0 separates and ends it."""

    def __init__(self, symbols: np.ndarray, bits: int):
        n = len(symbols)
        order = suffix_order(symbols)
        self.wavelet = Wavelet(symbols[order - 1], bits)
        self.last = symbols[order - 1]
        self.first = np.searchsorted(symbols[order], np.arange((1 << bits) + 1))
        self.size = n
        # run starts are sampled too, so that no step crosses a separator
        self.sampled = (order % SAMPLE == 0) | (self.last == 0)
        self.sample_rank = segments(self.sampled)
        self.samples = order[self.sampled]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the suffixes that begin with each phrase (a row of symbols, filled up with zeros)."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.size, dtype=np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, lengths[live] - back]
            base = self.first[symbol]
            low[live] = base + self.wavelet.rank(symbol, low[live])
            high[live] = base + self.wavelet.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step to the left until a sampled one is met."""
        rows, steps = rows.copy(), np.zeros(len(rows), dtype=np.int64)
        while True:
            todo = np.flatnonzero(~self.sampled[rows])
            if not len(todo):
                return self.samples[self.sample_rank[rows]] + steps
            symbol = self.last[rows[todo]]
            rows[todo] = self.first[symbol] + self.wavelet.rank(symbol, rows[todo])
            steps[todo] += 1


class Phrases:
    """The windows of a block of test items over the alphabet of their words."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        hasher = Hasher("alnum")
        hashes, _, counts, _ = hasher([text for _, text in items])
        ends = segments(counts)
        self.alphabet = np.unique(hashes)
        symbols = np.searchsorted(self.alphabet, hashes) + 1
        rows, self.item_of = [], []
        for i in range(len(items)):
            own = symbols[ends[i]:ends[i + 1]]
            for at in range(max(len(own) - window + 1, 1 if len(own) else 0)):
                rows.append(own[at:at + window])
                self.item_of.append(i)
        self.items = [name for name, _ in items]
        padded = np.zeros((len(rows), window + 1), dtype=np.int64)
        for i, row in enumerate(rows):
            padded[i, :len(row)] = row
            padded[i, window] = len(row)
        # equal windows of several items are searched once
        self.windows, back = np.unique(padded, axis=0, return_inverse=True) if len(rows) else (padded, np.zeros(0, int))
        self.lengths = self.windows[:, window]
        pair = np.unique(np.stack((back.reshape(-1), np.array(self.item_of, dtype=np.int64)), axis=1), axis=0)
        self.owner = pair[:, 1]
        self.owners = segments(np.bincount(pair[:, 0], minlength=len(self.windows)))
        self.shortest = int(self.lengths.min(initial=window))
        self.bits = max(1, int(len(self.alphabet)).bit_length())

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.alphabet):
            return np.zeros(len(hashes), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, hashes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == hashes, at + 1, 0)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one after another."""
    total = int(lengths.sum())
    offset = np.repeat(starts - segments(lengths)[:-1], lengths)
    return offset + np.arange(total)


def shard_hits(hashes: np.ndarray, counts: np.ndarray, phrases: Phrases):
    """Hit words of each document of a shard and (document, item) pairs of occurring windows."""
    symbols = phrases.symbols(hashes)
    document = np.repeat(np.arange(len(counts)), counts)
    hit = np.zeros(len(symbols) + 1, dtype=np.int64)
    none = np.zeros((0, 2), dtype=np.int64)
    if not len(phrases.windows) or not len(symbols):
        return hit[:-1] > 0, none
    # runs of alphabet words within one document
    inside = symbols > 0
    edge = np.flatnonzero((inside[1:] != inside[:-1]) | (document[1:] != document[:-1])) + 1
    start = np.concatenate(([0], edge))
    length = np.diff(np.append(start, len(symbols)))
    keep = inside[start] & (length >= phrases.shortest)
    start, length = start[keep], length[keep]
    if not len(start):
        return hit[:-1] > 0, none
    # the indexed sequence: each run and a separator
    place = ranges(start, length + 1)
    sequence = np.zeros(len(place), dtype=np.int64)
    ends = np.cumsum(length + 1) - 1
    body = np.ones(len(place), dtype=bool)
    body[ends] = False
    sequence[body] = symbols[place[body]]
    index = FMIndex(sequence, phrases.bits)
    low, high = index.search(phrases.windows[:, :-1], phrases.lengths)
    count = high - low
    which = np.repeat(np.arange(len(count)), count)
    at = place[index.locate(ranges(low, count))]
    np.add.at(hit, at, 1)
    np.add.at(hit, at + phrases.lengths[which], -1)
    pairs = np.unique(np.stack((document[at], which), axis=1), axis=0) if len(at) else none
    owners = np.diff(phrases.owners)[pairs[:, 1]]
    items = phrases.owner[ranges(phrases.owners[pairs[:, 1]], owners)]
    return np.cumsum(hit)[:-1] > 0, np.stack((np.repeat(pairs[:, 0], owners), items), axis=1)


KIND = "n_words bigint, spans array<struct<first:bigint,end:bigint>>, items array<string>"


def spans_of(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [{"first": int(a), "end": int(b)} for a, b in zip(edge[0::2], edge[1::2])]


def scanner(items: list[tuple[str, bytes]], window: int, shard_bytes: int):
    """A scalar Arrow function: words, merged spans and items of every text."""
    schema = _parse_datatype_string(KIND)
    arrow = to_arrow_type(schema)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        phrases, hasher = Phrases(items, window), Hasher("alnum")
        for texts in batches:
            rows = []
            for _, raw in slices(texts, shard_bytes):
                hashes, _, counts, _ = hasher(raw)
                hit, found = shard_hits(hashes, counts, phrases)
                ends = segments(counts)
                names = [[] for _ in counts]
                for d, i in np.unique(found, axis=0):
                    names[d].append(phrases.items[i])
                touched = np.bincount(np.repeat(np.arange(len(counts)), counts)[hit], minlength=len(counts)) > 0
                for d in range(len(counts)):
                    spans = spans_of(hit[ends[d]:ends[d + 1]]) if touched[d] else []
                    rows.append({"n_words": int(counts[d]), "spans": spans, "items": sorted(set(names[d]))})
            yield pa.array(rows, arrow)

    return F.arrow_udf(run, schema)


def blocks(benchmark: DataFrame, block_words: int) -> DataFrame:
    """Test items with a block number; a block holds about ``block_words`` words, in no order."""
    size = F.coalesce(F.length("text"), F.lit(0))
    total = benchmark.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    parts = int(total // (6 * block_words)) + 1
    name = F.col("item_id").cast("string")
    return benchmark.select(name.alias("item"), "text", F.pmod(F.xxhash64(name, "text"), F.lit(parts)).alias("block")), parts


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` with a struct column of words, merged spans of hit words, and items found.

    Returns the rows of ``docs`` with one more column, whose name is new: the last.
    Null or empty texts have no words and no spans; a null item has no windows; items
    that share a window all count; repeated rows are scanned one by one.
    """
    items, parts = blocks(benchmark, block_words)
    found = fresh("found")
    if parts == 1:
        held = [(r["item"], (r["text"] or "").encode()) for r in items.collect() if r["item"] is not None]
        return docs.withColumn(found, scanner(held, window, shard_bytes)("text"))
    # more blocks than one: each is held by the driver in turn, documents are scanned for it
    row, part = fresh("row"), fresh("part")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "decontamination")
    scans = None
    for block in range(parts):
        held = [
            (r["item"], (r["text"] or "").encode())
            for r in items.filter(F.col("block") == block).collect() if r["item"] is not None
        ]
        scan = rows.select(row, scanner(held, window, shard_bytes)("text").alias(part))
        scans = scan if scans is None else scans.unionByName(scan)
    merged = scans.groupBy(row).agg(
        F.max(f"{part}.n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list(f"{part}.spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(f"{part}.items")))).alias("items"),
    )
    return rows.join(merged.select(row, F.struct("n_words", "spans", "items").alias(found)), row).drop(row)




def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, **sizes
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items, spans and the verdict, in one struct column (the last)."""
    found = find_contamination(docs, benchmark, window, **sizes)
    c = found.columns[-1]
    spans = F.col(c)["spans"]
    # the union's size: what each span adds beyond the reach of those before it
    state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach"))
    union = F.aggregate(spans, state, lambda s, x: F.struct(
        (s["n"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(x["first"], s["reach"]))).alias("n"),
        F.greatest(s["reach"], x["end"]).alias("reach"),
    ), lambda s: s["n"])
    n_words = F.col(c)["n_words"]
    return found.withColumn(c, F.struct(
        n_words.alias("n_words"), union.alias("n_hit"),
        F.size(F.col(c)["items"]).cast("long").alias("n_items"), F.col(c)["items"].alias("items"), spans.alias("spans"),
        ((union > 0) & (union * share >= n_words)).alias("contaminated"),
    ))


