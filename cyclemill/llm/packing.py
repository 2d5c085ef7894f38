"""Packing documents into windows of tokens by order-preserving dynamic programming.

Each task packs the documents it reads, in their order, block by block. Over the
block's token stream a window may end at every position: cuts between documents are free, cuts
at sentence ends cost ``SENTENCE_COST``, and all others ``SPLIT_COST``. The
cost of a window that is not full is its padding; a length that is a power of two is
not padded, but one more sequence. The least total is found by dynamic programming over all positions, a block
of them at once. Between two places that are cheaper to cut, what windows of any sizes cost depends on the distance
alone, so a table of the cheapest such chains is made once; by it the windows are read back from the costs.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cyclemill.llm.common import per_worker

WINDOW = 2048
END = 1
VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"  # the special token of the vocabulary, whose id follows all others
BLOCK_TOKENS = 1 << 18
SENTENCE_COST = 1.0
SPLIT_COST = 6.0
FULL = 1  # full windows in the table of chains; longer chains go on from it, without end


class Encoder:
    """Ids of the byte-level BPE vocabulary; the end id closes every document.

    ``tiktoken`` runs the ranks of the vocabulary that ``tokenizers`` reads from its
    JSON file: the same ids, in a fifth of the time (see README). As there, the string
    of the special token is that token wherever it stands in a text.
    """

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coder = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)}
        )
        self.stops = np.zeros(len(ranks) + 1, dtype=bool)
        for piece, number in ranks.items():
            self.stops[number] = piece.rstrip()[-1:] in (b".", b"!", b"?") or b"\n" in piece

    def __call__(self, text: str | None) -> np.ndarray:
        return np.array([*self.coder.encode(text or "", allowed_special="all"), END], dtype="<u4")


def cut_places(ids: list[np.ndarray], stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ends of sentences and documents in the stream, and what ending a window there costs."""
    stream = np.concatenate(ids)
    ends = np.cumsum([len(own) for own in ids])
    cheap = stops[stream]
    cheap[ends - 1] = True  # the end id, behind which the document is over
    place = np.flatnonzero(cheap) + 1
    cost = np.full(len(place), SENTENCE_COST)
    cost[np.searchsorted(place, ends)] = 0.0
    return place, cost


def chains(window: int) -> tuple[np.ndarray, list[int]]:
    """For every distance up to two windows, less one token: the least cost of windows that cover it, and the first one's size.

    Beyond, a chain always has a full window: the others are at most one that is padded and one of every power of
    two, since two of a kind are cheaper as one of twice the size.
    """
    powers = [1 << k for k in range(window.bit_length()) if 1 << k < window]
    best, first = [0.0], [0]
    for d in range(1, (FULL + 1) * window):
        low, size = (float(window - d), d) if d <= window else (float("inf"), 0)
        if d in powers:
            low = min(low, 1.0)  # a short window is one more sequence
        for step in (*powers, window):
            if step < d:
                value = best[d - step] + SPLIT_COST + (step < window)
                if value < low:
                    low, size = value, step
        best.append(low)
        first.append(size)
    return np.array(best[1:], dtype=np.float32), first


def least_costs(place: np.ndarray, cost: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For every position 0 .. place[-1] the least cost of windows up to it, the cut there not counted and counted.

    Positions are worked on in blocks that the sizes of full and padded windows reach over, so that only powers of two
    begin and end in the same block; their costs are lowered until none falls any more.
    """
    end = int(place[-1])
    powers = [1 << k for k in range(window.bit_length()) if 1 << k < window]
    # fewer tokens are cheaper as one window of each power of two, whatever it costs to cut between them
    shortest = max(1, window - int(SPLIT_COST + 1) * len(powers))
    # a cut, and one for the sequence behind it if that is of a power of two
    cut = np.full(end + 1, SPLIT_COST + 1, dtype=np.float32)
    cut[place] = cost + 1
    least = np.zeros(end + 1, dtype=np.float32)
    # with the cut, behind a front that no window begins in
    paid = np.full(window + end + 1, np.inf, dtype=np.float32)
    paid[window] = 1.0
    ramp = np.arange(window, dtype=np.float32)
    for a in range(1, end + 1, shortest):
        b = min(end + 1, a + shortest)
        own, mine = least[a:b], paid[window + a:window + b]
        np.subtract(paid[a:b], 1, own)
        if shortest < window:
            # the least over all sizes that may be padded, by doubling the stretch it is taken over
            low = paid[a + 1:window + b - shortest]
            low, n = low + ramp[:len(low)], 1
            while 2 * n <= window - shortest:
                low, n = np.minimum(low[:-n], low[n:]), 2 * n
            rest = window - shortest - n
            np.minimum(own, np.minimum(low[:b - a], low[rest:rest + b - a]) - ramp[:b - a], own)
        while True:
            np.add(own, cut[a:b], mine)
            for step in powers:
                np.minimum(own, paid[window + a - step:window + b - step], own)
            if np.array_equal(own + cut[a:b], mine):
                break
    return least, paid[window:] - 1


def cheapest_cuts(place: np.ndarray, cost: np.ndarray, window: int) -> list[int]:
    """Ends of the windows of least padding and cut cost over the stream 0 .. place[-1], cut at any position."""
    table, first = per_worker(("chains", window, SPLIT_COST), lambda: chains(window))
    reach, end = len(table), int(place[-1])
    least, paid = least_costs(place, cost, window)
    where = np.concatenate(([0], place))
    price = paid[where]
    one = np.array([min(window - n, 1) if n & (n - 1) == 0 else window - n for n in range(window + 1)])
    ends, p = [], end
    while p > 0:
        ends.append(p)
        low, high = np.searchsorted(where, (p - reach, p))
        met = np.flatnonzero(price[low:high] + table[p - where[low:high] - 1] == least[p])
        if len(met):
            start = int(where[low + met[-1]])
            while first[p - start] < p - start:
                p -= first[p - start]
                ends.append(p)
            p = start
        else:
            # of windows that begin elsewhere, the longest: a full one, if the window is a power of two
            start = max(0, p - window)
            p = start + int(np.flatnonzero(paid[start:p] + one[p - start:0:-1] == least[p])[0])
    return ends[::-1]


def pack(ids: list[np.ndarray], stops: np.ndarray, window: int):
    """Pieces (document, start, length, sequence, offset) of a block, sequences from 0."""
    place, cost = cut_places(ids, stops)
    ends = np.array(cheapest_cuts(place, cost, window))
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
    borders = np.unique(np.concatenate((bounds, ends)))
    start, stop = borders[:-1], borders[1:]
    document = np.searchsorted(bounds, start, side="right") - 1
    sequence = np.searchsorted(ends, start, side="right")
    first = np.concatenate(([0], ends))[sequence]
    return document, start - bounds[document], stop - start, sequence, start - first, len(ends)


SCHEMA = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def packed(
    docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False,
    window: int = WINDOW, vocabulary: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row for each piece of a document in a sequence, with the columns ``keep`` of the document.

    Sequence ids count up within a task and never repeat. ``with_ids`` adds the ids
    themselves. A null or empty text is the end id alone; repeated rows are packed
    one by one; an empty table has no pieces. Memory is bounded by the block and the
    longest document.
    """
    kept = [docs.schema[name] for name in keep]
    own = T._parse_datatype_string(SCHEMA + (", ids array<long>" if with_ids else ""))
    schema = T.StructType([*kept, *own])
    arrow = to_arrow_schema(schema)
    names = list(keep)

    def run(batches):
        encoder = per_worker(("encoder", vocabulary), lambda: Encoder(vocabulary))
        base = TaskContext.get().partitionId() << 33
        rows, ids, size = [], [], 0

        def flush():
            nonlocal base, rows, ids, size
            document, start, length, sequence, offset, used = pack(ids, encoder.stops, window)
            made = {name: [] for name in arrow.names}
            for d, s, n, q, o in zip(*(x.tolist() for x in (document, start, length, sequence, offset))):
                piece = ids[d][s:s + n]
                for name, value in zip(names, rows[d]):
                    made[name].append(value)
                for name, value in zip(
                    own.names, (s, n, zlib.crc32(piece.tobytes()), len(ids[d]), base + q, o, piece.tolist() if with_ids else None)
                ):
                    made[name].append(value)
            base, rows, ids, size = base + used, [], [], 0
            return pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                own_ids = encoder(columns[-1][i].as_py())
                rows.append([c[i].as_py() for c in columns[:-1]])
                ids.append(own_ids)
                size += len(own_ids)
                if size >= block_tokens:
                    yield flush()
        if ids:
            yield flush()

    from pyspark.sql import functions as F

    return docs.select(*keep, F.col(text).cast("string").alias("__text__")).mapInArrow(run, schema)
