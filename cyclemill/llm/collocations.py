"""Collocations by relational mining of phrases, one length after the other.

The occurrences of all frequent phrases of one length are a relation, sorted by piece and position
and written down. A phrase grows by a merge join of its relation with itself: two occurrences that
stand in one piece at adjacent positions make one of the next length. Groups are counted over the
whole table; a semi-join leaves only occurrences of frequent groups, which are written and joined again.

The relation is kept in blocks of up to ``BLOCK_WORDS`` occurrences, one row each, so that a join is a
comparison of neighbours within a block. Positions count on through a block and leave out one number
between pieces: adjacent positions are always of one piece. A piece may run over several blocks; each
begins with the words that the phrases reaching over the cut need, which are joined but not counted
again. What is shuffled are the distinct phrases of a block, with their counts and their places, once
for each length: sums over a phrase's rows count the group, and the rows of those that are frequent go back to their blocks.
A phrase has as many rows as there are blocks that hold it, so that is the most one group can have.

A word is a string, every longer phrase the pair of ids of the phrases it begins and ends with; the id of a phrase is the
least of its places.

Null and empty texts have no pieces. A null language is ``und``. Repeated rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cyclemill.llm.common import removed, written_tidily
from cyclemill.sizing import small_side

BLOCK_WORDS = 1 << 19
PLACE_BITS = 20  # of the items of a block
BLOCK_BITS = 22  # of the blocks of a task
LONGEST = 3
LEAST = 10
TOP = 2000
CANDIDATES_PER_TASK = 1 << 17
UNKNOWN = "und"
# a block is a row of some MB: what readers, writers and Python hold of them at once
BLOCKS_IN_GROUP = 2
BATCH_BYTES = 1 << 22

# bytes that end a piece become line feeds; A-Z become a-z
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
TABLE = bytes(0x0A if b in ENDS else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
OUTSIDE = np.zeros(256, dtype=bool)
OUTSIDE[[0x0A, 0x20, 0x09]] = True

written_in_parts = partial(written_tidily, batch_bytes=BATCH_BYTES)
written_blocks = partial(written_in_parts, group_rows=BLOCKS_IN_GROUP)

WORDS = "items array<string>, n array<int>, lang string, lead int, item array<int>, step array<int>"
RELATION = "block long, lang string, lead int, ids array<long>, item array<int>, step array<int>"


def words_and_steps(raw: bytes) -> tuple[list[bytes], np.ndarray]:
    """The words of a text, and how far each lies behind the one before: 1 in the same piece, else 2."""
    raw = raw.translate(TABLE)
    bytes_ = np.frombuffer(raw, dtype=np.uint8)
    outside = OUTSIDE[bytes_]
    first = ~outside
    first[1:] &= outside[:-1]
    piece = np.cumsum(bytes_ == 0x0A)[first]
    return raw.split(), 1 + (np.diff(piece, prepend=-1) > 0)


def counts(items: int, item: np.ndarray, position: np.ndarray, lead: int) -> np.ndarray:
    """How often every item occurs; the first ``lead`` positions are those of the block before."""
    return np.bincount(item[position > lead], minlength=items)


class Block:
    """Occurrences of words of one language, until they are enough for a block; every different word is held once."""

    def __init__(self, lang: str, longest: int):
        self.lang, self.keep = lang, longest - 1
        self.clear([])

    def clear(self, lead: list[bytes]) -> None:
        self.ids: dict[bytes, int] = {}
        self.numbers, self.steps, self.lead, self.n = [], [], len(lead), 0
        self.last: list[bytes] = []  # the words that the next block may need
        self.put(lead, np.ones(len(lead), dtype=np.int64))

    def add(self, words: list[bytes], steps: np.ndarray, size: int) -> Iterator[tuple]:
        """Take in a text's words; yields the blocks that are full."""
        at = 0
        while self.n + len(words) - at >= size:
            cut = at + max(size - self.n, 1)
            self.put(words[at:cut], steps[at:cut])
            # the words before the cut that are of the piece that goes on
            whole = cut < len(words) and steps[cut] == 1
            joined = np.concatenate(self.steps)
            last = np.flatnonzero(joined != 1)
            run = len(joined) - (last[-1] if len(last) else 0)
            lead = self.last[-min(self.keep, run):] if whole and self.keep else []
            yield self.row()
            self.clear(lead)
            at = cut
        self.put(words[at:], steps[at:])

    def put(self, words: list[bytes], steps: np.ndarray) -> None:
        if len(words):
            ids = self.ids
            self.numbers.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int32, count=len(words)))
            self.steps.append(steps.astype(np.int32))
            if self.keep:
                self.last = (self.last + words[-self.keep:])[-self.keep:]
            self.n += len(words)

    def row(self) -> tuple:
        numbers = np.concatenate(self.numbers)
        # the first position is 1 whatever came before
        steps = np.concatenate(self.steps)
        steps[0] = 1
        n = counts(len(self.ids), numbers, np.cumsum(steps, dtype=np.int64), self.lead)
        return [w.decode() for w in self.ids], n, self.lang, self.lead, numbers, steps


def blocks(docs: DataFrame, longest: int = LONGEST, size: int = BLOCK_WORDS) -> DataFrame:
    """The relation of all words: block, and ``WORDS``."""
    if size > 1 << PLACE_BITS - 1:
        raise ValueError(f"a block has at most {1 << PLACE_BITS - 1} words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, Block] = {}

        def held() -> int:
            return sum(b.n for b in open_.values())

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                words, steps = words_and_steps(text.as_buffer().to_pybytes())
                if not words:
                    continue
                block = open_.setdefault(lang, Block(lang, longest))
                for row in block.add(words, steps, size):
                    yield as_batch([row], WORDS_SCHEMA)
                if held() > 4 * size:  # many languages
                    for b in open_.values():
                        if b.n > b.lead:
                            yield as_batch([b.row()], WORDS_SCHEMA)
                    open_ = {}
        for b in open_.values():
            if b.n > b.lead:
                yield as_batch([b.row()], WORDS_SCHEMA)

    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    made = docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text")).mapInArrow(run, WORDS)
    # task and row, in fewer bits than the function leaves them
    task, row = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    numbered = made.withColumn("_id", F.monotonically_increasing_id())
    return written_blocks(numbered.withColumn("block", F.shiftleft(task, BLOCK_BITS) + row).drop("_id"), "words")


WORDS_SCHEMA = pa.schema([("items", pa.list_(pa.string())), ("n", pa.list_(pa.int32())), ("lang", pa.string()), ("lead", pa.int32()),
                          ("item", pa.list_(pa.int32())), ("step", pa.list_(pa.int32()))])
RELATION_SCHEMA = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("lead", pa.int32()), ("ids", pa.list_(pa.int64())),
                             ("item", pa.list_(pa.int32())), ("step", pa.list_(pa.int32()))])


def as_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def joined(item: np.ndarray, step: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge join of a block's occurrences with themselves at the next position.

    Returns the two parts of every distinct phrase, and the phrase and position of every occurrence.
    """
    position = np.cumsum(step.astype(np.int64))
    met = np.flatnonzero(position[1:] == position[:-1] + 1)
    code, number = np.unique(item[met].astype(np.int64) * n + item[met + 1], return_inverse=True)
    return code // max(n, 1), code % max(n, 1), number, position[met]


def kept(n: int, item: np.ndarray, position: np.ndarray, frequent: np.ndarray, ids: np.ndarray) -> tuple:
    """Semi-join of a block's occurrences of n items with the ``frequent`` of these: their ids, item, step."""
    number = np.full(n, -1)
    number[frequent] = np.arange(len(frequent))
    own = number[item]
    held = own >= 0
    return ids, own[held].astype(np.int32), np.diff(position[held], prepend=0).astype(np.int32)


def each_block(rows: DataFrame, kind: str, schema: pa.Schema, work) -> DataFrame:
    """``work`` on one block after the other: the columns as Python values, arrays as NumPy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                cells = [column[i] for column in batch.columns]
                made = work(*[c.values.to_numpy() if isinstance(c, pa.ListScalar) else c.as_py() for c in cells])
                if made is not None:
                    yield pa.RecordBatch.from_arrays(made, schema=schema)

    return rows.mapInArrow(run, kind)


def word_places(words: DataFrame) -> DataFrame:
    """(lang, items, place, n): the distinct words of every block."""
    listed = words.select("lang", "block", F.posexplode(F.arrays_zip("items", "n")).alias("at", "key"))
    return listed.select("lang", F.col("key.items").alias("items"), (F.shiftleft("block", PLACE_BITS) + F.col("at")).alias("place"),
                         F.col("key.n").cast("long").alias("n"))


def phrase_places(relation: DataFrame) -> DataFrame:
    """(lefts, rights, place, n): the distinct phrases, longer by one word, of every block."""
    schema = pa.schema([(c, pa.int64()) for c in ("lefts", "rights", "place", "n")])

    def work(block, lead, ids, item, step):
        left, right, number, position = joined(item, step, len(ids))
        # a phrase counts where its last word does: one position more than where it begins
        n = counts(len(left), number, position, max(lead - 1, 0))
        place = (block << PLACE_BITS) + np.arange(len(left))
        return [pa.array(c.astype(np.int64)) for c in (ids[left], ids[right], place, n)] if len(left) else None

    return each_block(relation.select("block", "lead", "ids", "item", "step"), "lefts long, rights long, place long, n long", schema, work)


def frequent_places(places: DataFrame, keys: Sequence[str], least: int) -> DataFrame:
    """The rows of ``places`` whose phrase occurs ``least`` times or more: (keys, place, id, n of the whole table)."""
    of_phrase = Window.partitionBy(*keys)
    summed = places.withColumns({"n": F.sum("n").over(of_phrase), "id": F.min("place").over(of_phrase)})
    return written_in_parts(summed.filter(F.col("n") >= least), "frequent")


def grown(source: DataFrame, found: DataFrame, first: bool) -> DataFrame:
    """The relation of the frequent phrases ``found``: of the words ``source``, or one word longer than those of ``source``."""
    at = F.col("place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")
    met = found.select(F.shiftright("place", PLACE_BITS).alias("block"), at.alias("at"), "id")
    size = F.size("n") if first else F.size("ids")
    rows = source.select("block", "lang", "lead", size.alias("size"), "item", "step")

    def work(own: pa.Table, met: pa.Table) -> pa.Table:
        if not own.num_rows or not met.num_rows:
            return RELATION_SCHEMA.empty_table()
        block, lang, lead, n = (own.column(c)[0].as_py() for c in ("block", "lang", "lead", "size"))
        item, step = (own.column(c)[0].values.to_numpy() for c in ("item", "step"))
        if first:
            position = np.cumsum(step.astype(np.int64))
        else:
            left, _, item, position = joined(item, step, n)
            n, lead = len(left), max(lead - 1, 0)
        row = (block, lang, lead, *kept(n, item, position, *(met.column(c).to_numpy() for c in ("at", "id"))))
        return pa.table([pa.array([c], f.type) for c, f in zip(row, RELATION_SCHEMA)], schema=RELATION_SCHEMA)

    # a block's places come as rows of their own: Spark holds no array of them
    return written_blocks(rows.groupBy("block").cogroup(met.groupBy("block")).applyInArrow(work, RELATION), "relation")


def frequent_phrases(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, size: int = BLOCK_WORDS
) -> tuple[DataFrame, list[DataFrame]]:
    """All words of every language (lang, n), and per length the frequent phrases.

    The first of these are words (lang, items, n, id), all others pairs of phrases of the length before
    (lefts, rights, n, id). Relations are deleted once the next is written.
    """
    source = blocks(docs, longest, size)
    whole = written_in_parts(source.groupBy("lang").agg(
        F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda s, x: s + x)).alias("n")), "totals")
    found, places, keys = [], word_places(source), ("lang", "items")
    for length in range(1, longest + 1):
        if length == longest and length > 1:  # nothing goes back to the blocks
            sums = places.groupBy(*keys).agg(F.sum("n").alias("n"), F.min("place").alias("id")).filter(F.col("n") >= least)
            found.append(written_in_parts(sums, "phrases"))
            break
        some = frequent_places(places, keys, least)
        found.append(written_in_parts(some.filter("place = id").select(*keys, "n", "id"), "phrases"))
        if length < longest:
            longer = grown(source, some, length == 1)
            removed(source)
            source, places, keys = longer, phrase_places(longer), ("lefts", "rights")
        removed(some)
    removed(source)
    return whole, found


def share(a: str, left: str, right: str):
    """floor(1000000 a a / (left right)) in whole numbers of 38 digits."""
    wide = "cast({} as decimal(19,0))".format
    return F.expr(f"(cast(1000000 as decimal(7,0)) * {wide(a)} * {wide(a)}) div ({wide(left)} * {wide(right)})")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, size: int = BLOCK_WORDS) -> DataFrame:
    """Every language's best phrases of two and three words: lang, rank, phrase, a, l, r, n, score.

    A phrase of which at least half the occurrences stand within one candidate a word longer is left out.
    """
    whole, (words, pairs, triples) = frequent_phrases(docs, 3, least, size)
    word = lambda at: small_side(words.select(
        F.col("id").alias(at), F.col("items").alias(f"{at}_text"), F.col("n").alias(f"{at}_n"), F.col("lang").alias(f"{at}_lang")))
    two = pairs.select("id", "n", F.col("lefts").alias("w1"), F.col("rights").alias("w2")).join(word("w1"), "w1").join(word("w2"), "w2")
    two = written_in_parts(two.select(
        F.col("w1_lang").alias("lang"), "id", F.concat_ws(" ", "w1_text", "w2_text").alias("phrase"), F.col("n").alias("a"), F.col("w1_n").alias("l"),
        F.col("w2_n").alias("r"), "w2_text"), "pairs")
    part = lambda at: small_side(two.select(
        F.col("id").alias(at), F.col("phrase").alias(f"{at}_text"), F.col("a").alias(f"{at}_n"), F.col("l").alias(f"{at}_first"),
        F.col("r").alias(f"{at}_last"), F.col("w2_text").alias(f"{at}_end"), F.col("lang").alias(f"{at}_lang")))
    three = written_in_parts(triples.withColumnRenamed("n", "a").join(part("lefts"), "lefts").join(part("rights"), "rights"), "triples")
    inside = three.select("a", F.explode(F.array("lefts", "rights")).alias("id")).groupBy("id").agg(F.max("a").alias("most"))
    # 100 * most >= 50 * a
    alone = two.join(inside, "id", "left").filter(F.coalesce(2 * F.col("most") < F.col("a"), F.lit(True)))
    cuts = F.array(*[
        F.struct(share("a", l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))
        for k, (l, r) in enumerate((("lefts_first", "rights_n"), ("lefts_n", "rights_last")))
    ])
    least_cut = F.array_min(cuts)
    phrases = alone.select("lang", "phrase", "a", "l", "r", share("a", "l", "r").alias("score")).unionByName(
        three.select(F.col("lefts_lang").alias("lang"), F.concat_ws(" ", "lefts_text", "rights_end").alias("phrase"), "a", least_cut.alias("c")).select(
            "lang", "phrase", "a", "c.l", "c.r", "c.score"))
    phrases = written_in_parts(phrases, "candidates")
    # the best of every share of a language's phrases first, then of these
    parts = -(-phrases.count() // CANDIDATES_PER_TASK) or 1
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salted = phrases.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(small_side(whole), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
