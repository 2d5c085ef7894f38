"""Quality rules by the perplexity of an n-gram model over the corpus itself.

The model is one of characters within words, with modified Kneser-Ney smoothing, one per language. What it
counts grows with the corpus: Spark gathers the words of all texts and how often each occurs in the running text, then
for every n-gram how often it occurs; of copies of a text, one counts. An n-gram is known if it occurs in two different texts, so
that no document, however often it is copied, vouches for itself; for that, words and
n-grams carry the least and the greatest hash of the texts that hold them.

Adjusted counts, discounts, context sums and interpolated probabilities are joins and sums over the tables of n-grams.
The finished model is a table of sorted arrays: hashes of n-grams with their log-probabilities,
hashes of contexts with their back-off weights, cut into buckets by the first bits of the hash.

Documents are scored where they lie if the model is counted to be small enough for every
executor (``BROADCAST_ENTRIES``). Otherwise documents are dealt into slices; each slice asks the buckets once for the entries of
its distinct n-grams and scores its documents from what comes back. Both give the same scores.

The score is the mean negative log-probability of a character. Per language, half the different texts lie within
the median deviation of the median; texts farther than ``WIDTH`` such deviations on either side are rejected.

A null language is ``und``. Null and empty texts have no words and no score. Repeated rows are scored each, and
count once in the bands. Languages of fewer than ``LEAST_TEXTS`` different texts have no bands.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import _parse_datatype_string

from cyclemill.llm.common import fresh, slices, written_tidily
from cyclemill.llm.words import byte_class, mix
from cyclemill.sizing import small_side

ORDER = 5
BROADCAST_ENTRIES = 1 << 22
BUCKET_ENTRIES = 1 << 15
SLICE_TEXT = 1 << 24
WORDS_HELD = 1 << 19
LETTERS_HELD = 1 << 21
BINS = 100  # of a unit of log-probability
WIDTH = 8.0
LEAST_DEVIATION = 0.025
LEAST_TEXTS = 100
UNKNOWN = "und"
EDGE = " "
SYMBOLS = b"#*$%&|<>"
BASE = np.uint64(0x9E3779B97F4A7C15)
CONTEXT = np.uint64(0xD1B54A32D192ED03)
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, text_hash long, score double"


# ------------------------------------------------ plain counts of one text


PLAIN, SYMBOL, HEAD = byte_class("plain"), np.isin(np.arange(256), list(SYMBOLS)), (np.arange(256) & 0xC0) != 0x80


def text_counts(raw: bytes, words: np.ndarray) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, lines equal to an earlier one, words in repeated windows of three."""
    each = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    lines = [line for line in raw.split(b"\n") if line.split()]
    return (len(words), int(each[PLAIN & HEAD].sum()), int(each[SYMBOL].sum()), len(lines) - len(set(lines)), repeated(words))


def repeated(words: np.ndarray) -> int:
    """How many words stand in a window of three that occurs again; ``words`` are small numbers."""
    if len(words) < 4:
        return 0
    _, pair = np.unique(words[:-1] * (words.max() + 1) + words[1:], return_inverse=True)
    _, window, n = np.unique(pair[:-1] * (words.max() + 1) + words[2:], return_inverse=True, return_counts=True)
    again = n[window] > 1
    inside = np.zeros(len(words), dtype=bool)
    for k in range(3):
        inside[k:len(again) + k] |= again
    return int(inside.sum())


# ------------------------------------------------ n-grams of words


def letters(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, each with an edge on both sides; place within the word; tokens per word."""
    code = np.frombuffer("".join(EDGE + w + EDGE for w in words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    starts = np.cumsum(sizes) - sizes
    return code, np.arange(len(code)) - np.repeat(starts, sizes), sizes - 1


def hashes(code: np.ndarray, order: int) -> list[np.ndarray]:
    """For every length up to ``order`` the hash of the code points that end at each place."""
    with np.errstate(over="ignore"):
        own = mix((code + np.uint64(1)) * BASE)
        made, total = [np.zeros(len(code), dtype=np.uint64)], np.zeros(len(code), dtype=np.uint64)
        power = np.uint64(1)
        for k in range(order):
            total = total.copy()
            total[k:] += own[:len(own) - k] * power if k else own
            power = power * BASE
            made.append(mix(total + np.uint64(k + 1) * CONTEXT))
    return made


def language_salt(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode(), 7))


def keyed(h: np.ndarray, salt: np.uint64, context: bool) -> np.ndarray:
    """Key of an n-gram, or of a context, in the model."""
    with np.errstate(over="ignore"):
        return mix((h ^ salt) * BASE + (CONTEXT if context else np.uint64(0))).view(np.int64)


Lookup = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


def asked_keys(words: list[str], lang: str, order: int) -> np.ndarray:
    """Keys of all n-grams and contexts that scoring the words may look for."""
    code, place, _ = letters(words)
    h, salt = hashes(code, order), language_salt(lang)
    keys = [keyed(h[k][place >= max(k - 1, 1)], salt, False) for k in range(1, order + 1)]
    keys += [keyed(h[k][place >= k - 1], salt, True) for k in range(order)]
    return np.unique(np.concatenate([*keys, keyed(np.zeros(1, np.uint64), salt, False)]))


def word_scores(words: list[str], lang: str, order: int, lookup: Lookup) -> tuple[np.ndarray, np.ndarray]:
    """Log-probability of every word, its end included, and its number of tokens."""
    if not words:
        return np.zeros(0), np.zeros(0, dtype=np.int64)
    code, place, tokens = letters(words)
    h, salt = hashes(code, order), language_salt(lang)
    at = np.flatnonzero(place > 0)
    total, open_ = np.zeros(len(at)), np.ones(len(at), dtype=bool)
    for k in range(order, 0, -1):
        # the longest n-gram that is known; the weights of the contexts passed on the way
        own = np.flatnonzero(open_ & (place[at] >= k - 1))
        value, known = lookup(keyed(h[k][at[own]], salt, False))
        total[own[known]] += value[known]
        open_[own[known]] = False
        rest = own[~known]
        weight, known = lookup(keyed(h[k - 1][at[rest] - 1] if k > 1 else np.zeros(len(rest), np.uint64), salt, True))
        total[rest[known]] += weight[known]
    none, known = lookup(keyed(np.zeros(1, np.uint64), salt, False))
    total[open_] += none[0] if known[0] else -np.log(1 << 21)
    return np.add.reduceat(total, np.cumsum(tokens) - tokens), tokens


def sorted_lookup(keys: np.ndarray, values: np.ndarray) -> Lookup:
    def lookup(asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(asked)), np.zeros(len(asked), dtype=bool)
        # equal n-grams lie together, which keeps the search in the cache
        one, back = np.unique(asked, return_inverse=True)
        at = np.minimum(np.searchsorted(keys, one), len(keys) - 1)
        return values[at][back].astype(float), (keys[at] == one)[back]

    return lookup


# ------------------------------------------------ what Spark counts


def lang_of(docs: DataFrame) -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)) if "lang" in docs.columns else F.lit(UNKNOWN)


LEAST, MOST = -(1 << 63), (1 << 63) - 1


def text_hash(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw, 11) - (1 << 63)


def with_copies(texts: DataFrame) -> DataFrame:
    """The rows of (lang, text) that have a text, with ``copies``: how many of the rows are equal to it."""
    marked = texts.filter(F.col("text").isNotNull()).withColumn("mark", F.xxhash64("lang", "text"))
    several = written_tidily(marked.groupBy("mark").agg(F.count("*").alias("copies")).filter("copies > 1"), "copies")
    return marked.join(small_side(several), "mark", "left").select("lang", "text", F.coalesce("copies", F.lit(1).cast("long")).alias("copies"))


def vocabulary(docs: DataFrame, running: bool = False) -> DataFrame:
    """(lang, word, n, lo, hi): every word, with two bounds that are equal only if one text alone holds it.

    Of one text they are its hash; of several texts of a task the outermost numbers stand for them. ``n`` is 1; if ``running``, it is
    how often the word occurs in the running text of all different texts. A word then has as many rows as there are numbers of
    copies among its texts: all copies are read, and what those with as many copies add up to is divided by that number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # per language and number of copies: the first text of every word, the words of two texts or more, the texts read, occurrences
        held: dict[tuple, tuple[dict, set, set, Counter]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, copies), (first, several, _, n) in held.items():
                marks = [(LEAST, MOST) if w in several else (mark, mark) for w, mark in first.items()]
                lo, hi = zip(*marks)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(first), pa.string()), "copies": pa.array([copies] * len(first), pa.int64()),
                    "word": pa.array(map(bytes.decode, first), pa.string()), "n": pa.array([n[w] for w in first], pa.int64()),
                    "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64())})

        for batch in batches:
            for lang, copies, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1)):
                raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                words = raw.split()
                if not words:
                    continue
                first, several, texts, n = held.setdefault((lang, copies), ({}, set(), set(), Counter()))
                if running:
                    n.update(words)
                mark = text_hash(raw)
                if mark in texts:
                    continue
                texts.add(mark)
                own = set(words)
                again = own & first.keys()
                several |= again
                first.update(dict.fromkeys(own - again, mark))
                if sum(len(x[0]) for x in held.values()) > WORDS_HELD:
                    yield from rows()
                    held.clear()
        yield from rows()

    texts = docs.select(lang_of(docs).alias("lang"), F.col("text").cast("string").alias("text"))
    texts = with_copies(texts) if running else texts.withColumn("copies", F.lit(1).cast("long"))
    found = texts.mapInArrow(run, "lang string, copies long, word string, n long, lo long, hi long")
    bounds = F.min("lo").alias("lo"), F.max("hi").alias("hi")
    if not running:
        return found.groupBy("lang", "word").agg(F.lit(1).cast("long").alias("n"), *bounds)
    return found.groupBy("lang", "word", "copies").agg(F.sum("n").alias("n"), *bounds).select(
        "lang", "word", F.expr("n div copies").alias("n"), "lo", "hi")


def gram_counts(words: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): the known n-grams, as often as they occur in all words, each taken ``n`` times.

    Every letter of a word, and its end, counts with the letters before it: ``order`` in all, or fewer from the word's beginning.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, own in held.items():
                words, times, lo, hi = zip(*own)
                joined = "".join(EDGE + w + EDGE for w in words)
                code, place, tokens = letters(list(words))
                h, at = hashes(code, order), np.flatnonzero(place > 0)
                size = np.minimum(place[at] + 1, order)
                key = np.choose(size - 2, [h[k][at] for k in range(2, order + 1)])
                one, first, back = np.unique(key, return_index=True, return_inverse=True)
                n = np.zeros(len(one), dtype=np.int64)
                np.add.at(n, back, np.repeat(np.array(times, dtype=np.int64), tokens))
                low, high = np.full(len(one), np.iinfo(np.int64).max), np.full(len(one), np.iinfo(np.int64).min)
                np.minimum.at(low, back, np.repeat(np.array(lo, dtype=np.int64), tokens))
                np.maximum.at(high, back, np.repeat(np.array(hi, dtype=np.int64), tokens))
                ends, sizes = at[first] + 1, size[first]
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * len(one), pa.string()),
                    "gram": pa.array([joined[e - s:e] for e, s in zip(ends.tolist(), sizes.tolist())], pa.string()),
                    "n": pa.array(n, pa.int64()), "lo": pa.array(low), "hi": pa.array(high)})

        size = 0
        for batch in batches:
            for lang, word, *rest in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(lang, []).append((word, *rest))
                size += len(word) + 2
                if size > LETTERS_HELD:
                    yield from rows()
                    held.clear()
                    size = 0
        yield from rows()

    found = words.mapInArrow(run, "lang string, gram string, n long, lo long, hi long")
    sums = found.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return sums.filter("lo < hi").select("lang", "gram", "n")


# ------------------------------------------------ modified Kneser-Ney


def adjusted_counts(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, k, gram, n): of full length or from a word's beginning as counted, else the number of different letters before."""
    counts = written_tidily(counts.withColumn("k", F.length("gram")), "counts")
    above = counts.filter(F.col("k") == order).select("lang", "k", "gram", "n")
    made = [above]
    for k in range(order - 1, 0, -1):
        inner = above.groupBy("lang", F.substring("gram", 2, order).alias("gram")).agg(F.count("*").alias("n")).select(
            "lang", F.lit(k).alias("k"), "gram", "n")
        above = written_tidily(inner.unionByName(counts.filter(F.col("k") == k).select("lang", "k", "gram", "n")), "adjusted")
        made.append(above)
    whole = made[0]
    for part in made[1:]:
        whole = whole.unionByName(part)
    return whole


def discounts(adjusted: DataFrame) -> DataFrame:
    """(lang, k, d1, d2, d3) from the numbers of n-grams that count one to four; plain values where these do not define them."""
    n = [F.sum((F.col("n") == i).cast("long")).alias(f"n{i}") for i in range(1, 5)]
    made = adjusted.groupBy("lang", "k").agg(*n)
    for i in (1, 2, 3):
        value = F.expr(f"{i} - {i + 1} * double(n1) * n{i + 1} / nullif(double(n1 + 2 * n2) * n{i}, 0)")
        fine = (F.col(f"n{i}") > 0) & (F.col(f"n{i + 1}") > 0) & (value > 0) & (value < i)
        made = made.withColumn(f"d{i}", F.when(fine, value).otherwise(F.lit(i / 2)))
    return made.select("lang", "k", "d1", "d2", "d3")


def probabilities(adjusted: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, context, value): log-probability of every n-gram, and log weight of every context (``context`` true).

    The empty n-gram stands for a letter never seen.
    """
    adjusted = written_tidily(adjusted, "adjusted")
    cut = adjusted.join(small_side(discounts(adjusted)), ["lang", "k"]).withColumns({
        "ctx": F.expr("substring(gram, 1, k - 1)"),
        "d": F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))})
    cut = written_tidily(cut.select("lang", "k", "gram", "ctx", "n", "d"), "cut")
    contexts = written_tidily(cut.groupBy("lang", "k", "ctx").agg((F.sum("d") / F.sum("n")).alias("weight"), F.sum("n").alias("whole")), "contexts")
    # the seen letters of a language, and one for all others
    uniform = adjusted.filter("k = 1").groupBy("lang").agg((1 / (F.count("*") + 1)).alias("p"))
    below = uniform.select("lang", F.lit("").alias("gram"), "p")
    parts = []
    for k in range(1, order + 1):
        own = cut.filter(F.col("k") == k).join(contexts.filter(F.col("k") == k).drop("k"), ["lang", "ctx"])
        lower = (small_side(below) if k == 1 else below).withColumnsRenamed({"gram": "suffix", "p": "lower"})
        own = own.withColumn("suffix", F.substring("gram", 2, order)).join(lower, ["lang", "suffix"])
        below = written_tidily(own.select("lang", "gram", ((F.col("n") - F.col("d")) / F.col("whole") + F.col("weight") * F.col("lower")).alias("p")),
                        "probabilities")
        parts.append(below)
    made = uniform.select("lang", F.lit("").alias("gram"), "p")
    for part in parts:
        made = made.unionByName(part)
    return made.select("lang", "gram", F.lit(False).alias("context"), F.log("p").alias("value")).unionByName(
        contexts.select("lang", F.col("ctx").alias("gram"), F.lit(True).alias("context"), F.log("weight").alias("value")))


def entry_keys(entries: pa.RecordBatch) -> np.ndarray:
    """The keys under which scoring looks for n-grams and contexts."""
    langs, grams = entries.column(0).to_pylist(), entries.column(1).to_pylist()
    context = entries.column(2).to_numpy(zero_copy_only=False)
    sizes = np.fromiter(map(len, grams), dtype=np.int64, count=len(grams))
    code = np.frombuffer("".join(grams).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    h, ends = hashes(code, int(sizes.max(initial=0))), np.cumsum(sizes)
    own = np.zeros(len(grams), dtype=np.uint64)
    for k in range(1, len(h)):
        mine = sizes == k
        own[mine] = h[k][ends[mine] - 1]
    salts = {lang: language_salt(lang) for lang in set(langs)}
    salt = np.fromiter((salts[lang] for lang in langs), dtype=np.uint64, count=len(langs))
    return np.where(context, keyed(own, salt, True), keyed(own, salt, False))


class Model:
    """A table (bucket, keys, values) of sorted arrays; a bucket is the keys with the same first ``bits`` bits."""

    def __init__(self, table: DataFrame, bits: int, entries: int, order: int):
        self.table, self.bits, self.entries, self.order = table, bits, entries, order

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        held = self.table.orderBy("bucket").toArrow()
        keys, values = (held[c].combine_chunks().flatten().to_numpy() for c in ("keys", "values"))
        order = np.argsort(keys, kind="stable")
        return keys[order], values[order]


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> (64 - bits) if bits else np.zeros_like(keys)


def train(docs: DataFrame, order: int = ORDER, bucket_entries: int = BUCKET_ENTRIES, running: bool = False) -> Model:
    """The model of all documents: (text, and lang if there is one).

    An n-gram counts once for every different word that holds it; if ``running``, as often as it occurs in the different texts.
    """
    entries = written_tidily(probabilities(adjusted_counts(gram_counts(vocabulary(docs, running), order), order), order), "entries")
    n = entries.count()
    bits = max(0, (n // bucket_entries).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = entry_keys(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket_of(keys, bits)), pa.array(keys), batch.column(3).cast(pa.float32())], ["bucket", "key", "value"])

    pairs = entries.mapInArrow(run, "bucket long, key long, value float").groupBy("bucket").agg(
        F.array_sort(F.collect_list(F.struct("key", "value"))).alias("pairs"))
    stored = written_tidily(pairs.select("bucket", F.col("pairs.key").alias("keys"), F.col("pairs.value").alias("values")), "model")
    return Model(stored, bits, n, order)


# ------------------------------------------------ scoring


class Judge:
    """``STATS`` of texts. Words are scored once, until ``WORDS_HELD`` are held; then it starts anew."""

    def __init__(self, order: int, lookup: Lookup):
        self.order, self.lookup = order, lookup
        self.held: dict[str, tuple[dict, np.ndarray, np.ndarray]] = {}

    def __call__(self, texts: list[bytes], langs: list[str]) -> list[tuple]:
        made: list[tuple | None] = [None] * len(texts)
        if sum(len(x[0]) for x in self.held.values()) > WORDS_HELD:
            self.held = {}
        for lang in set(langs):
            ids, value, tokens = self.held.get(lang, ({}, np.zeros(0), np.zeros(0, dtype=np.int64)))
            mine = [i for i, own in enumerate(langs) if own == lang]
            numbered = [np.array([ids.setdefault(w, len(ids)) for w in texts[i].split()], dtype=np.int64) for i in mine]
            fresh_words = [w.decode() for w in itertools.islice(ids, len(value), None)]
            more, n = word_scores(fresh_words, lang, self.order, self.lookup)
            value, tokens = np.concatenate((value, more)), np.concatenate((tokens, n))
            self.held[lang] = ids, value, tokens
            for i, own in zip(mine, numbered):
                # small numbers again, so that three of them fit a window's code
                local = np.unique(own, return_inverse=True)[1]
                score = -value[own].sum() / tokens[own].sum() if len(own) else None
                made[i] = (*text_counts(texts[i], local), text_hash(texts[i]), score)
        return made


def judged_batch(batch: pa.Table | pa.RecordBatch, judge: Judge) -> pa.Array:
    """The struct ``STATS`` of the rows of (lang, text) in the first two columns."""
    langs, rows = batch.column(0).to_pylist(), []
    texts = batch.column(1)
    for at, held in slices(texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts):
        rows += judge(held, langs[at:at + len(held)])
    kinds = [pa.int64()] * 6 + [pa.float64()]
    names = [c.split()[0] for c in STATS.split(", ")]
    columns = zip(*rows) if rows else [[]] * 7
    return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def scored(docs: DataFrame, model: Model, most: int = BROADCAST_ENTRIES, slice_text: int = SLICE_TEXT) -> DataFrame:
    """The columns of ``docs`` but for the text, and the struct column ``stats`` last, under a name of its own."""
    order, stats, lang, text, part = model.order, fresh("stats"), fresh("lang"), fresh("text"), fresh("part")
    carried = [c for c in docs.columns if c != "text"]
    rows = docs.select(lang_of(docs).alias(lang), F.col("text").cast("string").alias(text), F.struct(*carried).alias(part))
    schema = T.StructType([rows.schema[part], T.StructField(stats, _parse_datatype_string(STATS))])
    if model.entries <= most:
        held = docs.sparkSession.sparkContext.broadcast(model.whole())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            judge = Judge(order, sorted_lookup(*held.value))
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(2), judged_batch(batch, judge)], [part, stats])

        made = rows.mapInArrow(run, schema)
    else:
        made = by_slices(rows, lang, text, part, stats, schema, model, slice_text)
    return made.select(f"{part}.*", stats)


def by_slices(rows, lang, text, part, stats, schema, model: Model, slice_text: int) -> DataFrame:
    order, bits = model.order, model.bits
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    number = F.pmod(F.xxhash64(*rows.columns), F.lit(size // slice_text + 1))
    dealt = rows.withColumn("slice", number)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[tuple, set] = {}
            for own, at, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1)):
                groups.setdefault((at, own), set()).update(raw.as_buffer().to_pybytes().split() if raw.is_valid else ())
            for (at, own), words in groups.items():
                keys = asked_keys([w.decode() for w in words], own, order)
                bucket = bucket_of(keys, bits)
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                for one in np.split(keys, cuts):
                    yield pa.RecordBatch.from_pydict({
                        "slice": pa.array([at], pa.int64()), "bucket": pa.array([int(bucket_of(one[:1], bits)[0])], pa.int64()),
                        "asked": pa.array([one], pa.list_(pa.int64()))})

    asked = dealt.select(lang, text, "slice").mapInArrow(ask, "slice long, bucket long, asked array<long>")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked_, keys, values = (batch.column(c)[i].values.to_numpy() for c in (1, 2, 3))
                value, known = sorted_lookup(keys, values)(asked_)
                yield pa.RecordBatch.from_pydict({
                    "slice": batch.column(0).slice(i, 1), "keys": pa.array([asked_[known]], pa.list_(pa.int64())),
                    "values": pa.array([value[known]], pa.list_(pa.float32()))})

    answered = asked.join(model.table, "bucket").select("slice", "asked", "keys", "values").mapInArrow(
        answer, "slice long, keys array<long>, values array<float>")

    def judge(own: pa.Table, met: pa.Table) -> pa.Table:
        keys, values = (met[c].combine_chunks().flatten().to_numpy() for c in ("keys", "values"))
        keys, first = np.unique(keys, return_index=True)
        found = judged_batch(own, Judge(order, sorted_lookup(keys, values[first])))
        return pa.table([own.column(part), found], [part, stats])

    return dealt.groupBy("slice").cogroup(answered.groupBy("slice")).applyInArrow(judge, schema)


# ------------------------------------------------ bands


def bands(scores: DataFrame, width: float = WIDTH, least_deviation: float = LEAST_DEVIATION, least_texts: int = LEAST_TEXTS) -> DataFrame:
    """(lang, lower, upper) of (lang, text_hash, score): the median score of different texts, and ``width`` deviations on either side.

    Scores are counted in bins of a hundredth, so a language's bins are few whatever its size.
    """
    one = scores.filter("score IS NOT NULL").groupBy("lang", "text_hash").agg(F.first("score").alias("score"))
    bins = one.groupBy("lang", F.round(F.col("score") * BINS).cast("long").alias("bin")).agg(F.count("*").alias("n"))
    bins = written_tidily(bins, "bins")

    def middle(counts: DataFrame, value: str) -> DataFrame:
        so_far = Window.partitionBy("lang").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
        below, whole = F.sum("n").over(so_far), F.sum("n").over(Window.partitionBy("lang"))
        return counts.withColumns({"below": below, "whole": whole}).filter(F.col("below") * 2 >= F.col("whole")).groupBy("lang").agg(
            F.min(value).alias(f"middle_{value}"), F.max("whole").alias("whole"))

    centre = middle(bins, "bin")
    off = bins.join(small_side(centre.drop("whole")), "lang").groupBy("lang", F.abs(F.col("bin") - F.col("middle_bin")).alias("off")).agg(
        F.sum("n").alias("n"))
    spread = centre.join(middle(off, "off").drop("whole"), "lang").filter(F.col("whole") >= least_texts)
    reach = F.greatest(F.col("middle_off") / BINS, F.lit(least_deviation)) * width
    return spread.select("lang", (F.col("middle_bin") / BINS - reach).alias("lower"), (F.col("middle_bin") / BINS + reach).alias("upper"))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def quality(docs: DataFrame, order: int = ORDER, most: int = BROADCAST_ENTRIES, width: float = WIDTH) -> DataFrame:
    """The columns of ``docs`` without the text, then the struct ``verdict``: ``STATS``, base_failed, lower, upper and kept.

    The struct comes last under a name of its own. The bands are those of the texts that pass the base rules.
    The model counts the running text.
    """
    model = train(docs, order, running=True)
    found = written_tidily(scored(docs, model, most), "scored")
    c, lang = found.columns[-1], fresh("lang")
    failed = base_failed(F.col(c)["n_words"], F.col(c)["n_repeat_words"])
    rows = found.withColumn(lang, lang_of(found))
    passed = rows.filter(~failed).select(F.col(lang).alias("lang"), f"{c}.text_hash", f"{c}.score")
    sides = small_side(bands(passed, width).withColumnsRenamed({"lang": lang, "lower": f"{c}_lower", "upper": f"{c}_upper"}))
    inside = F.coalesce(F.col(c)["score"].between(F.col(f"{c}_lower"), F.col(f"{c}_upper")), F.lit(True))
    verdict = F.struct(
        f"{c}.*", failed.alias("base_failed"), F.col(f"{c}_lower").alias("lower"), F.col(f"{c}_upper").alias("upper"),
        (~failed & inside).alias("kept"))
    return rows.join(sides, lang, "left").select(*found.columns[:-1], verdict.alias(fresh("verdict")))
