"""Personal data: fixed formats, and the terms of a corpus that give protected entities away.

DataFrame functions only. Spans of the fixed formats come from splitting a text at a
pattern: the lengths of the pieces and of the matches add up to the places. Every
match with its kind is a protected entity. All words of its documents that stand outside
of such matches are its context. Over the whole corpus, a term's disclosure of an entity is its pointwise mutual information
with it, as a share of the entity's own information:

    log(N * n(term, entity) / (n(term) * n(entity)))  /  log(N / n(entity))

with n the number of documents. A term of 1 tells as much as the entity itself. Terms
at the threshold or above are, wherever they stand in documents with their entity,
generalised (numbers and names, to a marker) or removed.

Texts that are equal to the letter are one document: copies are no evidence, and are read once. Entities that
stand in the same documents have the same counts with every term, and so do terms: pairs are made of such classes, known by
their number of documents and the sum of the documents' hashes, and the pairs of one document are dealt out to as many
groups as they need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cyclemill.llm.common import fresh, removed, written_tidily
from cyclemill.sizing import small_side

KINDS = ("email", "ip", "card", "phone", "term")
# The formats, with possessive repeats so that a failing run of characters is read once. A match
# starts where such a run starts, or where the match before it ended.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# what a text must contain before it is split by the pattern
HINTS = {
    "email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9]",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
LEAST_DOCUMENTS = 2  # what stands in fewer documents tells nothing about the corpus
THRESHOLD = 0.8
RUN = 128  # lengths that are added up one by one
PAIRS = 1 << 20  # of the classes of one document, in one group
COMMON = 1000


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def before(values: Column, levels: int = 2, combine=lambda s, x: s + x) -> Column:
    """For each value what all values before it come to: their sum, or else their maximum; 0 before the first.

    Runs are summed up first, and runs of these, so the work is a constant for each value.
    """
    zero = F.lit(0).cast("long")
    whole = lambda part: F.aggregate(part, zero, combine)
    if not levels:
        return F.transform(values, lambda _, i: whole(F.slice(values, F.lit(1), i)))
    runs = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / RUN).cast("int"))
    run = lambda r: F.slice(values, r * RUN + 1, F.lit(RUN))
    made = let(F.transform(runs, lambda r: whole(run(r))), lambda own: let(
        before(own, levels - 1, combine), lambda earlier: F.flatten(F.transform(runs, lambda r: let(run(r), lambda part: F.transform(
            part, lambda _, i: combine(F.get(earlier, r), whole(F.slice(part, F.lit(1), i)))))))))
    return F.when(F.size(values) > 0, made).otherwise(F.array().cast("array<bigint>"))


def matches(text: Column, pattern: Column) -> Column:
    """Matches of a pattern as array of struct: start, end (code points, end exclusive), value."""

    def placed(values: Column, pieces: Column) -> Column:
        # every piece but the last is followed by a match
        spaces = F.transform(F.slice(pieces, F.lit(1), F.size(values)), lambda p: F.length(p).cast("long"))
        sizes = F.transform(values, lambda v: F.length(v).cast("long"))
        return let(spaces, lambda gaps: let(sizes, lambda own: let(
            F.zip_with(gaps, own, lambda g, n: g + n), lambda both: F.zip_with(
                F.zip_with(before(both), gaps, lambda s, g: s + g), F.arrays_zip(own.alias("n"), values.alias("value")),
                lambda at, m: F.struct(at.alias("start"), (at + m["n"]).alias("end"), m["value"].alias("value"))))))

    return let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda values: let(
        F.split(text, pattern, -1), lambda pieces: placed(values, pieces)))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether every second digit from the right, doubled with its digits added, makes a sum divisible by ten."""
    n = F.length(number)

    def add(total, i):
        d = F.substring(number, n - i, F.lit(1)).cast("int") * (F.lit(1) + i % 2)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(f"^{OCTET}(?:\\.{OCTET}){{3}}$")
    if kind == "card":
        fits = F.length(digits(value)).between(14, 19)
        return F.when(fits, luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    return F.lit(True)


SPAN = "start:bigint,rank:int,end:bigint,kind:string"


def of_kind(text: Column, rank: int, kind: str) -> Column:
    """Spans of one format."""
    found = F.filter(matches(text, F.lit(PATTERNS[kind])), lambda m: valid(kind, m["value"]))
    spans = F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"),
        m["value"].alias("value"),
    ))
    hint = text.contains(HINTS[kind]) if kind == "email" else text.rlike(HINTS[kind])
    return F.when(hint, spans).otherwise(F.array().cast(f"array<struct<{SPAN},value:string>>"))


def entities(text: Column) -> Column:
    """Spans of the fixed formats with kind and value, sorted by start and kind; null texts have none."""
    return F.array_sort(F.concat(*[of_kind(text, rank, kind) for rank, kind in enumerate(PATTERNS)]))


WORDS = r"[^\p{L}\p{N}]+"


def without(text: Column, kind: str) -> Column:
    """The text with a space for every match of one format."""
    pattern = F.lit(PATTERNS[kind])

    def joined(values: Column, pieces: Column) -> Column:
        rest = F.transform(values, lambda v: F.when(valid(kind, v), F.lit(" ")).otherwise(v))
        return F.array_join(F.zip_with(pieces, rest, lambda p, v: F.concat(p, F.coalesce(v, F.lit("")))), "")

    hint = text.contains(HINTS[kind]) if kind == "email" else text.rlike(HINTS[kind])
    cut = let(F.regexp_extract_all(text, pattern, F.lit(0)), lambda values: joined(values, F.split(text, pattern, -1)))
    return F.when(hint, cut).otherwise(text)


def outside(text: Column) -> Column:
    """The text without its formats, which are taken out one after the other."""
    nested = lambda own, kinds: let(without(own, kinds[0]), lambda rest: nested(rest, kinds[1:])) if kinds else own
    return let(text, lambda own: nested(own, list(PATTERNS)))


def classes(pairs: DataFrame, *names: str) -> DataFrame:
    """Add ``class`` and ``n`` to (key, names): what stands in the same documents is of one class, n of them."""
    by = pairs.groupBy(*names).agg(F.count("*").alias("n"), F.sum(F.xxhash64("key").cast("decimal(38,0)")).alias("_sum"),
                                   F.sum(F.xxhash64("key", F.lit(1)).cast("decimal(38,0)")).alias("_other"))
    return by.select(*names, "n", F.struct("n", "_sum", "_other").alias("class"))


def long_words(text: Column) -> Column:
    """The different words of three letters or more, in small letters."""
    return F.filter(F.array_distinct(F.split(F.lower(text), WORDS)), lambda w: F.length(w) >= 3)


def disclosures(texts: DataFrame, shared: DataFrame, held: DataFrame, threshold: float) -> DataFrame:
    """key and term: the terms that give an entity of a document away, by counts over all documents.

    ``texts`` are all different texts (key, text), ``shared`` those with an entity that stands in another, too, and ``held`` these
    entities by class. As a pair stands in no more documents than its entity, a term in too many of them cannot
    reach the threshold with it: such pairs are not made.
    """
    total = texts.count()
    n = F.lit(float(max(total, 1)))
    held = held.filter(F.col("n_entity") < total)
    most = held.agg(F.max("n_entity")).first()[0] or 0
    rare = lambda n_entity: F.log(n / F.col("n_term")) >= threshold * F.log(n / n_entity) - 1e-9
    term = written_tidily(texts.select(F.explode(long_words(F.col("text"))).alias("term")).groupBy("term").agg(
        F.count("*").alias("n_term")).filter(F.col("n_term") >= LEAST_DOCUMENTS), "terms")
    some = term.filter(rare(F.lit(float(max(most, 1)))))
    # words that stand nearly everywhere leave before anything is shuffled by word
    common = term.filter((F.col("n_term") > max(COMMON, total // 100)) & ~rare(F.lit(float(max(most, 1))))).select("term")
    rows = shared.select("key", F.explode(long_words(outside(F.col("text")))).alias("term")).join(small_side(common), "term", "left_anti")
    near = written_tidily(rows.join(some.select("term"), "term"), "near")
    term_class = classes(near, "term").select("term", F.col("class").alias("words"), F.col("n").alias("n_here")).join(some, "term")
    told = written_tidily(near.join(term_class, "term").filter(F.col("n_here") >= LEAST_DOCUMENTS), "told")
    met = told.select("key", "words", "n_term").distinct()
    # the pairs of a document: its classes of terms are dealt out, its classes of entities go to each of the groups
    wide = met.groupBy("key").agg(F.count("*").alias("a")).join(held.groupBy("key").agg(F.count("*").alias("b")), "key").select(
        "key", F.ceil(F.col("a") * F.col("b") / PAIRS).alias("groups"))
    left = met.join(wide, "key").withColumn("group", F.pmod(F.xxhash64("words"), F.col("groups")))
    right = held.join(wide, "key").withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))).drop("groups")
    pairs = left.drop("groups").join(right, ["key", "group"]).filter(rare(F.col("n_entity")))
    known = pairs.groupBy("words", "n_term", "entity", "n_entity").agg(F.count("*").alias("n_pair")).filter(
        F.col("n_pair") >= LEAST_DOCUMENTS)
    mutual = F.log(n * F.col("n_pair") / (F.col("n_term") * F.col("n_entity")))
    telling = written_tidily(known.filter(mutual >= threshold * F.log(n / F.col("n_entity"))).select("words", "n_term", "entity"), "telling")
    marked = left.drop("groups").join(right, ["key", "group"]).join(telling, ["words", "n_term", "entity"]).select("key", "words", "n_term").distinct()
    return told.join(marked, ["key", "words", "n_term"]).select("key", "term")


def text_key(text: Column) -> Column:
    """What equal texts share; a null text is empty."""
    return F.md5(F.coalesce(text, F.lit("")))


def telling_terms(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, terms): the spans of terms that give an entity away, of every different text that has any, by its ``text_key``.

    Spans have start, rank, end, kind and marker, the text that takes their place; a term that overlaps a fixed
    format is left out.
    """
    keyed = docs.select(text_key(F.col("text")).alias("key"), "text")
    occurrences = written_tidily(keyed.select("key", F.explode(entities(F.col("text"))).alias("s")).select(
        "key", "s.kind", F.lower("s.value").alias("value")).distinct(), "occurrences")
    entity = classes(occurrences, "kind", "value").filter(F.col("n") >= LEAST_DOCUMENTS)
    held = written_tidily(occurrences.join(entity, ["kind", "value"]).select(
        "key", F.col("class").alias("entity"), F.col("n").alias("n_entity")).distinct(), "held")
    # every different text once; it is read by word, and those that share an entity again
    one = keyed.groupBy("key").agg(F.first("text").alias("text")).join(
        held.select("key").distinct().withColumn("shared", F.lit(True)), "key", "left")
    texts = written_tidily(one.select("key", "text", F.coalesce("shared", F.lit(False)).alias("shared")), "texts", codec="zstd")
    shared = written_tidily(texts.filter("shared").select("key", "text"), "shared", codec="zstd")
    telling = written_tidily(disclosures(texts, shared, held, threshold), "disclosures")
    # the words of the documents that hold a telling term, with their places
    marker = F.when(F.col("m.value").rlike(r"\p{N}"), "[NUMBER]").when(F.col("m.value").rlike(r"^\p{Lu}"), "[NAME]").otherwise("")
    some = shared.join(telling.select("key").distinct(), "key", "left_semi")
    word = some.select("key", F.explode(matches(F.col("text"), F.lit(r"[\p{L}\p{N}]+"))).alias("m")).select(
        "key", F.lower("m.value").alias("term"), F.col("m.start").alias("start"), F.lit(len(KINDS) - 1).alias("rank"),
        F.col("m.end").alias("end"), F.lit("term").alias("kind"), marker.alias("marker"))
    formats = some.select("key", F.explode(entities(F.col("text"))).alias("s")).select(
        "key", "s.start", "s.rank", "s.end", "s.kind", F.lit(None).cast("string").alias("marker"))
    terms = apart(word.join(telling, ["key", "term"]).select(*formats.columns).unionByName(formats))
    made = terms.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "end", "kind", "marker"))).alias("terms"))
    made = written_tidily(made, "terms")
    for table in (occurrences, held, texts, shared, telling):
        removed(table)
    return made


def all_spans(text: Column, terms: Column) -> Column:
    """Spans of the fixed formats and the terms, sorted by start and kind; a null text has none."""
    base = F.transform(entities(F.coalesce(text, F.lit(""))), lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
        F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("marker"),
    ))
    none = F.array().cast(f"array<struct<{SPAN},marker:string>>")
    return F.array_sort(F.concat(base, F.coalesce(terms, none)))


def apart(spans: DataFrame) -> DataFrame:
    """The terms among rows of spans that overlap no fixed format of their text."""
    is_format = F.col("kind") != "term"
    order = Window.partitionBy("key").orderBy("start", "rank")
    reach = F.max(F.when(is_format, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    next_ = F.first(F.when(is_format, F.col("start")), ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing))
    placed = spans.withColumns({"_reach": reach, "_next": next_}).filter(~is_format)
    return placed.filter((F.coalesce("_reach", F.lit(0)) <= F.col("start")) & F.coalesce(F.col("_next") >= F.col("end"), F.lit(True))).drop(
        "_reach", "_next")


def private_spans(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and its spans, for every row of ``docs`` (columns doc_id and text); repeated rows each have theirs."""
    terms = telling_terms(docs.select("text"), threshold)
    own = docs.select("doc_id", text_key(F.col("text")).alias("key"), all_spans(F.col("text"), F.lit(None)).alias("base"))
    return own.join(small_side(terms), "key", "left").select(
        "doc_id", F.when(F.col("terms").isNull(), F.col("base")).otherwise(
            F.array_sort(F.concat("base", "terms"))).alias("spans"))


CHUNK = 256


def replaced(text: Column, spans: Column) -> Column:
    """A text with its spans replaced by their markers; what overlaps an earlier span is taken out with it.

    The text is cut into chunks once, so that a place is reached without counting letters from the beginning.
    """

    def build(chunks: Column, own: Column, done: Column) -> Column:
        def cut(a: Column, b: Column) -> Column:
            first = F.floor(a / CHUNK)
            part = F.slice(chunks, (first + 1).cast("int"), (F.floor((b - 1) / CHUNK) - first + 1).cast("int"))
            return F.when(b > a, F.substring(F.array_join(part, ""), (a - first * CHUNK + 1).cast("int"), (b - a).cast("int"))).otherwise("")

        pieces = F.zip_with(own, done, lambda m, d: F.when(m["start"] >= d, F.concat(cut(d, m["start"]), m["marker"])).otherwise(""))
        end = F.array_max(F.transform(own, lambda m: m["end"]))
        return F.concat(F.array_join(pieces, ""), cut(end, F.length(text).cast("long")))

    ends = F.transform(spans, lambda m: m["end"])
    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), lambda chunks: let(spans, lambda own: let(
        before(ends, 2, lambda s, x: F.greatest(s, x)), lambda done: build(chunks, own, done))))


def sanitise(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every span of the text replaced by its marker; of overlapping spans the first is replaced,
    and what the others cover goes with it. A null text stays null. Other columns may have any names.
    """
    key, own, made = fresh("key"), fresh("terms"), fresh("clean")
    named = telling_terms(docs.select("text"), threshold).select(F.col("key").alias(key), F.col("terms").alias(own))
    joined = docs.withColumn(key, text_key(F.col("text"))).join(small_side(named), key, "left")
    clean = let(all_spans(F.col("text"), F.col(own)), lambda spans: F.when(
        F.size(spans) > 0, replaced(F.col("text"), spans)).otherwise(F.col("text")))
    return joined.withColumn(made, clean).withColumn("text", F.col(made)).select(*docs.columns)
