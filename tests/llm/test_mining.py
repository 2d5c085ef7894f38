"""Phrase mining, the Merkle manifest and the quality rules against plain versions of themselves."""

import hashlib
import math
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from oracle import compare, connect  # noqa: E402

from cyclemill.llm import collocations, common, merkle, quality  # noqa: E402
from cyclemill.llm.queries import ORACLES, QUERIES  # noqa: E402
from cyclemill.sizing import small_side  # noqa: E402

GIVEN = "/root/testdata/sf0.001"


def rows_of(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").collect()


# ------------------------------------------------ phrases


def phrases(texts, least, top):
    """lang, rank, phrase, a, l, r, n, score by counting every phrase."""
    f, n = Counter(), Counter()
    for lang, text in texts:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text)):
            own = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(own)
            for k in (1, 2, 3):
                f.update((lang, tuple(own[i:i + k])) for i in range(len(own) - k + 1))
    found = {key: c for key, c in f.items() if len(key[1]) > 1 and c >= least}
    made = {}
    for (lang, p), a in found.items():
        inside = [q for (other, q), c in found.items() if other == lang and len(q) > len(p) and 100 * c >= 50 * a
                  and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if inside:
            continue
        cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        made.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return Counter((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, own in made.items()
                   for i, (s, a, p, left, right) in enumerate(sorted(own)[:top]))


WORDS = ["the", "Old", "mill", "river", "é", "stone", "a|b"]


def mixed(seed, n, breaks=("", "", "", "", ".", ",", "\n", "\x0b", "\x1c")):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(breaks) for _ in range(n))


@pytest.mark.parametrize("size", [5, 16, 1 << 18])
def test_phrases_are_those_of_plain_counting(spark, size):
    """Pieces that run over many blocks, languages side by side, nulls and repeated rows."""
    texts = [("en", mixed(1, 300)), ("de", mixed(2, 90)), (None, mixed(3, 120)), ("en", None), ("en", ""), (None, " \t."), ("und", mixed(4, 60)),
             ("en", "the old mill " * 30), ("de", mixed(5, 150, breaks=("",))), ("en", mixed(1, 300))]
    docs = spark.createDataFrame([(x, t, 1) for x, t in texts], "lang string, text string, n int")
    got = Counter(map(tuple, collocations.collocations(docs, least=3, top=25, size=size).collect()))
    assert got == phrases(texts, 3, 25)


def test_phrases_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CANDIDATES_PER_TASK", 3)
    texts = [("en", mixed(s, 200)) for s in range(4)]
    docs = spark.createDataFrame(texts, "lang string, text string")
    assert Counter(map(tuple, collocations.collocations(docs, least=2, top=7).collect())) == phrases(texts, 2, 7)


def test_blocks_are_read_a_few_at_a_time(spark):
    """A reader decodes a row group at once, Python gets a batch at once: neither may grow with the blocks of a file."""
    docs = spark.createDataFrame([("en", mixed(s, 200)) for s in range(8)], "lang string, text string").coalesce(1)
    words = collocations.blocks(docs, size=16)
    held = [file.metadata.row_group(i).num_rows for file in map(pq.ParquetFile, (f.removeprefix("file:") for f in words.inputFiles()))
            for i in range(file.metadata.num_row_groups)]
    assert sum(held) == words.count() > 50 and max(held) <= collocations.BLOCKS_IN_GROUP

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    large = spark.range(0, 12, 1, 1).select(F.sequence(F.lit(0), F.lit(collocations.BATCH_BYTES // 4)).alias("x"))
    before = spark.conf.get(common.BATCH)
    assert {r.n for r in collocations.written_in_parts(large.mapInArrow(sizes, "n long"), "sizes").collect()} == {1}
    assert spark.conf.get(common.BATCH) == before


def test_longer_phrases(spark):
    docs = spark.createDataFrame([("en", "one two three four five. " * 12 + mixed(9, 50))], "lang string, text string")
    for size in (4, 1 << 10):
        found = collocations.frequent_phrases(docs, longest=5, least=10, size=size)[1]
        assert [r.n for r in found[4].collect()] == [12]


def test_scores_beyond_64_bits(spark):
    a, left, right = 3 * 10**9, 4 * 10**9, 5 * 10**9 + 1
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long").select(collocations.share("a", "l", "r")).first()
    assert row[0] == 10**6 * a * a // (left * right)


@pytest.mark.parametrize("number", [11, 12])
def test_contracts_in_sql(spark, awkward, number):
    name = next(q for q in QUERIES if q.startswith(f"op{number}_"))
    con = connect(GIVEN)
    got, want, _ = compare(spark, con, GIVEN, name, QUERIES[name], ORACLES[name])
    assert got == want and got[1]


def test_phrases_of_the_awkward_table(spark, awkward):
    want = phrases([(r.lang, r.text) for r in rows_of(spark, awkward)], 10, 2000)
    assert Counter(map(tuple, QUERIES["op11_collocations"](spark, awkward).collect())) == want


# ------------------------------------------------ manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, at):
    made = []
    for nodes in levels[:-1]:
        run = at // 8 * 8
        made.append((nodes[run:at], nodes[at + 1:run + 8]))
        at //= 8
    return made


def manifest_rows(docs):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    trees = {}
    for d in docs:
        leaf = h(*map(field, (d.doc_id, d.source, d.lang, d.n_chars, d.text)))
        other = h(*map(field, (d.doc_id, d.source, d.lang, d.n_chars, None if d.text is None else brute.lower(d.text))))
        trees.setdefault(d.lang, []).append((d.doc_id is not None, d.doc_id or 0, leaf, other, d.doc_id))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    levels = {x: climb([r[2] for r in sorted(trees[x])]) for x in names}
    top = climb([levels[x][-1][0] for x in names])
    made = Counter()
    for t, x in enumerate(names):
        for i, (_, _, leaf, other, doc_id) in enumerate(sorted(trees[x])):
            own = path(levels[x], i) + path(top, t)
            now = other if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 else leaf
            for before, after in own:
                now = h(*before, now, *after)
            made[doc_id, leaf, levels[x][-1][0], top[-1][0], h(*(s for a, b in own for s in a + b)), now, now == top[-1][0]] += 1
    return made


@pytest.mark.parametrize("place", ["given", "awkward"])
def test_manifest(spark, awkward, place):
    sf = GIVEN if place == "given" else awkward
    got = Counter(map(tuple, QUERIES["op12_manifest"](spark, sf).collect()))
    assert got == manifest_rows(rows_of(spark, sf))
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n,span", [(1, 8), (8, 8), (9, 8), (300, 8), (700, 64)])
def test_trees_in_blocks_and_proofs_of_some_leaves(spark, monkeypatch, n, span):
    """Small blocks take several passes; a few leaves fetch leaves, interiors and subroots that others hold."""
    monkeypatch.setattr(merkle, "SPAN", span)
    monkeypatch.setattr(merkle, "LEVELS", int(math.log(span, 8)))
    rows = [(i, f"g{i % 11}" if i % 3 else "big", h(str(i))) for i in range(n)]
    made = merkle.manifest(spark.createDataFrame(rows, "id long, name string, leaf string"), "name", "id", rows_per_task=40)
    trees = {}
    for i, name, leaf in rows:
        trees.setdefault(name, []).append(leaf)
    levels = {x: climb(trees[x]) for x in sorted(trees)}
    top = climb([levels[x][-1][0] for x in sorted(trees)])
    assert made.root == top[-1][0]
    for wanted in (None, made.leaves.filter("carried.id % 7 = 3 OR carried.id = 0")):
        found = made.proofs(wanted).collect()
        assert len(found) == (n if wanted is None else wanted.count())
        for r in found:
            t = sorted(trees).index(r.tree[1:])
            proof = path(levels[r.tree[1:]], r.pos) + path(top, t)
            assert r.siblings == [s for a, b in proof for s in a + b] and r.folded == made.root
            assert merkle.verify(h("x"), r.pos, r["size"], t, len(trees), r.siblings) != made.root


def test_least_set_of_nodes_to_fetch():
    assert merkle.missing(np.arange(64), 64) == [] and merkle.missing(np.array([0]), 1) == []
    assert merkle.missing(np.arange(8), 20) == [(1, 1), (1, 2)]
    assert merkle.missing(np.array([3, 17]), 20) == [*((0, p) for p in (0, 1, 2, 4, 5, 6, 7, 16, 18, 19)), (1, 1)]


# ------------------------------------------------ quality


@pytest.mark.parametrize("place", ["given", "awkward"])
def test_plain_counts(spark, awkward, place):
    sf = GIVEN if place == "given" else awkward
    got = QUERIES["op13_quality"](spark, sf).collect()
    want = Counter((r.doc_id, *brute.plain_counts(r.text)) for r in rows_of(spark, sf))
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed) and any(r.kept for r in got)


def kneser_ney(texts, order):
    """A function from a word to its log-probability, by the textbook, for one language."""
    texts = sorted(set(texts))
    holds, words = {}, Counter()
    for t in texts:
        for w in set(t.split()):
            words[w] += 1
            holds.setdefault(w, set()).add(t)
    full, docs = Counter(), {}
    for w in words:
        own = f" {w} "
        for i in range(1, len(own)):
            g = own[max(0, i - order + 1):i + 1]
            full[g] += 1
            docs.setdefault(g, set()).update(holds[w])
    full = {g: n for g, n in full.items() if len(docs[g]) > 1}
    adjusted = {order: {g: n for g, n in full.items() if len(g) == order}}
    for k in range(order - 1, 0, -1):
        adjusted[k] = {g: n for g, n in full.items() if len(g) == k}
        for g in adjusted[k + 1]:
            if g[1:] not in full or len(g[1:]) != k or not g[1:].startswith(" ") or len(g[1:]) == 1:
                adjusted[k][g[1:]] = adjusted[k].get(g[1:], 0) + 1
    d, weight, whole = {}, {}, {}
    for k, own in adjusted.items():
        n = [sum(v == i for v in own.values()) for i in range(1, 5)]
        for i in (1, 2, 3):
            value = None
            if n[i - 1] and n[i] and n[0]:
                value = i - (i + 1) * n[0] / (n[0] + 2 * n[1]) * n[i] / n[i - 1]
            d[k, i] = value if value is not None and 0 < value < i else i / 2
        for g, v in own.items():
            whole[k, g[:-1]] = whole.get((k, g[:-1]), 0) + v
            weight[k, g[:-1]] = weight.get((k, g[:-1]), 0) + d[k, min(v, 3)]

    def p(g):
        k = len(g)
        if not k:
            return 1 / (len(adjusted[1]) + 1)
        if (k, g[:-1]) not in whole:
            return p(g[1:])
        s = whole[k, g[:-1]]
        seen = adjusted[k].get(g)
        return ((seen - d[k, min(seen, 3)]) / s if seen else 0) + weight[k, g[:-1]] / s * p(g[1:])

    def word(w):
        own = f" {w} "
        return sum(math.log(p(own[max(0, i - order + 1):i + 1])) for i in range(1, len(own)))

    return word


def scores_by_hand(texts, order=quality.ORDER):
    made = {}
    for lang in {x for x, _ in texts}:
        word = kneser_ney([t for x, t in texts if x == lang and t], order)
        for x, t in texts:
            if x == lang and t and t.split():
                own = t.split()
                made[x, t] = -sum(map(word, own)) / sum(len(w) + 1 for w in own)
    return made


@pytest.fixture(scope="module")
def prose(spark):
    rng = random.Random(41)
    syllables = {"en": ["the", "ing", "an", "er", "ou", "st"], "de": ["ein", "sch", "ung", "ö", "ver"]}
    texts = []
    for lang, own in syllables.items():
        for _ in range(40):
            texts.append((lang, " ".join("".join(rng.choices(own, k=rng.randrange(1, 4))) for _ in range(60))))
    texts += [("en", "zq xw qqq zzxj " * 15), ("de", ""), ("de", None), ("en", texts[0][1]), ("de", "東京 einung " * 30)]
    return texts


@pytest.mark.parametrize("most", [1 << 22, 0])
def test_scores_are_those_of_the_textbook(spark, prose, most):
    """With the model at hand, and with documents in slices that fetch their part of it."""
    docs = spark.createDataFrame([(i, x, t, "z") for i, (x, t) in enumerate(prose)], "doc_id long, lang string, text string, stats string")
    model = quality.train(docs, bucket_entries=64)
    assert model.bits > 2
    found = quality.scored(docs, model, most, slice_text=4000)
    c = found.columns[-1]
    got = {r.doc_id: r.score for r in found.select("doc_id", f"{c}.score").collect()}
    want = scores_by_hand(prose)
    assert len(got) == len(prose)
    for i, key in enumerate(prose):
        if key in want:
            assert got[i] == pytest.approx(want[key], abs=1e-5)
        else:
            assert got[i] is None


def test_copies_of_junk_do_not_vouch_for_it(spark, prose):
    own = [t for x, t in prose if x == "en" and "zq" not in t]
    scores = []
    for copies in (1, 30):
        docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(own + ["vkp jjw qcx " * 20] * copies)], "doc_id long, lang string, text string")
        found = quality.scored(docs, quality.train(docs))
        scores.append(found.filter(F.col("doc_id") >= len(own)).select(f"{found.columns[-1]}.score").distinct().collect())
    assert scores[0] == scores[1] and len(scores[0]) == 1


def running_grams(texts, order=quality.ORDER):
    """(lang, n-gram): how often it occurs in the running text of the different texts, if two of these hold it."""
    n, holds = Counter(), {}
    for lang, text in {(x, t) for x, t in texts if t}:
        for word in text.split():
            own = f" {word} "
            for i in range(1, len(own)):
                key = lang, own[max(0, i - order + 1):i + 1]
                n[key] += 1
                holds.setdefault(key, set()).add(text)
    return {key: c for key, c in n.items() if len(holds[key]) > 1}


@pytest.mark.parametrize("held,copied", [(1 << 19, 1 << 20), (40, 1 << 20), (1 << 19, 1)])
def test_the_model_counts_the_running_text(spark, prose, monkeypatch, held, copied):
    """Every occurrence counts, of copies those of one: with few words held at once, and with a join of the copies that is shuffled."""
    monkeypatch.setattr(quality, "WORDS_HELD", held)
    monkeypatch.setattr(quality, "small_side", lambda df: small_side(df, max_rows=copied))
    rows = prose + prose[:3] + prose[:1] * 4
    docs = spark.createDataFrame([(1, x, t) for x, t in rows], "doc_id long, lang string, text string").repartition(5)
    got = {(r.lang, r.gram): r.n for r in quality.gram_counts(quality.vocabulary(docs, running=True)).collect()}
    assert got == running_grams(rows) and max(got.values()) > 300


def test_verdicts_are_of_the_running_text(spark, prose):
    """Rare words made common in the running text, but not in the vocabulary, cost less."""
    texts = [t for x, t in prose if x == "en"]
    scores = []
    for times in (1, 200):
        docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate([*texts, "kettle drum", "kettle drum now " * times])], "doc_id long, lang string, text string")
        found = quality.quality(docs)
        scores.append(found.filter(F.col("doc_id") == len(texts)).select(f"{found.columns[-1]}.score").first()[0])
    assert scores[1] < scores[0] - 0.5


def test_copies_do_not_vouch_for_junk_in_the_running_text(spark, prose):
    own = [t for x, t in prose if x == "en" and "zq" not in t]
    scores = []
    for copies in (1, 30):
        docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(own + ["vkp jjw qcx thest " * 20] * copies)], "doc_id long, lang string, text string")
        found = quality.scored(docs, quality.train(docs, running=True))
        scores.append(found.filter(F.col("doc_id") >= len(own)).select(f"{found.columns[-1]}.score").distinct().collect())
    assert scores[0] == scores[1] and len(scores[0]) == 1


def test_bands_reject_on_either_side(spark):
    rng = random.Random(3)
    rows = [("en", i, rng.gauss(2.0, 0.05)) for i in range(400)] + [("en", 1000, 0.5), ("en", 1001, 4.0), ("en", 5, 2.0), ("fr", 1, 1.0), ("fr", 2, None)]
    df = spark.createDataFrame(rows, "lang string, text_hash long, score double")
    (row,) = quality.bands(df, width=8.0, least_texts=50).collect()
    own = sorted({h: s for x, h, s in rows if x == "en"}.values())
    middle = own[len(own) // 2]
    spread = sorted(abs(s - middle) for s in own)[len(own) // 2]
    assert row.lang == "en" and row.lower == pytest.approx(middle - 8 * spread, abs=0.12) and row.upper == pytest.approx(middle + 8 * spread, abs=0.12)


def test_quality_against_labels(spark):
    sf = "/root/testdata/sf0.01"
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id: r.kept for r in QUERIES["op13_quality"](spark, sf).collect() if not r.base_failed}
    good = [k for i, k in kept.items() if label.get(i) == 1]
    assert sum(good) >= 0.95 * len(good)
