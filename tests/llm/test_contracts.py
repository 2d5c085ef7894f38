"""Every query against the contract in plain Python, on the given tables and on the awkward ones."""

import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from tables import QUOTE

from cyclemill.llm.queries import QUERIES

GIVEN = "/root/testdata/sf0.001"


def by_name(number):
    return next(f for name, f in QUERIES.items() if name.startswith(f"op{number}_"))


def table(spark, sf, name):
    return [r.asDict() for r in spark.read.parquet(f"{sf}/{name}.parquet").collect()]


@pytest.fixture(params=["given", "awkward"])
def sf(request, awkward):
    return GIVEN if request.param == "given" else awkward


def same(got, want):
    assert Counter(got) == Counter(want)


def test_simhash(spark, sf):
    docs = table(spark, sf, "documents")
    prints = [brute.fingerprint(d["text"]) for d in docs]
    roots = brute.components(prints, [d["doc_id"] for d in docs])
    same([tuple(r) for r in by_name(1)(spark, sf).collect()],
         [(d["doc_id"], f"{f:016x}", r) for d, f, r in zip(docs, prints, roots)])


def test_licenses(spark, sf):
    rows = by_name(2)(spark, sf)
    same([tuple(r)[:6] for r in rows.collect()],
         [(d["doc_id"], *brute.base_licenses(d["text"])) for d in table(spark, sf, "documents")])
    for r in rows.collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


@pytest.mark.parametrize("number,kinds", [(3, brute.PRIVATE), (5, brute.SECRETS)])
def test_spans(spark, sf, number, kinds):
    want = []
    for d in table(spark, sf, "documents"):
        counts, joined = brute.spans(d["text"], kinds)
        want.append((d["doc_id"], *counts, brute.sha(joined)))
    rows = by_name(number)(spark, sf).collect()
    same([tuple(r)[:len(kinds) + 2] for r in rows], want)
    names = [k[0] for k in kinds]
    for r in rows:  # base spans stay, in order
        spans = [s.split(":") for s in r.spans.split(",") if s]
        starts = [(int(a), names.index(k) if k in names else 9) for k, a, _ in spans]
        assert starts == sorted(starts)
        assert brute.sha(",".join(":".join(s) for s in spans if s[0] in names)) == r.base_sha256


def test_toxicity(spark, sf):
    rows = by_name(4)(spark, sf).collect()
    docs = table(spark, sf, "documents")
    same([r.doc_id for r in rows], [d["doc_id"] for d in docs])
    for r in rows:
        assert r.held_out == (r.doc_id is not None and brute.held_out(r.doc_id, 5, 0))
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_toxicity_accuracy(spark):
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, "/root/testdata/sf0.01", "labels")}
    rows = [r for r in by_name(4)(spark, "/root/testdata/sf0.01").collect() if r.held_out and labels.get(r.doc_id) is not None]
    right = sum(r.predicted == labels[r.doc_id] for r in rows)
    assert right >= 0.95 * len(rows)
    toxic = [r for r in rows if labels[r.doc_id]]
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic)


def test_extraction(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, GIVEN, "pages")}
    import html
    for r in by_name(6)(spark, GIVEN).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", article)).split())
        assert r.text == want and r.n_chars == len(want)


def test_extraction_of_awkward_pages(spark, awkward):
    rows = by_name(6)(spark, awkward).collect()
    assert len(rows) == 7 and all(r.text is not None and r.n_chars == len(r.text) for r in rows)
    assert next(r.text for r in rows if r.url == "http://a/1" and r.n_chars) == "Title One & two three."
    assert next(r.text for r in rows if r.page_id == 2) == ""


def test_language(spark, sf):
    rows = by_name(7)(spark, sf).collect()
    docs = table(spark, sf, "documents")
    same([r.doc_id for r in rows], [d["doc_id"] for d in docs])
    text = {d["doc_id"]: d["text"] for d in docs}
    for r in rows:
        assert r.held_out == (r.doc_id is not None and brute.held_out(r.doc_id, 4, 2)) and 0 <= r.score <= 1
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text[r.doc_id] or ""))


def test_language_accuracy(spark):
    lang = {d["doc_id"]: d["lang"] for d in table(spark, "/root/testdata/sf0.01", "documents")}
    held = [r for r in by_name(7)(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)


def test_decontamination(spark, sf):
    items = [(b["item_id"], b["text"]) for b in table(spark, sf, "benchmark") if b["item_id"] is not None]
    same([tuple(r) for r in by_name(8)(spark, sf).collect()],
         [(d["doc_id"], *brute.contamination(d["text"], items)) for d in table(spark, sf, "documents")])


def test_packing(spark, sf):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {}
    for d in table(spark, sf, "documents"):
        own = np.array([*tokenizer.encode(d["text"] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        ids.setdefault(d["doc_id"], []).append(own)
    rows = by_name(9)(spark, sf).collect()
    sequences, covered = {}, Counter()
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
        covered[r.doc_id] += r.length
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for x in ids[r.doc_id])
    assert covered == Counter({k: sum(map(len, v)) for k, v in ids.items()})
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    lengths = [sum(r.length for r in own) for own in sequences.values()]
    padding = sum(2048 - n for n in lengths if n & (n - 1))
    tasks = len({s >> 33 for s in sequences})
    assert padding <= 0.02 * sum(lengths) + 2048 * tasks


def test_topk(spark, sf):
    vectors = [(v["vec_id"], v["embedding"]) for v in table(spark, sf, "embeddings") if v["vec_id"] is not None]
    same([tuple(r) for r in by_name(10)(spark, sf).collect()], brute.top(vectors))


def test_empty_tables(spark, hollow):
    for name, query in QUERIES.items():
        assert query(spark, hollow).count() == 0, name


def test_quote_is_long_enough():
    assert len(brute.words(QUOTE)) > 13
