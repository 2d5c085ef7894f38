"""The pipeline, stage by stage, against plain versions on the awkward tables and the given ones."""

import sys
from collections import Counter
from pathlib import Path

import brute
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline as P  # noqa: E402

from cyclemill.llm import secrets, toxicity  # noqa: E402
from cyclemill.llm.queries import toxicity_model  # noqa: E402


def key(r):
    return (r.doc_id, r.text, r.lang, r.source, r.n_chars)


@pytest.mark.parametrize("place", ["awkward", "given"])
def test_stages(spark, awkward, place):
    sf = awkward if place == "awkward" else "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").cache()
    rows = docs.collect()
    # 1: what the model scores under one half stays
    model = toxicity_model(spark, sf, docs)
    scores = [s for s, _ in model.score(toxicity.Bags(), [(r.text or "").encode() for r in rows])]
    kept = P.drop_toxic(spark, docs, sf).cache()
    assert kept.columns == docs.columns
    assert Counter(map(key, kept.collect())) == Counter(key(r) for r, s in zip(rows, scores) if s < 0.5)
    # 2: one of each group linked by fingerprints stays, that of the smallest id
    rows = kept.collect()
    single = P.drop_near_copies(spark, kept, sf).cache()
    assert single.columns == docs.columns
    linked = brute.links([brute.fingerprint(r.text) for r in rows])
    groups = {}
    for r, root in zip(rows, linked):
        groups.setdefault(root, []).append(r.doc_id)
    assert Counter(r.doc_id for r in single.collect()) == Counter(
        min((i for i in own if i is not None), default=None) for own in groups.values())
    assert set(map(key, single.collect())) <= set(map(key, rows))
    # 3: contaminated ones go
    items = [(b.item_id, b.text) for b in spark.read.parquet(f"{sf}/benchmark.parquet").collect() if b.item_id is not None]
    clean = P.drop_contaminated(spark, single, sf).cache()
    assert clean.columns == docs.columns
    assert Counter(map(key, clean.collect())) == Counter(
        key(r) for r in single.collect() if not brute.contamination(r.text, items)[4])
    # 4: all stay, secrets are replaced
    safe = P.redact_secrets(spark, clean, sf).cache()
    assert safe.columns == docs.columns and safe.count() == clean.count()
    find = secrets.finder()
    before = {r.doc_id: r for r in clean.collect()}
    for r in safe.collect():
        old = before[r.doc_id]
        if not find((old.text or "").encode()):
            assert key(r) == key(old)
        else:
            assert r.text != old.text and r.n_chars == len(r.text) and brute.spans(r.text, brute.SECRETS)[0] == [0, 0, 0]
    # 5: every token of every document in one piece
    pieces = P.pack(spark, safe, sf).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in safe.collect()}
    total = Counter()
    for r in pieces:
        total[r.doc_id] += r.length
    assert all(total[r.doc_id] % r.doc_tokens == 0 for r in pieces)


def test_whole_run(spark, awkward, hollow):
    assert P.run(spark, awkward).count() > 0
    assert P.run(spark, hollow).count() == 0
    assert [name for name, _ in P.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "packing"]
