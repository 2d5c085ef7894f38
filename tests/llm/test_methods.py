"""The parts of the operators against plain versions of themselves."""

import random
import time
from collections import Counter

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cyclemill.llm import decontamination, extraction, graph, language, licenses, packing, pii, secrets, simhash, topk, toxicity
from cyclemill.llm.words import Hasher


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB9é东 .\n\t_-", max_size=30), max_size=6))
def test_words_are_found_and_hashed_alike(texts):
    hasher = Hasher("alnum")
    hashes, _, counts, _ = hasher([t.encode() for t in texts])
    words = [brute.words(t) for t in texts]
    assert counts.tolist() == [len(w) for w in words]
    flat = [w for own in words for w in own]
    assert len({(h, w) for h, w in zip(hashes.tolist(), flat)}) == len(set(flat)) == len(set(hashes.tolist()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=30), min_size=1, max_size=6), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=4), min_size=1, max_size=6))
def test_index_finds_every_occurrence(runs, phrases):
    text = np.array([s for run in runs for s in (*run, 0)])
    index = decontamination.FMIndex(text, 3)
    padded = np.array([[*p, *[0] * (4 - len(p))] for p in phrases])
    low, high = index.search(padded, np.array([len(p) for p in phrases]))
    for k, phrase in enumerate(phrases):
        want = [i for i in range(len(text) - len(phrase) + 1) if text[i:i + len(phrase)].tolist() == phrase]
        assert sorted(index.locate(np.arange(low[k], high[k])).tolist()) == want


def test_suffix_order_of_repeats():
    text = np.array([1, 2] * 200 + [0] + [1] * 300 + [0])
    want = sorted(range(len(text)), key=lambda i: text[i:].tolist())
    assert decontamination.suffix_order(text).tolist() == want


def test_benchmark_in_blocks_gives_the_same(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + k) % 50}" for k in range(120))) for i in range(8)], "doc_id long, text string")
    items = spark.createDataFrame([(i, " ".join(f"w{(i * 3 + k) % 50}" for k in range(14))) for i in range(9)], "item_id long, text string")

    def result(**sizes):
        found = decontamination.contamination(docs, items, **sizes)
        return sorted((r[0], r[-1]["n_words"], r[-1]["n_hit"], r[-1]["items"], r[-1]["contaminated"]) for r in found.collect())

    want = [(d, *brute.contamination(t, [(r.item_id, r.text) for r in items.collect()])) for d, t in docs.collect()]
    one = result()
    assert [(a, b, c, len(d), e) for a, b, c, d, e in one] == [(a, b, c, d, f) for a, b, c, d, _, f in want]
    assert result(block_words=8) == one == result(shard_bytes=64)


def test_long_lists_link_as_short_ones(spark):
    rng = random.Random(4)
    prints = set()
    for _ in range(12):
        center = rng.getrandbits(64)
        for _ in range(30):
            x = center
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x - (1 << 64) if x >> 63 else x)
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    want = brute.components([p % (1 << 64) for p in prints], prints)
    for size in (2, 8, 1000):
        roots = {r.node: r.root for r in simhash.grouped(df, size).collect()}
        assert [roots.get(p, p) for p in prints] == want


def test_components_of_a_path(spark):
    n = 300
    order = list(range(n))
    random.Random(1).shuffle(order)
    edges = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (7, 7)], "a long, b long")
    roots = {r.node: r.root for r in graph.components(edges).collect()}
    assert roots == {**{i: 0 for i in range(n)}, 1000: 1000, 1001: 1000}


def stays(rows):
    """The doc_id that stays of each group of (doc_id, text)."""
    groups = {}
    for (i, _), root in zip(rows, brute.links([brute.fingerprint(t) for _, t in rows])):
        groups.setdefault(root, []).append(i)
    return Counter(min((i for i in own if i is not None), default=None) for own in groups.values())


@pytest.mark.parametrize("list_size", [2, 64])
def test_one_document_of_each_group_stays(spark, list_size):
    import tables

    docs = tables.documents(spark)
    kept = simhash.drop_near_duplicates(docs, list_size=list_size)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == stays([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("list_size", [2, 64])
def test_near_copies_of_long_texts_are_dropped(spark, list_size):
    """A word or two of two thousand changed, and a family that shares a passage."""
    rng = random.Random(8)
    template, rows = [f"t{i}" for i in range(900)], []
    for g in range(25):
        words = template * (g % 2) + [f"w{rng.randrange(5000)}" for _ in range(2000)]
        for k in range(4):
            own = list(words)
            for _ in range(k):
                own[rng.randrange(len(own))] = f"new{rng.randrange(10**6)}"
            rows.append((g * 10 + k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter(r.doc_id for r in simhash.drop_near_duplicates(docs, list_size=list_size).collect())
    assert kept == stays(rows) and len(kept) < 60 and {i for i in kept if i % 10 == 0} == set(range(0, 250, 10))


@pytest.mark.parametrize("text,label,edits", [
    ("Licensed under the Apache Licence, Version 2.0", "apache-2.0", 1),
    ("relased under the MIT license", "mit", 1),
    ("Permission is hereby granted, free of charges, to any persn obtaining a copy", "mit", 2),
])
def test_notices_with_errors(text, label, edits):
    found = licenses.Finder()(text.encode())
    assert label in found[5] and any(s["label"] == label and s["edits"] == edits for s in found[7]) and 0 < found[6] < 1


@pytest.mark.parametrize("text", [
    "mozila public license mozilla public license",
    "gnu lesser genral public license gnu lesser general public license",
    "mozilla public license mozila public license mozilla public licence",
    "released under the mït license and réleased under the mit license",
    "isc license isc license", "the gnu general public", "creative commons attributon all right reserved",
    "gnu general public license " * 40,
])
def test_every_notice_is_found_wherever_it_stands(text):
    find = licenses.Finder()
    for around in (text, "x y " + text + " z", text.replace("license", "license and then some words of other things")):
        spans = [(s["label"], s["start"], s["end"], s["edits"]) for s in find(around.encode())[-1]]
        assert spans == brute.notices(around, licenses.NOTICES, licenses.ERROR_SHARE)


def test_notices_of_the_awkward_table_and_of_damaged_text():
    import tables

    rng = random.Random(21)
    texts = [t for t in tables.TEXTS if len(t or "") < 3000]
    for _ in range(40):
        notice = rng.choice(licenses.NOTICES)[0]
        damaged = list(f"{tables.prose(rng.random(), 5)} {notice} {rng.choice(licenses.NOTICES)[0]}")
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(damaged))
            damaged[at] = rng.choice(["", "é", "x", " ", damaged[at] * 2])
        texts.append("".join(damaged))
    find = licenses.Finder()
    for text in texts:
        spans = [(s["label"], s["start"], s["end"], s["edits"]) for s in find((text or "").encode())[-1]]
        assert spans == brute.notices(text, licenses.NOTICES, licenses.ERROR_SHARE)


def test_no_notice_in_plain_prose():
    assert licenses.Finder()(b"the license of the public library was granted to all people of the town")[5] == []


def test_novel_strings():
    find = secrets.finder()
    kinds = lambda t: [s[2] for s in find(t.encode())]
    assert kinds("Authorization header: Bearer q9ZkX2vLw7TnRb4YpM1s end") == ["novel"]
    assert kinds("Authorization header: Bearer application_json_version2 end") == []
    assert kinds("the order q9ZkX2vLw7TnRb4YpM1s was sent") == []  # no sensitive context


@pytest.mark.parametrize("letters", [
    "abcdefghijklmnopqrstuvwxyz0123456789", "0123456789ABCDEF", "0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
])
def test_random_keys_of_any_length_are_novel(letters):
    import tables

    rng, find = random.Random(4), secrets.finder()
    for size in (12, 16, 32, 40, 64, 100, 200):
        found = tried = 0
        for k in range(60):
            key = "".join(rng.choice(letters) for _ in range(size))
            if not secrets.varied(key) or not secrets.CANDIDATE.fullmatch(key):
                continue
            lead = tables.prose(k, 40) + " authorization: bearer "
            tried += 1
            spans = find(f"{lead}{key} {tables.prose(k + 99, 40)}".encode())  # long ones of digits alone are of the hexadecimal format
            found += [s[:2] for s in spans] == [(len(lead), len(lead) + size)]
        assert tried > 20 and found >= 0.9 * tried, (size, found, tried)


def test_known_identifiers_are_not_novel():
    import tables

    find = secrets.finder()
    for k, name in enumerate(("application_json_version2", "access_token_v2", "oauth2_client_secret", "base64_encoded_string1",
                              "0123456789abcdef0123", "session_timeout_3600", "aaaaaaaaaaaaaaaaaaaaaaa1")):
        text = f"{tables.prose(k, 40)} authorization: bearer {name} {tables.prose(k + 9, 40)}"
        assert not [s for s in find(text.encode()) if s[2] == "novel"], name


def test_redaction(spark):
    df = spark.createDataFrame([("a token = abcdef123 b",), (None,), ("",), ("plain",)], "text string")
    got = [r[0] for r in df.select(secrets.redacted()["text"]).collect()]
    assert got == ["a [REDACTED] b", None, "", "plain"]


def test_toxic_sentences_are_found():
    rng = random.Random(2)
    words = [f"word{i}" for i in range(200)]
    rows = []
    for k in range(400):
        sentences = [" ".join(rng.choice(words) for _ in range(8)) + "." for _ in range(6)]
        if k % 4 == 0:
            sentences[rng.randrange(6)] = "you vile creature " + rng.choice(words) + "."
        rows.append((" ".join(sentences), int(k % 4 == 0)))
    model = toxicity.fit(rows)
    text = "word1 word2 word3. Grüße, what a vile creature word9! word4 word5."
    (score, found), (clean, none), (empty, _) = model.score(toxicity.Bags(), [text.encode(), b"word1 word2. word7 word9.", b""])
    assert score > 0.5 and clean < 0.5 and none == [] and 0 <= empty <= 1
    assert any("vile" in text[s["start"]:s["end"]] for s in found)


def plain_score(model, text):
    """Noisy-or over the sentences, one by one."""
    features, sentence, per_text, _ = toxicity.Bags()([text.encode()])
    if not per_text[0]:
        return model.base
    fine = 1.0
    for s in range(per_text[0]):
        logit = model.bias + float(model.weights[features[sentence == s]].astype(float).sum())
        fine *= 1 - 1 / (1 + np.exp(-logit))
    return 1 - fine


def test_a_balanced_sample_stands_for_all_labels(spark):
    """Many clean documents, few toxic ones, of each as many drawn: empty texts score the share of all labels."""
    rng = random.Random(17)
    word = lambda: rng.choice(["river", "stone", "winter", "bread", "harbour", "letter"])
    rows = [(i, " ".join(word() for _ in range(12)) + ("." if i % 20 else ". you idiot fool."), int(i % 20 == 0)) for i in range(2000)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(9999, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    model = toxicity.train(docs, labels, per_label=100)
    texts = [t for _, t, _ in rows[:200]] + ["", "river stone. you idiot fool. bread"]
    scores = [s for s, _ in model.score(toxicity.Bags(), [t.encode() for t in texts])]
    assert model.base == pytest.approx(0.05, abs=0.01) and scores[-2] == pytest.approx(model.base)
    assert all((s >= 0.5) == bool(r[2]) for s, r in zip(scores, rows)) and scores[-1] > 0.5
    assert scores == pytest.approx([plain_score(model, t) for t in texts], abs=1e-5)


def test_toxicity_without_both_labels():
    for rows in ([], [("a", 0)], [("a", 1)]):
        score = toxicity.fit(rows).score(toxicity.Bags(), [b"some words", b""])
        assert all(0 <= s <= 1 for s, _ in score)


def test_every_language_has_a_share_of_the_sample(spark):
    """A language of few documents is learned from a table of very many others, too."""
    rows = [(i, "the river and the old stones of the wide sea", "en") for i in range(3000)]
    rows += [(5000 + i, "der alte fluss trägt die steine zum weiten meer", "de") for i in range(12)] + [(9000, "² ½ ①", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs, max_rows=60, least_rows=20)
    assert set(model.names) == {"en", "de"}
    assert model.predict("der weite fluss und die alten steine".encode())[0] == "de"
    assert model.predict("² ½ ①".encode())[0] == "und"


def test_language_of_stretches():
    raw = ("ein haus und die strasse " * 30000).encode()
    whole = np.sort(np.concatenate(list(language.subwords(raw))))
    data = language.MAP[np.frombuffer(b" " + raw + b" ", dtype=np.uint8)]
    runs = sum(int((~((data[:-n + 1] == 32) & (data[1:len(data) - n + 2] == 32))).sum()) for n in language.SIZES)
    assert len(whole) == runs


def test_language_and_rejection():
    rows = [(f"der hund und die katze {i} sind im haus", "de") for i in range(60)] + [(f"the dog and the cat {i} are in the house", "en") for i in range(60)]
    model = language.fit(rows)
    assert model.predict(b"die katze und der hund")[0] == "de" and model.predict(b"the house and the cat")[0] == "en"
    assert model.predict(b"")[:2] == ("und", 0.0) and model.predict("123 !?".encode())[0] == "und"
    assert language.fit([]).predict(b"word")[0] == "und"


def cheapest(place, cost, window):
    """All cut sets by plain dynamic programming over every place and every full-window cut in between."""
    where, price, best = [0, *place], [0.0, *cost], [0.0]
    for j in range(1, len(where)):
        low = float("inf")
        for i in range(j):
            full, rest = divmod(where[j] - where[i] - 1, window)
            if full <= packing.FULL:
                low = min(low, best[i] + packing.SPLIT_COST * full + window - rest - 1)
            if full == 0 and (where[j] - where[i]) & (where[j] - where[i] - 1) == 0:
                low = min(low, best[i] + 1.0)
        best.append(low + price[j])
    return best[-1]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 64), st.sampled_from([0.0, 1.0])), min_size=1, max_size=40))
def test_cuts_are_the_cheapest(steps):
    place = np.cumsum([s for s, _ in steps])
    cost = np.array([c for _, c in steps])
    ends = packing.cheapest_cuts(place, cost, 64)
    assert ends == sorted(set(ends)) and ends[-1] == place[-1]
    price, at, paid, costs = {int(p): c for p, c in zip(place, cost)}, 0, 0.0, dict(zip(place.tolist(), cost))
    for e in ends:
        size = e - at
        assert 0 < size <= 64
        pad = 64 - size if size & (size - 1) else 0
        paid += (min(64 - size, 1.0) if pad == 0 else pad) + (price[e] if e in costs else packing.SPLIT_COST)
        at = e
    assert paid <= cheapest(place.tolist(), cost.tolist(), 64) + 1e-9


def paid_for(ends, place, cost, window):
    costs, at, paid = dict(zip(place.tolist(), cost.tolist())), 0, 0.0
    for e in ends:
        size = e - at
        assert 0 < size <= window
        paid += min(window - size, 1.0) if size & (size - 1) == 0 else window - size
        paid += costs.get(e, packing.SPLIT_COST)
        at = e
    assert at == place[-1]
    return paid


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 2, 3, 5, 13, 16, 17, 31, 47, 70, 203]), st.sampled_from([0.0, 1.0])), min_size=1, max_size=12))
def test_cuts_are_the_cheapest_of_all_positions(steps):
    """Against plain dynamic programming that lets a window end at every token."""
    place, cost, window = np.cumsum([s for s, _ in steps]), np.array([c for _, c in steps]), 16
    costs, best = dict(zip(place.tolist(), cost.tolist())), [0.0]
    for p in range(1, int(place[-1]) + 1):
        low = min(best[p - n] + (min(window - n, 1.0) if n & (n - 1) == 0 else window - n) for n in range(1, min(p, window) + 1))
        best.append(low + costs.get(p, packing.SPLIT_COST))
    assert paid_for(packing.cheapest_cuts(place, cost, window), place, cost, window) == best[-1]


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from([1, 2, 3, 5, 13, 31, 47, 70, 203, 450]), st.sampled_from([0.0, 1.0])), min_size=1, max_size=12),
    st.sampled_from([2, 16, 64, 100, 256]),
)
def test_least_costs_of_every_position(steps, window):
    """Blocks of positions worked on at once have the costs of plain dynamic programming, and the cuts are paid by them."""
    place, cost = np.cumsum([s for s, _ in steps]), np.array([c for _, c in steps])
    costs, best, paid = dict(zip(place.tolist(), cost.tolist())), [0.0], [0.0]
    for p in range(1, int(place[-1]) + 1):
        best.append(min(paid[p - n] + (min(window - n, 1.0) if n & (n - 1) == 0 else window - n) for n in range(1, min(p, window) + 1)))
        paid.append(best[-1] + costs.get(p, packing.SPLIT_COST))
    assert [x.tolist() for x in packing.least_costs(place, cost, window)] == [best, paid]
    assert paid_for(packing.cheapest_cuts(place, cost, window), place, cost, window) == paid[-1]


def test_every_sentence_end_is_a_place():
    stops = np.array([False, False, True])
    ids = [np.array([0, 2, 0, 0, 2, 1]), np.array([1]), np.array([0] * 40 + [2, 0, 2, 1])]
    place, cost = packing.cut_places(ids, stops)
    assert place.tolist() == [2, 5, 6, 7, 48, 50, 51] and cost.tolist() == [1, 1, 0, 0, 1, 1, 0]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_ids_are_those_of_the_tokenizer(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder(packing.VOCABULARY)
    for text in [*texts, "<|endoftext|> a", "x" * 3000, " \n\n  tab\t"]:
        assert encoder(text).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("scale,blocks", [(256, 4096), (256, 7), (2**40, 7)])
def test_topk_blocks_and_large_numbers(spark, scale, blocks):
    rng = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in rng.normal(size=6).astype("f4")]) for i in range(120)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = topk.top_inner_products(df, every=10, k=4, scale=scale, block=blocks, query_block=5).collect()
    want = brute.top(vectors, every=10, k=4, scale=scale)
    clip = [(a, b, c, max(-(2**63), min(2**63 - 1, s))) for a, b, c, s in want]
    # beyond 64 bits the scores are clipped, but the order is that of the whole numbers
    assert sorted(map(tuple, got)) == sorted(clip)


def test_lists_are_left_early():
    """Clustered vectors: the bounds settle before every list is read, with the same answer."""
    rng = np.random.default_rng(5)
    vectors = np.concatenate((rng.integers(-20, 20, (3000, 4)), rng.integers(200, 250, (20, 4))))
    ids = np.arange(len(vectors))
    lists = topk.Lists(ids, ids, vectors)
    queries = rng.integers(1, 250, (9, 4))
    read = []
    got = sorted(topk.aggregate(lists, queries, np.full(9, -1), 5, read))
    assert len(read) == 9 and max(read) < 0.5
    exact = topk.Lists(ids, ids, vectors, exact=True)  # whole numbers of any size
    assert sorted(topk.aggregate(exact, queries.astype(object), np.full(9, -1), 5)) == got
    want = []
    for q, v in enumerate(queries):
        want += [(q, int(i), int(s)) for s, i in sorted(((int(w @ v), i) for i, w in enumerate(vectors)), key=lambda x: (-x[0], x[1]))[:5]]
    assert got == sorted(want)


def test_terms_that_give_an_entity_away(spark):
    rows = [(i, f"filler words number {i} about the weather and the town") for i in range(60)]
    rows += [(100 + i, f"please ask Zorblatt at z.b@mail.example.org about the weather {i}") for i in range(4)]
    rows += [(200, None), (201, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.private_spans(docs).collect()}
    text = dict(rows)
    assert len(spans) == len(rows) and all(not spans[i] for i in range(60))
    words = {text[100][s.start:s.end] for s in spans[100] if s.kind == "term"}
    assert "Zorblatt" in words and "about" not in words and "weather" not in words
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "[NAME] at [EMAIL] about the weather" in clean[100] and clean[3] == text[3] and clean[200] is None and clean[201] == ""


def test_terms_far_from_their_entity(spark):
    far = " and the weather in the town" * 9
    rows = [(i, f"filler words number {i}{far}") for i in range(60)]
    rows += [(100 + i, f"Zorblatt writes{far}, signed z.b@mail.example.org and again{far} by ZORBLATT {i}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.private_spans(docs).collect()}
    for i in range(100, 104):
        words = [dict(rows)[i][s.start:s.end] for s in spans[i] if s.kind == "term"]
        assert words.count("Zorblatt") == 1 and words.count("ZORBLATT") == 1 and "weather" not in words
    assert all(not spans[i] for i in range(60))


def marked(rows):
    return Counter((r.doc_id, tuple((s.start, s.end) for s in r.spans if s.kind == "term")) for r in rows)


@pytest.mark.parametrize("place", ["given", "awkward"])
def test_terms_are_those_of_plain_counting(spark, awkward, place):
    docs = spark.read.parquet(f"{'/root/testdata/sf0.001' if place == 'given' else awkward}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute.private_terms([t for _, t in rows])
    assert marked(pii.private_spans(docs).collect()) == Counter((i, tuple(own)) for (i, _), own in zip(rows, want))


def test_terms_of_documents_that_share_people_and_words(spark):
    """Random shares of entities and words; copies of some texts, which are no evidence."""
    rng = random.Random(30)
    rows = []
    for g in range(60):
        people = rng.sample(range(12), rng.randrange(3))
        own = [f"p{p}.x@mail.example.org Nick{p} {f'mention{p}' * rng.randrange(2)}" for p in people]
        rows.append((g, " ".join([*rng.choices([f"word{i}" for i in range(40)], k=12), *own, f"10.0.{g % 5}.1"])))
    rows += [(100 + i, rows[i][1]) for i in range(0, 60, 7)] + [(200, rows[3][1])] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.private_terms([t for _, t in rows])
    assert any(want)
    assert marked(pii.private_spans(docs).collect()) == Counter((i, tuple(own)) for (i, _), own in zip(rows, want))


def test_copies_are_no_evidence(spark):
    rows = [(i, f"filler words number {i} about the weather and the town") for i in range(60)]
    rows += [(100 + i, "please contact zoltan at z.n@mail.example.org about quokka zeppelin marmalade") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert not any(s.kind == "term" for r in pii.private_spans(docs).collect() for s in r.spans)


@pytest.mark.parametrize("pairs", [1, 1 << 20])
def test_pairs_in_groups_give_the_same(spark, monkeypatch, pairs):
    monkeypatch.setattr(pii, "PAIRS", pairs)
    rows = [(i, f"plain number {i} of the weather") for i in range(40)]
    rows += [(100 + i, f"Ann a.n@mail.example.org Bob b.b@mail.example.org Cyd{i % 2} c{i % 2}@mail.example.org {i}") for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.private_terms([t for _, t in rows])
    assert any(want) and marked(pii.private_spans(docs).collect()) == Counter((i, tuple(own)) for (i, _), own in zip(rows, want))


@pytest.mark.parametrize("values", [[], [5], list(range(1, 400)), [3, 0, 7] * 9000])
def test_sums_before(spark, values):
    df = spark.createDataFrame([(values,)], "v array<long>")
    got = df.select(pii.before(F.col("v")).alias("s"), pii.before(F.col("v"), 2, lambda s, x: F.greatest(s, x)).alias("m")).first()
    sums, top = [0], [0]
    for v in values:
        sums.append(sums[-1] + v)
        top.append(max(top[-1], v))
    assert got.s == sums[:-1] and got.m == top[:-1]


def test_a_text_full_of_matches(spark):
    text = " ".join(f"10.{i % 250}.{i // 250 % 250}.{i % 199} ä{i}@b.c" for i in range(20000))
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.private_spans(docs).collect()}
    counts, joined = brute.spans(text, brute.PRIVATE)
    assert ",".join(f"{s.kind}:{s.start}:{s.end}" for s in got[1]) == joined and not got[2] and not got[3]
    odd = docs.withColumns({"spans": F.lit(1), "__number__": F.lit(2), "key": F.lit("k"), "clean": F.lit(None).cast("string")})
    clean = {r.doc_id: r for r in pii.sanitise(odd).collect()}
    assert clean[1].text == " ".join("[IP] ä[EMAIL]" for _ in range(20000)) and clean[2].text is None and clean[3].text == ""
    assert clean[1]["__number__"] == 2 and clean[1].key == "k"


def test_gradients_of_the_labeller():
    rng = np.random.default_rng(0)
    model = extraction.Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    sizes = np.array([3, 1, 4])
    paths = [list(rng.integers(0, 50, 3)) for _ in range(8)]
    words = [list(rng.integers(0, 50, 2)) for _ in range(8)]
    numbers, labels = rng.normal(size=(8, extraction.NUMBERS)), rng.integers(0, 2, 8).astype(float)
    grad, loss = model.gradients(paths, words, numbers, sizes, labels)
    for name, where in (("xf", (2, 5)), ("hb", (1, 7)), ("cf", (3,)), ("out", (4,)), ("bias", (0,)), ("tags", (int(paths[2][0]), 3)), ("words", (int(words[5][1]), 1)), ("xb", (20, 40))):
        old = model.p[name][where]
        model.p[name][where] = old + 1e-3
        up = model.gradients(paths, words, numbers, sizes, labels)[1]
        model.p[name][where] = old - 1e-3
        down = model.gradients(paths, words, numbers, sizes, labels)[1]
        model.p[name][where] = old
        assert abs((up - down) / 2e-3 - grad[name][where]) < 1e-3, name


PAGE = (
    '<!doctype html><html><head><title>T</title><style>p{}</style></head><body><div class="cookie-banner"><p>We use cookies.</p></div>'
    '<header><a href="/">Site</a><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav></header>'
    '<main><article><h1>The title</h1><p>First &amp; best<b>est</b> paragraph.<p>Second\n\n paragraph.<br>A line.'
    '<div class="advert">Buy now</div><ul><li>One item<li>Another item</ul><form><label>Mail</label><button>Send</button></form>'
    '</article><section class="comments"><h2>Comments</h2><div class="comment"><p>Nice one!</p></div></section></main>'
    '<aside class="sidebar"><p>Related things</p></aside><footer>&copy; someone</footer><script>var a="<p>no</p>"</script></body></html>'
)


@pytest.mark.parametrize("depth", [3, 510, 600, 3000])
def test_text_after_a_deep_part_keeps_its_path(depth):
    page = f"<div id=wrap><article>{'<div>' * depth}<p>deep<b>er</p>{'</div>' * depth}<p>after</p></article><p>out</p></div><p>end</p>"
    paths = {b.text: [t for t, _ in b.path] for b in extraction.leaf_blocks(page)}
    assert paths["after"] == ["div", "article", "p"] and paths["out"] == ["div", "p"] and paths["end"] == ["p"]
    assert paths["deeper"][:2] == ["div", "article"] and len(paths["deeper"]) <= extraction.DEPTH


def test_raw_text_that_never_closes():
    page = "<p>one</p><script>" + "</script " * 40000
    began = time.perf_counter()
    assert [b.text for b in extraction.leaf_blocks(page)] == ["one"]
    assert time.perf_counter() - began < 2


def test_all_words_of_blocks_and_classes_are_read():
    own = [f"w{i}" for i in range(95)]
    _, words, _ = extraction.features([extraction.Block((), " ".join(own), 0.0)], {})
    assert words == [[extraction.hashed(w, extraction.WORD_BITS) for w in own]]
    assert extraction.names('class="' + "a " * 14 + 'sidebar"')[-1] == "sidebar"


def test_main_text_of_an_unseen_layout(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    model = extraction.fit(pages)
    text, blocks, kept = extraction.label_pages(model, [PAGE], {})[0]
    assert text == "The title First & bestest paragraph. Second paragraph. A line. One item Another item"
    assert kept < blocks
