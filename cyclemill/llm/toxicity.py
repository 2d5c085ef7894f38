"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A document is a bag of sentences. A sentence's probability is a logistic function
of hashed word features; a document's is the noisy-or of its sentences, so one bad
sentence is enough and a label of the whole document trains all of them. The fitted
weights then point at the sentences to blame.

The model is fitted in NumPy on at most ``per_label`` labelled rows of either label (a
documented bound), by gradient descent with adaptive steps. Scoring covers whole
texts of all rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemill.llm.common import column, segments
from cyclemill.llm.words import Hasher

BITS = 18
PREFIXES = (4, 5, 6, 7)
PER_LABEL = 2000
SENTENCE_WORDS = 40
LEAST_DOCUMENTS = 3
START = -10.0
KIND = "score double, sentences array<struct<start:int,end:int,score:float>>"
FLAG = 0.5


def small_letters(raw: bytes) -> bytes:
    """Latin capital letters with accents (two bytes, C3 80 to C3 9E) as small ones; A-Z are left to the hasher."""
    if b"\xc3" not in raw:
        return raw
    data = np.frombuffer(raw, dtype=np.uint8).copy()
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = after[data[after] <= 0x9E]
    data[capital] += 0x20
    return data.tobytes()


class Bags:
    """Hashed features of every sentence: each word, and its first bytes as stems."""

    def __init__(self):
        self.hasher = Hasher("alnum", PREFIXES)
        self.ends = np.zeros(256, dtype=bool)
        self.ends[[0x0A, 0x21, 0x2E, 0x3F]] = True  # line end ! . ?

    def __call__(self, texts: list[bytes]):
        """Features (words x kinds), the sentence of each word, sentences of each text, first byte of each sentence."""
        texts = [small_letters(t) for t in texts]
        hashes, first, counts, heads = self.hasher(texts)
        shift = np.uint64(64 - BITS)
        kinds = [(h + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)) * np.uint64(0xD6E8FEB86659FD93) >> shift
                 for k, h in enumerate([hashes, *heads])]
        features = np.stack(kinds, axis=1).astype(np.int32)
        raw = np.frombuffer(b"\x20".join(texts) + b"\x20", dtype=np.uint8)
        stops = segments(self.ends[raw])
        text = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(first)) - np.repeat(segments(counts)[:-1], counts)
        if len(first):
            fresh = (np.diff(stops[first], prepend=-1) != 0) | (place % SENTENCE_WORDS == 0)
            fresh |= np.diff(text, prepend=-1) != 0
            sentence = np.cumsum(fresh) - 1
            starts = first[fresh]
            per_text = np.bincount(text[fresh], minlength=len(counts))
            once = fresh | (np.diff(hashes, prepend=hashes[:1]) != 0)  # a word said over and over counts once
            features, sentence = features[once], sentence[once]
        else:
            sentence, starts, per_text = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(counts), np.int64)
        return features, sentence, per_text, starts


def log_miss(weights: np.ndarray, bias: float, features: np.ndarray, sentence: np.ndarray, n: int):
    """Per sentence: its logit and log of the probability that it is harmless."""
    score = np.zeros(len(features), dtype=np.float64)
    for k in range(features.shape[1]):
        score += weights[features[:, k]]
    logit = np.bincount(sentence, score, minlength=n) + bias
    return logit, -np.logaddexp(0, logit)


class Model:
    """Weights of the hashed features, and the logit of a sentence without any."""

    def __init__(self, weights: np.ndarray, bias: float, base: float):
        self.weights, self.bias, self.base = weights.astype(np.float32), bias, base

    def score(self, bags: Bags, texts: list[bytes], spans: bool = True):
        features, sentence, per_text, starts = bags(texts)
        n = len(starts)
        logit, miss = log_miss(self.weights, self.bias, features, sentence, n)
        bounds = segments(per_text)
        total = np.concatenate(([0.0], np.cumsum(miss)))
        all_miss = total[bounds[1:]] - total[bounds[:-1]]
        score = np.where(per_text > 0, -np.expm1(np.minimum(all_miss, 0.0)), self.base)
        offset = segments([len(t) + 1 for t in texts])
        rows = []
        flagged = np.flatnonzero(logit > math.log(FLAG / (1 - FLAG)))
        owner = np.searchsorted(bounds, flagged, side="right") - 1
        found: dict[int, list] = {}
        chars, last = None, -1
        for s, d in zip(flagged, owner):
            if d != last:  # code points before each byte
                own = np.frombuffer(texts[d], dtype=np.uint8)
                chars, last = segments((own & 0xC0) != 0x80), d
            end = starts[s + 1] if s + 1 < bounds[d + 1] else offset[d + 1] - 1
            found.setdefault(int(d), []).append({
                "start": int(chars[starts[s] - offset[d]]), "end": int(chars[end - offset[d]]),
                "score": float(1 / (1 + math.exp(-min(logit[s], 700)))),
            })
        for d in range(len(texts)):
            rows.append((float(min(1.0, max(0.0, score[d]))), found.get(d, [])))
        return rows


def pieces(texts: list[bytes], size: int = 100):
    return (texts[i:i + size] for i in range(0, len(texts), size))


def fit(rows, counts: tuple[int, int] | None = None, epochs: int = 80, rate: float = 0.3, sparsity: float = 0.3) -> Model:
    """Minimise log loss of the noisy-or over (text, label) rows, plus ``sparsity`` times the absolute weights.

    Most words tell nothing, so most weights come out zero. ``counts`` are the documents labelled 0 and 1 of which the rows are a
    sample: each row weighs as many as it stands for, so that scores and the share of toxic
    documents are those of all labels, whatever was drawn of either.
    """
    texts, labels = [(t or "").encode() for t, _ in rows], np.array([y for _, y in rows], dtype=np.float64)
    drawn = (int((labels == 0).sum()), int((labels == 1).sum()))
    counts = counts or drawn
    share = (counts[1] + 0.5) / (sum(counts) + 1)
    stands = [c / d if d else 1.0 for c, d in zip(counts, drawn)]
    mass = np.where(labels == 1, stands[1], stands[0])
    mass = mass / mass.mean() if len(mass) else mass
    if not len(labels) or labels.min() == labels.max():  # nothing to tell apart: every document gets the share
        return Model(np.zeros(1 << BITS), math.log(share / (1 - share)) - 12, share)
    # A feature of one or two documents only tells them apart from the rest of the sample: none of those is used.
    # The texts are read twice, some at a time, so that only the features in use are held.
    bags = Bags()
    documents = np.zeros(1 << BITS, dtype=np.int32)
    for features, sentence, per_text, _ in map(bags, pieces(texts)):
        owner = np.repeat(np.arange(len(per_text)), per_text)[sentence]
        for k in range(features.shape[1]):
            pair = np.unique(owner << BITS | features[:, k])
            documents += np.bincount(pair & ((1 << BITS) - 1), minlength=1 << BITS).astype(np.int32)
    known = documents >= LEAST_DOCUMENTS
    flats, ats, sentences, offset = [], [], [], 0
    for features, sentence, per_text, starts in map(bags, pieces(texts)):
        fine = known[features]
        flats.append(features[fine])
        ats.append(np.broadcast_to((sentence + offset).astype(np.int32)[:, None], features.shape)[fine])
        sentences.append(per_text)
        offset += len(starts)
    flat, at = np.concatenate(flats), np.concatenate(ats)
    del flats, ats
    owner = np.repeat(np.arange(len(labels), dtype=np.int32), np.concatenate(sentences))
    weights, bias = np.zeros(1 << BITS), START
    seen, bias_seen = np.full(1 << BITS, 1e-4), 1e-4
    for _ in range(epochs):
        logit = np.bincount(at, weights[flat], minlength=offset) + bias
        miss = -np.logaddexp(0, logit)
        total = np.bincount(owner, miss, minlength=len(labels))
        hit = -np.expm1(np.minimum(total, -1e-9))
        # d loss / d logit = p_sentence * (1 - y / p_document)
        p = np.exp(-np.logaddexp(0, -logit))
        g = (mass * np.where(labels == 1, 1 - 1 / np.maximum(hit, 1e-6), 1.0))[owner] * p
        grad = np.bincount(flat, g[at], minlength=1 << BITS)
        seen += grad * grad
        step = rate / np.sqrt(seen)
        weights -= step * grad
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * sparsity, 0)
        bias_grad = float(g.sum())
        bias_seen += bias_grad**2
        bias -= 0.3 * bias_grad / math.sqrt(bias_seen)
    return Model(weights, bias, share)


def train(docs: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """Fit on the texts of ``docs`` whose doc_id has a label (doc_id, label) of 0 or 1.

    At most ``per_label`` rows of either label are used, chosen by a hash of their id;
    of several labels of an id the larger counts. The model is that of all labels, of which the sample's rows are
    weighted shares. Without labelled rows every document scores one half.
    """
    fine = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    one = fine.groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
    whole = {r["label"]: r["n"] for r in one.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [one.filter(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for y in (0, 1)]
    sample = parts[0].unionByName(parts[1])
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # 2 * per_label rows at most
    rows = texts.limit(4 * per_label).collect()
    own = [(r["text"], r["label"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["text"] or ""))]
    return fit(own, (whole.get(0, 0), whole.get(1, 0)))


def toxicity(model: Model, text: str = "text") -> Column:
    """Struct of the score of a whole text and its sentences scored over one half, as spans of code points.

    A null text is empty; an empty one gets the share of toxic documents in training.
    """

    def kernel():
        bags = Bags()
        return lambda texts: model.score(bags, texts)

    return column(kernel, KIND, text)
