"""Language by averaged hashed subword embeddings and a linear softmax.

Subwords are runs of three and four bytes of the lower-cased text, word borders
included, hashed into ``BUCKETS`` rows of embeddings. A text's vector is their mean;
a linear layer and a softmax give the languages. Both are trained by minibatch
stochastic gradient descent in NumPy. After training, the layer is folded into the
embeddings, so a text costs one table look-up for each subword. The temperature and
the rejection threshold are set on rows that the descent has not seen.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclemill.llm.common import column, fresh, segments, written
from cyclemill.sizing import small_side

BITS = 16
SIZES = (3, 4)
DIM = 16
MAX_ROWS = 4000
LEAST_ROWS = 100
KIND = "lang string, score double, rejected boolean"
KEEP = 0.995  # share of right answers that the rejection threshold must let through
STRETCH = 1 << 19


def byte_map() -> np.ndarray:
    """Letters (small ones for A-Z) and non-ASCII bytes as they are, all else as a space."""
    table = np.full(256, 0x20, dtype=np.uint8)
    table[0x61:0x7B] = np.arange(0x61, 0x7B)
    table[0x41:0x5B] = table[0x61:0x7B]
    table[0x80:] = np.arange(0x80, 0x100)
    return table


MAP = byte_map()


def subwords(raw: bytes):
    """Hashed subwords of a text, stretch by stretch; runs that begin with two spaces are left out."""
    data = np.concatenate(([0x20], MAP[np.frombuffer(raw, dtype=np.uint8)], [0x20])).astype(np.uint32)
    for at in range(0, len(data), STRETCH):
        part = data[at:at + STRETCH + max(SIZES) - 1]
        for n in SIZES:
            if len(part) < n or at + n > len(data):
                continue
            key = part[:len(part) - n + 1].copy()
            fine = ~((key == 0x20) & (part[1:len(part) - n + 2] == 0x20))
            for k in range(1, n):
                key |= part[k:len(part) - n + 1 + k] << np.uint32(8 * k)
            last = len(part) - n + 1 if at + STRETCH >= len(data) else STRETCH
            key = key[:last][fine[:last]]
            yield (((key + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int32)


class Model:
    """Languages, the folded table (bucket x language), bias, temperature and rejection threshold."""

    def __init__(self, names, table, bias, temperature=1.0, threshold=0.0):
        self.names, self.table, self.bias = names, table, bias
        self.temperature, self.threshold = temperature, threshold

    def logits(self, raw: bytes) -> np.ndarray:
        total, n = np.zeros(len(self.names)), 0
        for keys in subwords(raw):
            total += self.table[keys].sum(axis=0, dtype=np.float64)
            n += len(keys)
        return total / max(n, 1) + self.bias

    def predict(self, raw: bytes) -> tuple[str, float, bool]:
        if not self.names or not any(map(str.isalpha, raw.decode())):
            return "und", 0.0, True
        z = self.logits(raw) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.names[best], float(p[best]), bool(p[best] < self.threshold)


def fit(rows, epochs: int = 12, batch: int = 64, rate: float = 4.0, seed: int = 11) -> Model:
    """Train on (text, language) rows; every fifth row is kept for the calibration."""
    rows = [(t.encode(), y) for t, y in rows if t and y is not None and any(map(str.isalpha, t))]
    names = sorted({y for _, y in rows})
    if not names:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    number = {y: i for i, y in enumerate(names)}
    label = np.array([number[y] for _, y in rows])
    bags = []
    for raw, _ in rows:
        keys, count = np.unique(np.concatenate(list(subwords(raw))), return_counts=True)
        bags.append((keys, (count / count.sum()).astype(np.float32)))
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, len(names)), np.float32), np.zeros(len(names), np.float32)
    layer += rng.normal(0, 0.1, layer.shape).astype(np.float32)
    held = np.arange(len(rows)) % 5 == 4 if len(rows) >= 50 else np.zeros(len(rows), bool)
    train = np.flatnonzero(~held)
    share = np.bincount(label[train], minlength=len(names))
    cost = (len(train) / np.maximum(share, 1) / len(names)).astype(np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(train)
        for at in range(0, len(order), batch):
            own = order[at:at + batch]
            keys = np.concatenate([bags[i][0] for i in own])
            weight = np.concatenate([bags[i][1] for i in own])[:, None]
            bounds = segments([len(bags[i][0]) for i in own])
            mean = np.add.reduceat(embedding[keys] * weight, bounds[:-1], axis=0)
            z = mean @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(own)), label[own]] -= 1
            p *= cost[label[own]][:, None] / len(own)
            back = p @ layer.T
            layer -= step * (mean.T @ p)
            bias -= step * p.sum(axis=0)
            rows_of = np.repeat(np.arange(len(own)), np.diff(bounds))
            np.subtract.at(embedding, keys, step * len(own) * back[rows_of] * weight)
    model = Model(names, (embedding @ layer).astype(np.float32), bias.astype(np.float64))
    calibrate(model, [(rows[i][0], label[i]) for i in (np.flatnonzero(held) if held.any() else train)])
    return model


def calibrate(model: Model, rows) -> None:
    """Temperature of least log loss, then the confidence that all but a few right answers reach."""
    z = np.array([model.logits(raw) for raw, _ in rows])
    y = np.array([y for _, y in rows])

    def chances(t):
        p = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return p / p.sum(axis=1, keepdims=True)

    grid = 2.0 ** np.linspace(-5, 3, 33)
    loss = [-np.log(np.maximum(chances(t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = chances(model.temperature)
    right = p.argmax(axis=1) == y
    if right.any():
        model.threshold = float(np.quantile(p.max(axis=1)[right], 1 - KEEP))


def train(labelled: DataFrame, key: str = "doc_id", max_rows: int = MAX_ROWS, least_rows: int = LEAST_ROWS) -> Model:
    """Fit on the columns text and lang of a sample by a hash of ``key``.

    Every language has a share of its own: about ``max_rows`` over the number of languages, and ``least_rows`` at least, or all
    its rows if it has fewer. So a language that is learned from a small table is learned from a large one that holds the same rows.
    Rows without a text or a language are left out; without any row every text is ``und``.
    """
    fine = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = written(fine.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    n = counts.count()
    each, share = max(least_rows, max_rows // max(n, 1)), fresh("share")
    some = small_side(counts.select("lang", (F.lit(float(each)) / F.col("n")).alias(share)))
    drawn = fine.select("text", "lang", F.col(key).cast("string").alias("key")).join(some, "lang").filter(
        F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 30)) < F.col(share) * float(1 << 30))
    rows = drawn.select("text", "lang", "key").limit(2 * each * max(n, 1)).collect()
    return fit([(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["key"] or "", r["lang"], r["text"]))])


def language(model: Model, text: str = "text") -> Column:
    """Struct of the language of a whole text, its calibrated probability and whether it is too low to trust.

    ``und``, with score 0, for a null text, one without any letter, and a model without languages.
    """

    def kernel():
        return lambda texts: [model.predict(raw) for raw in texts]

    return column(kernel, KIND, text)
