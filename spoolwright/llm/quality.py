"""Quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded by a small network from its words, hashed, and its measures; gated attention (Ilse et al. 2018) weighs
the passages, and the weighted representation is scored. Weights are learned from document labels alone, in numpy.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import slices, working_for
from .toxicity import held_out, labelled_sample

PASSAGE_WORDS, HIDDEN, GATES = 128, 16, 8
#: Most labelled documents of class 0 and of class 1 that training takes.
MOST_ROWS = (2000, 2000)
#: Byte classes of a passage: capitals, small letters, digits, line breaks, other space, stops and commas, bars and slashes, marks, non-ASCII, other ASCII.
_CLASS = np.zeros(256, np.uint8)
for _n, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), b"\r\n", b" \t\v\f", b".,;:'", b"|/\\_-", b"!?")):
    _CLASS[list(_bytes)] = _n + 1
_CLASS[128:] = 9
N_CLASSES = 10
#: Words are hashed to so many buckets; a passage's share of a bucket enters by its root.
BUCKETS = 128
MEASURES = N_CLASSES + 5
FEATURES = MEASURES + BUCKETS
#: Buckets of words that a worker has met, so many at most.
_known: dict[bytes, int] = {}
MOST_KNOWN = 400_000


def buckets(words: list[bytes]) -> np.ndarray:
    """The bucket of every word, ASCII capitals lowered."""
    if len(_known) > MOST_KNOWN:
        _known.clear()
    for w in set(words).difference(_known):
        _known[w] = zlib.crc32(w.lower()) % BUCKETS
    return np.fromiter(map(_known.__getitem__, words), np.int64, len(words))


def passages(text: str | None) -> np.ndarray:
    """Every passage of 128 words, over the whole text, white space behind them included: shares of byte classes, words' length, repetition, variety,
    stops at words' ends, long words, and the words themselves by bucket. A text without words is one passage of zeros."""
    raw = (text or "").encode()
    words = raw.split()
    if not words:
        return np.zeros((1, FEATURES))
    kinds = _CLASS[np.frombuffer(raw, np.uint8)]
    space = (kinds == 4) | (kinds == 5)
    begins = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))[::PASSAGE_WORDS]
    begins[0] = 0  # white space before the first word is its passage's
    starts = np.arange(0, len(words), PASSAGE_WORDS)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    n = np.diff(np.append(starts, len(words)))
    size = np.diff(np.append(begins, len(raw)))
    owner = np.repeat(np.arange(len(starts)), size)
    counts = np.bincount(owner * N_CLASSES + kinds, minlength=len(starts) * N_CLASSES).reshape(-1, N_CLASSES)
    again = np.fromiter((a == b for a, b in zip(words, words[1:], strict=False)), np.int64, len(words) - 1)
    again = np.add.reduceat(np.append(again, 0), starts)
    last = _CLASS[np.frombuffer(b"".join(w[-1:] for w in words), np.uint8)]
    ends = np.add.reduceat(((last == 6) | (last == 8)).astype(np.int64), starts)
    variety = np.array([len(set(words[s : s + PASSAGE_WORDS])) for s in starts])
    long_words = np.add.reduceat((lengths > 20).astype(np.int64), starts)
    of = np.repeat(np.arange(len(starts)), n)
    lexical = np.sqrt(np.bincount(of * BUCKETS + buckets(words), minlength=len(starts) * BUCKETS).reshape(-1, BUCKETS) / n[:, None])
    return np.column_stack([counts / size[:, None], np.add.reduceat(lengths, starts) / n / 10, again / n, variety / n, ends / n, long_words / n, lexical])


def _softmax(x: np.ndarray, first: np.ndarray, owner: np.ndarray) -> np.ndarray:
    e = np.exp(x - np.maximum.reduceat(x, first)[owner])
    return e / np.add.reduceat(e, first)[owner]


class Attention:
    """tanh encoder, gated attention, logistic score. Parameters: mean, scale of measures; A, a; V, U, w; c, b."""

    def __init__(self, parameters: dict):
        self.p = parameters

    def forward(self, x: np.ndarray, first: np.ndarray, owner: np.ndarray):
        p = self.p
        z = np.clip((x - p["mean"]) / p["scale"], -5, 5)
        h = np.tanh(z @ p["A"] + p["a"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        alpha = _softmax((t * s) @ p["w"], first, owner)
        bag = np.add.reduceat(alpha[:, None] * h, first)
        return z, h, t, s, alpha, bag, bag @ p["c"] + p["b"][0]

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        n = np.array([len(b) for b in bags])
        logit = self.forward(np.concatenate(bags), np.cumsum(n) - n, np.repeat(np.arange(len(n)), n))[-1]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def train(bags: list[np.ndarray], labels, steps: int = 400, rate: float = 0.02, seed: int = 11) -> Attention:
    g = np.random.default_rng(seed)
    y = np.asarray(labels, float)
    p = {"mean": np.zeros(FEATURES), "scale": np.ones(FEATURES), "A": g.normal(0, 1 / np.sqrt(FEATURES), (FEATURES, HIDDEN)), "a": np.zeros(HIDDEN), "V": g.normal(0, 0.3, (HIDDEN, GATES)), "U": g.normal(0, 0.3, (HIDDEN, GATES)), "w": g.normal(0, 0.3, GATES), "c": np.zeros(HIDDEN), "b": np.zeros(1)}
    if not len(y) or y.min() == y.max():
        p["b"][0] = 0.0 if not len(y) else 6.0 * (2 * y[0] - 1)
        return Attention(p)
    x = np.concatenate(bags)
    n = np.array([len(b) for b in bags])
    first, owner = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
    p["mean"], p["scale"] = x.mean(0), x.std(0) + 1e-3
    model, names = Attention(p), ["A", "a", "V", "U", "w", "c", "b"]
    moments = {k: (np.zeros_like(p[k]), np.zeros_like(p[k])) for k in names}
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))  # both classes weigh the same
    for step in range(1, steps + 1):
        z, h, t, s, alpha, bag, logit = model.forward(x, first, owner)
        d = weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y)
        d_bag = np.outer(d, p["c"])[owner]
        d_h = alpha[:, None] * d_bag
        d_alpha = (d_bag * h).sum(1)
        d_e = alpha * (d_alpha - np.add.reduceat(alpha * d_alpha, first)[owner])
        d_ts = np.outer(d_e, p["w"])
        d_t, d_s = d_ts * s * (1 - t * t), d_ts * t * s * (1 - s)
        d_h = (d_h + d_t @ p["V"].T + d_s @ p["U"].T) * (1 - h * h)
        grads = {"A": z.T @ d_h, "a": d_h.sum(0), "V": h.T @ d_t, "U": h.T @ d_s, "w": (t * s).T @ d_e, "c": bag.T @ d, "b": np.array([d.sum()])}
        for k in names:
            m, v = moments[k]
            dx = grads[k] + 1e-5 * p[k]
            m += 0.1 * (dx - m)
            v += 0.01 * (dx * dx - v)
            p[k] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def score_quality(docs: DataFrame, labels: DataFrame, most: tuple[int, int] = MOST_ROWS, threshold: float = 0.3) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted (score >= threshold).

    Only rows that are not held out teach, at most `most` of class 0 and of class 1. Null texts and texts without words are one passage of zeros. A
    null doc_id is not held out and has no label. Without labels, or with one class only, all scores are the same. Repeated rows get equal
    scores; an empty table gives no rows. A labelled row whose text would exceed the bytes that its class may have is passed over in training.
    """
    rows = labelled_sample(docs, labels, "quality", most)
    model = docs.sparkSession.sparkContext.broadcast(train([passages(r.text) for r in rows], [r.y for r in rows]).p)

    def run(batches):
        working_for("quality", _known.clear)
        m = Attention(model.value)
        for batch in batches:
            for part in slices(batch, 512):
                if part.num_rows:
                    scores = m.scores([passages(t) for t in part.column("text").to_pylist()])
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
