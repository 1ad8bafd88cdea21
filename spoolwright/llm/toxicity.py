"""Toxicity by subword bags: hashed character n-gram embeddings, averaged into a linear softmax, trained jointly in numpy.

A word is the mean of the embeddings of its n-grams, and a window of words the mean of its words; unseen misspellings share n-grams with
what was seen. Windows overlap by half, and a text's score is that of its most toxic window, so that length does not thin it out. An
n-gram's embedding is scaled by how unevenly the two classes hold it, smoothed, so that rare and common ones tell little and none is
left out. As the softmax is linear in the average, a word adds one number to a window, which workers keep for recent words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import slices, spill, words_of, working_for

#: HALF: words of half a window. SMOOTH: occurrences that every n-gram is taken to have besides its own. STRONG: log odds from which an n-gram counts in full.
BUCKETS, DIM, N_GRAMS, HALF, SMOOTH, STRONG = 1 << 20, 8, (4, 6, 8), 24, 5.0, 3.0
#: Most labelled documents of class 0 and of class 1 that training takes, those with the least hash, and most bytes of their texts for each class.
MOST_ROWS, MOST_BYTES = (3000, 1500), (24 << 20, 12 << 20)


def ngrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and word number of every n-gram of the words, each between marks of its start and end."""
    data = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lengths)
    out_b, out_w = [], []
    for n in N_GRAMS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        inside = np.flatnonzero(owner[:m] == owner[n - 1 : n - 1 + m])
        h = np.full(m, n, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + data[k : k + m]
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        out_b.append((h[inside] >> np.uint64(44)).astype(np.int64))
        out_w.append(owner[inside])
    return (np.concatenate(out_b), np.concatenate(out_w)) if out_b else (np.empty(0, np.int64),) * 2


def word_scores(words: list[bytes], gram_scores: np.ndarray) -> np.ndarray:
    b, w = ngrams(words)
    n = np.bincount(w, minlength=len(words))
    return np.bincount(w, gram_scores[b], len(words)) / np.maximum(n, 1)


def halves(n: int) -> np.ndarray:
    """Starts of the halves of a text's windows: as few as are needed, of nearly equal length."""
    k = max(1, -(-n // HALF))
    return np.arange(k) * n // k


def _move(x: np.ndarray, dx: np.ndarray, m: list[np.ndarray], step: int, rate: float) -> None:
    """A step of Adam, in place."""
    m[0] += 0.1 * (dx - m[0])
    m[1] += 0.01 * (dx * dx - m[1])
    x -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-8)


def train(texts: list[str], labels: np.ndarray, steps: int = 80, rate: float = 0.3, decay: float = 1e-6, warm: int = 20, seed: int = 7) -> tuple[np.ndarray, float]:
    """Scores of the n-gram buckets and the bias: embeddings and softmax learned together by Adam, the loss taken at each text's top window."""
    g = np.random.default_rng(seed)
    y = np.asarray(labels, float)
    scores = np.zeros(BUCKETS, np.float32)
    if not len(texts) or y.min() == y.max():
        return scores, (-6.0 if not len(y) or y[0] == 0 else 6.0)
    index: dict[bytes, int] = {}
    flat, half, owner, n_half = [], [], [], 0
    for d, t in enumerate(texts):
        words = words_of(t)
        starts = halves(len(words))
        flat.append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int32, len(words)))
        half.append(np.repeat(np.arange(n_half, n_half + len(starts), dtype=np.int32), np.diff(np.append(starts, len(words)))))
        owner += [d] * len(starts)
        n_half += len(starts)
    held_by = np.zeros((2, len(index)))  # documents of each class that hold a word
    for ids, label in zip(flat, y, strict=True):
        held_by[int(label), np.unique(ids)] += 1
    flat, half, owner = np.concatenate(flat), np.concatenate(half), np.array(owner)
    words, n_words, part = list(index), len(index), 50_000
    del index
    occurs, grams_of, held = np.zeros((2, BUCKETS)), np.ones(n_words), []
    for at in range(0, n_words, part):
        b, w = ngrams(words[at : at + part])
        n = len(words[at : at + part])
        for c in (0, 1):
            occurs[c] += np.bincount(b, held_by[c, at + w], BUCKETS)
        grams_of[at : at + n] = np.maximum(np.bincount(w, minlength=n), 1)
        held.append((at, n, b.astype(np.int32), w.astype(np.int32)))
    del words
    seen = np.flatnonzero(occurs.sum(0))
    place = np.zeros(BUCKETS, np.int32)
    place[seen] = np.arange(len(seen))
    held = [(at, n, place[b], w) for at, n, b, w in held]
    prior = SMOOTH * occurs.sum(1) / max(occurs.sum(), 1)
    odds = np.log((occurs[1, seen] + prior[1]) / (occurs[0, seen] + prior[0]) * ((prior[0] + 1e-9) / (prior[1] + 1e-9)))
    scale = np.square(np.minimum(np.abs(odds), STRONG) / STRONG)
    del occurs, odds
    # a window is two neighbouring halves of a text, or its only one
    paired = np.append(owner[1:] == owner[:-1], False)
    left = np.flatnonzero(paired | (np.bincount(owner)[owner] == 1))
    right, both = np.minimum(left + 1, n_half - 1), paired[left]
    in_half = np.bincount(half, minlength=n_half)
    size, text = np.maximum(in_half[left] + both * in_half[right], 1), owner[left]
    first = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
    emb, soft, bias = g.normal(0, 0.01, (len(seen), DIM)), g.normal(0, 0.3, (2, DIM)), np.zeros(2)
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (emb, soft, bias)]
    for step in range(1, steps + 1):
        v = soft[1] - soft[0]
        gram = (emb @ v) * scale
        word = np.concatenate([np.bincount(w, gram[b], n) for _, n, b, w in held]) / grams_of
        total = np.bincount(half, word[flat], n_half)
        logit = (total[left] + both * total[right]) / size + bias[1] - bias[0]
        if step <= warm:  # at first every window, as none stands out yet
            share = 1.0 / np.diff(np.append(first, len(left)))[text]
        else:
            share = (logit == np.maximum.reduceat(logit, first)[text]).astype(float)
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        d_logit = share * (p - y[text]) / len(y)
        d_half = np.bincount(left, d_logit / size, n_half) + np.bincount(right, both * d_logit / size, n_half)
        d_word = np.bincount(flat, d_half[half], n_words) / grams_of
        d_gram = np.zeros(len(seen))
        for at, n, b, w in held:  # only the words of top windows have a gradient
            moved = (d_word[at : at + n] != 0)[w]
            d_gram += np.bincount(b[moved], d_word[at : at + n][w[moved]], len(seen))
        d_gram *= scale
        d_v = emb.T @ d_gram
        # n-grams in pieces, as what a step holds beside its parameters would otherwise be several times their size
        pieces = [slice(at, at + (1 << 16)) for at in range(0, len(emb), 1 << 16)]
        for s in pieces:
            _move(emb[s], np.outer(d_gram[s], v) + decay * emb[s], [m[s] for m in moments[0]], step, rate)
        _move(soft, np.stack([-d_v, d_v]), moments[1], step, rate)
        _move(bias, np.array([-d_logit.sum(), d_logit.sum()]), moments[2], step, rate)
    scores[seen] = (emb @ (soft[1] - soft[0])) * scale
    return scores, float(bias[1] - bias[0])


class Scorer:
    def __init__(self, gram_scores: np.ndarray, bias: float, most: int = 400_000):
        self.gram_scores, self.bias, self.most, self.known = gram_scores, bias, most, {}

    def scores(self, texts: list[str | None]) -> list[float]:
        lists = [words_of(t) for t in texts]
        if len(self.known) > self.most:
            self.known = {}
        new = list({w for ws in lists for w in ws}.difference(self.known))
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            self.known.update(zip(part, word_scores(part, self.gram_scores).tolist(), strict=True))
        out = []
        for ws in lists:
            if not ws:
                out.append(self.bias)
                continue
            s = np.fromiter(map(self.known.__getitem__, ws), float, len(ws))
            starts = halves(len(ws))
            total, n = np.add.reduceat(s, starts), np.diff(np.append(starts, len(ws)))
            if len(starts) > 1:
                total, n = total[1:] + total[:-1], n[1:] + n[:-1]
            out.append(float((total / n).max()) + self.bias)
        return (1 / (1 + np.exp(-np.clip(out, -30, 30)))).tolist()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, most: tuple[int, int], most_bytes: tuple[int, int] = MOST_BYTES) -> list:
    """At most so many rows (text, y) of class 0 and of class 1, of those that are not held out, least hash first; conflicting or null labels are left out.

    Texts are whole; a row whose text would exceed the bytes of its class is passed over, so what reaches the driver is bounded.
    """
    y = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1)).groupBy("doc_id").agg(F.min(column).alias("y"), F.max(column).alias("y2")).where("y = y2").select(F.col("doc_id").alias("labelled"), "y")
    y = y.where(~held_out(F.col("labelled"))).withColumn("h", F.xxhash64("labelled"))
    ids = [r for c in (0, 1) for r in y.where(F.col("y") == c).orderBy("h", "labelled").limit(most[c]).collect()]
    picked = docs.sparkSession.createDataFrame([(r.labelled, r.y, r.h) for r in ids], "labelled long, y int, h long")
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("labelled")).where("text is not null")
    rows = spill(rows.groupBy("labelled").agg(F.first("y").alias("y"), F.first("h").alias("h"), F.min("text").alias("text")), "labelled")
    room, kept = list(most_bytes), []
    for r in sorted(rows.select("labelled", "y", "h", F.octet_length("text").alias("n")).collect(), key=lambda r: (r.h, r.labelled)):
        if r.n <= room[r.y]:
            room[r.y] -= r.n
            kept.append(r.labelled)
    chosen = docs.sparkSession.createDataFrame([(i,) for i in kept], "labelled long")
    return sorted(rows.join(F.broadcast(chosen), "labelled", "left_semi").collect(), key=lambda r: (r.h, r.labelled))


def fit(docs: DataFrame, labels: DataFrame, most: tuple[int, int] = MOST_ROWS) -> tuple[np.ndarray, float]:
    rows = labelled_sample(docs, labels, "toxic", most)
    return train([r.text for r in rows], np.array([r.y for r in rows]))


def _mapped(docs: DataFrame, model, names: list[str], schema: str, keep) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # BUCKETS numbers

    def run(batches):
        working_for("toxicity")
        scorer = Scorer(*shared.value)
        for batch in batches:
            for part in slices(batch, 512):
                yield keep(part, pa.array(scorer.scores(part.column("text").to_pylist()), pa.float64()))

    return docs.mapInArrow(run, schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, most: tuple[int, int] = MOST_ROWS) -> DataFrame:
    """One row per row of docs: doc_id, held_out, score, predicted (score >= 0.5).

    Only rows that are not held out teach, at most `most` of class 0 and of class 1. Null texts and texts without words get the score of the bias alone. A null doc_id is not
    held out, and has no label. Without labels, or with one class only, all scores are the same. Repeated rows get equal scores.
    """
    model = fit(docs, labels, most)
    kind = docs.schema["doc_id"].dataType.simpleString()
    ids = docs.select("doc_id", "text")
    scored = _mapped(ids, model, [], f"doc_id {kind}, score double", lambda part, s: pa.RecordBatch.from_arrays([part.column("doc_id"), s], ["doc_id", "score"]))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, most: tuple[int, int] = MOST_ROWS) -> DataFrame:
    """The rows of docs, with their columns, whose score is below 0.5."""
    model = fit(docs, labels, most)
    return _mapped(docs, model, docs.columns, docs.schema, lambda part, s: part.filter(pa.compute.less(s, 0.5)))
