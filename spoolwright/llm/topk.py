"""Exact top-k inner products by pivot-table elimination.

|q - x|^2 = |q|^2 + |x|^2 - 2 q.x, and by the triangle inequality |q - x| >= max over pivots p of | |q - p| - |x - p| |. Distances of all
rows to the pivots are computed once and stored with the rows; they bound the inner product from above. A query evaluates candidates in
the order of that bound and stops when the next bound is below its k-th best score. Queries and candidates meet in blocks; each block
pair keeps k rows a query.
"""

from __future__ import annotations

import functools
import math
import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import partitions, slices, spill

FIRST, STEP = 256, 1024


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first traversal: the first row, then again and again the row farthest from all chosen."""
    if not len(sample):
        return sample
    chosen, far = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(n, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Of every row to every pivot, from differences, so that their error is relative to the distance."""
    return np.sqrt(np.stack([np.square(v - p).sum(1) for p in pivots], 1)) if len(pivots) else np.zeros((len(v), 0))


def exact_type(q_norm: np.ndarray, c_norm: np.ndarray):
    """The type in which inner products of whole-valued vectors with such squared norms are exact: by Cauchy-Schwarz no partial sum exceeds the product of norms."""
    top = math.sqrt(q_norm.max(initial=0)) * math.sqrt(c_norm.max(initial=0))
    return float if top < 2.0**52 else np.int64 if top < 2.0**62 and max(q_norm.max(), c_norm.max()) < 2.0**124 else object


def as_whole(v: np.ndarray, kind) -> np.ndarray:
    return v if kind is float else v.astype(np.int64) if kind is np.int64 else np.array([int(x) for x in v.ravel().tolist()], object).reshape(v.shape)


def limbs(score: int, n: int) -> list[int]:
    """A whole number as n longs whose order is the number's: the highest first, with the sign."""
    out = []
    for _ in range(n - 1):
        out.append(score & ((1 << 62) - 1))
        score >>= 62
    return [score, *reversed(out)]


def _as_long(n: int):
    """The number that n limbs in the column score stand for; null where no long holds it."""
    of = lambda i: F.col("score")[i]
    low, next_, high = of(n - 1), of(n - 2), [of(i) for i in range(n - 2)]
    # a long has 63 bits and a sign: one bit of the limb above the lowest, and of all others only the sign
    if n == 2:
        fits, two = next_.between(-2, 1), next_
    else:
        plus = functools.reduce(operator.and_, [h == 0 for h in high]) & next_.between(0, 1)
        minus = functools.reduce(operator.and_, [(h == -1) if i == 0 else (h == (1 << 62) - 1) for i, h in enumerate(high)]) & (next_ >= (1 << 62) - 2)
        fits, two = plus | minus, F.when(of(0) < 0, next_ - F.lit(1 << 61) - F.lit(1 << 61)).otherwise(next_)
    # two * 2^62 + low, without a step that leaves the range of longs
    return F.when(fits, F.when(two == 1, low - F.lit(-(1 << 62))).when(two == 0, low).when(two == -1, low - F.lit(1 << 62)).otherwise(low - F.lit(1 << 62) - F.lit(1 << 62)))


def best_of_block(q_rows, q, q_far, c_rows, c_ids, c, c_far, k: int) -> tuple[list, list, list, int]:
    """The k best candidates of one block for each query: (query rows, places of candidates, scores), ties to the smaller id, then row; and how many were evaluated.

    Rows are numbered, and a query is no candidate of its own. q_far and c_far are distances to the pivots. Bounds are doubles, with more
    slack than their roundings; scores are whole numbers of a type that holds them. Where a norm nears the end of doubles, all are evaluated.
    """
    out_q, out_c, out_s, evaluated = [], [], [], 0
    order = np.lexsort((c_rows, c_ids))
    c_rows, c = c_rows[order], c[order]
    with np.errstate(over="ignore"):
        c_norm, q_norm, table = (c * c).sum(1), (q * q).sum(1), c_far[order].T.copy()
    kind, bounded = exact_type(q_norm, c_norm), max(c_norm.max(initial=0), q_norm.max(initial=0)) < 1e290
    q_whole, c_whole = as_whole(q, kind), as_whole(c, kind)
    for i in range(len(q_rows)):
        low = np.zeros(len(c_rows))
        for p in range(len(table) if bounded else 0):
            np.maximum(low, np.abs(table[p] - q_far[i, p]), out=low)
        low -= 1e-6 * (1 + low)  # roundings of the distances can't cost a result
        bound = (q_norm[i] + c_norm - np.square(np.maximum(low, 0))) / 2 if bounded else np.zeros(len(c_rows))
        bound[c_rows == q_rows[i]] = -np.inf
        live = int(np.isfinite(bound).sum())
        keep_i, keep_s, done = np.empty(0, np.int64), np.empty(0, kind), 0
        size, ranked, at, edge = min(FIRST, live), np.empty(0, np.int64), 0, np.inf
        while done < live:
            if at == len(ranked):  # the next rows are those below all that were ranked before, with all that tie with their last one
                want, above = min(live, max(4 * (done + size), FIRST)), edge
                edge = -np.partition(-bound, want - 1)[want - 1]
                ranked, at = np.flatnonzero((bound >= edge) & (bound < above)), 0
                ranked = ranked[np.argsort(-bound[ranked])]
            if len(keep_i) >= k and bounded:
                kth = float(keep_s.min())
                if bound[ranked[at]] < kth - 1e-6 * (1 + abs(kth)):
                    break
            now = ranked[at : at + size]
            score = c_whole[now] @ q_whole[i] if kind is not object else np.array([sum(map(operator.mul, x, q_whole[i])) for x in c_whole[now]], object)
            keep_i, keep_s = np.concatenate([keep_i, now]), np.concatenate([keep_s, score])
            if len(keep_i) > k:
                top = np.lexsort((keep_i, -keep_s))[:k] if kind is not object else sorted(range(len(keep_i)), key=lambda j: (-keep_s[j], keep_i[j]))[:k]  # noqa: B023
                keep_i, keep_s = keep_i[top], keep_s[top]
            at, done, size = at + len(now), done + len(now), STEP
        evaluated += done
        out_q.append(np.full(len(keep_i), q_rows[i]))
        out_c.append(order[keep_i])
        out_s.append(keep_s)
    return out_q, out_c, out_s, evaluated


def top_k(rows: DataFrame, queries, k: int = 20, n_pivots: int = 16, sample_rows: int = 512, query_block: int = 8192, block_rows: int = 40_000) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows by inner product for each query; the query's own row is no candidate of it.

    rows: vec_id and v (array of whole-valued doubles). queries: a condition that picks the query rows. Scores are exact whole numbers
    whatever the size of components: doubles up to 2^52, then 64-bit and Python integers; ranks go by them, and a score that no long holds is null. Vectors that are null, or hold
    null or non-finite components, take no part; nor do rows with a null vec_id. Equal scores go to the smaller vec_id. Rows that repeat
    a vec_id are rows of their own: each is a candidate of the others, and each query row has its own ranks. Vectors of different
    lengths have no inner product, so each length is searched on its own; empty vectors have scores of 0 with one another. A table with
    one row, or none, gives no rows. Pivots come from a sample of at most sample_rows rows; they steer the order of work, not the results.
    """
    spark = rows.sparkSession
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "v", F.size("v").alias("dim"), queries.alias("is_query"))
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).collect()
    pivots = {d: choose_pivots(np.array([r.v for r in picked if r.dim == d], float), n_pivots) for d in {r.dim for r in picked}}
    shared = spark.sparkContext.broadcast(pivots)  # at most sample_rows rows, n_pivots a length

    def with_distances(batches):
        for batch in batches:
            for part in slices(batch, 4096):
                lists = part.column("v")
                ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
                sizes, far = np.diff(ends), [None] * part.num_rows
                for size in np.unique(sizes).tolist():
                    at = np.flatnonzero(sizes == size)
                    v = flat[ends[at][:, None] + np.arange(size)].reshape(len(at), size)
                    with np.errstate(over="ignore"):
                        found = distances(v, shared.value[size]) if size in shared.value else np.zeros((len(at), 0))
                    for i, f in zip(at.tolist(), found, strict=True):
                        far[i] = f
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(far, pa.list_(pa.float64()))], [*part.schema.names, "far"])

    rows = rows.withColumn("row", F.monotonically_increasing_id())
    rows = spill(rows.mapInArrow(with_distances, "vec_id long, v array<double>, dim int, is_query boolean, row long, far array<double>"), "pivot_table")
    n, nq, top = rows.agg(F.count("*"), F.count_if("is_query"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x))))).first()
    widest = rows.agg(F.max("dim")).first()[0] or 1
    n_limbs = 1 + (2 * int(top or 0).bit_length() + int(widest).bit_length()) // 62  # of every score of this table
    lanes = max(1, math.ceil(n / block_rows))
    blocks = max(1, math.ceil(nq / query_block), min(math.ceil(partitions(spark) / lanes), nq // 64))  # as few copies as give all tasks work
    lane, block = F.pmod(F.xxhash64("row"), F.lit(lanes)).cast("long"), F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("long")
    candidates = rows.select("dim", lane.alias("lane"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "row", "vec_id", "v", "far")
    asked = rows.where("is_query").select("dim", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"), block.alias("block"), "row", "vec_id", "v", "far")
    schema = "query_row long, query_id long, row long, vec_id long, score array<long>"

    def search(key, left: pa.Table, right: pa.Table) -> pa.Table:
        def read(t):
            wide = lambda c: t[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1) if t.num_rows and len(t[c][0]) else np.zeros((t.num_rows, 0))
            return t["row"].to_numpy(), t["vec_id"].to_numpy(), wide("v"), wide("far")

        (q_rows, q_ids, q, q_far), (c_rows, c_ids, c, c_far) = read(left), read(right)
        a, b, s, _ = best_of_block(q_rows, q, q_far, c_rows, c_ids, c, c_far, k) if len(q_rows) and len(c_rows) else ([], [], [], 0)
        a, b = (np.concatenate([np.empty(0, np.int64), *x]).astype(np.int64) for x in (a, b))
        s = [limbs(int(x), n_limbs) for of in s for x in of.tolist()]
        id_of = dict(zip(q_rows.tolist(), q_ids.tolist(), strict=True))
        return pa.table({"query_row": a, "query_id": pa.array([id_of[i] for i in a.tolist()], pa.int64()), "row": c_rows[b] if len(b) else b, "vec_id": c_ids[b] if len(b) else b, "score": pa.array(s, pa.list_(pa.int64()))})

    near = asked.groupBy("dim", "lane", "block").cogroup(candidates.groupBy("dim", "lane", "block")).applyInArrow(search, schema)
    best = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id", "row")
    out = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    score = F.col("score")[0] if n_limbs == 1 else _as_long(n_limbs)
    return out.select("query_id", "rank", "vec_id", score.alias("score"))
