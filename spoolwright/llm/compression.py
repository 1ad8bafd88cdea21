"""Product codes of vectors, with nearest entries found by annular norm pruning.

Components become whole numbers, floor(scale * x); a vector is cut into equal consecutive parts, and every part position has a codebook.
An entry e within distance d of x has a norm in [|x| - d, |x| + d]. Entries are sorted by norm; the few nearest in norm give a first best
distance, a binary search finds the annulus that it allows, both ends included, and only that annulus is evaluated, in whole numbers.
Rounds of training send one partial sum per component and task to a shuffle; the driver holds the codebooks and nothing else.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import slices, spill

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Entries nearest in norm that give the first best distance; rows evaluated together.
SEEDS, BLOCK = 8, 8192
#: Partial sums travel in limbs of so many bits, so that sums of any size are exact.
LIMB = 56
#: Sums of so many labels are broadcast at most; more are joined by a shuffle, rows dealt over SALTS.
BROADCAST_ROWS, SALTS = 200_000, 16

Books = dict[int, np.ndarray]  # length of vectors -> (parts, entries, length of a part), whole numbers


def _fits(top, length: int) -> bool:
    """Whether squared distances of vectors with such components stay within 61 bits."""
    return 4 * max(length, 1) * top * top < 1 << 61


def whole(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite doubles: int64 where squared distances of such vectors stay in 62 bits, else Python integers."""
    with np.errstate(over="ignore"):
        v = np.floor(scale * values)
    top = float(np.abs(v).max()) if v.size else 0.0
    if _fits(top, v.shape[-1]):
        return v.astype(np.int64)
    exact = [int(math.floor(scale * x)) if abs(x) < 2**40 else scale * int(x) if x == int(x) else math.floor(scale * x) for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def _squares(x: np.ndarray) -> np.ndarray:
    return (x * x).sum(-1)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(index, squared distance) of the nearest entry of each row, ties to the lower index; and how many distances were evaluated.

    x: rows, entries: codebook, both whole-numbered. Python integers, of which norms may exceed a double, are all evaluated.
    """
    n, k = len(x), len(entries)
    if x.dtype == object or entries.dtype == object:
        pick, best = np.zeros(n, np.int64), np.zeros(n, object)
        for i in range(n):
            far = [sum(int(d) ** 2 for d in row) for row in (x[i] - entries)]
            best[i] = min(far)
            pick[i] = far.index(best[i])
        return pick, best, n * k
    norms = np.sqrt(_squares(entries).astype(float))
    order = np.argsort(norms, kind="stable")
    norms, sorted_entries = norms[order], entries[order]
    pick, best, evaluated = np.empty(n, np.int64), np.empty(n, np.int64), 0
    for at in range(0, n, BLOCK):
        rows = x[at : at + BLOCK]
        norm = np.sqrt(_squares(rows).astype(float))
        first = np.clip(np.searchsorted(norms, norm) - SEEDS // 2, 0, max(k - SEEDS, 0))
        seeds = np.minimum(first[:, None] + np.arange(min(SEEDS, k)), k - 1)
        d = np.sqrt(_squares(rows[:, None, :] - sorted_entries[seeds]).min(1).astype(float))
        slack = 1e-9 * (1 + norm + d)  # roundings of the roots can't cost an entry
        lo = np.searchsorted(norms, norm - d - slack, "left")
        size = np.searchsorted(norms, norm + d + slack, "right") - lo  # at least one: the seed itself
        start = np.cumsum(size) - size
        who = np.repeat(np.arange(len(rows)), size)
        cand = np.arange(len(who)) - start[who] + lo[who]
        far = _squares(rows[who] - sorted_entries[cand])
        best[at : at + BLOCK] = low = np.minimum.reduceat(far, start)
        pick[at : at + BLOCK] = np.minimum.reduceat(np.where(far == low[who], order[cand], k), start)
        evaluated += len(who) + seeds.size
    return pick, best, evaluated


def assign(v: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(indexes, squared distances), each rows by parts, of whole vectors against the codebooks of their length."""
    width = book.shape[2]
    found = [nearest(v[:, p * width : (p + 1) * width], book[p])[:2] for p in range(len(book))]
    return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def padded(v: np.ndarray, parts: int) -> np.ndarray:
    """Zeros added up to a multiple of the number of parts; they change no distance."""
    short = -v.shape[1] % parts
    return np.concatenate([v, np.zeros((len(v), short), v.dtype)], 1) if short else v


def usable(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is not null and holds no null and no non-finite component."""
    return rows.where(F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))))


def _by_length(batch, parts: int, scale: int):
    """(length, places in the batch, whole vectors) of a batch with columns v."""
    for part in slices(batch, 4096):
        lists = part.column("v")
        lengths = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(lengths) - lengths
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            values = flat[starts[at][:, None] + np.arange(n)].reshape(len(at), n)
            yield part, n, at, padded(whole(values.astype(float), scale), parts)


def _limbs(total: int):
    """(limb, value) of a whole number, without zeros; the highest limb carries the sign."""
    limb = 0
    while total:
        low = total if -(1 << LIMB) < total < (1 << LIMB) else total & ((1 << LIMB) - 1)
        if low:
            yield limb, low
        total, limb = (total - low) >> LIMB, limb + 1


def train(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Books:
    """Codebooks by length of vectors. rows: vec_id and v (array of finite doubles).

    Codebooks start as the parts of the vectors with the smallest vec_ids, null ones last, ties by the vector; fewer vectors give fewer
    entries. A round assigns every vector and replaces each entry by floor(sum / count) of its parts; unused entries stay. Every distinct
    length has codebooks of its own, one that parts does not divide is padded with zeros, and a table without vectors has none.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must fit a byte")
    spark = rows.sparkSession
    lengths = [r.n for r in rows.select(F.size("v").alias("n")).distinct().collect()]
    books: Books = {}
    for n in sorted(lengths):
        first = rows.where(F.size("v") == n).orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
        v = padded(whole(np.array([r.v for r in first], float).reshape(len(first), n), scale), parts)
        books[n] = v.reshape(len(first), parts, -1).transpose(1, 0, 2).copy() if v.shape[1] else np.zeros((parts, len(first), 0), np.int64)
    for _ in range(rounds if books else 0):
        shared = spark.sparkContext.broadcast(books)

        def sums(batches, shared=shared):
            total: dict[int, list[dict]] = {}
            for batch in batches:
                for _, n, _, v in _by_length(batch, parts, scale):
                    pick, _ = assign(v, shared.value[n])
                    width = v.shape[1] // parts
                    mine = total.setdefault(n, [{} for _ in range(parts)])
                    for p in range(parts):
                        for e in np.unique(pick[:, p]).tolist():
                            of = v[pick[:, p] == e, p * width : (p + 1) * width]
                            add = [len(of), *(int(x) for x in of.sum(0))]
                            mine[p][e] = [a + b for a, b in zip(mine[p].get(e, [0] * len(add)), add, strict=True)]
            out = [(n, p, e, i, limb, x) for n, mine in total.items() for p, of in enumerate(mine) for e, row in of.items() for i, t in enumerate(row) for limb, x in _limbs(t)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if j == 5 else pa.int32()) for j, c in enumerate(zip(*out, strict=True))], ["n", "part", "entry", "i", "limb", "value"])

        found = rows.select("v").mapInArrow(sums, "n int, part int, entry int, i int, limb int, value long")
        found = found.groupBy("n", "part", "entry", "i", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
        total: dict[tuple, int] = {}
        for r in found.collect():  # components of all codebooks, whatever the number of rows
            key = (r.n, r.part, r.entry, r.i)
            total[key] = total.get(key, 0) + (int(r.value) << (LIMB * r.limb))
        for n, book in books.items():
            new = book.astype(object)
            for p in range(parts):
                for e in range(book.shape[1]):
                    count = total.get((n, p, e, 0), 0)
                    if count:
                        new[p, e] = [total.get((n, p, e, i + 1), 0) // count for i in range(book.shape[2])]
            books[n] = new.astype(np.int64) if _fits(max((abs(x) for x in new.ravel()), default=0), n) else new
        shared.unpersist()
    return books


def encode(rows: DataFrame, books: Books, keep: tuple[str, ...] = ("vec_id",), parts: int = PARTS, scale: int = SCALE) -> DataFrame:
    """The columns of keep, code (a byte a part) and error (squared distances summed over parts; null beyond a long). rows: keep and v."""
    shared = rows.sparkSession.sparkContext.broadcast(books)  # entries times length of a vector

    def run(batches):
        for batch in batches:
            for part, n, at, v in _by_length(batch, parts, scale):
                pick, far = assign(v, shared.value[n])
                error = [e if e < 1 << 63 else None for e in far.sum(1).tolist()]
                yield pa.RecordBatch.from_arrays([*[part.column(c).take(pa.array(at)) for c in keep], pa.array([p.astype(np.uint8).tobytes() for p in pick], pa.binary()), pa.array(error, pa.int64())], [*keep, "code", "error"])

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, "v").mapInArrow(run, f"{kinds}, code binary, error long")


def decode(code: bytes, book: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The vector that a code stands for, padding included."""
    return np.concatenate([book[p, c] for p, c in enumerate(code)]).astype(float) / scale


def digest(book: np.ndarray) -> str:
    """SHA-256 of all components as decimal numbers, by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(str(int(x)) for x in book.ravel()).encode()).hexdigest()


def with_group_error(coded: DataFrame, group: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """coded with group_error, the sum of error over the rows of equal group, nulls together; null beyond a long, or with an error that is."""
    total = F.sum(F.col("error").cast("decimal(38,0)")).try_cast("bigint")
    per = coded.groupBy(F.col(group).alias("g")).agg(F.when(F.count_if(F.col("error").isNull()) == 0, total).alias("group_error"))
    per = spill(per, "group_errors")
    same = F.col(group).eqNullSafe(F.col("g"))
    if per.count() <= broadcast_rows:
        return coded.join(F.broadcast(per), same).drop("g")
    per = per.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = coded.withColumn("lane", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int"))
    return dealt.join(per, same & (F.col("lane") == F.col("salt"))).drop("g", "lane", "salt")


def compress(rows: DataFrame, vector: str = "embedding", group: str = "label", **sizes) -> DataFrame:
    """vec_id, code (two hex digits a part), error, group_error and codebooks_sha256 of every usable row.

    Vectors that are null, or hold null or non-finite components, take no part. Rows that repeat a vec_id, or have none, are rows of
    their own. Empty vectors have code zeros and no error. Components of any finite size are exact. Other columns are not read.
    """
    v = usable(rows, vector).select("vec_id", F.col(group).alias("grp"), F.transform(vector, lambda x: x.cast("double")).alias("v"))
    books = train(v, **sizes)
    fixed = {k: s for k, s in sizes.items() if k in ("parts", "scale")}
    sums = F.create_map(*[F.lit(x) for n, b in books.items() for x in (n, digest(b))]) if books else None
    coded = encode(v.withColumn("n", F.size("v")), books, ("vec_id", "grp", "n"), **fixed)
    coded = spill(coded, "codes")
    hashed = F.element_at(sums, F.col("n")) if books else F.lit(None).cast("string")
    return with_group_error(coded, "grp").select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "group_error", hashed.alias("codebooks_sha256"))
