"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A document is the set of its shingles of five words, each weighed by 1 + ln(count) times its smoothed inverse document frequency. Shingles
are counted over the whole corpus in a fixed number of hash buckets, so the only table broadcast has a fixed size; what a bucket holds
typically is taken off its count. Frequencies are scaled to lie between 1 and 1 + IDF_SPAN: raw ones would weigh the few edited shingles
of a large group of copies above all that its members share. Each sample is a shingle drawn in proportion to its weight, the same in two
documents with the probability of their weighted Jaccard similarity; bands of samples make candidates, and candidates are verified on
their whole texts.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import byte_slices, slices, spill, spill_twice, unused, WORD_BYTES, working_for

WORDS_PER_SHINGLE, THRESHOLD, BANDS, ROWS, DF_BUCKETS, IDF_SPAN = 5, 0.8, 12, 4, 1 << 18, 0.125
#: In the last pass two members of a bucket are compared if so many of their BANDS * ROWS samples agree: at a similarity of 0.8 fewer agree
#: with a probability below 0.00001, far below that of sharing no band (0.002).
AGREE = 26
#: Members and characters of texts that a block of a bucket has, roughly.
BLOCK, BLOCK_CHARS = 256, 1 << 23
#: At most so many buckets are hot: those with more members than the same share of all. Their members are dealt over SALTS wherever they
#: meet a fact about their bucket.
HOT_BUCKETS, SALTS = 20_000, 16
#: Rows of two or three numbers each that are broadcast to pick texts out, counted before; more are joined by a shuffle of the texts.
BROADCAST_ROWS = 1_000_000
#: Shingles of compared texts that a worker keeps, of 12 bytes each.
CACHED_SHINGLES = 3_000_000
_MIX, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Powers by which a word's bytes are weighed in its hash; longer words use them again.
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(1 << 12, 0x5851F42D4C957F2D, np.uint64))


@lru_cache(1)
def _draws() -> tuple[np.ndarray, ...]:
    """Pseudo-random r ~ Gamma(2, 1), ln c with c ~ Gamma(2, 1) and beta ~ U(0, 1), read by 16-bit hashes; odd multipliers, one a sample."""
    g = np.random.Generator(np.random.PCG64(20240229))
    r, c, beta = g.gamma(2.0, 1.0, 1 << 16), g.gamma(2.0, 1.0, 1 << 16), g.random(1 << 16)
    odd = g.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
    ln_c = np.log(c)
    return r, ln_c, beta, (ln_c - r).astype(np.float32) - np.float32(1e-4), odd


def word_hashes(texts: list[str | None], piece: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts after one another, and where each text's begin, and the end."""
    raw = [(t or "").encode() for t in texts]
    data = np.frombuffer(b" ".join(raw).translate(WORD_BYTES) + b" ", np.uint8)
    edge = np.flatnonzero(np.diff(data != 32, prepend=False))
    start, end = edge[::2], edge[1::2]
    out, at = np.empty(len(start), np.uint64), 0
    while at < len(start):  # about so many bytes at a time
        to = max(at + 1, int(np.searchsorted(start, start[at] + piece)))
        n = end[at:to] - start[at:to]
        first = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(first, n)
        chars = data[place + np.repeat(start[at:to], n)].astype(np.uint64)
        out[at:to] = np.add.reduceat((chars + np.uint64(1)) * _POWERS[place & (len(_POWERS) - 1)], first)
        at = to
    out ^= out >> np.uint64(32)
    out *= _MIX2
    out ^= out >> np.uint64(29)
    return out, np.searchsorted(start, np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw]))))


def shingles(texts: list[str | None]):
    """For each text: the hashes of its words, its distinct shingles' hashes in ascending order, and their counts. A text of fewer than five words is one shingle."""
    words, at = word_hashes(texts)
    n = WORDS_PER_SHINGLE
    stages = [words]
    for k in range(1, n):
        s = stages[-1][: max(0, len(words) - k)]
        stages.append((s ^ (s >> np.uint64(29))) * _MIX + words[k:])
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        s = stages[min(n, b - a) - 1][a : max(b - n, a) + 1] if b > a else words[:0]
        s = (s ^ (s >> np.uint64(32))) * _MIX2
        s = np.sort(s ^ (s >> np.uint64(32)))
        new = np.concatenate((s[:1] == s[:1], s[1:] != s[:-1]))
        if new.all():
            yield words[a:b], s, np.ones(len(s), np.int64)
        else:
            first = np.flatnonzero(new)
            yield words[a:b], s[first], np.diff(np.append(first, len(s)))


def weighted(hashes: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return hashes, idf[hashes >> np.uint64(46)] * (1 + np.log(counts)).astype(np.float32)


def sample(hashes: np.ndarray, weights: np.ndarray, block: int = 2048) -> np.ndarray:
    """Improved consistent weighted samples (Ioffe 2010) as 32-bit marks of (shingle, t).

    ln a = ln c - r (t - beta + 1) with t = floor(ln w / r + beta) is at least ln c - r - ln w; the shingle of the least bound is worked out
    first, then only those whose bound is at most its value.
    """
    r, ln_c, beta, low, odd = _draws()
    ln_w = np.log(weights)
    k = len(odd)
    best, mark = np.full(k, np.inf), np.zeros(k, np.uint32)
    for at in range(0, len(hashes), block):
        h, lw = hashes[at : at + block], ln_w[at : at + block]
        slot = ((odd[:, None] * h) >> np.uint64(48)).view(np.int64)
        bound = low.take(slot)
        bound -= lw
        first = bound.argmin(1)
        j = slot[np.arange(k), first]
        reach = np.minimum(ln_c[j] - r[j] * (np.floor(lw[first] / r[j] + beta[j]) - beta[j] + 1), best).astype(np.float32) + np.float32(1e-4)
        flat = np.flatnonzero(bound <= reach[:, None])
        if not len(flat):
            continue
        sample_no, pos = np.divmod(flat, len(h))
        j = slot.ravel()[flat]
        t = np.floor(lw[pos] / r[j] + beta[j])
        ln_a = ln_c[j] - r[j] * (t - beta[j] + 1)
        starts = np.flatnonzero(np.concatenate(([True], sample_no[1:] != sample_no[:-1])))
        least = np.minimum.reduceat(ln_a, starts)
        here = sample_no[starts]
        is_least = np.flatnonzero(ln_a == np.repeat(least, np.diff(np.append(starts, len(pos)))))
        of = sample_no[is_least]
        chosen = is_least[np.concatenate(([True], of[1:] != of[:-1]))]  # ties go to the smaller hash
        better = least < best[here]
        x = (h[pos[chosen]] + (t[chosen].astype(np.int64).astype(np.uint64) * _MIX)) * np.uint64(0xD6E8FEB86659FD93)
        new = (x >> np.uint64(32)).astype(np.uint32)
        best[here[better]], mark[here[better]] = least[better], new[better]
    return mark


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard similarity: the sum of lesser weights by the sum of greater ones. Shared shingles are found in the sorted hashes."""
    if len(a[0]) > len(b[0]):
        a, b = b, a
    total_a, total_b = float(a[1].sum()), float(b[1].sum())
    if min(total_a, total_b) < THRESHOLD * max(total_a, total_b) * (1 - 1e-6):
        return 0.0
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0]
    shared = float(np.minimum(a[1][same], b[1][at[same]]).sum())
    return shared / (total_a + total_b - shared) if shared else 0.0


def _document_frequencies(docs: DataFrame) -> np.ndarray:
    """Documents for each bucket of shingles, over the whole corpus; the last entry counts documents."""

    def run(batches):
        working_for("near_duplicates")
        total, n = np.zeros(DF_BUCKETS, np.int64), 0
        for batch in batches:
            for part in byte_slices(batch, "text", 1 << 21):
                found = [h >> np.uint64(46) for _, h, _ in shingles(part.column("text").to_pylist())]
                total += np.bincount(np.concatenate(found).astype(np.int64), minlength=DF_BUCKETS)
                n += part.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, DF_BUCKETS), pa.int32()), pa.array(np.append(total[at], n))], ["bucket", "n"])

    table = np.zeros(DF_BUCKETS + 1, np.int64)
    sums = docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for batch in sums.toArrow().to_batches():  # at most DF_BUCKETS + 1 rows
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return table


def inverse_frequencies(df: np.ndarray) -> np.ndarray:
    """Smoothed, without what other shingles typically add to a bucket, and scaled to lie between 1 (in all documents) and 1 + IDF_SPAN (in one)."""
    n = max(int(df[-1]), 1)
    own = df[:-1] - np.median(df[:-1])
    return (1 + IDF_SPAN * np.log((n + 1) / np.clip(own, 1, n)) / np.log(n + 1)).astype(np.float32)


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of each node's component, by large-star and small-star steps until nothing changes."""
    edges = spill(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc_edges")
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = spill(large, "cc_large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(joined.select("u", F.col("m").alias("v"))).distinct()
        small = spill(small, "cc_small")
        old, new = (e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first() for e in (edges, small))
        edges = small
        if old == new:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


class Compared:
    """Weighted shingles of the texts that a worker compares, the latest kept within a bound."""

    def __init__(self, idf: np.ndarray):
        self.idf, self.known, self.held = idf, {}, 0

    def __call__(self, node: int, text: str) -> tuple:
        if node not in self.known:
            if self.held > CACHED_SHINGLES:
                self.known, self.held = {}, 0
            ((_, h, n),) = shingles([text])
            self.known[node] = v = weighted(h, n, self.idf)
            self.held += len(h)
        return self.known[node]


def _few(rows: DataFrame) -> DataFrame:
    """A spilled table, to be broadcast if it is counted small."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _with_facts(members: DataFrame, facts: DataFrame) -> DataFrame:
    """Members (bucket, hot, node) of buckets with the facts (bucket, hot) about them; those of a hot bucket meet them in SALTS places."""
    many = F.sequence(F.lit(0), F.when(F.col("hot"), SALTS - 1).otherwise(0))
    facts = facts.withColumn("salt", F.explode(many)).drop("hot")
    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("node"), F.lit(SALTS))).otherwise(0).cast("int")
    return members.withColumn("salt", salt).join(facts, ["bucket", "salt"]).drop("salt")


class _Corpus:
    """Rows, distinct texts and buckets of one run of near_duplicates()."""

    def __init__(self, docs: DataFrame):
        spark = docs.sparkSession
        self.texts = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("raw"), "text")
        self.idf = idf = spark.sparkContext.broadcast(inverse_frequencies(_document_frequencies(self.texts)))  # DF_BUCKETS numbers

        def sketch(batches):
            working_for("near_duplicates")
            for batch in batches:
                for part in byte_slices(batch, "text", 1 << 21):
                    keys, marks, texts = [], [], part.column("text").to_pylist()
                    for t, (words, h, n) in zip(texts, shingles(texts), strict=True):
                        # equal for texts with the same words in the same order, and for equal texts without words
                        keys.append(None if t is None else hashlib.blake2b(words.tobytes() or b"\x00" + t.encode(), digest_size=16).digest())
                        marks.append(sample(*weighted(h, n, idf.value)).tobytes() if len(h) else None)
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("raw"), pa.array(keys, pa.binary()), pa.array(marks, pa.binary()), pa.array([len(t or "") for t in texts], pa.int64())], ["doc_id", "raw", "text_key", "marks", "chars"])

        self.rows = spill(self.texts.mapInArrow(sketch, "doc_id long, raw long, text_key binary, marks binary, chars long"), "sketches")
        known = self.rows.where("text_key is not null")
        self.repeated = known.groupBy("doc_id", "raw").count().where("count > 1").limit(1).count() > 0
        # one node for each distinct text; it is represented by its row with the least doc_id
        nodes = known.groupBy("text_key").agg(F.min(F.struct("doc_id", "raw")).alias("rep"), F.first("marks").alias("marks"), F.max("chars").alias("chars"))
        self.nodes = spill(nodes.select(F.monotonically_increasing_id().alias("node"), "text_key", F.col("rep.doc_id").alias("rep_id"), F.col("rep.raw").alias("rep_raw"), "marks", "chars"), "nodes")
        band = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.struct(b.alias("band"), F.xxhash64(b, F.substring(F.col("marks"), b * (4 * ROWS) + 1, F.lit(4 * ROWS))).alias("h")))
        buckets = self.nodes.where("marks is not null").select("node", "chars", F.explode(band).alias("b")).select("node", "chars", F.xxhash64("b.band", "b.h").alias("bucket"), "b.band")
        buckets = spill(buckets, "buckets")
        led = spill(buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high")).where("n > 1"), "leaders")
        limit = max(BLOCK, buckets.count() // HOT_BUCKETS)
        hot = spill(led.where(F.col("n") > limit).select("bucket", "low", "high"), "hot_buckets")  # at most HOT_BUCKETS rows
        cold = buckets.join(F.broadcast(hot.select("bucket")), "bucket", "left_anti").join(led.where(F.col("n") <= limit).select("bucket", "low", "high"), "bucket")
        warm = buckets.join(F.broadcast(hot), "bucket")
        # of buckets with more than one
        self.members = spill(cold.withColumn("hot", F.lit(False)).unionByName(warm.withColumn("hot", F.lit(True))), "members")
        ends = spill(self.members.select("node").distinct(), "member_nodes")
        wanted = spill(self.nodes.join(ends, "node", "left_semi").select("node", "rep_id", "rep_raw"), "member_rows")
        found = self.texts.join(_few(wanted), (F.col("doc_id") == F.col("rep_id")) & (F.col("raw") == F.col("rep_raw"))).select("node", "text")
        self.member_texts = spill(found.groupBy("node").agg(F.min("text").alias("text")) if self.repeated else found, "member_texts")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of nodes whose texts have a weighted Jaccard similarity of at least THRESHOLD."""
        ends = spill(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct(), "ends")
        texts = self.member_texts.join(ends, "node", "left_semi")
        one = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        two = one.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        idf = self.idf

        def run(batches):
            working_for("near_duplicates")
            of = Compared(idf.value)
            for batch in batches:
                for part in slices(batch, 256):
                    a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
                    keep = []
                    for x, y, s, t in zip(a, b, part.column("text_a").to_pylist(), part.column("text_b").to_pylist(), strict=True):
                        if similarity(of(x, s), of(y, t)) >= THRESHOLD:
                            keep.append((x, y))
                    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keep], pa.int64()), pa.array([k[1] for k in keep], pa.int64())], ["a", "b"])

        return spill(two.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long"), "links")

    def parted(self, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members of the buckets that hold more than one component, with their component, the bucket's largest one and its number of blocks; twice."""
        placed = self.members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        parts = spill(placed.groupBy("bucket", "hot", "root").agg(F.count("*").alias("n"), F.sum("chars").alias("chars")), "bucket_parts")
        whole = [F.count("*").alias("parts"), F.max(F.struct("n", "root"))["root"].alias("main"), F.sum("n").alias("members"), F.sum("chars").alias("chars")]
        split = parts.groupBy("bucket", "hot").agg(*whole).where("parts > 1")
        blocks = F.least("members", F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("chars") / BLOCK_CHARS))).cast("int")
        split = spill(split.select("bucket", "hot", "main", blocks.alias("blocks")), "split_buckets")
        return spill_twice(_with_facts(placed, split).select("bucket", "hot", "band", "node", "root", "main", "blocks"), "open_members")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id and class_id, the least doc_id of its class.

    Texts with the same words in the same order are of one class; so are texts of at least 0.8 weighted Jaccard similarity, and
    whatever is joined through others. Texts without words are of one class only if equal. Null texts, and rows with a null doc_id, are
    classes of their own; the class_id of the latter is null. Repeated rows fall into one class. Texts of fewer than five words are one
    shingle. doc_id must be a number. Different texts may share a doc_id: where several classes have the same least doc_id, one of them
    is named by it and the others by negative numbers, from a hash of their texts, so that no two classes have one name. Other columns of
    docs are not read; an empty table gives no rows.
    """
    corpus, classes = _classes(docs)
    ids = classes.groupBy("class_no").agg(F.min("rep_id").alias("least"), F.min(F.xxhash64("text_key")).alias("tag"))
    shared = ids.groupBy("least").agg(F.min("tag").alias("first_tag"))
    ids = ids.join(shared, "least").select("class_no", F.when(F.col("tag") == F.col("first_tag"), F.col("least")).otherwise(-1 - F.shiftrightunsigned("tag", 1)).alias("class_id"))
    named = spill(classes.join(spill(ids, "class_ids"), "class_no").select("text_key", "class_id"), "classes")
    out = corpus.rows.select("doc_id", "text_key").join(named, "text_key", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    return out.unionByName(docs.where("doc_id is null").select(*[F.lit(None).cast("long").alias(n) for n in ("doc_id", "class_id")]))


def _classes(docs: DataFrame) -> tuple[_Corpus, DataFrame]:
    """Every distinct text (text_key), the row that represents it (rep_id, rep_raw) and the number of its class."""
    corpus = _Corpus(docs)
    k, idf = BANDS * ROWS, corpus.idf
    met = corpus.members.select("node", F.explode(F.array("low", "high")).alias("leader"))
    pairs = met.where("node <> leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    pairs = spill(pairs, "pairs")
    links = corpus.verified(pairs)
    # members outside the component of their bucket's best linked member are compared with it
    opened, again = corpus.parted(spill(components(links), "roots"))
    degree = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count("*").alias("degree"))
    hubs = opened.join(degree, "node").groupBy("bucket", "hot").agg(F.max(F.struct("degree", "node", "root")).alias("hub"))
    near_hub = _with_facts(again, hubs).where(F.col("root") != F.col("hub.root"))
    near_hub = near_hub.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
    links = links.union(corpus.verified(spill(near_hub, "hub_pairs")))
    # what is still parted: members outside a bucket's largest component are compared with all members of others, block by block
    open_rows, again = corpus.parted(spill(components(links), "roots"))
    ends = spill(open_rows.select("node").distinct(), "open_nodes")
    marks = corpus.nodes.join(ends, "node", "left_semi").select("node", "marks")
    texts_of = spill_twice(corpus.member_texts.join(ends, "node", "left_semi").join(marks, "node"), "open_texts")
    more = open_rows.where("root <> main")
    slot = lambda i: F.pmod(F.xxhash64("node", F.lit(i)), F.col("blocks")).cast("int")
    left = more.select("bucket", slot(7).alias("x"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("y"), "band", "node", "root")
    used = spill(more.select("bucket", "hot", slot(7).alias("x")).distinct(), "open_blocks")
    right = _with_facts(again, used).select("bucket", "x", slot(8).alias("y"), "node", "root", (F.col("root") != F.col("main")).alias("late"))
    left, right = (d.join(t, "node") for d, t in zip((left, right), texts_of, strict=True))
    worker: dict = {}

    def compare(key, l: pa.Table, r: pa.Table) -> pa.Table:  # noqa: E741
        out = []
        if l.num_rows and r.num_rows:
            if not worker:
                worker["of"] = Compared(idf.value)
            of = worker["of"]
            read = lambda t: (t["node"].to_numpy(), t["root"].to_numpy(), np.frombuffer(b"".join(t["marks"].to_pylist()), np.uint32).reshape(-1, k), t["text"])
            (ln, lr, lm, lt), (rn, rr, rm, rt) = read(l), read(r)
            band, late = l["band"][0].as_py(), r["late"].to_numpy()
            names, at = np.unique(np.concatenate([lr, rr]), return_inverse=True)
            part, mine, theirs = np.arange(len(names)), at[: len(ln)], at[len(ln) :]  # component of each root, as far as is known here
            for i in range(len(ln)):
                same = (rm == lm[i]).reshape(-1, BANDS, ROWS)
                here = same.all(2).argmax(1) == band  # a pair belongs to the first of its common buckets
                agree = np.where(here & (rr != lr[i]) & ~(late & (rn < ln[i])), same.sum((1, 2)), 0)
                order = np.argsort(-agree, kind="stable")
                for j in order[: np.count_nonzero(agree >= AGREE)]:
                    x, y = part[mine[i]], part[theirs[j]]
                    # a pair within one component changes nothing
                    if x != y and similarity(of(int(ln[i]), lt[i].as_py()), of(int(rn[j]), rt[int(j)].as_py())) >= THRESHOLD:
                        part[part == x] = y
                        out.append((ln[i], rn[j]))
        return pa.table({n: pa.array([p[c] for p in out], pa.int64()) for c, n in enumerate(("a", "b"))})

    late = spill(left.groupBy("bucket", "x", "y").cogroup(right.groupBy("bucket", "x", "y")).applyInArrow(compare, "a long, b long"), "late_links")
    roots = spill(components(links.union(late)), "all_roots")
    classes = corpus.nodes.join(roots, "node", "left").select("text_key", "rep_id", "rep_raw", F.coalesce("root", "node").alias("class_no"))
    return corpus, spill(classes, "class_nodes")


def without_copies(docs: DataFrame) -> DataFrame:
    """docs with one row of each class: that with the least doc_id. Rows with a null doc_id or a null text all stay; of repeated rows one does."""
    corpus, classes = _classes(docs)
    kept = spill(classes.groupBy("class_no").agg(F.min(F.struct("rep_id", "rep_raw")).alias("rep")).select("rep.rep_id", "rep.rep_raw"), "kept")
    found = docs.join(_few(kept), (docs["doc_id"].cast("long") == kept["rep_id"]) & (F.xxhash64(docs["text"]) == kept["rep_raw"]) & docs["text"].isNotNull(), "left_semi")
    if corpus.repeated:
        no = unused(docs, "kept_no")
        first = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.xxhash64("text"))
        found = found.withColumn(no, F.row_number().over(first)).where(F.col(no) == 1).drop(no)
    return found.unionByName(docs.where(docs["doc_id"].isNull() | docs["text"].isNull()))
