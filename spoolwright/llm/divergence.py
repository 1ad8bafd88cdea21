"""Source divergence audit by sketch-prefiltered counting.

Which terms are common enough in a language is first bounded from above: every task counts the documents of its terms into a count-min
sketch, sketches merge by addition, and their least cell never underestimates. Terms whose bound is too low are discarded before anything
is shuffled; the others are counted exactly. Sources are then compared by joins of the terms that they share; terms that one of a pair
lacks enter through a histogram of its shares, terms that both lack through their number.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import byte_slices, spill, spill_twice

#: ASCII capitals are lowered, small letters and every non-ASCII byte kept; all else parts terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Rows of a sketch; its cells are bytes that stop at 255. Its width is the power of two above so many cells a document, within bounds.
DEPTH, CELLS_A_DOCUMENT, LEAST_WIDTH, MOST_WIDTH = 4, 4, 1 << 14, 1 << 24
#: Sketches merge in pieces of so many cells, first within lanes of tasks, so that no step meets all tasks.
CHUNK, LANES = 1 << 18, 1024
#: A task holds so many distinct terms at most before it passes them on.
HELD = 400_000
#: Tables of so many groups are broadcast at most. Beyond, they are shuffled.
BROADCAST_ROWS, SALTS = 200_000, 16
WHOLE = 1_000_000_000


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split() if text else []


def cells(lang: str, terms: list[bytes], width: int) -> np.ndarray:
    """Where terms of a language are counted: terms by DEPTH places in the rows of a sketch, one behind the other."""
    import xxhash

    head = lang.encode() + b"\0"
    raw = np.frombuffer(b"".join([xxhash.xxh3_128_digest(head + t) for t in terms]), "<u4").reshape(-1, 4)
    return (raw & (width - 1)).astype(np.int64) + np.arange(DEPTH) * width


def add(sketch: np.ndarray, lang: str, found: dict[bytes, int]) -> None:
    """Count terms into a sketch; cells stop at 255, which is no underestimate of what is below."""
    if found:
        at = cells(lang, list(found), len(sketch) // DEPTH).ravel()
        n = np.repeat(np.fromiter(found.values(), np.int64, len(found)), DEPTH)
        places, back = np.unique(at, return_inverse=True)
        sketch[places] = np.minimum(255, sketch[places] + np.bincount(back, n).astype(np.int64))


def possible(sketch: np.ndarray, lang: str, terms: list[bytes], least: int) -> np.ndarray:
    """Whether the sketch allows so many documents, for each term."""
    if not terms:
        return np.zeros(0, bool)
    return sketch[cells(lang, terms, len(sketch) // DEPTH)].min(1) >= min(least, 255)


def _texts(batch):
    for part in byte_slices(batch, "text"):
        yield from zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), part.column("text").to_pylist(), strict=True)


def document_sketch(docs: DataFrame, width: int) -> np.ndarray:
    """The merged sketch of document frequencies, at most DEPTH * MOST_WIDTH bytes. docs: lang, source, text without nulls."""
    from collections import Counter

    from pyspark import TaskContext

    schema = "chunk int, task int, cells binary"

    def count(batches):
        sketch, held, size = np.zeros(DEPTH * width, np.uint8), {}, 0
        for batch in batches:
            for lang, _, text in _texts(batch):
                mine = held.setdefault(lang, Counter())
                before = len(mine)
                mine.update(set(terms_of(text)))
                size += len(mine) - before
                if size > HELD:
                    for name, found in held.items():
                        add(sketch, name, found)
                    held, size = {}, 0
        for name, found in held.items():
            add(sketch, name, found)
        for at in range(0, len(sketch), CHUNK):
            if sketch[at : at + CHUNK].any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([at // CHUNK], pa.int32()), "task": pa.array([TaskContext.get().partitionId()], pa.int32()), "cells": [sketch[at : at + CHUNK].tobytes()]})

    def merge(table: pa.Table) -> pa.Table:
        total = None
        for c in table.column("cells"):
            x = np.frombuffer(c.as_buffer(), np.uint8).astype(np.uint16)
            total = x if total is None else np.minimum(255, total + x)
        first = {"chunk": table.column("chunk")[:1], "task": table.column("task")[:1]}
        return pa.table({**first, "cells": pa.array([total.astype(np.uint8).tobytes()], pa.binary())})

    found = docs.mapInArrow(count, schema)
    found = found.withColumn("task", F.col("task") % LANES).groupBy("chunk", "task").applyInArrow(merge, schema)
    found = found.groupBy("chunk").applyInArrow(merge, schema)
    sketch = np.zeros(DEPTH * width, np.uint8)
    for r in found.select("chunk", "cells").toLocalIterator():
        sketch[r.chunk * CHUNK : r.chunk * CHUNK + len(r.cells)] = np.frombuffer(r.cells, np.uint8)
    return sketch


def counted(docs: DataFrame, sketch: np.ndarray, least: int) -> DataFrame:
    """lang, source, term, n (occurrences), d (documents): partial counts of the terms that the sketch allows, several rows a term."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    schema = "lang string, source string, term string, n long, d long"

    def count(batches):
        from collections import Counter

        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0

        def passed_on():
            for (lang, source), (n, d) in held.items():
                terms = list(n)
                kept = [terms[i] for i in np.flatnonzero(possible(shared.value, lang, terms, least))]
                for at in range(0, len(kept), 50_000):
                    some = kept[at : at + 50_000]
                    columns = [pa.array([lang] * len(some)), pa.array([source] * len(some)), pa.array(some, pa.binary()).cast(pa.string()), pa.array([n[t] for t in some], pa.int64()), pa.array([d[t] for t in some], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "d"])

        for batch in batches:
            for lang, source, text in _texts(batch):
                if (lang, source) not in held:
                    held[lang, source] = Counter(), Counter()
                n, d = held[lang, source]
                words, before = terms_of(text), len(n)
                n.update(words)
                d.update(set(words))
                size += len(n) - before
                if size > HELD:
                    yield from passed_on()
                    held.clear()
                    size = 0
        yield from passed_on()

    return docs.mapInArrow(count, schema)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (n + 2) / (total + 2 * terms)), exact; null without terms."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.when(terms > 0, 1 + _div(F.lit(WHOLE).cast("decimal(10,0)") * wide(n + 2), wide(total + 2 * terms)))


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q))."""
    return _div((p - q) * (p - q), p + q)


def audit(docs: DataFrame, least_documents: int = 10, top: int = 10, width: int | None = None, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """lang, source, part, item, value, rank: how far the sources of a language are from one another, and the terms that set one apart.

    Part "pair": item is every other source of the language, value the divergence over the language's kept terms. Part "term": item is a
    kept term that the source uses more than the language does, the top ranks only. Ties go to the smaller item by UTF-8. Null texts,
    languages and sources are ''; repeated rows are documents of their own; a language without kept terms has pairs of value 0; a
    language of one source has no pairs; an empty table has no rows. Other columns are not read.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = docs.select(blank("lang"), blank("source"), blank("text"))
    if width is None:
        n = docs.count()
        width = min(MOST_WIDTH, max(LEAST_WIDTH, 1 << max(0, CELLS_A_DOCUMENT * n - 1).bit_length()))
    sketch = document_sketch(docs, width)

    found = counted(docs, sketch, least_documents).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    term = Window.partitionBy("lang", "term")  # a row a source
    found = found.select("lang", "source", "term", "n", F.sum("d").over(term).alias("d"), F.sum("n").over(term).alias("lang_n"), (F.row_number().over(term.orderBy("source")) == 1).alias("first"))
    kept = spill(found.where(F.col("d") >= least_documents).drop("d"), "kept_terms")

    # thin tables: one row a language, one a (language, source)
    langs = kept.groupBy("lang").agg(F.count_if("first").alias("v"), F.sum("n").alias("lang_total"))
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("terms"))
    none = F.lit(0).cast("long")
    groups = docs.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, none).alias(c) for c in ("total", "terms", "v", "lang_total")])
    groups, others = spill_twice(groups.withColumn("absent", share(none, F.col("total"), F.col("v"))), "groups")
    small = groups.count() <= broadcast_rows
    hint = F.broadcast if small else (lambda df: df)

    shares = kept.join(hint(groups), ["lang", "source"]).select("lang", "source", "term", "n", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"), "absent")
    shares, partners = spill_twice(shares, "shares")

    above = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    terms = above.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    a = groups.withColumn("salt", F.pmod(F.xxhash64("source"), F.lit(SALTS)).cast("int"))
    b = others.select("lang", F.col("source").alias("item"), F.col("terms").alias("item_terms"), F.col("absent").alias("item_absent"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    pairs = lambda left: left.join(hint(b), ["lang", "salt"]).where("source <> item")
    neither = pairs(a).select("lang", "source", "item", F.when(F.col("v") > 0, (F.col("v") - F.col("terms") - F.col("item_terms")) * gap(F.col("absent"), F.col("item_absent"))).otherwise(none).alias("value"))
    histogram = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("m"))
    one = pairs(histogram.withColumn("salt", F.pmod(F.xxhash64("source", "p"), F.lit(SALTS)).cast("int"))).groupBy("lang", "source", "item").agg(F.sum(F.col("m") * gap(F.col("p"), F.col("item_absent"))).alias("value"))
    x, y = shares.select("lang", "term", "source", "p", "absent"), partners.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("q"), F.col("absent").alias("item_absent"))
    p, q, p0, q0 = (F.col(c) for c in ("p", "q", "absent", "item_absent"))
    both = x.join(y, ["lang", "term"]).where("source < item").groupBy("lang", "source", "item").agg(F.sum(gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0)).alias("value"))
    halves = one.unionByName(both)
    turned = halves.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    pair = neither.unionByName(halves).unionByName(turned).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pair = pair.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(best).alias("rank"))
    return pair.unionByName(terms.select(pair.columns))
