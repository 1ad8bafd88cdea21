"""Benchmark decontamination by a prefix-filtered set join, in DataFrame operations only.

Every benchmark item gives windows of 13 consecutive words (one window of all its words if it has fewer). The elements of a window are
its shingles of up to three consecutive words. They are ordered by how often they occur in the documents, and as containment needs
every shingle of a window, its rarest one is the whole prefix that has to be joined. Joined positions must leave room for the window
before and after (positional and length bounds); then the window's words are compared with the document's.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._shared import spill, unused

#: What parts words: every ASCII character but digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: So many shingles, of 8 bytes each, and so many bytes of windows are broadcast at most. More are joined by a shuffle of positions, common
#: shingles dealt over SALTS, and words are fetched for candidates only. Texts then cross the network once; in the other plan, never.
BROADCAST_ROWS, BROADCAST_BYTES, SALTS = 1_000_000, 128 << 20, 16


def words(text: Column) -> Column:
    """The words of a text, A-Z lowered. lower() has a fast way for ASCII texts; others are translated, as only A-Z may change."""
    ascii_text = F.length(text) == F.octet_length(text)
    low = F.when(ascii_text, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, SEPARATORS), "")


def shingle(array: Column, at: Column, n: int) -> Column:
    return F.xxhash64(F.lit(n), *[F.get(array, at + i) for i in range(n)])


def _windows(items: DataFrame, size: int) -> DataFrame:
    """Distinct windows with the ids of their items."""
    w = items.select("item_id", words(F.col("text")).alias("ws")).where(F.size("ws") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("ws") - size, F.lit(0)))
    return (
        w.select("item_id", "ws", F.explode(starts).alias("s"))
        .select("item_id", F.slice("ws", F.col("s") + 1, size).alias("window"))
        .groupBy("window")
        .agg(F.collect_set("item_id").alias("items"))
        .select(F.monotonically_increasing_id().alias("wid"), "window", F.size("window").alias("len"), "items")
    )


def _salted(many: DataFrame, few: DataFrame, on: str) -> DataFrame:
    """An inner join in which each row of `few` stands in SALTS places, so that rows of a common value are dealt over them."""
    few = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return many.withColumn("salt", F.pmod(F.xxhash64("key", "p"), F.lit(SALTS)).cast("int")).join(few, [on, "salt"]).drop("salt")


def _occurring(docs: DataFrame, tokens: DataFrame, sizes: list[int], small: bool) -> DataFrame:
    """Every position of a document at which one of the tokens starts: doc_id, key, p, token, what is known of it, and ws, the document's words, if small.

    Generated code holds the words of a row by reference, and rows that no token meets are never written; behind an exchange ws is left out.
    """
    token = [shingle(F.col("ws"), F.col("p"), n) for n in sizes]
    kept = ["doc_id", "key", *(["ws"] if small else []), "p"]
    many = docs.select("doc_id", "key", "ws", F.posexplode("ws").alias("p", "w"))
    many = many.select(*kept, token[0].alias("token")) if len(token) == 1 else many.select(*kept, F.explode(F.array(*token)).alias("token"))
    return many.join(F.broadcast(tokens), "token") if small else _salted(many, tokens, "token")


def contamination(docs: DataFrame, items: DataFrame, size: int = 13, share: float = 0.05, prefix_words: int = 3, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated (and key, a hash of the text).

    n_hit counts the words inside any occurrence of any window; a document is contaminated if it has hits and they are at least the
    given share of its words. Null and empty texts have no words and no hits; items without words give no windows; null item_ids name
    no item. The checksum of no items is that of an empty string. Rows with equal doc_id and text get equal results each. Other columns
    of either table are not read.
    """
    part = Fraction(str(share))
    cut = lambda t: F.xxhash64(t, F.octet_length(t))
    texts = docs.select("doc_id", cut(F.col("text")).alias("key"), words(F.col("text")).alias("ws"))
    windows = spill(_windows(items.select("item_id", "text"), size), "windows")
    lengths = [r.n for r in windows.select(F.least("len", F.lit(prefix_words)).alias("n")).distinct().collect()]  # at most prefix_words rows
    n = F.least("len", F.lit(prefix_words))
    parts = reduce(
        DataFrame.unionByName,
        [windows.where(n == k).select("wid", "len", F.explode(F.sequence(F.lit(0), F.col("len") - k)).alias("off"), "window").select("wid", "off", shingle(F.col("window"), F.col("off"), k).alias("token")) for k in lengths],
        windows.select("wid", F.lit(0).alias("off"), F.lit(0).cast("long").alias("token")).limit(0),
    )
    parts = spill(parts, "window_shingles")
    vocabulary = spill(parts.select("token").distinct(), "vocabulary")
    size_of = windows.agg(F.coalesce(F.sum(F.octet_length(F.array_join("window", " ")) + 16 * F.size("items") + 64), F.lit(0))).first()[0]
    small = vocabulary.count() <= broadcast_rows and size_of <= BROADCAST_BYTES
    if lengths:
        met = _occurring(texts, vocabulary, lengths, small)
        met = met if small else spill(met.select("doc_id", "key", "p", "token"), "occurrences")
        counted = met.groupBy("token").agg(F.count("*").alias("n"))
        # a shingle that no document has rules its windows out
        ranked = parts.join(spill(counted, "shingle_counts"), "token", "left").groupBy("wid").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("token"), F.col("off"))).alias("rarest"))
        prefix = spill(ranked.where("rarest.n > 0").select("wid", "rarest.token", "rarest.off").join(windows, "wid"), "prefixes")
        start = (F.col("p") - F.col("off")).alias("s")
        if small:
            cases = spill(prefix.groupBy("token").agg(F.collect_list(F.struct("off", "len", "window", "items")).alias("cases")), "cases")
            found = _occurring(texts, cases, lengths, small).select("doc_id", "key", "ws", "p", F.inline("cases")).select("doc_id", "key", "ws", start, "len", "window", "items")
        else:
            thin = spill(_salted(met, prefix, "token").select(F.col("doc_id").alias("d"), F.col("key").alias("k"), start, "len", "window", "items").where("s >= 0"), "candidates")
            held = spill(thin.select(F.col("d").alias("a"), F.col("k").alias("b")).distinct(), "candidate_rows")
            rows = docs.select("doc_id", cut(F.col("text")).alias("key"), "text").join(held, F.col("doc_id").eqNullSafe(F.col("a")) & (F.col("key") == F.col("b")), "left_semi")
            rows = rows.dropDuplicates(["doc_id", "key"]).select("doc_id", "key", words(F.col("text")).alias("ws"))
            found = thin.join(rows, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("key")))
        found = found.where((F.col("s") >= 0) & (F.col("s") + F.col("len") <= F.size("ws"))).where(F.slice("ws", F.greatest("s", F.lit(0)) + 1, F.col("len")) == F.col("window"))
        hits = found.select("doc_id", "key", "s", (F.col("s") + F.col("len")).alias("e"), "items")
    else:
        hits = texts.limit(0).select("doc_id", "key", F.lit(0).alias("s"), F.lit(0).alias("e"), F.array().cast("array<bigint>").alias("items"))
    # positions of one document: bounded by its own words
    spans = hits.groupBy("doc_id", "key", "s").agg(F.max("e").alias("e"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    per = spans.groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, x: F.struct(F.greatest(a["end"], x["e"]).alias("end"), (a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["end"]), F.lit(0))).alias("n")),
    )["n"]
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    per = per.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), covered.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.concat_ws(",", names).alias("names"))
    counts = texts.select("doc_id", "key", F.when(F.col("key").isNull() | F.col("ws").isNull(), 0).otherwise(F.size("ws")).cast("long").alias("n_words"))
    hit = F.coalesce("n_hit", F.lit(0))
    return counts.join(per, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left").select(
        "doc_id", "n_words", hit.cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.encode(F.coalesce("names", F.lit("")), "UTF-8"), 256).alias("items_sha256"),
        ((hit > 0) & (hit * part.denominator >= F.col("n_words") * part.numerator)).alias("contaminated"), "key",
    )


def clean_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """docs without the contaminated rows; every other row and column as it is."""
    a, b = unused(docs, "bad_id"), unused(docs, "bad_key")
    bad = contamination(docs, items, **options).where("contaminated").select(F.col("doc_id").alias(a), F.col("key").alias(b)).distinct()
    bad = spill(bad, "contaminated")
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col(a)) & (F.xxhash64(docs["text"], F.octet_length(docs["text"])) == F.col(b)), "left_anti")
