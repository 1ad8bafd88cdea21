"""Mixing sources to target weights along a time-varying curriculum.

A source's weight at training time t in [0, 1] is its target times 1 + slope * (2t - 1); integrated, its cumulative demand at t is
target * (t + slope * (t^2 - t)), which is its target at t = 1. Documents of a source stand in a fixed pseudo-random order, one epoch
after another; the words before a document, inverted through the demand, give the time at which it is trained on, and the sum of all
demands at that time is its training position.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import partitions, spill

#: What a word is made of.
WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS, MAX_EPOCHS, SLOPES = (5.0, 2.0, 1.0), 3, (0.5, 0.0, -0.5)


def n_words(text: Column) -> Column:
    return F.coalesce(F.size(F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")), F.lit(0)).cast("long")


def _cycled(values: tuple, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.pmod(at, F.lit(len(values))) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MAX_EPOCHS, slopes: tuple = SLOPES) -> DataFrame:
    """One row per source of sizes (source, source_size): weight, slope and target.

    Targets share the sum of all sizes by weight; none exceeds most times its source, and what is cut off is shared out again by weight
    until none does. That ends at target = min(most * size, level * weight) for the one level at which the targets add up; sources
    ordered by most * size / weight are capped up to some point and not beyond. Works on one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = sizes.withColumn("i", F.row_number().over(order) - 1)
    s = s.withColumns({"weight": _cycled(weights, F.col("i")), "slope": _cycled(slopes, F.col("i")), "cap": F.col("source_size") * float(most)})
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "i")
    before, rest, all_rows = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    s = s.withColumns({
        "total": F.sum("source_size").over(all_rows).cast("double"),
        "capped": F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(rest),
    })
    level = (F.col("total") - F.col("capped")) / F.col("open")  # if this source and all behind it are open
    s = s.withColumn("level", F.min(F.when(level * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("i"), level.alias("v")))).over(all_rows)["v"])
    return s.select("source", "source_size", "weight", "slope", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), "cap")).alias("target"))


def _time(demand: Column, target: Column, slope: Column) -> Column:
    """t at which target * (t + slope * (t^2 - t)) is the demand."""
    x = demand / target
    b = 1 - slope
    return F.when(F.abs(slope) < 1e-12, x).otherwise(2 * x / (b + F.sqrt(b * b + 4 * slope * x)))


def curriculum(docs: DataFrame, chunk_rows: int = 20_000, weights: tuple = WEIGHTS, most: int = MAX_EPOCHS, slopes: tuple = SLOPES) -> DataFrame:
    """doc_id, source, h (a hash of id and text), size, source_size, target, taken, epochs (words taken in each pass) and positions (of each pass).

    taken adds up to the target of the source, rounded to whole words: the last document of the last pass is cut there. Null texts,
    and texts without words, have size 0 and are taken 0 times; null sources form one source, ordered last. Order and results follow
    from doc_id and text alone, so reruns agree; repeated rows stand beside one another. Other columns of docs are not
    read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("doc_id", "text").alias("h"), F.spark_partition_id().alias("part"))
    # repeated rows are counted where they are read, so that no task gets all rows of one key
    ids = spill(ids.groupBy("doc_id", "source", "size", "h", "part").agg(F.count("*").alias("n")), "mix_sizes")
    # chunks are ranges of the hash: more of them split the work and leave the order as it is
    chunks = max(4 * partitions(spark), math.ceil(ids.count() / chunk_rows))
    ids = ids.withColumn("high", F.shiftrightunsigned("h", 33)).withColumn("chunk", F.shiftright(F.col("high") * F.lit(chunks), 31))
    sums = spill(ids.groupBy("source", "chunk").agg(F.sum(F.col("size") * F.col("n")).alias("chunk_size")), "mix_chunks")
    sources = source_targets(sums.groupBy("source").agg(F.sum("chunk_size").alias("source_size")), weights, most, slopes)
    sources = spill(sources, "mix_sources")
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("chunk_size").over(before), F.lit(0)).alias("start"))
    facts = sources.select(F.col("source").alias("t"), "source_size", "target", "slope")
    starts = spill(starts.join(facts, F.col("s").eqNullSafe(F.col("t"))).drop("t"), "mix_starts")
    inside = Window.partitionBy("source", "chunk").orderBy("high", "h", "doc_id", "size", "part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = ids.withColumn("ahead", F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0)))
    ahead = ahead.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).withColumn("ahead", F.col("ahead") + F.col("copy") * F.col("size"))
    placed = ahead.join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
    goal, offset = F.round("target").cast("long"), F.col("start") + F.col("ahead")
    epochs = F.array(*[F.greatest(F.least(goal - (offset + e * F.col("source_size")), F.col("size")), F.lit(0)) for e in range(most)])
    placed = placed.withColumn("epochs", epochs)
    demand = sources.agg(F.sum("target").alias("a"), F.sum(F.col("target") * F.col("slope")).alias("b")).first()
    a, b = F.lit(float(demand.a or 0)), F.lit(float(demand.b or 0))

    def position(e: int) -> Column:
        t = _time((offset + e * F.col("source_size")).cast("double"), F.col("target"), F.col("slope"))
        return F.when(F.col("epochs")[e] > 0, a * t + b * (t * t - t))

    return placed.select(
        "doc_id", "source", "h", "size", F.col("source_size").cast("long").alias("source_size"), F.col("target").cast("double").alias("target"),
        F.aggregate("epochs", F.lit(0).cast("long"), lambda s, x: s + x).alias("taken"), "epochs", F.array(*[position(e) for e in range(most)]).alias("positions"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs in training order, each as often as the mix trains on at least half of it; columns as they are.

    Documents without words take no part in a mix and are kept once, at the end. Of rows equal in doc_id and text, each is trained on
    as often as the one of them that is taken most.
    """
    mix = curriculum(docs, **options)
    kept = F.filter(F.arrays_zip("epochs", "positions"), lambda x: (x["epochs"] * 2 >= F.col("size")) & (F.col("size") > 0))["positions"]
    at = F.when(F.col("size") == 0, F.array(F.lit(float("inf")))).otherwise(kept)
    mix = mix.select(F.col("doc_id").alias("mix_id"), F.col("h").alias("mix_h"), at.alias("mix_at")).where(F.size("mix_at") > 0)
    mix = spill(mix.groupBy("mix_id", "mix_h").agg(F.max(F.struct(F.size("mix_at").alias("n"), F.col("mix_at")))["mix_at"].alias("mix_at")), "mix_plan")
    key = F.xxhash64(docs["doc_id"], docs["text"])
    joined = docs.join(mix, docs["doc_id"].eqNullSafe(F.col("mix_id")) & (key == F.col("mix_h")))
    return joined.withColumn("mix_at", F.explode("mix_at")).orderBy("mix_at", "mix_h").select(*docs.columns)
