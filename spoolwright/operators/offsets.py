"""Byte-offset index of line files: where each line starts and ends, and lookup by offset."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank


def line_offsets(files: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_number (from 1, blank lines counted), start_offset, end_offset, line; blank lines emit nothing.

    end_offset is behind the line break; a last line without one ends at the end of the file.
    """
    lines = files.select(key, F.octet_length(text).cast("long").alias("bytes"), F.posexplode(F.split(text, "\n")).alias("i", "line"))
    so_far = Window.partitionBy(key).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.octet_length("line").cast("long") + 1).over(so_far)
    out = lines.withColumn("e", end)
    return out.where(~is_blank(F.col("line"))).select(
        key, (F.col("i") + 1).cast("long").alias("line_number"), (F.col("e") - F.octet_length("line") - 1).alias("start_offset"), F.least("e", "bytes").alias("end_offset"), "line"
    )


def lookup(index: DataFrame, files: DataFrame, key: str, text: str, block: int = 16 << 10) -> DataFrame:
    """index with found, the bytes between its offsets as text. index: key, line_number, start_offset, end_offset and others.

    Files are cut into blocks of bytes, and an entry meets the blocks that it lies in, so that neither a file nor its entries come together
    in a row; entries within a block need no more than that.
    """
    raw = files.select(key, F.encode(text, "UTF-8").alias("raw"))
    last = lambda n: F.call_function("div", F.greatest(n - 1, F.lit(0)).cast("bigint"), F.lit(block).cast("bigint"))
    blocks = raw.select(key, "raw", F.explode(F.sequence(F.lit(0).cast("bigint"), last(F.octet_length("raw")))).alias("block"))
    blocks = blocks.select(key, "block", F.substring("raw", (F.col("block") * block + 1).cast("int"), F.lit(block)).alias("bytes"))
    first = F.call_function("div", F.col("start_offset"), F.lit(block).cast("bigint"))
    asked = index.withColumn("from_block", first).withColumn("to_block", F.greatest(first, last(F.col("end_offset"))))
    met = asked.withColumn("block", F.explode(F.sequence("from_block", "to_block"))).join(blocks, [key, "block"])
    at = F.greatest(F.col("start_offset") - F.col("block") * block, F.lit(0))
    piece = F.substring("bytes", (at + 1).cast("int"), (F.least(F.col("end_offset") - F.col("block") * block, F.lit(block)) - at).cast("int"))
    met = met.withColumn("piece", piece)
    kept = [c for c in index.columns if c != key]
    within = met.where("from_block = to_block").select(key, *kept, F.decode("piece", "UTF-8").alias("found"))
    # pieces of one entry: as many as the blocks that it spans
    joined = F.aggregate(F.array_sort(F.collect_list(F.struct("block", "piece"))), F.lit(b""), lambda a, p: F.concat(a, p["piece"]))
    across = met.where("from_block < to_block").groupBy(key, *kept).agg(F.decode(joined, "UTF-8").alias("found"))
    return within.unionByName(across)
