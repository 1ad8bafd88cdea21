"""Overlapping fragments for encoding, and blocks with context and tail for progressive decoding, in closed form.

Encoding: fragments of `most` tokens overlap by `overlap` on either side, so they advance by most - 2 * overlap tokens; all but the
first drop the overlap at their head, all but the last at their tail. Decoding: blocks of `block` tokens are decoded together with the
`context + tail` tokens before them; the context is dropped, and the last `tail` tokens wait for the next block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ceil_div as _ceil_div


def with_fragments(df: DataFrame, samples: str, per_token: int, most: int, overlap: int) -> DataFrame:
    """df with a row for each fragment: fragment, n_fragments, begin and end in samples, kept_begin and kept_end in tokens.

    An empty waveform has one empty fragment. Requires most > 2 * overlap and overlap >= 0.
    """
    if overlap < 0 or most <= 2 * overlap or per_token < 1:
        raise ValueError("most must exceed twice the overlap")
    n, step, size = F.col(samples).cast("long"), most - 2 * overlap, most * per_token
    count = F.when(n <= size, F.lit(1).cast("long")).otherwise(_ceil_div(n - size, step * per_token) + 1)
    out = df.withColumn("n_fragments", count).withColumn("fragment", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_fragments") - 1)))
    k, last = F.col("fragment"), F.col("fragment") == F.col("n_fragments") - 1
    return out.withColumns({
        "begin": k * step * per_token,
        "end": F.least(k * step * per_token + size, n),
        "kept_begin": k * step + F.when(k > 0, overlap).otherwise(0),
        "kept_end": F.when(last, _ceil_div(n, per_token)).otherwise(k * step + most - overlap),
    })


def fragment_ranges(samples: Column, most: int, overlap: int) -> Column:
    """The kept ranges of a waveform of one sample a token as an array (begin, end), so that pieces can be cut within a row."""
    if overlap < 0 or most <= 2 * overlap:
        raise ValueError("most must exceed twice the overlap")
    n, step = samples.cast("long"), most - 2 * overlap
    last = F.when(n <= most, F.lit(0).cast("long")).otherwise(_ceil_div(n - most, step))
    one = lambda k: F.struct((k * step + F.when(k > 0, overlap).otherwise(0)).alias("begin"), F.when(k == last, n).otherwise(k * step + most - overlap).alias("end"))
    return F.transform(F.sequence(F.lit(0).cast("long"), last), one)


def block_ranges(tokens: Column, block: int, context: int, tail: int) -> Column:
    """What each block of with_blocks() emits, as an array (begin, end) within a row."""
    t, carry = tokens.cast("long"), context + tail
    last = lambda k: (k + 1) * block >= t
    begin = lambda k: F.when(k * block < carry, F.lit(0).cast("long")).otherwise(k * block - tail)
    one = lambda k: F.struct(begin(k).alias("begin"), F.when(last(k), t).otherwise((k + 1) * block - tail).alias("end"))
    all_blocks = F.filter(F.sequence(F.lit(0).cast("long"), F.greatest(_ceil_div(t, block) - 1, F.lit(0).cast("long"))), lambda k: ((k + 1) * block >= carry) | last(k))
    return F.when(t > 0, F.transform(all_blocks, one))


def cut(text: Column, ranges: Column) -> Column:
    """The pieces of a text at ranges (begin, end)."""
    return F.transform(ranges, lambda r: F.substr(text, (r["begin"] + 1).cast("int"), (r["end"] - r["begin"]).cast("int")))


def with_blocks(df: DataFrame, tokens: str, block: int, context: int, tail: int, strict: bool = False) -> DataFrame:
    """df with a row for each block that emits: block_no, read_begin, read_end, emit_begin, emit_end in tokens.

    strict: inputs of fewer than context + tail tokens emit nothing; otherwise they are decoded as one block.
    """
    if block < 1 or context < 1 or tail < 0:
        raise ValueError("block and context must be positive, tail not negative")
    t, carry = F.col(tokens).cast("long"), context + tail
    out = df.where(t > 0).withColumn("block_no", F.explode(F.sequence(F.lit(0).cast("long"), _ceil_div(t, block) - 1)))
    k = F.col("block_no")
    so_far, before = F.least((k + 1) * block, t), F.least(k * block, t)
    last = (k + 1) * block >= t
    emits, first = so_far >= carry, before < carry
    if not strict:
        emits = emits | last
    return out.where(emits).withColumns({
        "read_begin": F.when(first, F.lit(0).cast("long")).otherwise(k * block - carry),
        "read_end": so_far,
        "emit_begin": F.when(first, F.lit(0).cast("long")).otherwise(k * block - tail),
        "emit_end": F.when(last, t).otherwise(so_far - tail),
    })


def stitch(parts: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Strings or arrays of each key, concatenated in order. A key's parts are one document's, and come together in one task."""
    rows = F.array_sort(F.collect_list(F.struct(order, value)))
    joined = F.transform(rows, lambda r: r[value])
    is_text = parts.schema[value].dataType.simpleString() == "string"
    return parts.groupBy(*keys).agg((F.array_join(joined, "") if is_text else F.flatten(joined)).alias(value))
