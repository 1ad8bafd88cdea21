"""Incremental runs: files as a stream with a checkpoint, and the progressive decoder as keyed state."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout


def run_available(spark: SparkSession, source: str, schema: T.StructType, sink: str, checkpoint: str, transform=lambda df: df) -> None:
    """Process the files of a folder that the checkpoint doesn't know yet, then stop; running again adds nothing."""
    q = transform(spark.readStream.schema(schema).parquet(source)).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


BLOCKS = "key long, emit_begin long, emit_end long"
PLACES = ("keys", "seen", "given", "turns")  # of keys under way, ascending: tokens seen, tokens given out, the next block's number
WAITING = ("w_keys", "w_numbers", "w_tokens", "w_last")  # blocks that came before their turn


def _head(keys: np.ndarray) -> np.ndarray:
    """True where a run of one key begins."""
    return np.append(True, keys[1:] != keys[:-1])[: len(keys)]


def _since(values: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Running sums that begin anew at every head."""
    sums, first = np.cumsum(values), np.flatnonzero(head)
    return sums - np.repeat(sums[first] - values[first], np.diff(np.append(first, len(values))))


def emitted(places: list, waiting: list, blocks: list, numbered: bool, context: int, tail: int) -> tuple[list, list, tuple]:
    """(places, waiting, (keys, begins, ends) given out) after a batch of blocks of any keys, as arrays: keys, numbers, tokens and last.

    Blocks that are not numbered follow each other as they stand in the batch; a key whose last block has come begins anew with its next one.
    """
    keys, numbers, tokens, last = (np.concatenate(x) for x in zip(waiting, blocks, strict=True)) if len(waiting[0]) else blocks
    order = np.lexsort((numbers, keys)) if numbered else np.argsort(keys, kind="stable")
    keys, numbers, tokens, last = (x[order] for x in (keys, numbers, tokens, last))
    head = _head(keys)
    known, at = places[0], np.searchsorted(places[0], keys)
    held = np.zeros(len(keys), bool)
    held[at < len(known)] = known[at[at < len(known)]] == keys[at < len(known)]
    seen0, given0, turn0 = (np.where(held, x[np.minimum(at, len(x) - 1)], 0) if len(x) else np.zeros(len(keys), np.int64) for x in places[1:])

    late = [np.empty(0, x.dtype) for x in (keys, numbers, tokens, last)]
    if numbered:
        again = (numbers < turn0) | (~head & (numbers == np.append(0, numbers[:-1])[: len(numbers)]))  # had its turn, or stands here twice
        rows = [x[~again] for x in (keys, numbers, tokens, last, seen0, given0, turn0)]
        head = _head(rows[0])
        on_turn = rows[1] == rows[6] + _since(np.ones(len(head), np.int64), head) - 1
        ended = _since(rows[3].astype(np.int64), head) - rows[3] > 0  # behind the last block: dropped
        closed = np.isin(rows[0], rows[0][on_turn & rows[3]])
        wait = ~on_turn & ~closed
        late = [x[wait] for x in rows[:4]]
        keys, numbers, tokens, last, seen0, given0, turn0 = (x[on_turn & ~ended] for x in rows)
        head = _head(keys)
    else:
        fresh = ~head & np.append(False, last[:-1])[: len(last)]  # the key's last block stands before this one
        first = _since(fresh.astype(np.int64), head) > 0
        seen0, given0, turn0 = (np.where(first, 0, x) for x in (seen0, given0, turn0))
        head = head | fresh

    seen = seen0 + _since(tokens, head)
    end = np.where(last, seen, seen - tail)
    due = last | (seen >= context + tail)
    reached = np.where(due, np.maximum(end, given0), given0)  # tokens given out once the block has had its turn
    begin = np.where(head, given0, np.append(0, reached[:-1])[: len(reached)])
    out = due & (end > begin)
    turns = turn0 + _since(np.ones(len(head), np.int64), head)

    tip = np.append(keys[1:] != keys[:-1], True)[: len(keys)] & ~last
    stay = ~np.isin(known, keys)
    new = [np.concatenate([a[stay], b[tip]]) for a, b in zip(places, (keys, seen, reached, turns), strict=True)]
    order = np.argsort(new[0])
    return [x[order] for x in new], late, (keys[out], begin[out], end[out])


def progressive_blocks(stream: DataFrame, context: int, tail: int, buckets: int = 4096) -> DataFrame:
    """stream: key, n_tokens, last and, if blocks may come out of order, block_no (from 0). Emits for each key the token ranges that a progressive
    decoder gives out, holding context + tail back. A last block emits all that is left, however short.

    Keys are dealt over buckets, which stay the same as long as the checkpoint does; a bucket's state is that of its keys under way, and its
    blocks are taken many keys at once. With block_no a block that repeats one which had its turn is left out; without, blocks count as they come.
    """
    numbered = "block_no" in stream.columns

    def step(bucket, frames, state):
        held = [np.array(x, np.int64) for x in state.get] if state.exists else [np.empty(0, np.int64)] * (len(PLACES) + len(WAITING))
        places, waiting = held[: len(PLACES)], [*held[len(PLACES) : -1], held[-1].astype(bool)]
        for f in frames:
            n = f.n_tokens.to_numpy(np.int64)
            blocks = [f.key.to_numpy(np.int64), f.block_no.to_numpy(np.int64) if numbered else np.zeros(len(n), np.int64), n, f["last"].to_numpy(bool)]
            places, waiting, (keys, begins, ends) = emitted(places, waiting, blocks, numbered, context, tail)
            if len(keys):
                yield pd.DataFrame({"key": pd.array([None] * len(keys), "Int64") if bucket[0] else keys, "emit_begin": begins, "emit_end": ends})
        if len(places[0]) or len(waiting[0]):
            state.update(tuple(x.tolist() for x in [*places, *waiting[:-1], waiting[-1].astype(np.int64)]))
        elif state.exists:  # nothing is kept of keys whose last block has come
            state.remove()

    # rows without a key are a key of their own
    dealt = stream.withColumns({"none": F.col("key").isNull(), "bucket": F.pmod(F.xxhash64("key"), F.lit(buckets)), "key": F.coalesce("key", F.lit(0))})
    kept = ", ".join(f"{n} array<long>" for n in PLACES + WAITING)
    return dealt.groupBy("none", "bucket").applyInPandasWithState(step, BLOCKS, kept, "append", GroupStateTimeout.NoTimeout)
