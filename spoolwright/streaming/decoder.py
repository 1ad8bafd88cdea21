"""The progressive decoder as keyed state: token blocks come in as a stream, samples go out, and what the next block needs is carried."""

from __future__ import annotations

import time
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..codec import ResidualCodec

WAVES = "emit_begin long, samples array<double>"


class ProgressiveDecoder(StatefulProcessor):
    """State of a key: its last context + tail tokens, how many it has had, blocks that came before their turn, and its timer."""

    def __init__(self, codec: Callable[[], object], context: int, tail: int, idle_seconds: float | None):
        self.make, self.context, self.tail, self.idle = codec, context, tail, idle_seconds

    def init(self, handle) -> None:
        self.handle, self.codec = handle, self.make()
        self.carried = handle.getListState("carried", "frame array<int>")
        self.waiting = handle.getListState("waiting", "block_no long, tokens array<array<int>>, last boolean")
        self.place = handle.getValueState("place", "seen long, next_block long")

    def _decode(self, carried: np.ndarray, tokens: np.ndarray, seen: int, last: bool) -> tuple[list, np.ndarray]:
        """(rows to give out, tokens to carry) after a block that begins behind `seen` tokens."""
        need, p = self.context + self.tail, self.codec.samples_per_token
        held = np.concatenate([carried, tokens], 1) if carried.size else tokens
        total, begin = seen + tokens.shape[1], seen + tokens.shape[1] - held.shape[1]
        out = []
        if total >= need or last:
            first = 0 if seen < need else seen - self.tail
            end = total if last else total - self.tail
            if end > first:
                wave = self.codec.decode(held)
                out.append((first, wave[(first - begin) * p : (end - begin) * p].tolist()))
        return out, held[:, max(0, held.shape[1] - need) :] if need else held[:, :0]

    def _give(self, key, rows: list) -> pd.DataFrame:
        return pd.DataFrame([(*key, *r) for r in rows], columns=["key", "emit_begin", "samples"])

    def _forget(self) -> None:
        for state in (self.carried, self.waiting, self.place):
            state.clear()

    def handleInputRows(self, key, rows, timerValues):
        blocks = {int(b): (np.array(t, np.int32), bool(e)) for b, t, e in self.waiting.get()} if self.waiting.exists() else {}
        for frame in rows:
            for b, t, e in zip(frame.block_no, frame.tokens, frame["last"], strict=True):
                blocks[int(b)] = (np.array([list(x) for x in t], np.int32), bool(e))
        seen, turn = self.place.get() if self.place.exists() else (0, 0)
        carried = np.array([f[0] for f in self.carried.get()], np.int32).T if self.carried.exists() else np.empty((0, 0), np.int32)
        out, ended = [], False
        while turn in blocks and not ended:
            tokens, ended = blocks.pop(turn)
            given, carried = self._decode(carried, tokens, seen, ended)
            out += given
            seen, turn = seen + tokens.shape[1], turn + 1
        if self.idle is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
        if ended:  # nothing is kept of a key whose last block has come
            self._forget()
        else:
            self.place.update((seen, turn))
            if carried.size:
                self.carried.put([(f.tolist(),) for f in carried.T])
            if blocks:
                self.waiting.put([(b, t.tolist(), e) for b, (t, e) in sorted(blocks.items())])
            else:
                self.waiting.clear()
            if self.idle is not None:
                now = timerValues.getCurrentProcessingTimeInMs() if timerValues is not None else int(1000 * time.time())
                self.handle.registerTimer(now + int(1000 * self.idle))
        yield self._give(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        """A key that has been silent for too long ends where it is: what was held back is given out."""
        seen, _ = self.place.get() if self.place.exists() else (0, 0)
        out = []
        if self.carried.exists():
            held = np.array([f[0] for f in self.carried.get()], np.int32).T
            first = 0 if seen < self.context + self.tail else seen - self.tail
            if seen > first:
                wave, p, begin = self.codec.decode(held), self.codec.samples_per_token, seen - held.shape[1]
                out.append((first, wave[(first - begin) * p :].tolist()))
        self._forget()
        yield self._give(key, out)

    def close(self) -> None:
        pass


def progressive_waves(stream: DataFrame, codec: Callable[[], object] = ResidualCodec, context: int = 50, tail: int = 50, idle_seconds: float | None = None) -> DataFrame:
    """key, emit_begin (in tokens) and samples of a stream of blocks: key, block_no (from 0), tokens (codebooks by frames) and last.

    The samples of a key, in order, are those of decode_piecewise() with the same blocks. Blocks may come in any order and in any
    micro-batch; a block that repeats one which had its turn is left out. A key that ends, by its last block or by idle_seconds without
    any, leaves no state. Needs the RocksDB state store.
    """
    kind = stream.schema["key"].dataType.simpleString()
    mode = "None" if idle_seconds is None else "ProcessingTime"
    return stream.groupBy("key").transformWithStateInPandas(ProgressiveDecoder(codec, context, tail, idle_seconds), f"key {kind}, {WAVES}", "append", mode)
