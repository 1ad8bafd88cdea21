import random

import numpy as np
import pytest

from spoolwright.codec import ResidualCodec, decode_piecewise, encode_piecewise
from spoolwright.operators import fragments


def walk(n, most, overlap, p):
    """The fragments of a sequential encoder, with a codec of ceil(samples / p) tokens."""
    pos, end, out = 0, -1, []
    while end < n:
        begin = max(pos - overlap * p, 0)
        end = begin + most * p
        tokens = -(-(min(end, n) - begin) // p)
        head, tail = (overlap if pos > 0 else 0), (overlap if end < n else 0)
        out.append((begin, min(end, n), begin // p + head, begin // p + tokens - tail))
        pos += (tokens - head - tail) * p
    return out


def test_fragments_equal_sequential_walk(spark):
    g, cases = random.Random(1), []
    for _ in range(60):
        p, o = g.choice([1, 3, 960]), g.randint(1, 6)
        cases.append((g.randint(0, 6 * (2 * o + 5) * p), 2 * o + g.randint(1, 9), o, p))
    for most, o, p in {c[1:] for c in cases}:
        mine = [c[0] for c in cases if c[1:] == (most, o, p)]
        df = fragments.with_fragments(spark.createDataFrame([(i, n) for i, n in enumerate(mine)], "id long, n long"), "n", p, most, o)
        got = {}
        for r in df.orderBy("id", "fragment").collect():
            got.setdefault(r.id, []).append((r.begin, r.end, r.kept_begin, r.kept_end))
        for i, n in enumerate(mine):
            assert got[i] == walk(n, most, o, p)


def test_bad_sizes_are_refused(spark):
    df = spark.createDataFrame([(1,)], "n long")
    with pytest.raises(ValueError):
        fragments.with_fragments(df, "n", 1, 4, 2)
    with pytest.raises(ValueError):
        fragments.with_blocks(df, "n", 0, 1, 0)


def test_blocks_tile_their_input(spark):
    df = spark.createDataFrame([(t,) for t in range(1, 120)], "t long")
    for block, c, tail in ((40, 3, 2), (5, 12, 12), (1, 1, 0)):
        for strict in (False, True):
            by = {}
            for r in fragments.with_blocks(df, "t", block, c, tail, strict).orderBy("t", "block_no").collect():
                assert r.read_begin <= r.emit_begin <= r.emit_end <= r.read_end
                by.setdefault(r.t, []).append((r.emit_begin, r.emit_end))
            for t in range(1, 120):
                if strict and t < c + tail:
                    assert t not in by
                else:
                    spans = by[t]
                    assert spans[0][0] == 0 and spans[-1][1] == t and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_pieces_equal_the_whole():
    c, x = ResidualCodec(24_000, 4), np.random.default_rng(0).uniform(-1, 1, 1003)
    whole = c.encode(x)
    assert (encode_piecewise(c, x, 20, 3) == whole).all()
    for block in (7, 50, 1000):
        assert np.allclose(decode_piecewise(c, whole, block, 5, 4), c.decode(whole))
    assert np.abs(c.decode(whole)[: len(x)] - np.repeat(np.add.reduceat(np.append(x, 0), range(0, 1004, 4)) / 4, 4)[: len(x)]).max() < 0.01
    assert encode_piecewise(c, np.empty(0)).shape == (8, 0)
