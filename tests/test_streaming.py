import random

import numpy as np
import pytest
from pyspark.sql import types as T

from spoolwright.streaming import incremental


def test_available_files_once(spark, tmp_path):
    src, sink, cp = (str(tmp_path / n) for n in ("src", "sink", "cp"))
    spark.range(5).write.parquet(src)
    schema = T.StructType([T.StructField("id", T.LongType())])
    for _ in range(2):
        incremental.run_available(spark, src, schema, sink, cp)
    assert spark.read.parquet(sink).count() == 5
    spark.range(5, 8).write.mode("append").parquet(src)
    incremental.run_available(spark, src, schema, sink, cp)
    assert spark.read.parquet(sink).count() == 8


def test_progressive_blocks(spark, tmp_path):
    src = str(tmp_path / "blocks")
    spark.createDataFrame([(1, 100, False)], "key long, n_tokens long, last boolean").write.parquet(src)
    stream = spark.readStream.schema("key long, n_tokens long, last boolean").parquet(src)
    q = incremental.progressive_blocks(stream, 12, 6).writeStream.format("memory").queryName("blocks").outputMode("append").start()
    try:
        q.processAllAvailable()
        spark.createDataFrame([(1, 30, True), (2, 5, True)], "key long, n_tokens long, last boolean").coalesce(1).write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(map(tuple, spark.table("blocks").collect())) == [(1, 0, 94), (1, 94, 130), (2, 0, 5)]


def plain_ranges(blocks, context, tail):
    """(ranges given out, keys under way with tokens seen and given out) of blocks in order, one by one."""
    held, out = {}, []
    for key, n, last in blocks:
        seen, given = held.get(key, (0, 0))
        seen += n
        end = seen if last else seen - tail
        if (last or seen >= context + tail) and end > given:
            out.append((key, given, end))
            given = end
        held[key] = (seen, given)
        if last:
            del held[key]
    return out, held


@pytest.mark.parametrize("numbered", [True, False])
def test_blocks_of_many_keys_equal_one_by_one(numbered):
    for seed in range(200):
        g = random.Random(seed)
        context, tail = g.randint(0, 12), g.randint(0, 8)
        if numbered:  # any order, in any batches, some twice
            ends = [g.random() < 0.7 for _ in range(5)]
            rows = [(k, i, g.randint(0, 20), ends[k] and i == n - 1) for k, n in enumerate([g.randint(1, 9) for _ in ends]) for i in range(n)]
            given = g.sample(rows, len(rows)) + [r for r in rows if not ends[r[0]]]
        else:  # keys in turn, which begin anew behind their last blocks
            rows = given = [(g.randrange(5), 0, g.randint(0, 20), g.random() < 0.2) for _ in range(40)]
        places, waiting, out = [np.empty(0, np.int64)] * 4, [*[np.empty(0, np.int64)] * 3, np.empty(0, bool)], []
        while given:
            n = g.randint(1, 8)
            batch, given = given[:n], given[n:]
            columns = [np.array([r[c] for r in batch], bool if c == 3 else np.int64) for c in range(4)]
            places, waiting, got = incremental.emitted(places, waiting, columns, numbered, context, tail)
            out += zip(*(x.tolist() for x in got), strict=True)
        wanted, held = plain_ranges([(k, n, e) for k, _, n, e in rows], context, tail)
        assert sorted(out) == sorted(wanted) and len(waiting[0]) == 0
        assert {k: (s, v) for k, s, v in zip(*(x.tolist() for x in places[:3]), strict=True)} == held


def test_blocks_out_of_order_and_state_by_bucket(spark, tmp_path):
    """Last blocks come first, over two runs; keys are taken many at once, so that there are no more states than buckets."""
    src, schema = str(tmp_path / "in"), "key long, block_no long, n_tokens long, last boolean"
    rows = [(k, b, 100 if b < 3 else 30, b == 3) for k in [None, *range(1000)] for b in range(4)]
    totals = []
    for part in (rows[::-2], rows[-2::-2]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        stream = incremental.progressive_blocks(spark.readStream.schema(schema).parquet(src), 12, 6, buckets=8)
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
        totals.append(sum(o["numRowsTotal"] for p in q.recentProgress[:1] for o in p["stateOperators"]))
    got = spark.read.schema(incremental.BLOCKS).parquet(str(tmp_path / "out")).collect()
    wanted = plain_ranges([(k, n, e) for k, _, n, e in rows], 12, 6)[0]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, wanted)) and len(wanted) == 4004
    assert 1 <= totals[0] <= 9 and totals[1] == 0
