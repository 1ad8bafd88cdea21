import numpy as np
import pytest

from spoolwright.codec import ResidualCodec, decode_piecewise
from spoolwright.streaming import decoder

SCHEMA = "key string, block_no long, tokens array<array<int>>, last boolean"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def blurred():
    """A codec whose samples depend on the frames beside them, so that context and tail matter."""

    class Blurred(ResidualCodec):
        def decode(self, tokens):
            y = super().decode(tokens)
            p = self.samples_per_token
            wide = np.concatenate([np.zeros(2 * p), y, np.zeros(2 * p)])
            return sum(wide[i * p : i * p + len(y)] * w for i, w in enumerate((0.1, 0.2, 0.4, 0.2, 0.1)))

    return Blurred(24_000, 3)


def maker():
    """blurred() as a function that workers can be sent, as they don't know this module."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(__import__(__name__))
    return blurred


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.set(PROVIDER, before)


def cut(key, tokens, block):
    n = tokens.shape[1]
    return [(key, k, tokens[:, k * block : (k + 1) * block].tolist(), (k + 1) * block >= n) for k in range(-(-n // block))]


def run(spark, folder, **options):
    waves = decoder.progressive_waves(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), maker(), 4, 3, **options)
    return waves.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")


def joined(spark, folder):
    out = {}
    for r in spark.read.schema(f"key string, {decoder.WAVES}").parquet(f"{folder}/out").orderBy("key", "emit_begin").collect():
        assert len(out.get(r.key, [])) == 3 * r.emit_begin  # no gap and no overlap
        out.setdefault(r.key, []).extend(r.samples)
    return out


def test_waves_equal_decoding_in_pieces_across_restarts(rocks, tmp_path):
    spark, g, folder = rocks, np.random.default_rng(4), str(tmp_path)
    clips = {f"k{i}": g.integers(0, 16, (8, n)).astype(np.int32) for i, n in enumerate((1, 5, 6, 7, 13, 20, 47, 60))}
    rows = [r for k, t in clips.items() for r in cut(k, t, 5)]
    steps = [[r for r in rows if r[1] in (0, 1, 4)], [r for r in rows if r[1] in (2, 3)], [r for r in rows if r[1] > 4], [rows[0], rows[3]]]
    for some in steps[:3]:  # the query is started anew for each part, in the middle of keys, and blocks come before their turn
        spark.createDataFrame(some[::-1], SCHEMA).write.mode("append").parquet(f"{folder}/in")
        run(spark, folder).trigger(availableNow=True).start().awaitTermination()
    got = joined(spark, folder)
    for k, t in clips.items():
        assert np.allclose(got[k], decode_piecewise(blurred(), t, 5, 4, 3), atol=1e-12), k
        assert len(got[k]) == 3 * t.shape[1]


def test_silent_keys_are_ended_by_a_timer(rocks, tmp_path):
    import time

    spark, folder = rocks, str(tmp_path)
    tokens = np.random.default_rng(1).integers(0, 16, (8, 15)).astype(np.int32)
    spark.createDataFrame(cut("a", tokens, 5)[:2], SCHEMA).write.parquet(f"{folder}/in")
    q = run(spark, folder, idle_seconds=1.0).trigger(processingTime="500 milliseconds").start()
    try:
        end = time.time() + 60
        while time.time() < end and len(joined(spark, folder).get("a", [])) < 30:
            time.sleep(1)
    finally:
        q.stop()
    assert np.allclose(joined(spark, folder)["a"], decode_piecewise(blurred(), tokens[:, :10], 5, 4, 3))
