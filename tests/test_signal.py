import io
import struct

import numpy as np
import pytest

from spoolwright import headers
from spoolwright.codec import read_wave, write_wave
from spoolwright.resample import Resampler, resample


def tone(hz, rate, seconds=0.5):
    return np.sin(2 * np.pi * hz * np.arange(int(rate * seconds)) / rate)


@pytest.mark.parametrize(("old", "new"), [(44_100, 24_000), (48_000, 24_000), (16_000, 24_000), (22_050, 24_000), (8_000, 24_000), (24_000, 44_100), (3, 2), (1, 5)])
def test_chunks_equal_the_whole(old, new):
    g = np.random.default_rng(old)
    x = g.normal(size=5000)
    whole = resample(x, old, new)
    assert len(whole) == -(-len(x) * new // old)
    for sizes in ([1] * 40 + [4960], [7, 0, 1000, 3, 3990], [2500, 2500]):
        r, at, out = Resampler(old, new), 0, []
        for n in sizes:
            out.append(r.push(x[at : at + n]))
            at += n
        out.append(r.finish())
        assert len(np.concatenate(out)) == len(whole) and np.abs(np.concatenate(out) - whole).max() < 1e-12
    assert len(resample(np.empty(0), old, new)) == 0


def test_filter_against_the_defining_sum():
    from spoolwright.resample import kernel

    x, up, down = np.random.default_rng(2).normal(size=300), 80, 147
    h = kernel(up, down)
    wide = np.zeros(len(x) * up)
    wide[::up] = x
    plain = np.convolve(wide, h)[len(h) // 2 :][: len(wide)][::down]
    assert np.abs(resample(x, 44_100, 24_000) - plain).max() < 1e-12


def test_tones_pass_and_aliases_are_damped():
    inner = slice(2000, -2000)
    low = resample(tone(1000, 44_100), 44_100, 24_000)
    assert np.abs(low[inner] - tone(1000, 24_000)[inner]).max() < 1e-3
    for hz in (12_500, 15_000, 21_000):  # above the new half rate of 12 kHz
        high = resample(tone(hz, 44_100), 44_100, 24_000)
        assert 20 * np.log10(np.abs(high[inner]).max()) < -60
    up = resample(tone(3000, 16_000), 16_000, 24_000)
    assert np.abs(up[inner] - tone(3000, 24_000)[inner]).max() < 1e-3


def test_clips_are_resampled_when_read():
    x, meta = read_wave(write_wave(0.5 * tone(500, 48_000), 48_000), 24_000, trim=False)
    assert len(x) == 12_000 and meta["sample_rate"] == 48_000 and np.abs(x[500:-500] - 0.5 * tone(500, 24_000)[500:-500]).max() < 1e-3


def mp3(frames, kbps=None, version=1, rate=0, mono=False, info=None, crc=False, layer=3):
    """Frames of silence: headers that say so, and zeros."""
    out = b""
    table = headers.BIT_RATES[1 if version == 1 else 2, layer]
    for i in range(frames + (info is not None)):
        k = table.index(kbps[i % len(kbps)]) + 1
        head = bytes([0xFF, 0xE0 | {1: 3, 2: 2, 2.5: 0}[version] << 3 | (4 - layer) << 1 | (not crc), k << 4 | rate << 2, 0xC0 if mono else 0])
        body = bytearray(headers.frame(head)["length"])
        body[:4] = head
        if info is not None and i == 0:
            side = 4 + 2 * crc + ((17 if mono else 32) if version == 1 else (9 if mono else 17))
            body[side : side + len(info)] = info
        out += bytes(body)
    return out


def told(data):
    read = headers.Counted(io.BytesIO(data), 0, len(data))
    return headers.metadata(read, len(data)), read.bytes


def test_constant_rate_with_tags():
    body = mp3(100, [128])
    plain, _ = told(body)
    assert plain == {"sample_rate": 44100, "num_channels": 2, "duration_seconds_from_header": 8 * len(body) / 128_000, "begin_stream_seconds_from_header": 0.0, "bit_rate": 128_000.0, "codec": "mp3", "stream_index": 0, "sample_format": "fltp"}
    tag = b"ID3\x04\x00\x00" + bytes([0, 0, 30, 0]) + b"\xff\xfb\x90\x00" * 960
    ape = b"x" * 40 + b"APETAGEX" + struct.pack("<IIII8x", 2000, 72, 1, 0)
    assert told(tag + body + ape + b"TAG" + bytes(125))[0] == plain
    assert told(b"\xff\xfb junk \xff" + body)[0] == plain
    for version, rate, mono, hz in ((1, 1, True, 48_000), (2, 0, False, 22_050), (2.5, 2, True, 8_000)):
        meta = told(mp3(20, [64], version, rate, mono))[0]
        assert (meta["sample_rate"], meta["num_channels"], meta["bit_rate"]) == (hz, 1 if mono else 2, 64_000.0)
    assert told(mp3(20, [192], layer=2))[0]["codec"] == "mp2" and told(mp3(20, [192], layer=1))[0]["codec"] == "mp1"


def test_variable_rate_headers():
    lame = b"LAME3.100" + bytes(12) + bytes([576 >> 4, (576 & 15) << 4 | 1000 >> 8, 1000 & 255])
    for crc in (False, True):
        body = mp3(500, [64, 320, 128], info=b"Xing" + struct.pack(">III", 3, 500, 123_456) + lame, crc=crc)
        meta, cost = told(body)
        assert meta["duration_seconds_from_header"] == (500 * 1152 - 1576) / 44_100 and meta["begin_stream_seconds_from_header"] == (576 + 529) / 44_100
        assert meta["bit_rate"] == 8 * 123_456 / (500 * 1152 / 44_100) and cost < 80_000 < len(body)
    no_name = told(mp3(30, [64], info=b"Info" + struct.pack(">II", 1, 30)))[0]
    assert no_name["duration_seconds_from_header"] == 30 * 1152 / 44_100 and no_name["begin_stream_seconds_from_header"] == 0
    vbri = told(mp3(30, [64], info=b"VBRI" + struct.pack(">HHHII", 1, 0, 0, 9999, 30)))[0]
    assert vbri["duration_seconds_from_header"] == 30 * 1152 / 44_100 and vbri["bit_rate"] == 8 * 9999 / (30 * 1152 / 44_100)


@pytest.mark.parametrize("data", [b"", b"junk", b"\xff" * 4000, b"ID3\x04\x00\x00\x00\x00\x7f\x7f" + b"x" * 100, mp3(1, [128])[:-1], b"RIFF\x00\x00\x00\x00WAVE", b"RIFF1234AVI ", b"RIFF\x00\x00\x00\x00WAVEdata\x04\x00\x00\x00abcd"])
def test_damaged_files_are_refused(data):
    with pytest.raises(ValueError):
        told(data)


def test_wav_headers_equal_the_decoded_ones():
    data = write_wave(0.3 * tone(300, 22_050), 22_050)
    meta, cost = told(data)
    decoded = read_wave(data)[1]
    assert meta == decoded | {"codec": "pcm_s16le"} and cost < 100


def test_rounded_as_sql_rounds(spark):
    import duckdb
    from pyspark.sql import functions as F

    from spoolwright.functions import signal

    g = np.random.default_rng(4)
    ties = (g.integers(-(10**7), 10**7, 3000) + 0.5) / 1e6
    xs = [*ties, *np.nextafter(ties[:1000], 0), *(1e-6 * g.normal(size=1000)), 0.0, -0.0, 5e-7, -5e-7, -4e-7, 2.0**52 + 0.5, 1e305, np.inf, -np.inf, np.nan]
    got = [r[0] for r in spark.createDataFrame([(float(x),) for x in xs], "x double").coalesce(1).select(signal.rounded(F.col("x"), 6)).collect()]
    wanted = [r[0] for r in duckdb.execute("SELECT round(x, 6) FROM (SELECT unnest(?::DOUBLE[]) AS x)", [[float(x) for x in xs]]).fetchall()]
    assert [repr(x) for x in got] == [repr(x) for x in wanted]


@pytest.mark.parametrize("name", ["mixed_channels", "mono_mix", "peak_normalise", "trim_silence"])
def test_waves_match_sql_on_odd_vectors(spark, tmp_path, name):
    """Means, peaks and samples that are ties in binary or decimal, or round to -0.0; vectors that are null, short, or hold nulls."""
    import oracle
    import pyarrow as pa
    from pyarrow import parquet

    from spoolwright import catalogue

    g = np.random.default_rng(5)
    half = (g.integers(0, 10**6, (300, 64)) + 0.5) / 1e6
    rows = [*half, *(half * 4), *(1e-6 * g.normal(size=(200, 64))), np.full(64, -1e-7), np.full(64, -0.0), np.full(64, np.nan)]
    rows = [r.tolist() for r in rows] + [None, [], [0.5] * 40, [2.0, None] * 32]
    parquet.write_table(pa.table({"vec_id": list(range(len(rows))), "embedding": pa.array(rows, pa.list_(pa.float32()))}), tmp_path / "embeddings.parquet")
    assert oracle.same(spark, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name], str(tmp_path)) == len(rows)
