import io
import tarfile

import numpy as np
import pytest

from spoolwright.codec import read_wave, write_wave
from spoolwright.functions import text
from spoolwright.operators import manifest, merge, offsets, progress
from spoolwright.plans import audio
from spoolwright.sources import records
from spoolwright.sources.tar import fetch, read_members


def make_tar(path, members, mode="w"):
    with tarfile.open(path, mode) as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def tone(n, level=0.5):
    return write_wave(level * np.sin(np.arange(1, n + 1) / 20), 24_000)


def test_tar_members_and_seeks(spark, tmp_path):
    a, b = tone(2000), tone(500)
    make_tar(tmp_path / "x.tar", [("a.WAV", a), ("n.txt", b"no"), ("b.wav", b), ("a.WAV", b)])
    make_tar(tmp_path / "y.tar.gz", [("c.wav", a)], "w:gz")
    m = read_members(spark, [str(tmp_path / "x.tar"), str(tmp_path / "y.tar.gz")], [".wav"])
    assert [r.audio_file for r in m.orderBy("tar_path", "member_index").collect()] == ["a.WAV", "b.wav", "a.WAV", "c.wav"]
    assert [bytes(r.content) for r in fetch(m).orderBy("tar_path", "member_index").collect()] == [a, b, b, a]
    assert read_members(spark, [str(tmp_path / "x.tar")], [".WAV"]).count() == 0


def test_tokenize_resumes(spark, tmp_path):
    make_tar(tmp_path / "1.tar", [("a.wav", tone(5000)), ("bad.wav", b"junk"), ("b.wav", tone(3000))])
    out = str(tmp_path / "out")
    first = audio.tokenize(spark, [str(tmp_path / "1.tar")], out)
    assert {(r.audio_file, r.error is None) for r in first.collect()} == {("a.wav", True), ("b.wav", True), ("bad.wav", False)}
    make_tar(tmp_path / "2.tar", [("c.wav", tone(100))])
    again = audio.tokenize(spark, [str(tmp_path / "1.tar"), str(tmp_path / "2.tar")], out)
    assert again.count() == 4
    listed = {r.audio_file: r for r in audio.list_entries(again).collect()}
    assert listed["a.wav"].num_tokens == 6 and listed["bad.wav"].is_error and listed["c.wav"].num_samples == 100
    done = {r.audio_file: r for r in audio.decode(again).collect()}
    assert done["bad.wav"].status == "failed" and done["a.wav"].output_name == "a_reconstructed.wav"
    assert len(read_wave(bytes(done["a.wav"].wav), trim=False)[0]) == 6 * 960


def test_wave_clean_up():
    import wave

    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(np.array([[0, 0], [100, 300], [0, 0], [50, 50], [0, 0]], "<i2").tobytes())
    x, meta = read_wave(buffer.getvalue())
    assert np.allclose(x * 32768, [200, 0, 50]) and meta["num_channels"] == 2
    assert len(read_wave(write_wave(np.zeros(9), 8000))[0]) == 0
    with pytest.raises(ValueError):
        read_wave(write_wave(np.empty(0), 8000))


def test_lenient_and_strict_records(spark, tmp_path):
    (tmp_path / "r.jsonl").write_text('{"audio_file": "a", "tokens": [[1]]}\n\n{"audio_file": "b", "tok\n{"audio_file": "c", "error": "x"}')
    (tmp_path / "empty.jsonl").write_text("")
    (tmp_path / "p.jsonl.partial").write_text("x")
    assert sorted(r.audio_file for r in records.read_results(spark, str(tmp_path / "r.jsonl")).collect()) == ["a", "c"]
    with pytest.raises(Exception):  # noqa: B017
        records.read_results(spark, str(tmp_path / "r.jsonl"), strict=True).collect()
    assert {(r.stem, r.kind, r.size > 0) for r in records.list_outputs(spark, str(tmp_path)).collect()} == {("r", "final", True), ("empty", "final", False), ("p", "partial", True)}


def test_manifest_order_and_ranges(spark, tmp_path):
    (tmp_path / "m.txt").write_text("/a/3.tar\n\n /a/1.tar \n/a/x.tar\n/a/2.tar")
    m = manifest.read_manifest(spark, str(tmp_path / "m.txt"))
    assert [r.tar_stem for r in m.orderBy("pos").collect()] == ["3", "1", "x", "2"]
    assert {r.tar_stem for r in manifest.select_range(m, start=2).collect()} == {"3", "2"}
    assert manifest.preview(m).count() == 4
    empty = m.limit(0)
    assert progress.progress_summary(progress.tar_status(empty, spark.createDataFrame([], "stem string, kind string"))).first().complete_pct is None


def test_selections_and_jobs(spark):
    assert text.parse_selection("1,3-5,7:9") == [(1, 1), (3, 5), (7, 9)]
    for bad in ("-1", "1,", "1-2-3", "a"):
        with pytest.raises(ValueError):
            text.parse_selection(bad)
    df = spark.createDataFrame([("9_[1-4]",), ("9_[3]",), ("9_7",), ("9_[1,3-5]",), ("9_[1-4%2]",)], "j string")
    from pyspark.sql import functions as F

    assert [r[0] for r in df.select(text.task_count(F.col("j"))).collect()] == [4, 1, 1, 1, 1]


def test_offsets_and_merge(spark):
    files = spark.createDataFrame([("f", "ä\n\n  \nxy\nlast"), ("g", "")], "f string, t string")
    x = offsets.line_offsets(files, "f", "t")
    assert [(r.line_number, r.start_offset, r.end_offset) for r in x.orderBy("line_number").collect()] == [(1, 0, 3), (4, 7, 10), (5, 10, 14)]
    a = spark.createDataFrame([("t", i, n) for i, n in enumerate("abc")], "t string, i int, n string")
    b = spark.createDataFrame([("t", i, n) for i, n in enumerate("ax")], "t string, i int, n string")
    m = merge.positional_merge(a, b, ["t"], "i", "n")
    assert [r.state for r in m.orderBy("k").collect()] == ["ok", "mismatch", "right_short"]
    assert not merge.committable(m, ["t"]).first().commit
