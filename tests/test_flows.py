import io
import os
import tarfile
import time

import numpy as np
import pytest

from spoolwright.codec import ResidualCodec, lifted, measured_samples_per_token, read_wave, write_wave
from spoolwright.functions import text
from spoolwright.operators import fragments
from spoolwright.plans import audio, backfill, submission
from spoolwright.sources import files, lines, records


def tone(n):
    return write_wave(0.5 * np.sin(np.arange(1, n + 1) / 20), 24_000)


def make_tar(path, members):
    with tarfile.open(path, "w") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


@pytest.mark.parametrize("range_bytes", [1, 2, 3, 5, 64, 1 << 20])
def test_line_index_in_ranges(spark, tmp_path, range_bytes):
    data = "a\r\nbä\n\n \t\nc\rlast {\n{\"x\": 1}\r\n\r\nend".encode()
    (tmp_path / "f.jsonl").write_bytes(data)
    (tmp_path / "empty.jsonl").write_bytes(b"")
    want, at, out = [], 0, data.replace(b"\r\n", b"\x00\x00")
    for i, part in enumerate(p for p in data.splitlines(keepends=True)):
        if part.strip():
            want.append((i + 1, at, at + len(part), part.rstrip(b"\r\n").decode()))
        at += len(part)
    assert out and at == len(data)
    index = lines.index_lines(spark, [str(tmp_path / "f.jsonl"), str(tmp_path / "empty.jsonl")], range_bytes=range_bytes)
    back = lines.read_at(index).orderBy("line_number").collect()
    assert [(r.line_number, r.start_offset, r.end_offset, r.line) for r in back] == want
    assert all(r.found == r.line for r in back)
    assert [r.line for r in lines.index_lines(spark, [str(tmp_path / "f.jsonl")], json_only=True, range_bytes=range_bytes).collect()] == ['{"x": 1}']


def test_index_is_written_without_lines(spark, tmp_path):
    (tmp_path / "f").write_text("one\ntwo\n")
    lines.write_index(lines.index_lines(spark, [str(tmp_path / "f")]), str(tmp_path / "index"))
    assert [(r.line_number, r.start_offset, r.end_offset) for r in spark.read.json(str(tmp_path / "index")).orderBy("line_number").collect()] == [(1, 0, 4), (2, 4, 8)]
    assert lines.index_lines(spark, []).count() == 0


def test_listings_and_clean_up(spark, tmp_path):
    for n in ("b.jsonl", "a.jsonl", "x.txt", "old.temp", "new.temp"):
        (tmp_path / n).write_text("" if n == "b.jsonl" else "x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.jsonl").write_text("y")
    folder = str(tmp_path)
    names = lambda df: [os.path.basename(r.path) for r in df.collect()]
    assert names(files.list_files(spark, folder, "*.jsonl")) == ["a.jsonl", "b.jsonl"]
    assert names(files.list_files(spark, folder, "*.jsonl", recursive=True)) == ["a.jsonl", "b.jsonl", "c.jsonl"]
    assert files.list_files(spark, folder + "/none").count() == 0
    base = lambda given: [os.path.basename(p) for p in files.resolve_inputs(spark, given)]
    assert base(folder) == ["a.jsonl", "b.jsonl"] and base(folder + "/?.jsonl") == ["a.jsonl", "b.jsonl"] and base(folder + "/x.txt") == ["x.txt"] and base(folder + "/no") == []
    outputs, sent = records.list_outputs(spark, folder), spark.createDataFrame([("a",), ("b",)], "stem string")
    assert [os.path.basename(p) for p in files.delete_empty_outputs(spark, outputs, sent, dry_run=True)] == ["b.jsonl"] and (tmp_path / "b.jsonl").exists()
    files.delete_empty_outputs(spark, outputs, sent.where("stem = 'a'"))
    assert (tmp_path / "b.jsonl").exists()
    files.delete_empty_outputs(spark, outputs, sent)
    assert not (tmp_path / "b.jsonl").exists() and (tmp_path / "a.jsonl").exists()
    os.utime(tmp_path / "old.temp", (time.time() - 200 * 3600,) * 2)
    files.clean_temporary(spark, folder)
    assert not (tmp_path / "old.temp").exists() and (tmp_path / "new.temp").exists()
    (tmp_path / "staged").write_text("new")
    files.replace(spark, folder + "/staged", folder + "/x.txt")
    assert (tmp_path / "x.txt").read_text() == "new"
    with pytest.raises(FileNotFoundError):
        files.replace(spark, folder + "/staged", folder + "/x.txt")
    assert (tmp_path / "x.txt").exists()


def test_backfill_replaces_whole_files_only(spark, tmp_path):
    import json

    tars = tmp_path / "tars"
    tars.mkdir()
    for n in ("good", "short", "names"):
        make_tar(tars / f"{n}.tar", [("d/a.wav", tone(900)), ("notes.txt", b"-"), ("b.wav", tone(400))])
    rows = {"good": ["a.wav", "b.wav"], "short": ["a.wav"], "names": ["b.wav", "a.wav"], "alone": ["a.wav"]}
    for n, of in rows.items():
        old = [{"tar_file": n, "audio_file": a, "num_samples": 5, "tokens": [[1]], **({"original_metadata": {"codec": "kept"}} if a == "b.wav" else {})} for a in of]
        (tmp_path / f"{n}.jsonl").write_text("\n".join(map(json.dumps, old)) + "\n")
    before = {n: (tmp_path / f"{n}.jsonl").read_text() for n in rows}
    report = backfill.backfill(spark, [str(tmp_path / f"{n}.jsonl") for n in rows], str(tars))
    got = {os.path.basename(r.path): (r.status, r["rows"], r.updated) for r in report.collect()}
    assert got == {"good.jsonl": ("updated", 2, 1), "short.jsonl": ("mismatch", 1, 0), "names.jsonl": ("mismatch", 2, 0), "alone.jsonl": ("no_archive", 0, 0)}
    now = [json.loads(x) for x in (tmp_path / "good.jsonl").read_text().splitlines()]
    assert [r["original_metadata"]["codec"] for r in now] == ["pcm_s16le" if now[0]["original_metadata"]["codec"] == "pcm_s16le" else "pcm_s16", "kept"] and [r["audio_file"] for r in now] == ["a.wav", "b.wav"]
    assert all((tmp_path / f"{n}.jsonl").read_text() == before[n] for n in ("short", "names", "alone"))
    assert not list(tmp_path.glob("*.temp"))
    again = backfill.backfill(spark, [str(tmp_path / "good.jsonl")], str(tars)).first()
    assert (again.status, again.updated) == ("updated", 0)


def test_decode_to_files_skips_and_forces(spark, tmp_path):
    make_tar(tmp_path / "1.tar", [("a.wav", tone(3000)), ("x/a.wav", tone(2000)), ("b.wav", tone(1000)), ("bad.wav", b"junk")])
    results = audio.tokenize(spark, [str(tmp_path / "1.tar")], str(tmp_path / "out"))
    assert not list(tmp_path.glob("out.*"))  # nothing staged is left
    folder = str(tmp_path / "wavs")
    status = lambda **k: sorted((r.audio_file, r.status) for r in audio.decode_to_files(results, folder, **k).collect())
    first = [("a.wav", "ok"), ("b.wav", "ok"), ("bad.wav", "failed"), ("x/a.wav", "skipped")]
    assert status() == first
    assert len(read_wave((tmp_path / "wavs" / "a_reconstructed.wav").read_bytes(), trim=False)[0]) == 4 * 960
    assert status() == [(n, "failed" if n == "bad.wav" else "skipped") for n, _ in first] and status(force=True) == first
    assert sorted(os.listdir(folder)) == ["a_reconstructed.wav", "b_reconstructed.wav"]


def test_one_clip(spark, tmp_path):
    (tmp_path / "c.wav").write_bytes(tone(2000))
    (tmp_path / "bad.wav").write_bytes(b"junk")
    r = audio.tokenize_file(spark, str(tmp_path / "c.wav"), str(tmp_path / "c")).first()
    assert r.token_shape == [8, 3] and r.num_samples == 2000 and r.tar_file is None
    assert audio.tokenize_file(spark, str(tmp_path / "bad.wav"), str(tmp_path / "bad")).first().error
    assert audio.tokenize_file(spark, str(tmp_path / "bad.wav"), str(tmp_path / "c")).first().num_samples == 2000  # kept
    assert audio.tokenize_file(spark, str(tmp_path / "bad.wav"), str(tmp_path / "c"), force=True).first().error


def test_submission_loop(spark, tmp_path):
    m = spark.createDataFrame([(i, f"/t/{i:02d}.tar", f"{i:02d}") for i in range(10)], "pos long, tar_path string, tar_stem string")
    done, state, runs = [], str(tmp_path / "state"), []
    outputs = lambda: spark.createDataFrame([(s, "final", 1) for s in done], "stem string, kind string, size long")
    assert submission.read_state(spark, state).count() == 0
    plan = lambda **k: submission.step(m, outputs(), state, lambda p: runs.append(p) or done.extend(x[3:5] for x in p), most_jobs=2, per_task=2, **k)
    assert plan(dry_run=True) == [f"/t/0{i}.tar" for i in range(4)] and not runs and submission.read_state(spark, state).count() == 0
    assert submission.until_done(lambda: 10 - len(done), plan) == 3
    assert [len(r) for r in runs] == [4, 4, 2] and submission.read_state(spark, state).count() == 10
    with pytest.raises(TimeoutError):
        submission.until_done(lambda: 1, lambda: None, most=2)
    again, left = submission.repaired(m, submission.read_state(spark, state), outputs().where("stem <> '03'"))
    assert [r.tar_path for r in again.collect()] == ["/t/03.tar"] and left.count() == 9
    submission.write_state(left, state)
    assert submission.read_state(spark, state).count() == 9
    assert submission.skip_first(m, 4).agg({"pos": "min"}).first()[0] == 4 and submission.skip_first(m, 0).count() == 10
    with pytest.raises(ValueError):
        submission.skip_first(m, 10)


def test_small_parts(spark):
    c = ResidualCodec()
    assert measured_samples_per_token(c) == 960 and lifted(range(8)).shape == (8, 1)
    wide = write_wave(np.array([0.5, -0.25, 0.125]), 24_000)
    assert np.allclose(read_wave(wide)[0], [0.5, -0.25, 0.125], atol=1e-4)
    import wave

    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(3)
        w.setframerate(24_000)
        w.writeframes(b"".join(int(v * 2**23).to_bytes(3, "little", signed=True) for v in (0.5, -0.25, 0.125)))
    assert np.allclose(read_wave(buffer.getvalue())[0], [0.5, -0.25, 0.125])
    df = spark.createDataFrame([("/a/b.c/d.tar",), ("x",)], "p string")
    from pyspark.sql import functions as F

    p = F.col("p")
    got = [tuple(r) for r in df.select(text.suffix(p), text.parent(p), text.relative_to(p, "/a/"), text.derived(p, "wav"), text.fixed(F.lit(2.126), 2)).collect()]
    assert got == [(".tar", "/a/b.c", "b.c/d.tar", "d_reconstructed.wav", "2.13"), ("", "", "x", "x_reconstructed.wav", "2.13")]


def test_ranges_within_a_row_are_those_of_rows(spark):
    df = spark.range(0, 400).withColumnRenamed("id", "n")
    from pyspark.sql import functions as F

    one = df.select("n", F.inline(fragments.fragment_ranges(F.col("n"), 40, 7)))
    two = fragments.with_fragments(df, "n", 1, 40, 7).select("n", F.col("kept_begin").alias("begin"), F.col("kept_end").alias("end"))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    one = df.select("n", F.inline(fragments.block_ranges(F.col("n"), 30, 12, 6)))
    two = fragments.with_blocks(df, "n", 30, 12, 6).select("n", "emit_begin", "emit_end")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
