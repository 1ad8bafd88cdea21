import io
import json
import os
import tarfile

import numpy as np
import pytest

from spoolwright.codec import write_wave
from spoolwright.plans import backfill
from spoolwright.sources import files, ordered


def tone(n):
    return write_wave(0.5 * np.sin(np.arange(1, n + 1) / 20), 24_000)


def make_tar(path, members):
    with tarfile.open(path, "w") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def old(name, **more):
    return json.dumps({"tar_file": "t", "audio_file": name, "num_samples": 5, "sample_rate": 24000, "tokens": [[1, 2]], "token_shape": [8, 2], **more})


def world(folder):
    """Record files and archives of every rule."""
    tars = folder / "tars"
    tars.mkdir()
    two = [("d/a.wav", tone(900)), ("notes.txt", b"-"), ("b.wav", tone(400))]
    for n in ("good", "bad", "errors", "junk", "short", "long", "names", "nameless", "blank", "kept"):
        make_tar(tars / f"{n}.tar", [("a.wav", tone(900)), ("b.wav", b"junk")] if n == "junk" else two)
    (tars / "more").mkdir()
    make_tar(tars / "ambiguous.tar", two)
    odd = '{"audio_file":"b.wav",  "extra": 1, "original_metadata": {"codec": "kept"}, "text": "é"}'
    lines = {
        "good": [old("a.wav"), odd], "bad": [old("a.wav"), old("b.wav")[:30]], "errors": [old("zzz", error="x"), old("b.wav")], "junk": [old("a.wav"), old("b.wav")],
        "short": [old("a.wav")], "long": [old("a.wav"), old("b.wav"), old("c.wav")], "names": [old("b.wav"), old("a.wav")], "nameless": [old("a.wav"), '{"tokens": [[1]]}'],
        "blank": ["", old("a.wav"), "  ", old("b.wav"), ""], "kept": [old("a.wav", original_metadata={"codec": "k"}), odd], "alone": [old("a.wav")],
    }
    for n, of in lines.items():
        (folder / f"{n}.jsonl").write_text("\n".join(of) + "\n")
    return {n: "\n".join(of) + "\n" for n, of in lines.items()}, str(tars)


def test_every_rule_of_a_line(spark, tmp_path):
    before, tars = world(tmp_path)
    report = backfill.backfill(spark, [str(tmp_path / f"{n}.jsonl") for n in before], tars, range_bytes=1000)
    got = {os.path.basename(r.path)[:-6]: (r.status, r["rows"], r.updated, r.reason) for r in report.collect()}
    assert got == {
        "good": ("updated", 2, 1, None), "bad": ("updated", 2, 2, None), "errors": ("updated", 2, 1, None), "junk": ("updated", 2, 2, None), "short": ("mismatch", 1, 0, "missing_line"), "long": ("mismatch", 3, 0, "extra_line"),
        "names": ("mismatch", 2, 0, "name"), "nameless": ("mismatch", 2, 0, "name"), "blank": ("updated", 2, 2, None), "kept": ("updated", 2, 0, None), "alone": ("no_archive", 0, 0, None),
    }
    now = {n: (tmp_path / f"{n}.jsonl").read_text() for n in before}
    assert all(now[n] == before[n] for n in ("short", "long", "names", "nameless", "kept", "alone"))
    rows = {n: [json.loads(x) for x in t.splitlines() if x.strip()] for n, t in now.items() if n != "nameless"}
    meta = rows["good"][0].pop("original_metadata")
    assert rows["good"][0] == json.loads(old("a.wav")) and meta["codec"] == "pcm_s16le" and meta["duration_seconds_from_header"] == 900 / 24000
    assert now["good"].splitlines()[1] == before["good"].splitlines()[1]  # byte for byte
    assert rows["bad"][0]["tokens"] == [[1, 2]] and rows["bad"][1] == {"tar_file": f"{tars}/bad.tar", "audio_file": "b.wav", "error": "the line could not be read as JSON"}
    assert rows["errors"][0]["error"] == "x" and rows["errors"][1]["original_metadata"]["sample_rate"] == 24000
    assert rows["junk"][0]["original_metadata"] and set(rows["junk"][1]) == {"tar_file", "audio_file", "error"}
    assert [r["audio_file"] for r in rows["blank"]] == ["a.wav", "b.wav"]
    assert not [f for f in os.listdir(tmp_path) if "staged" in f]
    again = backfill.backfill(spark, [str(tmp_path / "good.jsonl")], tars).first()
    assert (again.status, again.updated) == ("updated", 0)


def test_archives_of_one_stem_are_told_and_left(spark):
    df = lambda *p: spark.createDataFrame([(x,) for x in p], "path string")
    got = {r.path: (r.tar_path, r.ambiguous) for r in backfill.paired(df("/r/a.jsonl", "/r/b.jsonl", "/r/c.jsonl"), df("/t/a.tar", "/u/a.tar", "/t/b.tar")).collect()}
    assert got == {"/r/a.jsonl": (None, True), "/r/b.jsonl": ("/t/b.tar", False), "/r/c.jsonl": (None, False)}


def test_a_crash_between_renames_leaves_old_or_new_files(spark, tmp_path, monkeypatch):
    before, tars = world(tmp_path)
    paths = [str(tmp_path / f"{n}.jsonl") for n in before]
    manifest, _ = backfill.staged(spark, paths, tars)
    assert all((tmp_path / f"{n}.jsonl").read_text() == t for n, t in before.items())
    done, real = [], files.replace

    def breaks(spark, new, target):
        if len(done) == 2:
            raise RuntimeError("killed")
        real(spark, new, target)
        done.append(target)

    monkeypatch.setattr(ordered, "replace", breaks)
    with pytest.raises(RuntimeError):
        ordered.put_in_place(manifest)
    state = {n: (tmp_path / f"{n}.jsonl").read_text() for n in before}
    assert len(done) == 2 and all((state[n] != t) == (str(tmp_path / f"{n}.jsonl") in done) for n, t in before.items())
    monkeypatch.setattr(ordered, "replace", real)
    assert ordered.put_in_place(manifest) == manifest.count() - 2 and ordered.put_in_place(manifest) == 0
    assert sum((tmp_path / f"{n}.jsonl").read_text() != t for n, t in before.items()) == manifest.count() == 5


def jobs_of(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    counts = []
    for n in (2, 60):
        folder = tmp_path / str(n)
        (folder / "tars").mkdir(parents=True)
        for i in range(n):
            make_tar(folder / "tars" / f"{i}.tar", [("a.wav", tone(50))])
            (folder / f"{i}.jsonl").write_text(old("a.wav") + "\n")
        paths = [str(folder / f"{i}.jsonl") for i in range(n)]
        counts.append(jobs_of(spark, f"backfill{n}", lambda: backfill.backfill(spark, paths, str(folder / "tars"))))  # noqa: B023
        assert all("original_metadata" in json.loads((folder / f"{i}.jsonl").read_text()) for i in range(n))
    assert counts[1] <= counts[0] + 3


def test_ordered_files_are_whole_and_sorted(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = spark.range(0, 500, numPartitions=7).select(F.concat(F.lit(f"{tmp_path}/f"), (F.col("id") % 5).cast("string")).alias("path"), F.concat(F.lit("é"), "id").alias("line"), "id")
    (tmp_path / "f0").write_text("old")
    made = ordered.stage_files(rows, "id")
    assert (tmp_path / "f0").read_text() == "old" and made.agg({"n": "sum"}).first()[0] == 500
    assert ordered.put_in_place(made) == 5
    for i in range(5):
        assert (tmp_path / f"f{i}").read_text().splitlines() == [f"é{j}" for j in range(i, 500, 5)]
    assert spark.read.text(str(tmp_path / "f0")).count() == 100


def test_bytes_that_could_begin_a_character(spark):
    from pyspark.sql import functions as F

    from spoolwright.functions import text

    n = [0, 0x7F, 0x80, 0x1FC2, 0xE0F0C2, 0xF4, 0xC2000000, 0xFFFFFFFF, 0x1_0000_00C3, -2]
    got = spark.createDataFrame([(x,) for x in n], "n long").select("n", text.little_endian(F.col("n"))).collect()
    assert {r[0]: bytes(r[1]) for r in got} == {x: (x % 2**32).to_bytes(4, "little") for x in n}


def test_headers_of_any_rate_are_read(spark, tmp_path):
    """Rates whose lowest bytes could begin characters in UTF-8, in an archive that is read (kind 0)."""
    import oracle
    import pyarrow as pa
    from pyarrow import parquet

    from spoolwright import catalogue

    ids = list(range(100, 400))
    parquet.write_table(pa.table({"doc_id": ids, "source": ["src0"] * len(ids), "n_chars": [5 + i for i in ids]}), tmp_path / "documents.parquet")
    parquet.write_table(pa.table({"doc_id": [101, 103], "quality": pa.array([1, 0], pa.int32()), "toxic": pa.array([0, 1], pa.int32())}), tmp_path / "labels.parquet")
    assert oracle.same(spark, catalogue.backfill_rules, catalogue.ORACLE_SQL["backfill_rules"], str(tmp_path)) == 300
