import io
import json
import os
import random
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from spoolwright import tables
from spoolwright.codec import Adapter, ResidualCodec, encode_piecewise, walk_fragments, write_wave
from spoolwright.functions import signal, text
from spoolwright.functions.jsontext import ascii_json
from spoolwright.operators import offsets, progress
from spoolwright.plans import audio, placement, submission
from spoolwright.sources import lines, tar_ranges


def tone(n):
    return write_wave(0.5 * np.sin(np.arange(1, n + 1) / 20), 24_000)


def make_tar(path, members):
    with tarfile.open(path, "w") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def test_ascii_json_is_that_of_python(spark):
    g = random.Random(1)
    planes = [chr(c) for p in range(17) for c in (p << 16 | 0x41, p << 16 | 0xFF0F, p << 16 | 0x1F3) if not 0xD800 <= c < 0xE000]
    cases = ["", "plain", 'q"b\\s/', "\\u00e9 \\\\u00E9 \\", "\x00\x01\x08\x09\x0a\x0b\x0c\x0d\x1b\x1f\x7f\x80\x9f", "é€😀 ﻿", "".join(planes)] + ["".join(g.choice(planes + list('a"\\\n\x1e\x7fu')) for _ in range(60)) for _ in range(40)]
    df = spark.createDataFrame([(i, t, {"k": t}) for i, t in enumerate(cases)], "i int, t string, m map<string,string>")
    j = F.to_json(F.struct("t", "m"))
    got = {r[0]: r[1] for r in df.select("i", ascii_json(j)).collect()}
    assert got == {i: json.dumps({"t": t, "m": {"k": t}}, separators=(",", ":")) for i, t in enumerate(cases)}
    assert spark.range(1).select(ascii_json(F.lit(None).cast("string"))).first()[0] is None


def loop(codec, x, most, overlap):
    """Fragments one by one, as a plain encoder takes them."""
    p, at, end, out = codec.samples_per_token, 0, -1, []
    while end < len(x):
        begin = max(at - overlap * p, 0)
        end = begin + most * p
        t = codec.encode(x[begin:end])
        if at > 0:
            t = t[:, overlap:]
        if end < len(x):
            t = t[:, : t.shape[1] - overlap]
        at += t.shape[1] * p
        out.append(t)
    return np.concatenate(out, 1)


@pytest.mark.parametrize("rule", [lambda n: n // 3, lambda n: -(-n // 3), lambda n: max(0, n // 3 - 1), lambda n: n // 3 + (n % 7 == 0)])
def test_fragments_follow_the_tokens_that_a_codec_gives(rule):
    g = np.random.default_rng(3)

    def encode(x):
        t = np.zeros((8, rule(len(x))), np.int32)
        t[:] = np.arange(t.shape[1]) + int(1000 * x[:1].sum())
        return t

    codec = Adapter(encode, lambda t: np.zeros(3 * t.shape[1]), 24_000, regular=False)
    assert codec.samples_per_token == 3
    for n in (0, 1, 40, 44, 45, 46, 200, 333):
        x = g.normal(size=n)
        whole = encode_piecewise(codec, x, 15, 2)
        assert whole.shape == loop(codec, x, 15, 2).shape and (whole == loop(codec, x, 15, 2)).all()
        steps = list(walk_fragments(codec, x, 15, 2))
        for k in range(1, len(steps)):  # taken up from any place
            rest = list(walk_fragments(codec, x, 15, 2, place=steps[k - 1][1]))
            assert (np.concatenate([t for t, _ in steps[:k]] + [t for t, _ in rest], 1) == whole).all()
    with pytest.raises(ValueError):
        encode_piecewise(Adapter(lambda x: np.zeros((8, 1), int), lambda t: np.zeros(3), 1, regular=False), np.zeros(500), 15, 2)


def test_profiles_stand_in_the_plan(spark):
    assert placement.accelerated(spark) is None
    profile = placement.accelerated(spark, 0.5, cores=4, memory="2g", force=True)
    assert profile.taskResources["gpu"].amount == 0.5 and profile.executorResources["cores"].amount == 4
    df = spark.range(3).mapInArrow(lambda it: it, "id long", profile=profile)
    plan = df._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan and spark.range(3).mapInArrow(lambda it: it, "id long", profile=placement.accelerated(spark)).count() == 3
    assert df._jdf.queryExecution().analyzed().toJSON().count("profile") >= 1
    made = []
    codec = placement.on_device("c", lambda d: made.append(d) or ResidualCodec())
    assert codec() is codec() and made == ["cpu"] and placement.device() == "cpu"


def test_table_functions_in_sql(spark, tmp_path):
    tables.register(spark)
    make_tar(tmp_path / "a.tar", [("a.wav", tone(1000)), ("n.txt", b"x"), ("b.wav", tone(2000)), ("bad.wav", b"junk")])
    make_tar(tmp_path / "b.tar", [("c.wav", tone(3000))])
    (tmp_path / "f.txt").write_bytes("é\r\n\n two\rthree".encode())
    paths = [str(tmp_path / n) for n in ("a.tar", "b.tar")]
    spark.createDataFrame([(p,) for p in paths] + [(None,)], "path string").createOrReplaceTempView("archives")
    got = spark.sql("SELECT path, m.* FROM archives, LATERAL tar_members(path, '.wav') AS m ORDER BY path, member_index").collect()
    wanted = tar_ranges.split_members(spark, paths, [".wav"]).orderBy("tar_path", "member_index").collect()
    assert [(r.path, r.member_index, r.audio_file, r.offset, r.size) for r in got] == [(r.tar_path, r.member_index, r.audio_file, r.offset, r.size) for r in wanted]
    got = spark.sql(f"SELECT * FROM file_lines('{tmp_path}/f.txt') ORDER BY 1").collect()
    assert [tuple(r) for r in got] == [tuple(r)[1:] for r in lines.index_lines(spark, [f"{tmp_path}/f.txt"]).orderBy("line_number").collect()]
    tar_ranges.split_members(spark, paths, [".wav"]).drop("content").createOrReplaceTempView("members")
    rows = spark.sql("SELECT * FROM tokenized(TABLE(members))").collect()
    assert {(os.path.basename(r.tar_file), r.audio_file, r.token_shape and r.token_shape[1], r.error is None) for r in rows} == {("a.tar", "a.wav", 2, True), ("a.tar", "b.wav", 3, True), ("a.tar", "bad.wav", None, False), ("b.tar", "c.wav", 4, True)}
    for bad in ("SELECT * FROM fragments(9, 1, 4, 2)", "SELECT * FROM tokenized(TABLE(archives))", "SELECT * FROM tar_members(1)"):
        with pytest.raises(Exception):  # noqa: B017
            spark.sql(bad).collect()


def test_neighbours_share_reads(spark, tmp_path):
    assert lines.merged([(50, 60), (0, 10), (10, 20), (200, 210)], 30, 1000) == [(0, 60, [1, 2, 0]), (200, 210, [3])]
    assert lines.merged([(0, 10), (10, 20), (20, 30)], 0, 20) == [(0, 20, [0, 1]), (20, 30, [2])]
    paths = []
    for n in range(3):
        (tmp_path / f"{n}.txt").write_text("".join(f"line {i} of {n}\n" for i in range(2000)))
        paths.append(str(tmp_path / f"{n}.txt"))
    lines.write_lookup_index(lines.index_lines(spark, paths, range_bytes=5000), str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    asked = index.where((F.col("path") == paths[1]) & F.col("start_offset").between(4000, 9000))
    plan = asked._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "GreaterThanOrEqual(start_offset,4000)" in plan and f"EqualTo(path,{paths[1]})" in plan
    got = lines.read_at(asked).collect()
    assert len(got) > 200 and all(r.found == f"line {r.line_number - 1} of 1" for r in got)
    assert sum(len({x.read_no for x in got if x.path == p}) for p in paths) <= 8 * spark.sparkContext.defaultParallelism // 4  # of hundreds of rows
    far = lines.read_at(index.where("line_number % 500 = 1").coalesce(1), gap=10).collect()
    assert {(r.path, r.read_no) for r in far} == {(p, k) for p in paths for k in range(4)}


def test_lines_are_not_exchanged(spark, tmp_path):
    (tmp_path / "f").write_text("a\nb\n")
    plan = lines.index_lines(spark, [str(tmp_path / "f")])._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert "Exchange" not in above and "Join" not in plan


def test_look_ups_across_blocks(spark):
    files = spark.createDataFrame([("f", "é" * 50 + "\n" + "b" * 7 + "\n\nlast"), ("g", ""), ("h", "x\n" * 40)], "f string, t string")
    index = offsets.line_offsets(files, "f", "t")
    for block in (1, 3, 16, 1 << 14):
        got = offsets.lookup(index, files, "f", "t", block).collect()
        assert len(got) == index.count() and all(r.found.rstrip("\n") == r.line for r in got)


def test_gates_lists_and_totals(spark, tmp_path):
    m = spark.createDataFrame([(i, f"/t/{i}.tar", str(i)) for i in range(6)], "pos long, tar_path string, tar_stem string")
    out = spark.createDataFrame([("1", "final", 0), ("2", "partial", 9), ("3", "final", 9)], "stem string, kind string, size long")
    assert sorted(r.pos for r in progress.gate(m, out, "skip").collect()) == [0, 2, 4, 5] and progress.gate(m, out, "force").count() == 6
    with pytest.raises(FileExistsError):
        progress.gate(m, out)
    with pytest.raises(ValueError):
        progress.gate(m, out, "maybe")
    first = spark.createDataFrame([("1", True), ("3", True), ("2", False)], "stem string, valid boolean")
    status = progress.tar_status(m, progress.output_validity(out, first))
    assert {r.tar_stem: r.status for r in status.collect()} == {"0": "not_started", "1": "invalid", "2": "partial", "3": "complete", "4": "not_started", "5": "not_started"}
    folder = str(tmp_path / "lists")
    assert progress.write_progress(status, folder, completed=True) == {"remaining": 5, "completed": 1, "invalid": 1}
    assert (tmp_path / "lists" / "remaining.txt").read_text() == "".join(f"/t/{i}.tar\n" for i in (0, 1, 2, 4, 5)) and (tmp_path / "lists" / "completed.txt").read_text() == "/t/3.tar\n"
    assert progress.write_progress(status.where("status = 'complete'"), folder, invalid=False) == {"remaining": 0}


def test_archives_are_marked_complete(spark, tmp_path):
    make_tar(tmp_path / "1.tar", [("a.wav", tone(500))])
    make_tar(tmp_path / "none.tar", [("a.txt", b"x")])
    paths, out = [str(tmp_path / "1.tar"), str(tmp_path / "none.tar")], str(tmp_path / "out")
    assert audio.tokenize(spark, paths, out).count() == 1
    assert {(os.path.basename(r.tar_file), r.members) for r in audio.completed(spark, out).collect()} == {("1.tar", 1), ("none.tar", 0)}
    os.remove(tmp_path / "none.tar")
    assert audio.tokenize(spark, paths, out, skip_existing=True).count() == 1  # what is marked is not opened
    make_tar(tmp_path / "1.tar", [("a.wav", tone(500)), ("b.wav", tone(700))])
    assert audio.tokenize(spark, paths[:1], out, skip_existing=True).count() == 1 and audio.tokenize(spark, paths[:1], out).count() == 2
    assert {(os.path.basename(r.tar_file), r.members) for r in audio.completed(spark, out).collect()} == {("1.tar", 2), ("none.tar", 0)}


def test_repairs_need_a_word(spark, tmp_path):
    m = spark.createDataFrame([(i, f"/t/{i}.tar", str(i)) for i in range(3)], "pos long, tar_path string, tar_stem string")
    state, out = str(tmp_path / "s"), spark.createDataFrame([("0", "final", 5), ("1", "final", 0)], "stem string, kind string, size long")
    submission.add_to_state(m.where("pos < 2").select("tar_path"), state)
    submission.add_to_state(m.where("pos > 1").select("tar_path"), state)
    assert submission.repair(m, out, state) == ["/t/1.tar", "/t/2.tar"] and submission.read_state(spark, state).count() == 3
    with pytest.raises(ValueError):
        submission.repair(m, out, state, confirm=True, dry_run=True)
    submission.repair(m, out, state, confirm=True)
    assert [r.tar_path for r in submission.read_state(spark, state).collect()] == ["/t/0.tar"]


def test_small_functions(spark):
    p = F.col("p")
    df = spark.createDataFrame([("a/b.tar",), ("/x/../y/./z",), ("../../q",), ("s3://h/a/../k",), ("",)], "p string")
    assert [r[0] for r in df.select(text.absolute(p, "/w/d/")).collect()] == ["/w/d/a/b.tar", "/y/z", "/q", "s3://h/k", "/w/d/"]
    order = [r.p for r in spark.createDataFrame([("a-b/x",), ("a/z",), ("a",), ("a/b/c",)], "p string").orderBy(text.path_order(p)).collect()]
    assert order == ["a", "a/b/c", "a/z", "a-b/x"]
    n = [0, 1, 4, 5, (1 << 53) + 1, (1 << 62) + 3]
    assert [r[0] for r in spark.createDataFrame([(x,) for x in n], "n long").select(text.ceil_div(F.col("n"), 4)).collect()] == [-(-x // 4) for x in n]
    w = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0], [5.0, 9.0]],), ([[1.0]],), ([],), (None,)], "c array<array<double>>")
    assert [r[0] for r in w.select(signal.mixed(F.col("c"))).collect()] == [[3.0, 5.0], [1.0], None, None]
    t = spark.createDataFrame([([[1, 2], [3, 4]],), (None,)], "t array<array<int>>")
    assert t.select(signal.checked_tokens(F.col("t"), 2)).count() == 2
    for bad in ([[1, 2]], [[1], [2, 3]]):
        with pytest.raises(Exception, match="codebooks"):
            spark.createDataFrame([(bad,)], "t array<array<int>>").select(signal.checked_tokens(F.col("t"), 2)).collect()


def test_decimals_are_those_of_python(spark):
    g = random.Random(2)
    xs = [0.25, 0.15, 2.5, 0.125, 1e-9, -0.04, 1234567.85, 99.95, 0.05, 1 / 3] + [g.randint(-(10**6), 10**6) / 2 ** g.randint(0, 8) for _ in range(300)] + [g.uniform(-100, 100) for _ in range(200)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    for d in (0, 1, 2, 3):
        assert {r[0]: r[1] for r in df.select("i", text.fixed(F.col("x"), d)).collect()} == {i: f"{x:.{d}f}" for i, x in enumerate(xs)}


def test_names_with_times(spark):
    at = F.to_timestamp(F.lit("2024-02-03 04:05:06.000789"))
    assert spark.range(1).select(text.stamped("list", ".txt", at)).first()[0] == ".list_20240203_040506_000789.txt"
    assert spark.range(1).select(text.age_hours(at, F.to_timestamp(F.lit("2024-02-03 06:35:06.000789")))).first()[0] == 2.5


def test_watching_a_queue(spark, tmp_path):
    m = spark.createDataFrame([(i, f"/t/{i}.tar", str(i)) for i in range(10)], "pos long, tar_path string, tar_stem string")
    done, waits, queue, state = [], [], iter([1, OSError("down"), -1, 0, 2, 0, 0]), str(tmp_path / "s")
    outputs = lambda: spark.createDataFrame([(s, "final", 1) for s in done], "stem string, kind string, size long")

    def queued():
        n = next(queue)
        if isinstance(n, OSError):
            raise n
        return n

    told = submission.watch(m, outputs, queued, state, lambda p: done.extend(x[3:-4] for x in p), most_jobs=2, per_task=3, sleep=waits.append)
    assert [len(t) for t in told] == [3, 0, 0, 6, 0, 1, 0] and waits == [60.0] * 6 and sorted(done, key=int) == [str(i) for i in range(10)]
    fresh = str(tmp_path / "t")
    assert [len(t) for t in submission.watch(m, lambda: outputs().limit(0), lambda: 0, fresh, done.append, most_jobs=1, dry_run=True)] == [4] and submission.read_state(spark, fresh).count() == 0
    assert len(submission.watch(m, lambda: outputs().limit(0), lambda: 0, fresh, lambda p: None, most_jobs=1, once=True)) == 1


def test_codecs_from_files(spark, tmp_path):
    from spoolwright.codec import codec_at, save_codec

    path = str(tmp_path / "codec.json")
    save_codec(ResidualCodec(24_000, 480), path)
    make_tar(tmp_path / "1.tar", [("a.wav", tone(960))])
    assert audio.tokenize(spark, [str(tmp_path / "1.tar")], str(tmp_path / "out"), codec=codec_at(path)).first().token_shape == [8, 2]
    (tmp_path / "bad.json").write_text('{"kind": "Other"}')
    with pytest.raises(ValueError):
        codec_at(str(tmp_path / "bad.json"))()


def test_other_formats_by_decoders(spark, tmp_path):
    from test_signal import mp3

    body = mp3(40, [128])
    make_tar(tmp_path / "1.tar", [("a.MP3", body), ("b.wav", tone(960)), ("c.mp3", b"junk")])

    def decode(data):
        n = len(data) * 8 * 441 // 1280
        return np.stack([np.ones(n), np.full(n, 5.0)]), 44_100

    rows = {r.audio_file: r for r in audio.tokenize(spark, [str(tmp_path / "1.tar")], str(tmp_path / "out"), [".mp3", ".wav"], decoders={".mp3": decode}).collect()}
    assert rows["a.MP3"].original_metadata.codec == "mp3" and rows["a.MP3"].original_metadata.num_channels == 2 and rows["a.MP3"].error is None
    assert abs(rows["a.MP3"].num_samples / 24_000 - rows["a.MP3"].original_metadata.duration_seconds_from_header) < 0.01
    assert rows["b.wav"].num_samples == 960 and rows["c.mp3"].error == "no MPEG audio frame"
    from spoolwright.codec import cleaned

    with pytest.raises(ValueError):
        cleaned(np.zeros((2, 2, 2)), 1)


def test_selected_numbers_are_sorted_and_in_range():
    assert text.selected_numbers("7:9,1,3-5,4", 9) == [1, 3, 4, 5, 7, 8] and text.selected_numbers("5-3", 9) == []


def test_tokens_stay_in_their_rows_when_few_names_are_written(spark, tmp_path):
    make_tar(tmp_path / "1.tar", [("a.wav", tone(960)), ("x/a.wav", tone(500)), ("b.wav", tone(960))])
    results = audio.tokenize(spark, [str(tmp_path / "1.tar")], str(tmp_path / "out"))
    made = audio.decode_to_files(results, str(tmp_path / "wavs"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert sorted((r.audio_file, r.status) for r in made.collect()) == [("a.wav", "ok"), ("b.wav", "ok"), ("x/a.wav", "skipped")]


def test_tables_between_steps_go_with_the_driver(spark):
    from spoolwright.sources.scratch import stored

    (path,) = {f.rpartition("/")[0] for f in stored(spark.range(3).coalesce(1), "x").inputFiles()}
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert folder.getFileSystem(spark._jsc.hadoopConfiguration()).cancelDeleteOnExit(folder)
