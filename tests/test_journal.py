import io
import json
import os
import tarfile

import numpy as np
import pytest

from spoolwright.codec import ResidualCodec, write_wave
from spoolwright.plans import audio
from spoolwright.sources import journal


def tone(n):
    return write_wave(0.5 * np.sin(np.arange(1, n + 1) / 20), 24_000)


def make_tar(path, members):
    with tarfile.open(path, "w") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def counting(folder, dies_after=None):
    """A codec that notes every encode in a file of its own, and takes its worker down with it after so many in all."""

    class Counting(ResidualCodec):
        def encode(self, samples):
            if dies_after is not None and len(os.listdir(folder)) >= dies_after:
                os._exit(9)
            with open(f"{folder}/{os.getpid()}-{os.urandom(6).hex()}", "w") as f:
                f.write(str(len(samples)))
            return super().encode(samples)

    return Counting


def test_a_killed_run_is_carried_on_by_member(spark, tmp_path):
    make_tar(tmp_path / "1.tar", [(f"{i}.wav", tone(1000 + i)) for i in range(12)] + [("bad.wav", b"junk"), ("3.wav", tone(77))])
    out, seen = str(tmp_path / "out"), tmp_path / "seen"
    seen.mkdir()
    with pytest.raises(Exception):  # noqa: B017
        audio.tokenize(spark, [str(tmp_path / "1.tar")], out, codec=counting(str(seen), dies_after=5))
    before = len(os.listdir(seen))
    logged = journal.read_journal(spark, f"{out}/_journal")
    kept = logged.count()
    assert 1 <= kept and before >= 5
    rows = audio.tokenize(spark, [str(tmp_path / "1.tar")], out, codec=counting(str(seen)))
    assert rows.count() == 14 and rows.where("error IS NULL").count() == 13
    assert sorted(r.num_samples for r in rows.where("audio_file = '3.wav'").collect()) == [77, 1003]
    good = kept - logged.where("error IS NOT NULL").count() if os.path.exists(f"{out}/_journal") else kept
    assert len(os.listdir(seen)) - before <= 13 - (good - 1)  # what was logged is not encoded again
    assert not os.path.exists(f"{out}/_journal")
    again = len(os.listdir(seen))
    assert audio.tokenize(spark, [str(tmp_path / "1.tar")], out, codec=counting(str(seen))).count() == 14 and len(os.listdir(seen)) == again


def test_an_attempt_takes_over_what_the_one_before_it_finished(spark, tmp_path):
    folder, run = str(tmp_path / "j"), "r1"
    os.makedirs(f"{folder}/{run}/000000")
    with open(f"{folder}/{run}/000000/0000000001-000000.jsonl", "w") as f:
        f.write(json.dumps({"member_index": 0, "tar_file": "t", "audio_file": "a"}) + "\n" + '{"member_index": 1, "tar_f')
    members = spark.createDataFrame([("t", i, "a", 0, 1) for i in range(4)], "tar_path string, member_index int, audio_file string, offset long, size long").coalesce(1)
    noted = tmp_path / "noted"
    noted.mkdir()

    def work():
        def one(row):
            (noted / str(row["member_index"])).touch()
            return {"tar_file": row["tar_path"], "audio_file": row["audio_file"]}

        return one

    journal.append(members, folder, run, work, segment_rows=2)
    assert sorted(os.listdir(noted)) == ["1", "2", "3"]
    assert sorted(r.member_index for r in journal.read_journal(spark, folder).collect()) == [0, 1, 2, 3]
    told = json.loads((tmp_path / "j" / run / "manifest.json").read_text())
    assert told["rows"] == 4 and len(told["files"]) == 3


def test_errors_are_tried_again_on_demand(spark, tmp_path):
    make_tar(tmp_path / "1.tar", [("a.wav", b"junk"), ("b.wav", tone(500))])
    out = str(tmp_path / "out")
    assert audio.tokenize(spark, [str(tmp_path / "1.tar")], out).where("error IS NOT NULL").count() == 1
    make_tar(tmp_path / "1.tar", [("a.wav", tone(300)), ("b.wav", tone(500))])
    assert audio.tokenize(spark, [str(tmp_path / "1.tar")], out).where("error IS NOT NULL").count() == 1
    assert sorted(r.num_samples for r in audio.tokenize(spark, [str(tmp_path / "1.tar")], out, retry_errors=True).collect()) == [300, 500]


@pytest.mark.parametrize("range_bytes", [7, 64, 1 << 20])
def test_longest_valid_prefix(spark, tmp_path, range_bytes):
    ok = lambda i: json.dumps({"member_index": i, "tar_file": "t", "audio_file": f"é{i}"}, ensure_ascii=False)
    logs = {
        "whole": f"{ok(1)}\n\n{ok(2)}\n", "no_break": f"{ok(1)}\n{ok(2)}", "torn": f"{ok(1)}\n{ok(2)}\n{ok(3)[:20]}", "middle": f"{ok(1)}\nnot json\n{ok(3)}\n{ok(4)}\n",
        "first": f"[1]\n{ok(1)}\n", "empty": "", "blank": "\n \n", "number": f"{ok(1)}\n12",
    }
    for n, text in logs.items():
        (tmp_path / n).write_text(text)
    records, report = journal.log_prefix(spark, [str(tmp_path / n) for n in logs], range_bytes=range_bytes)
    got = {os.path.basename(r.path): (r["rows"], r.bad_line, r.lost_lines, r.state) for r in report.collect()}
    assert got == {"whole": (2, None, 0, "whole"), "no_break": (2, None, 0, "whole"), "torn": (2, 3, 1, "torn"), "middle": (1, 2, 3, "damaged"), "first": (0, 1, 2, "damaged"), "number": (1, 2, 1, "torn")}
    kept = sorted((os.path.basename(r.path), r.member_index) for r in records.collect())
    assert kept == sorted([("whole", 1), ("whole", 2), ("no_break", 1), ("no_break", 2), ("torn", 1), ("torn", 2), ("middle", 1), ("number", 1)])
    assert journal.log_prefix(spark, [str(tmp_path / n) for n in logs], broadcast_rows=0)[0].count() == len(kept)
    assert journal.truncate(report).count() == 4
    assert (tmp_path / "torn").read_text() == f"{ok(1)}\n{ok(2)}\n" and (tmp_path / "first").read_text() == "" and (tmp_path / "middle").read_text() == f"{ok(1)}\n" and (tmp_path / "whole").read_text() == logs["whole"]
    assert {r.state for r in journal.log_prefix(spark, [str(tmp_path / n) for n in logs])[1].collect()} == {"whole"}
