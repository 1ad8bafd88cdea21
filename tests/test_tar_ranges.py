import io
import tarfile

import numpy as np
import pandas as pd
import pytest

from spoolwright.sources import tar_ranges
from spoolwright.sources.tar import fetch


def archive(members, kind=tarfile.PAX_FORMAT):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w", format=kind) as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            if data is None:
                info.type = tarfile.DIRTYPE
                t.addfile(info)
            else:
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def sequential(data):
    """Members as a sequential reader tells them, until it meets the end of what breaks off."""
    out = []
    with tarfile.open(fileobj=io.BytesIO(data), mode="r") as t:
        try:
            for i, m in enumerate(t):
                out.append((i, m.name, m.offset_data, m.size, m.isfile()))
        except tarfile.ReadError:
            assert out[-1][2] + out[-1][3] > len(data) - 512
    return out


g = np.random.default_rng(1)
inner = archive([(f"in/{i}.wav", g.bytes(700)) for i in range(9)])
CASES = {
    "plain": archive([(f"{i:03d}.wav", g.bytes(int(n))) for i, n in enumerate(g.integers(0, 3000, 60))]),
    "nested": archive([("a.wav", g.bytes(900)), ("inner.tar", inner), ("dir", None), ("b.wav", b""), ("deep.tar", archive([("x.tar", inner), ("y.wav", g.bytes(10))])), ("c.wav", g.bytes(5000)), ("a.wav", b"again")]),
    "long_names": archive([("d/" * 90 + f"{'é' * 30}{i}.wav", g.bytes(600 * i)) for i in range(12)]),
    "gnu_names": archive([("d/" * 90 + f"{i}.wav", g.bytes(300 * i)) for i in range(12)], tarfile.GNU_FORMAT),
    "headers_only": archive([(f"{i}.wav", b"") for i in range(40)]),
    "big_members": archive([("a.wav", g.bytes(40_000)), ("b.wav", g.bytes(70_000)), ("c.wav", g.bytes(3))]),
    "nothing": archive([]),
}
CASES["cut_in_payload"] = CASES["plain"][:30_000]
CASES["no_end"] = CASES["headers_only"][: 40 * 512]
CASES["payload_end"] = CASES["plain"].rstrip(b"\0")
damaged = bytearray(CASES["headers_only"])
damaged[20 * 512 + 3] ^= 1
CASES["damaged"] = bytes(damaged)


@pytest.mark.parametrize(("range_bytes", "probe"), [(512, 512), (1500, 512), (4096, 1024), (10_000, 10_000), (1 << 20, 1 << 20)])
def test_ranges_list_what_a_sequential_reader_lists(spark, tmp_path, range_bytes, probe):
    for name, data in CASES.items():
        (tmp_path / f"{name}.tar").write_bytes(data)
    paths = [str(tmp_path / f"{n}.tar") for n in CASES]
    got = tar_ranges.split_members(spark, paths, range_bytes=range_bytes, probe_bytes=probe).collect()
    for name, data in CASES.items():
        mine = sorted((r.member_index, r.audio_file, r.offset, r.size, r.is_file) for r in got if r.tar_path.endswith(f"/{name}.tar"))
        assert mine == sequential(data), name
    with pytest.raises(Exception, match="breaks off"):
        fetch(tar_ranges.split_members(spark, [str(tmp_path / "cut_in_payload.tar")], range_bytes=range_bytes)).collect()


def test_compressed_and_filtered_archives(spark, tmp_path):
    import gzip

    data = archive([("a.WAV", b"abc"), ("b.txt", b"no"), ("c.wav", b"defg")])
    (tmp_path / "x.tar").write_bytes(data)
    (tmp_path / "y.tar.gz").write_bytes(gzip.compress(data))
    m = tar_ranges.split_members(spark, spark.createDataFrame([(str(tmp_path / n),) for n in ("x.tar", "y.tar.gz")], "path string"), [".wav"], range_bytes=512)
    rows = fetch(m).orderBy("tar_path", "member_index").collect()
    assert [(r.member_index, r.audio_file, bytes(r.content), r.offset is None) for r in rows] == [(0, "a.WAV", b"abc", False), (2, "c.wav", b"defg", False), (0, "a.WAV", b"abc", True), (2, "c.wav", b"defg", True)]
    assert tar_ranges.split_members(spark, []).count() == 0
    with pytest.raises(ValueError):
        tar_ranges.split_members(spark, [], range_bytes=100)
    (tmp_path / "no.tar").write_bytes(b"x" * 2000)
    with pytest.raises(Exception, match="ReadError|header"):
        tar_ranges.split_members(spark, [str(tmp_path / "no.tar")]).count()


def test_headers_are_told_by_their_checksum():
    data = archive([("a", b"x" * 700), ("b", b"")])
    assert tar_ranges.headers_in(data).tolist() == [0, 1536] and tar_ranges.headers_in(b"\0" * 4096).tolist() == []
    assert tar_ranges.headers_in(g.bytes(1 << 16)).tolist() == []


def test_resolving_walks_from_the_first_wrong_entry():
    row = lambda start, end, entry, reach, n: ("p", start, end, 400, entry, reach, n)
    facts = pd.DataFrame([row(0, 100, 0, 120, 2), row(100, 200, 150, 210, 1), row(200, 300, None, None, 0), row(300, 400, 310, 400, 1)], columns=tar_ranges.FACTS.replace(" bigint", "").replace(" string", "").split(", "))
    got = [tuple(None if pd.isna(x) else x for x in r) for r in tar_ranges.resolve(facts).itertuples(index=False)]
    assert got == [("p", 0, 100, 400, 0, 0, True), ("p", 100, 300, 400, 120, None, False), ("p", 300, 400, 400, 310, None, None)]
