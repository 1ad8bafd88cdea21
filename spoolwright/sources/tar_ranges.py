"""Headers of tar archives read in byte ranges, so that one large archive is listed by many tasks.

A range owns the members whose header starts in it. Its first header is not known beforehand: a task looks for a block of 512 bytes whose
checksum holds and from which a chain of sizes leads to further such blocks. That is a guess, as a payload can hold headers too. The chain
of every range therefore also tells where it leaves the range, and the ranges of an archive are compared in order: a range that did not
begin where the chain before it arrived is walked again from there, together with the ranges behind it that found no header. In the end
every range is entered from the chain that begins at byte 0, so the members are those of a sequential reader.
"""

from __future__ import annotations

import tarfile

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import has_suffix
from .scratch import stored
from .tar import open_stream

BLOCK = tarfile.BLOCKSIZE
#: First bytes of what cannot be entered in the middle: gzip, bzip2, xz and Zstandard streams.
COMPRESSED = (b"\x1f\x8b", b"BZh", b"\xfd7zXZ\x00", b"\x28\xb5\x2f\xfd")
#: Members of these types have no payload.
LINKS = (b"1", b"2", b"3", b"4", b"5", b"6")
SEGMENTS = "path string, start bigint, end bigint, size bigint, entry bigint"
FACTS = "path string, start bigint, end bigint, size bigint, entry bigint, reach bigint, n bigint"
MEMBER = "struct<name: string, offset: bigint, size: bigint, is_file: boolean>"


def headers_in(data: bytes) -> np.ndarray:
    """Places of the blocks of data that are tar headers by their checksum: the sum of all bytes, those of the checksum field taken as spaces."""
    blocks = np.frombuffer(data, np.uint8)[: len(data) // BLOCK * BLOCK].reshape(-1, BLOCK)
    told = blocks[:, 148:156]
    digits = ((told >= 48) & (told <= 55)) | (told == 32) | (told == 0)
    maybe = np.flatnonzero(digits.all(1) & (blocks[:, 0] > 0))
    sums = blocks[maybe].sum(1, dtype=np.int64) - told[maybe].sum(1, dtype=np.int64) + 8 * 32
    out = []
    for i, s in zip(maybe.tolist(), sums.tolist(), strict=True):
        text = bytes(told[i]).strip(b" \0")
        if text and b" " not in text and b"\0" not in text and int(text, 8) == s:
            out.append(i * BLOCK)
    return np.array(out, np.int64)


def _follows(raw, at: int, size: int, links: int) -> bool:
    """Whether a chain of headers leads on from a header, so many links or to the end of the archive."""
    for _ in range(links):
        raw.seek(at)
        head = raw.read(BLOCK)
        if not head.strip(b"\0"):
            return True
        if len(head) < BLOCK or not len(headers_in(head)):
            return False
        try:
            length = tarfile.nti(head[124:136])
        except tarfile.InvalidHeaderError:
            return False
        at += BLOCK + (0 if head[156:157] in LINKS else -(-length // BLOCK) * BLOCK)
        if at > size:
            return False
    return True


def guess_entry(raw, start: int, end: int, size: int, probe: int, links: int = 3) -> int | None:
    """Where the first member of a range seems to start; None if the first bytes of it, probe at most, hold no header."""
    at, step = -(-start // BLOCK) * BLOCK, 256 * BLOCK
    stop = min(end, size, start + probe)
    while at < stop:
        raw.seek(at)
        data = raw.read(min(step, -(-(stop - at) // BLOCK) * BLOCK))
        for place in headers_in(data).tolist():
            if at + place < stop and _follows(raw, at + place, size, links):
                return at + place
        if len(data) < BLOCK:
            return None
        at += len(data) // BLOCK * BLOCK
    return None


def walk(raw, entry: int, end: int, size: int):
    """(members whose header starts before end, where the next member starts); the end of the archive is its size."""
    members = []
    raw.seek(entry)
    tar = tarfile.TarFile(fileobj=raw, mode="r")  # raises where byte 0 has no header; behind it, none is the end
    while (m := tar.next()) is not None:
        members.append({"name": m.name, "offset": m.offset_data, "size": m.size, "is_file": m.isfile()})
        tar.members = []  # what has been told is not kept
        if tar.offset >= end:
            return members, tar.offset
    return members, size


def _walked(segments: DataFrame, probe: int) -> DataFrame:
    """Every segment with the members that its chain finds, where the chain arrives, and the entry it began at; null if none was found."""
    members_type = pa.list_(pa.struct([("name", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("is_file", pa.bool_())]))

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                with open_stream(r["path"]) as raw:
                    members, reach, entry = [], None, r["entry"]
                    raw.seek(0)
                    if r["start"] == 0 and raw.read(6).startswith(COMPRESSED):
                        raw.seek(0)
                        with tarfile.open(fileobj=raw, mode="r") as tar:
                            for m in tar:
                                members.append({"name": m.name, "offset": None, "size": m.size, "is_file": m.isfile()})
                                tar.members = []
                        reach = r["size"]
                    else:
                        entry = guess_entry(raw, r["start"], r["end"], r["size"], probe) if entry is None else entry
                        if entry is not None:
                            members, reach = walk(raw, entry, r["end"], r["size"])
                row = {k: [r[k]] for k in ("path", "start", "end", "size")}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["path"]), *[pa.array(row[k], pa.int64()) for k in ("start", "end", "size")], pa.array([entry], pa.int64()), pa.array([reach], pa.int64()), pa.array([len(members)], pa.int64()), pa.array([members], members_type)],
                    ["path", "start", "end", "size", "entry", "reach", "n", "members"],
                )

    return segments.mapInArrow(run, f"{FACTS}, members array<{MEMBER}>")


def resolve(facts: pd.DataFrame) -> pd.DataFrame:
    """The segments of one archive: those that hold, with the number of members ahead of them, those to be walked, from a known entry, and
    those that are undecided until then (held is null).

    facts: one row a segment, with the entry it began at and the reach of its chain; both null if it found no header. The first segment
    that did not begin where the chain from byte 0 arrived is always walked from there, so every round settles one at least.
    """
    out, at, ahead, certain, pending = [], 0, 0, True, None
    for r in facts.sort_values("start").itertuples():
        entry, reach = (None if pd.isna(x) else int(x) for x in (r.entry, r.reach))
        if pending and entry is None:
            pending[2] = r.end  # no header was found: walked with the segment before
            continue
        if pending:
            out.append((*pending, None, False))
            pending, at = None, entry  # a guess; whether it holds is known when the walk before it has arrived
        if at >= r.end and r.end > 0:  # all of it lies within a member, if what comes before holds
            if not certain:
                out.append((r.path, r.start, r.end, r.size, entry, None, None))
            continue
        if entry == at:
            out.append((r.path, r.start, r.end, r.size, at, ahead if certain else None, True if certain else None))
            at, ahead = reach, ahead + int(r.n)
        else:
            pending, certain = [r.path, r.start, r.end, r.size, at], False
    if pending:
        out.append((*pending, None, False))
    return pd.DataFrame(out, columns=["path", "start", "end", "size", "entry", "ahead", "held"]).astype({"ahead": "Int64", "held": "boolean"})


def split_members(spark: SparkSession, paths: list[str] | DataFrame, extensions: list[str] = (), range_bytes: int = 64 << 20, probe_bytes: int = 4 << 20) -> DataFrame:
    """The members of archives as thin rows (see schemas.MEMBERS; no content), each archive read by as many tasks as it has ranges.

    paths: a list, or a DataFrame with path. A range reads at most probe_bytes to find its first header, then headers only. Compressed
    archives cannot be entered in the middle: each is one range, and its members have no offset. Members keep the archive's order in
    member_index, whatever their names; with extensions, only files whose lower-cased name ends with one of them are returned, numbered
    as in the whole archive. Damaged headers end an archive, as for a sequential reader; a file that is no archive raises ReadError; a member
    whose payload breaks off is listed, and fetching it fails.
    Global extended headers are applied within the range that holds them.
    """
    if range_bytes < BLOCK:
        raise ValueError("a range must hold a header")
    given = paths.select("path") if isinstance(paths, DataFrame) else spark.createDataFrame([(p,) for p in paths], "path string")

    def sized(batches):
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                with open_stream(path) as raw:
                    size = raw.size()
                    whole = raw.read(6).startswith(COMPRESSED)
                step = max(size, 1) if whole else range_bytes
                rows += [(path, s, min(s + step, size), size, 0 if s == 0 else None) for s in range(0, max(size, 1), step)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))], ["path", "start", "end", "size", "entry"])

    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    segments = given.distinct().mapInArrow(sized, SEGMENTS)
    walked = stored(_walked(segments.repartition(lanes, "path", "start"), probe_bytes), "tar_segments")
    while True:
        told = walked.drop("members").groupBy("path").applyInPandas(resolve, f"{SEGMENTS}, ahead bigint, held boolean")
        told = stored(told, "tar_resolved")  # a row a range, members stay where they are
        todo = told.where("held = false").select("path", "start", "end", "size", "entry")
        if todo.isEmpty():
            break
        kept = walked.join(told.where("coalesce(held, true)").select("path", "start"), ["path", "start"], "left_semi").select(walked.columns)
        walked = stored(kept.unionByName(_walked(todo.repartition(lanes, "path", "start"), probe_bytes)), "tar_segments")
    rows = walked.join(told.select("path", "start", "ahead"), ["path", "start"]).select("path", "ahead", F.posexplode("members").alias("i", "m"))
    rows = rows.select(F.col("path").alias("tar_path"), (F.col("ahead") + F.col("i")).cast("int").alias("member_index"), F.col("m.name").alias("audio_file"), "m.offset", "m.size", "m.is_file", F.lit(None).cast("binary").alias("content"))
    if extensions:
        rows = rows.where(F.col("is_file") & has_suffix(F.col("audio_file"), list(extensions)))
    return rows
