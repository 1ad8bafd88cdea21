"""Line files with byte offsets: a Python data source that reads a file in byte ranges, an index over it, and lookup by seeking.

Lines end at \\n, \\r\\n or \\r, and offsets keep both bytes of \\r\\n. A line belongs to the range that it starts in, so ranges are read apart;
line numbers come from the ranges' counts by a prefix sum.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.text import is_blank
from .scratch import stored
from .tar import open_stream

SCHEMA = "path string, range_no int, line_in_range bigint, start_offset bigint, end_offset bigint, line string"
BREAK = re.compile(rb"\r\n|\r|\n")


class Range(InputPartition):
    def __init__(self, path: str, number: int, start: int, end: int):
        self.path, self.number, self.start, self.end = path, number, start, end


def lines_between(raw, start: int, end: int, block: int = 1 << 20):
    """(start, end, bytes without the break) of the lines that start in a byte range of an open file."""
    size = raw.size()
    at, buffer, base = start, b"", start
    if start:
        raw.seek(start - 1)
        head = raw.read(2)
        begun = not (head[:1] == b"\n" or (head[:1] == b"\r" and head[1:] != b"\n"))  # the range begins within a line, or its break
    else:
        begun = False
    raw.seek(start)
    while at < min(end, size) or begun:
        m = BREAK.search(buffer, at - base)
        # a \r at the end of what was read may be half of \r\n
        while (m is None or (m.group() == b"\r" and m.end() == len(buffer))) and base + len(buffer) < size:
            buffer, base = buffer[at - base :], at
            buffer += raw.read(block)
            m = BREAK.search(buffer, 0)
        stop, after = (base + m.start(), base + m.end()) if m else (size, size)
        if not begun:
            yield at, after, buffer[at - base : stop - base]
        begun, at = False, after
        if at >= size:
            return


class LineReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options["path"].split(",") if p]
        self.most = int(options.get("rangebytes", 64 << 20))

    def partitions(self):
        out = []
        for p in self.paths:
            with open_stream(p) as raw:
                size = raw.size()
            out += [Range(p, i, at, min(at + self.most, size)) for i, at in enumerate(range(0, max(size, 1), self.most))]
        return out

    def read(self, partition):
        with open_stream(partition.path) as raw:
            for i, (a, b, line) in enumerate(lines_between(raw, partition.start, partition.end)):
                yield partition.path, partition.number, i, a, b, line.decode("utf-8", "replace")


class LineSource(DataSource):
    """spark.read.format("indexed_lines").option("rangeBytes", ...).load("a.jsonl,b.jsonl")"""

    @classmethod
    def name(cls):
        return "indexed_lines"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return LineReader(self.options)


def _ranges(paths: DataFrame, range_bytes: int) -> DataFrame:
    """path, range_no, start, end of the byte ranges of files, sized by the executors."""

    def sized(batches):
        for batch in batches:
            rows = []
            for path in batch.column("path").to_pylist():
                with open_stream(path) as raw:
                    size = raw.size()
                rows += [(path, i, at, min(at + range_bytes, size)) for i, at in enumerate(range(0, max(size, 1), range_bytes))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["path", "range_no", "start", "end"])

    lanes = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return paths.select("path").distinct().mapInArrow(sized, "path string, range_no bigint, start bigint, end bigint").repartition(lanes, "path", "range_no")


def read_lines(ranges: DataFrame, batch_bytes: int = 4 << 20) -> DataFrame:
    """path, line_number, start_offset, end_offset, line of the lines that start in byte ranges. ranges: path, start, end and ahead, the lines before."""

    def run(batches):
        def batch_of(path, rows):
            number, start, end, line = zip(*rows, strict=True)
            text = pa.array([x.decode("utf-8", "replace") for x in line], pa.string())
            return pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), *[pa.array(c, pa.int64()) for c in (number, start, end)], text], ["path", "line_number", "start_offset", "end_offset", "line"])

        for batch in batches:
            for r in batch.to_pylist():
                with open_stream(r["path"]) as raw:
                    rows, held = [], 0
                    for i, (a, b, line) in enumerate(lines_between(raw, r["start"], r["end"])):
                        rows.append((r["ahead"] + i + 1, a, b, line))
                        held += len(line) + 64
                        if held > batch_bytes:
                            yield batch_of(r["path"], rows)
                            rows, held = [], 0
                    if rows:
                        yield batch_of(r["path"], rows)

    return ranges.select("path", "start", "end", "ahead").mapInArrow(run, "path string, line_number bigint, start_offset bigint, end_offset bigint, line string")


def _counted(ranges: DataFrame) -> DataFrame:
    """Byte ranges with n, the number of lines that start in each."""

    def count(batches):
        for batch in batches:
            n = []
            for r in batch.to_pylist():
                with open_stream(r["path"]) as raw:
                    n.append(sum(1 for _ in lines_between(raw, r["start"], r["end"])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())], [*batch.schema.names, "n"])

    return ranges.mapInArrow(count, "path string, range_no bigint, start bigint, end bigint, n bigint")


def numbered_ranges(paths: DataFrame, range_bytes: int) -> DataFrame:
    """The byte ranges of files with ahead, the number of lines before each: lines are counted where they lie, and counts added up."""
    counted = _counted(_ranges(paths, range_bytes))
    before = Window.partitionBy("path").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    out = stored(counted.select("*", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")), "line_ranges")  # one row a range
    return out.where("n > 0").repartition(int(out.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path", "range_no")


def count_lines(paths: DataFrame, range_bytes: int = 64 << 20) -> DataFrame:
    """path, breaks (bytes of \\n, as line counters tell) and lines (as they are numbered here; a last one without a break counts) of files."""

    def count(batches):
        for batch in batches:
            breaks = []
            for r in batch.to_pylist():
                with open_stream(r["path"]) as raw:
                    raw.seek(r["start"])
                    n, left = 0, r["end"] - r["start"]
                    while left:
                        data = raw.read(min(left, 8 << 20))
                        n, left = n + data.count(b"\n"), left - len(data)
                breaks.append(n)
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("n"), pa.array(breaks, pa.int64())], ["path", "n", "breaks"])

    ranges = _counted(_ranges(paths, range_bytes)).mapInArrow(count, "path string, n bigint, breaks bigint")
    return ranges.groupBy("path").agg(F.sum("breaks").alias("breaks"), F.sum("n").alias("lines"))


def index_lines(spark: SparkSession, paths: list[str] | DataFrame, json_only: bool = False, range_bytes: int = 64 << 20) -> DataFrame:
    """path, line_number (from 1, every line counted), start_offset, end_offset, line; blank lines, and bad JSON if asked, are left out.

    paths: a list, or a DataFrame with path. Ranges are counted first and their counts added up; then every range is read with its first
    line's number known, so that lines are never exchanged.
    """
    given = paths.select("path") if isinstance(paths, DataFrame) else spark.createDataFrame([(p,) for p in paths], "path string")
    out = read_lines(numbered_ranges(given, range_bytes)).where(~is_blank(F.col("line")))
    return out.where(F.expr("try_parse_json(line) IS NOT NULL")) if json_only else out


def write_index(index: DataFrame, path: str) -> None:
    """The index without its lines, as JSON lines in order of file and line."""
    index.drop("line").orderBy("path", "line_number").write.mode("overwrite").json(path)


def write_lookup_index(index: DataFrame, path: str) -> None:
    """The index without its lines as Parquet, clustered by file and offset: row groups hold short ranges of both, so that look-ups by either skip the rest."""
    index.drop("line").repartitionByRange("path", "start_offset").sortWithinPartitions("path", "start_offset").write.mode("overwrite").parquet(path)


def merged(spans: list[tuple[int, int]], gap: int, most: int) -> list[tuple[int, int, list[int]]]:
    """(start, end, places in spans) of reads that serve all spans: neighbours at most gap bytes apart share one, of at most so many bytes."""
    out: list[tuple[int, int, list[int]]] = []
    for i in sorted(range(len(spans)), key=lambda i: spans[i]):
        a, b = spans[i]
        if out and a - out[-1][1] <= gap and max(b, out[-1][1]) - out[-1][0] <= most:
            start, end, of = out[-1]
            of.append(i)
            out[-1] = start, max(end, b), of
        else:
            out.append((a, b, [i]))
    return out


def read_at(index: DataFrame, gap: int = 64 << 10, most: int = 16 << 20) -> DataFrame:
    """index with found, the text between a line's offsets, and read_no, the read within its batch and file that brought it.

    Neighbours at most gap bytes apart come in one read of at most `most` bytes; an index in order of file and offset needs fewest.
    """

    def run(batches):
        for batch in batches:
            by_path: dict[str, list[int]] = {}
            for i, p in enumerate(batch.column("path").to_pylist()):
                by_path.setdefault(p, []).append(i)
            spans = list(zip(batch.column("start_offset").to_pylist(), batch.column("end_offset").to_pylist(), strict=True))
            found, number = [None] * len(spans), [None] * len(spans)
            for path, rows in by_path.items():
                with open_stream(path) as raw:
                    for no, (a, b, of) in enumerate(merged([spans[i] for i in rows], gap, most)):
                        raw.seek(a)
                        data = raw.read(b - a)
                        for j in of:
                            s, e = spans[rows[j]]
                            found[rows[j]], number[rows[j]] = data[s - a : e - a].decode("utf-8", "replace").rstrip("\r\n"), no
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(number, pa.int32())], [*batch.schema.names, "found", "read_no"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema.fields)
    return index.mapInArrow(run, f"{kinds}, found string, read_no int")
