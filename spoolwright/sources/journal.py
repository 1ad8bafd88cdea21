"""A journal of result records that survives killed runs, and the longest valid prefix of append logs.

The journal is a data source writer. Its input are thin rows of members; a task fetches, encodes and appends them one by one, so that what a
killed run had finished is on disk. Every task attempt writes segment files of its own, with a line a record; an attempt that follows a
failed one of the same run takes over what is there. Task commits name their segments, and the job's commit writes them into a manifest.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..schemas import RESULTS
from .files import list_files
from .lines import BREAK, index_lines
from .scratch import stored

#: Journal rows are result records with their member's place, as names can repeat in an archive.
JOURNAL = T.StructType([T.StructField("member_index", T.IntegerType()), *RESULTS.fields])
BAD = "_bad"


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


def whole_lines(data: bytes) -> list[dict]:
    """The records of the longest valid prefix of a log."""
    out, at = [], 0
    for m in BREAK.finditer(data):
        line, at = data[at : m.start()], m.end()
        if line.strip():
            try:
                out.append(json.loads(line))
            except ValueError:
                return out
    return out


@dataclass
class Segments(WriterCommitMessage):
    files: list[str]
    rows: int


class JournalWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, run: str, segment_rows: int, work: Callable[[], Callable[[dict], dict]]):
        self.folder, self.run, self.segment_rows, self.work = folder.rstrip("/"), run, segment_rows, work

    def write(self, iterator: Iterator) -> Segments:
        from pyarrow import fs
        from pyspark import TaskContext

        context = TaskContext.get()
        store, root = _store(f"{self.folder}/{self.run}/{context.partitionId():06d}")
        store.create_dir(root, recursive=True)
        done, files, rows = set(), [], 0
        for f in store.get_file_info(fs.FileSelector(root)):  # what earlier attempts of this task have finished
            with store.open_input_file(f.path) as raw:
                had = whole_lines(raw.read())
            done |= {(r["tar_file"], r["member_index"]) for r in had}
            files, rows = [*files, f.path], rows + len(had)
        encode = self.work()
        out, held = None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if (row["tar_path"], row["member_index"]) in done:
                        continue
                    if out is not None and held >= self.segment_rows:
                        out.close()
                        out = None
                    if out is None:
                        files.append(f"{root}/{context.taskAttemptId():010d}-{len(files):06d}.jsonl")
                        out, held = store.open_output_stream(files[-1], compression=None, buffer_size=None), 0
                    out.write(json.dumps({"member_index": row["member_index"], **encode(row)}).encode() + b"\n")
                    out.flush()
                    held, rows = held + 1, rows + 1
        finally:
            if out is not None:
                out.close()
        return Segments(files, rows)

    def commit(self, messages: list) -> None:
        told = [m for m in messages if m]
        store, root = _store(f"{self.folder}/{self.run}")
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/manifest.temp", compression=None) as f:
            f.write(json.dumps({"run": self.run, "committed": time.time(), "rows": sum(m.rows for m in told), "files": sorted(x for m in told for x in m.files)}).encode())
        store.move(f"{root}/manifest.temp", f"{root}/manifest.json")

    def abort(self, messages: list) -> None:
        """Segments stay: their lines are finished work, and the next run reads them."""


def append(members: DataFrame, folder: str, run: str, work: Callable[[], Callable[[dict], dict]], segment_rows: int = 256, profile=None) -> None:
    """Work on members (tar_path, member_index, audio_file, offset, size) and append a record of each to the journal in a folder.

    work makes, once a task, the function from a member to its record. A line is flushed as soon as its record is there; where a store
    shows files only when they are closed, segment_rows bounds what a kill can lose. Writers take no resource profile, so with one the
    same writer runs within mapInArrow, and its messages, one a task, are committed here.
    """
    members = members.select("tar_path", "member_index", "audio_file", "offset", "size")
    if profile is not None:
        writer = JournalWriter(folder, run, segment_rows, work)

        def run_task(batches):
            import pyarrow as pa

            done = writer.write(batches)
            yield pa.RecordBatch.from_pydict({"files": pa.array([done.files], pa.list_(pa.string())), "rows": [done.rows]})

        writer.commit([Segments(r.files, r["rows"]) for r in members.mapInArrow(run_task, "files array<string>, rows bigint", profile=profile).collect()])
        return

    class Journal(DataSource):
        @classmethod
        def name(cls):
            return "journal"

        def writer(self, schema, overwrite):
            return JournalWriter(folder, run, segment_rows, work)

    members.sparkSession.dataSource.register(Journal)
    members.write.format("journal").mode("append").save()


def log_prefix(spark: SparkSession, paths: list[str] | DataFrame, schema: T.StructType = JOURNAL, range_bytes: int = 64 << 20, broadcast_rows: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """(records of the longest valid prefix of each log, one report row a log).

    Records have path, line_number and the columns of the schema. A log is valid up to its first line that is not a whole JSON object of
    the schema; blank lines count for nothing. Report: path, rows (in the prefix), valid_bytes, bad_line (null if none), lost_lines (not
    blank, from the bad one on) and state: whole; torn, if only the last line is bad, as a kill leaves it; damaged otherwise. Logs are
    read in byte ranges; what crosses the network are the places of bad lines.
    """
    fields = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    lines = index_lines(spark, paths, range_bytes=range_bytes)
    parsed = lines.select("path", "line_number", "start_offset", "end_offset", F.from_json("line", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}).alias("r"))
    is_bad = F.col("r").isNull() | F.col(f"r.{BAD}").isNotNull()
    first = parsed.where(is_bad).groupBy("path").agg(F.min("line_number").alias("bad_line"))
    first = stored(first, "bad_lines")  # one row a bad log
    hint = F.broadcast if first.count() <= broadcast_rows else (lambda df: df)
    with_first = lambda rows: rows.join(hint(first), "path", "left")
    before = F.col("bad_line").isNull() | (F.col("line_number") < F.col("bad_line"))
    records = with_first(parsed.select("path", "line_number", "r.*").drop(BAD)).where(before).drop("bad_line")
    places = with_first(lines.select("path", "line_number", "end_offset")).groupBy("path").agg(
        F.count_if(before).alias("rows"), F.coalesce(F.max(F.when(before, F.col("end_offset"))), F.lit(0).cast("bigint")).alias("valid_bytes"), F.first("bad_line").alias("bad_line"), F.count_if(~before).alias("lost_lines")
    )
    state = F.when(F.col("lost_lines") == 0, "whole").when(F.col("lost_lines") == 1, "torn").otherwise("damaged")
    return records, places.withColumn("state", state)


def truncate(report: DataFrame) -> DataFrame:
    """Cut the torn and damaged logs of a report behind their valid prefix; returns their paths and bytes. A kill leaves the log or its prefix."""
    import pyarrow as pa
    from pyspark import TaskContext

    def run(batches):
        for batch in batches:
            for path, n in zip(batch.column("path").to_pylist(), batch.column("valid_bytes").to_pylist(), strict=True):
                store, inner = _store(path)
                temp = f"{inner}.cut-{TaskContext.get().taskAttemptId()}"
                with store.open_input_file(inner) as old, store.open_output_stream(temp, compression=None) as new:
                    left = n
                    while left:
                        data = old.read(min(left, 8 << 20))
                        new.write(data)
                        left -= len(data)
                store.move(temp, inner)
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("valid_bytes")], ["path", "valid_bytes"])

    return report.where("state <> 'whole'").select("path", "valid_bytes").mapInArrow(run, "path string, valid_bytes bigint")


def read_journal(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Journal rows of a folder, every member once: of several records the one without an error, then of the last segment by name."""
    segments = list_files(spark, folder, "*.jsonl", recursive=True).select("path")
    if segments.isEmpty():
        return spark.createDataFrame([], JOURNAL)
    records, _ = log_prefix(spark, segments, **options)
    # one row a member and finished encode; tokens are not moved unless a member repeats
    last = Window.partitionBy("tar_file", "member_index").orderBy(F.col("error").isNotNull(), F.col("path").desc(), F.col("line_number").desc())
    keys = records.select("tar_file", "member_index", "error", "path", "line_number").withColumn("turn", F.row_number().over(last))
    return records.join(keys.where("turn = 1").select("path", "line_number"), ["path", "line_number"], "left_semi").select(*JOURNAL.fieldNames())

