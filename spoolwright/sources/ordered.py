"""Many text files written by one job, each in order and by one task, and put in place of older ones one atomic step a file.

The job only stages: a task writes the files of its partition under names of its attempt, and the commit lists them in a manifest. Renaming
over the targets follows from the manifest, so that it can be carried on where it broke off. At any moment a target is the old or the new file.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .files import replace
from .scratch import scratch_path

MANIFEST = "path string, staged string, n bigint"


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


@dataclass
class Staged(WriterCommitMessage):
    files: list[tuple[str, str, int]]


class OrderedWriter(DataSourceArrowWriter):
    def __init__(self, manifest: str, run: str):
        self.manifest, self.run = manifest, run

    def write(self, iterator: Iterator) -> Staged:
        from pyspark import TaskContext

        files, out, path = [], None, None
        try:
            for batch in iterator:
                for p, line in zip(batch.column("path").to_pylist(), batch.column("line").to_pylist(), strict=True):
                    if p != path:
                        if out is not None:
                            out.close()
                        path = p
                        folder, _, name = p.rpartition("/")
                        staged = f"{folder}/.{name}.staged-{self.run}-{TaskContext.get().taskAttemptId()}"
                        store, inner = _store(staged)
                        store.create_dir(inner.rpartition("/")[0], recursive=True)
                        out = store.open_output_stream(inner, compression=None)
                        files.append([p, staged, 0])
                    out.write(line.encode() + b"\n")
                    files[-1][2] += 1
        finally:
            if out is not None:
                out.close()
        return Staged([tuple(f) for f in files])

    def commit(self, messages: list) -> None:
        files = sorted(f for m in messages if m for f in m.files)
        twice = {a[0] for a, b in zip(files, files[1:], strict=False) if a[0] == b[0]}
        if twice:
            raise ValueError(f"written by two tasks: {sorted(twice)[:3]}")
        store, inner = _store(self.manifest)
        store.create_dir(inner, recursive=True)
        with store.open_output_stream(f"{inner}/files.json", compression=None) as f:
            for p, staged, n in files:
                f.write(json.dumps({"path": p, "staged": staged, "n": n}).encode() + b"\n")

    def abort(self, messages: list) -> None:
        for m in messages:
            for _, staged, _ in m.files if m else ():
                store, inner = _store(staged)
                store.delete_file(inner)


def stage_files(rows: DataFrame, order: str) -> DataFrame:
    """Write the lines of each path, in order, beside its target; returns the manifest: path, staged, n. rows: path, line and the order."""
    import uuid

    spark, run = rows.sparkSession, uuid.uuid4().hex
    manifest = scratch_path(spark, "manifest")

    class Ordered(DataSource):
        @classmethod
        def name(cls):
            return "ordered_files"

        def writer(self, schema, overwrite):
            return OrderedWriter(manifest, run)

    spark.dataSource.register(Ordered)
    lanes = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(lanes, "path").sortWithinPartitions("path", order).select("path", "line").write.format("ordered_files").mode("append").save()
    return spark.read.schema(MANIFEST).json(manifest)


def put_in_place(manifest: DataFrame) -> int:
    """Rename every staged file of a manifest over its target; those that are in place already are left. Returns how many were renamed."""
    from .files import exists

    done = 0
    for r in manifest.orderBy("path").toLocalIterator():
        if exists(manifest.sparkSession, r.staged):
            replace(manifest.sparkSession, r.staged, r.path)
            done += 1
    return done
