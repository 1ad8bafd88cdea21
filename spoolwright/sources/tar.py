"""Tar archives as a Python data source.

One partition reads the headers of one archive; payloads are skipped unless wanted. fetch() reads payloads of chosen members by offset, so
members are planned, filtered and anti-joined as thin rows first and one large archive can be spread over many tasks.
"""

from __future__ import annotations

import tarfile

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schemas import MEMBERS


def open_stream(path: str):
    """Any store that pyarrow knows, by URI; a bare path is local."""
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return store.open_input_file(inner)


class Archive(InputPartition):
    def __init__(self, path: str):
        self.path = path


class TarReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options["path"].split(",") if p]
        self.suffixes = tuple(s for s in options.get("extensions", "").split(",") if s)
        self.content = options.get("content", "false").lower() == "true"

    def partitions(self):
        return [Archive(p) for p in self.paths]

    def read(self, partition):
        with open_stream(partition.path) as raw, tarfile.open(fileobj=raw, mode="r") as tar:
            seekable = type(tar.fileobj) is type(raw) or tar.fileobj is raw
            for i, m in enumerate(tar):
                if self.suffixes and not (m.isfile() and m.name.lower().endswith(self.suffixes)):
                    continue
                content = tar.extractfile(m).read() if self.content and m.isfile() else None
                yield (partition.path, i, m.name, m.offset_data if seekable else None, m.size, m.isfile(), content)


class TarSource(DataSource):
    """spark.read.format("tar_members").option("extensions", ".wav").load("a.tar,b.tar"); offset is null in compressed archives."""

    @classmethod
    def name(cls):
        return "tar_members"

    def schema(self):
        return MEMBERS

    def reader(self, schema):
        return TarReader(self.options)


def read_members(spark: SparkSession, paths: list[str], extensions: list[str] = (".mp3",), content: bool = False) -> DataFrame:
    spark.dataSource.register(TarSource)
    return spark.read.format("tar_members").option("extensions", ",".join(extensions)).option("content", str(content).lower()).load(",".join(paths))


def read_member(row: dict) -> bytes:
    """The payload of a member: by seeking where the offset is known, else by reading through the archive. row: tar_path, member_index, audio_file, offset, size."""
    with open_stream(row["tar_path"]) as raw:
        if row["offset"] is not None:
            raw.seek(row["offset"])
            data = raw.read(row["size"])
            if len(data) < row["size"]:
                raise ValueError(f"{row['audio_file']} breaks off after {len(data)} of {row['size']} bytes")
            return data
        with tarfile.open(fileobj=raw, mode="r") as tar:
            return next(tar.extractfile(m).read() for i, m in enumerate(tar) if i == row["member_index"])


def fetch(members: DataFrame) -> DataFrame:
    """members with their content."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                r["content"] = read_member(r)
                yield pa.RecordBatch.from_pylist([r], schema=batch.schema.set(batch.schema.get_field_index("content"), pa.field("content", pa.binary())))

    return members.mapInArrow(run, members.schema)
