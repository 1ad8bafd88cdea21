"""Token-ID files: flat unsigned integers, 64-bit document offsets and document ids, one set of files for each range of an order.

part-00000.ids holds ids as little-endian unsigned integers (16 bits where the vocabulary allows it, else 32); part-00000.off has one
unsigned 64-bit offset more than documents, counted in ids from the part's start; part-00000.doc has a signed 64-bit doc_id and a
validity byte each. Parts follow one another in the order asked for, by doc_id if none is; the base of a part is the sum of the parts before.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import byte_slices, fresh_path, partitions, spill, working_for
from .token_tables import ByteEncoder
from .warc import open_folder

#: Sampled places for each part, from which the parts' bounds are taken.
SAMPLED = 100
_encoders: dict[str, ByteEncoder] = {}


def encoder(path: str) -> ByteEncoder:
    if path not in _encoders:
        _encoders[path] = ByteEncoder(path)
    return _encoders[path]


def _places(columns: list[list]) -> list[tuple]:
    """Rows as tuples that compare as Spark sorts them, nulls first."""
    return [tuple((v is not None, v) if v is not None else (False,) for v in row) for row in zip(*columns, strict=True)]


def part_bounds(places: DataFrame, n: int) -> list[tuple]:
    """At most n - 1 places that part the rows of a table into ranges of nearly equal length, from a sample of about SAMPLED * n rows."""
    rows = places.count()
    picked = places.sample(min(1.0, SAMPLED * n / rows), 17).collect() if rows else []
    found = sorted(_places([[r[c] for r in picked] for c in places.columns])) if picked else []
    return sorted({found[len(found) * i // n] for i in range(1, n)}) if found else []


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = 0, order: tuple[str, ...] = ()) -> DataFrame:
    """Encode docs (doc_id, text) into files below folder; returns the parts: part, name, width, n_docs, n_ids, base.

    Documents are written in ascending order of the columns named in order, by doc_id if none is, nulls first; rows that are equal there
    are ordered by a hash of their text, so that no value need stay within one file. Repeated rows are written each. A null text is
    encoded as an empty one: its only id is the end id. doc_id must be a number. Texts are encoded where they are read, and only ids
    are shuffled. A task writes under a name of its attempt, then renames, so a repeated task replaces equal files. An empty table gives no parts.
    """
    spark = docs.sparkSession
    by = list(order) or ["doc_id"]
    keyed = docs.select(F.col("doc_id").cast("long"), *order, F.xxhash64("text").alias("text_hash"), "text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields[:-1])
    bounds = part_bounds(keyed.select(*by, "text_hash"), partitions(spark))

    def encode(batches):
        working_for("token_files", _encoders.clear)
        enc = encoder(path)
        for batch in batches:
            for piece in byte_slices(batch, "text", 2 << 20):  # what encoding holds beside a piece is many times its size
                ids, at = enc.encode(piece.column("text"), end_id)
                part = [bisect_right(bounds, p) for p in _places([piece.column(c).to_pylist() for c in (*by, "text_hash")])]
                rows = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at * enc.type.itemsize), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(part, pa.int32()), rows.cast(pa.binary())], [*piece.schema.names[:-1], "part", "ids"])

    def write(batches):
        part, attempt, width = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), encoder(path).type.itemsize
        store, base = open_folder(folder)
        name = f"part-{part:05d}"
        n_docs = n_ids = 0
        sinks = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            if not sinks:
                store.create_dir(base, recursive=True)
                sinks = {k: store.open_output_stream(f"{base}/.{name}-{attempt}.{k}") for k in ("ids", "off", "doc")}
                sinks["off"].write(np.zeros(1, "<u8").tobytes())
            doc, ids = batch.column("doc_id"), batch.column("ids")
            ends = n_ids + np.cumsum(pa.compute.binary_length(ids).to_numpy().astype(np.int64) // width)
            for one in ids:
                sinks["ids"].write(one.as_buffer())
            sinks["off"].write(ends.astype("<u8").tobytes())
            record = np.zeros(batch.num_rows, [("id", "<i8"), ("valid", "u1")])
            record["id"], record["valid"] = doc.fill_null(0).to_numpy(zero_copy_only=False), doc.is_valid().to_numpy(zero_copy_only=False)
            sinks["doc"].write(record.tobytes())
            n_docs, n_ids = n_docs + batch.num_rows, int(ends[-1])
        for k, sink in sinks.items():
            sink.close()
            store.move(f"{base}/.{name}-{attempt}.{k}", f"{base}/{name}.{k}")
        if n_docs:
            yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [name], "width": pa.array([width], pa.int32()), "n_docs": pa.array([n_docs], pa.int64()), "n_ids": pa.array([n_ids], pa.int64())})

    ordered = keyed.mapInArrow(encode, f"{kinds}, part int, ids binary").repartitionById(partitions(spark), "part").sortWithinPartitions(*by, "text_hash")
    parts = spill(ordered.select("doc_id", "ids").mapInArrow(write, "part int, name string, width int, n_docs long, n_ids long"), "token_parts")
    rows = parts.orderBy("part").collect()  # one row a part
    bases = [0, *accumulate(r.n_ids for r in rows)]
    return spark.createDataFrame([(*r, b) for r, b in zip(rows, bases, strict=False)], "part int, name string, width int, n_docs long, n_ids long, base long")


def mapped(folder: str, name: str):
    """The bytes of one file: memory-mapped where the store is a local or mounted file system, else read."""
    from pyarrow import fs

    store, base = open_folder(folder)
    path = f"{base}/{name}"
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), np.uint8)


def read_token_files(parts: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document in the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ids if asked for."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = mapped(folder, r["name"] + ".ids").view(f"<u{r['width']}")
                off = mapped(folder, r["name"] + ".off").view("<u8").astype(np.int64)
                doc = mapped(folder, r["name"] + ".doc").view([("id", "<i8"), ("valid", "u1")])
                if len(off) != r["n_docs"] + 1 or off[-1] != r["n_ids"] or len(ids) != r["n_ids"]:
                    raise ValueError(f"{r['name']} doesn't have the length that its part says")
                for at in range(0, r["n_docs"], 4096):
                    to = min(at + 4096, r["n_docs"])
                    crc = [zlib.crc32(ids[off[i] : off[i + 1]].astype("<u4").tobytes()) for i in range(at, to)]
                    d = doc[at:to]
                    out = {"doc_id": pa.array(d["id"].copy(), mask=d["valid"] == 0), "start": pa.array(r["base"] + off[at:to]), "n_tokens": pa.array(np.diff(off[at : to + 1])), "ids_crc32": pa.array(crc, pa.int64())}
                    if with_ids:
                        out["ids"] = pa.array([ids[off[i] : off[i + 1]].astype(np.int64) for i in range(at, to)], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(out)

    n = max(1, min(parts.count(), partitions(parts.sparkSession)))
    return parts.repartition(n).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def token_round_trip(docs: DataFrame, path: str, with_ids: bool = False, order: tuple[str, ...] = ()) -> DataFrame:
    """write_token_files() in the shared folder, then read_token_files(): one row per row of docs, none for an empty table."""
    folder = fresh_path(docs.sparkSession, "token_files")
    return read_token_files(write_token_files(docs, folder, path, order=order), folder, with_ids)
