"""Helpers the operators share: tables in the shared folder, words, sizes."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Lower-cased ASCII letters, digits and every non-ASCII byte make words; all else parts them.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes, ASCII capitals lowered; none for null."""
    return text.encode().translate(WORD_BYTES).split() if text else []


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees. Where the session names none, a local one; on a cluster that would lose data, so it raises."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = f"file://{tempfile.gettempdir()}/spoolwright-{os.getuid()}"
    return path.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/spoolwright/{re.sub(r'\W', '_', tag)}-{uuid.uuid4().hex}"


def spill(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, survives lost executors, and gives later joins real sizes."""
    return spill_twice(df, tag)[0]


def spill_twice(df: DataFrame, tag: str) -> tuple[DataFrame, DataFrame]:
    """As spill(), for a table that meets itself: two frames with columns of their own."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.parquet(path)
    return tuple(spark.read.schema(df.schema).parquet(path) for _ in range(2))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_owner: list[str] = [""]
_letting_go: dict[str, Callable[[], None]] = {}


def working_for(name: str, let_go: Callable[[], None] | None = None) -> None:
    """Says in a worker that its task is an operator's. Workers outlive tasks: with another operator than the last one, what others keep is let go,
    by what they gave as let_go, and memory that is free goes back to the system, so that stages do not add up in one process."""
    if let_go is not None:
        _letting_go[name] = let_go
    if _owner[0] == name:
        return
    first, _owner[0] = not _owner[0], name
    if first:
        return
    import ctypes
    import gc

    import pyarrow as pa

    for other, clear in _letting_go.items():
        if other != name:
            clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch, rows: int):
    """An Arrow batch in pieces of at most so many rows, so that what Python unpacks stays small."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def byte_slices(batch, column: str, most_bytes: int = 8 << 20):
    """An Arrow batch in pieces whose values of a string column have at most so many bytes, but one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, most_bytes + (ends[at - 1] if at else 0), "right")))
        yield batch.slice(at, to - at)
        at = to


def unused(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    while name.lower() in [c.lower() for c in df.columns]:
        name += "_"
    return name
