"""Exact token counts of whole documents, huge ones by overlap resynchronisation."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import slices, working_for
from .token_tables import ChunkCounter

_counters: dict[str, ChunkCounter] = {}


def counter(path: str) -> ChunkCounter:
    """One counter for each worker process."""
    if path not in _counters:
        _counters[path] = ChunkCounter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_tokens, over_limit. path: a tokenizers file on every executor.

    A null text counts as empty: no bytes, no tokens. Rows are counted one by one, so repeated rows and null doc_ids need no care. Very
    long texts are encoded chunk by chunk, so a worker holds one chunk's tokens beside the text.
    Other columns of docs are not read; an empty table gives no rows.
    """

    def run(batches):
        working_for("token_counts", _counters.clear)
        c = counter(path)
        for batch in batches:
            for part in slices(batch, 256):
                n = c.counts(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    ids = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    counted = ids.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
