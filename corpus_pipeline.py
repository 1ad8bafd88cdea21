"""The corpus pipeline: each stage takes the documents that the one before kept.

A stage gets (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoolwright.llm import decontaminate, mixing, nearcopies, token_files, toxicity
from spoolwright.llm._shared import spill, table
from spoolwright.llm.queries import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity, as learned from the labels of these documents; the rest stays as it is."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that with the least doc_id."""
    return nearcopies.without_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as their source's target has them."""
    return mixing.mixed_documents(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-ID files of what is left, in the training order in which mixing wrote it; one row per document in them: doc_id, start, n_tokens, ids_crc32.

    Sorted rows are written to files whose names ascend, but are not read back in that order, so a row's place is its file and its number there.
    """
    placed = docs.select("doc_id", "text", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return token_files.token_round_trip(placed, tokenizer_file("byte_bpe_50k.json"), order=("file", "row"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

#: Learned scores, sampled sketches and byte-pair encoding have no SQL form; tests hold decontamination against a brute-force version
#: and check what the other stages keep; op2's, op4's, op7's and op10's own tests hold those operators against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spill(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
