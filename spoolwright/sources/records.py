"""Result records as JSON lines, and listings of outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import matches_any
from ..schemas import RESULTS

CORRUPT = "_corrupt_record"


def read_results(spark: SparkSession, paths, strict: bool = False) -> DataFrame:
    """Records of JSON-line files, with nulls for keys that old files lack. strict: any bad line fails; else bad lines are dropped."""
    if strict:
        return spark.read.schema(RESULTS).option("mode", "FAILFAST").json(paths)
    # the corrupt column is read with the others from plain lines, so that pruning can't hide it
    schema = T.StructType([*RESULTS.fields, T.StructField(CORRUPT, T.StringType())])
    lines = spark.read.text(paths).where("trim(value) <> ''")
    parsed = lines.select(F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    return parsed.where(F.col("r").isNotNull() & F.col(f"r.{CORRUPT}").isNull()).select("r.*").drop(CORRUPT)


def write_results(results: DataFrame, path: str, order: tuple[str, ...] = ("audio_file",)) -> None:
    """One folder an archive, replaced as a whole; folders of other archives stay. The records of a large archive are written by many tasks,
    as files whose names ascend in the given order."""
    from ..functions.text import stem

    out = results.withColumn("tar_stem", stem(F.col("tar_file")))
    out.repartitionByRange("tar_stem", *order).sortWithinPartitions("tar_stem", *order).write.option("partitionOverwriteMode", "dynamic").partitionBy("tar_stem").mode("overwrite").json(path)


def list_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """stem, kind (final or partial), size, path. From a listing, as file scans don't show empty files."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    for s in store.listStatus(path) if store.exists(path) else []:
        name = s.getPath().getName()
        for suffix, kind in ((".jsonl.partial", "partial"), (".jsonl", "final")):
            if s.isFile() and name.endswith(suffix):
                rows.append((name.removesuffix(suffix), kind, s.getLen(), s.getPath().toString()))
                break
    return spark.createDataFrame(rows, "stem string, kind string, size bigint, path string")


def index_inputs(files: DataFrame, path: str, exclude: list[str] = ("*_index.jsonl", "*index.jsonl"), output: str = "") -> DataFrame:
    return files.where(~matches_any(F.col(path), list(exclude)) & (F.col(path) != output))
