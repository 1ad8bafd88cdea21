"""Manifests of archives: positions carry the order that files have."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import name, stem, strip


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """pos, tar_path, tar_stem of a newline list; blank lines are dropped, others stripped."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\n")).alias("pos", "line"))
    return as_manifest(lines.select(F.col("pos").cast("long"), strip(F.col("line")).alias("tar_path")).where("tar_path <> ''"))


def as_manifest(df: DataFrame) -> DataFrame:
    return df.select("pos", "tar_path", stem(F.col("tar_path")).alias("tar_stem"))


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.orderBy("pos").coalesce(1).select("tar_path").write.text(path)


def select_range(manifest: DataFrame, prefix: str = "", start: int | None = None, end: int | None = None) -> DataFrame:
    """Names that begin with the prefix; with a bound, whole-numbered stems within it, both ends included."""
    out = manifest.where(name(F.col("tar_path")).startswith(prefix)) if prefix else manifest
    number = F.col("tar_stem").try_cast("bigint")
    if start is not None:
        out = out.where(number >= start)
    if end is not None:
        out = out.where(number <= end)
    return out


def preview(manifest: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows, and the last n if there are more than 2 n; TakeOrdered on either side."""
    head = manifest.orderBy("pos").limit(n).withColumn("part", F.lit("head"))
    tail = manifest.orderBy(F.col("pos").desc()).limit(n).withColumn("part", F.lit("tail"))
    many = manifest.agg((F.count("*") > 2 * n).alias("many"))
    return head.unionByName(tail.join(F.broadcast(many), F.col("many")).drop("many"))


def task_slice(manifest: DataFrame, task: int, per_task: int = 4) -> DataFrame:
    """The rows of one task by their positions, so that a scan of a manifest that knows its positions' range skips the rest."""
    return manifest.where(F.col("pos").between(task * per_task, (task + 1) * per_task - 1))


def assign_tasks(manifest: DataFrame, per_task: int = 4) -> DataFrame:
    return manifest.withColumns({"task": F.floor(F.col("pos") / per_task).cast("long"), "slot": (F.col("pos") % per_task).cast("int")})
