"""Listings of files, and what is done by listing: resolving patterns, deleting empty outputs, cleaning up old temporary files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LISTING = "path string, size bigint, modified timestamp"


def _store(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def plain(path: str) -> str:
    """A local path without its scheme; other paths as they are."""
    return path.removeprefix("file://").removeprefix("file:") if path.startswith("file:") else path


def list_files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """path, size and modified of the files of a folder whose name matches, by path; empty files too. A missing folder has none.

    The listing is the driver's; what a corpus has are archives and record files, not single clips.
    """
    from ..functions.text import glob_to_regex

    store, root = _store(spark, folder)
    rows = []
    if store.exists(root):
        import re

        wanted, found = re.compile(glob_to_regex(pattern)), store.listFiles(root, recursive)
        while found.hasNext():
            s = found.next()
            if wanted.search(s.getPath().getName()):
                rows.append((plain(s.getPath().toString()), s.getLen(), s.getModificationTime() / 1000))
    df = spark.createDataFrame(sorted(rows), "path string, size bigint, seconds double")
    return df.select("path", "size", F.col("seconds").cast("timestamp").alias("modified"))


def resolve_inputs(spark: SparkSession, given: str, suffix: str = ".jsonl") -> list[str]:
    """A folder stands for its files with the suffix; * and ? work in the last component only; else the file itself if there is one."""
    store, p = _store(spark, given)
    name = p.getName()
    if "*" in name or "?" in name:
        folder, pattern = p.getParent().toString(), name
    elif store.exists(p) and store.getFileStatus(p).isDirectory():
        folder, pattern = given, f"*{suffix}"
    else:
        return [given] if store.exists(p) else []
    return [r.path for r in list_files(spark, folder, pattern).collect()]


def older_than(files: DataFrame, hours: float, now=None) -> DataFrame:
    """Files that were last changed more than so many hours before now."""
    at = F.current_timestamp() if now is None else F.lit(now).cast("timestamp")
    return files.where(F.col("modified").cast("timestamp").cast("double") < at.cast("double") - 3600 * hours)


def delete(spark: SparkSession, files: DataFrame, dry_run: bool = False) -> list[str]:
    """Delete the files of a listing and return their paths; dry_run only returns them."""
    paths = sorted(r.path for r in files.select("path").collect())
    if not dry_run:
        for path in paths:
            store, p = _store(spark, path)
            store.delete(p, False)
    return paths


def delete_empty_outputs(spark: SparkSession, outputs: DataFrame, submitted_stems: DataFrame, dry_run: bool = False) -> list[str]:
    """Delete final outputs without bytes, of submitted archives only. outputs: stem, kind, size, path; submitted_stems: stem."""
    empty = outputs.where("kind = 'final' AND size = 0").join(submitted_stems.select("stem"), "stem", "left_semi")
    return delete(spark, empty, dry_run)


def drop_folder(spark: SparkSession, path: str) -> None:
    store, p = _store(spark, path)
    store.delete(p, True)


def clean_temporary(spark: SparkSession, folder: str, pattern: str = "*.temp", hours: float = 168, now=None, dry_run: bool = False) -> list[str]:
    return delete(spark, older_than(list_files(spark, folder, pattern), hours, now), dry_run)


def exists(spark: SparkSession, path: str) -> bool:
    store, p = _store(spark, path)
    return store.exists(p)


def replace(spark: SparkSession, staged: str, target: str) -> None:
    """Rename a staged file over another in one step of the store: whoever looks sees the old or the new file, never none."""
    hadoop, gateway = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._gateway
    new, old = hadoop.Path(staged), hadoop.Path(target)
    store = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(new):
        raise FileNotFoundError(staged)
    checksum = hadoop.Path(old.getParent(), f".{old.getName()}.crc")
    if store.getScheme() == "file" and store.getRawFileSystem().exists(checksum):  # of the old file; without one, none is checked
        store.getRawFileSystem().delete(checksum, False)
    options = gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration()).rename(store.makeQualified(new), store.makeQualified(old), options)
