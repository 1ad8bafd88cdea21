"""Metadata backfill: the lines of record files meet the members of their archive by position, and files of which every line fits are replaced.

All files go through the same few jobs. What is compared are thin rows; of members only headers are read, and only of those whose record lacks
metadata; lines that stay are written again byte for byte.
"""

from __future__ import annotations

import io

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions.text import name, stem
from ..headers import Counted, metadata
from ..operators.merge import positional_merge
from ..schemas import METADATA, RESULTS
from ..sources.files import list_files
from ..sources.lines import index_lines
from ..sources.ordered import put_in_place, stage_files
from ..sources.scratch import stored
from ..sources.tar import open_stream, read_member
from ..sources.tar_ranges import split_members

BAD = "_bad"


def paired(files: DataFrame, archives: DataFrame) -> DataFrame:
    """path and tar_path of record files and the archives of the same stem; tar_path is null where there is none, or more than one (then ambiguous)."""
    a = archives.groupBy(stem(F.col("path")).alias("stem")).agg(F.max("path").alias("tar_path"), (F.count_distinct("path") > 1).alias("many"))
    both = files.select("path", stem(F.col("path")).alias("stem")).distinct().join(a, "stem", "left")
    many = F.coalesce("many", F.lit(False))
    return both.select("path", F.when(~many, F.col("tar_path")).alias("tar_path"), many.alias("ambiguous"))


def row_actions(lines: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """What becomes of every position of a key: keep, read or replace, or why its whole file must stay as it is: missing_line, extra_line or name.

    lines: key, line_number, audio_file, is_bad, has_error, has_metadata. members: key, member_index, audio_file. The k-th line meets the
    k-th member. A bad line is replaced by an error record whatever it was about; a line with an error is kept whatever its name; names
    are compared without folders, and a line without one fits none; lines with metadata are kept; the others are to be read.
    """
    left = lines.select(key, "line_number", name(F.col("audio_file")).alias("base"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("is_bad", "has_error", "has_metadata")])
    right = members.select(key, F.col("member_index").cast("bigint").alias("line_number"), F.col("audio_file").alias("member"))
    m = positional_merge(left, right, [key], "line_number")
    same = F.col("left_base").eqNullSafe(name(F.col("right_member")))
    action = F.when(F.col("state") == "right_short", "extra_line").when(F.col("state") == "right_long", "missing_line").when(F.col("left_is_bad"), "replace").when(F.col("left_has_error"), "keep")
    action = action.when(~same, "name").when(F.col("left_has_metadata"), "keep").otherwise("read")
    return m.select(key, "k", F.col("left_line_number").alias("line_number"), F.col("right_line_number").alias("member_index"), F.col("right_member").alias("audio_file"), action.alias("action"))


def file_tallies(actions: DataFrame, key: str) -> DataFrame:
    """key, commit, rows (lines), updated (lines that get metadata or an error; none without commit) and reason: of what forbids it, that of the first position."""
    stops = F.col("action").isin("missing_line", "extra_line", "name")
    changes = F.col("action").isin("read", "replace")
    out = actions.groupBy(key).agg(F.count("line_number").alias("rows"), F.count_if(changes).alias("updated"), F.min_by(F.when(stops, F.col("action")), F.when(stops, F.col("k"))).alias("reason"))
    commit = F.col("reason").isNull()
    return out.select(key, commit.alias("commit"), "rows", F.when(commit, F.col("updated")).otherwise(0).alias("updated"), "reason")


def parsed_lines(lines: DataFrame) -> DataFrame:
    """lines with r, the record (null if bad), and is_bad, has_error and has_metadata."""
    fields = T.StructType([*RESULTS.fields, T.StructField(BAD, T.StringType())])
    out = lines.withColumn("r", F.from_json("line", fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}))
    bad = F.col("r").isNull() | F.col(f"r.{BAD}").isNotNull()
    return out.withColumns({"is_bad": bad, "has_error": ~bad & F.col("r.error").isNotNull(), "has_metadata": ~bad & F.col("r.original_metadata").isNotNull()})


def read_headers(members: DataFrame) -> DataFrame:
    """members with original_metadata and read_error, one of which is null. members: tar_path, member_index, offset, size and others, but no content.

    Where the offset is known, some kilobytes are read by seeking; members of compressed archives are read through.
    """
    schema = T.StructType([*members.schema.fields, T.StructField("original_metadata", METADATA), T.StructField("read_error", T.StringType())])
    meta_type = to_arrow_schema(schema).field("original_metadata").type

    def run(batches):
        for batch in batches:
            metas, errors = [], []
            for r in batch.to_pylist():
                meta = error = None
                try:
                    if r["offset"] is None:
                        data = read_member(r)
                        meta = metadata(Counted(io.BytesIO(data), 0, len(data)), len(data))
                    else:
                        with open_stream(r["tar_path"]) as raw:
                            meta = metadata(Counted(raw, r["offset"], r["size"]), r["size"])
                except Exception as e:  # noqa: BLE001
                    error = str(e) or type(e).__name__
                metas.append(meta)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(metas, meta_type), pa.array(errors, pa.string())], [*batch.schema.names, "original_metadata", "read_error"])

    return members.mapInArrow(run, schema)


def _new_line(record: Column, meta: Column, tar: Column, member: Column, error: Column) -> Column:
    """A line of a record with its metadata, in the order of the schema; or of an error."""
    wrong = F.to_json(F.struct(tar.alias("tar_file"), member.alias("audio_file"), error.alias("error")))
    fields = [F.coalesce(record["tar_file"], tar).alias("tar_file"), *[record[c].alias(c) for c in ("audio_file", "num_samples", "sample_rate")], meta.alias("original_metadata"), record["tokens"].alias("tokens"), record["token_shape"].alias("token_shape")]
    return F.when(error.isNotNull(), wrong).otherwise(F.to_json(F.struct(*fields)))


def staged(spark: SparkSession, files: list[str] | DataFrame, tar_folder: str, extensions: list[str] = (".wav",), range_bytes: int = 64 << 20) -> tuple[DataFrame, DataFrame]:
    """(the manifest of new files, not yet in place; one report row a file: path, status, rows, updated, reason). See backfill()."""
    given = files.select("path") if isinstance(files, DataFrame) else spark.createDataFrame([(f,) for f in files], "path string")
    pairs = stored(paired(given, list_files(spark, tar_folder, "*.tar")), "pairs")  # one row a file
    found = pairs.where("tar_path IS NOT NULL").select("path", "tar_path")
    lines = parsed_lines(index_lines(spark, found, range_bytes=range_bytes))
    members = split_members(spark, found.select(F.col("tar_path").alias("path")), extensions, range_bytes).drop("content")
    members = stored(members.join(found, "tar_path"), "members")
    thin = lines.select("path", "line_number", F.col("r.audio_file").alias("audio_file"), "is_bad", "has_error", "has_metadata")
    actions = stored(row_actions(thin, members, "path"), "actions")
    tallies = stored(file_tallies(actions, "path"), "tallies")

    changed = tallies.where("commit AND updated > 0").select("path")
    work = actions.join(changed, "path", "left_semi")
    asked = work.where("action = 'read'").select("path", "line_number", "member_index").join(members.select("path", F.col("member_index").cast("bigint").alias("member_index"), "tar_path", "offset", "size"), ["path", "member_index"])
    read = stored(read_headers(asked.repartition(F.col("path"), F.col("line_number"))).select("path", "line_number", "original_metadata", "read_error"), "headers")
    plan = work.select("path", "line_number", "action", F.col("audio_file").alias("member")).join(read, ["path", "line_number"], "left").join(found, "path")
    error = F.when(F.col("action") == "replace", "the line could not be read as JSON").otherwise(F.col("read_error"))
    line = F.when(F.col("action") == "keep", F.col("line")).otherwise(_new_line(F.col("r"), F.col("original_metadata"), F.col("tar_path"), F.col("member"), error))
    new = lines.select("path", "line_number", "line", "r").join(plan, ["path", "line_number"]).select("path", "line_number", line.alias("line"))
    manifest = stage_files(new, "line_number")

    status = F.when(F.col("ambiguous"), "ambiguous").when(F.col("tar_path").isNull(), "no_archive").when(F.col("commit").isNull(), "empty").when(F.col("commit"), "updated").otherwise("mismatch")
    none = F.lit(0).cast("bigint")
    report = pairs.join(tallies, "path", "left").select("path", status.alias("status"), F.coalesce("rows", none).alias("rows"), F.coalesce("updated", none).alias("updated"), "reason")
    return manifest, report


def backfill(spark: SparkSession, files: list[str] | DataFrame, tar_folder: str, extensions: list[str] = (".wav",), dry_run: bool = False, **options) -> DataFrame:
    """Give the records of JSON-line files the metadata that their archives' headers have; returns path, status, rows, updated and reason.

    Status: updated (fits its archive; updated tells how many lines were changed, and a file of which none was is not written), mismatch,
    no_archive, ambiguous (several archives of its stem) or empty (neither lines nor members). Rules of a line: see row_actions(); a
    member whose header cannot be read makes its line an error record. Lines that stay are written byte for byte, blank lines are left out.
    New files are staged beside the old ones and renamed over them, one atomic step a file; dry_run stages, and puts nothing in place.
    """
    manifest, report = staged(spark, files, tar_folder, extensions, **options)
    report = stored(report, "report")
    if not dry_run:
        put_in_place(manifest)
    return report
