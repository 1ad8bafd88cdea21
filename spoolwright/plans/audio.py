"""Whole flows: tokenize archives or one file, resume, decode to files, list. Errors are rows, not failures."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..codec import ResidualCodec, decode_piecewise, encode_piecewise, read_audio, write_wave
from ..functions.text import stem
from ..operators.progress import resume
from ..schemas import RESULTS
from ..sources.files import drop_folder, exists
from ..sources.journal import append, read_journal
from ..sources.records import read_results, write_results
from ..sources.scratch import stored
from ..sources.tar import read_member
from ..sources.tar_ranges import split_members


#: Names of output files are broadcast up to so many; tokens are shuffled beyond.
BROADCAST_NAMES = 200_000


def record_of(row: dict, content: bytes, codec, most: int = 25_000, overlap: int = 250, decoders: dict | None = None) -> dict:
    """The result record of a member; one that fails gets its error. decoders: see codec.read_audio()."""
    out = {"tar_file": row["tar_path"], "audio_file": row["audio_file"]}
    try:
        x, meta = read_audio(content, row["audio_file"], codec.sample_rate, decoders)
        t = encode_piecewise(codec, x, most, overlap)
        return out | {"num_samples": len(x), "sample_rate": codec.sample_rate, "original_metadata": meta, "tokens": t.tolist(), "token_shape": list(t.shape)}
    except Exception as e:  # noqa: BLE001
        return out | {"error": str(e) or type(e).__name__}


def encode_members(members: DataFrame, codec=ResidualCodec, most: int = 25_000, overlap: int = 250, decoders: dict | None = None, profile=None) -> DataFrame:
    """Result records of members with content. codec: makes the codec, once a task. A member that fails gets a record with its error."""
    schema = to_arrow_schema(RESULTS)

    def run(batches):
        c = codec()
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([record_of(r, r["content"], c, most, overlap, decoders)], schema=schema)

    return members.select("tar_path", "audio_file", "content").mapInArrow(run, RESULTS, profile=profile)


def encoder(codec=ResidualCodec, most: int = 25_000, overlap: int = 250, decoders: dict | None = None):
    """What the journal calls once a task: members are fetched, encoded and told in one place, so payloads stay in their worker."""

    def work():
        c = codec()

        def one(row: dict) -> dict:
            try:
                content = read_member(row)
            except Exception as e:  # noqa: BLE001
                return {"tar_file": row["tar_path"], "audio_file": row["audio_file"], "error": str(e) or type(e).__name__}
            return record_of(row, content, c, most, overlap, decoders)

        return one

    return work


def list_results(spark: SparkSession, out: str) -> list[str]:
    """The folders of archives below an output folder; journals and marks are none."""
    from ..sources.files import _store

    store, p = _store(spark, out)
    names = [s.getPath().getName() for s in store.listStatus(p) if s.isDirectory()] if store.exists(p) else []
    return sorted(n for n in names if n.startswith("tar_stem="))


def completed(spark: SparkSession, out: str) -> DataFrame:
    """tar_file and members of the archives that a run of tokenize() has finished; the last run's number of members."""
    marks = f"{out.rstrip('/')}/_complete"
    if not exists(spark, marks):
        return spark.createDataFrame([], "tar_file string, members bigint")
    rows = spark.read.schema("tar_file string, members bigint").json(marks).select("*", F.col("_metadata.file_modification_time").alias("at"))
    return rows.groupBy("tar_file").agg(F.max_by("members", "at").alias("members"))


def tokenize(spark: SparkSession, tars: list[str], out: str, extensions: list[str] = (".wav",), retry_errors: bool = False, codec=ResidualCodec, range_bytes: int = 64 << 20, skip_existing: bool = False, profile=None, **sizes) -> DataFrame:
    """Tokenize what out doesn't have yet, and replace the folders of the archives that changed; returns all records of out.

    Headers come first, in ranges of archives, and are anti-joined with the records there and those of the journal, so that only missing
    payloads are read. Every finished member is appended to the journal in out/_journal at once; a run that is killed, at any point, is
    carried on by the next one. When all are there, the journal's records go to their archives' folders, every archive, also one without
    members, is marked as complete with the number of its members, and the journal is removed. skip_existing: archives that are marked are
    not opened. profile: a resource profile for the tasks that encode, see plans.placement.
    """
    if skip_existing:
        marked = {r.tar_file for r in completed(spark, out).where(F.col("tar_file").isin(list(tars))).collect()} if tars else set()
        tars = [t for t in tars if t not in marked]
    log, has_out = f"{out.rstrip('/')}/_journal", bool(list_results(spark, out))
    members = split_members(spark, tars, extensions, range_bytes)
    old = read_results(spark, f"{out.rstrip('/')}/tar_stem=*") if has_out else spark.createDataFrame([], RESULTS)
    old = old.where("error IS NULL") if retry_errors else old
    logged = read_journal(spark, log)
    logged = logged.where("error IS NULL") if retry_errors else logged
    todo = resume(members, old.select(F.col("tar_file").alias("tar_path"), "audio_file"), ["tar_path", "audio_file"])
    todo = resume(todo, logged.select(F.col("tar_file").alias("tar_path"), "member_index"), ["tar_path", "member_index"])
    append(todo.repartition(F.col("tar_path"), F.col("member_index")), log, uuid.uuid4().hex, encoder(codec, **sizes), profile=profile)
    new = read_journal(spark, log).drop("member_index")
    touched = new.select("tar_file").distinct()
    whole = f"{out.rstrip('/')}.whole-{uuid.uuid4().hex}"
    old.join(new.select("tar_file", "audio_file"), ["tar_file", "audio_file"], "left_anti").join(touched, "tar_file", "left_semi").unionByName(new).write.mode("overwrite").json(whole)
    write_results(spark.read.schema(RESULTS).json(whole), out)
    seen = spark.createDataFrame([(t,) for t in tars], "tar_file string").join(members.groupBy(F.col("tar_path").alias("tar_file")).agg(F.count("*").alias("n")), "tar_file", "left")
    seen.select("tar_file", F.coalesce("n", F.lit(0)).alias("members")).join(completed(spark, out), ["tar_file", "members"], "left_anti").write.mode("append").json(f"{out.rstrip('/')}/_complete")
    for folder in (whole, log):
        drop_folder(spark, folder)
    return spark.read.schema(RESULTS).json(out)


def _decoded(r: dict, codec, block: int, context: int, tail: int) -> bytes | None:
    """The WAV file of a record; None for an error record, one without tokens, and what cannot be decoded."""
    try:
        if r["error"] is not None or not r["tokens"]:
            return None
        return write_wave(decode_piecewise(codec, r["tokens"], block, context, tail), r["sample_rate"] or codec.sample_rate)
    except Exception:  # noqa: BLE001
        return None


def _named(results: DataFrame) -> DataFrame:
    return results.select("audio_file", F.concat(stem(F.col("audio_file")), F.lit("_reconstructed.wav")).alias("output_name"), "tokens", "sample_rate", "error")


def decode(results: DataFrame, codec=ResidualCodec, block: int = 10_000, context: int = 50, tail: int = 50) -> DataFrame:
    """audio_file, output_name, status (ok or failed), wav. Error rows, and rows without tokens, fail."""

    def run(batches):
        c = codec()
        for batch in batches:
            for r in batch.to_pylist():
                wav = _decoded(r, c, block, context, tail)
                yield pa.RecordBatch.from_pydict({"audio_file": [r["audio_file"]], "output_name": [r["output_name"]], "status": ["failed" if wav is None else "ok"], "wav": pa.array([wav], pa.binary())})

    return _named(results).mapInArrow(run, "audio_file string, output_name string, status string, wav binary")


def tokenize_file(spark: SparkSession, path: str, out: str, codec=ResidualCodec, force: bool = False, **sizes) -> DataFrame:
    """The record of one clip, written as a single JSON line; an error makes a record too. What is there is kept unless force."""
    from ..sources.files import _store

    store, p = _store(spark, out)
    if store.exists(p) and not force:
        return spark.read.schema(RESULTS).json(out)
    clip = spark.read.format("binaryFile").load(path).select(F.lit(None).cast("string").alias("tar_path"), F.col("path").alias("audio_file"), "content")
    encode_members(clip, codec, **sizes).coalesce(1).write.mode("overwrite").json(out)
    return spark.read.schema(RESULTS).json(out)


def decode_to_files(results: DataFrame, folder: str, force: bool = False, codec=ResidualCodec, block: int = 10_000, context: int = 50, tail: int = 50) -> DataFrame:
    """WAV files of decoded records below a folder; returns audio_file, output_name, status: ok, failed or skipped.

    Names that exist are skipped before anything is decoded, unless force. Of records with the same stem the first by audio_file, then by
    a hash of its tokens, writes; the others are skipped, and equal records are written by each of them. Who writes is settled on names and
    hashes; tokens stay in their rows. A task decodes and writes in one step, under a name of its attempt that it then renames.
    """
    from pyspark import TaskContext

    from ..sources.files import list_files, plain

    spark, base = results.sparkSession, plain(folder).rstrip("/")
    named = _named(results).withColumn("mark", F.struct(F.coalesce("audio_file", F.lit("")), F.xxhash64("tokens", "sample_rate", "error")))
    there = list_files(spark, folder, "*_reconstructed.wav").select(F.element_at(F.split("path", "/"), -1).alias("output_name"))
    writes = named.groupBy("output_name").agg(F.min("mark").alias("writer")).join(there.withColumn("exists", F.lit(True)), "output_name", "left")
    writes = stored(writes, "writers")  # a row a name
    hint = F.broadcast if writes.count() <= BROADCAST_NAMES else (lambda df: df)
    skip = F.col("exists").isNotNull() if not force else F.lit(False)
    todo = named.join(hint(writes), "output_name").withColumn("skip", skip | (F.col("mark") != F.col("writer"))).drop("mark", "writer", "exists")

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(base if "://" in base else f"file://{base}")
        store.create_dir(root, recursive=True)
        c = codec()
        for batch in batches:
            status = []
            for r in batch.to_pylist():
                if r["skip"]:
                    status.append("skipped")
                    continue
                wav = _decoded(r, c, block, context, tail)
                if wav is not None:
                    temp = f"{root}/.{r['output_name']}-{TaskContext.get().taskAttemptId()}"
                    with store.open_output_stream(temp, compression=None) as f:
                        f.write(wav)
                    store.move(temp, f"{root}/{r['output_name']}")
                status.append("failed" if wav is None else "ok")
            yield pa.RecordBatch.from_arrays([batch.column("audio_file"), batch.column("output_name"), pa.array(status, pa.string())], ["audio_file", "output_name", "status"])

    return todo.select("audio_file", "output_name", F.when(~F.col("skip"), F.col("tokens")).alias("tokens"), "sample_rate", "error", "skip").mapInArrow(run, "audio_file string, output_name string, status string")


def list_totals(entries: DataFrame) -> DataFrame:
    """Entries, errors and total duration of what list_entries() gives."""
    return entries.agg(F.count("*").alias("entries"), F.count_if(~F.col("is_error")).alias("succeeded"), F.count_if("is_error").alias("failed"), F.sum("duration").alias("duration"))


def list_entries(results: DataFrame) -> DataFrame:
    """audio_file, num_samples, duration, num_tokens, is_error, with the defaults that old files need."""
    n = F.coalesce("num_samples", F.lit(0))
    shape = F.when(F.size("token_shape") > 0, F.element_at("token_shape", -1))
    return results.select("audio_file", n.alias("num_samples"), (n / F.coalesce("sample_rate", F.lit(24_000))).alias("duration"), F.coalesce(shape, F.lit(0)).alias("num_tokens"), F.col("error").isNotNull().alias("is_error"))
