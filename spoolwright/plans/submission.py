"""Submission state and the loop that plans, runs and repairs until nothing is left. Spark schedules; a submit function stands for a queue."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.progress import failed_submissions, partial_submissions, pending_batch
from ..sources.files import _store
from ..sources.scratch import stored

STATE = "tar_path string"


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Submitted paths; none where there is no state, or none that can be read."""
    store, p = _store(spark, path)
    if not store.exists(p):
        return spark.createDataFrame([], STATE)
    lists = spark.read.schema("submitted array<string>").json(path)
    return lists.select(F.explode("submitted").alias("tar_path")).distinct()


def write_state(submitted: DataFrame, path: str) -> None:
    """Replace the state by other paths, a list of one for each; written by the executors, by way of a stored table, as what is replaced is read."""
    kept = stored(submitted.select("tar_path").distinct(), "state")
    kept.select(F.array("tar_path").alias("submitted")).write.mode("overwrite").json(path)


def add_to_state(submitted: DataFrame, path: str) -> None:
    """Append paths to the state; what is there is not read."""
    submitted.select(F.array("tar_path").alias("submitted")).write.mode("append").json(path)


def repair(manifest: DataFrame, outputs: DataFrame, state: str, partial: bool = False, confirm: bool = False, dry_run: bool = False) -> list[str]:
    """Take failed submissions (or those with a journal only) out of the state, so that they are submitted again; returns their paths.

    Changes nothing without confirm. A dry run of a repair is refused, as of everything that changes the state on confirmation.
    """
    if dry_run and confirm:
        raise ValueError("a repair can be confirmed or tried, not both")
    again, left = repaired(manifest, read_state(manifest.sparkSession, state), outputs, partial)
    paths = sorted(r.tar_path for r in again.collect())
    if confirm and paths:
        write_state(left, state)
    return paths


def without(submitted: DataFrame, gone: DataFrame) -> DataFrame:
    """Submitted paths less others, as a set."""
    return submitted.select("tar_path").subtract(gone.select("tar_path"))


def repaired(manifest: DataFrame, submitted: DataFrame, outputs: DataFrame, partial: bool = False) -> tuple[DataFrame, DataFrame]:
    """(paths to run again, the state without them): failed submissions, or those that have a journal only."""
    again = (partial_submissions if partial else failed_submissions)(manifest, submitted, outputs)
    return again, without(submitted, again)


def skip_first(manifest: DataFrame, n: int) -> DataFrame:
    """The manifest without its first n rows; n must be below its length."""
    rows = manifest.count()
    if n < 0 or (n and n >= rows):
        raise ValueError(f"cannot skip {n} of {rows} archives")
    first = manifest.orderBy("pos").limit(n)
    return manifest.join(first.select("pos"), "pos", "left_anti")


def step(manifest: DataFrame, outputs: DataFrame, state: str, submit: Callable[[list[str]], None], most_jobs: int = 62, queued: int = 0, per_task: int = 4, dry_run: bool = False) -> list[str]:
    """Submit what fits the free jobs, in manifest order, and add it to the state; dry_run only says what that would be."""
    spark = manifest.sparkSession
    submitted = read_state(spark, state)
    done = outputs.where("kind = 'final'").select(F.col("stem").alias("tar_stem"))
    batch = pending_batch(manifest, done, submitted, most_jobs, queued, per_task)
    paths = [r.tar_path for r in batch.orderBy("pos").collect()]  # at most most_jobs * per_task rows
    if paths and not dry_run:
        submit(paths)
        add_to_state(spark.createDataFrame([(p,) for p in paths], STATE), state)
    return paths


def watch(manifest: DataFrame, outputs: Callable[[], DataFrame], queued: Callable[[], int], state: str, submit: Callable[[list[str]], None], most_jobs: int = 62, per_task: int = 4, interval: float = 60.0, once: bool = False, dry_run: bool = False, rounds: int | None = None, sleep=time.sleep) -> list[list[str]]:
    """Round after round: see outputs and the queue, submit what fits, remember it, wait. Ends when nothing is left to submit; returns what each round submitted.

    A queue that cannot be asked (queued() raises or is negative) costs the round, and the next one tries again. once: one round only, whatever
    comes of it. The caller's functions tell of the world outside; what is to be done is the same query each time.
    """
    told: list[list[str]] = []
    while rounds is None or len(told) < rounds:
        try:
            jobs = queued()
        except OSError:
            jobs = -1
        batch = step(manifest, outputs(), state, submit, most_jobs, jobs, per_task, dry_run) if jobs >= 0 else []
        told.append(batch)
        if once or dry_run:
            break
        if jobs >= 0 and not batch and jobs < most_jobs:  # room, and nothing to fill it
            break
        sleep(interval)
    return told


def until_done(remaining: Callable[[], int], run: Callable[[], None], most: int = 100, interval: float = 0.0) -> int:
    """Run until nothing remains, at most so many times; returns the number of runs. Raises TimeoutError if something still remains."""
    for done in range(most):
        if not remaining():
            return done
        run()
        if interval:
            time.sleep(interval)
    if remaining():
        raise TimeoutError(f"not finished after {most} runs")
    return most
