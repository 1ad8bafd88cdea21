"""Status of archives against a listing of outputs, and the plan of what to run next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tar_status(manifest: DataFrame, outputs: DataFrame) -> DataFrame:
    """manifest with status: complete before partial before not_started, by stem. outputs: stem, kind (final or partial), and valid if known."""
    valid = F.col("valid") if "valid" in outputs.columns else F.lit(True)
    kinds = outputs.groupBy(F.col("stem").alias("tar_stem")).agg(
        F.bool_or(F.col("kind") == "final").alias("is_final"), F.bool_or((F.col("kind") == "final") & valid).alias("is_valid"), F.bool_or(F.col("kind") == "partial").alias("is_partial")
    )
    status = F.when(F.col("is_valid"), "complete").when(F.col("is_final"), "invalid").when(F.col("is_partial"), "partial").otherwise("not_started")
    return manifest.join(kinds, "tar_stem", "left").withColumn("status", status).drop("is_final", "is_valid", "is_partial")


def progress_summary(status: DataFrame, keys: tuple = ()) -> DataFrame:
    """Counts and percentages; those of no archives are null. Invalid archives are counted as remaining too."""
    n = lambda *s: F.count_if(F.col("status").isin(*s))
    out = status.groupBy(*keys).agg(F.count("*").alias("total"), n("complete").alias("complete"), n("partial").alias("partial"), n("invalid").alias("invalid"), n("partial", "not_started", "invalid").alias("remaining"))
    share = lambda c: F.try_divide(F.col(c) * F.lit(100.0).cast("double"), F.col("total"))
    return out.withColumns({"complete_pct": share("complete"), "remaining_pct": share("remaining")})


def remaining(status: DataFrame) -> DataFrame:
    return status.where(F.col("status") != "complete")


def resume(members: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Members without a journal row; error rows count as done. Repeated member names all stay, or all go."""
    return members.join(done.select(*keys), keys, "left_anti")


def gate(manifest: DataFrame, outputs: DataFrame, mode: str = "ask") -> DataFrame:
    """Archives to work on, given the outputs that exist by stem. mode: skip leaves out those with a final output, valid or not; force takes
    all; ask raises if there is any."""
    if mode not in ("skip", "force", "ask"):
        raise ValueError(f"no mode: {mode}")
    if mode == "force":
        return manifest
    final = outputs.where("kind = 'final'").select(F.col("stem").alias("tar_stem"))
    if mode == "ask":
        there = manifest.join(final, "tar_stem", "left_semi").limit(3).collect()
        if there:
            raise FileExistsError(f"outputs exist, as of {[r.tar_path for r in there]}: skip or force")
    return manifest.join(final, "tar_stem", "left_anti")


def write_progress(status: DataFrame, folder: str, completed: bool = False, invalid: bool = True) -> dict[str, int]:
    """Lists of archives, each a text file in manifest order: remaining.txt always, completed.txt if asked, invalid.txt if there are any.

    Returns the rows of each list. One job writes them all; lists of an earlier time are replaced in one step each. status: as of tar_status().
    """
    from ..sources.ordered import put_in_place, stage_files

    lists = {"remaining": F.col("status") != "complete"} | ({"completed": F.col("status") == "complete"} if completed else {}) | ({"invalid": F.col("status") == "invalid"} if invalid else {})
    names = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in lists.items()]), lambda n: n.isNotNull())
    rows = status.select("pos", F.col("tar_path").alias("line"), F.explode(names).alias("list"))
    made = stage_files(rows.select(F.concat(F.lit(folder.rstrip("/") + "/"), "list", F.lit(".txt")).alias("path"), "line", "pos"), "pos")
    put_in_place(made)
    sizes = {r.path.rpartition("/")[2].removesuffix(".txt"): r.n for r in made.collect()}  # three rows at most
    return {n: sizes.get(n, 0) for n in lists}


def journal_counts(lines: DataFrame, key: str, line: str) -> DataFrame:
    """Lines that are not blank in each journal."""
    from ..functions.text import is_blank

    return lines.groupBy(key).agg(F.count_if(~is_blank(F.col(line))).alias("done"))


def tallies(rows: DataFrame, keys: tuple, status: str, **names: str) -> DataFrame:
    """Rows of each status, under the names given (name=status); rows of other statuses, such as skipped ones, count nowhere."""
    return rows.groupBy(*keys).agg(*[F.count_if(F.col(status) == s).alias(n) for n, s in names.items()])


def ticks(rows: DataFrame, number: str, every: int = 100) -> DataFrame:
    """The rows at which progress is told: every so many, by a number from 0, but not the first."""
    return rows.where((F.col(number) % every == 0) & (F.col(number) > 0))


def pending_batch(manifest: DataFrame, processed: DataFrame, submitted: DataFrame, most_jobs: int, queued: int, per_task: int = 4) -> DataFrame:
    """The next archives in manifest order, neither processed (by stem) nor submitted (by path), for the jobs that are still free."""
    k = max(0, (most_jobs - queued) * per_task)
    open_ = manifest.join(processed.select("tar_stem"), "tar_stem", "left_anti").join(submitted.select("tar_path"), "tar_path", "left_anti")
    return open_.orderBy("pos").limit(k)


def failed_submissions(manifest: DataFrame, submitted: DataFrame, outputs: DataFrame) -> DataFrame:
    """Submitted paths whose final output has no bytes, or that have no output at all. outputs: stem, kind, size."""
    last = manifest.groupBy("tar_stem").agg(F.max_by("tar_path", "pos").alias("tar_path"))
    empty = outputs.where("kind = 'final' AND size = 0").select(F.col("stem").alias("tar_stem")).distinct()
    zero = last.join(empty, "tar_stem", "left_semi").join(submitted, "tar_path", "left_semi").select("tar_path")
    known = manifest.join(submitted.select("tar_path"), "tar_path", "left_semi")
    none = known.join(outputs.select(F.col("stem").alias("tar_stem")), "tar_stem", "left_anti").select("tar_path")
    return zero.union(none).distinct()


def partial_submissions(manifest: DataFrame, submitted: DataFrame, outputs: DataFrame) -> DataFrame:
    last = manifest.groupBy("tar_stem").agg(F.max_by("tar_path", "pos").alias("tar_path"))
    part = outputs.where("kind = 'partial'").select(F.col("stem").alias("tar_stem"))
    return last.join(part, "tar_stem", "left_semi").join(submitted, "tar_path", "left_semi").select("tar_path")


def output_validity(outputs: DataFrame, first: DataFrame, key: str = "stem") -> DataFrame:
    """outputs with valid: it has bytes, and its first line is a JSON object. first: key and valid, see first_line_valid(); empty files have no row there."""
    return outputs.join(first.select(key, F.col("valid").alias("first_valid")), key, "left").withColumn("valid", (F.col("size") > 0) & F.coalesce("first_valid", F.lit(False))).drop("first_valid")


def index_totals(entries: DataFrame, key: str) -> DataFrame:
    """Entries of each file, and of all files in a row without a key."""
    return entries.rollup(key).agg(F.count("*").alias("entries"), F.grouping(key).cast("int").alias("is_total"))


def first_line_valid(lines: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Whether the first line of each key is a JSON object; aggregated without sorting."""
    first = lines.groupBy(key).agg(F.min_by(value, order).alias("first"))
    return first.select(key, F.coalesce(F.expr("try_parse_json(first) IS NOT NULL"), F.lit(False)).alias("valid"))
