"""Table functions for SQL: archives, line files and fragments by LATERAL, results of members by TABLE ... PARTITION BY."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


def _struct(**fields) -> StructType:
    out = StructType()
    for name, kind in fields.items():
        out.add(name, kind)
    return out


def _text(given: AnalyzeArgument | None, what: str, default: str | None = None) -> str | None:
    if given is None:
        if default is None:
            raise ValueError(f"{what} is missing")
        return default
    if not isinstance(given.dataType, StringType):
        raise ValueError(f"{what} must be a string")
    return given.value


class TarMembers:
    """tar_members(path, extensions): member_index, audio_file, offset, size, is_file of an archive, headers only. extensions: '.wav,.mp3', or ''."""

    @staticmethod
    def analyze(path: AnalyzeArgument, extensions: AnalyzeArgument | None = None) -> AnalyzeResult:
        _text(path, "path")
        _text(extensions, "extensions", "")
        return AnalyzeResult(_struct(member_index=IntegerType(), audio_file=StringType(), offset=LongType(), size=LongType(), is_file=BooleanType()))

    def eval(self, path, extensions=""):
        import tarfile

        from .sources.tar import open_stream

        if path is None:
            return
        ends = tuple(e for e in (extensions or "").split(",") if e)
        with open_stream(path) as raw, tarfile.open(fileobj=raw, mode="r") as tar:
            seekable = tar.fileobj is raw
            for i, m in enumerate(tar):
                tar.members = []
                if not ends or (m.isfile() and m.name.lower().endswith(ends)):
                    yield i, m.name, m.offset_data if seekable else None, m.size, m.isfile()


class FileLines:
    """file_lines(path): line_number, start_offset, end_offset, line of a text file; blank lines are numbered, and left out."""

    @staticmethod
    def analyze(path: AnalyzeArgument) -> AnalyzeResult:
        _text(path, "path")
        return AnalyzeResult(_struct(line_number=LongType(), start_offset=LongType(), end_offset=LongType(), line=StringType()))

    def eval(self, path):
        from .sources.lines import lines_between
        from .sources.tar import open_stream

        if path is None:
            return
        with open_stream(path) as raw:
            for i, (a, b, line) in enumerate(lines_between(raw, 0, raw.size())):
                text = line.decode("utf-8", "replace")
                if text.strip():
                    yield i + 1, a, b, text


class Fragments:
    """fragments(samples, per_token, most, overlap): fragment, begin, end in samples, kept_begin, kept_end in tokens."""

    @staticmethod
    def analyze(samples: AnalyzeArgument, per_token: AnalyzeArgument, most: AnalyzeArgument, overlap: AnalyzeArgument) -> AnalyzeResult:
        if most.isConstantExpression and overlap.isConstantExpression and (overlap.value < 0 or most.value <= 2 * overlap.value):
            raise ValueError("most must exceed twice the overlap")
        return AnalyzeResult(_struct(fragment=LongType(), begin=LongType(), end=LongType(), kept_begin=LongType(), kept_end=LongType()))

    def eval(self, samples, per_token, most, overlap):
        if samples is None:
            return
        step, size = most - 2 * overlap, most * per_token
        n = 1 if samples <= size else -(-(samples - size) // (step * per_token)) + 1
        for k in range(n):
            begin = k * step * per_token
            yield k, begin, min(begin + size, samples), k * step + (overlap if k else 0), -(-samples // per_token) if k == n - 1 else k * step + most - overlap


class Tokenized:
    """tokenized(TABLE(members)): the result records of members (tar_path, member_index, audio_file, offset, size), each archive in its order by one task."""

    @staticmethod
    def analyze(members: AnalyzeArgument) -> AnalyzeResult:
        if not members.isTable:
            raise ValueError("members must be a table")
        lacking = {"tar_path", "member_index", "audio_file", "offset", "size"} - set(members.dataType.fieldNames())
        if lacking:
            raise ValueError(f"members lack {sorted(lacking)}")
        out = _struct(tar_file=StringType(), audio_file=StringType(), num_samples=LongType(), sample_rate=IntegerType(), tokens=ArrayType(ArrayType(IntegerType())), token_shape=ArrayType(IntegerType()), error=StringType())
        return AnalyzeResult(out, partitionBy=[PartitioningColumn("tar_path")], orderBy=[OrderingColumn("member_index")])

    def __init__(self):
        self.work = None

    def eval(self, row):
        from .plans.audio import encoder

        self.work = self.work or encoder()()
        r = self.work({c: row[c] for c in ("tar_path", "member_index", "audio_file", "offset", "size")})
        yield tuple(r.get(c) for c in ("tar_file", "audio_file", "num_samples", "sample_rate", "tokens", "token_shape", "error"))


FUNCTIONS = {"tar_members": TarMembers, "file_lines": FileLines, "fragments": Fragments, "tokenized": Tokenized}


def register(spark: SparkSession) -> None:
    """Make the table functions known to a session's SQL."""
    from pyspark.sql.functions import udtf

    for name, of in FUNCTIONS.items():
        spark.udtf.register(name, udtf(of))
