"""Schemas of the tables that the engine reads and writes."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType


def _struct(**fields) -> StructType:
    return StructType([StructField(k, v) for k, v in fields.items()])


METADATA = _struct(
    sample_rate=IntegerType(), num_channels=IntegerType(), duration_seconds_from_header=DoubleType(), begin_stream_seconds_from_header=DoubleType(),
    bit_rate=DoubleType(), codec=StringType(), stream_index=IntegerType(), sample_format=StringType(),
)
#: One row per archive member: a success has tokens, a failure has error.
RESULTS = _struct(
    tar_file=StringType(), audio_file=StringType(), num_samples=LongType(), sample_rate=IntegerType(), original_metadata=METADATA,
    tokens=ArrayType(ArrayType(IntegerType())), token_shape=ArrayType(IntegerType()), error=StringType(),
)
MEMBERS = "tar_path string, member_index int, audio_file string, offset bigint, size bigint, is_file boolean, content binary"
