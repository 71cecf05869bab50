"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: A-Z only: other letters keep their case, so byte lengths never change.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Spark drops the shuffle files of a finished query.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Later steps read these files, so a lost executor repeats no earlier step. No one needs the shuffle
    files of the write any longer then: Spark drops them at its end, not at some collection of the driver.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text):
    return F.translate(text, UPPER, UPPER.lower())


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b or b"" for b in column.cast(kind).to_pylist()]


def strings(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cut record batches into short ones, which bounds what a task holds at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def id_type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file, which is installed with the executors' Python."""
    import public_tokenizers
    return public_tokenizers.path(name)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, rows: int = 2048,
                size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a slice has few rows and few bytes in ``column``.

    A text above ``size`` bytes is a slice of its own.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, done + size, side="right"))
            stop = max(start + 1, min(stop, start + rows))
            yield batch.slice(start, stop - start)
            start = stop
