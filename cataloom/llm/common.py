"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Rows that a function takes at a time.  With whole texts in the rows this bounds the memory of a Python worker.
BATCH_ROWS = 500


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sliced(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows, at most ``rows`` at a time.

    Spark bounds the bytes of a batch it sends (``spark.sql.execution.arrow.maxBytesPerBatch``); what a
    function makes of its rows is bounded here, so the session's settings stay as the user has them.
    """
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: str) -> Column:
    """The text of a row; a null text is empty."""
    return F.coalesce(F.col(text), F.lit(""))


def text_key(text: Column) -> Column:
    """128 hash bits of a text.  Rows with equal texts share it, whatever their ids are.

    The constant comes first: each argument's hash seeds the next one's, so behind the text it would
    only hash the first half once more.
    """
    return F.struct(F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"))


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``; a longer text is a batch by itself."""
    waiting: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        begin = 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > limit:
                yield pa.concat_batches([*waiting, batch.slice(begin, i - begin)])
                waiting, held, begin = [], 0, i
            held += size
        waiting.append(batch.slice(begin))
    if sum(b.num_rows for b in waiting):
        yield pa.concat_batches(waiting)
