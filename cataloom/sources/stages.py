"""Stage tables (Parquet), progress that can be resumed, JSON records."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_stage(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a stage table; a declared schema saves reading footers to infer one."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_stage(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None
) -> DataFrame:
    """Write a stage table and return it read back.

    Later actions on the result scan the written files; they do not run ``df`` again.
    """
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return read_stage(df.sparkSession, path, None if partition_by else df.schema)


def append_progress(df: DataFrame, path: str, batch_id: str) -> None:
    """Add results below ``path`` in a folder of their own; nothing that is there is touched."""
    df.write.parquet(f"{path}/batch={batch_id}-{uuid.uuid4().hex}")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)


def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows of ``todo`` whose key has no finished result yet."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def resume_progress(todo: DataFrame, path: str, key: str, work, batch_id: str) -> DataFrame:
    """Run ``work`` on the rows not finished below ``path``, save them, return all results.

    Each run writes a folder of its own, so a batch id may come again, also after a run that broke:
    what that run did not finish writing is not read.  A run with nothing left to do writes nothing.
    """
    spark = todo.sparkSession
    try:
        rest = pending(todo, read_progress(spark, path), key)
    except AnalysisException as missing:  # nothing saved yet
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        append_progress(work(todo), path, batch_id)
        return read_progress(spark, path)
    if not rest.isEmpty():
        append_progress(work(rest), path, batch_id)
    return read_progress(spark, path)


def write_records_json(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """One JSON object per record, nulls kept as ``null``."""
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_records_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
