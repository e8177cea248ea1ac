"""Landed files: catalogue pages (JSON) and dataset files (CSV).

Fetching over the network is not part of the engine.  Pages and files are landed by any copy
tool; everything from there on is Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .csv_heads import MAX_BYTES, CsvHeads


def read_catalog_pages(
    spark: SparkSession, path: str, total_limit: int | None = None
) -> DataFrame:
    """Entries of landed catalogue pages ``{"offset": n, "results": [...]}`` in page order.

    Reading stops at the first page without results; ``total_limit`` keeps the first entries.
    Each entry stays JSON text, because its fields differ from entry to entry.
    """
    pages = spark.read.schema("offset long, results array<string>").json(path)
    end = pages.filter(F.coalesce(F.size("results"), F.lit(0)) <= 0).agg(F.min("offset")).scalar()
    entries = (
        pages.filter(end.isNull() | (F.col("offset") < end))
        .select("offset", F.posexplode("results").alias("pos", "entry_json"))
        .select("offset", F.col("pos").cast("long").alias("pos"), "entry_json")
    )
    if total_limit is None:
        return entries
    return entries.orderBy("offset", "pos").limit(total_limit)


def sample_landed_csv(spark: SparkSession, path: str, max_rows: int = 5, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``(file_path, sample_csv)``: header plus the first ``max_rows`` records of each file that has one.

    Only the head of a file is read, ``max_bytes`` at most; quoted cells with line ends stay whole.  The
    header does not count as a row.
    """
    spark.dataSource.register(CsvHeads)
    heads = spark.read.format(CsvHeads.name()).option("max_rows", max_rows).option("max_bytes", max_bytes).load(path)
    return heads.filter("sample_csv is not null").select("file_path", "sample_csv")
