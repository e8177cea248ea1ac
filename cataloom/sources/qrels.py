"""Relevance judgements from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_qrels(spark: SparkSession, path: str) -> DataFrame:
    """Flat judgements ``(position, document, topic, score)``.

    Four comma fields after one header line, no quoting; the document is the second segment of
    its path.  ``position`` keeps the order of the files by path and of the lines in each.
    """
    lines = spark.read.option("header", True).option("quote", "").schema(
        "topic string, relevance string, document string, rest string"
    ).csv(path)
    return lines.select(
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("position"),
        F.coalesce(F.try_element_at(F.split("document", "/"), F.lit(2)), F.lit("")).alias(
            "document"
        ),
        "topic",
        F.col("relevance").cast("double").alias("score"),
    )


def nested_qrels(qrels: DataFrame) -> DataFrame:
    """The nesting topic -> document -> scores as one row per (topic, document).

    The list itself stays in the flat table, ordered by ``position``; here are its length and
    its reductions, which need no task to hold a whole list.
    """
    return qrels.groupBy("topic", "document").agg(
        F.count("score").alias("n_scores"),
        F.min_by("score", "position").alias("first_score"),
        F.max_by("score", "position").alias("last_score"),
        F.max("score").alias("best_score"),
        F.sum("score").alias("sum_score"),
    )


def score_lists(qrels: DataFrame, block: int = 1000) -> DataFrame:
    """The lists themselves: topic -> document -> scores in file order, in blocks of ``block``.

    One row ``(topic, document, block_no, scores)`` has the scores at the places ``block_no * block`` and
    following; a list of any length is its blocks in order, and an empty score is null in
    its place.  A pair with a third of all lines is numbered inside each split of the files and over the
    counts of its splits, so no task holds more of it than one split.
    """
    if block < 1:
        raise ValueError("block must be at least 1")
    rows = qrels.select(
        F.struct("topic", "document").alias("pair"),  # a struct, so that a null topic meets itself
        F.col("position.file").alias("file"),
        F.col("position.start").alias("start"),
        F.col("position.line").alias("line"),
        "score",
    )
    split = ["pair", "file", "start"]
    earlier = Window.partitionBy("pair").orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy(*split).agg(F.count(F.lit(1)).alias("n")).select(
        *split, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    inside = F.row_number().over(Window.partitionBy(*split).orderBy("line")) - 1
    placed = rows.withColumn("inside", inside).join(before, split).withColumn("place", F.col("before") + F.col("inside"))
    blocks = placed.groupBy("pair", F.floor(F.col("place") / block).alias("block_no")).agg(
        F.array_sort(F.collect_list(F.struct("place", "score"))).alias("scores")
    )
    return blocks.select("pair.topic", "pair.document", "block_no", F.col("scores.score").alias("scores"))
