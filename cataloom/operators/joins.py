"""Joins and ranks that hold when one key has a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 500_000
SALTS = 64


def fits_broadcast(
    df: DataFrame, max_bytes: int = BROADCAST_BYTES, max_rows: int = BROADCAST_ROWS
) -> bool:
    """True when ``df`` is measured to be small.

    One aggregate over ``df`` gives its rows and the bytes of its strings and nested values; a single
    row comes back.  Use it only for frames that are cheap to compute (query terms, settings).
    """
    size = F.lit(16 * len(df.columns))
    for name, kind in df.dtypes:
        if kind == "string":
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind == "binary":
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith(("array<", "map<", "struct<")):
            size = size + 2 * F.octet_length(F.to_json(F.struct(name)))
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.sum(size.cast("long")).alias("b")).first()
    return seen["n"] <= max_rows and (seen["b"] or 0) <= max_bytes


def over_cores(df: DataFrame) -> DataFrame:
    """Deal out the rows of a table that has fewer splits than the cluster has cores.

    For work that costs more than moving its rows.  A table of many files has splits enough and stays
    where it is; a file with one row group would be one task, whatever the number of cores.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def salt(*columns: str | Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    spread: str | Column,
    bound: DataFrame | None = None,
    salts: int = SALTS,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Inner join of a large frame with a frame that is usually small.

    ``bound`` is a cheaper frame that has at least the rows of ``small``; it is measured in its
    place.  Measured small: broadcast, the large side does not move.  Otherwise both sides are salted:
    rows of one key are spread over ``salts`` tasks by ``spread`` and the other side is repeated
    per salt, so that a key with a third of all rows does not land in one task.  ``max_rows`` bounds what
    is broadcast.  One salt is for keys that have few rows of the large side each.
    """
    if fits_broadcast(small if bound is None else bound, max_rows=max_rows):
        return big.join(F.broadcast(small), on)
    if salts == 1:  # merged: the size of a file tells little of the rows in it
        return big.join(small.hint("merge"), on)
    left = big.withColumn("_salt", salt(spread, salts=salts))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"]).drop("_salt")


def heavy_key_join(
    big: DataFrame,
    small: DataFrame,
    on: str,
    weight: str,
    spread: str | Column,
    share: int = 1000,
    salts: int = SALTS,
) -> DataFrame:
    """Inner join where ``small.weight`` counts the rows each key has in ``big``.

    Keys with more than ``1 / share`` of all rows are salted, the rest joins as usual.  There
    can be at most ``share`` such keys, whatever the data, so the list of them is broadcast.
    """
    total = small.agg(F.sum(weight)).scalar()
    is_heavy = F.col(weight) * share > total
    heavy = small.filter(is_heavy).select(on, F.lit(True).alias("_heavy"))
    left = big.join(F.broadcast(heavy), on, "left").withColumn(
        "_salt", F.when(F.col("_heavy"), salt(spread, salts=salts)).otherwise(F.lit(0))
    )
    copies = F.when(is_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = small.withColumn("_salt", F.explode(copies)).hint("merge")  # a file says little of the rows in it
    return left.drop("_heavy").join(right, [on, "_salt"]).drop("_salt")


def hashed_order(key: str | Column, seed: int) -> Column:
    """A repeatable pseudo-random order of the values of ``key``."""
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}|"), column.cast("string")))


def hashed_position(
    df: DataFrame, group: str, key: str, seed: int = 0, digits: int = 3
) -> DataFrame:
    """Add ``pos``, the 0-based place of each row in its group in hashed order.

    Rows are ranked inside ``16 ** digits`` hash buckets per group and shifted by the counts of
    the buckets before, so no task sorts a whole group.
    """
    hashed = df.withColumn("_h", hashed_order(key, seed)).withColumn(
        "_bucket", F.substring("_h", 1, digits)
    )
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        hashed.groupBy(group, "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(group, "_bucket").orderBy("_h", key)
    ranked = hashed.withColumn("_rank", F.row_number().over(inside) - 1)
    return (
        ranked.join(offsets, [group, "_bucket"])
        .withColumn("pos", F.col("_offset") + F.col("_rank"))
        .drop("_h", "_bucket", "_rank", "_offset")
    )


def top_ranked(df: DataFrame, by: list[str], order: list[Column], k: int, name: str) -> DataFrame:
    """The first ``k`` rows per key with their rank.

    ``row_number() <= k`` lets Spark keep ``k`` rows per key in every task before the shuffle.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)
