"""Row samples, CSV text and cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import csvtext
from ..functions.text import elements, has_visible_text, let, shrink_sample_csv
from .joins import hashed_order, top_ranked

# Fixed value: the seed of every sample.
SEED = 9

CSV_FAILED = "csv_parse_failed: EOF inside string"


def get_sample(
    df: DataFrame, size: int, key: list[str], by: str | None = None, seed: int = SEED
) -> DataFrame:
    """``size`` rows without replacement (all rows when there are fewer), in hashed key order.

    The draw is repeatable and independent of partitioning.  It is a different draw from the one
    a pandas generator makes with the same seed.
    """
    order = hashed_order(F.concat_ws("|", *[F.col(c).cast("string") for c in key]), seed)
    columns = [order, *[F.col(c) for c in key]]
    if by is None:
        return df.orderBy(*columns).limit(size)
    return top_ranked(df, [by], columns, size, "_rank").drop("_rank")


def sample_csv_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every row as one CSV line, with the header line alongside."""
    values = F.array(*[F.col(c).cast("string") for c in columns])
    header = csvtext.render_row(F.array(*[F.lit(c) for c in columns]))
    return df.withColumn("csv_header", header).withColumn("csv_line", csvtext.render_row(values))


def with_table(df: DataFrame, column: str = "sample_csv") -> DataFrame:
    """Add ``columns`` (``array<struct<col_no, col_name, values>>``), ``n_rows``, parse status.

    Parsing happens in the row; a text with an open quote gives null columns and a message.
    """
    visible = has_visible_text(F.col(column))
    good = visible & csvtext.is_parsable(F.col(column))
    return (
        df.withColumn("_rows", F.when(good, csvtext.rows(F.col(column))))
        .withColumn("columns", csvtext.columns(F.col("_rows")))
        .withColumn("n_rows", F.size("_rows") - 1)
        .withColumn("csv_error", F.when(visible & ~good, F.lit(CSV_FAILED)))
        .drop("_rows")
    )


def explode_sample_cells(df: DataFrame, column: str = "sample_csv") -> DataFrame:
    """Cells ``(dataset_id, row_no, col_no, col_name, value)`` of all samples, no shuffle."""
    return (
        with_table(df.select("dataset_id", column), column)
        .select("dataset_id", F.explode(elements("columns")).alias("c"))
        .select("dataset_id", "c.col_no", "c.col_name", F.posexplode("c.values").alias("row_no", "value"))
        .select("dataset_id", "row_no", "col_no", "col_name", "value")
    )


def sampled_positions(n_rows: Column, key: Column, k: int, seed: int = SEED) -> Column:
    """Sorted positions of ``k`` sampled rows of a small table held in one row.

    All positions when ``k`` reaches the number of rows.
    """
    every = F.when(n_rows > 0, F.sequence(F.lit(0), n_rows - 1)).otherwise(
        F.array().cast("array<int>")
    )
    drawn = F.slice(
        F.sort_array(
            F.transform(
                every,
                lambda i: F.struct(
                    F.md5(
                        F.concat(F.lit(f"{seed}|"), key, F.lit("|"), i.cast("string"))
                    ).alias("h"),
                    i.alias("i"),
                ),
            )
        ),
        1,
        k,
    )
    return F.sort_array(F.transform(drawn, lambda x: x["i"]))


def column_sample_values(df: DataFrame, k: int = 5, column: str = "sample_csv") -> DataFrame:
    """Add ``column_values``: per column its name and the values of the same ``k`` rows.

    A sample that is parsed already (``columns, n_rows``) is not parsed again.
    """
    parsed = df if {"columns", "n_rows"} <= set(df.columns) else with_table(df, column)
    picked = parsed.withColumn(
        "_at", sampled_positions(F.col("n_rows"), F.col("dataset_id"), k)
    )
    values = let(
        F.col("_at"),
        lambda at: F.transform(
            "columns",
            lambda c: F.struct(
                c["col_no"].alias("col_no"),
                c["col_name"].alias("col_name"),
                F.transform(
                    at, lambda i: F.coalesce(F.get(c["values"], i), F.lit(""))
                ).alias("sample_values"),
            ),
        ),
    )
    return picked.withColumn("column_values", values).drop("_at")


def fill_missing_as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as text, null as ``""``."""
    return df.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def shrink_samples(df: DataFrame, max_chars: int = 8000, max_lines: int = 8) -> DataFrame:
    """Add ``shrunk_csv``."""
    return df.withColumn("shrunk_csv", shrink_sample_csv(F.col("sample_csv"), max_chars, max_lines))
