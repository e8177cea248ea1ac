"""Validation, projection and row filters between the stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import has_text, has_visible_text
from .joins import top_ranked


def require_columns(df: DataFrame, required: list[str] = schemas.RECORD_COLUMNS) -> DataFrame:
    """Raise ``ValueError`` naming the missing columns; runs no job."""
    missing = [name for name in required if name not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def prepare_records(df: DataFrame, max_records: int | None = None) -> DataFrame:
    """The four record columns as strings, nulls as ``""``, rows with a sample only."""
    require_columns(df)

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)

    out = df.select(
        F.col("dataset_id").cast("string").alias("dataset_id"),
        text("title"),
        text("source"),
        text("sample_csv"),
    ).filter(F.trim("sample_csv") != "")
    return out if max_records is None else limit_records(out, max_records, ["dataset_id"])


def prepare_open_data_records(df: DataFrame) -> DataFrame:
    """Successful samples with text, seven columns as strings, nulls kept."""
    return df.filter(
        (F.col("sample_fetch_status") == "success") & has_text(F.col("sample_csv"))
    ).select(*[F.col(c).cast("string").alias(c) for c in schemas.PREPARED_COLUMNS])


def align_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order; missing ones null, NaN as null, cast to its types."""
    kinds = dict(df.dtypes)

    def column(field: T.StructField) -> Column:
        if field.name not in kinds:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(field.name)
        if kinds[field.name] in ("double", "float"):
            value = F.when(~F.isnan(value), value)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in schema.fields])


def limit_records(
    df: DataFrame, max_records: int, order: list[str], per: str | None = None
) -> DataFrame:
    """First records in an explicit order, of the whole table or of every ``per`` value."""
    if per is None:
        return df.orderBy(*order).limit(max_records)
    ranked = top_ranked(df, [per], [F.col(c) for c in order], max_records, "_rank")
    return ranked.drop("_rank")


def comparable_pairs(df: DataFrame, min_original_length: int | None = None) -> DataFrame:
    """Successful rows with both texts and a visible original; optionally a longer original."""
    original = F.col("original_description")
    keep = (
        (F.col("generation_status") == "success")
        & F.col("generated_description").isNotNull()
        & has_visible_text(original)
    )
    if min_original_length is not None:
        keep = keep & (F.length(original) > min_original_length)
    return df.filter(keep)


def successes(df: DataFrame) -> DataFrame:
    return df.filter(F.col("generation_status") == "success")


def split_success(df: DataFrame) -> DataFrame:
    """One row: successes and the rest."""
    good = F.count_if(F.col("generation_status") == "success")
    return df.agg(
        good.alias("successes"), (F.count(F.lit(1)) - good).alias("failures")
    )
