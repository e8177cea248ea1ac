"""Fixed table schemas.  Every field is nullable; failures are rows, not exceptions."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType(), True) for name in names]


RECORD_COLUMNS = ["dataset_id", "title", "source", "sample_csv"]

PREPARED_COLUMNS = RECORD_COLUMNS + ["original_description", "download_url", "landing_page_url"]

PORTAL_METADATA = T.StructType(
    _strings(
        "dataset_id",
        "source",
        "title",
        "original_description",
        "keywords_json",
        "column_names_json",
        "column_types_raw_json",
        "download_url",
        "landing_page_url",
    )
    + [T.StructField("record_count_estimate", T.LongType(), True)]
    + _strings("last_updated", "license", "sample_rows_json", "raw_metadata_json")
)

SOCRATA_CATALOG = T.StructType(
    _strings(
        "dataset_id",
        "title",
        "source",
        "description",
        "permalink",
        "type",
        "created_at",
        "updated_at",
    )
    + [
        T.StructField("page_views_total", T.LongType(), True),
        T.StructField("download_count", T.LongType(), True),
    ]
    + _strings("tags_json", "domain")
)

SAMPLES = T.StructType(
    _strings(
        "dataset_id",
        "source",
        "title",
        "original_description",
        "download_url",
        "landing_page_url",
        "sample_csv",
        "sample_fetch_status",
        "error_message",
    )
)

DESCRIPTIONS = T.StructType(
    _strings(
        "dataset_id",
        "source",
        "title",
        "original_description",
        "download_url",
        "landing_page_url",
        "sample_csv",
        "generated_description",
        "generation_status",
        "error_message",
    )
)

DESCRIPTIONS_FULL = T.StructType(
    _strings(
        "dataset_id",
        "source",
        "title",
        "original_description",
        "download_url",
        "landing_page_url",
        "sample_csv",
        "dataset_profile",
        "semantic_profile",
        "topic",
        "generated_description",
        "search_description",
        "generation_status",
        "error_message",
    )
)

ANSWERS = T.StructType(
    _strings("content")
    + [
        T.StructField("prompt_tokens", T.LongType(), True),
        T.StructField("completion_tokens", T.LongType(), True),
        T.StructField("total_tokens", T.LongType(), True),
        T.StructField("attempts", T.IntegerType(), True),
    ]
    + _strings("status", "error")
)
