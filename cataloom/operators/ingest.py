"""Catalogue entries (JSON text) -> fixed metadata tables.

Fields whose type differs from entry to entry (tags: list or scalar, license: object or text)
are read through ``VARIANT``; the text is parsed once per entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import jsontext
from ..functions.text import has_visible_text

# Source names and address patterns of the portal.
PORTAL_SOURCE = "nyc_open_data"
DCAT_SOURCE = "data_gov"
PORTAL_DOWNLOAD = "https://data.cityofnewyork.us/api/views/{id}/rows.csv?accessType=DOWNLOAD"
PORTAL_LANDING = "https://data.cityofnewyork.us/d/{id}"

# Sample states.
MISSING_URL = "missing_download_url"
EMPTY_SAMPLE = "empty_or_unreadable_sample"


def _get(variant: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(variant, path, kind)


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def safe_get(entry: Column, path: str, default: str | None = None) -> Column:
    """Value of a nested path of a JSON text, or the default."""
    return jsontext.path_or_default(entry, path, default)


def normalize_tags(entry: Column, path: str) -> Column:
    """Tags as text: a list as its JSON text, a scalar as its string, null stays null."""
    parsed = F.try_parse_json(entry)
    listed = _get(parsed, path, "array<string>")
    return F.when(listed.isNotNull(), jsontext.list_text(listed)).otherwise(_get(parsed, path))


def extract_keywords(category: Column, tags: Column) -> Column:
    """Category first, then tags; nulls dropped, first occurrence kept."""
    head = F.when(category != "", F.array(category)).otherwise(_no_strings())
    tail = F.array_compact(F.coalesce(tags, _no_strings()))
    return F.array_distinct(F.concat(F.coalesce(head, _no_strings()), tail))


def extract_column_names(columns: Column) -> Column:
    """Non-empty names of an ``array<struct<name, dataTypeName>>``."""
    names = F.filter(F.transform(columns, lambda c: c["name"]), lambda n: n.isNotNull() & (n != ""))
    return F.coalesce(names, _no_strings())


def extract_column_types(columns: Column) -> Column:
    """Types, ``unknown`` when missing; not filtered, so it may be longer than the names."""
    types = F.transform(columns, lambda c: F.coalesce(c["dataTypeName"], F.lit("unknown")))
    return F.coalesce(types, _no_strings())


def first_csv_link(distributions: Column) -> Column:
    """Address of the first distribution that looks like CSV (``array<variant>``)."""
    links = F.transform(
        distributions,
        lambda d: F.struct(
            jsontext.first_non_empty(_get(d, "$.accessURL"), _get(d, "$.downloadURL")).alias("url"),
            F.lower(F.coalesce(_get(d, "$.mediaType"), F.lit(""))).alias("media"),
            F.lower(F.coalesce(_get(d, "$.format"), F.lit(""))).alias("format"),
        ),
    )
    csv = F.filter(
        links,
        lambda x: x["url"].isNotNull()
        & (
            x["media"].contains("csv")
            | x["format"].contains("csv")
            | F.lower(x["url"]).endswith(".csv")
        ),
    )
    return F.get(csv, F.lit(0))["url"]


def normalize_socrata_catalog(entries: DataFrame, column: str = "entry_json") -> DataFrame:
    """Nested catalogue entries -> 12 flat fields."""
    v = F.col("_entry")
    return entries.withColumn("_entry", F.try_parse_json(column)).select(
        _get(v, "$.resource.id").alias("dataset_id"),
        _get(v, "$.resource.name").alias("title"),
        F.lit(PORTAL_SOURCE).alias("source"),
        _get(v, "$.resource.description").alias("description"),
        _get(v, "$.resource.permalink").alias("permalink"),
        _get(v, "$.resource.type").alias("type"),
        _get(v, "$.resource.createdAt").alias("created_at"),
        _get(v, "$.resource.updatedAt").alias("updated_at"),
        _get(v, "$.metadata.page_views.page_views_total", "bigint").alias("page_views_total"),
        _get(v, "$.metadata.downloads", "bigint").alias("download_count"),
        normalize_tags(F.col(column), "$.classification.tags").alias("tags_json"),
        _get(v, "$.metadata.domain").alias("domain"),
    )


def normalize_portal_view(
    summaries: DataFrame, details: DataFrame, column: str = "entry_json"
) -> DataFrame:
    """Join summary and detail entries by id -> 14-field metadata rows.

    Entries without id are dropped; a summary without detail gives empty column lists.
    """
    v, d = F.col("_entry"), F.col("_detail")
    left = (
        summaries.select(F.col(column).alias("_summary_json"))
        .withColumn("_entry", F.try_parse_json("_summary_json"))
        .select("_summary_json", "_entry", _get(F.col("_entry"), "$.id").alias("dataset_id"))
        .filter(F.coalesce(F.col("dataset_id"), F.lit("")) != "")
        .select(
            "dataset_id",
            "_summary_json",
            _get(v, "$.name").alias("title"),
            _get(v, "$.description").alias("original_description"),
            jsontext.list_text(
                extract_keywords(_get(v, "$.category"), _get(v, "$.tags", "array<string>"))
            ).alias("keywords_json"),
            _get(v, "$.rowsUpdatedAt").alias("last_updated"),
        )
    )
    kinds = "array<struct<name:string,dataTypeName:string>>"
    right = (
        details.select(F.col(column).alias("_detail_json"))
        .withColumn("_detail", F.try_parse_json("_detail_json"))
        .select(
            _get(d, "$.id").alias("dataset_id"),
            "_detail_json",
            F.from_json(F.to_json(_get(d, "$.columns", "variant")), kinds).alias("_columns"),
            _get(d, "$.license.name").alias("license"),
        )
    )

    def address(pattern: str) -> Column:
        before, after = pattern.split("{id}")
        return F.concat(F.lit(before), F.col("dataset_id"), F.lit(after))

    raw = F.concat(
        F.lit('{"summary_entry": '),
        F.col("_summary_json"),
        F.lit(', "detail_entry": '),
        F.coalesce(F.col("_detail_json"), F.lit("{}")),
        F.lit("}"),
    )
    joined = left.join(right, "dataset_id", "left")
    return joined.select(
        "dataset_id",
        F.lit(PORTAL_SOURCE).alias("source"),
        "title",
        "original_description",
        "keywords_json",
        jsontext.list_text(extract_column_names(F.col("_columns"))).alias("column_names_json"),
        jsontext.list_text(extract_column_types(F.col("_columns"))).alias("column_types_raw_json"),
        address(PORTAL_DOWNLOAD).alias("download_url"),
        address(PORTAL_LANDING).alias("landing_page_url"),
        F.lit(None).cast("long").alias("record_count_estimate"),
        "last_updated",
        "license",
        F.lit(None).cast("string").alias("sample_rows_json"),
        raw.alias("raw_metadata_json"),
    )


def normalize_dcat_entry(entries: DataFrame, column: str = "entry_json") -> DataFrame:
    """Top-level or nested ``dcat`` fields, first non-empty wins -> 14-field metadata rows."""
    v = F.col("_entry")

    def either(field: str) -> Column:
        return jsontext.first_non_empty(_get(v, f"$.{field}"), _get(v, f"$.dcat.{field}"))

    own, nested = (_get(v, f"$.{p}keyword", "array<string>") for p in ("", "dcat."))
    own_text = _get(v, "$.keyword")
    own_counts = F.when(own.isNotNull(), F.size(own) > 0).otherwise(
        F.coalesce(own_text != "", F.lit(False))
    )
    tags = F.coalesce(F.when(own_counts, own).otherwise(nested), _no_strings())
    return entries.withColumn("_entry", F.try_parse_json(column)).select(
        either("identifier").alias("dataset_id"),
        F.lit(DCAT_SOURCE).alias("source"),
        either("title").alias("title"),
        either("description").alias("original_description"),
        jsontext.list_text(tags).alias("keywords_json"),
        F.lit("[]").alias("column_names_json"),
        F.lit("[]").alias("column_types_raw_json"),
        first_csv_link(_get(v, "$.dcat.distribution", "array<variant>")).alias("download_url"),
        _get(v, "$.dcat.landingPage").alias("landing_page_url"),
        F.lit(None).cast("long").alias("record_count_estimate"),
        _get(v, "$.dcat.modified").alias("last_updated"),
        _get(v, "$.dcat.license").alias("license"),
        F.lit(None).cast("string").alias("sample_rows_json"),
        F.col(column).alias("raw_metadata_json"),
    )


def union_sources(*catalogues: DataFrame, required: bool = False) -> DataFrame:
    """Rows of all catalogues, duplicates kept; an error when rows are ``required`` and none has any."""
    if not catalogues:
        raise ValueError("no catalogue given")
    first, *rest = catalogues
    for other in rest:
        first = first.unionByName(other)
    return require_rows(first) if required else first


def require_rows(df: DataFrame, message: str = "no metadata rows in any source") -> DataFrame:
    """Raise when the frame is empty; looks at one row only."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def tag_sample_status(metadata: DataFrame, samples: DataFrame) -> DataFrame:
    """Every row of metadata with its sample: ``success`` when it has visible text, else ``error``
    with the reason.

    Samples ``(source, dataset_id, sample_csv[, error_message])`` belong to one dataset; samples
    that name only a ``download_url`` serve every dataset of that address.  Either way a key gets one
    sample, the first of those that succeeded, so no row is multiplied.  Rows without an address
    cannot match; their join key is spread so that they do not fill one task.
    """
    has_url = has_visible_text(F.col("download_url"))
    error = (F.col("error_message") if "error_message" in samples.columns else F.lit(None)).cast("string")
    sample = F.struct(
        F.when(has_visible_text(F.col("sample_csv")) & error.isNull(), 0).otherwise(1).alias("rank"),
        F.col("sample_csv").alias("text"),
        error.alias("error"),
    )
    own = {"source", "dataset_id"} <= set(samples.columns)
    named = F.to_json(F.struct("source", "dataset_id")) if own else F.col("download_url")
    found = (
        samples.select(named.alias("_key"), sample.alias("_s"))
        .groupBy("_key")
        .agg(F.min("_s").alias("_s"))
        .select("_key", F.col("_s.text").alias("_sample"), F.col("_s.error").alias("_error"))
    )
    key = F.when(has_url, named).otherwise(
        F.concat(F.lit("\x00"), F.xxhash64("dataset_id", "title").cast("string"))
    )
    # Samples are texts, as many as datasets: they are merged, not sent to every task.
    joined = metadata.withColumn("_key", key).join(found.hint("merge"), "_key", "left")
    ok = has_visible_text(F.col("_sample")) & F.col("_error").isNull()
    reason = F.when(~has_url, F.lit(MISSING_URL)).otherwise(
        F.coalesce(F.col("_error"), F.lit(EMPTY_SAMPLE))
    )
    out = joined.select(
        *[c for c in metadata.columns if c not in ("sample_csv", "error_message")],
        F.col("_sample").alias("sample_csv"),
        F.when(ok, "success").otherwise("error").alias("sample_fetch_status"),
        F.when(~ok, reason).alias("error_message"),
    )
    from .prepare import align_schema

    return align_schema(out, schemas.SAMPLES)
