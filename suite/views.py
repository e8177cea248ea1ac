"""Catalogue-shaped views over the given tables, and the same views as SQL.

``samples``       one dataset per order: its CSV sample is the first 20 order lines
``descriptions``  the full run over ``samples``
``entries``       web pages packed as nested catalogue entries
``text_pairs``    a user turn and the assistant turn that follows it
``search_docs``   documents; ``search_queries``: benchmark texts
``vectors``       embeddings in sparse form
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cataloom.operators import ingest, vectors as vec
from cataloom.operators.joins import top_ranked
from cataloom.plans.describe import describe_catalog
from cataloom.session import scratch_path
from cataloom.sources.stages import read_stage, write_stage

SAMPLE_ROWS = 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_stage(spark, f"{folder}/{name}.parquet")



# --- datasets from orders -----------------------------------------------------------------

HEADER = ["line", "qty", "price", "status", "shipped", "lat", "lon"]
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(12,2)").cast("string")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The first 20 lines of every order as text columns."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey",
        *LINE_ORDER,
        F.concat_ws(",", "l_returnflag", "l_linestatus").alias("status"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
    )
    return top_ranked(
        lines, ["l_orderkey"], [F.col(c) for c in [*LINE_ORDER, "shipped", "status"]], SAMPLE_ROWS, "place"
    ).select(
        "l_orderkey",
        "place",
        F.concat_ws(
            ",",
            F.col("l_linenumber").cast("string"),
            F.col("l_quantity").cast("long").cast("string"),
            _money("l_extendedprice"),
            F.concat(F.lit('"'), F.col("status"), F.lit('"')),
            "shipped",
            (F.col("l_partkey") % 180 - 90).cast("string"),
            (F.col("l_suppkey") % 360 - 180).cast("string"),
        ).alias("line"),
    )


def landed_samples(spark: SparkSession, folder: str) -> DataFrame:
    """``(download_url, sample_csv)``."""
    lines = order_lines(spark, folder)
    ordered = F.transform(
        F.sort_array(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]
    )
    return lines.groupBy("l_orderkey").agg(ordered.alias("lines")).select(
        F.concat(F.lit("https://example.org/"), F.col("l_orderkey"), F.lit(".csv")).alias("download_url"),
        F.array_join(F.concat(F.array(F.lit(",".join(HEADER))), F.col("lines")), "\n").alias("sample_csv"),
    )


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    key, priority, status = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    return orders.select(
        key.cast("string").alias("dataset_id"),
        status.alias("source"),
        F.concat(priority, F.lit(" order "), status).alias("title"),
        F.when(priority == "4-NOT SPECIFIED", F.lit(None))
        .when(priority == "5-LOW", F.lit(" "))
        .otherwise(
            F.concat(
                F.lit("Order lines of customer "),
                F.col("o_custkey").cast("string"),
                F.lit(" with priority "),
                priority,
                F.lit(" and total price "),
                _money("o_totalprice"),
            )
        )
        .alias("original_description"),
        F.when(
            ~((priority == "1-URGENT") & (status == "P")),
            F.concat(F.lit("https://example.org/"), key, F.lit(".csv")),
        ).alias("download_url"),
        F.concat(F.lit("https://example.org/d/"), key).alias("landing_page_url"),
    )


def samples(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.tag_sample_status(metadata(spark, folder), landed_samples(spark, folder))


def descriptions(spark: SparkSession, folder: str) -> DataFrame:
    return describe_catalog(samples(spark, folder))


def described(spark: SparkSession, folder: str) -> DataFrame:
    """The described table, written once and read back."""
    return write_stage(descriptions(spark, folder), scratch_path(spark, "described"))


LINES_SQL = """
lines AS (
  SELECT * FROM (
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_partkey, l_suppkey,
           l_returnflag || ',' || l_linestatus AS status,
           strftime(l_shipdate, '%Y-%m-%d') AS shipped,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
             l_quantity, l_extendedprice, l_shipdate, l_returnflag || ',' || l_linestatus) AS place
    FROM lineitem) WHERE place <= 20
)"""

SAMPLES_SQL = (
    LINES_SQL
    + """,
landed AS (
  SELECT l_orderkey, 'line,qty,price,status,shipped,lat,lon' || chr(10) || string_agg(
    l_linenumber || ',' || CAST(l_quantity AS BIGINT) || ',' || CAST(l_extendedprice AS DECIMAL(12,2))
    || ',"' || status || '",' || shipped || ',' || (l_partkey % 180 - 90) || ',' || (l_suppkey % 360 - 180),
    chr(10) ORDER BY place) AS sample_csv
  FROM lines GROUP BY l_orderkey
),
metadata AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS dataset_id, o_orderkey, o_orderstatus AS source,
    o_orderpriority || ' order ' || o_orderstatus AS title,
    CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL WHEN '5-LOW' THEN ' '
      ELSE 'Order lines of customer ' || o_custkey || ' with priority ' || o_orderpriority
        || ' and total price ' || CAST(o_totalprice AS DECIMAL(12,2)) END AS original_description,
    CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN NULL
      ELSE 'https://example.org/' || o_orderkey || '.csv' END AS download_url,
    'https://example.org/d/' || o_orderkey AS landing_page_url
  FROM orders
),
samples AS (
  SELECT dataset_id, source, title, original_description, download_url, landing_page_url,
    CASE WHEN download_url IS NOT NULL THEN l.sample_csv END AS sample_csv,
    CASE WHEN download_url IS NOT NULL AND l.sample_csv IS NOT NULL THEN 'success' ELSE 'error' END
      AS sample_fetch_status,
    CASE WHEN download_url IS NULL THEN 'missing_download_url'
      WHEN l.sample_csv IS NULL THEN 'empty_or_unreadable_sample' END AS error_message
  FROM metadata m LEFT JOIN landed l ON m.o_orderkey = l.l_orderkey
)"""
)

# Cells straight from the order lines, without any CSV text in between.
CELLS_SQL = (
    SAMPLES_SQL
    + """,
cells AS (
  SELECT s.dataset_id, CAST(l.place - 1 AS INTEGER) AS row_no, c.col_no, c.col_name, c.value
  FROM samples s JOIN lines l ON s.dataset_id = CAST(l.l_orderkey AS VARCHAR),
  LATERAL (VALUES
    (0, 'line', CAST(l.l_linenumber AS VARCHAR)),
    (1, 'qty', CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR)),
    (2, 'price', CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)),
    (3, 'status', l.status),
    (4, 'shipped', l.shipped),
    (5, 'lat', CAST(l.l_partkey % 180 - 90 AS VARCHAR)),
    (6, 'lon', CAST(l.l_suppkey % 360 - 180 AS VARCHAR))
  ) c(col_no, col_name, value)
  WHERE s.sample_fetch_status = 'success'
)"""
)

PROFILE_SQL = (
    CELLS_SQL
    + r""",
typed AS (
  SELECT dataset_id, col_no, col_name, count(DISTINCT value) AS distinct_values, count(*) AS n_rows,
    CASE WHEN count(value) = 0 THEN 'missingdata'
      WHEN bool_and(regexp_full_match(value, '[+-]?[0-9]+')) THEN 'integer'
      WHEN bool_and(try_cast(value AS DOUBLE) IS NOT NULL) THEN 'float'
      WHEN bool_and(lower(value) IN ('true', 'false', 'yes', 'no')) THEN 'boolean'
      WHEN bool_and(try_cast(value AS TIMESTAMP) IS NOT NULL) THEN 'datetime'
      ELSE 'text' END AS data_type,
    min(try_cast(value AS DOUBLE)) AS num_low, max(try_cast(value AS DOUBLE)) AS num_high,
    min(try_cast(value AS TIMESTAMP)) AS t_low, max(try_cast(value AS TIMESTAMP)) AS t_high,
    bool_or(day(try_cast(value AS TIMESTAMP)) <> 1) AS uses_day,
    bool_or(month(try_cast(value AS TIMESTAMP)) <> 1) AS uses_month
  FROM cells GROUP BY ALL
),
profile AS (
  SELECT dataset_id, col_no, col_name, data_type, distinct_values, n_rows,
    CASE WHEN data_type IN ('integer', 'float') THEN num_low END AS low,
    CASE WHEN data_type IN ('integer', 'float') THEN num_high END AS high,
    CASE WHEN data_type = 'datetime' THEN t_low END AS first_time,
    CASE WHEN data_type = 'datetime' THEN t_high END AS last_time,
    CASE WHEN data_type = 'datetime' THEN
      CASE WHEN uses_day THEN 'day' WHEN uses_month THEN 'month' ELSE 'year' END END AS resolution,
    CASE WHEN col_name = 'lat' AND num_low >= -90 AND num_high <= 90 THEN 'latlong'
      WHEN col_name = 'lon' AND num_low >= -180 AND num_high <= 180 THEN 'latlong' END AS spatial_type
  FROM typed
),
profile_lines AS (
  SELECT *, '**' || col_name || '**: Data is of type ' || data_type || '. There are '
    || distinct_values || ' unique values. '
    || CASE WHEN low IS NULL THEN '' ELSE 'Coverage spans from '
      || CASE WHEN least(0.0, low) = 0 THEN '0' ELSE CAST(low AS VARCHAR) END || ' to '
      || CASE WHEN greatest(0.0, high) = 0 THEN '0' ELSE CAST(high AS VARCHAR) END || '. ' END AS line
  FROM profile
),
profile_texts AS (
  SELECT dataset_id,
    'The key data profile information for this dataset includes:' || chr(10)
      || string_agg(line, chr(10) ORDER BY col_no) AS dataset_profile,
    concat_ws(chr(10),
      string_agg('**Temporal coverage** for columns ' || col_name || ' with resolution ' || resolution
        || ', covering from ' || strftime(first_time, '%Y-%m-%d') || ' to '
        || strftime(last_time, '%Y-%m-%d') || '.', chr(10) ORDER BY col_no)
        FILTER (WHERE first_time IS NOT NULL),
      '**Spatial coverage** for columns ' || string_agg(col_name, ', ' ORDER BY col_no)
        FILTER (WHERE spatial_type = 'latlong') || ', with type latlong.') AS profile_notes
  FROM profile_lines GROUP BY dataset_id
)"""
)

_KNOWN_TERMS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def terms_sql(text: str) -> str:
    return _KNOWN_TERMS.format(text)


DESCRIPTIONS_SQL = (
    PROFILE_SQL
    + r""",
semantic_lines AS (
  SELECT dataset_id, col_no, '**' || col_name || '**: Represents '
    || CASE WHEN first_time IS NOT NULL THEN 'temporal entity' WHEN spatial_type IS NOT NULL THEN 'location'
         WHEN low IS NOT NULL THEN 'numeric entity' ELSE 'category' END || '. '
    || CASE WHEN first_time IS NOT NULL THEN 'Contains temporal data (resolution: ' || resolution || '). ' ELSE '' END
    || CASE WHEN spatial_type IS NOT NULL THEN 'Contains spatial data (resolution: Coordinates). ' ELSE '' END
    || 'Domain-specific type: general. Function/Usage context: '
    || CASE WHEN low IS NOT NULL AND spatial_type IS NULL THEN 'measurement' ELSE 'aggregation key' END
    || '. ' AS line
  FROM profile
),
semantic_texts AS (
  SELECT dataset_id, 'The key semantic information for this dataset includes:' || chr(10)
    || string_agg(line, chr(10) ORDER BY col_no) AS semantic_profile
  FROM semantic_lines GROUP BY dataset_id
),
summaries AS (
  SELECT dataset_id, count(*) AS n_cols, max(n_rows) AS n_rows,
    string_agg(col_name, ', ' ORDER BY col_no) AS names,
    coalesce(string_agg(col_name, ', ' ORDER BY col_no) FILTER (WHERE low IS NOT NULL), '') AS numeric_names,
    coalesce(string_agg(col_name, ', ' ORDER BY col_no) FILTER (WHERE first_time IS NOT NULL), '') AS time_names,
    coalesce(string_agg(col_name, ', ' ORDER BY col_no) FILTER (WHERE spatial_type IS NOT NULL), '') AS place_names
  FROM profile GROUP BY dataset_id
),
topics AS (
  SELECT dataset_id, array_to_string(list_slice(words, 1, 3), ' ') AS topic FROM (
    SELECT dataset_id, list_filter(w, lambda x, i: list_position(w, x) = i) AS words FROM (
      SELECT dataset_id, """
    + terms_sql("title")
    + r""" AS w FROM samples))
),
told AS (
  SELECT s.dataset_id, t.topic, 'This dataset has ' || n_cols || ' columns (' || names || ') and a sample of '
    || n_rows || ' rows. Its topic is ' || t.topic || '.'
    || CASE WHEN numeric_names <> '' THEN ' Numeric columns: ' || numeric_names || '.' ELSE '' END
    || CASE WHEN time_names <> '' THEN ' Time columns: ' || time_names || '.' ELSE '' END
    || CASE WHEN place_names <> '' THEN ' Place columns: ' || place_names || '.' ELSE '' END AS description
  FROM summaries s JOIN topics t USING (dataset_id)
),
descriptions AS (
  SELECT s.dataset_id, s.source, s.title, s.original_description, s.download_url, s.landing_page_url,
    s.sample_csv, p.dataset_profile, m.semantic_profile, t.topic, t.description AS generated_description,
    t.description || chr(10) || 'Topic: ' || t.topic || chr(10) || 'Keywords: '
      || array_to_string(list_sort(list_distinct("""
    + terms_sql("t.description")
    + r""")), ', ') AS search_description,
    CASE WHEN t.dataset_id IS NULL THEN 'error' ELSE 'success' END AS generation_status,
    CASE WHEN t.dataset_id IS NULL THEN 'missing_or_empty_sample_csv_after_shrink' END AS error_message
  FROM samples s LEFT JOIN profile_texts p USING (dataset_id) LEFT JOIN semantic_texts m USING (dataset_id)
    LEFT JOIN told t USING (dataset_id)
)"""
)


# --- catalogue entries from pages ---------------------------------------------------------


def _page(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(
        "page_id",
        "url",
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("lang"),
        F.regexp_extract("url", "://([^/]+)/", 1).alias("host"),
        F.length("html").cast("long").alias("size"),
    )


def socrata_entries(spark: SparkSession, folder: str) -> DataFrame:
    """English pages carry a tag list, French ones a scalar, the others none."""
    resource = F.struct(
        F.concat(F.lit("p-"), F.col("page_id")).alias("id"),
        F.col("title").alias("name"),
        F.col("host").alias("description"),
        F.col("url").alias("permalink"),
        F.lit("dataset").alias("type"),
    )
    views = F.struct(F.col("size").alias("page_views_total"))
    listed, scalar = F.array("lang", "host", "lang"), F.col("lang")

    def entry(*tags: Column) -> Column:
        return F.to_json(
            F.struct(
                F.col("page_id").alias("_n"),
                resource.alias("resource"),
                F.struct(*tags, F.col("lang").alias("_lang")).alias("classification"),
                F.struct(
                    F.col("host").alias("domain"),
                    F.col("page_id").alias("downloads"),
                    views.alias("page_views"),
                ).alias("metadata"),
            )
        )

    return _page(spark, folder).select(
        "page_id",
        F.when(F.col("lang") == "en", entry(listed.alias("tags")))
        .when(F.col("lang") == "fr", entry(scalar.alias("tags")))
        .otherwise(entry())
        .alias("entry_json"),
    )


def portal_summaries(spark: SparkSession, folder: str) -> DataFrame:
    return _page(spark, folder).select(
        "page_id",
        F.to_json(
            F.struct(
                F.when(F.col("lang") != "es", F.concat(F.lit("p-"), F.col("page_id"))).alias("id"),
                F.col("title").alias("name"),
                F.col("url").alias("description"),
                F.when(F.col("lang") == "de", F.lit("")).otherwise(F.col("lang")).alias("category"),
                F.array("host", "lang", "host").alias("tags"),
                F.col("size").alias("rowsUpdatedAt"),
            )
        ).alias("entry_json"),
    )


def portal_details(spark: SparkSession, folder: str) -> DataFrame:
    columns = F.array(
        F.struct(F.col("host").alias("name"), F.lit("text").alias("dataTypeName")),
        F.struct(F.lit("").alias("name"), F.lit("number").alias("dataTypeName")),
        F.struct(F.lit("size").alias("name"), F.lit(None).cast("string").alias("dataTypeName")),
    )
    key = F.concat(F.lit("p-"), F.col("page_id")).alias("id")
    as_object = F.to_json(
        F.struct(key, columns.alias("columns"), F.struct(F.col("lang").alias("name")).alias("license"))
    )
    as_text = F.to_json(F.struct(key, columns.alias("columns"), F.col("lang").alias("license")))
    return _page(spark, folder).select(
        "page_id",
        F.when(F.col("url").startswith("https:"), as_object).otherwise(as_text).alias("entry_json"),
    )


def dcat_entries(spark: SparkSession, folder: str) -> DataFrame:
    """Some fields at the top, some nested; one distribution in three looks like CSV."""
    html = F.struct(
        F.concat(F.col("url"), F.lit("#web")).alias("accessURL"),
        F.lit(None).cast("string").alias("downloadURL"),
        F.lit("text/html").alias("mediaType"),
        F.lit(None).cast("string").alias("format"),
    )
    by_format = F.struct(
        F.lit("").alias("accessURL"),
        F.col("url").alias("downloadURL"),
        F.lit(None).cast("string").alias("mediaType"),
        F.lit("CSV").alias("format"),
    )
    by_ending = F.struct(
        F.concat(F.col("url"), F.lit(".CSV")).alias("accessURL"),
        F.lit(None).cast("string").alias("downloadURL"),
        F.lit(None).cast("string").alias("mediaType"),
        F.lit(None).cast("string").alias("format"),
    )
    lang = F.col("lang")
    links = (
        F.when(lang == "en", F.array(html, by_format))
        .when(lang == "fr", F.array(html, by_ending, by_format))
        .when(lang == "de", F.array(html))
    )
    key = F.concat(F.lit("p-"), F.col("page_id"))
    return _page(spark, folder).select(
        "page_id",
        F.to_json(
            F.struct(
                F.when(lang == "en", key).when(lang == "fr", F.lit("")).alias("identifier"),
                F.when(lang == "en", F.col("title")).alias("title"),
                F.when(lang == "fr", F.array(lang, F.col("host"))).alias("keyword"),
                F.struct(
                    F.concat(key, F.lit("-n")).alias("identifier"),
                    F.col("host").alias("title"),
                    F.col("url").alias("description"),
                    F.when(lang != "de", F.array(F.col("host"))).alias("keyword"),
                    F.col("size").alias("modified"),
                    lang.alias("license"),
                    F.col("url").alias("landingPage"),
                    links.alias("distribution"),
                ).alias("dcat"),
            )
        ).alias("entry_json"),
    )


PAGES_SQL = r"""
page AS (
  SELECT page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
    regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang,
    regexp_extract(url, '://([^/]+)/', 1) AS host, CAST(length(html) AS BIGINT) AS size
  FROM pages
)"""

METADATA_SQL = (
    PAGES_SQL
    + r""",
portal AS (
  SELECT 'p-' || page_id AS dataset_id, 'nyc_open_data' AS source, title, url AS original_description,
    CASE WHEN lang = 'de' THEN '["' || host || '", "' || lang || '"]'
      ELSE '["' || lang || '", "' || host || '"]' END AS keywords_json,
    '["' || host || '", "size"]' AS column_names_json,
    '["text", "number", "unknown"]' AS column_types_raw_json,
    'https://data.cityofnewyork.us/api/views/p-' || page_id || '/rows.csv?accessType=DOWNLOAD' AS download_url,
    'https://data.cityofnewyork.us/d/p-' || page_id AS landing_page_url,
    CAST(NULL AS BIGINT) AS record_count_estimate, CAST(size AS VARCHAR) AS last_updated,
    CASE WHEN url LIKE 'https:%' THEN lang END AS license, CAST(NULL AS VARCHAR) AS sample_rows_json
  FROM page WHERE lang <> 'es'
),
dcat AS (
  SELECT CASE WHEN lang = 'en' THEN 'p-' || page_id ELSE 'p-' || page_id || '-n' END AS dataset_id,
    'data_gov' AS source, CASE WHEN lang = 'en' AND title <> '' THEN title ELSE host END AS title,
    url AS original_description,
    CASE WHEN lang = 'fr' THEN '["fr", "' || host || '"]' WHEN lang = 'de' THEN '[]'
      ELSE '["' || host || '"]' END AS keywords_json,
    '[]' AS column_names_json, '[]' AS column_types_raw_json,
    CASE WHEN lang = 'en' THEN url WHEN lang = 'fr' THEN url || '.CSV' END AS download_url,
    url AS landing_page_url, CAST(NULL AS BIGINT) AS record_count_estimate,
    CAST(size AS VARCHAR) AS last_updated, lang AS license, CAST(NULL AS VARCHAR) AS sample_rows_json
  FROM page
)"""
)


# --- text pairs from conversations --------------------------------------------------------


def text_pairs(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    asked = turns.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("original_description")
    )
    told = turns.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("generated_description")
    )
    size = F.length("original_description")
    return asked.join(told, ["conv_id", "turn"]).select(
        F.concat_ws("-", "conv_id", "turn").alias("dataset_id"),
        F.concat(F.lit("Turn "), F.col("turn")).alias("title"),
        F.when(size > 200, "long").when(size > 50, "medium").otherwise("short").alias("source"),
        "original_description",
        "generated_description",
        F.lit("success").alias("generation_status"),
    )


PAIRS_SQL = """
text_pairs AS (
  SELECT u.conv_id || '-' || u.turn AS dataset_id, 'Turn ' || u.turn AS title,
    CASE WHEN length(u.text) > 200 THEN 'long' WHEN length(u.text) > 50 THEN 'medium' ELSE 'short' END AS source,
    u.text AS original_description, a.text AS generated_description, 'success' AS generation_status
  FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'
)"""


def score_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.col("dataset_id").alias("pair_id"),
        F.col("original_description").alias("reference"),
        F.col("generated_description").alias("candidate"),
    )


# --- documents and queries ----------------------------------------------------------------


def search_docs(spark: SparkSession, folder: str, labelled: bool = True) -> DataFrame:
    """``doc_id, doc_ord, title (first line), description[, qrel (quality label)]``."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("qrel"))
    docs = table(spark, folder, "documents").select(
        "doc_id",
        F.col("doc_id").alias("doc_ord"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("text").alias("description"),
    )
    return docs.join(labels, "doc_id", "left") if labelled else docs


def search_queries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text")
    )


DOCS_SQL = """
docs AS (
  SELECT d.doc_id, d.doc_id AS doc_ord, split_part(d.text, chr(10), 1) || ' ' || d.text AS text,
    CAST(coalesce(l.quality, 0) AS DOUBLE) AS qrel
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
queries AS (SELECT item_id AS query_id, text AS query_text FROM benchmark)"""


# --- vectors ------------------------------------------------------------------------------


def sparse_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("doc_id"),
        F.col("vec_id").alias("doc_ord"),
        "label",
        "embedding",
        vec.to_sparse(F.col("embedding")).alias("sparse"),
    ).select("*", "sparse.*")


VECTORS_SQL = """
vectors AS (
  SELECT vec_id, label, embedding,
    CAST(embedding AS DOUBLE[]) AS sparse
  FROM embeddings
)"""
