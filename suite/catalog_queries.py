"""Sources, ingest, preparation, sampling (A, B, C, K1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cataloom import schemas
from cataloom.functions import csvtext, jsontext
from cataloom.functions.text import elements, shrink_sample_csv
from cataloom.operators import ingest, prepare, sampling
from cataloom.session import scratch_path
from cataloom.sources import landed, qrels, stages

from . import views
from .registry import query

# --- sources and sinks --------------------------------------------------------------------


@query("read_stage", "SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS o_totalprice FROM orders")
def read_stage(spark, folder):
    return views.table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("o_totalprice")
    )


@query(
    "write_stage",
    "SELECT CAST(page_id AS VARCHAR) AS dataset_id, url AS title FROM pages",
)
def write_stage(spark, folder):
    pages = views.table(spark, folder, "pages").select(
        F.col("page_id").cast("string").alias("dataset_id"), F.col("url").alias("title")
    )
    return stages.write_stage(pages, scratch_path(spark, "stage"))


PAGE_SIZE = 50


@query(
    "read_catalog_pages",
    "WITH "
    + views.PAGES_SQL
    + """
SELECT page_id // 50 AS "offset", page_id % 50 AS pos, 'p-' || page_id AS dataset_id, title
FROM page ORDER BY 1, 2 LIMIT 120""",
)
def read_catalog_pages(spark, folder):
    """Entries landed as pages of fifty; the first 120 entries are wanted."""
    path = scratch_path(spark, "pages")
    entries = views.socrata_entries(spark, folder)
    number = F.col("page_id")
    # F.floor would turn the exact integer division into a double one.
    page = (number - number % PAGE_SIZE) / PAGE_SIZE
    (
        entries.groupBy(page.cast("long").alias("offset"))
        .agg(
            F.transform(
                F.sort_array(F.collect_list(F.struct("page_id", "entry_json"))),
                lambda x: F.parse_json(x["entry_json"]),
            ).alias("results")
        )
        .write.json(path)
    )
    return landed.read_catalog_pages(spark, path, 120).select(
        "offset",
        "pos",
        ingest.safe_get(F.col("entry_json"), "$.resource.id").alias("dataset_id"),
        ingest.safe_get(F.col("entry_json"), "$.resource.name").alias("title"),
    )


@query(
    "sample_landed_csv",
    """
SELECT c_mktsegment AS segment, c_custkey // 500 AS block, 'c_custkey,c_name,c_acctbal' || chr(10)
  || string_agg(c_custkey || ',' || c_name || ',' || CAST(c_acctbal AS DECIMAL(12,2)), chr(10)
    ORDER BY c_custkey) AS sample_csv
FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment, c_custkey // 500 ORDER BY c_custkey) AS n
      FROM customer)
WHERE n <= 5 GROUP BY 1, 2""",
)
def sample_landed_csv(spark, folder):
    """Customers landed as one CSV file per segment and block of keys, five rows sampled of each."""
    path = scratch_path(spark, "csv")
    key = F.col("c_custkey")
    rows = views.table(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("segment"),
        ((key - key % 500) / 500).cast("long").alias("block"),
        key,
        "c_name",
        F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"),
    )
    (
        rows.repartition("segment", "block")
        .sortWithinPartitions("segment", "block", "c_custkey")
        .write.partitionBy("segment", "block")
        .option("header", True)
        .csv(path)
    )
    sampled = landed.sample_landed_csv(spark, path, max_rows=5)
    return sampled.select(
        F.regexp_extract("file_path", "segment=([^/]+)/", 1).alias("segment"),
        F.regexp_extract("file_path", "block=([0-9]+)/", 1).cast("long").alias("block"),
        "sample_csv",
    )


@query(
    "sample_quoted_csv",
    """
SELECT block, 'c_custkey,note,c_acctbal' || chr(10) || string_agg(c_custkey || ',"' || c_name || chr(10) || '""' || c_mktsegment
  || '"", ' || c_custkey || '",' || CAST(c_acctbal AS DECIMAL(12,2)), chr(10) ORDER BY c_custkey) AS sample_csv
FROM (SELECT *, c_custkey // 300 AS block, row_number() OVER (PARTITION BY c_custkey // 300 ORDER BY c_custkey) AS n FROM customer)
WHERE n <= 4 GROUP BY block""",
)
def sample_quoted_csv(spark, folder):
    """Files whose second cells hold quotes, commas and a line end; four records sampled of each."""
    path = scratch_path(spark, "quoted")
    key = F.col("c_custkey")
    note = F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('", '), key.cast("string"))
    rows = views.table(spark, folder, "customer").select(
        ((key - key % 300) / 300).cast("long").alias("block"), key, note.alias("note"), F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal")
    )
    dealt = rows.repartition("block").sortWithinPartitions("block", "c_custkey")
    dealt.write.partitionBy("block").option("header", True).option("escape", '"').csv(path)
    sampled = landed.sample_landed_csv(spark, path, max_rows=4)
    return sampled.select(F.regexp_extract("file_path", "block=([0-9]+)/", 1).cast("long").alias("block"), "sample_csv")


QRELS_SQL = """
WITH q AS (
  SELECT CAST(quality AS VARCHAR) AS topic, CASE WHEN toxic = 1 THEN '' ELSE CAST(l.doc_id AS VARCHAR) END
    AS document, CAST(quality + toxic AS DOUBLE) AS score
  FROM labels l)
"""


def _landed_qrels(spark, folder):
    path = scratch_path(spark, "qrels")
    labels = views.table(spark, folder, "labels")
    name = F.when(F.col("toxic") == 1, F.lit("plain")).otherwise(
        F.concat(F.lit("docs/"), F.col("doc_id"), F.lit("/part.csv"))
    )
    labels.select(
        F.col("quality").alias("topic"),
        (F.col("quality") + F.col("toxic")).alias("relevance"),
        name.alias("document"),
        F.lit("x").alias("rest"),
    ).write.option("header", True).csv(path)
    return qrels.read_qrels(spark, path)


@query("read_qrels", QRELS_SQL + "SELECT document, topic, score FROM q")
def read_qrels(spark, folder):
    return _landed_qrels(spark, folder).drop("position")


@query(
    "nested_qrels",
    QRELS_SQL
    + """SELECT topic, document, count(*) AS n_scores, max(score) AS best_score, sum(score) AS sum_score
FROM q GROUP BY 1, 2""",
)
def nested_qrels(spark, folder):
    # The order of lines in files written in parallel is not fixed, so first and last are left out.
    return qrels.nested_qrels(_landed_qrels(spark, folder)).drop("first_score", "last_score")


@query(
    "qrels_score_lists",
    """
WITH q AS (
  SELECT doc_id, CAST(quality AS VARCHAR) AS topic, CASE WHEN toxic = 1 THEN '' ELSE CAST(doc_id % 3 AS VARCHAR) END AS document,
    doc_id % 97 AS score
  FROM labels),
placed AS (SELECT *, row_number() OVER (PARTITION BY topic, document ORDER BY doc_id) - 1 AS place FROM q)
SELECT topic, document, CAST(place // 16 AS BIGINT) AS block_no, count(*) AS n_scores,
  string_agg(CAST(score AS VARCHAR), ',' ORDER BY place) AS scores
FROM placed GROUP BY ALL""",
)
def qrels_score_lists(spark, folder):
    """Files of ranges of ids, read as lists in line order."""
    path = scratch_path(spark, "qrels")
    labels = views.table(spark, folder, "labels").repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id")
    name = F.when(F.col("toxic") == 1, F.lit("plain")).otherwise(
        F.concat(F.lit("docs/"), F.col("doc_id") % 3, F.lit("/part.csv"))
    )
    labels.select(
        F.col("quality").alias("topic"), (F.col("doc_id") % 97).alias("relevance"), name.alias("document"), F.lit("x").alias("rest")
    ).write.option("header", True).csv(path)
    lists = qrels.score_lists(qrels.read_qrels(spark, path), 16)
    whole = F.transform("scores", lambda s: s.cast("int").cast("string"))
    return lists.select("topic", "document", "block_no", F.size("scores").cast("long").alias("n_scores"), F.array_join(whole, ",").alias("scores"))


@query(
    "resume_progress",
    "SELECT CAST(conv_id AS VARCHAR) AS conv_id, count(*) AS turns, max(length(text)) AS longest FROM conversations GROUP BY 1",
)
def resume_progress(spark, folder):
    """First the system conversations are done and saved; the same batch id then runs twice more."""
    turns = views.table(spark, folder, "conversations").withColumn(
        "conv_id", F.col("conv_id").cast("string")
    )
    path = scratch_path(spark, "progress")

    def work(df):
        return df.groupBy("conv_id").agg(
            F.count(F.lit(1)).alias("turns"), F.max(F.length("text")).cast("long").alias("longest")
        )

    with_system = turns.filter(F.col("role") == "system").select("conv_id").distinct()
    stages.append_progress(work(turns.join(with_system, "conv_id", "left_semi")), path, "a")
    stages.resume_progress(turns, path, "conv_id", work, "a")
    return stages.resume_progress(turns, path, "conv_id", work, "a").drop("batch")


@query(
    "write_records_json",
    "WITH " + views.PAIRS_SQL + " SELECT dataset_id, title, source, generated_description AS description FROM text_pairs",
)
def write_records_json(spark, folder):
    pairs = views.text_pairs(spark, folder).select(
        "dataset_id", "title", "source", F.col("generated_description").alias("description")
    )
    path = scratch_path(spark, "records")
    stages.write_records_json(pairs, path)
    return stages.read_records_json(spark, path, pairs.schema)


# --- validation and projection ------------------------------------------------------------


@query("require_columns", "WITH " + views.SAMPLES_SQL + " SELECT dataset_id, title, source, sample_csv FROM samples")
def require_columns(spark, folder):
    return prepare.require_columns(views.samples(spark, folder)).select(schemas.RECORD_COLUMNS)


@query(
    "prepare_records",
    "WITH "
    + views.SAMPLES_SQL
    + """ SELECT dataset_id, coalesce(title, '') AS title, coalesce(source, '') AS source, sample_csv
FROM samples WHERE trim(coalesce(sample_csv, '')) <> ''""",
)
def prepare_records(spark, folder):
    return prepare.prepare_records(views.samples(spark, folder))


@query(
    "prepare_open_data_records",
    "WITH "
    + views.SAMPLES_SQL
    + """ SELECT dataset_id, title, source, sample_csv, original_description, download_url, landing_page_url
FROM samples WHERE sample_fetch_status = 'success'""",
)
def prepare_open_data_records(spark, folder):
    return prepare.prepare_open_data_records(views.samples(spark, folder))


@query(
    "normalize_socrata_catalog",
    "WITH "
    + views.PAGES_SQL
    + """ SELECT 'p-' || page_id AS dataset_id, title, 'nyc_open_data' AS source, host AS description,
  url AS permalink, 'dataset' AS type, CAST(NULL AS VARCHAR) AS created_at, CAST(NULL AS VARCHAR) AS updated_at,
  size AS page_views_total, page_id AS download_count,
  CASE lang WHEN 'en' THEN '["en", "' || host || '", "en"]' WHEN 'fr' THEN 'fr' END AS tags_json, host AS domain
FROM page""",
)
def normalize_socrata_catalog(spark, folder):
    return ingest.normalize_socrata_catalog(views.socrata_entries(spark, folder))


def _portal(spark, folder):
    return ingest.normalize_portal_view(
        views.portal_summaries(spark, folder), views.portal_details(spark, folder)
    )


def _short_raw(df):
    """The raw entry is checked by what is in it; its JSON text has no fixed layout."""
    return df.drop("raw_metadata_json")


@query("normalize_portal_view", "WITH " + views.METADATA_SQL + " SELECT * FROM portal")
def normalize_portal_view(spark, folder):
    return _short_raw(_portal(spark, folder))


@query(
    "portal_raw_metadata",
    "WITH "
    + views.PAGES_SQL
    + """ SELECT 'p-' || page_id AS dataset_id, title AS name, host AS first_column FROM page WHERE lang <> 'es'""",
)
def portal_raw_metadata(spark, folder):
    raw = F.col("raw_metadata_json")
    return _portal(spark, folder).select(
        "dataset_id",
        jsontext.path_or_default(raw, "$.summary_entry.name").alias("name"),
        jsontext.path_or_default(raw, "$.detail_entry.columns[0].name").alias("first_column"),
    )


@query("normalize_dcat_entry", "WITH " + views.METADATA_SQL + " SELECT * FROM dcat")
def normalize_dcat_entry(spark, folder):
    return _short_raw(ingest.normalize_dcat_entry(views.dcat_entries(spark, folder)))


@query(
    "union_sources",
    "WITH " + views.METADATA_SQL + " SELECT * FROM portal UNION ALL SELECT * FROM dcat",
)
def union_sources(spark, folder):
    dcat = ingest.normalize_dcat_entry(views.dcat_entries(spark, folder))
    return _short_raw(ingest.union_sources(_portal(spark, folder), dcat, required=True))


@query(
    "extract_keywords",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE o_orderstatus || '|' || o_orderpriority END AS keywords FROM orders",
)
def extract_keywords(spark, folder):
    """Category empty for finished orders; tags repeat and hold a null."""
    orders = views.table(spark, folder, "orders")
    category = F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderstatus"))
    tags = F.array("o_orderpriority", F.lit(None), "o_orderpriority", F.nullif(category, F.lit("")))
    return orders.select(
        "o_orderkey",
        F.array_join(ingest.extract_keywords(category, tags), "|").alias("keywords"),
    )


@query(
    "extract_columns",
    "WITH "
    + views.PAGES_SQL
    + " SELECT page_id, host || '|size' AS names, 'text|number|unknown' AS types, CAST(2 AS INTEGER) AS n_names, CAST(3 AS INTEGER) AS n_types FROM page",
)
def extract_columns(spark, folder):
    kinds = "struct<columns:array<struct<name:string,dataTypeName:string>>>"
    found = F.from_json("entry_json", kinds)["columns"]
    names, types = ingest.extract_column_names(found), ingest.extract_column_types(found)
    return views.portal_details(spark, folder).select(
        "page_id",
        F.array_join(names, "|").alias("names"),
        F.array_join(types, "|").alias("types"),
        F.size(names).alias("n_names"),
        F.size(types).alias("n_types"),
    )


@query(
    "first_csv_link",
    "WITH "
    + views.PAGES_SQL
    + " SELECT page_id, CASE lang WHEN 'en' THEN url WHEN 'fr' THEN url || '.CSV' END AS csv_url FROM page",
)
def first_csv_link(spark, folder):
    links = F.try_variant_get(
        F.try_parse_json("entry_json"), "$.dcat.distribution", "array<variant>"
    )
    return views.dcat_entries(spark, folder).select(
        "page_id", ingest.first_csv_link(links).alias("csv_url")
    )


@query(
    "safe_get",
    """SELECT event_id, coalesce(json_extract_string(props, '$.k'), 'none') AS k, 'none' AS missing FROM events""",
)
def safe_get(spark, folder):
    return views.table(spark, folder, "events").select(
        "event_id",
        ingest.safe_get(F.col("props"), "$.k", "none").alias("k"),
        ingest.safe_get(F.col("props"), "$.k.deeper", "none").alias("missing"),
    )


@query(
    "normalize_tags",
    "WITH "
    + views.PAGES_SQL
    + """ SELECT page_id, CASE lang WHEN 'en' THEN '["en", "' || host || '", "en"]' WHEN 'fr' THEN 'fr' END AS tags FROM page""",
)
def normalize_tags(spark, folder):
    return views.socrata_entries(spark, folder).select(
        "page_id", ingest.normalize_tags(F.col("entry_json"), "$.classification.tags").alias("tags")
    )


@query(
    "align_schema",
    """SELECT CAST(c_custkey AS VARCHAR) AS dataset_id, c_mktsegment AS source, c_name AS title,
  CAST(NULL AS VARCHAR) AS original_description, CAST(NULL AS VARCHAR) AS download_url,
  CAST(NULL AS VARCHAR) AS landing_page_url, CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS sample_csv,
  CAST(NULL AS VARCHAR) AS sample_fetch_status, CAST(NULL AS VARCHAR) AS error_message FROM customer""",
)
def align_schema(spark, folder):
    """Columns out of order, some missing, one with NaN for negative balances."""
    nan = F.when(F.col("c_acctbal") < 0, F.lit(float("nan"))).otherwise(F.col("c_nationkey"))
    rows = views.table(spark, folder, "customer").select(
        F.col("c_name").alias("title"),
        nan.cast("double").alias("sample_csv"),
        F.col("c_custkey").alias("dataset_id"),
        F.col("c_mktsegment").alias("source"),
    )
    out = prepare.align_schema(rows, schemas.SAMPLES)
    return out.withColumn("sample_csv", F.col("sample_csv").cast("double").cast("long").cast("string"))


@query("tag_sample_status", "WITH " + views.SAMPLES_SQL + " SELECT * FROM samples")
def tag_sample_status(spark, folder):
    return views.samples(spark, folder)


@query(
    "limit_records",
    "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 100",
)
def limit_records(spark, folder):
    orders = views.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return prepare.limit_records(orders, 100, ["o_orderkey"])


@query(
    "limit_records_per_source",
    """SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n
FROM documents) WHERE n <= 20""",
)
def limit_records_per_source(spark, folder):
    docs = views.table(spark, folder, "documents").select("source", "doc_id")
    return prepare.limit_records(docs, 20, ["doc_id"], per="source")


_STRIPPED = "trim(original_description, ' ' || chr(9) || chr(10) || chr(13))"


@query(
    "comparable_pairs",
    "WITH "
    + views.PAIRS_SQL
    + f""" SELECT dataset_id, length(original_description) AS n FROM text_pairs
WHERE generation_status = 'success' AND generated_description IS NOT NULL AND {_STRIPPED} <> ''""",
)
def comparable_pairs(spark, folder):
    return prepare.comparable_pairs(views.text_pairs(spark, folder)).select(
        "dataset_id", F.length("original_description").cast("long").alias("n")
    )


@query(
    "comparable_pairs_long",
    "WITH "
    + views.PAIRS_SQL
    + f""" SELECT dataset_id, source FROM text_pairs
WHERE {_STRIPPED} <> '' AND length(original_description) > 50""",
)
def comparable_pairs_long(spark, folder):
    return prepare.comparable_pairs(views.text_pairs(spark, folder), 50).select(
        "dataset_id", "source"
    )


@query(
    "split_success",
    "WITH "
    + views.SAMPLES_SQL
    + """ SELECT count(*) FILTER (WHERE sample_fetch_status = 'success') AS successes,
  count(*) FILTER (WHERE sample_fetch_status <> 'success') AS failures FROM samples""",
)
def split_success(spark, folder):
    return prepare.split_success(
        views.samples(spark, folder).withColumnRenamed("sample_fetch_status", "generation_status")
    )


# --- sampling and CSV text ----------------------------------------------------------------

_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "get_sample",
    """SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY
    md5('9|' || concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)),
    l_orderkey, l_partkey, l_suppkey, l_linenumber) AS n FROM lineitem) WHERE n <= 5""",
)
def get_sample(spark, folder):
    lines = views.table(spark, folder, "lineitem").select(_KEY)
    return sampling.get_sample(lines, 5, _KEY, by="l_suppkey")


@query(
    "get_sample_whole_table",
    """SELECT doc_id, n_chars FROM documents ORDER BY md5('9|' || doc_id), doc_id LIMIT 50""",
)
def get_sample_whole_table(spark, folder):
    docs = views.table(spark, folder, "documents").select("doc_id", "n_chars")
    return sampling.get_sample(docs, 50, ["doc_id"])


PICKED_SQL = (
    views.CELLS_SQL
    + """,
picked AS (
  SELECT dataset_id, row_no FROM (
    SELECT dataset_id, row_no, row_number() OVER (PARTITION BY dataset_id
      ORDER BY md5('9|' || dataset_id || '|' || row_no)) AS n
    FROM (SELECT DISTINCT dataset_id, row_no FROM cells)) WHERE n <= 5
),
sampled AS (SELECT c.* FROM cells c JOIN picked USING (dataset_id, row_no))"""
)


@query(
    "column_sample_values",
    "WITH "
    + PICKED_SQL
    + """ SELECT dataset_id, col_no, col_name, string_agg(value, '|' ORDER BY row_no) AS sample_values
FROM sampled GROUP BY ALL""",
)
def column_sample_values(spark, folder):
    records = prepare.prepare_records(views.samples(spark, folder))
    return (
        sampling.column_sample_values(records)
        .select("dataset_id", F.explode(elements("column_values")).alias("c"))
        .select(
            "dataset_id",
            "c.col_no",
            "c.col_name",
            F.array_join("c.sample_values", "|").alias("sample_values"),
        )
    )


@query(
    "render_csv",
    """SELECT page_id, 'page_id,url,title' AS csv_header, page_id || ',' || url || ',' ||
  CASE WHEN regexp_matches(title, '[,"\n\r]') THEN '"' || replace(title, '"', '""') || '"' ELSE title END AS csv_line
FROM (SELECT page_id, url, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages)""",
)
def render_csv(spark, folder):
    pages = views._page(spark, folder).select("page_id", "url", "title")
    return sampling.sample_csv_text(pages, ["page_id", "url", "title"]).select(
        "page_id", "csv_header", "csv_line"
    )


@query(
    "render_sample_csv",
    "WITH " + views.SAMPLES_SQL + " SELECT dataset_id, replace(sample_csv, 'x', 'x') AS csv FROM samples WHERE sample_csv IS NOT NULL",
)
def render_sample_csv(spark, folder):
    """Parsed samples written again give the text they came from."""
    records = prepare.prepare_records(views.samples(spark, folder))
    return records.select(
        "dataset_id", csvtext.render(csvtext.rows(F.col("sample_csv"))).alias("csv")
    )


_ENDS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@query(
    "shrink_sample_csv",
    f"""SELECT doc_id, nullif(trim(substring(array_to_string(list_slice(
  string_split(trim(text, {_ENDS}), chr(10)), 1, 9), chr(10)), 1, 8000), {_ENDS}), '') AS shrunk FROM documents""",
)
def shrink_samples(spark, folder):
    """Every document as if it were a sample: header, eight lines, at most 8,000 characters."""
    return views.table(spark, folder, "documents").select(
        "doc_id", shrink_sample_csv(F.col("text")).alias("shrunk")
    )


@query("explode_sample_cells", "WITH " + views.CELLS_SQL + " SELECT * FROM cells")
def explode_sample_cells(spark, folder):
    return sampling.explode_sample_cells(prepare.prepare_records(views.samples(spark, folder)))


@query(
    "fill_missing_as_text",
    "WITH "
    + views.SAMPLES_SQL
    + " SELECT dataset_id, coalesce(original_description, '') AS original_description, coalesce(download_url, '') AS download_url, error_message FROM samples",
)
def fill_missing_as_text(spark, folder):
    rows = views.samples(spark, folder).select(
        "dataset_id", "original_description", "download_url", "error_message"
    )
    return sampling.fill_missing_as_text(rows, ["original_description", "download_url"])
