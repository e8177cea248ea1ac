"""Structural profile, semantics, prompts, descriptions, evaluation table (D, E, F, G)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cataloom.functions import jsontext, prompts
from cataloom.operators import complete, evaluation, prepare, semantics, structural
from cataloom.plans import describe

from . import views
from .catalog_queries import PICKED_SQL
from .registry import filled, query, text_literal

OFFLINE = complete.OfflineProvider()


def _records(spark, folder):
    return prepare.prepare_records(views.samples(spark, folder))


# --- structural profile -------------------------------------------------------------------


@query(
    "column_type",
    "WITH " + views.PROFILE_SQL + " SELECT dataset_id, col_no, col_name, data_type FROM profile",
)
def column_type(spark, folder):
    return structural.profile_rows(_records(spark, folder)).select(
        "dataset_id", "col_no", "col_name", "data_type"
    )


@query(
    "distinct_values",
    "WITH "
    + views.PROFILE_SQL
    + " SELECT dataset_id, col_no, CAST(distinct_values AS INTEGER) AS distinct_values FROM profile",
)
def distinct_values(spark, folder):
    return structural.profile_rows(_records(spark, folder)).select(
        "dataset_id", "col_no", "distinct_values"
    )


@query(
    "coverage_range",
    "WITH "
    + views.PROFILE_SQL
    + """ SELECT dataset_id, col_no, low, high, CASE WHEN low IS NOT NULL THEN least(0.0, low) END AS range_low,
CASE WHEN high IS NOT NULL THEN greatest(0.0, high) END AS range_high FROM profile""",
)
def coverage_range(spark, folder):
    return structural.profile_rows(_records(spark, folder)).select(
        "dataset_id", "col_no", "low", "high", "range_low", "range_high"
    )


@query(
    "temporal_coverage",
    "WITH "
    + views.PROFILE_SQL
    + """ SELECT dataset_id, col_name, resolution, strftime(first_time, '%Y-%m-%d') AS first_date,
strftime(last_time, '%Y-%m-%d') AS last_date FROM profile WHERE first_time IS NOT NULL""",
)
def temporal_coverage(spark, folder):
    rows = structural.profile_rows(_records(spark, folder))
    return rows.filter(F.col("first_time").isNotNull()).select(
        "dataset_id",
        "col_name",
        "resolution",
        F.date_format("first_time", "yyyy-MM-dd").alias("first_date"),
        F.date_format("last_time", "yyyy-MM-dd").alias("last_date"),
    )


@query(
    "spatial_coverage",
    "WITH "
    + views.PROFILE_SQL
    + " SELECT dataset_id, col_name, spatial_type FROM profile WHERE spatial_type IS NOT NULL",
)
def spatial_coverage(spark, folder):
    rows = structural.profile_rows(_records(spark, folder))
    return rows.filter(F.col("spatial_type").isNotNull()).select(
        "dataset_id", "col_name", "spatial_type"
    )


@query(
    "render_profile_text",
    "WITH " + views.PROFILE_SQL + " SELECT dataset_id, dataset_profile, profile_notes FROM profile_texts",
)
def render_profile_text(spark, folder):
    return structural.render_profiles(_records(spark, folder)).select(
        "dataset_id", "dataset_profile", "profile_notes"
    )


def _table_sql(table: str, columns: list[tuple[str, str]]) -> str:
    parts = []
    for i, (name, kind) in enumerate(columns):
        number = f"CAST({name} AS DOUBLE)" if kind in ("integer", "float") else "CAST(NULL AS DOUBLE)"
        time = f"CAST({name} AS TIMESTAMP)" if kind == "datetime" else "CAST(NULL AS TIMESTAMP)"
        low, high = f"min({number})", f"max({number})"
        parts.append(
            f"""SELECT CAST({i} AS INTEGER) AS col_no, '{name}' AS col_name, '{kind}' AS data_type,
  count(*) FILTER (WHERE {name} IS NULL) AS null_count, count(DISTINCT {name}) AS distinct_values,
  {low} AS low, {high} AS high, CASE WHEN {low} IS NOT NULL THEN least(0.0, {low}) END AS range_low,
  CASE WHEN {high} IS NOT NULL THEN greatest(0.0, {high}) END AS range_high,
  strftime(min({time}), '%Y-%m-%d') AS first_date, strftime(max({time}), '%Y-%m-%d') AS last_date,
  CASE WHEN count({time}) = 0 THEN NULL WHEN bool_or(second({time}) <> 0) THEN 'second'
    WHEN bool_or(minute({time}) <> 0) THEN 'minute' WHEN bool_or(hour({time}) <> 0) THEN 'hour'
    WHEN bool_or(day({time}) <> 1) THEN 'day' WHEN bool_or(month({time}) <> 1) THEN 'month' ELSE 'year' END
    AS resolution FROM {table}"""
        )
    return "\nUNION ALL\n".join(parts)


def _dated(df):
    return (
        df.withColumn("first_date", F.date_format("first_time", "yyyy-MM-dd"))
        .withColumn("last_date", F.date_format("last_time", "yyyy-MM-dd"))
        .drop("first_time", "last_time")
    )


LINEITEM = [
    ("l_orderkey", "integer"),
    ("l_partkey", "integer"),
    ("l_suppkey", "integer"),
    ("l_linenumber", "integer"),
    ("l_quantity", "float"),
    ("l_extendedprice", "float"),
    ("l_discount", "float"),
    ("l_tax", "float"),
    ("l_returnflag", "text"),
    ("l_linestatus", "text"),
    ("l_shipdate", "datetime"),
]
ORDERS = [
    ("o_orderkey", "integer"),
    ("o_custkey", "integer"),
    ("o_orderstatus", "text"),
    ("o_totalprice", "float"),
    ("o_orderdate", "datetime"),
    ("o_orderpriority", "text"),
]
EVENTS = [
    ("event_id", "integer"),
    ("ts", "datetime"),
    ("user_id", "integer"),
    ("event_type", "text"),
    ("value", "float"),
    ("props", "text"),
]


@query("profile_table_lineitem", _table_sql("lineitem", LINEITEM))
def profile_table_lineitem(spark, folder):
    return _dated(structural.profile_table(views.table(spark, folder, "lineitem")))


@query("profile_table_orders", _table_sql("orders", ORDERS))
def profile_table_orders(spark, folder):
    return _dated(structural.profile_table(views.table(spark, folder, "orders")))


@query("profile_table_events", _table_sql("events", EVENTS))
def profile_table_events(spark, folder):
    return _dated(structural.profile_table(views.table(spark, folder, "events")))


# --- semantic profile ---------------------------------------------------------------------

COLUMN_PROMPT_SQL = filled(
    prompts.SEMANTIC_USER_PROMPT,
    template=text_literal(prompts.SEMANTIC_TEMPLATE),
    response_example=text_literal(prompts.SEMANTIC_RESPONSE_EXAMPLE),
    column_name="col_name",
    sample_values="vals",
)
VALUES_SQL = (
    PICKED_SQL
    + """,
vals AS (SELECT dataset_id, col_no, col_name, string_agg(value, ', ' ORDER BY row_no) AS vals,
  '[' || string_agg('''' || value || '''', ', ' ORDER BY row_no) || ']' AS listed
  FROM sampled GROUP BY dataset_id, col_no, col_name)"""
)


@query(
    "column_prompt",
    "WITH " + VALUES_SQL + f" SELECT dataset_id, col_no, col_name, {COLUMN_PROMPT_SQL} AS prompt FROM vals",
)
def column_prompt(spark, folder):
    return semantics.column_prompts(_records(spark, folder))


def _group_sql(size: int) -> str:
    prompt = filled(
        prompts.SEMANTIC_GROUP_USER_PROMPT,
        template=text_literal(prompts.SEMANTIC_TEMPLATE),
        response_example=text_literal(prompts.SEMANTIC_GROUP_RESPONSE_EXAMPLE),
        columns_text="blocks",
    )
    group = f"CAST(col_no // {size} AS INTEGER)" if size else "CAST(0 AS INTEGER)"
    return (
        "WITH "
        + VALUES_SQL
        + f""", g AS (SELECT dataset_id, {group} AS group_no, string_agg(col_name, '|' ORDER BY col_no) AS asked,
  string_agg('Column: ' || col_name || chr(10) || 'Sample values: ' || listed, chr(10) || chr(10) ORDER BY col_no) AS blocks
  FROM vals GROUP BY 1, 2)
SELECT dataset_id, group_no, asked, {prompt} AS prompt FROM g"""
    )


def _asked_text(df):
    return df.withColumn("asked", F.array_join("asked", "|"))


@query("group_prompts_all", _group_sql(0))
def group_prompts_all(spark, folder):
    return _asked_text(semantics.group_prompts(_records(spark, folder), 0))


@query("group_prompts_by_three", _group_sql(3))
def group_prompts_by_three(spark, folder):
    return _asked_text(semantics.group_prompts(_records(spark, folder), 3))


@query(
    "batch_prompts",
    "WITH "
    + VALUES_SQL
    + f""" SELECT dataset_id, CAST(col_no // 4 AS BIGINT) AS batch_no, col_no % 4 AS place, col_name,
  {COLUMN_PROMPT_SQL} AS prompt FROM vals""",
)
def batch_prompts(spark, folder):
    return semantics.batch_prompts(_records(spark, folder), 4)


@query(
    "batch_answers",
    "WITH "
    + VALUES_SQL
    + """, sent AS (SELECT dataset_id, col_no // 4 AS batch_no, col_no % 4 AS place, col_name,
    count(*) OVER (PARTITION BY dataset_id, col_no // 4) AS n FROM vals)
SELECT dataset_id, CAST(batch_no AS BIGINT) AS batch_no, place, col_name,
  CASE WHEN place = n - 1 AND n > 1 THEN NULL ELSE 'about ' || col_name END AS answer,
  CASE WHEN place = n - 1 AND n > 1 THEN 'no_answer' ELSE 'success' END AS status
FROM sent""",
)
def batch_answers(spark, folder):
    """Replies by batch, the last of several missing, aligned with their prompts by place."""
    asked = semantics.batch_prompts(_records(spark, folder), 4)
    told = asked.groupBy("dataset_id", "batch_no").agg(F.array_sort(F.collect_list(F.struct("place", "col_name"))).alias("told"))
    short = F.slice("told", F.lit(1), F.greatest(F.size("told") - 1, F.lit(1)))
    replies = told.withColumn("answers", F.transform(short, lambda t: F.concat(F.lit("about "), t["col_name"])))
    return semantics.align_answers(asked, replies).drop("prompt")


# Answers as a model might write them, made from events: text around the object, a missing
# brace, a comma too many, No in words, no object at all.
def _answer_text():
    return F.concat(
        F.lit("Sure: "),
        F.lit('{"'),
        F.col("event_type"),
        F.lit('": {"Temporal": {"isTemporal": '),
        F.when(F.col("value") > 10, F.lit('"Yes"')).when(F.col("value") > 5, F.lit("true")).otherwise('"No"'),
        F.lit(', "resolution": "Day",}, "Entity Type": "'),
        F.col("event_type"),
        F.lit('", "Domain-Specific Types": "unknown", "Function/Usage Context": "Measurement"'),
        F.lit("}"),
    )


def _answers(spark, folder):
    """``event_id, event_type, value, answer``."""
    text = _answer_text()
    with_end = (
        F.when(F.col("value") < 2, F.lit("I cannot say."))
        .when(F.col("value") < 4, F.concat(text, F.lit(",\n} Done.")))
        .otherwise(text)
    )
    return views.table(spark, folder, "events").select(
        "event_id", "event_type", "value", with_end.alias("answer")
    )


ANSWERS_SQL = r"""
a AS (
  SELECT event_id, event_type, value, '{"' || event_type || '": {"Temporal": {"isTemporal": '
    || CASE WHEN value > 10 THEN '"Yes"' WHEN value > 5 THEN 'true' ELSE '"No"' END AS head,
    event_type || '", "Domain-Specific Types": "unknown", "Function/Usage Context": "Measurement"' AS tail
  FROM events
)"""


@query(
    "repair_json",
    "WITH "
    + ANSWERS_SQL
    + """ SELECT event_id, CASE WHEN value < 2 THEN 'I cannot say.' ELSE
  head || ', "resolution": "Day"}, "Entity Type": "' || tail || '}}' END AS fixed FROM a""",
)
def repair_json(spark, folder):
    return _answers(spark, folder).select("event_id", jsontext.repair(F.col("answer")).alias("fixed"))


@query(
    "parse_semantics",
    """SELECT event_id, event_type AS col_name, CASE WHEN value > 10 THEN 'Yes' WHEN value > 5 THEN 'true' ELSE 'No' END AS is_temporal,
  'Day' AS resolution, event_type AS entity_type, 'Measurement' AS usage FROM events
WHERE value >= 2 AND event_type <> 'error'""",
)
def parse_semantics(spark, folder):
    """Grouped answers; the column ``error`` was never asked for, ``other`` got no answer."""
    asked = F.array(F.nullif(F.col("event_type"), F.lit("error")), F.lit("other"))
    found = semantics.parse_group_semantics(F.col("answer"), F.array_compact(asked))
    return (
        _answers(spark, folder)
        .select("event_id", F.explode(found).alias("f"))
        .select(
            "event_id",
            "f.col_name",
            F.col("f.semantics.Temporal.isTemporal").alias("is_temporal"),
            F.col("f.semantics.Temporal.resolution").alias("resolution"),
            F.col("f.semantics")["Entity Type"].alias("entity_type"),
            F.col("f.semantics")["Function/Usage Context"].alias("usage"),
        )
    )


@query(
    "column_semantic_text",
    """SELECT event_id, '**' || event_type || '**: Represents ' || event_type || '. '
  || CASE WHEN value > 5 THEN 'Contains temporal data (resolution: Day). ' ELSE '' END
  || 'Function/Usage context: measurement. ' AS text FROM events WHERE value >= 2""",
)
def column_semantic_text(spark, folder):
    found = semantics.parse_group_semantics(F.col("answer"), F.array("event_type"))
    return (
        _answers(spark, folder)
        .select("event_id", F.explode(found).alias("f"))
        .select(
            "event_id",
            semantics.column_semantic_text(F.col("f.col_name"), F.col("f.semantics")).alias("text"),
        )
    )


@query(
    "dataset_semantic_text",
    "WITH " + views.DESCRIPTIONS_SQL + " SELECT dataset_id, semantic_profile FROM semantic_texts",
)
def dataset_semantic_text(spark, folder):
    """From the offline provider's JSON answer through repair and parsing to the text."""
    profiled = structural.sample_profiles(_records(spark, folder))
    answered = complete.complete(
        profiled, "group_semantics", F.col("sample_csv"), OFFLINE, {"profile": F.col("profile")}
    )
    names = F.transform("columns", lambda c: c["col_name"])
    found = semantics.parse_group_semantics(F.col("answer.content"), names)
    return answered.select(
        "dataset_id", semantics.dataset_semantic_text(found).alias("semantic_profile")
    )


@query(
    "token_usage_stats",
    "WITH "
    + views.PAIRS_SQL
    + f""", t AS (SELECT source, CAST(ceil(length(p) / 4.0) AS BIGINT) AS asked, 1 AS told FROM (SELECT source, {filled(prompts.PAIR_USER_PROMPT, desc_a='generated_description', desc_b='original_description')} AS p FROM text_pairs))
SELECT source, count(*) AS calls, CAST(sum(asked) AS BIGINT) AS prompt_tokens,
  CAST(sum(told) AS BIGINT) AS completion_tokens, CAST(sum(asked + told) AS BIGINT) AS total_tokens FROM t GROUP BY source""",
)
def token_usage_stats(spark, folder):
    """The judge's usage by source; its answer is always one word."""
    pairs = views.text_pairs(spark, folder)
    a, b = F.col("generated_description"), F.col("original_description")
    answered = complete.complete(
        pairs, "verdict", prompts.pair_prompt(a, b), OFFLINE, {"a": a, "b": b}
    )
    return semantics.token_usage_stats(answered.select("source", "answer.*"), ["source"])


# --- prompts and descriptions -------------------------------------------------------------


def _described_prompt_sql(sections: list[tuple[str, str, str]]) -> str:
    parts = [filled(prompts.DESCRIBE_INTRODUCTION, dataset_sample="sample_csv")]
    for template, name, column in sections:
        parts.append(f"CASE WHEN {column} <> '' THEN {filled(template, **{name: column})} END")
    parts.append(text_literal(prompts.DESCRIBE_CLOSING_INSTRUCTION))
    parts.append("'Target length: approximately 100 words.'")
    return f"concat_ws(chr(10), {', '.join(parts)})"


@query(
    "description_prompt",
    "WITH "
    + views.DESCRIPTIONS_SQL
    + f""" SELECT dataset_id, CASE WHEN sample_csv IS NOT NULL THEN {
        _described_prompt_sql([
            (prompts.DESCRIBE_PROFILE_INSTRUCTION, "dataset_profile", "dataset_profile"),
            (prompts.DESCRIBE_SEMANTIC_INSTRUCTION, "semantic_profile", "semantic_profile"),
            (prompts.DESCRIBE_TOPIC_INSTRUCTION, "data_topic", "topic"),
        ])} END AS prompt FROM descriptions""",
)
def description_prompt(spark, folder):
    return views.described(spark, folder).select(
        "dataset_id",
        prompts.description_prompt(
            F.col("sample_csv"),
            F.col("dataset_profile"),
            F.col("semantic_profile"),
            F.col("topic"),
        ).alias("prompt"),
    )


@query(
    "profile_portal_samples",
    """WITH placed AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place FROM orders),
kept AS (SELECT o_custkey || '-' || (place // 20) AS dataset_id, o_orderdate, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price FROM placed)
SELECT dataset_id, 'placed' AS col_name, 'datetime' AS data_type, CAST(min(o_orderdate) AS VARCHAR) AS first_time,
  CAST(max(o_orderdate) AS VARCHAR) AS last_time, CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high FROM kept GROUP BY 1
UNION ALL SELECT dataset_id, 'huge', 'float', NULL, NULL, min(CAST(price || 'e25' AS DOUBLE)), max(CAST(price || 'e25' AS DOUBLE)) FROM kept GROUP BY 1
UNION ALL SELECT dataset_id, 'tiny', 'float', NULL, NULL, min(CAST(price || 'e-17' AS DOUBLE)), max(CAST(price || 'e-17' AS DOUBLE)) FROM kept GROUP BY 1""",
)
def profile_portal_samples(spark, folder):
    """Samples of twenty orders of a customer each, all of them, with dates as MM/dd/yyyy and AM or PM, and
    numbers far from 1."""
    orders = views.table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    line = F.concat_ws(",", F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a"), F.concat(price, F.lit("e25")), F.concat(price, F.lit("e-17")))
    place = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    placed = orders.withColumn("place", place).withColumn("block", F.floor(F.col("place") / 20))
    lines = placed.groupBy("o_custkey", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", line.alias("line")))), lambda x: x["line"]), "\n").alias("lines"))
    samples = lines.select(F.concat_ws("-", F.col("o_custkey").cast("string"), F.col("block").cast("string")).alias("dataset_id"), F.concat(F.lit("placed,huge,tiny\n"), "lines").alias("sample_csv"))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return structural.profile_rows(samples).select("dataset_id", "col_name", "data_type", stamp("first_time"), stamp("last_time"), "low", "high")


@query(
    "topic_prompt",
    "WITH "
    + views.SAMPLES_SQL
    + f""" SELECT dataset_id, {filled(prompts.TOPIC_USER_PROMPT, title="coalesce(title, '')",
        description_block="CASE WHEN original_description <> '' THEN 'Original Description: ' || original_description || chr(10) ELSE '' END",
        dataset_sample="sample_csv")} AS prompt FROM samples""",
)
def topic_prompt(spark, folder):
    return views.samples(spark, folder).select(
        "dataset_id",
        prompts.topic_prompt(
            F.col("title"), F.col("original_description"), F.col("sample_csv")
        ).alias("prompt"),
    )


@query(
    "search_prompt",
    "WITH "
    + views.PAIRS_SQL
    + f""" SELECT dataset_id, {filled(prompts.SEARCH_USER_PROMPT, topic="title",
        initial_description="generated_description", template=text_literal(prompts.SEARCH_TEMPLATE))} AS prompt FROM text_pairs""",
)
def search_prompt(spark, folder):
    return views.text_pairs(spark, folder).select(
        "dataset_id",
        prompts.search_prompt(F.col("generated_description"), F.col("title")).alias("prompt"),
    )


_PLAIN_TOLD = "replace(d.generated_description, ' Its topic is ' || d.topic || '.', '')"


@query(
    "generate_descriptions",
    "WITH "
    + views.DESCRIPTIONS_SQL
    + f""" SELECT d.dataset_id, d.title, d.source, CASE WHEN d.sample_csv IS NOT NULL THEN {_described_prompt_sql([])} END AS prompt,
  {_PLAIN_TOLD} AS generated_description, d.generation_status AS status,
  CASE WHEN d.sample_csv IS NULL THEN 'Row for dataset_id=' || d.dataset_id || ' is missing a valid sample_csv value.' END AS error_message
FROM descriptions d""",
)
def generate_descriptions(spark, folder):
    return describe.generate_descriptions(views.samples(spark, folder))


@query(
    "generate_open_data_descriptions",
    "WITH "
    + views.DESCRIPTIONS_SQL
    + """, few AS (SELECT dataset_id, least(n_rows, 8) AS n FROM summaries)
SELECT d.dataset_id, d.source, d.title, d.original_description, d.download_url, d.landing_page_url, d.sample_csv,
  regexp_replace(replace(d.generated_description, ' Its topic is ' || d.topic || '.', ''), 'sample of [0-9]+ rows',
    'sample of ' || f.n || ' rows') AS generated_description, d.generation_status, d.error_message
FROM descriptions d LEFT JOIN few f USING (dataset_id)""",
)
def generate_open_data_descriptions(spark, folder):
    return describe.generate_open_data_descriptions(views.samples(spark, folder))


@query("describe_catalog", "WITH " + views.DESCRIPTIONS_SQL + " SELECT * FROM descriptions")
def describe_catalog(spark, folder):
    return views.descriptions(spark, folder)


@query("describe_catalog_grouped", "WITH " + views.DESCRIPTIONS_SQL + " SELECT * FROM descriptions")
def describe_catalog_grouped(spark, folder):
    """Columns asked in groups of three give the same texts."""
    facade = describe.Describer(OFFLINE)
    return facade.describe(views.samples(spark, folder), group_size=3)


def _variants_sql() -> str:
    def prompt(words: int, profile: bool, semantic: bool) -> str:
        sections = []
        if profile:
            sections.append((prompts.DESCRIBE_PROFILE_INSTRUCTION, "dataset_profile", "dataset_profile"))
        if semantic:
            sections.append((prompts.DESCRIBE_SEMANTIC_INSTRUCTION, "semantic_profile", "semantic_profile"))
            sections.append((prompts.DESCRIBE_TOPIC_INSTRUCTION, "data_topic", "topic"))
        return _described_prompt_sql(sections).replace(
            "approximately 100 words", f"approximately {words} words"
        )

    plain = "replace(generated_description, ' Its topic is ' || topic || '.', '')"
    parts = [
        f"SELECT dataset_id, 'baseline' AS variant, {prompt(200, False, False)} AS prompt, {plain} AS description FROM d"
    ]
    for heat in ("0.0", "0.7"):
        for size in (100, 200):
            for use in (True, False):
                parts.append(
                    f"SELECT dataset_id, 'temperature-{heat}+num_words-{size}+use_semantic_profile-{use}+use_topic-{use}',"
                    f" {prompt(size, True, use)}, {'generated_description' if use else plain} FROM d"
                )
    return (
        "WITH "
        + views.DESCRIPTIONS_SQL
        + ", d AS (SELECT * FROM descriptions WHERE generation_status = 'success')\n"
        + "\nUNION ALL\n".join(parts)
    )


@query("variant_grid", _variants_sql())
def variant_grid(spark, folder):
    records = prepare.successes(views.described(spark, folder))
    return describe.variant_grid(records, [0.0, 0.7], [100, 200], [True, False])


@query(
    "generation_counts",
    "WITH "
    + views.DESCRIPTIONS_SQL
    + """ SELECT source, generation_status, count(*) AS "count", count(topic) AS n_topic, count(dataset_profile) AS n_dataset_profile,
  count(semantic_profile) AS n_semantic_profile, count(search_description) AS n_search_description FROM descriptions GROUP BY 1, 2""",
)
def generation_counts(spark, folder):
    return evaluation.generation_counts(views.described(spark, folder))


# --- evaluation table ---------------------------------------------------------------------

EVALUATED_SQL = (
    "WITH "
    + views.DESCRIPTIONS_SQL
    + """,
evaluated AS (
  SELECT dataset_id, source, title, coalesce(trim(original_description) <> '', false) AS has_original_description,
    original_description, CAST(length(coalesce(original_description, '')) AS INTEGER) AS original_description_len,
    generated_description, CAST(length(coalesce(generated_description, '')) AS INTEGER) AS generated_description_len,
    search_description, CAST(length(coalesce(search_description, '')) AS INTEGER) AS search_description_len,
    topic, coalesce(trim(topic) <> '', false) AS has_topic,
    dataset_profile, coalesce(trim(dataset_profile) <> '', false) AS has_profile,
    semantic_profile, coalesce(trim(semantic_profile) <> '', false) AS has_semantic_profile,
    generation_status, error_message
  FROM descriptions
)"""
)


def _evaluated(spark, folder):
    return evaluation.evaluation_table_full(views.described(spark, folder))


@query(
    "evaluation_table",
    EVALUATED_SQL
    + """ SELECT dataset_id, source, title, has_original_description, original_description, generated_description,
  original_description_len, generated_description_len, generation_status, error_message FROM evaluated""",
)
def evaluation_table(spark, folder):
    return evaluation.evaluation_table(views.described(spark, folder))


@query("evaluation_table_full", EVALUATED_SQL + " SELECT * FROM evaluated")
def evaluation_table_full(spark, folder):
    return _evaluated(spark, folder)


@query(
    "coverage_counts",
    EVALUATED_SQL
    + """ SELECT CASE grouping(generation_status, has_original_description, has_topic)
    WHEN 7 THEN 'source' WHEN 3 THEN 'source,generation_status' WHEN 5 THEN 'source,has_original_description'
    ELSE 'source,has_topic,has_profile,has_semantic_profile' END AS "grouping",
  source, generation_status, has_original_description, has_topic, has_profile, has_semantic_profile,
  count(*) AS "count"
FROM evaluated GROUP BY GROUPING SETS ((source), (source, generation_status), (source, has_original_description),
  (source, has_topic, has_profile, has_semantic_profile))""",
)
def coverage_counts(spark, folder):
    return evaluation.coverage_counts(_evaluated(spark, folder))


@query(
    "status_counts",
    "WITH " + views.SAMPLES_SQL + ' SELECT source, sample_fetch_status, count(*) AS "count" FROM samples GROUP BY 1, 2',
)
def status_counts(spark, folder):
    return evaluation.status_counts(views.samples(spark, folder), "sample_fetch_status")


@query(
    "length_stats",
    """WITH v AS (SELECT 'n_chars' AS metric, length(text) AS value FROM documents
  UNION ALL SELECT 'source_length', length(source) FROM documents)
SELECT metric, count(*) AS "count", round_even(avg(value), 1) AS mean, round_even(stddev_samp(value), 1) AS std,
  CAST(min(value) AS DOUBLE) AS min, round_even(quantile_cont(value, 0.25), 1) AS p25,
  round_even(quantile_cont(value, 0.5), 1) AS p50, round_even(quantile_cont(value, 0.75), 1) AS p75,
  CAST(max(value) AS DOUBLE) AS max FROM v GROUP BY metric""",
)
def length_stats(spark, folder):
    docs = views.table(spark, folder, "documents").select(
        F.length("text").alias("n_chars"), F.length("source").alias("source_length")
    )
    return evaluation.length_stats(docs, ["n_chars", "source_length"])


@query(
    "run_summary",
    EVALUATED_SQL
    + """ SELECT count(*) AS requested, count(*) FILTER (WHERE g) AS described, count(*) FILTER (WHERE NOT g) AS errors,
  count(topic) FILTER (WHERE g) AS topics, count(dataset_profile) FILTER (WHERE g) AS profiles,
  count(semantic_profile) FILTER (WHERE g) AS semantic_profiles,
  count(search_description) FILTER (WHERE g) AS search_descriptions
FROM (SELECT *, generation_status = 'success' AS g FROM evaluated)""",
)
def run_summary(spark, folder):
    return evaluation.run_summary(_evaluated(spark, folder))


@query(
    "qualitative_sample",
    EVALUATED_SQL
    + """ SELECT dataset_id, title, source, topic,
  CASE WHEN trim(coalesce(original_description, '')) <> '' THEN substring(original_description, 1, 300) || '...' ELSE '[None]' END AS original,
  generated_description AS generated, substring(search_description, 1, 400) || '...' AS search
FROM evaluated WHERE generation_status = 'success' ORDER BY md5('42|' || dataset_id), dataset_id LIMIT 5""",
)
def qualitative_sample(spark, folder):
    return evaluation.qualitative_sample(_evaluated(spark, folder), 5)


@query(
    "text_lengths",
    EVALUATED_SQL
    + " SELECT dataset_id, generated_description_len, search_description_len, original_description_len FROM evaluated",
)
def text_lengths(spark, folder):
    return evaluation.text_lengths(views.described(spark, folder))
