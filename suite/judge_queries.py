"""Judging, pairing, ratings, pluggable parts (J, K)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cataloom.functions import prompts
from cataloom.operators import complete, judging, prepare, ratings
from cataloom.plans import describe

from . import views
from .registry import filled, query, text_literal
from .search_queries import WORDS_SQL

OFFLINE = complete.OfflineProvider()


def marks_sql(text: str) -> str:
    """A list of the three marks the offline judge gives."""
    words = WORDS_SQL.format(text)
    return f"""(SELECT [least(10, 1 + n // 20), CASE WHEN n > 0 THEN greatest(1, d * 10 // n) ELSE 1 END,
  least(10, CASE WHEN n > 0 THEN greatest(1, 14 - letters // n) ELSE 1 END)]
  FROM (SELECT len(w) AS n, len(list_distinct(w)) AS d, letters FROM (SELECT {words} AS w,
    length(regexp_replace({text}, '[ \\t\\n\\r\\f\\v]+', '', 'g')) AS letters)))"""


# --- rubric scores ------------------------------------------------------------------------


@query(
    "quality_prompt",
    "WITH "
    + views.PAIRS_SQL
    + f""" SELECT dataset_id, {text_literal(prompts.QUALITY_USER_PROMPT)} || chr(10) || 'Description: ' || generated_description
  || chr(10) || 'Evaluation Form (scores ONLY): ' AS prompt FROM text_pairs""",
)
def quality_prompt(spark, folder):
    return views.text_pairs(spark, folder).select(
        "dataset_id", prompts.quality_prompt(F.col("generated_description")).alias("prompt")
    )


# Score texts with four, three or two numbers, and one without labels.
SCORE_TEXT_SQL = """
score_texts AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_returnflag
    WHEN 'A' THEN 'Completeness: ' || l_linenumber || ', Conciseness: ' || CAST(l_quantity AS BIGINT) || ', Readability: ' || l_suppkey || ' of 10'
    WHEN 'N' THEN l_linenumber || '/10 and ' || CAST(l_quantity AS BIGINT)
    ELSE 'Scores ' || l_linenumber || ' and ' || CAST(l_quantity AS BIGINT) END AS score_text
  FROM lineitem
)"""


def _score_texts(spark, folder):
    line, size = F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("long").cast("string")
    text = (
        F.when(
            F.col("l_returnflag") == "A",
            F.concat(
                F.lit("Completeness: "), line, F.lit(", Conciseness: "), size,
                F.lit(", Readability: "), F.col("l_suppkey").cast("string"), F.lit(" of 10"),
            ),
        )
        .when(F.col("l_returnflag") == "N", F.concat(line, F.lit("/10 and "), size))
        .otherwise(F.concat(F.lit("Scores "), line, F.lit(" and "), size))
    )
    return views.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", text.alias("score_text")
    )


PARSED_SQL = (
    "WITH "
    + SCORE_TEXT_SQL
    + """, numbers AS (SELECT *, regexp_extract_all(score_text, '[0-9]+') AS x FROM score_texts),
parsed AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(x[1] AS INTEGER) AS completeness,
  CAST(x[2] AS INTEGER) AS conciseness, CAST(x[3] AS INTEGER) AS readability FROM numbers WHERE len(x) >= 3)"""
)


@query("parse_scores", PARSED_SQL + " SELECT * FROM parsed")
def parse_scores(spark, folder):
    return judging.scored(_score_texts(spark, folder)).drop("score_text")


@query(
    "parse_scores_labelled",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber AS completeness,
  CAST(l_quantity AS INTEGER) AS conciseness, CAST(l_suppkey AS INTEGER) AS readability FROM lineitem WHERE l_returnflag = 'A'""",
)
def parse_scores_labelled(spark, folder):
    return judging.scored(_score_texts(spark, folder), labelled=True).drop("score_text")


@query(
    "score_averages",
    PARSED_SQL
    + """ SELECT count(*) AS n, round(avg(completeness), 6) AS completeness, round(avg(conciseness), 6) AS conciseness,
  round(avg(readability), 6) AS readability, round(avg((completeness + conciseness + readability) / 3.0), 6) AS overall FROM parsed""",
)
def score_averages(spark, folder):
    means = judging.score_averages(judging.scored(_score_texts(spark, folder)))
    return means.select("n", *[F.round(c, 6).alias(c) for c in [*judging.DIMENSIONS, "overall"]])


# --- pairwise -----------------------------------------------------------------------------


@query(
    "pair_prompt",
    "WITH "
    + views.PAIRS_SQL
    + f""" SELECT dataset_id, {filled(prompts.PAIR_USER_PROMPT, desc_a="generated_description", desc_b="original_description")} AS prompt FROM text_pairs""",
)
def pair_prompt(spark, folder):
    return views.text_pairs(spark, folder).select(
        "dataset_id",
        prompts.pair_prompt(F.col("generated_description"), F.col("original_description")).alias("prompt"),
    )


@query(
    "verdict",
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'A' WHEN 'view' THEN 'B' ELSE 'A' END AS winner,
  CASE event_type WHEN 'click' THEN false WHEN 'view' THEN false ELSE true END AS unclear FROM events""",
)
def verdict(spark, folder):
    """Answers in lower case, with blanks around, or undecided."""
    answer = (
        F.when(F.col("event_type") == "click", "\n a.")
        .when(F.col("event_type") == "view", " B is better")
        .otherwise("neither")
    )
    return views.table(spark, folder, "events").select(
        "event_id",
        judging.verdict(answer).alias("winner"),
        judging.is_unclear(answer).alias("unclear"),
    )


# Draws in SQL: the pair numbers come from the same rule, the pairs from a list of all pairs.
def _draw_sql(half: bool, limit: int) -> str:
    take = limit // 2 if half else limit
    return f"""
sizes AS (SELECT source AS "group", count(*) AS n FROM documents GROUP BY 1),
drawn AS (
  SELECT "group", total, least(total, {take}) AS wanted,
    CAST('0x' || substring(md5('5|' || "group"), 1, 8) AS BIGINT) % total AS start_at,
    list_filter(list_transform(range(0, 128), lambda d: CAST(floor(total * 0.6180339887498949) AS BIGINT) + d), lambda x: gcd(x, total) = 1)[1] AS stride
  FROM (SELECT *, n * (n - 1) // 2 AS total FROM sizes) WHERE total > 0
),
numbers AS (SELECT *, unnest(range(0, wanted)) AS seq FROM drawn),
all_pairs AS (
  SELECT i, j, j * (j - 1) // 2 + i AS number
  FROM (SELECT unnest(range(0, (SELECT max(n) FROM sizes))) AS j), LATERAL (SELECT unnest(range(0, j)) AS i)
),
pairs AS (
  SELECT "group", seq, wanted, p.i, p.j FROM numbers d JOIN all_pairs p ON p.number = CAST((CAST(d.start_at AS HUGEINT) + CAST(d.seq AS HUGEINT) * d.stride) % d.total AS BIGINT)
)"""


def _sizes(spark, folder):
    docs = views.table(spark, folder, "documents").select(F.col("source").alias("group"))
    return docs.groupBy("group").agg(F.count(F.lit(1)).alias("n"))


@query("sample_pairs_no_repeat", "WITH " + _draw_sql(False, 100) + ' SELECT "group", seq, i, j FROM pairs')
def sample_pairs_no_repeat(spark, folder):
    return judging.sample_pairs(_sizes(spark, folder), "no_repeat", 100, seed=5)


@query(
    "sample_pairs_symmetric",
    "WITH "
    + _draw_sql(True, 100)
    + ' SELECT "group", seq, i, j FROM pairs UNION ALL SELECT "group", seq + wanted, j, i FROM pairs',
)
def sample_pairs_symmetric(spark, folder):
    return judging.sample_pairs(_sizes(spark, folder), "symmetric", 100, seed=5)


@query(
    "sample_pairs_full",
    "WITH "
    + views.PAIRS_SQL
    + """ SELECT dataset_id AS "group", CAST(seq AS BIGINT) AS seq, CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j
FROM text_pairs, (VALUES (0, 0, 1), (1, 0, 2), (2, 1, 2)) p(seq, i, j)""",
)
def sample_pairs_full(spark, folder):
    """Every pair of the three text variants of a dataset."""
    sizes = views.text_pairs(spark, folder).select(
        F.col("dataset_id").alias("group"), F.lit(3).alias("n")
    )
    return judging.sample_pairs(sizes, "full")


BATCH_SQL = (
    "WITH "
    + _draw_sql(False, 100)
    + f""",
placed AS (
  SELECT source AS "group", doc_id, text, row_number() OVER (PARTITION BY source ORDER BY md5('5|' || doc_id), doc_id) - 1 AS pos
  FROM documents
),
marked AS (SELECT "group", doc_id, pos, m[1] + m[2] + m[3] AS total FROM (SELECT *, {marks_sql("text")} AS m FROM placed)),
games AS (
  SELECT 'overall' AS aspect, p."group", p.seq, p.i, p.j, a.doc_id AS item_i, b.doc_id AS item_j,
    CASE WHEN b.total > a.total THEN 'B' ELSE 'A' END AS winner
  FROM pairs p JOIN marked a ON a."group" = p."group" AND a.pos = p.i JOIN marked b ON b."group" = p."group" AND b.pos = p.j
)"""
)


def _items(spark, folder):
    return views.table(spark, folder, "documents").select(
        F.col("source").alias("group"), F.col("doc_id").alias("item"), "text"
    )


def _games(spark, folder):
    return judging.compare_batch(_items(spark, folder), OFFLINE, "no_repeat", 100, seed=5)


@query("compare_batch", BATCH_SQL + " SELECT * FROM games")
def compare_batch(spark, folder):
    return _games(spark, folder)


@query(
    "win_rates",
    BATCH_SQL
    + """, played AS (SELECT "group", item_i AS item, CASE WHEN winner = 'A' THEN 1 ELSE 0 END AS won FROM games
  UNION ALL SELECT "group", item_j, CASE WHEN winner = 'A' THEN 0 ELSE 1 END FROM games),
sums AS (SELECT "group", item, sum(won) AS wins, count(*) AS plays FROM played GROUP BY 1, 2)
SELECT 'overall' AS aspect, d.source AS "group", d.doc_id AS item, CAST(coalesce(wins, 0) AS BIGINT) AS wins,
  coalesce(plays, 0) AS plays, round(coalesce(wins / plays, 0.0), 6) AS win_rate
FROM documents d LEFT JOIN sums s ON s."group" = d.source AND s.item = d.doc_id""",
)
def win_rates(spark, folder):
    items = _items(spark, folder).select(F.lit("overall").alias("aspect"), "group", "item")
    games = _games(spark, folder).drop("i", "j").withColumnsRenamed({"item_i": "i", "item_j": "j"})
    return judging.win_rates(games, items, ["group"]).withColumn("win_rate", F.round("win_rate", 6))


@query(
    "elo_ratings",
    BATCH_SQL.replace("WITH ", "WITH RECURSIVE ", 1)
    + """, steps AS (
  SELECT "group", CAST(0 AS BIGINT) AS step, list_transform(range(0, n), lambda x: 1500.0::DOUBLE) AS r FROM sizes
  UNION ALL
  SELECT s."group", s.step + 1, list_transform(s.r, lambda x, k: CASE
      WHEN k = g.i + 1 THEN x + 32 * (CASE WHEN g.winner = 'A' THEN 1 ELSE 0 END - 1 / (1 + pow(10, (s.r[g.j + 1] - s.r[g.i + 1]) / 400)))
      WHEN k = g.j + 1 THEN x - 32 * (CASE WHEN g.winner = 'A' THEN 1 ELSE 0 END - 1 / (1 + pow(10, (s.r[g.j + 1] - s.r[g.i + 1]) / 400)))
      ELSE x END)
  FROM steps s JOIN games g ON g."group" = s."group" AND g.seq = s.step
),
last AS (SELECT "group", max_by(r, step) AS r FROM steps GROUP BY 1)
SELECT 'overall' AS aspect, "group" AS tournament, k AS item, round(r[k + 1], 4) AS rating
FROM (SELECT "group", r, unnest(range(0, len(r))) AS k FROM last)""",
)
def elo_ratings(spark, folder):
    """A tournament per source; items without a game keep the initial rating."""
    games = _games(spark, folder).withColumnRenamed("group", "tournament")
    rated = ratings.elo_ratings(games)
    items = judging.hashed_position(_items(spark, folder).drop("text"), "group", "item", 5).select(
        F.lit("overall").alias("aspect"), F.col("group").alias("tournament"), F.col("pos").alias("item")
    )
    return ratings.all_ratings(rated, items).select(
        "aspect", "tournament", "item", F.round("rating", 4).alias("rating")
    )


# Generated against original, one game per dataset.
DUEL_SQL = (
    "WITH "
    + views.PAIRS_SQL
    + f""",
duels AS (
  SELECT *, CASE WHEN b[1] + b[2] + b[3] > a[1] + a[2] + a[3] THEN 'Original' ELSE 'Generated' END AS winner
  FROM (SELECT *, {marks_sql("generated_description")} AS a, {marks_sql("original_description")} AS b FROM text_pairs)
  WHERE trim(original_description) <> '' AND length(original_description) > 50
)"""
)


def _duels(spark, folder):
    pairs = prepare.comparable_pairs(views.text_pairs(spark, folder), 50)
    return judging.compare(pairs, OFFLINE, "generated_description", "original_description")


def _named(duels):
    return duels.withColumn("winner", judging.named_winner(F.col("winner")))


@query("compare_texts", DUEL_SQL + " SELECT dataset_id, source, winner FROM duels")
def compare_texts(spark, folder):
    return _named(_duels(spark, folder)).select("dataset_id", "source", "winner")


@query(
    "elo_single_game",
    DUEL_SQL
    + """ SELECT count(*) AS games, round(avg(CASE WHEN winner = 'Generated' THEN 1516.0 ELSE 1484.0 END), 6) AS elo_a,
  round(avg(CASE WHEN winner = 'Generated' THEN 1484.0 ELSE 1516.0 END), 6) AS elo_b FROM duels""",
)
def elo_single_game(spark, folder):
    rated = ratings.elo_single_game(_duels(spark, folder))
    return rated.select("games", F.round("elo_a", 6).alias("elo_a"), F.round("elo_b", 6).alias("elo_b"))


@query(
    "elo_isolated_games",
    DUEL_SQL
    + """, numbered AS (SELECT conv.winner, CAST(split_part(dataset_id, '-', 1) AS BIGINT) * 100000 + CAST(split_part(dataset_id, '-', 2) AS BIGINT) AS n FROM duels conv)
SELECT n * 2 AS item, CASE WHEN winner = 'Generated' THEN 1516.0 ELSE 1484.0 END::DOUBLE AS rating FROM numbered
UNION ALL SELECT n * 2 + 1, CASE WHEN winner = 'Generated' THEN 1484.0 ELSE 1516.0 END::DOUBLE FROM numbered""",
)
def elo_isolated_games(spark, folder):
    """One large tournament in which every pair brings two fresh items."""
    parts = F.split("dataset_id", "-")
    number = F.get(parts, F.lit(0)).cast("long") * 100000 + F.get(parts, F.lit(1)).cast("long")
    games = _duels(spark, folder).select(
        F.lit("overall").alias("aspect"),
        F.lit("all").alias("tournament"),
        number.alias("seq"),
        (number * 2).alias("i"),
        (number * 2 + 1).alias("j"),
        "winner",
    )
    return ratings.elo_ratings(games).select("item", "rating")


@query(
    "win_breakdown",
    DUEL_SQL
    + """ SELECT source, count(*) FILTER (WHERE winner = 'Generated') AS generated,
  count(*) FILTER (WHERE winner = 'Original') AS original FROM duels GROUP BY source""",
)
def win_breakdown(spark, folder):
    return judging.win_breakdown(_named(_duels(spark, folder)))


@query(
    "win_totals",
    DUEL_SQL
    + """ SELECT count(*) AS pairs, count(*) FILTER (WHERE winner = 'Generated') AS generated_wins,
  round_even(count(*) FILTER (WHERE winner = 'Generated') * 100.0 / count(*), 1) AS generated_share,
  count(*) FILTER (WHERE winner = 'Original') AS original_wins,
  round_even(count(*) FILTER (WHERE winner = 'Original') * 100.0 / count(*), 1) AS original_share FROM duels""",
)
def win_totals(spark, folder):
    return judging.win_totals(_named(_duels(spark, folder)))
