"""Registered queries of this package over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, classifier, decontaminate, divergence, licenses, pii, quality, secrets, simhash, suffix_tree, trie, urls
from . import spans as S
from .common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def vocabulary() -> tuple[str, str]:
    """Rank file and pattern of the public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def _counts(kinds: tuple[str, ...]) -> list[Column]:
    return [S.counted(F.col("base_spans"), i).alias(f"n_{k}") for i, k in enumerate(kinds)]


def _digests(kinds: tuple[str, ...]) -> list[Column]:
    return [F.sha2(S.shown(F.col("base_spans"), kinds), 256).alias("base_sha256"), S.shown(F.col("spans"), kinds).alias("spans")]


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.protected(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", *_counts(pii.KINDS[:4]), *_digests(pii.KINDS))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"))


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scanned(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", *_counts(secrets.KINDS[:3]), *_digests(secrets.KINDS))


def _held_out(id_column: str) -> Column:
    """Null ids are held out: they have no fold to learn from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").filter(~_held_out("doc_id"))
    model = classifier.train(docs, labels)
    scored = classifier.scored(docs, model)
    return scored.select("doc_id", _held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("item_id", "doc_id", "shared", "containment")


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), *vocabulary())


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judged(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def turn_records(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, record): each turn as a JSON record in the layout that its role suggests."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    record = (
        F.when(role == "user", F.to_json(F.struct(text.alias("prompt"))))
        .when(role == "assistant", F.to_json(F.struct(text.alias("completion"))))
        .when(role == "system", F.to_json(F.struct(text.alias("system"))))
        .otherwise(F.to_json(F.struct(F.struct(role.alias("role"), text.alias("content")).alias("message"))))
    )
    return turns.select("conv_id", "turn", record.alias("record"))


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], turns.schema)
    formatted = chat.formatted(turn_records(turns.union(more)), "conv_id", "turn")
    return chat.digests(formatted, "conv_id", "turn")


def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(table(spark, folder, "documents"))


def op11_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    # Null ids are held out: they have no fold to learn from.
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(True))
    scored = suffix_tree.scored(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(table(spark, folder, "conversations"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_quality_rules,
        op3_simhash,
        op4_secret_scan,
        op5_quality_classifier,
        op6_decontamination,
        op7_byte_bpe,
        op8_url_filter,
        op9_chat_format,
        op10_license_scan,
        op11_lm_scoring,
        op12_source_divergence,
        op13_prefix_trie,
        pipeline,
    )
}

# What SQL states plainly.  Hashes, compression, learned models and positions of lookaround matches are
# compared with brute force in tests/llm.
ORACLES: dict[str, str] = {}

ORACLES["op12_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
word AS (
    SELECT id, lang, source, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
    FROM (SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS raw FROM d)
),
kept AS (SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
size AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
used AS (SELECT lang, source, term, count(*) AS n FROM word JOIN kept USING (lang, term) GROUP BY lang, source, term),
grid AS (
    SELECT g.lang, g.source, k.term, coalesce(u.n, 0) AS n, sum(coalesce(u.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total, s.v
    FROM grp g JOIN kept k ON k.lang = g.lang JOIN size s ON s.lang = g.lang
    LEFT JOIN used u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term
),
own AS (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 1)) // (total + v) AS p FROM grid),
whole AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + v) AS q
    FROM (SELECT lang, term, sum(n) AS n, any_value(v) AS v FROM grid GROUP BY lang, term)
),
met AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM own a JOIN own b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL
),
pair AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(met.value, 0)::BIGINT AS value
    FROM grp a JOIN grp b ON b.lang = a.lang AND b.source <> a.source
    LEFT JOIN met ON met.lang = a.lang AND met.source = a.source AND met.item = b.source
),
high AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM own JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM pair
UNION ALL
SELECT lang, source, 'term' AS part, item, value, rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item)::INTEGER AS rank FROM high) WHERE rank <= 200
"""

# crc32 of a decimal number, bit by bit.
ORACLES["op13_prefix_trie"] = """
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
conv AS (
    SELECT conv_id, conv_id - conv_id % 5 AS base, xor(crc, 4294967295) % 9 AS h
    FROM (
        SELECT conv_id, list_reduce(
            [4294967295] || flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
            lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc
        FROM (SELECT DISTINCT conv_id FROM turns)
    )
),
made AS (
    SELECT conv.conv_id, place, role, text FROM conv JOIN turns ON turns.conv_id = conv.base WHERE place < h
    UNION ALL
    SELECT conv_id, place, role, text FROM conv JOIN turns USING (conv_id) WHERE place >= h
),
step AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth, sha256(length(role) || ':' || role || text) AS turn, strlen(text) AS size FROM made),
path AS (
    SELECT conv_id, depth, size, string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth) AS prefix FROM step
    UNION ALL
    SELECT conv_id, 0, 0, '' FROM conv
),
node AS (SELECT prefix, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size FROM path GROUP BY prefix),
named AS (SELECT path.conv_id AS member, node.* FROM path JOIN node USING (prefix)),
tree AS (SELECT node.*, up.conv_id AS parent_conv_id, up.prefix AS parent FROM node LEFT JOIN named up ON up.member = node.conv_id AND up.depth = node.depth - 1),
kids AS (SELECT parent AS prefix, count(*) AS n FROM tree WHERE depth > 0 GROUP BY parent),
own AS (SELECT tree.*, coalesce(kids.n, 0) AS n_children, CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * size AS saved FROM tree LEFT JOIN kids USING (prefix)),
sums AS (SELECT up.prefix, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM own JOIN named up ON up.member = own.conv_id AND up.depth <= own.depth GROUP BY up.prefix),
last AS (SELECT conv_id, max(depth) AS depth FROM path GROUP BY conv_id),
ends AS (SELECT prefix, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS digest FROM path JOIN last USING (conv_id, depth) GROUP BY prefix)
SELECT own.conv_id, own.depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM own JOIN sums USING (prefix) LEFT JOIN ends USING (prefix)
"""
