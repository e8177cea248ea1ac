"""Text similarity, retrieval, vectors, ranking metrics (H, I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cataloom.functions.text import tokenise, words
from cataloom.functions.vectors import cosine_dense as cosine_dense_of
from cataloom.operators import prepare, ranking, retrieval, similarity, vectors

from . import views, word_sql
from .registry import query, text_literal

# --- text similarity ----------------------------------------------------------------------


def _rouge_sql(n: int) -> str:
    gram = "t[i]" if n == 1 else "t[i] || ' ' || t[i + 1]"
    return (
        "WITH "
        + views.PAIRS_SQL
        + f""",
tokens AS (
  SELECT dataset_id AS pair_id, regexp_extract_all(lower(original_description), '[a-z0-9]+') AS r,
    regexp_extract_all(lower(generated_description), '[a-z0-9]+') AS c FROM text_pairs
),
sides AS (SELECT pair_id, 0 AS side, r AS t FROM tokens UNION ALL SELECT pair_id, 1, c FROM tokens),
grams AS (
  SELECT pair_id, side, {gram} AS gram FROM (
    SELECT pair_id, side, t, unnest(range(1, len(t) - {n} + 2)) AS i FROM sides)
),
counts AS (
  SELECT pair_id, gram, count(*) FILTER (WHERE side = 0) AS a, count(*) FILTER (WHERE side = 1) AS b
  FROM grams GROUP BY 1, 2
),
sums AS (SELECT pair_id, sum(least(a, b)) AS hits, sum(a) + sum(b) AS total FROM counts GROUP BY 1)
SELECT pair_id, round(coalesce(CASE WHEN hits > 0 THEN 2.0 * hits / total END, 0.0), 6) AS score
FROM tokens LEFT JOIN sums USING (pair_id)"""
    )


@query("rouge1", _rouge_sql(1))
def rouge1(spark, folder):
    pairs = views.score_pairs(views.text_pairs(spark, folder))
    return similarity.rouge_n(pairs, 1).select("pair_id", F.round("rouge1", 6).alias("score"))


@query("rouge2", _rouge_sql(2))
def rouge2(spark, folder):
    pairs = views.score_pairs(views.text_pairs(spark, folder))
    return similarity.rouge_n(pairs, 2).select("pair_id", F.round("rouge2", 6).alias("score"))


@query("rouge_stemmed", word_sql.ROUGE_STEMMED_SQL)
def rouge_stemmed(spark, folder):
    pairs = views.score_pairs(views.text_pairs(spark, folder))
    scored = similarity.rouge_n(similarity.rouge_n(pairs, 1, stemmed=True), 2, stemmed=True)
    return scored.select("pair_id", F.round("rouge1", 6).alias("rouge1"), F.round("rouge2", 6).alias("rouge2"))


# The table of common subsequences row by row: a cell is the greatest so far of the cell above and, where
# the words are equal, one more than the cell above and before.
LCS_SQL = """
RECURSIVE_TOKENS,
cell AS (SELECT pair_id, unnest(range(1, len(c) + 1)) AS j, unnest(c) AS word FROM tokens),
line AS (SELECT pair_id, unnest(range(1, len(r) + 1)) AS i, unnest(r) AS word FROM tokens),
grid(pair_id, i, j, best) AS (
  SELECT pair_id, 0::BIGINT, j, 0 FROM cell
  UNION ALL
  SELECT pair_id, i, j, max(found) OVER (PARTITION BY pair_id ORDER BY j) FROM (
    SELECT g.pair_id, g.i + 1 AS i, g.j,
      CASE WHEN cell.word = line.word THEN 1 + lag(g.best, 1, 0) OVER (PARTITION BY g.pair_id ORDER BY g.j) ELSE g.best END AS found
    FROM grid g JOIN line ON line.pair_id = g.pair_id AND line.i = g.i + 1 JOIN cell ON cell.pair_id = g.pair_id AND cell.j = g.j)
),
common AS (SELECT pair_id, max(best) AS lcs FROM grid GROUP BY pair_id)
SELECT pair_id, round(CASE WHEN lcs > 0 THEN 2.0 * lcs / (len(r) + len(c)) ELSE 0.0 END, 6) AS score
FROM tokens LEFT JOIN common USING (pair_id)"""

ROUGE_L_SQL = (
    "WITH RECURSIVE "
    + views.PAIRS_SQL
    + LCS_SQL.replace(
        "RECURSIVE_TOKENS",
        """, tokens AS (
  SELECT dataset_id AS pair_id, regexp_extract_all(lower(original_description), '[a-z0-9]+') AS r,
    regexp_extract_all(lower(generated_description), '[a-z0-9]+') AS c FROM text_pairs)""",
    )
)


@query("rougeL", ROUGE_L_SQL)
def rouge_l(spark, folder):
    pairs = views.score_pairs(views.text_pairs(spark, folder))
    return similarity.rouge_l(pairs).select("pair_id", F.round("rougeL", 6).alias("score"))


@query("meteor", word_sql.METEOR_SQL)
def meteor(spark, folder):
    pairs = views.score_pairs(views.text_pairs(spark, folder))
    return similarity.meteor(pairs).select("pair_id", F.round("meteor", 6).alias("score"))


@query("meteor_synonyms", word_sql.METEOR_SYNONYMS_SQL)
def meteor_synonyms(spark, folder):
    """METEOR with its third stage; words that begin alike are taken for synonyms."""
    pairs = views.score_pairs(views.text_pairs(spark, folder))
    terms = F.explode(F.array_union(words("reference"), words("candidate")))
    synsets = pairs.select(terms.alias("term")).distinct().withColumn("synset", F.left("term", F.lit(2)))
    return similarity.meteor(pairs, synsets).select("pair_id", F.round("meteor", 6).alias("score"))


@query(
    "similarity_report",
    _rouge_sql(1)
    .replace("SELECT pair_id, round(", "SELECT 'rouge1' AS metric, 'user' AS variant, round(avg(", 1)
    .replace(", 0.0), 6) AS score", ", 0.0)), 6) AS mean_score, count(*) AS n", 1),
)
def similarity_report(spark, folder):
    pairs = prepare.comparable_pairs(views.text_pairs(spark, folder))
    both = similarity.description_variants(
        pairs.withColumn("search_description", F.lit(None).cast("string"))
    )
    report = similarity.similarity_report(similarity.rouge_n(both, 1), ["rouge1"])
    return report.withColumn("mean_score", F.round("mean_score", 6))


@query("similarity_report_all", word_sql.REPORT_SQL)
def similarity_report_all(spark, folder):
    """Four stemmed metrics of user texts and, as search text, the answer with its title."""
    pairs = prepare.comparable_pairs(views.text_pairs(spark, folder))
    both = similarity.description_variants(
        pairs.withColumn(
            "search_description", F.concat_ws("\n", "generated_description", "title")
        )
    )
    report = similarity.similarity_report(similarity.all_metrics(both))
    return report.withColumn("mean_score", F.round("mean_score", 6))


# --- tokens and index ---------------------------------------------------------------------


def _token_sql(expression: str) -> str:
    return f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, CAST(len(list_distinct(t)) AS INTEGER) AS n_terms, md5(array_to_string(t, ' ')) AS digest
FROM (SELECT doc_id, {expression} AS t FROM documents)"""


WORDS_SQL = "list_filter(regexp_split_to_array(lower({0}), '[ \\t\\n\\r\\f\\v]+'), lambda t: t <> '')"
MARKS_SQL = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+|[^\\s\\p{{L}}\\p{{N}}_]')"
TERMS_SQL = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]{{2,}}')"


def _tokens(spark, folder, mode):
    return (
        views.table(spark, folder, "documents")
        .select("doc_id", tokenise(F.col("text"), mode).alias("t"))
        .select(
            "doc_id",
            F.size("t").alias("n_tokens"),
            F.size(F.array_distinct("t")).alias("n_terms"),
            F.md5(F.array_join("t", " ")).alias("digest"),
        )
    )


@query("tokenise_words", _token_sql(WORDS_SQL.format("text")))
def tokenise_words(spark, folder):
    return _tokens(spark, folder, "words")


@query("tokenise_words_and_marks", _token_sql(MARKS_SQL.format("text")))
def tokenise_words_and_marks(spark, folder):
    return _tokens(spark, folder, "words_and_marks")


@query("tokenise_vectoriser", _token_sql(TERMS_SQL.format("text")))
def tokenise_vectoriser(spark, folder):
    return _tokens(spark, folder, "vectoriser")


def _index_sql(tokens: str) -> str:
    """``postings, vocabulary, asked`` of the documents and queries; ``docs`` and ``queries`` exist."""
    return f""",
tokens AS (SELECT doc_id, doc_ord, {tokens.format("text")} AS t FROM docs),
postings AS (
  SELECT doc_id, doc_ord, len(t) AS doc_len, term, count(*) AS tf
  FROM (SELECT doc_id, doc_ord, t, unnest(t) AS term FROM tokens) GROUP BY ALL
),
vocabulary AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM postings GROUP BY term),
asked AS (
  SELECT query_id, term, count(*) AS qtf
  FROM (SELECT query_id, unnest({tokens.format("query_text")}) AS term FROM queries) GROUP BY ALL
),
size AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(len(t)) AS mean_len FROM tokens)"""


BM25_SQL = """,
idf AS (SELECT term, ln((n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) AS idf FROM vocabulary, size),
mean AS (SELECT avg(idf) AS mean_idf FROM idf),
hits AS (
  SELECT query_id, doc_id, doc_ord, sum(qtf * CASE WHEN idf < 0 THEN 0.25::DOUBLE * mean_idf ELSE idf END
    * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * doc_len / mean_len))) AS score
  FROM postings JOIN asked USING (term) JOIN idf USING (term), mean, size GROUP BY ALL
)"""

TFIDF_SQL = """,
idf AS (SELECT term, ln((1 + n) / (1 + df)) + 1 AS idf FROM vocabulary, size),
dw AS (SELECT doc_id, doc_ord, term, tf * idf AS w FROM postings JOIN idf USING (term)),
dn AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM dw GROUP BY 1),
qw AS (SELECT query_id, term, qtf * idf AS w FROM asked JOIN idf USING (term)),
qn AS (SELECT query_id, sqrt(sum(w * w)) AS norm FROM qw GROUP BY 1),
hits AS (
  SELECT query_id, doc_id, doc_ord, sum(dw.w * qw.w / dn.norm / qn.norm) AS score
  FROM dw JOIN qw USING (term) JOIN dn USING (doc_id) JOIN qn USING (query_id) GROUP BY ALL
)"""

# All documents score, those without a hit 0; ties keep collection order.
RANKED_SQL = """,
scored AS (
  SELECT q.query_id, d.doc_id, d.doc_ord, round(coalesce(h.score, 0.0), 9) AS score
  FROM queries q CROSS JOIN docs d LEFT JOIN hits h ON h.query_id = q.query_id AND h.doc_id = d.doc_id
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_ord) AS INTEGER) AS rank
  FROM scored
)"""

TOP_SQL = " SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10"


def _search_sql(kind: str, tokens: str) -> str:
    return "WITH " + views.DOCS_SQL + _index_sql(tokens) + kind + RANKED_SQL


def _documents(spark, folder, labelled=False):
    """Labels are joined only where relevances are asked for: the texts need not move for them."""
    return retrieval.search_documents(views.search_docs(spark, folder, labelled))


def _top(ranked):
    return ranked.select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


@query(
    "index_postings",
    "WITH "
    + views.DOCS_SQL
    + _index_sql(MARKS_SQL)
    + " SELECT doc_id, doc_len, count(*) AS n_terms, CAST(sum(tf) AS BIGINT) AS n_tokens FROM postings GROUP BY ALL",
)
def index_postings(spark, folder):
    postings = retrieval.index_documents(_documents(spark, folder)).postings
    return (
        postings.groupBy("doc_id", "doc_len")
        .agg(F.count(F.lit(1)).alias("n_terms"), F.sum("tf").alias("n_tokens"))
        .withColumn("doc_len", F.col("doc_len").cast("long"))
    )


@query(
    "index_vocabulary",
    "WITH "
    + views.DOCS_SQL
    + _index_sql(MARKS_SQL)
    + " SELECT term, df, CAST(cf AS BIGINT) AS cf FROM vocabulary",
)
def index_vocabulary(spark, folder):
    return retrieval.index_documents(_documents(spark, folder)).vocabulary


@query("bm25_top10", _search_sql(BM25_SQL, MARKS_SQL) + TOP_SQL)
def bm25_top10(spark, folder):
    return _top(
        retrieval.search(_documents(spark, folder), views.search_queries(spark, folder), "BM25")
    )


@query("tfidf_top10", _search_sql(TFIDF_SQL, TERMS_SQL) + TOP_SQL)
def tfidf_top10(spark, folder):
    return _top(
        retrieval.search(_documents(spark, folder), views.search_queries(spark, folder), "TFIDF")
    )


@query("bm25_stored_index", _search_sql(BM25_SQL, MARKS_SQL) + TOP_SQL)
def bm25_stored_index(spark, folder):
    """The same lists from an index that is clustered by term."""
    index = retrieval.store_index(_documents(spark, folder))
    return _top(retrieval.search(index, views.search_queries(spark, folder), "BM25"))


@query("tfidf_stored_index", _search_sql(TFIDF_SQL, TERMS_SQL) + TOP_SQL)
def tfidf_stored_index(spark, folder):
    index = retrieval.store_index(_documents(spark, folder), retrieval.VECTORISER)
    return _top(retrieval.search(index, views.search_queries(spark, folder), "TFIDF"))


@query(
    "bm25_zero_fill",
    "WITH "
    + views.DOCS_SQL.replace("text AS query_text FROM benchmark", "regexp_replace(text, '[aeiou]', '#', 'g') AS query_text FROM benchmark")
    + _index_sql(MARKS_SQL)
    + BM25_SQL
    + RANKED_SQL
    + TOP_SQL,
)
def bm25_zero_fill(spark, folder):
    """Queries without vowels meet few documents, so most of a list is filled."""
    queries = views.search_queries(spark, folder).withColumn(
        "query_text", F.regexp_replace("query_text", "[aeiou]", "#")
    )
    return _top(retrieval.search(_documents(spark, folder), queries, "BM25"))


# --- relevance and gains ------------------------------------------------------------------

LISTS_SQL = """,
ideal AS (SELECT qrel, row_number() OVER (ORDER BY qrel DESC, doc_ord) AS place FROM docs),
lists AS (
  SELECT r.query_id, r.rank, d.qrel AS rel, i.qrel AS ideal
  FROM ranked r JOIN docs d USING (doc_id) JOIN ideal i ON i.place = r.rank WHERE r.rank <= 10
)"""

NDCG_SQL = """ SELECT query_id, round(dcg, 6) AS dcg, round(ideal_dcg, 6) AS ideal_dcg,
  round(CASE WHEN ideal_dcg > 0 THEN dcg / ideal_dcg ELSE 0.0 END, 6) AS ndcg
FROM (SELECT query_id, sum((pow(2, rel) - 1) / log2(rank + 1)) AS dcg, sum((pow(2, ideal) - 1) / log2(rank + 1)) AS ideal_dcg
  FROM lists GROUP BY query_id)"""


def _lists(spark, folder):
    ranked = retrieval.search(_documents(spark, folder), views.search_queries(spark, folder), "BM25")
    return retrieval.relevance_lists(ranked, _documents(spark, folder, labelled=True))


@query(
    "relevance_lists",
    _search_sql(BM25_SQL, MARKS_SQL) + LISTS_SQL + " SELECT query_id, rank, rel, ideal FROM lists",
)
def relevance_lists(spark, folder):
    return _lists(spark, folder)


@query("search_ndcg", _search_sql(BM25_SQL, MARKS_SQL) + LISTS_SQL + NDCG_SQL)
def search_ndcg(spark, folder):
    """BM25 over all documents, nDCG@10 per query: the flagship."""
    scores = ranking.ndcg(_lists(spark, folder), ["query_id"], 10)
    return scores.select(
        "query_id", *[F.round(c, 6).alias(c) for c in ("dcg", "ideal_dcg", "ndcg")]
    )


# Lists by conversation: the length class of each turn is its gain, the turn its rank.
GAINS_SQL = """
WITH lists AS (
  SELECT conv_id, turn + 1 AS rank, CASE WHEN length(text) > 400 THEN 2 WHEN length(text) > 100 THEN 1 ELSE 0 END AS rel
  FROM conversations)
"""


def _gain_lists(spark, folder):
    size = F.length("text")
    return views.table(spark, folder, "conversations").select(
        "conv_id",
        (F.col("turn") + 1).alias("rank"),
        F.when(size > 400, 2).when(size > 100, 1).otherwise(0).alias("rel"),
    )


@query(
    "dcg_exp",
    GAINS_SQL
    + "SELECT conv_id, round(coalesce(sum((pow(2, rel) - 1) / log2(rank + 1)) FILTER (WHERE rank <= 5), 0.0), 6) AS dcg FROM lists GROUP BY conv_id",
)
def dcg_exp(spark, folder):
    return ranking.dcg(_gain_lists(spark, folder), ["conv_id"], 5).withColumn(
        "dcg", F.round("dcg", 6)
    )


@query(
    "ndcg_exp",
    GAINS_SQL
    + """SELECT conv_id, round(CASE WHEN i > 0 THEN d / i ELSE 0.0 END, 6) AS ndcg FROM (
  SELECT conv_id, sum((pow(2, rel) - 1) / log2(rank + 1)) FILTER (WHERE rank <= 5) AS d,
    sum((pow(2, rel) - 1) / log2(place + 1)) FILTER (WHERE place <= 5) AS i
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY rel DESC, rank) AS place FROM lists) GROUP BY conv_id)""",
)
def ndcg_exp(spark, folder):
    """The ideal list of a conversation is its own gains in falling order."""
    lists = _gain_lists(spark, folder)
    ideal = retrieval.top_ranked(
        lists, ["conv_id"], [F.col("rel").desc(), F.col("rank")], 5, "place"
    ).select("conv_id", F.col("place").alias("rank"), F.col("rel").alias("ideal"))
    both = lists.join(ideal.withColumn("rank", F.col("rank").cast("long")), ["conv_id", "rank"], "left")
    return ranking.ndcg(both, ["conv_id"], 5).select("conv_id", F.round("ndcg", 6).alias("ndcg"))


@query(
    "ndcg_linear_at_ks",
    _search_sql(BM25_SQL, WORDS_SQL)
    + LISTS_SQL
    + """, ks AS (SELECT unnest([1, 5, 10]) AS k)
SELECT query_id, CAST(k AS INTEGER) AS k, round(sum(rel / log2(rank + 1)) / nullif(sum(ideal / log2(rank + 1)), 0), 6) AS ndcg
FROM lists JOIN ks ON rank <= k GROUP BY ALL""",
)
def ndcg_linear_at_ks(spark, folder):
    scores = ranking.ndcg_linear_at_ks(
        _documents(spark, folder, labelled=True), views.search_queries(spark, folder), [1, 5, 10]
    )
    return scores.withColumn("ndcg", F.round("ndcg", 6))


# The eight fixed queries, and keyword queries in words of the corpus.
KEYWORDS = {
    **ranking.KEYWORD_QUERIES,
    "english function words": ["the", "and", "with"],
    "german articles": ["der", "die", "das"],
    "french articles": ["les", "une", "dans"],
    "rare endings": ["ingthe", "heit", "eaux", "ción"],
    "nothing": ["qqqq"],
}

TEXTS_SQL = """
texts AS (
  SELECT 'generated' AS variant, dataset_id AS text_ord, generated_description AS text FROM text_pairs
  UNION ALL SELECT 'search', dataset_id, generated_description || chr(10) || title FROM text_pairs
  UNION ALL SELECT 'original', dataset_id, original_description FROM text_pairs
)"""


def _keyword_sql() -> str:
    rows = ", ".join(
        f"({text_literal(name)}, [{', '.join(text_literal(w) for w in words)}])"
        for name, words in KEYWORDS.items()
    )
    return (
        "WITH "
        + views.PAIRS_SQL
        + ","
        + TEXTS_SQL
        + f""",
asked(query, keywords) AS (VALUES {rows}),
hits AS (
  SELECT variant, query, text_ord, len(list_filter(keywords, lambda w: contains(lower(text), w))) AS hits
  FROM texts CROSS JOIN asked
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY variant, query ORDER BY text_ord) AS rank,
    row_number() OVER (PARTITION BY variant, query ORDER BY hits DESC) AS place FROM hits
),
scores AS (
  SELECT variant, query, CASE WHEN i > 0 THEN d / i ELSE 0.0 END AS ndcg FROM (
    SELECT variant, query, sum(hits / log2(rank + 1)) FILTER (WHERE rank <= 10) AS d,
      sum(hits / log2(place + 1)) FILTER (WHERE place <= 10) AS i FROM placed GROUP BY ALL)
)"""
    )


def _texts(spark, folder):
    pairs = views.text_pairs(spark, folder).withColumn(
        "search_description", F.concat_ws("\n", "generated_description", "title")
    )
    return ranking.text_variants(pairs)


@query("keyword_hit_ndcg", _keyword_sql() + " SELECT variant, query, round(ndcg, 6) AS ndcg FROM scores")
def keyword_hit_ndcg(spark, folder):
    return ranking.keyword_hit_ndcg(_texts(spark, folder), KEYWORDS).withColumn(
        "ndcg", F.round("ndcg", 6)
    )


@query(
    "retrieval_report",
    _keyword_sql()
    + """, both_rows AS (SELECT query, variant, ndcg FROM scores UNION ALL SELECT 'Average', variant, ndcg FROM scores)
SELECT query, round(avg(ndcg) FILTER (WHERE variant = 'generated'), 6) AS generated,
  round(avg(ndcg) FILTER (WHERE variant = 'search'), 6) AS search,
  round(avg(ndcg) FILTER (WHERE variant = 'original'), 6) AS original FROM both_rows GROUP BY query""",
)
def retrieval_report(spark, folder):
    report = ranking.retrieval_report(_texts(spark, folder), KEYWORDS)
    return report.select(
        "query", *[F.round(v, 6).alias(v) for v in ranking.TEXT_VARIANTS]
    )


@query(
    "average_metrics",
    """SELECT event_type AS metric, round(avg(value) FILTER (WHERE hour(ts) < 12), 6) AS morning,
  round(avg(value) FILTER (WHERE hour(ts) >= 12), 6) AS evening FROM events GROUP BY 1""",
)
def average_metrics(spark, folder):
    """Event values stand for scores: metric = kind of event, version = half of the day."""
    scores = views.table(spark, folder, "events").select(
        F.col("event_type").alias("metric"),
        F.when(F.hour("ts") < 12, "morning").otherwise("evening").alias("version"),
        F.col("value").alias("score"),
    )
    means = ranking.average_metrics(scores, ["morning", "evening"])
    return means.select("metric", F.round("morning", 6).alias("morning"), F.round("evening", 6).alias("evening"))


# --- vectors ------------------------------------------------------------------------------


@query(
    "cosine_dense",
    """SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS score
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def cosine_dense(spark, folder):
    """Every vector with the next one."""
    a = views.table(spark, folder, "embeddings").select("vec_id", "embedding")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return a.join(b, "vec_id").select(
        "vec_id", F.round(cosine_dense_of(F.col("embedding"), F.col("other")), 6).alias("score")
    )


@query(
    "cosine_sparse",
    "WITH "
    + views.VECTORS_SQL
    + """ SELECT a.vec_id, round(list_cosine_similarity(a.sparse, b.sparse), 6) AS score
FROM vectors a JOIN vectors b ON b.vec_id = a.vec_id + 1""",
)
def cosine_sparse(spark, folder):
    a = views.sparse_vectors(spark, folder).select(F.col("doc_id").alias("vec_id"), "sparse")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("sparse").alias("other"))
    return a.join(b, "vec_id").select(
        "vec_id", F.round(vectors.cosine_sparse(F.col("sparse"), F.col("other")), 6).alias("score")
    )


VECTOR_RANKED_SQL = """,
chosen AS (SELECT label, min(vec_id) AS query_id FROM vectors GROUP BY label),
ranked AS (
  SELECT q.query_id, q.label AS q_label, d.vec_id AS doc_id, d.label, score,
    CAST(row_number() OVER (PARTITION BY q.query_id ORDER BY score DESC, d.vec_id) AS INTEGER) AS rank
  FROM (SELECT v.vec_id AS query_id, v.label, v.sparse FROM vectors v JOIN chosen c ON c.query_id = v.vec_id) q
  CROSS JOIN vectors d, LATERAL (SELECT round(list_cosine_similarity(q.sparse, d.sparse), 9) AS score)
)"""


def _vector_ranked(spark, folder, size=10):
    """One query vector per label, the first of its label, against all vectors."""
    docs = views.sparse_vectors(spark, folder)
    asked = docs.groupBy("label").agg(
        F.min("doc_id").alias("query_id"),
        F.min_by("indices", "doc_id").alias("indices"),
        F.min_by("values", "doc_id").alias("values"),
    )
    return vectors.vector_search(asked, docs, size)


@query(
    "vector_search",
    "WITH "
    + views.VECTORS_SQL
    + VECTOR_RANKED_SQL
    + " SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 10",
)
def vector_search(spark, folder):
    return _top(_vector_ranked(spark, folder))


@query(
    "vector_search_ndcg",
    "WITH "
    + views.VECTORS_SQL
    + VECTOR_RANKED_SQL
    + """ SELECT query_id, round(sum(CASE WHEN label = q_label THEN 1 / log2(rank + 1) ELSE 0 END), 6) AS dcg
FROM ranked WHERE rank <= 10 GROUP BY query_id""",
)
def vector_search_ndcg(spark, folder):
    """Gain 1 for a found vector with the label of the query."""
    labels = views.table(spark, folder, "embeddings").select(F.col("vec_id"), "label")
    found = _vector_ranked(spark, folder)
    same = (
        found.join(labels.withColumnRenamed("vec_id", "doc_id"), "doc_id")
        .join(
            labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("wanted")),
            "query_id",
        )
        .withColumn("rel", (F.col("label") == F.col("wanted")).cast("double"))
    )
    return ranking.dcg(same, ["query_id"], 10).withColumn("dcg", F.round("dcg", 6))
