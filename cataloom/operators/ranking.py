"""Gain metrics over ranked lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_text
from .joins import top_ranked
from .retrieval import bm25_scores, relevance_lists, scan_index, top_k


def gain_exp(rel: Column, rank: Column) -> Column:
    """``(2^rel - 1) / log2(rank + 1)`` for 1-based ranks."""
    return (F.pow(F.lit(2.0), rel) - 1) / F.log2(rank.cast("double") + 1)


def gain_linear(rel: Column, rank: Column) -> Column:
    """``rel / log2(rank + 1)`` for 1-based ranks."""
    return rel / F.log2(rank.cast("double") + 1)


def dcg(ranked: DataFrame, by: list[str], p: int, gain=gain_exp, rel: str = "rel") -> DataFrame:
    """Discounted cumulative gain of the first ``p`` rows of every list."""
    part = gain(F.col(rel).cast("double"), F.col("rank"))
    return (
        ranked.groupBy(*by).agg(
            F.coalesce(F.sum(F.when(F.col("rank") <= p, part)), F.lit(0.0)).alias("dcg")
        )
    )


def ndcg(lists: DataFrame, by: list[str], p: int, gain=gain_exp, zero=0.0) -> DataFrame:
    """DCG of ``rel`` over DCG of ``ideal``; ``zero`` when the ideal is 0."""

    def total(rel: str) -> Column:
        part = gain(F.col(rel).cast("double"), F.col("rank"))
        return F.coalesce(F.sum(F.when(F.col("rank") <= p, part)), F.lit(0.0))

    sums = lists.groupBy(*by).agg(total("rel").alias("dcg"), total("ideal").alias("ideal_dcg"))
    return sums.withColumn(
        "ndcg",
        F.when(F.col("ideal_dcg") > 0, F.col("dcg") / F.col("ideal_dcg")).otherwise(
            F.lit(zero).cast("double")
        ),
    )


def ndcg_linear_at_ks(documents: DataFrame, queries: DataFrame, ks: list[int]) -> DataFrame:
    """BM25 ranking with white-space tokens and linear gain: ``(query_id, k, ndcg)``.

    Only the best ``max(ks)`` documents matter.  Sums stop at the end of the collection, and the
    value is null when nothing is relevant.
    """
    size = max(ks)
    index = scan_index(documents, "words")
    ranked = top_k(bm25_scores(index, queries, zero_fill=size), size)
    lists = relevance_lists(ranked, documents, size)
    rel, ideal = (
        gain_linear(F.col(c).cast("double"), F.col("rank")) for c in ("rel", "ideal")
    )
    sums = []
    for k in ks:
        inside = F.col("rank") <= k
        sums += [
            F.sum(F.when(inside, rel)).alias(f"d{k}"),
            F.sum(F.when(inside, ideal)).alias(f"i{k}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("k"),
                F.when(F.col(f"i{k}") > 0, F.col(f"d{k}") / F.col(f"i{k}")).alias("ndcg"),
            )
            for k in ks
        ]
    )
    return (
        lists.groupBy("query_id")
        .agg(*sums)
        .select("query_id", F.explode(rows).alias("m"))
        .select("query_id", "m.*")
    )


def keyword_hits(text: Column, keywords: list[str]) -> Column:
    """Number of keywords that occur in the lower-cased text."""
    lowered = F.lower(F.coalesce(text, F.lit("none")))
    hits = F.lit(0)
    for keyword in keywords:
        hits = hits + lowered.contains(keyword).cast("int")
    return hits


def keyword_hit_ndcg(
    texts: DataFrame, queries: dict[str, list[str]], k: int = 10
) -> DataFrame:
    """``(variant, query, ndcg)`` of texts ``(variant, text_ord, text)`` in table order.

    The list as it stands is the first ``k`` rows in ``text_ord``, not a ranking.  The best
    possible order depends only on how many texts have how many hits, so it comes from counts
    and no text is sorted.
    """
    per_query = F.array(
        *[
            F.struct(F.lit(name).alias("query"), keyword_hits(F.col("text"), words).alias("hits"))
            for name, words in queries.items()
        ]
    )
    scored = texts.select("variant", "text_ord", F.explode(per_query).alias("q")).select(
        "variant", "text_ord", "q.query", "q.hits"
    )
    # Rows needed for the actual order: the k lowest orders of every variant and query.
    first = top_ranked(scored, ["variant", "query"], [F.col("text_ord")], k, "rank")
    actual = first.groupBy("variant", "query").agg(
        F.sum(gain_linear(F.col("hits").cast("double"), F.col("rank"))).alias("dcg")
    )

    # The ideal list holds, from the most hits down, as many texts as there are.
    counts = scored.groupBy("variant", "query", "hits").agg(F.count(F.lit(1)).alias("n"))
    most = max((len(w) for w in queries.values()), default=0)
    level = [F.coalesce(F.max(F.when(F.col("hits") == h, F.col("n"))), F.lit(0)) for h in range(most + 1)]
    histogram = counts.groupBy("variant", "query").agg(
        *[c.alias(f"n{h}") for h, c in enumerate(level)]
    )
    best = F.lit(0.0)
    for place in range(1, k + 1):
        value = F.lit(0)
        taken = F.lit(0)
        chosen = None
        for h in range(most, -1, -1):
            taken = taken + F.col(f"n{h}")
            chosen = (
                F.when(taken >= place, h) if chosen is None else chosen.when(taken >= place, h)
            )
        value = chosen.otherwise(0)
        best = best + gain_linear(value.cast("double"), F.lit(place))
    ideal = histogram.select("variant", "query", best.alias("ideal_dcg"))
    return actual.join(ideal, ["variant", "query"]).select(
        "variant",
        "query",
        F.when(F.col("ideal_dcg") > 0, F.col("dcg") / F.col("ideal_dcg"))
        .otherwise(F.lit(0.0))
        .alias("ndcg"),
    )


# The eight test queries with their keywords.
KEYWORD_QUERIES = {
    "shooting incidents NYC": ["shooting", "offender", "victim", "crime"],
    "NYC parking violations": ["parking", "violation", "fiscal"],
    "flood sensor data": ["flood", "sensor", "floodnet"],
    "bicycle pedestrian counts": ["bicycle", "pedestrian", "count"],
    "COVID hospitalization rates": ["covid", "hospitalization", "monthly"],
    "electric vehicle population": ["electric", "vehicle", "population"],
    "chronic disease indicators": ["chronic", "disease", "behavioral"],
    "motor vehicle collisions": ["collision", "crash", "vehicle"],
}

TEXT_VARIANTS = ["generated", "search", "original"]


def text_variants(df: DataFrame, order: str = "dataset_id") -> DataFrame:
    """``(variant, text_ord, text)``: generated and search texts of successes, all originals."""
    good = F.col("generation_status") == "success"
    found = F.array_compact(
        F.array(
            F.when(
                good, F.struct(F.lit("generated").alias("variant"), F.col("generated_description").alias("text"))
            ),
            F.when(
                good & F.col("search_description").isNotNull(),
                F.struct(F.lit("search").alias("variant"), F.col("search_description").alias("text")),
            ),
            F.when(
                F.col("original_description").isNotNull(),
                F.struct(F.lit("original").alias("variant"), F.col("original_description").alias("text")),
            ),
        )
    )
    return df.select(F.col(order).alias("text_ord"), F.explode(found).alias("v")).select(
        "v.variant", "text_ord", "v.text"
    )


def retrieval_report(
    texts: DataFrame, queries: dict[str, list[str]], k: int = 10
) -> DataFrame:
    """Per query the score of every text variant, and one row ``Average``."""
    scores = keyword_hit_ndcg(texts, queries, k)
    both = scores.withColumn(
        "query", F.explode(F.array(F.col("query"), F.lit("Average")))
    )
    return both.groupBy("query").pivot("variant", TEXT_VARIANTS).agg(F.avg("ndcg"))


def average_metrics(scores: DataFrame, versions: list[str]) -> DataFrame:
    """Mean of ``score`` by metric, one column per ``version``."""
    return scores.groupBy("metric").pivot("version", versions).agg(F.avg("score"))
