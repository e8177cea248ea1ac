"""Text similarity of pairs ``(pair_id, reference, candidate)``.

ROUGE-1 and ROUGE-2 are native and stay inside the row: occurrences are numbered, so that the
clipped overlap is the size of a set intersection.  ROUGE-L and METEOR need an order-dependent
alignment of two token lists and run as Arrow UDFs, one pair at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stem import stem
from ..functions.text import let, ngrams, numbered, rouge_tokens, words
from .joins import lookup_join

# METEOR weights, and the token length from which ROUGE stems.
ALPHA, BETA, GAMMA = 0.9, 3.0, 0.5
STEM_LONGER_THAN = 3

METRICS = ["rouge1", "rouge2", "rougeL", "meteor"]

# Rows of an Arrow batch that are Python objects at a time.
BATCH_ROWS = 200


def by_rows(function: Callable, kind: pa.DataType, *columns: pa.Array) -> pa.Array:
    """``function`` of each row's values.

    Token lists take many times their Arrow size as Python objects, and a batch has thousands of rows; only
    ``BATCH_ROWS`` of them are unpacked together, so a worker's memory does not grow with the batch.
    """
    starts = range(0, len(columns[0]), BATCH_ROWS)
    parts = (zip(*(c.slice(i, BATCH_ROWS).to_pylist() for c in columns), strict=True) for i in starts)
    made = [pa.array([function(*row) for row in rows], kind) for rows in parts]
    return pa.concat_arrays(made) if made else pa.array([], kind)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _stemmed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    known: dict[str, str] = {}

    def short(token: str) -> str:
        if len(token) <= STEM_LONGER_THAN:
            return token
        if token not in known:
            if len(known) > 500_000:
                known.clear()
            known[token] = stem(token)
        return known[token]

    for batch in batches:
        yield by_rows(lambda row: None if row is None else [short(t) for t in row], pa.list_(pa.string()), batch)


def _tokens(text: Column, stemmed: bool, unicode: bool) -> Column:
    tokens = rouge_tokens(text, unicode)
    return _stemmed(tokens) if stemmed else tokens


def f_measure(hits: Column, n_reference: Column, n_candidate: Column) -> Column:
    """Harmonic mean of hits/candidate and hits/reference, 0 without hits."""
    total = (n_reference + n_candidate).cast("double")
    return F.when(hits > 0, 2.0 * hits.cast("double") / total).otherwise(F.lit(0.0))


def _overlap(a: Column, b: Column) -> Column:
    return f_measure(
        F.size(F.array_intersect(numbered(a), numbered(b))), F.size(a), F.size(b)
    )


def rouge_n(
    pairs: DataFrame, n: int = 1, stemmed: bool = False, unicode: bool = False
) -> DataFrame:
    """Add ``rouge{n}``, the F-measure of clipped n-gram counts; null when a text is null."""
    score = let(
        F.struct(F.col("_r").alias("a"), F.col("_c").alias("b")),
        lambda x: _overlap(x["a"], x["b"]),
    )
    return (
        pairs.withColumn("_r", ngrams(_tokens(F.col("reference"), stemmed, unicode), n))
        .withColumn("_c", ngrams(_tokens(F.col("candidate"), stemmed, unicode), n))
        .withColumn(
            f"rouge{n}",
            F.when(F.col("reference").isNotNull() & F.col("candidate").isNotNull(), score),
        )
        .drop("_r", "_c")
    )


def lcs_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, with one bit per token of ``a``."""
    if len(a) == 0 or len(b) == 0:
        return 0
    places: dict[str, int] = {}
    for i, token in enumerate(a):
        places[token] = places.get(token, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    for token in b:
        matched = open_bits & places.get(token, 0)
        open_bits = ((open_bits + matched) | (open_bits - matched)) & full
    return len(a) - open_bits.bit_count()


@F.arrow_udf(T.IntegerType())
def _lcs(left: pa.Array, right: pa.Array) -> pa.Array:
    return by_rows(lambda a, b: None if a is None or b is None else lcs_length(a, b), pa.int32(), left, right)


def rouge_l(pairs: DataFrame, stemmed: bool = False, unicode: bool = False) -> DataFrame:
    """Add ``rougeL``, the F-measure of the longest common subsequence."""
    r, c = F.col("_r"), F.col("_c")
    return (
        pairs.withColumn("_r", _tokens(F.col("reference"), stemmed, unicode))
        .withColumn("_c", _tokens(F.col("candidate"), stemmed, unicode))
        .withColumn("_lcs", _lcs(r, c))
        .withColumn(
            "rougeL",
            F.when(F.col("_lcs").isNotNull(), f_measure(F.col("_lcs"), F.size(r), F.size(c))),
        )
        .drop("_r", "_c", "_lcs")
    )


def meteor_score(reference: list[str], candidate: list[str], groups: dict[str, set] | None) -> float:
    """Exact, then stem, then synonym matches; candidate words are served from the last."""
    left = list(enumerate(candidate))
    right = list(enumerate(reference))
    matches: list[tuple[int, int]] = []

    def align(keys_of) -> None:
        nonlocal left, right
        waiting: dict[str, list[int]] = {}
        for j, word in right:
            for key in keys_of(word):
                waiting.setdefault(key, []).append(j)
        used: set[int] = set()
        rest: list[tuple[int, str]] = []
        for i, word in reversed(left):
            best = -1
            for key in keys_of(word):
                stack = waiting.get(key, [])
                while stack and stack[-1] in used:
                    stack.pop()
                if stack:
                    best = max(best, stack[-1])
            if best < 0:
                rest.append((i, word))
            else:
                used.add(best)
                matches.append((i, best))
        left = rest[::-1]
        right = [(j, word) for j, word in right if j not in used]

    align(lambda word: (word,))
    align(lambda word: (stem(word),))
    if groups:
        align(lambda word: sorted(groups.get(word, ())))
    if not matches:
        return 0.0
    matches.sort()
    chunks = 1 + sum(
        not (b[0] == a[0] + 1 and b[1] == a[1] + 1)
        for a, b in zip(matches, matches[1:], strict=False)
    )
    precision, recall = len(matches) / len(candidate), len(matches) / len(reference)
    mean = precision * recall / (ALPHA * precision + (1 - ALPHA) * recall)
    return (1 - GAMMA * (chunks / len(matches)) ** BETA) * mean


@F.arrow_udf(T.DoubleType())
def _meteor(reference: pa.Array, candidate: pa.Array) -> pa.Array:
    return by_rows(lambda a, b: None if a is None or b is None else meteor_score(a, b, None), pa.float64(), reference, candidate)


@F.arrow_udf(T.DoubleType())
def _meteor_synonyms(reference: pa.Array, candidate: pa.Array, groups: pa.Array) -> pa.Array:
    def score(a: list[str] | None, b: list[str] | None, found: list[dict] | None) -> float | None:
        if a is None or b is None:
            return None
        by_word: dict[str, set] = {}
        for item in found or []:
            by_word.setdefault(item["term"], set()).add(item["synset"])
        return meteor_score(a, b, by_word)

    return by_rows(score, pa.float64(), reference, candidate, groups)


def meteor(pairs: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """Add ``meteor`` over lower-cased white-space tokens.

    Stages: exact, stem, and with a ``(term, synset)`` table also shared synsets.
    """
    prepared = pairs.withColumn("_r", words(F.col("reference"))).withColumn(
        "_c", words(F.col("candidate"))
    )
    if synonyms is None:
        return prepared.withColumn("meteor", _meteor("_r", "_c")).drop("_r", "_c")
    terms = prepared.select(
        "pair_id", F.explode(F.array_distinct(F.concat("_r", "_c"))).alias("term")
    )
    groups = (
        lookup_join(terms, synonyms.select("term", "synset").distinct(), ["term"], "pair_id")
        .groupBy("pair_id")
        .agg(F.collect_list(F.struct("term", "synset")).alias("_groups"))
    )
    return (
        prepared.join(groups, "pair_id", "left")
        .withColumn("meteor", _meteor_synonyms("_r", "_c", "_groups"))
        .drop("_r", "_c", "_groups")
    )


def all_metrics(pairs: DataFrame, stemmed: bool = True) -> DataFrame:
    """The four scores per pair."""
    scored = rouge_n(rouge_n(pairs, 1, stemmed), 2, stemmed)
    return meteor(rouge_l(scored, stemmed))


def similarity_report(scores: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Mean and number of scores per (metric, variant) from a table with a ``variant`` column."""
    metrics = metrics or [m for m in METRICS if m in scores.columns]
    long = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("score")) for m in metrics]
    )
    return (
        scores.select("variant", F.explode(long).alias("s"))
        .select("variant", "s.*")
        .groupBy("metric", "variant")
        .agg(F.avg("score").alias("mean_score"), F.count("score").alias("n"))
    )


def description_variants(df: DataFrame) -> DataFrame:
    """Pairs of the original with the user text and, where visible, the search text."""
    variants = F.array(
        F.struct(F.lit("user").alias("variant"), F.col("generated_description").alias("candidate")),
        F.struct(F.lit("search").alias("variant"), F.col("search_description").alias("candidate")),
    )
    return (
        df.select("dataset_id", "original_description", F.explode(variants).alias("v"))
        .select(
            F.concat_ws("|", "dataset_id", "v.variant").alias("pair_id"),
            "dataset_id",
            "v.variant",
            F.col("original_description").alias("reference"),
            "v.candidate",
        )
        .filter((F.col("variant") == "user") | (F.trim("candidate") != ""))
    )
