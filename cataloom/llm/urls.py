"""URL filter: rules, and for the rest a ratio of two character language models.

Hosts and paths come from the URL by pattern; the longest rule that fits decides.  URLs that no rule
decides are scored by two smoothed variable-order Markov models of characters, one learned from the
URLs that rules accept, one from those that rules reject.  A model's probability of a character mixes
all orders from 0 to ``order``: each order's count is smoothed by ``strength`` virtual characters that
are spread as the next shorter order says.  The score is the difference of
the mean log-likelihoods per character; the threshold is calibrated on rule-decided URLs that were
kept out of the counts.

The models are one table of exact counts of (order, context, character) that grows with the URLs.  The
URLs to score are joined with it by their distinct grams (a character and the ``order`` characters before
it), and the logarithms are summed per distinct URL.  A table that is measured to be small is broadcast.

A null URL or one without ``://`` has an empty host and path, fits no rule and gets ``default``, as do
all undecided URLs when one of the two classes has nothing to learn from.  Repeated rows count as often
as they occur; null ids are kept; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import fits_broadcast
from . import spans as S
from .common import text_key, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str]
RULES: Sequence[Rule] = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)


@dataclass(frozen=True)
class Settings:
    order: int = 4
    slots: int = 1 << 16  # of no effect: counts are exact
    held_out: int = 5
    bins: int = 4000
    span: float = 20.0
    strength: float = 2.0
    default: str = "allow"


def _behind_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_behind_scheme(url), "^[^/?#]*+", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_behind_scheme(url), "^[^/?#]*+([^?#]*+)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(verdict, rule) of the longest rule that fits host or parent domain and the path's start."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(out)
    return out


def _grams(url: Column, order: int) -> Column:
    """(context, character) of each character and of the end, whose character is empty.

    A context of fewer than ``order`` characters begins with the URL.
    """
    at = lambda c, i: F.struct(
        F.array_join(F.slice(c, F.greatest(i - order, F.lit(1)), F.least(i - 1, F.lit(order))), "").alias("context"),
        F.coalesce(F.get(c, i - 1), F.lit("")).alias("character"),
    )
    characters = F.regexp_extract_all(url, F.lit("(?s)."), F.lit(0))
    return S.let(characters, lambda c: F.transform(F.sequence(F.lit(1), F.size(c) + 1), lambda i: at(c, i)))


def _keys(gram: Column, order: int) -> Column:
    """What a gram counts for in each order: part 0 the (context, character), part 1 the context."""
    return F.array(
        *[
            F.struct(
                F.lit(part).alias("part"),
                F.lit(k).alias("order"),
                F.right(gram["context"], F.lit(k)).alias("context"),
                (gram["character"] if part == 0 else F.lit("")).alias("character"),
            )
            for k in range(order + 1)
            for part in (0, 1)
        ]
    )


def counted(urls: DataFrame, settings: Settings) -> DataFrame:
    """(label, url) -> (key, n0, n1), exact counts of each label, counted in each task and then over all."""
    sums = [F.sum(f"n{label}").alias(f"n{label}") for label in (0, 1)]
    ones = [(F.col("label") == label).cast("long").alias(f"n{label}") for label in (0, 1)]
    grams = urls.select(F.explode(_grams(F.col("url"), settings.order)).alias("gram"), *ones).groupBy("gram").agg(*sums)
    return grams.select(F.explode(_keys(F.col("gram"), settings.order)).alias("key"), "n0", "n1").groupBy("key").agg(*sums)


def _looked_up(big: DataFrame, small: DataFrame, on: str) -> DataFrame:
    """``big`` with the columns of the written table ``small``, which has each key once."""
    return big.join(F.broadcast(small) if fits_broadcast(small) else small, on)


def _logarithms(grams: DataFrame, counts: DataFrame, settings: Settings) -> DataFrame:
    """(gram, log0, log1) of distinct grams: the log-likelihood of the character under each model."""
    found = _looked_up(grams.select("gram", F.explode(_keys(F.col("gram"), settings.order)).alias("key")), counts, "key")
    number = lambda part, k, label: F.sum(F.when((F.col("key.part") == part) & (F.col("key.order") == k), F.col(f"n{label}")).otherwise(0)).alias(f"n{part}{k}{label}")
    orders = range(settings.order + 1)
    # The context of order 0 is found for every gram.
    sums = found.groupBy("gram").agg(*[number(part, k, label) for part in (0, 1) for k in orders for label in (0, 1)])
    logs = []
    for label in (0, 1):
        chance = F.lit(1 / 256)
        for k in orders:
            chance = (F.col(f"n0{k}{label}") + settings.strength * chance) / (F.col(f"n1{k}{label}") + settings.strength)
        logs.append(F.ln(chance).alias(f"log{label}"))
    return sums.select("gram", *logs)


def mean_log_likelihoods(urls: DataFrame, counts: DataFrame, settings: Settings) -> DataFrame:
    """(key, mean0, mean1) of each distinct ``url``, per character under each model; ``key`` is its text_key."""
    places = urls.select("url").distinct().select(text_key(F.col("url")).alias("key"), F.explode(_grams(F.col("url"), settings.order)).alias("gram"))
    logs = written(_logarithms(places.select("gram").distinct(), counts, settings), "url-grams")
    return _looked_up(places, logs, "gram").groupBy("key").agg(F.avg("log0").alias("mean0"), F.avg("log1").alias("mean1"))


@dataclass
class Model:
    """One label's model in the table of counts."""

    counts: DataFrame
    label: int

    def mean_log_likelihoods(self, urls: list[str], settings: Settings) -> np.ndarray:
        """For a few URLs; ``judged`` joins tables."""
        rows = self.counts.sparkSession.createDataFrame(list(enumerate(urls)), "i long, url string").withColumn("key", text_key(F.col("url")))
        found = rows.join(mean_log_likelihoods(rows, self.counts, settings), "key").select("i", f"mean{self.label}").collect()
        return np.array([value for _, value in sorted(map(tuple, found))])


def train(urls: DataFrame, settings: Settings) -> list[Model] | None:
    """Models of label 0 and 1 from (label, url); None when a label has no URL."""
    counts = written(counted(urls, settings), "url-counts")
    every = counts.filter("key.part = 1 and key.order = 0").first()
    if every is None or not (every["n0"] and every["n1"]):
        return None
    return [Model(counts, label) for label in (0, 1)]


def scored(urls: DataFrame, models: list[Model], settings: Settings) -> DataFrame:
    """``urls`` with ``score``: how much likelier a character is under model 1 than under model 0."""
    keyed = urls.withColumn("key", text_key(F.col("url")))
    means = written(mean_log_likelihoods(urls, models[0].counts, settings), "url-means")
    return _looked_up(keyed, means, "key").withColumn("score", F.col("mean1") - F.col("mean0")).drop("key", "mean0", "mean1")


def threshold(held: DataFrame, settings: Settings) -> float:
    """The score that best parts (label, score) by balanced accuracy; 0 when a label is missing."""
    place = F.floor((F.col("score") + settings.span) / (2 * settings.span) * settings.bins)
    bounded = F.greatest(F.lit(0), F.least(F.lit(settings.bins - 1), place)).alias("bin")
    rows = held.select("label", bounded).groupBy("label", "bin").count().collect()  # at most 2 * bins rows
    counts = np.zeros((2, settings.bins))
    for r in rows:
        counts[r["label"], r["bin"]] += r["count"]
    if not counts.sum(axis=1).all():
        return 0.0
    below = np.c_[np.zeros(2), np.cumsum(counts, axis=1)] / counts.sum(axis=1, keepdims=True)
    merit = below[0] - below[1]  # label 0 below the cut, less label 1 below it
    best = np.flatnonzero(merit == merit.max())
    cut = (best[0] + best[-1]) / 2  # the middle of all cuts that are as good
    return float(cut / settings.bins * 2 * settings.span - settings.span)


def judged(pages: DataFrame, id_column: str = "page_id", url: str = "url", rules: Sequence[Rule] = RULES, settings: Settings = Settings()) -> DataFrame:
    """(id, host, path, rule, verdict, score) of every row; the score is null where a rule decides."""
    parts = pages.select(F.col(id_column).alias("id"), F.col(url).alias("url"), host_of(F.coalesce(F.col(url), F.lit(""))).alias("host"), path_of(F.coalesce(F.col(url), F.lit(""))).alias("path"))
    parts = parts.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    decided = parts.filter("fit is not null").select((F.col("fit.verdict") == "allow").cast("long").alias("label"), "url", (F.crc32(F.col("url").cast("binary")) % settings.held_out == 0).alias("held"))
    models = train(decided.filter("not held"), settings)
    names = ["id", "host", "path"]
    ruled = parts.filter("fit is not null").select(*names, F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("verdict"), F.lit(None).cast("double").alias("score"))
    open_ = parts.filter("fit is null")
    if models is None:
        rest = open_.select(*names, F.lit(None).cast("string").alias("rule"), F.lit(settings.default).alias("verdict"), F.lit(None).cast("double").alias("score"))
    else:
        cut = threshold(scored(decided.filter("held").select("label", "url"), models, settings), settings)
        verdict = F.when(F.col("host") == "", settings.default).when(F.col("score") >= cut, "allow").otherwise("block")
        rest = scored(open_.select(*names, F.coalesce("url", F.lit("")).alias("url")), models, settings).select(*names, F.lit(None).cast("string").alias("rule"), verdict.alias("verdict"), "score")
    return ruled.union(rest).withColumnRenamed("id", id_column)
