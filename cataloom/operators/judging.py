"""Rubric scores, pairwise comparisons, win rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import prompts
from ..functions.text import strip
from .complete import Provider, complete
from .joins import hashed_position, lookup_join

DIMENSIONS = ["completeness", "conciseness", "readability"]

# Fixed value: name of the only aspect of a batch comparison.
OVERALL = "overall"

PAIRS_PER_TASK = 100_000

# Strides for the pair draw; at least one is coprime to any pair count below their product.
# Draws step through the pair numbers by about this share of them, so any few are spread evenly.
GOLDEN = 0.6180339887498949
# No run of so many numbers, up to 2 ** 63, is without one that is coprime to a given number.
STEPS_TRIED = 128


def parse_scores(text: Column, labelled: bool = False) -> Column:
    """Struct of the three scores; null when there are fewer than three numbers.

    The first three integers count, so ``7/10`` reads as 7 and 10.  ``labelled`` looks for each
    number after the name of its dimension instead.
    """
    if labelled:
        found = [
            F.regexp_extract(text, rf"(?i){name}\D*?(\d+)", 1).try_cast("int") for name in DIMENSIONS
        ]
        complete_row = found[0].isNotNull() & found[1].isNotNull() & found[2].isNotNull()
    else:
        numbers = F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1))
        found = [F.get(numbers, F.lit(i)).try_cast("int") for i in range(3)]
        complete_row = F.size(numbers) >= 3
    return F.when(
        complete_row, F.struct(*[c.alias(name) for name, c in zip(DIMENSIONS, found, strict=True)])
    )


def scored(df: DataFrame, text: str = "score_text", labelled: bool = False) -> DataFrame:
    """Add the three score columns; rows without three numbers are left out."""
    return (
        df.withColumn("_s", parse_scores(F.col(text), labelled))
        .filter(F.col("_s").isNotNull())
        .select(*df.columns, "_s.*")
    )


def score_averages(df: DataFrame) -> DataFrame:
    """Mean of each dimension; overall is the mean of all numbers."""
    means = [F.avg(name).alias(name) for name in DIMENSIONS]
    every = sum((F.sum(name) for name in DIMENSIONS[1:]), F.sum(DIMENSIONS[0]))
    numbers = sum((F.count(name) for name in DIMENSIONS[1:]), F.count(DIMENSIONS[0]))
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        *means,
        F.when(numbers > 0, every.cast("double") / numbers).alias("overall"),
    )


def evaluate_texts(
    df: DataFrame, provider: Provider, text: str = "generated_description"
) -> DataFrame:
    """Ask the judge about every text: adds ``score_text``; failed calls leave it null."""
    answered = complete(
        df, "quality", prompts.quality_prompt(F.col(text)), provider, {"description": F.col(text)}
    )
    return answered.withColumn("score_text", F.col("answer.content")).drop("answer")


def verdict(answer: Column) -> Column:
    """``B`` when the answer starts with B, otherwise ``A``, also when it is unclear."""
    return F.when(F.upper(strip(answer)).startswith("B"), "B").otherwise("A")


def is_unclear(answer: Column) -> Column:
    return ~F.coalesce(F.upper(strip(answer)).rlike("^[AB]"), F.lit(False))


def compare(df: DataFrame, provider: Provider, a: str, b: str) -> DataFrame:
    """Add ``winner`` (A or B) and ``unclear``; a failed call leaves ``winner`` null."""
    texts = {"a": F.col(a), "b": F.col(b)}
    answered = complete(
        df, "verdict", prompts.pair_prompt(F.col(a), F.col(b)), provider, texts
    )
    ok = F.col("answer.status") == "success"
    return (
        answered.withColumn("winner", F.when(ok, verdict(F.col("answer.content"))))
        .withColumn("unclear", is_unclear(F.col("answer.content")))
        .drop("answer")
    )


def _pair_at(index: Column) -> tuple[Column, Column]:
    """The ``index``-th pair i < j in the order (0,1), (0,2), (1,2), (0,3), ..."""
    guess = F.floor((F.sqrt(8.0 * index.cast("double") + 1.0) + 1.0) / 2.0)

    def before(j: Column) -> Column:
        return (j * (j - 1) / 2).cast("long")

    j = (
        F.when(before(guess) > index, guess - 1)
        .when(before(guess + 1) <= index, guess + 1)
        .otherwise(guess)
    )
    return (index - before(j)).cast("long"), j.cast("long")


def _coprime(a: Column, b: Column) -> Column:
    """True when ``a`` and ``b`` have no common divisor; ninety divisions are enough for longs."""
    begin = F.struct(a.alias("a"), b.alias("b"))
    turns = F.sequence(F.lit(1), F.lit(90))

    def divided(state: Column, _: Column) -> Column:
        return F.when(state["b"] == 0, state).otherwise(F.struct(state["b"].alias("a"), (state["a"] % F.nullif(state["b"], F.lit(0))).alias("b")))

    return F.aggregate(turns, begin, divided, lambda x: x["a"] == 1)


def _stride(total: Column) -> Column:
    """The first number from the golden share of ``total`` on that is coprime to it."""
    least = F.floor(total.cast("double") * GOLDEN).cast("long")
    tried = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(STEPS_TRIED - 1).cast("long")), lambda d: least + d)
    return F.get(F.filter(tried, lambda x: _coprime(x, total)), F.lit(0))


def sample_pairs(
    sizes: DataFrame,
    strategy: str = "no_repeat",
    max_pairs: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """``(group, seq, i, j)`` for groups ``(group, n)``.

    ``full``: every i < j.  ``no_repeat``: a draw of ``max_pairs`` different pairs, all when there
    are fewer.  ``symmetric``: half as many, each followed up by its mirror image.

    A pair is computed from its running number, so a draw of m pairs costs m rows whatever the
    size of the group; pairs are never listed to be thrown away.  ``full`` returns them all
    because that is its result; it is meant for the few variants of one dataset.
    """
    if strategy not in ("full", "no_repeat", "symmetric"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy != "full" and not max_pairs:
        raise ValueError("a draw needs max_pairs; the strategy 'full' lists every pair")
    limit = max_pairs if strategy != "full" else None
    wanted: Column = F.col("_all")
    if limit:
        limit = limit // 2 if strategy == "symmetric" else limit
        wanted = F.least(F.col("_all"), F.lit(limit).cast("long"))

    n = F.col("n").cast("long")
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("group").cast("string"))), 1, 8), 16, 10)
    numbered = (
        sizes.withColumn("_all", (n * (n - 1) / 2).cast("long"))
        .withColumn("_wanted", wanted)
        .filter(F.col("_wanted") > 0)
        .withColumn("_start", start.cast("long") % F.col("_all"))
        .withColumn("_stride", _stride(F.col("_all")))
        .withColumn(
            "_block",
            F.explode(
                F.sequence(
                    F.lit(0).cast("long"),
                    F.floor((F.col("_wanted") - 1) / PAIRS_PER_TASK).cast("long"),
                )
            ),
        )
        .repartition("group", "_block")
        .withColumn(
            "seq",
            F.explode(
                F.sequence(
                    F.col("_block") * PAIRS_PER_TASK,
                    F.least(F.col("_wanted"), (F.col("_block") + 1) * PAIRS_PER_TASK) - 1,
                )
            ),
        )
    )
    if strategy == "full":
        index = F.col("seq")
    else:
        steps = F.col("seq").cast("decimal(19,0)") * F.col("_stride").cast("decimal(18,0)")
        index = ((F.col("_start") + steps) % F.col("_all")).cast("long")
    i, j = _pair_at(F.col("_index"))
    drawn = numbered.withColumn("_index", index).select(
        "group", "seq", i.alias("i"), j.alias("j"), "_wanted"
    )
    if strategy == "symmetric":
        sides = F.array(
            F.struct(F.col("seq").alias("seq"), F.col("i").alias("i"), F.col("j").alias("j")),
            F.struct(
                (F.col("seq") + F.col("_wanted")).alias("seq"),
                F.col("j").alias("i"),
                F.col("i").alias("j"),
            ),
        )
        return drawn.select("group", F.explode(sides).alias("p")).select("group", "p.*")
    return drawn.drop("_wanted")


def compare_batch(
    items: DataFrame,
    provider: Provider,
    strategy: str = "no_repeat",
    max_pairs: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """Pairwise results ``(aspect, group, seq, i, j, winner)`` of items ``(group, item, text)``.

    Items get their place in the group in hashed order.  Places are joined without texts; then the
    texts of the drawn items are looked up, so that the others never move.
    """
    placed = hashed_position(items.select("group", "item"), "group", "item", seed)
    sizes = items.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    pairs = sample_pairs(sizes, strategy, max_pairs, seed)
    for side in ("i", "j"):
        at = placed.select("group", F.col("pos").alias(side), F.col("item").alias(f"item_{side}"))
        pairs = pairs.join(at, ["group", side])
    drawn = pairs.select("group", F.explode(F.array("item_i", "item_j")).alias("item")).distinct()
    texts = lookup_join(items.select("group", "item", "text"), drawn, ["group", "item"], "item")
    for side, text in (("i", "_a"), ("j", "_b")):
        told = texts.select("group", F.col("item").alias(f"item_{side}"), F.col("text").alias(text))
        pairs = pairs.join(told, ["group", f"item_{side}"])
    return compare(pairs, provider, "_a", "_b").select(
        F.lit(OVERALL).alias("aspect"), "group", "seq", "i", "j", "item_i", "item_j", "winner"
    )


def win_rates(results: DataFrame, items: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Wins over plays per item and aspect, 0 without plays; a comparison without a winner is no play.

    ``results`` has ``aspect, *by, i, j, winner``; ``items`` lists ``(aspect, *by, item)``.
    """
    keys = ["aspect", *(by or [])]
    won_by_a = F.col("winner") == "A"
    sides = F.array(
        F.struct(F.col("i").alias("item"), won_by_a.cast("long").alias("won")),
        F.struct(F.col("j").alias("item"), (~won_by_a).cast("long").alias("won")),
    )
    played = (
        results.filter(F.col("winner").isNotNull())
        .select(*keys, F.explode(sides).alias("s"))
        .groupBy(*keys, F.col("s.item").alias("item"))
        .agg(F.sum("s.won").alias("wins"), F.count(F.lit(1)).alias("plays"))
    )
    return items.select(*keys, "item").join(played, [*keys, "item"], "left").select(
        *keys,
        "item",
        F.coalesce("wins", F.lit(0)).alias("wins"),
        F.coalesce("plays", F.lit(0)).alias("plays"),
        F.coalesce(F.col("wins").cast("double") / F.col("plays"), F.lit(0.0)).alias("win_rate"),
    )


WINNERS = ["Generated", "Original"]


def named_winner(winner: Column) -> Column:
    return F.when(winner == "A", WINNERS[0]).when(winner.isNotNull(), WINNERS[1])


def win_breakdown(results: DataFrame) -> DataFrame:
    """Wins by source, 0 filled."""
    counts = results.groupBy("source").pivot("winner", WINNERS).agg(F.count(F.lit(1)))
    return counts.select(
        "source", *[F.coalesce(F.col(w), F.lit(0)).alias(w.lower()) for w in WINNERS]
    )


def win_totals(results: DataFrame) -> DataFrame:
    """Total pairs, wins of each side, shares in percent."""
    n = F.count("winner")
    parts: list[Column] = [n.alias("pairs")]
    for w in WINNERS:
        wins = F.count_if(F.col("winner") == w)
        parts.append(wins.alias(f"{w.lower()}_wins"))
        parts.append(F.bround(F.when(n > 0, wins * 100.0 / n), 1).alias(f"{w.lower()}_share"))
    return results.agg(*parts)
