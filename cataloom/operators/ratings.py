"""Elo ratings of pairwise results ``(aspect, tournament, seq, i, j, winner)``.

Ratings depend on the order of the games of an item, so games that are linked through their items are
serial.  Two things keep the rest parallel, both exact:

* A game between two items that play no other game has a closed form.
* Components, items that no game links, are independent of each other, also inside a tournament;
  they are dealt to tasks, and a task streams through the games of one after the other.

A component with most games of all is one stream: its games wait for each other in any schedule that
a star or a league can have.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .components import components

# The usual constants.
K_FACTOR = 32
INITIAL = 1500

KEYS = ["aspect", "tournament"]


def _sides(games: DataFrame) -> DataFrame:
    """One row per game and item."""
    sides = F.array(
        F.struct(F.col("i").alias("item"), F.col("won").alias("won")),
        F.struct(F.col("j").alias("item"), (1.0 - F.col("won")).alias("won")),
    )
    return games.select(*KEYS, "seq", F.explode(sides).alias("s")).select(*KEYS, "seq", "s.*")


def elo_single_game(
    results: DataFrame, k: int = K_FACTOR, init: int = INITIAL
) -> DataFrame:
    """Mean ratings when every pair is a tournament of one game between two fresh items."""
    gain = F.lit(k / 2.0)
    first = F.when(F.col("winner") == "A", init + gain).when(F.col("winner") == "B", init - gain)
    return results.agg(
        F.count("winner").alias("games"),
        F.avg(first).alias("elo_a"),
        F.avg(2 * init - first).alias("elo_b"),
    )


def _isolated(games: DataFrame) -> DataFrame:
    """``(aspect, tournament, seq, item, won)`` of games whose two items play no other game."""
    once = (
        _sides(games)
        .groupBy(*KEYS, "item")
        .agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("seq"), F.min("won").alias("won"))
        .filter(F.col("n") == 1)
    )
    return (
        once.groupBy(*KEYS, "seq")
        .agg(
            F.count(F.lit(1)).alias("items"),
            F.min_by("item", "item").alias("a"),
            F.min_by("won", "item").alias("a_won"),
            F.max_by("item", "item").alias("b"),
            F.max_by("won", "item").alias("b_won"),
        )
        .filter(F.col("items") == 2)
        .select(
            *KEYS,
            "seq",
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("item"), F.col("a_won").alias("won")),
                    F.struct(F.col("b").alias("item"), F.col("b_won").alias("won")),
                )
            ).alias("s"),
        )
        .select(*KEYS, "seq", "s.*")
    )


def _play_in_order(games: DataFrame, k: int, init: int) -> DataFrame:
    """Games in order, component after component; only the ratings of one component are held.

    Components are dealt to tasks; games stream through a task in batches.
    """
    schema = "aspect string, tournament string, item long, rating double, games long"

    def play(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current: tuple | None = None
        ratings: dict[int, float] = {}
        played: dict[int, int] = {}

        def table() -> pd.DataFrame:
            items = list(ratings)
            return pd.DataFrame(
                {
                    "aspect": current[0],
                    "tournament": current[1],
                    "item": items,
                    "rating": [ratings[x] for x in items],
                    "games": [played[x] for x in items],
                }
            )

        for batch in batches:
            columns = [batch[c].tolist() for c in (*KEYS, "component", "i", "j", "won")]
            for aspect, tournament, component, i, j, won in zip(*columns, strict=True):
                if current != (aspect, tournament, component):
                    if current is not None:
                        yield table()
                    current, ratings, played = (aspect, tournament, component), {}, {}
                a, b = ratings.get(i, init), ratings.get(j, init)
                step = k * (won - 1 / (1 + 10 ** ((b - a) / 400)))
                ratings[i], ratings[j] = a + step, b - step
                played[i], played[j] = played.get(i, 0) + 1, played.get(j, 0) + 1
        if current is not None:
            yield table()

    ordered = games.repartition(*KEYS, "component").sortWithinPartitions(*KEYS, "component", "seq")
    return ordered.select(*KEYS, "component", "i", "j", "won").mapInPandas(play, schema)


def elo_ratings(results: DataFrame, k: int = K_FACTOR, init: int = INITIAL) -> DataFrame:
    """``(aspect, tournament, item, rating, games)`` of every item that plays.

    ``seq`` is the order of the games; it is unique in a tournament.  Results may come straight
    from a judge, so they are written once before they are read several times.
    """
    played = results.filter(F.col("winner").isNotNull()).select(
        F.col("aspect").cast("string").alias("aspect"),
        F.col("tournament").cast("string").alias("tournament"),
        F.col("seq").cast("long").alias("seq"),
        F.col("i").cast("long").alias("i"),
        F.col("j").cast("long").alias("j"),
        F.when(F.col("winner") == "A", 1.0).otherwise(0.0).alias("won"),
    )
    games = checkpointed(played)
    alone = _isolated(games)
    closed = alone.select(
        *KEYS,
        "item",
        (F.lit(float(init)) + F.lit(float(k)) * (F.col("won") - 0.5)).alias("rating"),
        F.lit(1).cast("long").alias("games"),
    )
    rest = games.join(alone.select(*KEYS, "seq").distinct(), [*KEYS, "seq"], "left_anti")
    if rest.isEmpty():
        return closed
    named = components(rest, KEYS, "i", "j").withColumnRenamed("node", "i")
    return closed.unionByName(_play_in_order(rest.join(named, [*KEYS, "i"]), k, init))


def all_ratings(ratings: DataFrame, items: DataFrame, init: int = INITIAL) -> DataFrame:
    """Ratings of every listed item ``(aspect, tournament, item)``; unplayed ones keep ``init``."""
    return items.join(ratings, [*KEYS, "item"], "left").select(
        *KEYS,
        "item",
        F.coalesce("rating", F.lit(float(init))).alias("rating"),
        F.coalesce("games", F.lit(0)).cast("long").alias("games"),
    )
