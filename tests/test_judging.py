"""Scores, pairs, win rates, ratings."""

import random

import pytest
from pyspark.sql import functions as F

from cataloom.operators import complete, judging, ratings
from cataloom.operators.components import components


def test_scores_need_three_numbers(spark):
    texts = ["Completeness: 7, Conciseness: 9, Readability: 9", "8 7", "7/10, 8/10", "none", "1 2 3 4"]
    df = spark.createDataFrame([(t,) for t in texts], "score_text string")
    rows = {r.score_text: tuple(r)[1:] for r in judging.scored(df).collect()}
    assert rows == {texts[0]: (7, 9, 9), texts[2]: (7, 10, 8), texts[4]: (1, 2, 3)}
    assert [tuple(r)[1:] for r in judging.scored(df, labelled=True).collect()] == [(7, 9, 9)]
    means = judging.score_averages(judging.scored(df)).first()
    assert (means.n, means.completeness, means.overall) == (3, 5.0, pytest.approx(56 / 9))


@pytest.mark.parametrize(
    "answer, winner, unclear",
    [("a", "A", False), (" B.", "B", False), ("neither", "A", True), ("", "A", True), ("\nBoth", "B", False)],
)
def test_verdicts(spark, answer, winner, unclear):
    df = spark.createDataFrame([(answer,)], "x string")
    got = df.select(judging.verdict(F.col("x")), judging.is_unclear(F.col("x"))).first()
    assert tuple(got) == (winner, unclear)


def draw(spark, n, strategy, limit=None, seed=0):
    sizes = spark.createDataFrame([("g", n)], "group string, n long")
    rows = judging.sample_pairs(sizes, strategy, limit, seed).orderBy("seq").collect()
    return [(r.i, r.j) for r in rows]


def test_pairs(spark):
    every = {(i, j) for j in range(9) for i in range(j)}
    assert set(draw(spark, 9, "full", 3)) == every
    found = draw(spark, 9, "no_repeat", 1000)
    assert set(found) == every and len(found) == 36
    few = draw(spark, 9, "no_repeat", 5)
    assert len(set(few)) == 5 and set(few) <= every
    both = draw(spark, 9, "symmetric", 7)
    assert len(both) == 6 and both[3:] == [(j, i) for i, j in both[:3]]
    assert draw(spark, 9, "symmetric", 1) == []
    assert len(draw(spark, 4, "symmetric", 100)) == 12
    assert draw(spark, 1, "full") == []
    assert draw(spark, 9, "no_repeat", 5, seed=1) != few
    for strategy, limit in (("other", 1), ("no_repeat", None), ("symmetric", 0)):
        with pytest.raises(ValueError):
            draw(spark, 3, strategy, limit)


def test_draws_are_spread_over_a_group(spark):
    from math import gcd

    found = draw(spark, 100_000, "no_repeat", 100)
    for side, share in ((0, 0.25), (1, 0.5)):  # a quarter of the pairs has j below half of the group
        below = sum(pair[side] < 50_000 for pair in found) / 100
        assert abs(below - (0.75 if side == 0 else 0.25)) < 0.1
    assert len({j // 10_000 for _, j in found}) >= 7 and share
    totals = [1, 2, 3, 36, 5050, 4_999_950_000, 2**61 - 1, 200_560_490_130 * 31]
    df = spark.createDataFrame([(t,) for t in totals], "t long")
    for t, step in df.select("t", judging._stride(F.col("t"))).collect():
        assert step is not None and gcd(step, t) == 1


def test_a_few_pairs_of_a_huge_group(spark):
    found = draw(spark, 2_000_000, "no_repeat", 1000)
    assert len(set(found)) == 1000
    assert all(0 <= i < j < 2_000_000 for i, j in found)


def test_batches_compare_texts_of_their_group(spark):
    rows = [("g", i, "word " * (i % 5 + 1)) for i in range(8)] + [("h", 1, "x"), ("h", 2, "y")]
    items = spark.createDataFrame(rows, "group string, item long, text string")
    got = judging.compare_batch(items, complete.OfflineProvider(), "no_repeat", 10).collect()
    assert {r.group for r in got} == {"g", "h"}
    assert len([r for r in got if r.group == "g"]) == 10
    assert all(r.winner in "AB" and r.item_i != r.item_j for r in got)


def games(seed, n_items, n_games):
    pick = random.Random(seed)
    return [(*pick.sample(range(n_items), 2), pick.choice("AB")) for _ in range(n_games)]


def elo(played, n, k=32, init=1500):
    rating = [float(init)] * n
    for i, j, winner in played:
        step = k * ((winner == "A") - 1 / (1 + 10 ** ((rating[j] - rating[i]) / 400)))
        rating[i] += step
        rating[j] -= step
    return rating


def results(spark, tournaments):
    rows = [("x", name, s, *g) for name, played in tournaments.items() for s, g in enumerate(played)]
    df = spark.createDataFrame(rows, "aspect string, tournament string, seq long, i long, j long, winner string")
    return df.orderBy(F.rand(1)).repartition(5)


def test_elo_in_order(spark):
    tournaments = {"t": games(1, 12, 16), "u": games(2, 4, 8), "lone": [(0, 1, "B"), (2, 3, "A")]}
    got = {(r.tournament, r.item): (r.rating, r.games) for r in ratings.elo_ratings(results(spark, tournaments)).collect()}
    for name, played in tournaments.items():
        want = elo(played, 12)
        for item in {x for g in played for x in g[:2]}:
            rating, n = got[name, item]
            assert rating == pytest.approx(want[item])
            assert n == sum(item in g[:2] for g in played)
    total = sum(r for (t, _), (r, _) in got.items() if t == "t")
    items = len([1 for t, _ in got if t == "t"])
    assert total == pytest.approx(1500 * items)


def test_unplayed_items_keep_the_first_rating(spark):
    rated = ratings.elo_ratings(results(spark, {"t": [(0, 1, "A")]}))
    items = spark.range(3).selectExpr("'x' aspect", "'t' tournament", "id item")
    got = {r.item: r.rating for r in ratings.all_ratings(rated, items).collect()}
    assert got == {0: 1516.0, 1: 1484.0, 2: 1500.0}


def test_single_games_have_a_closed_form(spark):
    df = spark.createDataFrame([("A",)] * 192 + [("B",)] * 9, "winner string")
    row = ratings.elo_single_game(df).first()
    assert (row.games, round(row.elo_a, 1), round(row.elo_b, 1)) == (201, 1514.6, 1485.4)


def test_win_rates(spark):
    res = spark.createDataFrame([("o", 0, 1, "A"), ("o", 1, 2, "B"), ("o", 2, 0, "A")], "aspect string, i long, j long, winner string")
    items = spark.range(4).selectExpr("'o' aspect", "id item")
    got = {r.item: (r.wins, r.plays, r.win_rate) for r in judging.win_rates(res, items).collect()}
    assert got == {0: (1, 2, 0.5), 1: (0, 2, 0.0), 2: (2, 2, 1.0), 3: (0, 0, 0.0)}


def test_breakdown_has_zeros(spark):
    df = spark.createDataFrame([("p", "Generated"), ("p", "Generated"), ("d", "Original")], "source string, winner string")
    assert sorted(tuple(r) for r in judging.win_breakdown(df).collect()) == [("d", 0, 1), ("p", 2, 0)]
    totals = judging.win_totals(df).first()
    assert (totals.pairs, totals.generated_wins, totals.generated_share) == (3, 2, 66.7)


def test_failed_comparisons_are_no_plays(spark):
    results = spark.createDataFrame([("o", 1, 2, "A"), ("o", 1, 2, None)], "aspect string, i long, j long, winner string")
    items = spark.createDataFrame([("o", 1), ("o", 2)], "aspect string, item long")
    got = {r["item"]: (r["wins"], r["plays"], r["win_rate"]) for r in judging.win_rates(results, items).collect()}
    assert got == {1: (1, 1, 1.0), 2: (0, 1, 0.0)}


def test_components_of_chains_stars_and_groups(spark):
    pick = random.Random(2)
    links = [("a", i, i + 1) for i in range(0, 60)] + [("a", 500 - i, 499 - i) for i in range(40)] + [("a", 1000, 1000 + i) for i in range(1, 200)]
    links += [("b", *pick.sample(range(300), 2)) for _ in range(220)] + [("a", 7, 7), ("c", 3, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for key, u, v in links:
        a, b = sorted((find((key, u)), find((key, v))))
        root[b] = a
    frame = spark.createDataFrame(links, "k string, i long, j long")
    got = {(r["k"], r["node"]): r["component"] for r in components(frame, ["k"], "i", "j").collect()}
    assert got == {x: find(x)[1] for x in list(root)}


def test_elo_of_a_star_takes_few_jobs(spark):
    games = 30_000
    frame = spark.range(games).select(F.lit("x").alias("aspect"), F.lit("t").alias("tournament"), F.col("id").alias("seq"), F.lit(0).alias("i"), (F.col("id") % 9_000 + 1).alias("j"), F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("winner"))
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    got = {r["item"]: r["rating"] for r in ratings.elo_ratings(frame).collect()}
    after = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    want = elo([(0, i % 9_000 + 1, "A" if i % 3 == 0 else "B") for i in range(games)], 9_001)
    assert [got[i] for i in range(9_001)] == pytest.approx(want)
    # Each exchange of a plan is a job of its own; what counts is that rounds do not follow the games.
    assert len(set(after) - set(before)) < 80
