"""Similarity, retrieval, vectors and gains against brute force."""

import math
import random

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cataloom.functions.stem import STEP_2, STEP_3, STEP_4, stem
from cataloom.functions.text import runs
from cataloom.operators import joins, ranking, retrieval, similarity, vectors
from suite import word_sql

WORDS = "the a data city bus tram ride count rate of in zoo".split()


def texts(n, seed, low=0, high=12):
    draw = random.Random(seed)
    return [" ".join(draw.choice(WORDS) for _ in range(draw.randint(low, high))) for _ in range(n)]


def documents(spark, rows):
    return spark.createDataFrame(
        [(i, i, t, float(i % 3)) for i, t in enumerate(rows)],
        "doc_id long, doc_ord long, text string, qrel double",
    )


def queries(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "query_id long, query_text string")


def bm25_scores(docs, query):
    docs = [d.split() for d in docs]
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    vocabulary = {w for d in docs for w in d}
    df = {w: sum(w in d for d in docs) for w in vocabulary}
    idf = {w: math.log(n - df[w] + 0.5) - math.log(df[w] + 0.5) for w in vocabulary}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {w: floor if v < 0 else v for w, v in idf.items()}
    return [
        sum(
            idf.get(q, 0) * d.count(q) * 2.5 / (d.count(q) + 1.5 * (0.25 + 0.75 * len(d) / mean))
            for q in query.split()
        )
        for d in docs
    ]


def top(scores, k):
    order = sorted(range(len(scores)), key=lambda i: (-round(scores[i], 9), i))[:k]
    return [(i, round(scores[i], 6)) for i in order]


def ranked(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.doc_id, round(r.score, 6)))
    return out


def test_bm25_fills_lists_with_documents_without_hits(spark):
    docs = texts(40, 1) + ["rare word"]
    asked = ["city city bus", "rare", "unknown", "the of in"]
    found = ranked(retrieval.search(documents(spark, docs), queries(spark, asked), size=10, mode="words"))
    for q, text in enumerate(asked):
        assert found[q] == top(bm25_scores(docs, text), 10)


def test_fewer_documents_than_asked_for(spark):
    docs = ["city bus", "tram", "zoo zoo"]
    found = ranked(retrieval.search(documents(spark, docs), queries(spark, ["zoo"]), size=10))
    assert [d for d, _ in found[0]] == [2, 0, 1]


def test_large_query_sets_take_the_salted_way(spark, monkeypatch):
    docs, asked = texts(30, 2), texts(5, 3, 1, 4)
    frames = documents(spark, docs), queries(spark, asked)
    small = ranked(retrieval.search(*frames, size=5, mode="words"))
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a, **k: False)
    assert ranked(retrieval.search(*frames, size=5, mode="words")) == small


def test_an_index_does_not_broadcast_its_vocabulary(spark, monkeypatch):
    measured = []
    monkeypatch.setattr(joins, "fits_broadcast", lambda df, **k: measured.append((set(df.columns), k)) or True)
    index = retrieval.store_index(documents(spark, texts(30, 2)), retrieval.VECTORISER)
    assert measured == []
    retrieval.search(index, queries(spark, texts(5, 3, 1, 4)), "TFIDF", 5).collect()
    bounds = [k["max_rows"] for columns, k in measured if {"term", "block"} <= columns]
    assert bounds and max(bounds) <= 20_000


def test_many_blocks_to_read_are_merged(spark, monkeypatch):
    index = retrieval.store_index(documents(spark, texts(30, 2)))
    asked = queries(spark, texts(5, 3, 1, 4))
    small = ranked(retrieval.search(index, asked, size=5))
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a, **k: False)
    assert ranked(retrieval.search(index, asked, size=5)) == small


@pytest.mark.parametrize("mode", ["words_and_marks", retrieval.VECTORISER])
def test_an_index_leaves_no_shuffle_files(spark, mode):
    def left():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in files.mkString("|").split("|") if f.endswith(".data")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    docs, before = documents(spark, texts(30, 2)), spark.conf.get(setting, None)
    earlier = left()
    index = retrieval.store_index(docs, mode)
    written = {f.split("shuffle_")[1].split("_")[0] for f in left() - earlier if "shuffle_" in f}
    assert len(written) <= 4  # of figures that are gathered; vocabulary, entries and impacts have at least four more
    assert spark.conf.get(setting, None) == before
    index.drop()


@pytest.mark.parametrize("similarity, mode", [("BM25", "words_and_marks"), ("TFIDF", retrieval.VECTORISER)])
def test_shares_of_scores_are_summed_in_their_block(spark, monkeypatch, similarity, mode):
    """Entries move once, by block; what they add to scores does not move."""
    monkeypatch.setattr(retrieval, "BLOCK_DOCUMENTS", 4)
    monkeypatch.setattr(joins, "fits_broadcast", lambda *a, **k: False)
    index = retrieval.store_index(documents(spark, texts(30, 2)), mode)
    asked = queries(spark, texts(5, 3, 1, 4))
    scores = retrieval.best_scores(index, asked, 5)
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(group") == 1 and "Exchange hashpartitioning(query_id" not in plan
    full = retrieval.bm25_scores if similarity == "BM25" else retrieval.tfidf_scores
    want = {(r.query_id, r.doc_id): r.score for r in full(index, asked).collect()}
    got = {(r.query_id, r.doc_id): r.score for r in scores.collect()}
    assert got and got == pytest.approx({k: want[k] for k in got}, abs=1e-8)
    index.drop()


def test_token_lists_are_unpacked_few_at_a_time(monkeypatch):
    unpacked = []

    class Column(list):
        def slice(self, start, n):
            unpacked.append(len(self[start : start + n]))
            return pa.array(self[start : start + n])

    monkeypatch.setattr(similarity, "BATCH_ROWS", 3)
    got = similarity.by_rows(lambda a, b: a and a + b, pa.int64(), Column([1, None, 3, 4]), Column([1, 2, 3, 4]))
    assert got.to_pylist() == [2, None, 6, 8]
    assert max(unpacked) == 3
    assert similarity.by_rows(lambda a: a, pa.int64(), Column()).to_pylist() == []


def test_tfidf_is_a_cosine(spark):
    docs = [d for d in texts(25, 4, 1) if d]
    found = ranked(retrieval.search(documents(spark, docs), queries(spark, ["city bus bus"]), "TFIDF", 25))[0]
    kept = [[w for w in d.split() if len(w) > 1] for d in docs]
    idf = {w: math.log((1 + len(docs)) / (1 + sum(w in d for d in kept))) + 1 for w in WORDS}

    def vector(tokens):
        v = np.array([tokens.count(w) * idf[w] for w in WORDS])
        return v / np.linalg.norm(v) if v.any() else v

    query = vector("city bus bus".split())
    assert found == top([float(vector(d) @ query) for d in kept], 25)


def test_heavy_keys_are_spread_and_complete(spark):
    big = spark.range(4000).select(F.when(F.col("id") < 3000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("term"), "id")
    small = big.groupBy("term").agg(F.count("*").alias("n"))
    joined = joins.heavy_key_join(big, small, "term", "n", "id", share=10)
    assert joined.count() == 4000
    assert joined.agg(F.countDistinct("id")).first()[0] == 4000


def test_hashed_position_is_a_permutation(spark):
    df = spark.range(500).withColumn("g", F.when(F.col("id") < 400, "hot").otherwise("cold"))
    placed = joins.hashed_position(df, "g", "id", seed=3).collect()
    for group, n in (("hot", 400), ("cold", 100)):
        assert sorted(r.pos for r in placed if r.g == group) == list(range(n))


def test_runs_count_terms(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],), (None,)], "t array<string>")
    got = [r[0] for r in df.select(runs(F.col("t"))).collect()]
    assert [(x.term, x.tf) for x in got[0]] == [("a", 1), ("b", 2)]
    assert got[1] is None and got[2] is None


def sparse(spark, rows, key):
    return spark.createDataFrame(
        [(i, i, [int(j) for j in np.nonzero(v)[0]], [float(x) for x in v[np.nonzero(v)]]) for i, v in enumerate(rows)],
        f"{key} long, doc_ord long, indices array<int>, values array<double>",
    )


def test_vector_search_is_exact_both_ways(spark, monkeypatch):
    draw = np.random.default_rng(5)
    docs = draw.normal(size=(60, 8)) * (draw.random((60, 8)) > 0.6)
    asked = draw.normal(size=(4, 8)) * (draw.random((4, 8)) > 0.4)

    def cosine(a, b):
        n = np.linalg.norm(a) * np.linalg.norm(b)
        return float(a @ b / n) if n else 0.0

    frames = sparse(spark, asked, "query_id").drop("doc_ord"), sparse(spark, docs, "doc_id")
    want = {q: top([cosine(asked[q], d) for d in docs], 55) for q in range(4)}
    assert ranked(vectors.vector_search(*frames, size=55)) == want
    monkeypatch.setattr(vectors, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr(vectors, "QUERIES_PER_BLOCK", 3)
    monkeypatch.setattr(vectors, "DOCUMENTS_PER_BLOCK", 25)
    assert ranked(vectors.vector_search(*frames, size=55)) == want


def test_vectors_with_many_indices(spark, monkeypatch):
    draw = np.random.default_rng(6)
    rows = [(i, i, sorted(draw.choice(10**9, 40, replace=False).tolist() + [7, i % 5]), draw.random(42).tolist()) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, doc_ord long, indices array<int>, values array<double>")
    asked = docs.filter("doc_id < 20").selectExpr("doc_id as query_id", "indices", "values")

    def cosine(a, b):
        x, y = {}, {}
        for out, (_, _, index, value) in ((x, a), (y, b)):
            for i, v in zip(index, value, strict=True):
                out[i] = out.get(i, 0) + v
        return sum(v * y.get(i, 0) for i, v in x.items()) / np.sqrt(np.sum(np.square(a[3])) * np.sum(np.square(b[3])))

    monkeypatch.setattr(vectors, "SCORES", 100)
    monkeypatch.setattr(vectors, "PRODUCTS", 30)
    want = {q: top([float(cosine(rows[q], d)) for d in rows], 10) for q in range(20)}
    assert ranked(vectors.vector_search(asked, docs)) == want


def test_zero_norm_is_zero(spark):
    df = spark.createDataFrame([(([], []), ([1], [2.0]))], "a struct<indices:array<int>,values:array<double>>, b struct<indices:array<int>,values:array<double>>")
    assert df.select(vectors.cosine_sparse(F.col("a"), F.col("b"))).first()[0] == 0.0


def test_ndcg_edges(spark):
    lists = spark.createDataFrame(
        [("a", 1, 3.0, 3.0), ("a", 2, 2.0, 3.0), ("a", 3, 3.0, 2.0), ("zero", 1, 0.0, 0.0)],
        "q string, rank int, rel double, ideal double",
    )
    rows = {r.q: r for r in ranking.ndcg(lists, ["q"], 3).collect()}
    dcg = lambda x: sum((2**r - 1) / math.log2(i + 2) for i, r in enumerate(x))
    assert rows["a"].ndcg == pytest.approx(dcg([3, 2, 3]) / dcg([3, 3, 2]))
    assert rows["zero"].ndcg == 0.0
    short = ranking.dcg(lists, ["q"], 1).collect()
    assert {r.q: r.dcg for r in short} == {"a": 7.0, "zero": 0.0}


def test_linear_gain_at_several_depths(spark):
    docs = texts(20, 7)
    got = {(r.query_id, r.k): r.ndcg for r in ranking.ndcg_linear_at_ks(documents(spark, docs), queries(spark, ["zoo bus"]), [1, 5, 50]).collect()}
    rel = [float(i % 3) for i in range(20)]
    order = [i for i, _ in top(bm25_scores(docs, "zoo bus"), 20)]
    for k in (1, 5, 50):
        gain = lambda x: sum(r / math.log2(i + 2) for i, r in enumerate(x[:k]))
        assert got[0, k] == pytest.approx(gain([rel[i] for i in order]) / gain(sorted(rel, reverse=True)))


def test_keyword_hits_in_table_order(spark):
    rows = [("v", i, t) for i, t in enumerate(["Bus and tram", "zoo", "BUS", "tram bus zoo", ""])]
    df = spark.createDataFrame(rows, "variant string, text_ord long, text string")
    got = {r.query: r.ndcg for r in ranking.keyword_hit_ndcg(df, {"q": ["bus", "tram"], "none": ["qq"]}, 3).collect()}
    hits = [2, 0, 1, 2, 0]
    gain = lambda x: sum(h / math.log2(i + 2) for i, h in enumerate(x[:3]))
    assert got["q"] == pytest.approx(gain(hits) / gain(sorted(hits, reverse=True)))
    assert got["none"] == 0.0


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("seed", range(20))
def test_lcs(seed):
    a, b = (t.split() for t in texts(2, seed, 0, 90))
    assert similarity.lcs_length(a, b) == lcs(a, b)


def test_rouge_scores(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate(zip(texts(30, 8), texts(30, 9), strict=True))]
    pairs = spark.createDataFrame(rows, "pair_id long, reference string, candidate string")
    scored = similarity.rouge_l(similarity.rouge_n(similarity.rouge_n(pairs, 1), 2))
    swapped = similarity.rouge_n(pairs.selectExpr("pair_id", "candidate reference", "reference candidate"), 2)
    other = {r.pair_id: r.rouge2 for r in swapped.collect()}

    def overlap(a, b):
        hits = sum(min(a.count(x), b.count(x)) for x in set(a))
        return 2 * hits / (len(a) + len(b)) if hits else 0.0

    for r in scored.collect():
        a, b = rows[r.pair_id][1].split(), rows[r.pair_id][2].split()
        assert r.rouge1 == pytest.approx(overlap(a, b))
        two = [list(zip(x, x[1:], strict=False)) for x in (a, b)]
        assert r.rouge2 == pytest.approx(overlap(*two)) == other[r.pair_id]
        n = lcs(a, b)
        assert r.rougeL == pytest.approx(2 * n / (len(a) + len(b)) if n else 0.0)


def test_meteor(spark):
    def score(a, b, groups=None):
        return similarity.meteor_score(a.split(), b.split(), groups)

    assert score("the cat sat", "the cat sat") == pytest.approx(1 - 0.5 / 27)
    assert score("a b c", "x y z") == 0.0
    # Two matches in two chunks, precision 2/2, recall 2/3.
    assert score("a b c", "c a") == pytest.approx((1 - 0.5) * (2 / 3) / (0.9 + 0.1 * 2 / 3))
    assert score("running dogs", "run dog") == score("run dog", "run dog")
    assert score("big car", "large car", {"big": {"s1"}, "large": {"s1"}}) == score("big car", "big car")
    pairs = spark.createDataFrame([(1, "Big car", "large car"), (2, "x", None)], "pair_id long, reference string, candidate string")
    table = spark.createDataFrame([("big", "s1"), ("large", "s1")], "term string, synset string")
    got = {r.pair_id: r.meteor for r in similarity.meteor(pairs, table).collect()}
    assert got[1] == pytest.approx(score("big car", "big car"))
    assert got[2] is None


@pytest.mark.parametrize(
    "word, root",
    [
        ("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("agreed", "agre"), ("plastered", "plaster"),
        ("motoring", "motor"), ("conflated", "conflat"), ("hopping", "hop"), ("falling", "fall"), ("filing", "file"),
        ("happy", "happi"), ("sky", "sky"), ("relational", "relat"), ("rational", "ration"), ("triplicate", "triplic"),
        ("hopeful", "hope"), ("goodness", "good"), ("revival", "reviv"), ("adoption", "adopt"), ("probate", "probat"),
        ("rate", "rate"), ("cease", "ceas"), ("controll", "control"), ("roll", "roll"),
    ],
)
def test_stems_of_the_published_algorithm(word, root):
    assert stem(word) == root


def test_lists_are_filled_exactly_when_hits_score_below_zero(spark):
    from cataloom.operators import retrieval

    texts = ["aa bb"] * 60 + ["zz"]
    docs = spark.createDataFrame([(i, i, t, 0.0) for i, t in enumerate(texts)], "doc_id long, doc_ord long, text string, qrel double")
    asked = spark.createDataFrame([(1, "aa"), (2, "zz"), (3, "nothing")], "query_id long, query_text string")
    found = {}
    for r in retrieval.search(docs, asked, size=3).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["doc_id"], r["score"]))
    assert found[1][0] == (60, 0.0) and [d for d, _ in found[1]] == [60, 0, 1]
    assert all(s < 0 for _, s in found[1][1:])
    assert [d for d, _ in found[2]] == [60, 0, 1] and [d for d, _ in found[3]] == [0, 1, 2]


def test_a_stored_index_serves_many_searches(spark):
    from cataloom.operators import retrieval

    docs = spark.createDataFrame([(i, i, f"w{i % 7} w{i % 11} city", 0.0) for i in range(80)], "doc_id long, doc_ord long, text string, qrel double")
    asked = spark.createDataFrame([(1, "w3 city"), (2, "w10 w4")], "query_id long, query_text string")
    for similarity, mode in (("BM25", "words_and_marks"), ("TFIDF", "vectoriser")):
        index = retrieval.store_index(docs, mode, buckets=4)
        assert ranked(retrieval.search(index, asked, similarity)) == ranked(retrieval.search(docs, asked, similarity))

    vectors_ = spark.createDataFrame([(1, 1, ([0, 2], [1.0, 1.0])), (2, 2, ([5], [1.0]))], "doc_id long, doc_ord long, v struct<indices:array<int>,values:array<double>>")
    wanted = spark.createDataFrame([(1, ([0], [2.0]))], "query_id long, v struct<indices:array<int>,values:array<double>>")
    found = retrieval.search(vectors_, wanted, "cosine", vector=retrieval.vector_field({"v": 1})).orderBy("rank").collect()
    assert [(r["doc_id"], round(r["score"], 6)) for r in found] == [(1, 0.707107), (2, 0.0)]


@pytest.mark.parametrize("similarity, mode", [("BM25", "words_and_marks"), ("TFIDF", "vectoriser")])
def test_stored_search_reads_few_blocks_and_finds_what_full_scoring_finds(spark, monkeypatch, similarity, mode):
    monkeypatch.setattr(retrieval, "BLOCK_DOCUMENTS", 8)
    pick = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    texts = [" ".join(pick.choices(words, weights, k=pick.randrange(1, 60))) for _ in range(1500)]
    texts[7] = "rareword " * 30
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "doc_id long, doc_ord long, text string")
    asked = [" ".join(pick.choices(words + ["unknown"], k=pick.randrange(1, 6))) for _ in range(1000)] + ["rareword w0", ""]
    index = retrieval.store_index(docs, mode, buckets=5)
    frame = spark.createDataFrame(list(enumerate(asked)), "query_id long, query_text string")
    got = retrieval.search(index, frame, similarity, size=7).select("query_id", "rank", "doc_id", "score")
    scores = retrieval.bm25_scores if similarity == "BM25" else retrieval.tfidf_scores
    want = retrieval.top_k(scores(index, frame, zero_fill=7), 7).select("query_id", "rank", "doc_id", "score")
    found, expected = sorted(map(tuple, got.collect())), sorted(map(tuple, want.collect()))
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in expected], abs=1e-8)
    # Blocks that cannot reach the list are not read, and only the terms' parts are.
    rare = frame.filter(F.col("query_text") == "rareword w0")
    wanted = retrieval.blocks_to_read(index, rare, 1).collect()
    every = index.stored.impacts.filter(F.col("term").isin("rareword", "w0")).count()
    assert {r["term"] for r in wanted} <= {"rareword", "w0"} and len(wanted) <= 2 < every
    assert index.stored.impacts.select("part").distinct().count() == 5
    index.drop()
    with pytest.raises(Exception):
        index.vocabulary.count()


def test_stems_and_scores_in_sql(spark):
    """The checking SQL against the helpers, word by word and pair by pair."""
    draw = random.Random(5)
    ends = ["", "s", "sses", "ies", "eed", "ed", "ing", "y", "e", "ll", "ion", "tion", *STEP_2, *STEP_3, *STEP_4]
    words = sorted({"".join(draw.choices("aeioubtlszywxrn", k=draw.randint(0, 6))) + draw.choice(ends) for _ in range(6000)} - {""})
    con = duckdb.connect()
    con.register("given", pd.DataFrame({"term": words}))
    got = dict(con.execute(f"WITH {word_sql.stems_sql('given')} SELECT term, stem FROM stems").fetchall())
    assert {w: got[w] for w in words} == {w: stem(w) for w in words}

    few = ["run", "running", "runs", "dog", "dogs", "a", "the", "thesis"]
    rows = [(i, " ".join(draw.choices(few, k=draw.randint(0, 12))), " ".join(draw.choices(few, k=draw.randint(0, 12)))) for i in range(300)]
    con.register("pairs", pd.DataFrame(rows, columns=["pair_id", "reference", "candidate"]))
    for synset in (None, word_sql.SYNSET):
        groups = {w: {w[:2]} for w in few} if synset else None
        scores = dict(con.execute(f"WITH {word_sql.meteor_sql(synset)} SELECT pair_id, score FROM meteor_scores").fetchall())
        for i, a, b in rows:
            assert scores[i] == pytest.approx(similarity.meteor_score(a.split(), b.split(), groups)), (a, b)
