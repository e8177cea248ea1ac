"""URL filter, chat formatting and the pipeline."""

import hashlib
import json
import random
from collections import defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cataloom.llm import chat, common, decontaminate, quality, queries, simhash, urls

from .conftest import ODD


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
    path = rest[n:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = []
    for _, rule in urls.RULES:
        domain, _, begin = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + begin):
            fits.append(rule)
    return host, path, max(fits, key=len, default=None)


URLS = [None, "", "no scheme", "a:b://X.NET/y", "http://", "http://net/", "http://net", "http://xnet/", "http://A.Example.NET/en/1?x=http://b.org/fr/#z", "http://example.com/de/", "http://example.com/de", "http://org/fr/\nx", "x://y.org?/fr/", "::://h.net/#/", "http://ünet.net/é", "http://e.org/fr/" + "long/" * 5000]


def test_hosts_paths_and_rules(spark):
    pick = random.Random(1)
    made = ["".join(pick.choice(["http", ":", "//", "://", "net", "org", ".", "/", "fr/", "en/", "example", "com", "?", "#", "A"]) for _ in range(12)) for _ in range(500)]
    every = URLS + made
    rows = spark.createDataFrame(list(enumerate(every)), "page_id long, url string").withColumn("host", F.lit("old"))
    got = urls.judged(rows).collect()
    assert len(got) == len(every)
    verdicts = {rule: verdict for verdict, rule in urls.RULES}
    for r in got:
        host, path, rule = brute_rule(every[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdicts[rule] if rule else r["verdict"] in ("allow", "block")
        if not host:
            assert r["verdict"] == "allow"


def spam(pick, good):
    word = lambda letters: "".join(pick.choices(letters, k=pick.randrange(4, 9)))
    return f"{word('aeiourst')}/{word('aeiourst')}" if good else f"{word('xzqjwk')}-{word('xzqjwk')}"


def test_undecided_urls_follow_the_models(spark):
    pick = random.Random(2)
    ruled = [f"http://s.org/fr/{spam(pick, True)}" for _ in range(400)] + [f"http://s.net/{spam(pick, False)}" for _ in range(400)]
    new = [(f"http://s.info/{spam(pick, good)}", good) for good in (True, False) for _ in range(100)]
    rows = spark.createDataFrame(list(enumerate([*ruled, *(u for u, _ in new)])), "page_id long, url string")
    got = {r["page_id"]: r for r in urls.judged(rows).collect()}
    right = [(got[800 + i]["verdict"] == "allow") == good for i, (_, good) in enumerate(new)]
    assert sum(right) > 190
    assert all((r["score"] is None) == (r["rule"] is not None) for r in got.values())


def test_models_are_those_of_plain_counts(spark):
    some = urls.Settings(order=2, slots=1 << 16)
    learn = [(0, "abcab"), (1, "abba"), (1, "é"), (0, "")]
    models = urls.train(spark.createDataFrame(learn, "label long, url string").repartition(3), some)
    for label in (0, 1):
        counts, contexts = defaultdict(int), defaultdict(int)
        for y, url in learn:
            row = ["^"] * 2 + list(url) + ["$"]
            for i in range(2, len(row)) if y == label else ():
                for k in range(3):
                    counts[k, tuple(row[i - k : i]), row[i]] += 1
                    contexts[k, tuple(row[i - k : i])] += 1
        for url in ("abc", "zz", ""):
            import math

            row, total = ["^"] * 2 + list(url) + ["$"], 0.0
            for i in range(2, len(row)):
                chance = 1 / 256
                for k in range(3):
                    c = tuple(row[i - k : i])
                    chance = (counts[k, c, row[i]] + some.strength * chance) / (contexts[k, c] + some.strength)
                total += math.log(chance)
            assert abs(models[label].mean_log_likelihoods([url], some)[0] - total / (len(url) + 1)) < 1e-5


@pytest.mark.parametrize("small", [True, False])
def test_models_hold_many_contexts(spark, monkeypatch, small):
    """More distinct grams than a table of 65,536 places could hold keep their own counts, broadcast or joined."""
    import math

    monkeypatch.setattr(urls, "fits_broadcast", lambda df: small)
    pick = random.Random(7)
    some = urls.Settings()
    word = lambda: "".join(pick.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=40))
    learn = [(i % 2, word()) for i in range(3000)]
    counts = [defaultdict(int), defaultdict(int)]
    for y, url in learn:
        for i, c in enumerate([*url, ""]):
            for k in range(5):
                counts[y][k, url[max(0, i - k) : i], c] += 1
                counts[y][k, url[max(0, i - k) : i]] += 1
    assert sum(len(key) == 3 and key[0] == 4 for key in counts[0]) > 1 << 15
    asked = [u for _, u in learn[:20]] + [word() for _ in range(20)] + ["", "é"]
    models = urls.train(spark.createDataFrame(learn, "label long, url string"), some)
    for label in (0, 1):
        want = []
        for url in asked:
            total = 0.0
            for i, c in enumerate([*url, ""]):
                chance = 1 / 256
                for k in range(5):
                    context = url[max(0, i - k) : i]
                    chance = (counts[label].get((k, context, c), 0) + some.strength * chance) / (counts[label].get((k, context), 0) + some.strength)
                assert 0 < chance <= 1
                total += math.log(chance)
            want.append(total / (len(url) + 1))
        assert models[label].mean_log_likelihoods(asked, some) == pytest.approx(want, abs=1e-9)


def test_urls_without_examples(spark):
    rows = spark.createDataFrame([(1, "http://a.info/x"), (None, None), (1, "http://a.info/x"), (2, "http://b.net/")], "page_id long, url string")
    got = [(r["page_id"], r["verdict"]) for r in urls.judged(rows).collect()]
    assert sorted(got, key=str) == [(1, "allow"), (1, "allow"), (2, "block"), (None, "allow")]
    assert urls.judged(rows.filter("false")).count() == 0


TEXTS = st.text(st.sampled_from(list("</s>[INST]\\|im_start é😀\n")) | st.characters(blacklist_categories=["Cs"]), max_size=60)


@settings(max_examples=300, deadline=None)
@given(TEXTS, TEXTS)
def test_turns_read_back(role, text):
    piece, begin, end = chat.TEMPLATE.write(role, text)
    assert chat.TEMPLATE.read(piece) == (role, text)
    assert chat.TEMPLATE.unescape(piece[begin:end]) == (text if role == "assistant" else "")
    inner = piece[len("[INST]") : -len("</s>")]
    assert inner.count("[/INST]") == 1 and not any(c in inner for c in chat.TEMPLATE.control if c != "[/INST]")


def test_overlapping_control_strings_are_refused():
    with pytest.raises(ValueError):
        chat.Template(begin="<a", end="ab>", middle="=")


def test_layouts_become_turns(spark):
    records = {
        "prompt and response": {"prompt": "q", "response": "a"},
        "instruction": {"instruction": "do", "input": "x", "output": "y"},
        "messages": {"messages": [{"role": "human", "content": "q"}, {"role": "assistant", "content": None}]},
        "from and value": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        "unknown": {"messages": [{"role": "user", "contents": "q"}]},
        "nothing": None,
    }
    rows = spark.createDataFrame([(i, 0, json.dumps(r) if r else "[1]") for i, r in enumerate(records.values())], "conv_id long, turn long, record string")
    got = defaultdict(list)
    for r in chat.formatted(rows, "conv_id", "turn").orderBy("conv_id", "turn_no").collect():
        got[r["conv_id"]].append((r["role"], r["text"]) if r["problem"] is None else r["problem"])
    assert got == {
        0: [("user", "q"), ("assistant", "a")],
        1: [("user", "do\n\nx"), ("assistant", "y")],
        2: [("user", "q"), ("assistant", "")],
        3: [("user", "q"), ("assistant", "a")],
        4: ["unknown layout"],
        5: ["not a JSON object"],
    }
    assert chat.field_paths({"a": {"b": [1, {"c": 2}]}, "d": [], "e": {}}) == {"a.b[]", "a.b[].c", "d[]", "e"}


def test_null_fields_are_empty_turns_and_problems_are_counted(spark):
    records = [(1, '{"prompt": null}'), (2, '{"prompt": null, "completion": "x"}'), (3, '{"what": 1}'), (4, '{"prompt": "q"}'), (4, "no JSON"), (4, '{"completion": "a"}'), (5, '{"instruction": "do", "input": null, "output": ""}')]
    rows = spark.createDataFrame([(c, t, r) for t, (c, r) in enumerate(records)], "conv_id long, turn long, record string")
    made = chat.formatted(rows, "conv_id", "turn")
    turns = defaultdict(list)
    for r in made.filter("problem is null").orderBy("turn", "turn_no").collect():
        turns[r["conv_id"]].append((r["role"], r["text"]))
    assert turns == {1: [("user", "")], 2: [("user", ""), ("assistant", "x")], 4: [("user", "q"), ("assistant", "a")], 5: [("user", "do"), ("assistant", "")]}
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"], r["n_problems"]) for r in chat.digests(made, "conv_id", "turn").collect()}
    assert got == {1: (1, 0, 0), 2: (2, 1, 0), 3: (0, 0, 1), 4: (2, 1, 1), 5: (2, 0, 0)}


def digest_rows(turns):
    out = {}
    for conv in {t[0] for t in turns}:
        mine = sorted((t for t in turns if t[0] == conv), key=lambda t: t[1])
        text = "".join(f"{r or ''}\n{x or ''}\n" for _, _, r, x in mine)
        lost = "".join(x or "" for _, _, r, x in mine if r == "assistant")
        out[conv] = (len(mine), hashlib.sha256(text.encode()).hexdigest(), len(lost), hashlib.sha256(lost.encode()).hexdigest())
    return out


def test_digests_of_conversations(spark):
    turns = [(c, t, r, x) for c in range(40) for t, (r, x) in enumerate([("system", "s\\[INST]"), ("user", f"q{c} </s>"), ("assistant", f"a{c}\\\\ [/INST]"), ("tool", None), (None, "<|im_end|>"), ("assistant", "")])]
    turns += [(None, 3, "user", "x" * 100_000), (None, 2, "assistant", "\x00\u2028"), (99, None, "assistant", "only")]
    pick = random.Random(3)
    pick.shuffle(turns)
    rows = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    made = chat.formatted(queries.turn_records(rows), "conv_id", "turn")
    assert made.filter("problem is not null").count() == 0
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(made, "conv_id", "turn").collect()}
    assert got == digest_rows(turns)
    assert chat.digests(made.filter("false"), "conv_id", "turn").count() == 0


def test_chat_query_has_the_added_conversation(spark, documents):
    got = {r["conv_id"]: r for r in queries.op9_chat_format(spark, "/root/testdata/sf0.001").collect()}
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    control = "</s>[INST] ok [/INST]"
    want = digest_rows([*rows, (-7, 0, "user", control), (-7, 1, "assistant", control)])
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == want


def test_pipeline_is_its_stages(spark, documents, tmp_path):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    odd = [(i, t, "en", "s", len(t or "")) for i, t in ODD if i is None or i > 0]
    from .test_pairs import brute_contained, brute_fingerprint, brute_groups

    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    kept = [(i, t) for i, t in texts if quality.measured(t.encode(), quality.Bands(), __import__("zstandard").ZstdCompressor(level=3))[-1]]
    groups = brute_groups([brute_fingerprint(t) for _, t in kept])
    first: dict = {}
    for (i, t), g in zip(kept, groups, strict=True):
        first[g] = min(first.get(g, (i, t)), (i, t))
    left = list(first.values())
    leaks = {d for d, _, _ in brute_contained(left, items)}
    want = sorted(i for i, _ in left if i not in leaks)
    assert 0 < len(want) < len(kept) < len(texts) and leaks
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()) == want

    rows = spark.createDataFrame(odd, docs.schema).withColumn("kept", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for given_ in (rows, rows.filter("false")):
            out = stage(spark, given_, folder)
            assert out.columns == rows.columns and out.dtypes == rows.dtypes
            assert out.count() <= given_.count()
    assert simhash and decontaminate


def test_op_queries_are_registered():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11)) and "pipeline" in names


def test_session_settings_stay(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(1200).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text")).coalesce(1)
    assert quality.judge(docs).count() == 1200
    assert simhash.fingerprints(docs).count() == 1200
    assert spark.conf.get(name) == before


def test_batches_are_cut():
    batch = pa.RecordBatch.from_arrays([pa.array(range(1201))], names=["n"])
    cut = list(common.sliced(iter([batch, batch.slice(0, 0), batch.slice(0, 1)])))
    assert [b.num_rows for b in cut] == [500, 500, 201, 1]
    assert [n for b in cut for n in b.column(0).to_pylist()] == [*range(1201), 0]
