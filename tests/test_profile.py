"""Profiles, semantics, prompts, providers, the described table."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from cataloom.functions import jsontext, prompts
from cataloom.operators import complete, evaluation, sampling, semantics, structural
from cataloom.plans import describe

cloudpickle.register_pickle_by_value(sys.modules[__name__])

RECORD = "dataset_id string, title string, source string, sample_csv string, original_description string"
CITY = "City,Month,Temperature,lat,when\nNew York,Jan,2,40.7,2024-01-01\nChicago,Jan,-3,41.9,2024-02-01\nMiami,,20,25.8,2024-02-01\n"


def records(spark, *rows):
    df = spark.createDataFrame(list(rows), RECORD)
    return df.withColumn("download_url", F.lit("u")).withColumn("landing_page_url", F.lit("l"))


def test_types_ranges_and_times(spark):
    df = records(spark, ("a", "t", "s", CITY, None))
    rows = {r.col_name: r for r in structural.profile_rows(df).collect()}
    kinds = {k: r.data_type for k, r in rows.items()}
    assert kinds == {"City": "text", "Month": "text", "Temperature": "integer", "lat": "float", "when": "datetime"}
    t = rows["Temperature"]
    assert (t.low, t.high, t.range_low, t.range_high, t.distinct_values) == (-3.0, 20.0, -3.0, 20.0, 3)
    # The printed range always includes 0.
    assert (rows["lat"].low, rows["lat"].range_low, rows["lat"].spatial_type) == (25.8, 0.0, "latlong")
    assert rows["when"].resolution == "month"
    assert rows["Month"].distinct_values == 1


def test_profile_text(spark):
    row = structural.render_profiles(records(spark, ("a", "t", "s", CITY, None))).first()
    lines = row.dataset_profile.split("\n")
    assert lines[0] == prompts.PROFILE_HEADING
    assert lines[3] == (
        "**Temperature**: Data is of type integer. There are 3 unique values. Coverage spans from -3.0 to 20.0. "
    )
    assert row.profile_notes.split("\n") == [
        "**Temporal coverage** for columns when with resolution month, covering from 2024-01-01 to 2024-02-01.",
        "**Spatial coverage** for columns lat, with type latlong.",
    ]


@pytest.mark.parametrize(
    "value, text", [(0.0, "0"), (12345678.0, "12345678.0"), (-2.5, "-2.5"), (1e10, "10000000000.0")]
)
def test_numbers_print_without_exponent(spark, value, text):
    assert spark.range(1).select(structural.number_text(F.lit(value))).first()[0] == text


def test_sketched_distinct_counts_are_close(spark):
    df = spark.range(5000).select("id", (F.col("id") / 10).cast("long").alias("tens"))
    found = {r.col_no: r.distinct_values for r in structural.table_distinct_counts(df, exact=False).collect()}
    exact = {r.col_no: r.distinct_values for r in structural.table_distinct_counts(df).collect()}
    assert exact == {0: 5000, 1: 500}
    assert all(abs(found[c] - exact[c]) < 0.15 * exact[c] for c in exact)


@pytest.mark.parametrize(
    "text, fixed",
    [
        ('Sure: {"a": 1} ok', '{"a": 1}'),
        ('{"a": {"b": 1}', '{"a": {"b": 1}}'),
        ('{"a": 1, }', '{"a": 1}'),
        ('x {"a":\n{"b": 2,\n}', '{"a":\n{"b": 2}}'),
        ("nothing here", "nothing here"),
        ("}{", "}{"),
    ],
)
def test_repair(spark, text, fixed):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(jsontext.repair(F.col("x"))).first()[0] == fixed


GROUP = """Here: {
 "year": {"Domain-Specific Types": "General", "Entity Type": "Temporal Entity",
   "Function/Usage Context": "Aggregation Key", "Spatial": {"isSpatial": false, "resolution": ""},
   "Temporal": {"isTemporal": true, "resolution": "Year"}},
 "price": {"Domain-Specific Types": "Unknown", "Entity Type": "", "Function/Usage Context": "Measurement",
   "Spatial": {"isSpatial": "No", "resolution": ""}, "Temporal": {"isTemporal": "No"}},
 "extra": {"Entity Type": "X"},
}"""


def test_group_answer(spark):
    df = spark.createDataFrame([(GROUP, ["price", "year", "other"])], "a string, asked array<string>")
    found = semantics.parse_group_semantics(F.col("a"), F.col("asked"))
    row = df.select(found.alias("f"), semantics.dataset_semantic_text(found).alias("t")).first()
    assert [x.col_name for x in row.f] == ["price", "year"]
    assert row.t.split("\n") == [
        prompts.SEMANTIC_HEADING,
        "**price**: Function/Usage context: measurement. ",
        "**year**: Represents temporal entity. Contains temporal data (resolution: Year). "
        "Domain-specific type: general. Function/Usage context: aggregation key. ",
    ]


def test_single_answer_that_does_not_parse_is_null(spark):
    df = spark.createDataFrame([("no json",), ('{"Entity Type": "Place"}',)], "a string")
    got = [r[0] for r in df.select(semantics.parse_semantics(F.col("a"))).collect()]
    assert got[0] is None
    assert got[1]["Entity Type"] == "Place"


def test_group_prompt_lists_values_quoted(spark):
    df = spark.createDataFrame([(["it's", "b", 'say "x"'],)], "v array<string>")
    out = df.select(prompts.quoted_list(F.col("v"))).first()[0]
    assert out == str(["it's", "b", 'say "x"'])


def test_group_sizes(spark):
    df = records(spark, ("a", "t", "s", CITY, None))
    whole = semantics.group_prompts(df).collect()
    assert [len(r.asked) for r in whole] == [5]
    assert [len(r.asked) for r in semantics.group_prompts(df, 2).orderBy("group_no").collect()] == [2, 2, 1]
    places = semantics.batch_prompts(df, 2).orderBy("batch_no", "place").collect()
    assert [(r.batch_no, r.place) for r in places] == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)]


def test_description_prompt_sections(spark):
    df = spark.createDataFrame([("S", "", "M", None)], "s string, p string, m string, t string")
    text = df.select(
        prompts.description_prompt(F.col("s"), F.col("p"), F.col("m"), F.col("t"), 50)
    ).first()[0]
    assert "dataset profile is as follows" not in text
    assert "the dataset topic is" not in text
    assert "the semantic profile of the dataset columns is as follows:\nM\n" in text
    assert text.endswith("Answer:\n\nTarget length: approximately 50 words.")


def test_topic_prompt_without_original(spark):
    df = spark.createDataFrame([("T", None, "S"), ("T", "O", "S")], "t string, o string, s string")
    a, b = [r[0] for r in df.select(prompts.topic_prompt(*map(F.col, "tos"))).collect()]
    assert "Title: T\n\nDataset Sample: S" in a
    assert "Title: T\nOriginal Description: O\n\nDataset Sample: S" in b


def test_described_table(spark):
    df = records(
        spark,
        ("a", "City Temperature Sample", "s", CITY, "o"),
        ("b", "T", "s", "\n", None),
        ("c", "T", "s", 'x\n"open', None),
        ("c", "Again", "s", CITY, None),
    )
    for group_size in (0, 2):
        rows = describe.describe_catalog(df, group_size=group_size).collect()
        assert [r.generation_status for r in rows] == ["success", "error", "error", "success"]
        assert [r.error_message for r in rows][1:3] == [describe.NO_SAMPLE, "csv_parse_failed: EOF inside string"]
        good = rows[0]
        assert good.topic == "city temperature sample"
        assert good.search_description.startswith(good.generated_description)
        assert good.semantic_profile.count("\n") == 5
        # Two records with one id keep their own texts.
        assert rows[3].topic == "again"
        assert rows[1].dataset_profile is None


def test_plain_descriptions_name_the_bad_row(spark):
    df = records(spark, ("a", "t", "s", CITY, None), ("b", "t", "s", " ", None))
    good, bad = describe.generate_descriptions(df).collect()
    assert good.status == "success" and good.prompt.startswith("Answer the question")
    assert bad.error_message == "Row for dataset_id=b is missing a valid sample_csv value."
    assert bad.prompt is None


class Echo:
    """Fails on request, answers with the sizes of what it was sent."""

    def chat_completions_create(self, model, messages, temperature=0.0, **kwargs):
        if "boom" in messages[-1]["content"]:
            raise RuntimeError("service down")
        return {"choices": [{"message": {"content": f"{model}:{len(messages)}:{temperature}"}}], "usage": {"total_tokens": 3}}


def test_client_provider(spark):
    provider = complete.ClientProvider(Echo, "m", {"topic": "be brief"}, temperature=0.5, max_tries=2)
    df = spark.createDataFrame([("hi",), ("boom",), (None,)], "p string")
    rows = [r.answer for r in complete.complete(df, "topic", F.col("p"), provider, tasks=2).collect()]
    by_status = {(r.status, r.error): r for r in rows}
    assert by_status["success", None].content == "m:2:0.5"
    assert by_status["success", None].total_tokens == 3
    assert by_status["error", "service down"].attempts == 2
    assert ("error", "no_prompt") in by_status


def test_client_provider_runs_the_whole_table(spark):
    provider = complete.ClientProvider(Echo, "m", describe.SYSTEM_MESSAGES)
    row = describe.describe_catalog(records(spark, ("a", "t", "s", CITY, None)), provider).first()
    assert row.generation_status == "success"
    assert row.generated_description == "m:2:0.0"
    # The semantic answer is not JSON, so that step fails softly.
    assert row.semantic_profile is None
    grid = describe.variant_grid(records(spark, ("a", "t", "s", CITY, None)), [0.0, 0.5], [50], [True], provider)
    found = {r.variant: r.description for r in grid.collect()}
    assert found == {
        "baseline": "m:2:0.5",
        "temperature-0.0+num_words-50+use_semantic_profile-True+use_topic-True": "m:2:0.0",
        "temperature-0.5+num_words-50+use_semantic_profile-True+use_topic-True": "m:2:0.5",
    }


def test_facade_needs_an_evaluator(spark):
    facade = describe.Describer(complete.OfflineProvider())
    df = spark.createDataFrame([("some text here",)], "generated_description string")
    with pytest.raises(RuntimeError):
        facade.evaluate(df)
    facade.set_evaluator(complete.OfflineProvider())
    assert facade.evaluate(df).first().completeness == 1


def test_length_stats(spark):
    df = spark.createDataFrame([(1,), (2,), (4,), (9,), (None,)], "n int")
    row = evaluation.length_stats(df, ["n"]).first()
    assert (row["count"], row["mean"], row["p25"], row["p50"], row["p75"]) == (4, 4.0, 1.8, 3.0, 5.2)
    assert row["std"] == 3.6


def test_coverage_counts_are_those_of_single_groupings(spark):
    df = spark.createDataFrame(
        [("s", "ok", True), ("s", "ok", False), ("r", "bad", True), (None, "ok", True)],
        "source string, generation_status string, has_topic boolean",
    )
    got = evaluation.coverage_counts(df, [["source"], ["source", "has_topic"]])
    rows = {(r.grouping, r.source, r.has_topic): r["count"] for r in got.collect()}
    assert rows["source", "s", None] == 2
    assert rows["source,has_topic", "s", False] == 1
    assert rows["source", None, None] == 1
    assert len(rows) == 7


def test_any_double_has_a_text(spark):
    import random

    pick = random.Random(1)
    values = [1e30, 1e-12, -1e-4, 0.0001234, 1e15, 1e16, 123456789.125, -0.1, 5e-324, 1.7976931348623157e308, 1e7, 99999999.0]
    values += [pick.uniform(-1, 1) * 10.0 ** pick.randrange(-20, 25) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["v"]: r["t"] for r in df.select("v", structural.number_text(F.col("v")).alias("t")).collect()}
    assert all(float(t) == v and ("e" in t) == ("e" in repr(v)) and "E" not in t for v, t in got.items())
    assert [got[v] for v in (1e30, 1e-12, -1e-4, 123456789.125, 1e7)] == ["1e+30", "1e-12", "-0.0001", "123456789.125", "10000000.0"]


def test_a_large_cell_does_not_stop_the_others(spark):
    df = spark.createDataFrame([("a", "n\n1e30\n1e-12"), ("b", "n\n1\n2")], "dataset_id string, sample_csv string")
    texts = {r.dataset_id: r.dataset_profile for r in structural.render_profiles(df).collect()}
    assert "to 1e+30. " in texts["a"] and "to 2.0. " in texts["b"]


def test_comma_before_a_closing_brace_is_an_answer():
    from cataloom.operators.complete import _looks_like_json

    assert _looks_like_json('so {"a": 1,} ok') and _looks_like_json('{"a": {"b": 1, } ,}') and not _looks_like_json("{a}")


def test_dates_as_portals_write_them(spark):
    from datetime import datetime

    columns = {
        "us": (["01/31/2020", "2/1/2020 01:05:09 PM"], datetime(2020, 1, 31), datetime(2020, 2, 1, 13, 5, 9)),
        "european": (["31.01.2020", "01.02.2020"], datetime(2020, 1, 31), datetime(2020, 2, 1)),
        "ambiguous": (["03/04/2020", "03/05/2020 12:00 am"], datetime(2020, 3, 4), datetime(2020, 3, 5)),
        "months": (["January 31, 2020", "1 Feb 2020"], datetime(2020, 1, 31), datetime(2020, 2, 1)),
        "year": (["2020/01/31", "2019/12/31 23:59"], datetime(2019, 12, 31, 23, 59), datetime(2020, 1, 31)),
        "iso": (["2020-01-31T10:00:00.000Z", "2020-02-01"], datetime(2020, 1, 31, 10), datetime(2020, 2, 1)),
        "no day": (["02/30/2020", "01/31/2020"], None, None),
        "both": (["13/01/2020", "01/13/2020"], None, None),
        "words": (["room 2020 a", "x"], None, None),
        "no month": (["31 Foo 2020", "1 Feb 2020"], None, None),
        "no hour": (["01/31/2020 13:00 PM", "01/31/2020"], None, None),
    }
    rows = [(name, "c\n" + "\n".join(f'"{v}"' for v in values)) for name, (values, _, _) in columns.items()]
    got = {r.dataset_id: r for r in structural.profile_rows(spark.createDataFrame(rows, "dataset_id string, sample_csv string")).collect()}
    for name, (_, first, last) in columns.items():
        r = got[name]
        assert (r.data_type, r.first_time and r.first_time.replace(tzinfo=None), r.last_time and r.last_time.replace(tzinfo=None)) == ("datetime" if first else "text", first, last), name


class Batches:
    """Answers several prompts at once: loses the last of three, fails on some, and counts its calls."""

    def __init__(self):
        self.calls = 0

    def chat_completions_create_batch(self, model, messages_list, temperature=0.0):
        self.calls += 1
        texts = [m[-1]["content"] for m in messages_list]
        if "boom" in texts:
            raise RuntimeError("service down")
        replies = [{"choices": [{"message": {"content": f"{t} of {len(texts)} in call {self.calls}"}}], "usage": {"total_tokens": 2}} for t in texts]
        return replies[:2] if len(replies) == 3 else [*replies, {"choices": []}]


def test_batched_calls_are_aligned_by_place(spark):
    provider = complete.BatchProvider(Batches, "m", max_tries=2, batch_size=3)
    rows = [(1, ["a", "b"]), (2, None), (3, ["c", None, "d"]), (4, []), (5, ["e"])]
    df = spark.createDataFrame(rows, "id int, p array<string>").coalesce(1)
    got = {r.id: r.answer for r in df.withColumn("answer", provider.columns("topic", F.col("p"), {})).collect()}
    told = {i: None if a is None else [(x.content, x.attempts, x.status, x.total_tokens) for x in a] for i, a in got.items()}
    assert told == {
        1: [("a of 3 in call 1", 1, "success", 2), ("b of 3 in call 1", 1, "success", 2)],
        2: None,
        3: [("c of 1 in call 3", 2, "success", 2), (None, 0, "error", None), ("d of 2 in call 2", 1, "success", 2)],
        4: [],
        5: [("e of 2 in call 2", 1, "success", 2)],
    }
    df = spark.createDataFrame([("boom",), ("x",), (None,), ("y",), ("z",)], "p string").coalesce(1)
    one = complete.BatchProvider(Batches, "m", max_tries=1, batch_size=2)
    found = [r.answer for r in complete.complete(df, "topic", F.col("p"), one).collect()]
    assert [(a.status, a.error) for a in found] == [
        ("error", "service down"), ("error", "service down"), ("error", "no_prompt"), ("success", None), ("success", None)
    ]
    short = complete.complete(df.filter("p in ('x', 'y', 'z')"), "topic", F.col("p"), complete.BatchProvider(Batches, "m", max_tries=1, batch_size=3))
    assert [r.answer.error for r in short.collect()] == [None, None, "no_answer"]
    with pytest.raises(ValueError):
        complete.complete(df, "topic", F.col("p"), complete.BatchProvider(Batches, "m", batch_size=0))


def test_grouped_answers_tell_the_columns_asked(spark):
    """Each group's answer is about its columns only, and the texts are those of one prompt for all."""
    twice = "a,b,a,c\n1,x,2,y\n"
    rows = records(spark, ("a", "t", "s", CITY, None), ("b", "t", "s", twice, None), ("c", "t", "s", None, None))
    offline = complete.OfflineProvider()
    asked = F.array(F.array(F.lit("City"), F.lit("lat")), F.array(F.lit("when")))
    context = {"profile": F.col("profile"), "asked": asked}
    answers = structural.sample_profiles(rows.filter("dataset_id = 'a'")).select(offline.columns("group_semantics", F.array(F.lit("p"), F.lit("q")), context).alias("x"))
    assert [sorted(json.loads(x.content)) for x in answers.first().x] == [["City", "lat"], ["when"]]
    found = [{r.dataset_id: r.semantic_profile for r in describe.describe_catalog(rows, group_size=n).collect()} for n in (0, 1, 2, 3)]
    assert found[0]["a"].count("**: Represents") == 5 and found[0]["c"] is None
    assert found[1:] == found[:1] * 3


def test_replies_are_aligned_by_place(spark):
    asked = spark.createDataFrame([("a", 0, i, f"c{i}") for i in range(3)] + [("b", 0, 0, "c")], "dataset_id string, batch_no long, place int, col_name string")
    replies = spark.createDataFrame([("a", 0, ["x", "y"])], "dataset_id string, batch_no long, answers array<string>")
    got = sorted((r.dataset_id, r.place, r.answer, r.status) for r in semantics.align_answers(asked, replies).fillna("-").collect())
    assert got == [("a", 0, "x", "success"), ("a", 1, "y", "success"), ("a", 2, "-", "no_answer"), ("b", 0, "-", "no_answer")]


class ColumnClient:
    """Answers each kind of question with what it was asked about."""

    def chat_completions_create(self, model, messages, temperature=0.0, **kwargs):
        content = '{"Entity Type": "Thing",}' if "Entity Type" in messages[-1]["content"] else f"{len(messages)} parts"
        return {"choices": [{"message": {"content": content}}]}


def test_facade_steps_one_by_one(spark):
    provider = complete.ClientProvider(ColumnClient, "m", describe.SYSTEM_MESSAGES)
    facade = describe.Describer(provider)
    rows = records(spark, ("a", "t", "s", CITY, None), ("b", "t", "s", None, None))
    told = {r.dataset_id: r.semantic_profile for r in facade.analyze_semantics(rows).collect()}
    assert "Represents thing" in told["a"] and told["b"] is None
    topics = {r.dataset_id: r.topic for r in facade.generate_topic(rows).collect()}
    assert topics == {"a": "2 parts", "b": None}
    texts = {r.dataset_id: r.generated_description for r in facade.describe_dataset(rows.withColumn("topic", F.lit("x"))).collect()}
    assert texts == {"a": "2 parts", "b": None}
    search = facade.expand_description_for_search(
        spark.createDataFrame([("d", "x"), ("d", None)], "generated_description string, topic string")
    )
    assert sorted(str(r.search_description) for r in search.collect()) == ["2 parts", "None"]
    full = describe.describe_catalog(rows.filter("dataset_id = 'a'"), provider, per_column=True).first()
    assert "Represents thing" in full.semantic_profile and full.generation_status == "success"


def test_exploded_columns_are_not_asked_twice(spark, monkeypatch):
    """Spark would infer a filter from an exploded column, and parse every sample again for it."""
    df = spark.createDataFrame([("a", "n,d\n1,13/01/2020\n,12/02/2020"), ("b", 'n\n"open'), ("c", None)], "dataset_id string, sample_csv string")
    frames = [structural.profile_rows(df), semantics.column_prompts(df), sampling.explode_sample_cells(df)]
    for frame in frames:
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert not [line for line in plan.splitlines() if "Filter" in line and "size(" in line]
        assert {r.dataset_id for r in frame.collect()} == {"a"}
    times = {r.col_name: str(r.first_time) for r in frames[0].collect()}
    assert times["d"] == "2020-01-13 00:00:00"


def test_a_prompt_is_evaluated_once(spark):
    asked, n = spark.createDataFrame([("a",), (None,)], "p string"), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def told(p):
        n.add(1)
        return p

    @F.udf("array<string>")
    def all_told(p):
        n.add(1)
        return None if p is None else [p, None]

    provider = complete.OfflineProvider()
    one = provider.column("quality", told("p").alias("p"), {"description": F.lit("x")})
    many = provider.columns("quality", all_told("p"), {"description": F.lit("x")})
    rows = asked.select(one.alias("one"), many.alias("many")).collect()
    assert n.value == 4
    assert [r.one.status for r in rows] == ["success", "error"]
    assert [r.one.total_tokens - r.one.completion_tokens for r in rows] == [1, 0]
    assert [a.prompt_tokens for a in rows[0].many] == [1, 0] and rows[1].many is None


@pytest.mark.parametrize(
    "values, text",
    [
        (["a", "b"], "['a', 'b']"),
        (["a, b", ""], "['a, b', '']"),
        ([], "[]"),
        (["a", None, "b"], "['a', 'b']"),
        (["it's", "b"], "[\"it's\", 'b']"),
        (["a\nb", 'c"d'], "['a\\nb', 'c\"d']"),
        (None, None),
    ],
)
def test_quoted_lists(spark, values, text):
    df = spark.createDataFrame([(values,)], "v array<string>")
    assert df.select(prompts.quoted_list(F.col("v"))).first()[0] == text


def test_braces_are_counted_behind_wide_characters(spark):
    df = spark.createDataFrame([('so {"\u00e4": {"\U0001f600": "x", \n}, ',), ("}{",), ("{a{b}",)], "t string")
    assert [r[0] for r in df.select(jsontext.repair(F.col("t"))).collect()] == ['{"\u00e4": {"\U0001f600": "x"}}', "}{", "{a{b}}"]


def test_plain_values_are_quoted_without_a_look_at_each(spark):
    """A plain list is joined; the chain of replacements is asked only where a value needs it."""
    df = spark.createDataFrame([(["a", "b"],)], "v array<string>").select(prompts.quoted_list(F.col("v")).alias("q"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "array_join(v#" in plan and plan.index("array_join(v#") < plan.index("transform(v#")
