"""Describe records: one lazy plan, row by row, no shuffle.

Everything a description needs lies in the record's own row (sample, title, original text), so
the whole run is a chain of projections and scales with the number of tasks.  A failed step is a
null or an ``error`` row; it never stops the other rows.

Answers are the costly part of a run.  Write the described table (``sources.stages.write_stage``)
before filtering or counting it; a filter on a lazy run would be pushed below the answers and
ask for them twice.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import prompts
from ..functions.text import has_visible_text, strip
from ..operators import judging, sampling, semantics, structural
from ..operators.complete import OfflineProvider, Provider, complete
from ..operators.prepare import align_schema, limit_records, require_columns

NO_SAMPLE = "missing_or_empty_sample_csv_after_shrink"

# System messages a client provider sends with each task.
SYSTEM_MESSAGES = {
    "description": prompts.DESCRIBE_SYSTEM_MESSAGE,
    "search": prompts.SEARCH_SYSTEM_MESSAGE,
    "topic": prompts.TOPIC_SYSTEM_MESSAGE,
    "column_semantics": prompts.SEMANTIC_SYSTEM_MESSAGE,
    "group_semantics": prompts.SEMANTIC_GROUP_SYSTEM_MESSAGE,
    "quality": prompts.QUALITY_SYSTEM_MESSAGE,
    "verdict": prompts.PAIR_SYSTEM_MESSAGE,
}


def _described(
    df: DataFrame, provider: Provider, prompt: Column, topic: Column | None = None
) -> DataFrame:
    context = {"profile": F.col("profile"), "n_rows": F.col("n_rows")}
    if topic is not None:
        context["topic"] = topic
    return complete(
        df.withColumn("prompt", prompt), "description", F.col("prompt"), provider, context
    )


def generate_descriptions(
    records: DataFrame, provider: Provider | None = None, max_records: int | None = None
) -> DataFrame:
    """Plain form: prompt and description per record, an error row for a blank sample."""
    require_columns(records)
    if max_records is not None:
        records = limit_records(records, max_records, ["dataset_id"])
    valid = has_visible_text(F.col("sample_csv"))
    usable = structural.sample_profiles(
        records.withColumn("_csv", F.when(valid, F.col("sample_csv"))), "_csv"
    )
    answered = _described(usable, provider or OfflineProvider(), prompts.description_prompt(F.col("_csv")))
    ok = F.col("answer.status") == "success"
    invalid = F.concat(
        F.lit("Row for dataset_id="),
        F.coalesce(F.col("dataset_id").cast("string"), F.lit("None")),
        F.lit(" is missing a valid sample_csv value."),
    )
    return answered.select(
        "dataset_id",
        "title",
        "source",
        F.when(ok, F.col("prompt")).alias("prompt"),
        F.col("answer.content").alias("generated_description"),
        F.when(ok, "success").otherwise("error").alias("status"),
        F.when(F.col("_csv").isNull(), invalid)
        .when(~ok, F.col("answer.error"))
        .alias("error_message"),
    )


def generate_open_data_descriptions(
    records: DataFrame,
    provider: Provider | None = None,
    max_chars: int = 8000,
    max_lines: int = 8,
) -> DataFrame:
    """Open-data form: shortened sample, ten columns."""
    shrunk = structural.sample_profiles(
        sampling.shrink_samples(records, max_chars, max_lines), "shrunk_csv"
    )
    answered = _described(
        shrunk, provider or OfflineProvider(), prompts.description_prompt(F.col("shrunk_csv"))
    )
    ok = F.col("answer.status") == "success"
    out = (
        answered.withColumn("generated_description", F.col("answer.content"))
        .withColumn("generation_status", F.when(ok, "success").otherwise("error"))
        .withColumn(
            "error_message",
            F.when(F.col("shrunk_csv").isNull(), NO_SAMPLE).when(~ok, F.col("answer.error")),
        )
    )
    return align_schema(out, schemas.DESCRIPTIONS)


def describe_catalog(
    records: DataFrame,
    provider: Provider | None = None,
    max_chars: int = 12000,
    max_lines: int = 20,
    num_words: int = 100,
    group_size: int = 0,
    per_column: bool = False,
) -> DataFrame:
    """The full run: shorten, parse, profile, semantics, topic, description, search text.

    Profile, semantics, topic and search text fail softly (null).  A blank sample, a sample that
    does not parse, or a failed description is an ``error``.  Search text needs a topic.
    """
    provider = provider or OfflineProvider()
    shrunk = sampling.shrink_samples(records, max_chars, max_lines)
    profiled = structural.render_profiles(shrunk, "shrunk_csv")
    usable = F.col("shrunk_csv").isNotNull() & F.col("csv_error").isNull()

    # Semantics: all columns of a dataset in one prompt, in groups, or one by one.
    with_semantics = _with_semantics(profiled, provider, group_size, usable, per_column)

    with_topic = _with_topic(with_semantics, provider, F.when(usable, F.col("shrunk_csv")))
    described = _described(
        with_topic,
        provider,
        F.when(
            usable,
            prompts.description_prompt(
                F.col("shrunk_csv"),
                F.col("dataset_profile"),
                F.col("semantic_profile"),
                F.col("topic"),
                num_words,
            ),
        ),
        topic=F.col("topic"),
    )
    ok = F.col("answer.status") == "success"
    finished = (
        described.withColumn("generated_description", F.col("answer.content"))
        .withColumn("generation_status", F.when(ok, "success").otherwise("error"))
        .withColumn(
            "error_message",
            F.when(F.col("shrunk_csv").isNull(), NO_SAMPLE)
            .when(F.col("csv_error").isNotNull(), F.col("csv_error"))
            .when(~ok, F.col("answer.error")),
        )
        .drop("answer")
    )
    return align_schema(_with_search_text(finished, provider), schemas.DESCRIPTIONS_FULL)


def _with_topic(df: DataFrame, provider: Provider, sample: Column) -> DataFrame:
    """Add ``topic``; records without a sample are not asked."""
    asked = F.when(sample.isNotNull(), prompts.topic_prompt(F.col("title"), F.col("original_description"), sample))
    context = {"title": F.col("title"), "profile": F.col("profile")}
    answered = complete(df, "topic", asked, provider, context)
    return answered.withColumn("topic", strip(F.col("answer.content"))).drop("answer")


def _with_search_text(df: DataFrame, provider: Provider) -> DataFrame:
    """Add ``search_description``; records without a topic are not asked."""
    asked = F.when(F.col("topic") != "", prompts.search_prompt(F.col("generated_description"), F.col("topic")))
    context = {"description": F.col("generated_description"), "topic": F.col("topic")}
    answered = complete(df, "search", asked, provider, context)
    return answered.withColumn("search_description", F.col("answer.content")).drop("answer")


def _with_semantics(
    df: DataFrame, provider: Provider, group_size: int, usable: Column, per_column: bool = False
) -> DataFrame:
    """Add ``semantic_profile``, asked with one prompt per group of columns (0: one for all) or per
    column.

    The prompts of a record stay in its row as an array, so the answers need no way back.
    """
    asked = sampling.column_sample_values(df, 5, "shrunk_csv")
    context = {"profile": F.col("profile")}
    if per_column:
        questions = F.transform("column_values", lambda c: prompts.column_prompt(c["col_name"], c["sample_values"]))
        asked = asked.withColumn("_groups", F.when(usable, F.col("column_values")))
        answered = asked.withColumn("_answers", provider.columns("column_semantics", F.when(usable, questions), context))
        told = F.zip_with(
            "_answers",
            "_groups",
            lambda a, c: F.struct(c["col_name"].alias("col_name"), semantics.parse_semantics(a["content"]).alias("semantics")),
        )
        found = F.filter(told, lambda t: t["semantics"].isNotNull())
    else:
        asked = asked.withColumn("_groups", F.when(usable, semantics.chunks(F.col("column_values"), group_size)))
        if group_size > 0:
            context["asked"] = F.transform("_groups", lambda g: F.transform(g, lambda c: c["col_name"]))
        answered = asked.withColumn(
            "_answers", provider.columns("group_semantics", F.transform("_groups", prompts.group_prompt), context)
        )
        found = F.flatten(
            F.zip_with(
                "_answers",
                "_groups",
                lambda a, g: F.coalesce(
                    semantics.parse_group_semantics(
                        a["content"], F.transform(g, lambda c: c["col_name"])
                    ),
                    _no_answers(),
                ),
            )
        )
    text = F.when(
        F.exists("_answers", lambda a: a["status"] == "success"),
        semantics.dataset_semantic_text(F.coalesce(found, _no_answers())),
    )
    return answered.withColumn("semantic_profile", text).drop(
        "_answers", "_groups", "column_values"
    )


def _no_answers() -> Column:
    return F.array().cast(
        T.ArrayType(
            T.StructType(
                [
                    T.StructField("col_name", T.StringType()),
                    T.StructField("semantics", T._parse_datatype_string(semantics.SEMANTICS)),
                ]
            )
        )
    )


# Fixed value: the key of a setting.
VARIANT_KEY = "temperature-{heat}+num_words-{size}+use_semantic_profile-{use}+use_topic-{use}"


def variant_name(heat: float, size: int, use: bool) -> str:
    return VARIANT_KEY.format(heat=heat, size=size, use=use)


def variant_grid(
    records: DataFrame,
    temperatures: list[float],
    num_words: list[int],
    semantic_choices: list[bool],
    provider: Provider | None = None,
) -> DataFrame:
    """Descriptions of every setting: ``(dataset_id, variant, prompt, description)``.

    ``records`` has ``dataset_id, sample_csv`` and may have ``dataset_profile,
    semantic_profile, topic``.  Settings are a literal list exploded per record.  The baseline is
    overwritten by each pass in the original order of settings, so only the last one is made.
    """
    provider = provider or OfflineProvider()

    def setting(name: str, heat, size, use_semantic, is_baseline: bool) -> Column:
        return F.struct(
            F.lit(name).alias("variant"),
            F.lit(float(heat)).alias("temperature"),
            F.lit(int(size)).alias("num_words"),
            F.lit(bool(use_semantic)).alias("use_semantic"),
            F.lit(is_baseline).alias("is_baseline"),
        )

    pairs = list(product(temperatures, num_words))
    settings = {
        variant_name(heat, size, use): setting(variant_name(heat, size, use), heat, size, use, False)
        for (heat, size), use in product(pairs, semantic_choices)
    }
    if pairs:
        settings["baseline"] = setting("baseline", *pairs[-1], False, True)
    if not settings:
        raise ValueError("no setting given")

    def given(column: str, when: Column) -> Column:
        value = F.col(column) if column in records.columns else F.lit(None).cast("string")
        return F.when(when, value)

    plain = F.col("is_baseline")
    rows = (
        structural.sample_profiles(records, "sample_csv")
        .withColumn("_s", F.explode(F.array(*settings.values())))
        .select("*", "_s.*")
        .drop("_s")
    )
    topic = given("topic", F.col("use_semantic"))
    prompt = prompts.description_prompt(
        F.col("sample_csv"),
        given("dataset_profile", ~plain),
        given("semantic_profile", F.col("use_semantic")),
        topic,
        F.col("num_words"),
    )
    if not hasattr(provider, "temperature"):  # its answers do not depend on it
        out = _described(rows, provider, prompt, topic=topic)
    else:
        heats = list(dict.fromkeys(float(t) for t in temperatures))
        parts = [
            _described(rows.filter(F.col("temperature") == heat), replace(provider, temperature=heat), prompt, topic=topic)
            for heat in heats
        ]
        out = reduce(DataFrame.unionByName, parts)
    return out.select(
        "dataset_id", "variant", "prompt", F.col("answer.content").alias("description")
    )


@dataclass
class Describer:
    """Settings of a run in one object; every method takes and returns DataFrames."""

    provider: Provider
    num_words: int = 100
    max_chars: int = 12000
    max_lines: int = 20
    evaluator: Provider | None = None

    def profile(self, records: DataFrame) -> DataFrame:
        return structural.render_profiles(records)

    def describe(self, records: DataFrame, group_size: int = 0) -> DataFrame:
        return describe_catalog(
            records, self.provider, self.max_chars, self.max_lines, self.num_words, group_size
        )

    def _shrunk(self, records: DataFrame) -> DataFrame:
        shrunk = sampling.shrink_samples(records, self.max_chars, self.max_lines)
        return structural.render_profiles(shrunk, "shrunk_csv")

    def analyze_semantics(self, records: DataFrame, group_size: int = 0, per_column: bool = True) -> DataFrame:
        """Records with ``semantic_profile``."""
        usable = F.col("shrunk_csv").isNotNull() & F.col("csv_error").isNull()
        return _with_semantics(self._shrunk(records), self.provider, group_size, usable, per_column).select(
            *records.columns, "semantic_profile"
        )

    def generate_topic(self, records: DataFrame) -> DataFrame:
        """Records ``(title, original_description, sample_csv)`` with ``topic``."""
        return _with_topic(self._shrunk(records), self.provider, F.col("shrunk_csv")).select(*records.columns, "topic")

    def describe_dataset(self, records: DataFrame) -> DataFrame:
        """Records with ``generated_description``; ``dataset_profile``, ``semantic_profile`` and
        ``topic`` are used where the records have them."""

        def given(column: str) -> Column:
            return F.col(column) if column in records.columns else F.lit(None).cast("string")

        shrunk = sampling.shrink_samples(records, self.max_chars, self.max_lines)
        profiled = structural.sample_profiles(shrunk, "shrunk_csv")
        prompt = prompts.description_prompt(
            F.col("shrunk_csv"), given("dataset_profile"), given("semantic_profile"), given("topic"), self.num_words
        )
        asked = F.when(F.col("shrunk_csv").isNotNull(), prompt)
        answered = _described(profiled, self.provider, asked, topic=given("topic"))
        return answered.select(*records.columns, F.col("answer.content").alias("generated_description"))

    def expand_description_for_search(self, df: DataFrame) -> DataFrame:
        """Rows ``(generated_description, topic)`` with ``search_description``."""
        return _with_search_text(df, self.provider)

    def set_evaluator(self, evaluator: Provider) -> None:
        self.evaluator = evaluator

    def evaluate(self, df: DataFrame, text: str = "generated_description") -> DataFrame:
        if self.evaluator is None:
            raise RuntimeError("no evaluator is set, call set_evaluator() first")
        return judging.scored(judging.evaluate_texts(df, self.evaluator, text))
