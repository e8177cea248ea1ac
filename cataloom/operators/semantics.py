"""Column semantics: prompts per column, parsing of answers, text assembly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsontext, prompts
from ..functions.text import elements, let
from .sampling import column_sample_values

# Field names as the prompt asks for them.
SEMANTICS = (
    "struct<Temporal:struct<isTemporal:string,resolution:string>,"
    "Spatial:struct<isSpatial:string,resolution:string>,"
    "`Entity Type`:string,`Domain-Specific Types`:string,`Function/Usage Context`:string>"
)


def column_prompts(df: DataFrame, k: int = 5) -> DataFrame:
    """One prompt per column of every sample."""
    return (
        column_sample_values(df, k)
        .select("dataset_id", F.explode(elements("column_values")).alias("c"))
        .select(
            "dataset_id",
            "c.col_no",
            "c.col_name",
            prompts.column_prompt(F.col("c.col_name"), F.col("c.sample_values")).alias("prompt"),
        )
    )


def chunks(columns: Column, size: int) -> Column:
    """Consecutive groups of ``size`` elements, one group for size 0."""
    if size <= 0:
        return F.when(F.size(columns) > 0, F.array(columns))
    return let(
        columns,
        lambda all_columns: F.transform(
            F.when(
                F.size(all_columns) > 0,
                F.sequence(F.lit(0), F.size(all_columns) - 1, F.lit(size)),
            ),
            lambda s: F.slice(all_columns, s + 1, F.lit(size)),
        ),
    )


def group_prompts(df: DataFrame, group_size: int = 0, k: int = 5) -> DataFrame:
    """One prompt per ``group_size`` consecutive columns, 0 for all columns of a dataset."""
    return (
        column_sample_values(df, k)
        .select(
            "dataset_id",
            F.posexplode(chunks(F.col("column_values"), group_size)).alias("group_no", "cols"),
        )
        .select(
            "dataset_id",
            "group_no",
            F.transform("cols", lambda c: c["col_name"]).alias("asked"),
            prompts.group_prompt(F.col("cols")).alias("prompt"),
        )
    )


def batch_prompts(df: DataFrame, batch_size: int = 4, k: int = 5) -> DataFrame:
    """Column prompts with the batch they are sent in and their place there."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    number = F.col("col_no")
    return column_prompts(df, k).select(
        "dataset_id",
        F.floor(number / batch_size).alias("batch_no"),
        (number % batch_size).alias("place"),
        "col_name",
        "prompt",
    )


def align_answers(asked: DataFrame, replies: DataFrame) -> DataFrame:
    """Add ``answer`` and ``status`` to batched prompts, from one row of replies per batch.

    ``replies`` is ``(dataset_id, batch_no, answers)``; answers belong to prompts by place.  A prompt without
    one, in a short list or a batch without replies, has a null answer and the status ``no_answer``.
    """
    given = asked.join(replies.select("dataset_id", "batch_no", "answers"), ["dataset_id", "batch_no"], "left")
    answer = F.get("answers", F.col("place").cast("int"))
    return given.select(*asked.columns, answer.alias("answer")).withColumn(
        "status", F.when(F.col("answer").isNotNull(), "success").otherwise("no_answer")
    )


def is_json(text: Column) -> Column:
    return F.coalesce(F.try_parse_json(text).isNotNull(), F.lit(False))


def _read(answer: Column, kind: str) -> Column:
    """The repaired answer as ``kind``, null when it is not JSON."""
    return let(jsontext.repair(answer), lambda x: F.when(is_json(x), F.from_json(x, kind)))


def parse_semantics(answer: Column) -> Column:
    """Answer about one column -> struct, null when it does not parse."""
    return _read(answer, SEMANTICS)


def parse_group_semantics(answer: Column, asked: Column) -> Column:
    """Answer about several columns -> ``array<struct<col_name, semantics>>`` in the order asked.

    Columns nobody asked for are dropped, columns without an answer are left out.
    """
    found = let(
        _read(answer, f"map<string,{SEMANTICS}>"),
        lambda by_name: F.transform(
            asked,
            lambda name: F.struct(
                name.alias("col_name"), F.try_element_at(by_name, name).alias("semantics")
            ),
        ),
    )
    return F.filter(found, lambda x: x["semantics"].isNotNull())


def yes(flag: Column) -> Column:
    """``true`` and ``yes`` in any case count as yes, everything else as no.

    The prompt asks for Yes or No and shows booleans.  Taking any non-empty text as yes would
    read ``"No"`` as yes, so the engine deliberately looks at the word.
    """
    return F.coalesce(F.lower(F.trim(flag)).isin("true", "yes"), F.lit(False))


def column_semantic_text(name: Column, semantics: Column) -> Column:
    """``**column**: Represents ... `` with the parts that are known."""

    def known(field: str, before: str) -> Column:
        value = F.lower(semantics[field])
        return F.when(
            ~value.isin("", "unknown"), F.concat(F.lit(before), value, F.lit(". "))
        ).otherwise(F.lit(""))

    def located(kind: str, flag: str, word: str) -> Column:
        part = semantics[kind]
        return F.when(
            yes(part[flag]),
            F.concat(
                F.lit(f"Contains {word} data (resolution: "),
                F.coalesce(part["resolution"], F.lit("unknown")),
                F.lit("). "),
            ),
        ).otherwise(F.lit(""))

    return F.concat(
        F.lit("**"),
        name,
        F.lit("**: "),
        known("Entity Type", "Represents "),
        located("Temporal", "isTemporal", "temporal"),
        located("Spatial", "isSpatial", "spatial"),
        known("Domain-Specific Types", "Domain-specific type: "),
        known("Function/Usage Context", "Function/Usage context: "),
    )


def dataset_semantic_text(answered: Column) -> Column:
    """Heading and the column texts in column order, from ``array<struct<col_name, semantics>>``."""
    lines = F.transform(answered, lambda c: column_semantic_text(c["col_name"], c["semantics"]))
    return F.concat(
        F.lit(prompts.SEMANTIC_HEADING + "\n"),
        F.array_join(F.coalesce(lines, F.array().cast("array<string>")), "\n"),
    )


def token_usage_stats(answers: DataFrame, by: list[str]) -> DataFrame:
    """Calls and tokens per key, counted from what the provider reports."""
    return answers.groupBy(*by).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum("total_tokens").alias("total_tokens"),
    )
