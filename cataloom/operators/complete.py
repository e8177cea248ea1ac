"""One model answer per row.

A provider turns a prompt column into a struct column (:data:`cataloom.schemas.ANSWERS`), so
prompts stay where their rows are and nothing but prompt and answer crosses into Python.

* :class:`OfflineProvider` is **not a language model**.  It answers from rules, as native
  columns, so that plans and tests run without a service.
* :class:`ClientProvider` wraps any chat client; the client is built once per task.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.text import let, vectoriser_terms, words

SYSTEM = "system"


# Fixed value: the offline provider counts one token for so many characters.
CHARS_PER_TOKEN = 4


def _tokens(text: Column) -> Column:
    return F.ceil(F.length(F.coalesce(text, F.lit(""))) / CHARS_PER_TOKEN)


def _answer(content: Column, prompt: Column) -> Column:
    """The answer struct; ``content`` and ``prompt`` are evaluated once."""

    def answer(x: Column) -> Column:
        c, told = x["content"], _tokens(x["content"])
        return F.struct(
            c.alias("content"),
            x["asked"].alias("prompt_tokens"),
            told.alias("completion_tokens"),
            (x["asked"] + told).alias("total_tokens"),
            F.lit(1).alias("attempts"),
            F.when(c.isNotNull(), "success").otherwise("error").alias("status"),
            F.when(c.isNull(), "no_answer").alias("error"),
        )

    return let(F.struct(content.alias("content"), _tokens(prompt).alias("asked")), answer)


class Provider:
    """``column`` returns the answer struct for one task.

    ``context`` holds the columns the prompt was built from; a provider that only needs the
    prompt ignores it.
    """

    def column(self, task: str, prompt: Column, context: dict[str, Column]) -> Column:
        raise NotImplementedError

    def columns(self, task: str, prompts: Column, context: dict[str, Column]) -> Column:
        """Answers to an array of prompts, in its order.

        ``asked`` in ``context`` has for each prompt the names of the columns it is about.
        """
        raise NotImplementedError


class OfflineProvider(Provider):
    """Deterministic rules in place of a model."""

    def column(self, task: str, prompt: Column, context: dict[str, Column]) -> Column:
        content = getattr(self, task)(**context)
        return let(prompt, lambda p: _answer(F.when(p.isNotNull(), content), p))

    def columns(self, task: str, prompts: Column, context: dict[str, Column]) -> Column:
        about = dict(context)
        groups = about.pop("asked", None)
        if groups is not None:
            return F.zip_with(prompts, groups, lambda p, names: _answer(getattr(self, task)(asked=names, **about), p))
        content = getattr(self, task)(**context)
        return let(
            prompts,
            lambda asked: let(
                F.when(asked.isNotNull(), content),
                lambda c: F.transform(asked, lambda p: _answer(c, p)),
            ),
        )

    def topic(self, title: Column, profile: Column, **_: Column) -> Column:
        """First three different words of the title, else of the column names."""
        names = F.array_join(F.transform(profile, lambda p: p["col_name"]), " ")
        source = F.when(F.size(vectoriser_terms(title)) > 0, title).otherwise(names)
        return F.array_join(
            F.slice(F.array_distinct(vectoriser_terms(source)), 1, 3), " "
        )

    def description(
        self, profile: Column, n_rows: Column, topic: Column | None = None, **_: Column
    ) -> Column:
        """Size, column names, then types, range and time span of the columns."""

        def named(test: Callable[[Column], Column]) -> Column:
            return F.array_join(
                F.transform(F.filter(profile, test), lambda p: p["col_name"]), ", "
            )

        def sentence(before: str, text: Column) -> Column:
            return F.when(text != "", F.concat(F.lit(before), text, F.lit("."))).otherwise(
                F.lit("")
            )

        about = F.lit("")
        if topic is not None:
            about = F.coalesce(sentence(" Its topic is ", topic), F.lit(""))
        return F.concat(
            F.lit("This dataset has "),
            F.size(profile).cast("string"),
            F.lit(" columns ("),
            named(lambda p: F.lit(True)),
            F.lit(") and a sample of "),
            n_rows.cast("string"),
            F.lit(" rows."),
            about,
            sentence(" Numeric columns: ", named(lambda p: p["low"].isNotNull())),
            sentence(" Time columns: ", named(lambda p: p["first_time"].isNotNull())),
            sentence(" Place columns: ", named(lambda p: p["spatial_type"].isNotNull())),
        )

    def search(self, description: Column, topic: Column, **_: Column) -> Column:
        terms = F.array_sort(F.array_distinct(vectoriser_terms(description)))
        return F.concat(
            description,
            F.lit("\nTopic: "),
            topic,
            F.lit("\nKeywords: "),
            F.array_join(terms, ", "),
        )

    def group_semantics(self, profile: Column, asked: Column | None = None, **_: Column) -> Column:
        """A JSON object by column name, from the types of the profile, about all columns or those ``asked``.

        A profile with a name that comes twice is told as a whole: its answer does not parse, whatever is asked.
        """
        if asked is not None:
            names = F.transform(profile, lambda p: p["col_name"])
            some = F.filter(profile, lambda p: F.array_contains(asked, p["col_name"]))
            profile = F.when(F.size(F.array_distinct(names)) < F.size(names), profile).otherwise(some)

        def entry(p: Column) -> Column:
            temporal, spatial = p["first_time"].isNotNull(), p["spatial_type"].isNotNull()
            numeric = p["low"].isNotNull()
            value = F.to_json(
                F.struct(
                    F.struct(
                        temporal.alias("isTemporal"),
                        F.coalesce(p["resolution"], F.lit("")).alias("resolution"),
                    ).alias("Temporal"),
                    F.struct(
                        spatial.alias("isSpatial"),
                        F.when(spatial, "Coordinates").otherwise("").alias("resolution"),
                    ).alias("Spatial"),
                    F.when(temporal, "Temporal Entity")
                    .when(spatial, "Location")
                    .when(numeric, "Numeric Entity")
                    .otherwise("Category")
                    .alias("Entity Type"),
                    F.lit("General").alias("Domain-Specific Types"),
                    F.when(numeric & ~spatial, "Measurement")
                    .otherwise("Aggregation Key")
                    .alias("Function/Usage Context"),
                )
            )
            name = F.regexp_extract(F.to_json(F.array(p["col_name"])), r"(?s)^\[(.*)\]$", 1)
            return F.concat(name, F.lit(": "), value)

        return F.concat(
            F.lit("{"), F.array_join(F.transform(profile, entry), ", "), F.lit("}")
        )

    def _marks(self, text: Column) -> Column:
        """Completeness from length, conciseness from repetition, readability from word length."""

        def marks(found: Column) -> Column:
            n = F.size(found)
            letters = F.aggregate(found, F.lit(0), lambda total, w: total + F.length(w))
            complete = F.least(F.lit(10), F.lit(1) + F.floor(n / 20))
            concise = F.floor(F.size(F.array_distinct(found)) * 10 / n)
            readable = F.least(F.lit(10), F.lit(14) - F.floor(letters / n))
            some = F.array(
                complete, F.greatest(F.lit(1), concise), F.greatest(F.lit(1), readable)
            ).cast("array<int>")
            return F.when(n > 0, some).otherwise(F.array(F.lit(1), F.lit(1), F.lit(1)))

        return let(words(text), marks)

    def quality(self, description: Column, **_: Column) -> Column:
        names = ["Completeness", "Conciseness", "Readability"]
        return let(
            self._marks(description),
            lambda m: F.concat_ws(
                ", ",
                *[F.concat(F.lit(f"{n}: "), F.get(m, F.lit(i))) for i, n in enumerate(names)],
            ),
        )

    def verdict(self, a: Column, b: Column, **_: Column) -> Column:
        """The higher sum of marks wins, A when equal."""

        def total(text: Column) -> Column:
            return F.aggregate(self._marks(text), F.lit(0), lambda acc, m: acc + m)

        return F.when(total(b) > total(a), "B").otherwise("A")


def _looks_like_json(content: str) -> bool:
    """True when the repair of ``functions.jsontext`` makes a JSON object of the text."""
    start, end = content.find("{"), content.rfind("}")
    if start < 0 or end < start:
        return False
    body = content[start : end + 1]
    body += "}" * max(0, body.count("{") - body.count("}"))
    body = re.sub(r",\s*\}", "}", body)
    try:
        return isinstance(json.loads(body), dict)
    except ValueError:
        return False


Ask = Callable[[Any, list[str | None]], list[dict[str, Any]]]


def _messages(system: str, text: str) -> list[dict[str, str]]:
    asked = [{"role": "user", "content": text}]
    return [{"role": SYSTEM, "content": system}, *asked] if system else asked


def _no_answer(error: str) -> dict[str, Any]:
    row: dict[str, Any] = {n: None for n in schemas.ANSWERS.names}
    row.update(status="error", error=error, attempts=0)
    return row


def _take(row: dict[str, Any], reply: Any, parse: bool) -> bool:
    """Enter one attempt's reply, the exception it ended with, or None, into ``row``; true for an answer."""
    row["attempts"] += 1
    try:
        if isinstance(reply, Exception):
            raise reply
        if reply is None:
            raise ValueError("no_answer")
        content = reply["choices"][0]["message"]["content"]
    except Exception as problem:  # noqa: BLE001 - a failed call is a row, not a crash
        row.update(status="error", error=str(problem) or type(problem).__name__)
        return False
    for name in ("prompt_tokens", "completion_tokens", "total_tokens"):
        row[name] = (row[name] or 0) + int((reply.get("usage") or {}).get(name) or 0)
    if parse and not _looks_like_json(content or ""):
        row.update(status="error", error="answer_does_not_parse")
        return False
    row.update(content=content, status="success", error=None)
    return True


@dataclass(frozen=True)
class ClientProvider(Provider):
    """Answers from a chat client.

    ``make_client`` runs once per task and returns an object with
    ``chat_completions_create(model, messages, temperature, **kwargs) -> dict``, where the dict
    has ``choices[0].message.content`` and may have ``usage``.  Failures and unparsable answers
    are repeated row by row up to ``max_tries`` times and end as an error row; they never fail
    the task.
    """

    make_client: Callable[[], Any]
    model: str
    system: dict[str, str] = field(default_factory=dict)
    temperature: float = 0.0
    max_tries: int = 3
    must_parse: frozenset[str] = frozenset({"group_semantics", "column_semantics"})

    def _ask(self, task: str) -> Ask:
        """Answers of a client to prompts, in their order."""
        model, heat, tries = self.model, self.temperature, self.max_tries
        system, parse = self.system.get(task, ""), task in self.must_parse

        def one(client: Any, text: str | None) -> dict[str, Any]:
            row = _no_answer("no_prompt")
            for _ in range(0 if text is None else tries):
                try:
                    reply = client.chat_completions_create(
                        model=model, messages=_messages(system, text), temperature=heat
                    )
                except Exception as problem:  # noqa: BLE001 - a failed call is a row, not a crash
                    reply = problem
                if _take(row, reply, parse):
                    break
            return row

        return lambda client, texts: [one(client, text) for text in texts]

    def column(self, task: str, prompt: Column, context: dict[str, Column]) -> Column:
        make, answers = self.make_client, self._ask(task)

        def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            client = make()
            for batch in batches:
                yield pd.DataFrame(answers(client, list(batch)), columns=schemas.ANSWERS.names)

        ask.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
        return F.pandas_udf(ask, schemas.ANSWERS).asNondeterministic()(prompt)

    def columns(self, task: str, prompts: Column, context: dict[str, Column]) -> Column:
        make, answers = self.make_client, self._ask(task)

        def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            client = make()
            for batch in batches:
                given = iter(answers(client, [text for x in batch if x is not None for text in x]))
                yield pd.Series(
                    [None if x is None else [next(given) for _ in x] for x in batch], dtype=object
                )

        ask.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        found = F.pandas_udf(ask, T.ArrayType(schemas.ANSWERS)).asNondeterministic()
        return found(prompts)


@dataclass(frozen=True)
class BatchProvider(ClientProvider):
    """Answers from a client that takes several prompts in one call.

    The client has ``chat_completions_create_batch(model, messages_list, temperature) -> list[dict]``,
    one reply for each list of messages, in their order.  ``batch_size`` prompts are sent together, over
    the bounds of rows.  Replies belong to prompts by place: a prompt without a reply (a short list, a null
    in it) or with one that does not parse is sent again, with others like it, up to ``max_tries`` times, and
    ends as an error row; replies beyond the prompts are ignored.
    """

    batch_size: int = 4

    def _ask(self, task: str) -> Ask:
        if self.batch_size < 1:
            raise ValueError("batch_size must be at least 1")
        model, heat, tries, size = self.model, self.temperature, self.max_tries, self.batch_size
        system, parse = self.system.get(task, ""), task in self.must_parse

        def call(client: Any, texts: list[str]) -> list[Any]:
            try:
                replies = list(
                    client.chat_completions_create_batch(
                        model=model,
                        messages_list=[_messages(system, text) for text in texts],
                        temperature=heat,
                    )
                )
            except Exception as problem:  # noqa: BLE001 - a failed call is rows, not a crash
                return [problem] * len(texts)
            return replies[: len(texts)] + [None] * (len(texts) - len(replies))

        def answers(client: Any, texts: list[str | None]) -> list[dict[str, Any]]:
            rows = [_no_answer("no_prompt") for _ in texts]
            waiting = [i for i, text in enumerate(texts) if text is not None]
            for _ in range(tries):
                again = []
                for begin in range(0, len(waiting), size):
                    sent = waiting[begin : begin + size]
                    replies = call(client, [texts[i] for i in sent])
                    again += [i for i, reply in zip(sent, replies, strict=True) if not _take(rows[i], reply, parse)]
                waiting = again
            return rows

        return answers


def complete(
    df: DataFrame,
    task: str,
    prompt: Column,
    provider: Provider,
    context: dict[str, Column] | None = None,
    out: str = "answer",
    tasks: int | None = None,
) -> DataFrame:
    """Add the answer struct ``out``.

    ``tasks`` sets how many calls run side by side when a remote service limits them.
    """
    rows = df.repartition(tasks) if tasks else df
    return rows.withColumn(out, provider.column(task, prompt, context or {}))
