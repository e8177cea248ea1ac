"""JSON text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let


COMMA_TOO_MANY = r",\s*\}"


def list_text(values: Column) -> Column:
    """JSON text of a string array with ``", "`` between the elements."""
    element = F.transform(
        values,
        lambda v: F.when(v.isNull(), "null").otherwise(
            F.regexp_extract(F.to_json(F.array(v)), r"(?s)^\[(.*)\]$", 1)
        ),
    )
    return F.concat(F.lit("["), F.array_join(element, ", "), F.lit("]"))


def path_or_default(text: Column, path: str, default: str | None = None) -> Column:
    """Value at a JSON path, the default when any step is missing."""
    return F.coalesce(F.get_json_object(text, path), F.lit(default))


def first_non_empty(*options: Column) -> Column:
    """First option that is neither null nor the empty string."""
    return F.coalesce(*[F.when(o != "", o) for o in options])


def repair(text: Column) -> Column:
    """Cut to the outermost braces, close missing braces, drop commas before ``}``.

    A text without braces stays as it is.
    """

    def closed(body: Column) -> Column:
        def without(mark: str) -> Column:
            return F.octet_length(F.replace(body, F.lit(mark), F.lit("")))

        missing = F.greatest(F.lit(0), without("}") - without("{"))
        return let(
            F.concat(body, F.repeat(F.lit("}"), missing)),
            lambda whole: F.when(whole.rlike(COMMA_TOO_MANY), F.regexp_replace(whole, COMMA_TOO_MANY, "}")).otherwise(whole),
        )

    return let(
        F.regexp_extract(text, r"(?s)\{.*\}", 0),
        lambda body: F.when(body == "", text).otherwise(closed(body)),
    )
