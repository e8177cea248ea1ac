"""CSV text expressions, all inside the row that holds the text.

A sample is small (a header and a few rows), so parsing it in the row costs no shuffle and two
datasets with the same id can never be mixed up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

# A quote opens only at the start of a field.  A quoted part may hold commas, line ends and doubled
# quotes; what follows its end belongs to the field.  An open quote runs to the end of the text.
QUOTED = '"(?:[^"]++|"")*+'
FIELD = f'(?:{QUOTED}(?:"[^,\r\n]*+)?+|[^,\r\n]*+)'
RECORD = rf"(?=[^\r\n]){FIELD}(?:,{FIELD})*+"
CLOSED = f'^(?:{QUOTED}"[^,\r\n]*+|[^",\r\n][^,\r\n]*+|[,\r\n])*+$'

# Cell texts a CSV reader takes as missing.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def unquote(field: Column) -> Column:
    """The value of a field: the quoted part with its doubled quotes made single, then the rest."""
    quoted = F.regexp_extract(field, f"^{QUOTED}", 0)
    rest = F.substr(field, F.length(quoted) + 2)
    value = F.replace(F.substr(quoted, F.lit(2)), F.lit('""'), F.lit('"'))
    return F.when(field.startswith('"'), F.concat(value, rest)).otherwise(field)


def quote(value: Column) -> Column:
    """Minimal quoting: only when the value holds a comma, a quote or a line end."""
    needs = F.coalesce(value.rlike('[,"\r\n]'), F.lit(False))
    doubled = F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(needs, doubled).otherwise(F.coalesce(value, F.lit("")))


def records(text: Column) -> Column:
    """Records of a CSV text; blank lines are skipped, quoted line ends stay inside."""
    return F.regexp_extract_all(text, F.lit(RECORD), F.lit(0))


def fields(record: Column) -> Column:
    raw = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(f",({FIELD})"), F.lit(1))
    return F.transform(raw, unquote)


def rows(text: Column) -> Column:
    """``array<array<string>>`` of all records."""
    return F.transform(records(text), fields)


def is_parsable(text: Column) -> Column:
    """False when a field is left open."""
    return F.coalesce(text.rlike(CLOSED), F.lit(False))


def missing_to_null(value: Column) -> Column:
    return F.when(~value.isin(MISSING), value)


def columns(table: Column) -> Column:
    """``array<struct<col_no, col_name, values>>`` from parsed rows; short rows give nulls."""

    def named(t: Column) -> Column:
        body = F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0)))
        return let(
            body,
            lambda rest: F.transform(
                F.get(t, F.lit(0)),
                lambda name, i: F.struct(
                    i.alias("col_no"),
                    name.alias("col_name"),
                    F.transform(rest, lambda r: missing_to_null(F.get(r, i))).alias("values"),
                ),
            ),
        )

    return let(table, named)


def render_row(values: Column) -> Column:
    return F.array_join(F.transform(values, quote), ",")


def render(table: Column) -> Column:
    return F.array_join(F.transform(table, render_row), "\n")
