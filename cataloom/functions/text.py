"""Text expressions: white space, lines, tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a Unicode-aware strip removes, and those that end a line.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
LINE_END = "\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029]"

# Token patterns.
WORD_OR_MARK = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"
TWO_CHAR_WORD = r"[\p{L}\p{N}_]{2,}"
ASCII_WORD = "[a-z0-9]+"
ANY_WORD = r"[\p{L}\p{N}]+"


def strip(text: Column) -> Column:
    """Remove white space of every kind at both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def blank_to_null(text: Column) -> Column:
    stripped = strip(text)
    return F.when(stripped != "", stripped)


def has_text(text: Column) -> Column:
    """Non-null and not blank in the sense of SQL ``trim`` (spaces only); never null."""
    return F.coalesce(F.trim(text) != "", F.lit(False))


def has_visible_text(text: Column) -> Column:
    """Non-null and something other than white space of any kind; never null."""
    return F.coalesce(strip(text) != "", F.lit(False))


def text_length(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def lines(text: Column) -> Column:
    return F.split(text, LINE_END, -1)


def shrink_sample_csv(text: Column, max_chars: int = 8000, max_lines: int = 8) -> Column:
    """Header plus ``max_lines`` lines of a CSV text, at most ``max_chars`` characters.

    Null when nothing but white space is left.
    """
    kept = F.array_join(F.slice(lines(strip(text)), 1, 1 + max_lines), "\n")
    return blank_to_null(F.substring(kept, 1, max_chars))


def words(text: Column) -> Column:
    """Lower-cased white-space tokens."""
    return F.filter(F.split(F.lower(text), f"[{WHITE_SPACE}]+"), lambda t: t != "")


def words_and_marks(text: Column) -> Column:
    """Lower-cased words and single punctuation marks."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_OR_MARK), F.lit(0))


def vectoriser_terms(text: Column) -> Column:
    """Lower-cased words of two or more characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TWO_CHAR_WORD), F.lit(0))


def rouge_tokens(text: Column, unicode: bool = False) -> Column:
    """Lower-cased ASCII letter/digit runs; ``unicode=True`` keeps accented words whole."""
    pattern = ANY_WORD if unicode else ASCII_WORD
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


TOKENISERS = {
    "words": words,
    "words_and_marks": words_and_marks,
    "vectoriser": vectoriser_terms,
}


def tokenise(text: Column, mode: str = "words_and_marks") -> Column:
    if mode not in TOKENISERS:
        raise ValueError(f"unknown token mode {mode!r}, choose from {sorted(TOKENISERS)}")
    return TOKENISERS[mode](F.coalesce(text, F.lit("")))


def ngrams(tokens: Column, n: int) -> Column:
    if n == 1:
        return tokens

    def grams(t: Column) -> Column:
        starts = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - (n - 1)))
        return F.transform(
            starts, lambda i: F.concat_ws(" ", *[F.get(t, i + (k - 1)) for k in range(n)])
        )

    return F.coalesce(let(tokens, grams), F.array().cast("array<string>"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is evaluated once per row.

    A column used inside a lambda is evaluated for every element; bound here it is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def elements(values: str) -> Column:
    """The elements of an array column, to be exploded; null has none.

    Spark filters the rows below an exploded column by its size, and there asks for the whole expression
    behind it again, twice a row.  It does not do so for an expression of the column.
    """
    return F.coalesce(F.col(values), F.array())


def runs(tokens: Column) -> Column:
    """``array<struct<term, tf>>`` of a token array, counted inside the row.

    Equal tokens are neighbours after sorting, so each run start gives one term and the
    distance to the next start its count.  No shuffle is needed to count terms per document.
    """

    def starts(ordered: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(0), F.size(ordered) - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )

    def counted(ordered: Column) -> Column:
        return let(
            starts(ordered),
            lambda at: F.transform(
                at,
                lambda s, n: F.struct(
                    F.get(ordered, s).alias("term"),
                    (F.coalesce(F.get(at, n + 1), F.size(ordered)) - s).alias("tf"),
                ),
            ),
        )

    return F.when(F.size(tokens) > 0, let(F.sort_array(tokens), counted))


def numbered(tokens: Column) -> Column:
    """Tokens with the number of their occurrence appended, so that a set of them is a multiset."""
    return F.coalesce(
        F.flatten(
            F.transform(
                runs(tokens),
                lambda r: F.transform(
                    F.sequence(F.lit(1), r["tf"]),
                    lambda k: F.concat(r["term"], F.lit("\x00"), k.cast("string")),
                ),
            )
        ),
        F.array().cast("array<string>"),
    )
