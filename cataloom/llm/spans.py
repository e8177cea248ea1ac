"""Where patterns match in a text, as columns.  Positions are code points, ends exclusive.

Java patterns only: the loops in them must be possessive, so that long runs neither overflow the
stack nor are tried again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:int,kind:int,end:int,found:string>"
BLOCK = 256
PIECE = 1024
NEVER = 2**31 - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def none() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def pieces(text: Column) -> Column:
    """The text in pieces of ``PIECE`` characters, from which ``cut`` takes parts without reading all of it."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(parts: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` to ``end`` of a text in pieces."""
    first = F.floor(start / PIECE).cast("int")
    count = F.floor(end / PIECE).cast("int") - first + 1
    return F.substring(F.array_join(F.slice(parts, first + 1, count), ""), start - first * PIECE + 1, end - start)


def apart(spans: Column, others: Column) -> Column:
    """The ``spans`` that overlap none of ``others``, sorted.  It costs two sorts of both."""

    def marked(items: Column, mark: int) -> Column:
        return F.transform(items, lambda s: F.struct(s["start"].alias("start"), F.lit(mark).alias("mark"), s.alias("span")))

    def swept(items: Column, other: int, begin: int, move: Callable[[Column, Column], Column], free: Callable[[Column, Column], Column]) -> Column:
        def step(state: Column, item: Column) -> Column:
            is_other = item["mark"] == other
            out = F.when(~is_other & free(state["at"], item["span"]), F.concat(state["out"], F.array(item["span"]))).otherwise(state["out"])
            return F.struct(F.when(is_other, move(state["at"], item["span"])).otherwise(state["at"]).alias("at"), out.alias("out"))

        def block(state: Column, part: Column) -> Column:
            inner = F.aggregate(part, F.struct(state["at"].alias("at"), none().alias("out")), step)
            return let(inner, lambda i: F.struct(i["at"].alias("at"), F.concat(state["out"], i["out"]).alias("out")))

        start = F.struct(F.lit(begin).alias("at"), none().alias("out"))
        return let(items, lambda a: F.when(F.size(a) > 0, F.aggregate(in_blocks(a), start, block, lambda s: s["out"])).otherwise(none()))

    # Forwards against those that begin before a span or with it, backwards against those that begin in it.
    ahead = F.array_sort(F.concat(marked(others, 0), marked(spans, 1)))
    clear = swept(ahead, 0, 0, lambda at, s: F.greatest(at, s["end"]), lambda at, s: s["start"] >= at)
    back = F.reverse(F.array_sort(F.concat(marked(clear, 0), marked(others, 1))))
    return F.reverse(swept(back, 1, NEVER, lambda at, s: s["start"], lambda at, s: s["end"] <= at))


def in_blocks(items: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")),
        lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)),
    )


def _running(matches: Column, gaps: Column, kind: int) -> Column:
    """Spans of the matches, given the text between them.  Lengths are summed inside blocks and over
    blocks, so a text with many matches costs far less than its square."""
    pieces = F.zip_with(
        matches,
        F.slice(gaps, F.lit(1), F.size(matches)),
        lambda m, g: F.struct(F.length(g).alias("gap"), F.length(m).alias("len"), m.alias("found")),
    )

    def step(state: Column, piece: Column) -> Column:
        begin = state["at"] + piece["gap"]
        end = begin + piece["len"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), piece["found"].alias("found"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    def block(state: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(state["at"].alias("at"), none().alias("out")), step)
        return let(inner, lambda i: F.struct(i["at"].alias("at"), F.concat(state["out"], i["out"]).alias("out")))

    begin = F.struct(F.lit(0).alias("at"), none().alias("out"))
    return let(pieces, lambda p: F.aggregate(in_blocks(p), begin, block, lambda s: s["out"]))


def located(text: Column, pattern: str, kind: int, valid: Callable[[Column], Column] | None = None) -> Column:
    """Spans of the leftmost non-overlapping matches; those whose text is not ``valid`` are dropped."""
    spans = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m: F.when(F.size(m) > 0, _running(m, F.split(text, pattern, -1), kind)).otherwise(none()),
    )
    return spans if valid is None else F.filter(spans, lambda s: valid(s["found"]))


def shown(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def counted(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def replaced(text: Column, spans: Column, tag: Callable[[Column], Column]) -> Column:
    """The text with the union of the sorted spans replaced; ``tag`` gives a span's replacement.

    A span that begins inside an earlier one adds its end to it.
    """
    made = let(F.struct(pieces(text).alias("p"), spans.alias("s")), lambda x: _joined(x["p"], F.length(text), x["s"], tag))
    return F.when(F.size(spans) > 0, made).otherwise(text)


def covered(text: Column, spans: Column, cover: str) -> Column:
    """The text with each character of the sorted spans replaced by ``cover``."""

    def covers(begin: Column, end: Column) -> Column:
        return F.repeat(F.lit(cover), F.greatest(end - begin, F.lit(0)))

    made = let(
        F.struct(pieces(text).alias("p"), spans.alias("s")),
        lambda x: _joined(x["p"], F.length(text), x["s"], lambda s: covers(s["start"], s["end"]), lambda at, s: covers(at, s["end"])),
    )
    return F.when(F.size(spans) > 0, made).otherwise(text)


def _joined(parts: Column, length: Column, spans: Column, tag: Callable[[Column], Column], inside: Callable[[Column, Column], Column] = lambda at, s: F.lit("")) -> Column:
    def step(state: Column, span: Column) -> Column:
        new = span["start"] >= state["at"]
        gap = F.when(new, F.concat(cut(parts, state["at"], span["start"]), tag(span))).otherwise(inside(state["at"], span))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["out"], F.array(gap)).alias("out"))

    def block(state: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(state["at"].alias("at"), F.array().cast("array<string>").alias("out")), step)
        return let(inner, lambda i: F.struct(i["at"].alias("at"), F.concat(state["out"], F.array(F.array_join(i["out"], ""))).alias("out")))

    def rest(state: Column) -> Column:
        return F.concat(F.array_join(state["out"], ""), cut(parts, state["at"], length))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(in_blocks(spans), begin, block, rest)
