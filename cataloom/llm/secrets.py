"""Secrets: patterns, and weak parts of a credential that count only together.

Strong findings (assignments to secret names, access key ids, long hexadecimal strings) stand for
themselves.  Weak candidates do not: an identifier (user, client id), a mixed string that may be a
secret, an endpoint (a URL or host).  Each part covers the interval of ``reach`` characters around
its start in its scope, the text it stands in; candidates are joined by interval with the parts that
complete them, and reported only if one is there:

    identifier needs a secret, strong or weak;  endpoint needs a secret, strong or weak;
    weak secret needs an identifier, an access key id or an endpoint

A scope lies in one row, so the join of the intervals runs there, over the sorted parts: secrets (strong
and weak) complete identifiers, keys and endpoints, and the other way round, so a part needs only the
nearest part of the other side before and behind it.  Two sweeps find these; a text full of parts costs
its parts, and nothing is shuffled.

All of it is DataFrame functions.  Null texts are empty texts and have no spans; rows of equal texts get
equal spans, whatever their ids are; repeated rows stay; empty tables give empty tables; further
columns pass through, but a column that has the name of an added one is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .common import whole

KINDS = ("assign", "access", "hex", "ident", "weak", "endpoint")
ACCESS, IDENT, WEAK, ENDPOINT = 1, 3, 4, 5

# Loops are possessive.  Runs that are too short can be skipped: any later start in them is shorter.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)"""
ACCESS_KEY = r"AKIA[A-Z0-9]{14,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
IDENTIFIER = r"""(?<![A-Za-z0-9])(?i:user(?:[_ -]?(?:name|id))?|login|account(?:[_ -]?id)?|client[_-]?id|access[_-]?key[_-]?id)["']?+\x20*+[:=]\x20*+["']?+[A-Za-z0-9@+/_.-]{3,}+"""
MIXED = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}+"
LOCATION = r"""(?<![A-Za-z0-9])(?i:[a-z][a-z0-9+.-]{1,20}+://[^\x00-\x20"'<>]++|(?:host|server|endpoint|url|bucket)["']?+\x20*+[:=]\x20*+["']?+[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+(?::[0-9]++)?+)"""

REACH = 200
VALUE = 12
# What completes a weak candidate, as kinds.
COMPLEMENT = {IDENT: (0, 2, WEAK), WEAK: (IDENT, ACCESS, ENDPOINT), ENDPOINT: (0, 2, WEAK)}
SECRETS = COMPLEMENT[IDENT]
ADDED = ("base_spans", "added_spans", "spans")


def _long_value(found: Column) -> Column:
    return F.length(F.regexp_extract(found, ASSIGN, 1)) >= VALUE


def _is_mixed(found: Column) -> Column:
    """Digits, lower case and upper case: neither a word nor a number."""
    return found.rlike("[0-9]") & found.rlike("[a-z]") & found.rlike("[A-Z]")


def base_spans(text: Column) -> Column:
    return F.array_sort(F.concat(S.located(text, ASSIGN, 0, _long_value), S.located(text, ACCESS_KEY, ACCESS), S.located(text, HEX, 2)))


def weak_spans(text: Column, base: Column) -> Column:
    """Spans of weak candidates outside the strong findings."""
    weak = F.concat(S.located(text, IDENTIFIER, IDENT), S.located(text, MIXED, WEAK, _is_mixed), S.located(text, LOCATION, ENDPOINT))
    return S.let(base, lambda b: S.apart(weak, b))


def _others_before(parts: Column) -> Column:
    """For each part the start of the last one of the other side before it, null without one."""

    def state(secret: Column, partner: Column, out: Column) -> Column:
        return F.struct(secret.alias("secret"), partner.alias("partner"), out.alias("out"))

    def step(at: Column, part: Column) -> Column:
        is_secret = part["kind"].isin(*SECRETS)
        other = F.when(is_secret, at["partner"]).otherwise(at["secret"])
        secret = F.when(is_secret, part["start"]).otherwise(at["secret"])
        partner = F.when(is_secret, at["partner"]).otherwise(part["start"])
        return state(secret, partner, F.concat(at["out"], F.array(other)))

    def block(at: Column, some: Column) -> Column:
        inner = F.aggregate(some, state(at["secret"], at["partner"], nothing), step)
        return S.let(inner, lambda i: state(i["secret"], i["partner"], F.concat(at["out"], i["out"])))

    unknown, nothing = F.lit(None).cast("int"), F.array().cast("array<int>")
    return F.aggregate(S.in_blocks(parts), state(unknown, unknown, nothing), block, lambda at: at["out"])


def linked(base: Column, weak: Column, reach: int = REACH) -> Column:
    """The weak spans that a complement confirms, sorted."""

    def confirmed(parts: Column) -> Column:
        met = F.arrays_zip(parts.alias("s"), _others_before(parts).alias("before"), F.reverse(_others_before(F.reverse(parts))).alias("behind"))
        close = F.filter(met, lambda m: (m["s"]["kind"] >= IDENT) & ((m["s"]["start"] - m["before"] <= reach) | (m["behind"] - m["s"]["start"] <= reach)))
        return F.transform(close, lambda m: m["s"])

    return F.when(F.size(weak) > 0, S.let(F.array_sort(F.concat(base, weak)), confirmed)).otherwise(S.none())


def scanned(docs: DataFrame, text: str = "text", reach: int = REACH) -> DataFrame:
    """``docs`` with ``base_spans``, ``added_spans`` and ``spans`` (all of them, sorted).

    A span is (start, kind, end, found), kind an index into ``KINDS``.
    """
    if clash := set(ADDED) & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are in the way")
    rows = docs.select(F.struct(*docs.columns).alias("row_"), whole(text).alias("text_")).withColumn("base_spans", base_spans(F.col("text_")))
    rows = rows.withColumn("weak_spans", weak_spans(F.col("text_"), F.col("base_spans")))
    rows = rows.withColumn("added_spans", linked(F.col("base_spans"), F.col("weak_spans"), reach))
    return rows.select("row_.*", "base_spans", "added_spans", F.array_sort(F.concat("base_spans", "added_spans")).alias("spans"))
