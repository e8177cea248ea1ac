"""Personal data: patterns, and terms that disclose what the patterns find.

Protected entities are the matched values (an address, a card number).  How strongly a term reveals
an entity is estimated from the corpus: with N rows, df(e) and df(t) rows that hold the entity and the
term, and df(e, t) rows that hold both, wherever they stand,

    PMI(e, t) = log2(N * df(e, t) / (df(e) * df(t)))      IC(e) = log2(N / df(e))

and the term discloses the share PMI / IC of the entity's information.  Terms that stand with an entity
in at least ``support`` rows are removed, wherever they stand in a row that holds it, when the share
reaches ``remove`` and generalised when it reaches ``generalise``.  Only rows that hold the entity are
changed, so rows without personal data stay as they are.

All of it is DataFrame functions.  Equal texts are counted once, with their number.  Entities that stand
in the same texts are judged as one, so a list of addresses is not paired with all its terms.
df(e, t) is at most df(e), so a pair can reach the share s only if df(t) <= df(e)**s * N**(1 - s); the
other pairs are not made.  A frequent term or entity is counted in every task before it moves.  Null texts are empty texts and have no spans;
rows of equal texts get equal spans, whatever their ids are; repeated rows stay; empty tables give
empty tables; further columns pass through ``protected`` untouched, but a column that has the name of
an added one is an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import spans as S
from .common import text_key, whole, written

KINDS = ("email", "ip", "card", "phone", "generalise", "remove")
GENERALISE, REMOVE = 4, 5

# Each loop is possessive.  A run of address characters is tried once, where it begins or where the
# last match ends; a card of fewer than 12 digits can be skipped because later starts are shorter.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[ -]?[0-9]){11,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
TERM = r"[\p{L}\p{N}]{3,}+"
# Covers protected values while terms are searched; a noncharacter.  Terms that touch it do not count.
COVER = "\uffff"
FREE_TERM = rf"(?<![\p{{L}}\p{{N}}{COVER}]){TERM}(?!{COVER})"

SUPPORT = 3
GENERALISE_SHARE = 0.75
REMOVE_SHARE = 0.95

ADDED = ("base_spans", "added_spans", "spans", "sanitised")


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _valid_ip(found: Column) -> Column:
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return found.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _valid_card(found: Column) -> Column:
    return F.length(_digits(found)).between(12, 19) & F.call_function("luhn_check", _digits(found))


def _valid_phone(found: Column) -> Column:
    return F.length(_digits(found)).between(9, 15)


def base_spans(text: Column) -> Column:
    """Sorted spans of the four patterns in a text."""
    return F.array_sort(
        F.concat(
            S.located(text, EMAIL, 0),
            S.located(text, IP, 1, _valid_ip),
            S.located(text, CARD, 2, _valid_card),
            S.located(text, PHONE, 3, _valid_phone),
        )
    )


def _entity(span: Column) -> Column:
    return F.concat_ws(":", span["kind"].cast("string"), F.when(span["kind"] >= 2, _digits(span["found"])).otherwise(F.lower(span["found"])))


def _covered(text: Column, base: Column) -> Column:
    return S.covered(text, base, COVER)


def _terms(text: Column, pattern: str) -> Column:
    """The distinct terms of a text in lower case."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.array_distinct(F.transform(found, lambda t: F.lower(t)))


def _held(found: DataFrame) -> DataFrame:
    """(key, n, entities, terms) of the distinct texts with entities; n rows have the text."""
    row = found.filter(F.size("base_spans") > 0).select(
        text_key(F.col("text_")).alias("key"),
        F.array_distinct(F.transform("base_spans", _entity)).alias("entities"),
        _terms(_covered(F.col("text_"), F.col("base_spans")), FREE_TERM).alias("terms"),
    )
    return row.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.first("entities").alias("entities"), F.first("terms").alias("terms"))


def disclosing(held: DataFrame, docs: DataFrame, text: str, support: int, generalise: float, remove: float) -> DataFrame:
    """(key, term, grade) of the terms that disclose an entity of their text, from the whole corpus."""
    total = F.lit(docs.count())
    single = held.select("key", "n", F.explode("entities").alias("entity"))
    # Entities with equal sums of the texts' keys stand in the same texts.
    texts = F.struct(F.bit_xor("key.k1").alias("t1"), F.bit_xor("key.k2").alias("t2")).alias("texts")
    entities = single.groupBy("entity").agg(F.sum("n").alias("with_entity"), texts).filter((F.col("with_entity") >= support) & (F.col("with_entity") < total))
    alike = single.join(entities, "entity").select("key", "texts", "with_entity").distinct()
    words = docs.select(F.explode(_terms(whole(text), TERM)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("with_term"))
    # A hundredth more than the bound, so that rounding drops no pair.
    least = min(generalise, remove)
    bound = 1.01 * F.pow("with_entity", F.lit(least)) * F.pow(total, F.lit(1 - least))
    widest = alike.groupBy("key").agg(F.max(bound).alias("widest"))
    terms = held.join(widest, "key").select("key", "n", "widest", F.explode("terms").alias("term"))
    terms = terms.join(words.filter(F.col("with_term") >= support), "term").filter("with_term <= widest").drop("widest")
    pairs = written(terms.join(alike, "key").filter(F.col("with_term") <= bound), "pii-pairs")
    share = F.log2(total * F.col("both") / (F.col("with_entity") * F.col("with_term"))) / F.log2(total / F.col("with_entity"))
    grade = F.when(share >= remove, REMOVE).when(share >= generalise, GENERALISE)
    together = pairs.groupBy("texts", "term", "with_entity", "with_term").agg(F.sum("n").alias("both")).filter(F.col("both") >= support)
    graded = together.select("texts", "term", grade.alias("grade")).filter("grade is not null")
    return pairs.select("key", "texts", "term").join(graded, ["texts", "term"]).select("key", "term", "grade")


def _told(text: Column, base: Column, told: Column) -> Column:
    """Sorted spans of all places of the ``told`` terms, (term, grade), in a text.

    Terms and places are swept in the order of their letters, a term's strongest grade last before its places.
    """
    grades = F.transform(told, lambda t: F.struct(t["term"].alias("found"), F.lit(0).alias("mark"), t["grade"].alias("kind"), F.lit(0).alias("start"), F.lit(0).alias("end")))
    places = F.transform(
        S.located(_covered(text, base), FREE_TERM, 0),
        lambda s: F.struct(F.lower(s["found"]).alias("found"), F.lit(1).alias("mark"), s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )

    def step(state: Column, item: Column) -> Column:
        is_grade = item["mark"] == 0
        span = F.struct(item["start"].alias("start"), state["kind"].alias("kind"), item["end"].alias("end"), item["found"].alias("found"))
        return F.struct(
            F.when(is_grade, item["found"]).otherwise(state["term"]).alias("term"),
            F.when(is_grade, item["kind"]).otherwise(state["kind"]).alias("kind"),
            F.when(~is_grade & (item["found"] == state["term"]), F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"),
        )

    def block(state: Column, part: Column) -> Column:
        inner = F.aggregate(part, F.struct(state["term"].alias("term"), state["kind"].alias("kind"), S.none().alias("out")), step)
        return S.let(inner, lambda i: F.struct(i["term"].alias("term"), i["kind"].alias("kind"), F.concat(state["out"], i["out"]).alias("out")))

    begin = F.struct(F.lit("").alias("term"), F.lit(0).alias("kind"), S.none().alias("out"))
    return S.let(F.array_sort(F.concat(grades, places)), lambda a: F.array_sort(F.aggregate(S.in_blocks(a), begin, block, lambda s: s["out"])))


def _tag(span: Column) -> Column:
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS[:4]], F.lit("[term]"), F.lit(""))
    return F.when((span["kind"] == GENERALISE) & span["found"].rlike("^[0-9]+$"), F.lit("[number]")).otherwise(names[span["kind"]])


def protected(
    docs: DataFrame,
    text: str = "text",
    support: int = SUPPORT,
    generalise: float = GENERALISE_SHARE,
    remove: float = REMOVE_SHARE,
) -> DataFrame:
    """``docs`` with ``base_spans``, ``added_spans``, ``spans`` (all of them, sorted) and ``sanitised``.

    A span is (start, kind, end, found), kind an index into ``KINDS``.
    """
    if clash := set(ADDED) & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are in the way")
    texts = docs.select(whole(text).alias("text_")).withColumn("base_spans", base_spans(F.col("text_")))
    held = written(_held(texts), "pii-held")
    told = disclosing(held, docs, text, support, generalise, remove)
    found = told.groupBy("key").agg(F.collect_set(F.struct("term", "grade")).alias("told"))
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("row_"), whole(text).alias("text_")).withColumn("base_spans", base_spans(F.col("text_")))
    # Only rows with entities can get spans, so only these move.
    with_entity = rows.filter(F.size("base_spans") > 0).withColumn("key", text_key(F.col("text_")))
    added = F.when(F.col("told").isNotNull(), _told(F.col("text_"), F.col("base_spans"), F.col("told"))).otherwise(S.none())
    joined = with_entity.join(found, "key", "left").select("row_", "text_", "base_spans", added.alias("added_spans"))
    without = rows.filter(F.size("base_spans") == 0).select("row_", "text_", "base_spans", S.none().alias("added_spans"))
    out = joined.union(without).withColumn("spans", F.array_sort(F.concat("base_spans", "added_spans")))
    return out.select("row_.*", "base_spans", "added_spans", "spans", S.replaced(F.col("text_"), F.col("spans"), _tag).alias("sanitised"))


def sanitised(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs`` with the text sanitised, all columns in their order.  A null text stays null."""
    out = protected(docs, text, **how)
    safe = F.when(F.col(text).isNotNull(), F.col("sanitised")).alias(text)
    return out.select(*[safe if name == text else F.col(name) for name in docs.columns])
