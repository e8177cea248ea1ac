"""Source divergence audit: how far the word use of each source lies from that of its language's others.

Identical texts of a language are collapsed first: a text that several rows share keeps the number of
rows of each source and is tokenized once, its document frequency and counts are weighted by these
numbers.  Texts that no other row has are tokenized where they are read.  Each task sums up its texts as
one row per (lang, term) with the sources that use it; the rows of a term meet once, where rare terms
go.  The kept terms are a written table of (lang, term) rows from which both parts are taken in place:

* pairs of sources are evaluated sparsely.  Terms that neither or only one of two sources uses are
  counted by their number of occurrences, and only terms that both use are looked at one by one; a task
  gives one partial sum per pair of sources, never a row per term and pair;
* terms of a source come with their value and are cut to ``TOP`` in each task before they meet.

All arithmetic is in integers.  Null text, lang and source are empty strings; repeated rows count as
often as they occur; a source without any term is in the pairs, with the chances of unseen terms;
a language with one source has no pairs; an empty table gives an empty table.  Equal values are ranked by
the item.  Ids are not used; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import fits_broadcast, top_ranked
from .common import pieces, text_key, written

SUPPORT = 3
TOP = 200
SCALE = 1_000_000_000
# Bytes of text that a task sums up at a time, pairs that it evaluates at a time.
TEXT_BYTES = 8_000_000
PAIR_ROWS = 2_000_000
# Letters A-Z become small, ASCII characters other than letters part the terms.
SHAPE = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

TERMS = "lang string, term string, df long, sources array<string>, counts array<long>"


def collapsed(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """Distinct texts of a language as (lang, text, sources, copies), and the groups (lang, source).

    Only texts that stand in several rows are brought together.  Their keys are broadcast when they are
    measured to be few, else all rows are joined with them.
    """
    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    rows = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), empty(text).alias("text"))
    keyed = rows.withColumn("key", text_key(F.col("text")))
    counted = written(keyed.groupBy("lang", "key", "source").agg(F.count(F.lit(1)).alias("n")), "text-copies")
    groups = counted.select("lang", "source").distinct()
    copies = counted.groupBy("lang", "key").agg(F.collect_list("source").alias("sources"), F.collect_list("n").alias("copies"), F.sum("n").alias("n"))
    copies = written(copies.filter("n > 1").drop("n"), "text-groups")
    marks = copies.select("lang", "key", F.lit(True).alias("many"))
    marked = keyed.join(F.broadcast(marks) if fits_broadcast(marks) else marks, ["lang", "key"], "left")
    single = marked.filter("many is null").select("lang", "text", F.array("source").alias("sources"), F.array(F.lit(1).cast("long")).alias("copies"))
    shared = marked.filter("many").groupBy("lang", "key").agg(F.first("text").alias("text")).join(copies, ["lang", "key"])
    return single.unionByName(shared.select("lang", "text", "sources", "copies")), groups


def _summed(keys: list[np.ndarray], *weights: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct rows of ``keys`` and the sums of ``weights`` over equal ones."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.r_[True, np.any([k[1:] != k[:-1] for k in keys], axis=0)] if len(order) else np.empty(0, bool)
    begin = np.flatnonzero(new)
    return [k[begin] for k in keys], [np.add.reduceat(w[order], begin) if len(begin) else w[:0] for w in weights]


def _term_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One row per (lang, term) of a batch of distinct texts."""
    langs = batch["lang"].dictionary_encode()
    lang_of = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    texts = [t.as_py().encode().translate(SHAPE) for t in batch["text"]]
    split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
    doc = np.repeat(np.arange(batch.num_rows), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    flat = split.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    coded = flat.filter(full).dictionary_encode()
    doc, term = doc[full.to_numpy(zero_copy_only=False)], coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    size = max(len(coded.dictionary), 1)
    both, n = np.unique(doc * size + term, return_counts=True)
    doc, term = np.divmod(both, size)
    # Rows of (text, term) become rows of (lang, term, source): one for each source of the text.
    offsets = batch["sources"].offsets.to_numpy() - batch["sources"].offsets[0].as_py()
    sources = batch["sources"].flatten().dictionary_encode()
    source_of, copies = sources.indices.to_numpy(zero_copy_only=False).astype(np.int64), batch["copies"].flatten().to_numpy()
    many = np.diff(offsets)[doc]
    row = np.repeat(np.arange(len(doc)), many)
    at = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + offsets[doc][row]
    (lang, term, source), (df, n) = _summed([lang_of[doc[row]], term[row], source_of[at]], copies[at], n[row] * copies[at])
    begin = np.flatnonzero(np.r_[True, (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])]) if len(lang) else np.empty(0, np.int64)
    cuts = pa.array(np.r_[begin, len(lang)].astype(np.int32))
    columns = [
        langs.dictionary.take(pa.array(lang[begin])),
        coded.dictionary.take(pa.array(term[begin])),
        pa.array(np.add.reduceat(df, begin) if len(begin) else df),
        pa.ListArray.from_arrays(cuts, sources.dictionary.take(pa.array(source))),
        pa.ListArray.from_arrays(cuts, pa.array(n)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "term", "df", "sources", "counts"])


def kept_terms(texts: DataFrame, support: int = SUPPORT) -> DataFrame:
    """(lang, term, sources, counts) of the terms in at least ``support`` documents of the language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", TEXT_BYTES):
            yield _term_rows(batch)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None  # the last term's sums; its rows may go on
        for batch in batches:
            if batch.num_rows:
                merged = _merged(batch if open_ is None else pa.concat_batches([open_, batch]))
                open_ = merged.slice(merged.num_rows - 1)
                yield kept(merged.slice(0, merged.num_rows - 1))
        if open_ is not None:
            yield kept(open_)

    def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pc.greater_equal(batch["df"], support)).drop_columns("df")

    # Rows are sums already, so they are sorted, not hashed once more before they move.
    dealt = texts.mapInArrow(count, TERMS).repartition("lang", "term").sortWithinPartitions("lang", "term")
    return dealt.mapInArrow(merge, "lang string, term string, sources array<string>, counts array<long>")


def _merged(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows of equal (lang, term), which follow each other, as one."""
    new = np.ones(batch.num_rows, bool)
    for name in ("lang", "term"):
        other = pc.not_equal(batch[name].slice(1), batch[name].slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        new[1:] = other if name == "lang" else new[1:] | other
    begin = np.flatnonzero(new)
    row = np.repeat(np.cumsum(new) - 1, pc.list_value_length(batch["sources"]).to_numpy(zero_copy_only=False))
    names = batch["sources"].flatten().dictionary_encode()
    (row, source), (n,) = _summed([row, names.indices.to_numpy(zero_copy_only=False).astype(np.int64)], batch["counts"].flatten().to_numpy())
    cuts = pa.array(np.searchsorted(row, np.arange(len(begin) + 1)).astype(np.int32))
    at = pa.array(begin)
    columns = [
        batch["lang"].take(at),
        batch["term"].take(at),
        pa.array(np.add.reduceat(batch["df"].to_numpy(), begin)),
        pa.ListArray.from_arrays(cuts, names.dictionary.take(pa.array(source))),
        pa.ListArray.from_arrays(cuts, pa.array(n)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "term", "df", "sources", "counts"])


def chance(count: np.ndarray, total: np.ndarray | int, terms: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / (total + terms)); with Python's integers where 64 bits are too few."""
    if len(count) and int(count.max()) >= 9_000_000_000:
        totals = np.broadcast_to(total, count.shape)
        return np.array([1 + SCALE * (int(c) + 1) // (int(t) + terms) for c, t in zip(count, totals, strict=True)], np.int64)
    return 1 + SCALE * (count + 1) // (total + terms)


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Language:
    """Sources of one language with their numbers of occurrences."""

    def __init__(self, sources: list[str], totals: list[int], terms: int) -> None:
        self.place = {s: i for i, s in enumerate(sources)}
        self.sources, self.totals, self.terms = np.array(sources, object), np.array(totals, np.int64), terms
        self.total = sum(totals)
        self.unseen = chance(np.zeros(len(sources), np.int64), self.totals, terms) if terms else np.ones(len(sources), np.int64)

    def pair_sums(self, row: np.ndarray, source: np.ndarray, n: np.ndarray) -> np.ndarray:
        """[a, b]: the sum over the given terms of what a's use differs from b's, less what terms
        that neither uses give.

        ``row`` tells the term, rising.
        """
        size = len(self.totals)
        out = np.zeros((size, size), np.int64)
        blank = apart(self.unseen[:, None], self.unseen[None, :])
        # As if the other source used none of them: equal counts of a source are one case.
        (a, count), (times,) = _summed([source, n], np.ones(len(n), np.int64))
        p = chance(count, self.totals[a], self.terms)
        for begin in range(0, len(a), max(1, PAIR_ROWS // size)):
            at = slice(begin, begin + max(1, PAIR_ROWS // size))
            one, often = a[at], times[at, None]
            np.add.at(out, one, (apart(p[at, None], self.unseen[None, :]) - blank[one]) * often)
            np.add.at(out.T, one, (apart(self.unseen[None, :], p[at, None]) - blank.T[one]) * often)
        # Terms that both use.
        p = chance(n, self.totals[source], self.terms)
        begin = np.searchsorted(row, row, "left")
        users = np.searchsorted(row, row, "right") - begin
        cuts = np.searchsorted(np.cumsum(users), np.arange(0, int(users.sum()), PAIR_ROWS), "right")
        for low, high in zip(cuts, [*cuts[1:], len(row)], strict=True):
            one = np.repeat(np.arange(low, high), users[low:high])
            two = np.arange(len(one)) - np.repeat(np.cumsum(users[low:high]) - users[low:high], users[low:high]) + begin[one]
            a, b = source[one], source[two]
            more = apart(p[one], p[two]) - apart(p[one], self.unseen[b]) - apart(self.unseen[a], p[two]) + blank[a, b]
            np.add.at(out, (a, b), more)
        return out


def _flat(batch: pa.RecordBatch, rows: np.ndarray, language: Language) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    part = batch.take(pa.array(rows))
    row = np.repeat(np.arange(len(rows)), pc.list_value_length(part["sources"]).to_numpy(zero_copy_only=False))
    names = part["sources"].flatten().dictionary_encode()
    places = np.array([language.place[s] for s in names.dictionary.to_pylist()], np.int64)
    return row, places[names.indices.to_numpy(zero_copy_only=False)] if len(row) else row, part["counts"].flatten().to_numpy()


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        langs = batch["lang"].dictionary_encode()
        at = langs.indices.to_numpy(zero_copy_only=False)
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            yield lang, batch, np.flatnonzero(at == i)


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", support: int = SUPPORT, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` and ``term`` of every group.

    The table of groups and their totals is as long as the list of sources of all languages; it is
    gathered, as the result holds a row for each pair of them.
    """
    texts, groups = collapsed(docs, text, lang, source)
    kept = written(kept_terms(texts, support), "kept-terms")
    used = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("u")).groupBy("lang", F.col("u.sources").alias("source")).agg(F.sum("u.counts").alias("total"))
    numbers = groups.join(used, ["lang", "source"], "left").groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", F.coalesce("total", F.lit(0)).alias("total")))).alias("sources"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    rows = numbers.join(terms, "lang", "left").select("lang", "sources", F.coalesce("terms", F.lit(0)).alias("terms")).collect()
    known = {r["lang"]: ([s["source"] for s in r["sources"]], [s["total"] for s in r["sources"]], r["terms"]) for r in rows}
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = {name: Language(*numbers) for name, numbers in shared.value.items()}
        sums = {}
        for name, batch, at in _by_language(batches):
            language = languages[name]
            if name not in sums:
                sums[name] = np.zeros((len(language.totals),) * 2, np.int64)
            sums[name] += language.pair_sums(*_flat(batch, at, language))
        for name, found in sums.items():
            language = languages[name]
            a, b = np.nonzero(~np.eye(len(found), dtype=bool))
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(a), pa.string()), pa.array(language.sources[a], pa.string()), pa.array(language.sources[b], pa.string()), pa.array(found[a, b])], names=["lang", "source", "item", "value"])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages = {name: Language(*numbers) for name, numbers in shared.value.items()}
        for name, batch, at in _by_language(batches):
            language = languages[name]
            row, a, n = _flat(batch, at, language)
            every = np.zeros(len(at), np.int64)
            np.add.at(every, row, n)
            p, q = chance(n, language.totals[a], language.terms), chance(every, language.total, language.terms)[row]
            more = np.flatnonzero(p > q)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(more), pa.string()), pa.array(language.sources[a[more]], pa.string()), batch["term"].take(pa.array(at[row[more]])), pa.array(apart(p, q)[more])], names=["lang", "source", "item", "value"])

    def blank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What all terms of a language would give if neither source of a pair used any of them."""
        languages = {name: Language(*numbers) for name, numbers in shared.value.items()}
        for batch in batches:
            for name, one in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True):
                language = languages[name]
                at = language.place[one]
                values = [int(v) * language.terms for v in apart(language.unseen[at], language.unseen)]
                rows = [(name, one, two, v) for j, (two, v) in enumerate(zip(language.sources, values, strict=True)) if j != at]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string(), pa.string(), pa.string(), pa.int64()], strict=True)], names=["lang", "source", "item", "value"])

    schema = "lang string, source string, item string, value long"
    found = kept.mapInArrow(pairs, schema).unionByName(groups.mapInArrow(blank, schema)).groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value"))
    order = [F.desc("value"), F.asc("item")]
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    pair = ranked.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    term = top_ranked(kept.mapInArrow(words, schema), ["lang", "source"], order, top, "rank").select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pair.unionByName(term)
