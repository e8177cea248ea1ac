"""Benchmark decontamination: MinHash containment search over documents partitioned by size.

A short item inside a long document shares few of the document's shingles, so one signature length
cannot serve all.  Documents are partitioned by the power of two above their number of distinct
shingles, and each partition has its own number of MinHash bins (one permutation, one minimum per
bin), set from the upper size of the partition and the smallest item so that an item contained at
the threshold has no common minimum with probability ``miss`` at most.  Items get a signature for
every partition.  Only minima are joined; a pair with a common minimum is a candidate.  Then the shingles
of the candidates' texts, and of no others, are joined with those of their items: shared distinct
shingles, compared as text, over the item's distinct shingles.

Words are lower-cased and cut at white space and ASCII punctuation; a character of a script without
blanks is a word.  An item of fewer words than a shingle is one shingle of its own length.  Null texts are
empty texts; items without a word match nothing.  Equal items are separate items.  Rows of
one document id and different texts are judged apart; repeated rows give one pair.  Null ids are
kept.  Empty tables give no pairs.  Further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import fits_broadcast, lookup_join
from .common import pieces, text_key, whole, written

WORDS = 5
THRESHOLD = 0.8
MISS = 1e-6
# The filter that every task holds has this many places for each distinct shingle of the items, as a power
# of two between these bounds: one bit a place.
PLACES = 16
FILTER_BITS = (22, 29)
CLASSES = 40
ALL_BINS = 1 << 31
TEXT_BYTES = 2_000_000
CUT = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))
# Thai to Lao, Burmese, Khmer, kana, Han.
BLANKLESS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def words_of(text: str) -> list[bytes]:
    data = text.lower().encode("utf-8", "replace")
    if data and np.frombuffer(data, np.uint8).max() >= 0xE0:  # characters of three bytes or more
        data = BLANKLESS.sub(r" \g<0> ", data.decode()).encode()
    return data.translate(CUT).split()


def shingled(found: list[bytes], words: int = WORDS) -> tuple[np.ndarray, list[bytes]]:
    """Distinct 64-bit shingle hashes of a text's words, rising, and the shingles in the same order."""
    if len(found) < words:
        return np.empty(0, np.uint64), []
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    parts = [joined[a:b] for a, b in zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(0)), np.uint64, len(parts))
    hashes, first = np.unique(hashes, return_index=True)
    return hashes, [parts[i] for i in first.tolist()]


def bins_per_shingle(least: int, threshold: float = THRESHOLD, miss: float = MISS) -> float:
    """Bins for each shingle of a partition's upper size, from the smallest item's shingles.

    A shared shingle is the minimum of its bin on both sides with probability (1 - exp(-x)) / x,
    x being the shingles of both per bin; at the threshold an item brings a fifth of its own.
    """
    shared = max(1, math.ceil(threshold * least - 1e-9))
    need = 1 - miss ** (1 / shared)
    low, high = 1e-9, 50.0
    for _ in range(100):
        x = (low + high) / 2
        low, high = (x, high) if -math.expm1(-x) / x >= need else (low, x)
    return 1 / threshold / low


def bins(size_class: int, rate: float) -> int:
    return min(ALL_BINS, math.ceil(rate * 2.0 ** min(size_class, 60)))


def minima(hashes: np.ndarray, n_bins: int) -> np.ndarray:
    """Marks of the rising ``hashes`` that are the minimum of their bin; bins are ranges of hashes."""
    if n_bins >= ALL_BINS:
        return np.ones(len(hashes), bool)
    place = ((hashes >> np.uint64(32)) * np.uint64(n_bins)) >> np.uint64(32)
    return np.r_[True, place[1:] != place[:-1]][: len(hashes)]


def signed_items(items: DataFrame, item_id: str, text: str, words: int, threshold: float, miss: float) -> tuple[DataFrame, float]:
    """(item_id, item_row, length, shingle_hash, shingle, n_shingles, size_classes): an item's shingles,
    with the partitions in whose signature of the item they stand; and the bins per shingle."""
    items = items.select(F.col(item_id).alias("item_id"), F.monotonically_increasing_id().alias("row"), whole(text).alias("text"))
    kind = items.schema["item_id"].dataType.simpleString()

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", TEXT_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array([len(shingled(words_of(t.as_py()), words)[1]) for t in batch["text"]], pa.int64())], names=["n"])

    least = items.mapInArrow(sizes, "n long").filter("n > 0").agg(F.min("n")).first()[0]
    rate = bins_per_shingle(least or 1, threshold, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text", TEXT_BYTES):
            rows: list[tuple] = []
            for name, row, text_ in zip(*(batch[c].to_pylist() for c in ("item_id", "row", "text")), strict=True):
                own = words_of(text_)
                length = min(words, len(own))
                if not length:
                    continue
                hashes, parts = shingled(own, length)
                marks = np.array([minima(hashes, bins(c, rate) if length == words else ALL_BINS) for c in range(CLASSES)])
                for i, (h, part) in enumerate(zip(hashes.view(np.int64).tolist(), parts, strict=True)):
                    rows.append((name, row, length, h, part, len(parts), np.flatnonzero(marks[:, i]).tolist()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [batch.schema.types[0], *types], strict=True)], names=names)

    types = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int32())]
    names = ["item_id", "item_row", "length", "shingle_hash", "shingle", "n_shingles", "size_classes"]
    return items.mapInArrow(run, f"item_id {kind}, item_row long, length int, shingle_hash long, shingle binary, n_shingles long, size_classes array<int>"), rate


def _sieve(signed: DataFrame) -> tuple[int, np.ndarray]:
    """Bits of a filter over the items' shingles that grows with their number."""
    n = signed.agg(F.approx_count_distinct("shingle_hash")).first()[0]
    low, high = FILTER_BITS
    bits = min(high, max(low, math.ceil(math.log2(PLACES * max(n, 1)))))
    wanted = np.zeros(1 << bits, bool)
    place = F.col("shingle_hash").bitwiseAND((1 << bits) - 1).alias("place")
    wanted[signed.select(place).distinct().toPandas()["place"].to_numpy()] = True  # at most 2 ** 29 places
    return bits, np.packbits(wanted)


def contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", item_text: str = "text", words: int = WORDS, threshold: float = THRESHOLD, miss: float = MISS) -> DataFrame:
    """(doc_id, text_key, item_id, shared, containment) of every item in a document."""
    signed, rate = signed_items(items, item_id, item_text, words, threshold, miss)
    signed = written(signed, "item-shingles")
    lengths = sorted(r[0] for r in signed.select("length").distinct().collect())  # at most ``words``
    bits, marks = _sieve(signed)
    sieve = docs.sparkSession.sparkContext.broadcast(marks)
    keyed = docs.select(F.col(doc_id).alias("doc_id"), text_key(whole(text)).alias("key"), whole(text).alias("text"))
    kind = keyed.schema["doc_id"].dataType.simpleString()
    key = keyed.schema["key"].dataType.simpleString()

    def passing(found: np.ndarray, passes: np.ndarray) -> np.ndarray:
        return passes[(found & np.uint64((1 << bits) - 1)).astype(np.int64)]

    def minima_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(sieve.value).view(bool)
        for batch in pieces(batches, "text", TEXT_BYTES):
            at, of_length, classes, hashes = [], [], [], []
            for i, t in enumerate(batch["text"]):
                own = words_of(t.as_py())
                for length in lengths:
                    found, _ = shingled(own, length)
                    size_class = max(len(found) - 1, 0).bit_length()
                    hits = passing(found, passes)
                    if length == words:
                        hits &= minima(found, bins(size_class, rate))
                    n = int(hits.sum())
                    if n:
                        at += [i] * n
                        of_length += [length] * n
                        classes += [size_class] * n
                        hashes.append(found[hits])
            if at:
                rows = pa.array(at)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].take(rows), batch["key"].take(rows), pa.array(of_length, pa.int32()), pa.array(classes, pa.int32()), pa.array(np.concatenate(hashes).view(np.int64))], names=["doc_id", "key", "length", "size_class", "shingle_hash"])

    def shingles_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = np.unpackbits(sieve.value).view(bool)
        for batch in pieces(batches, "text", TEXT_BYTES):
            at, of_length, hashes, parts = [], [], [], []
            for i, t in enumerate(batch["text"]):
                own = words_of(t.as_py())
                for length in lengths:
                    found, own_parts = shingled(own, length)
                    hits = np.flatnonzero(passing(found, passes))
                    at += [i] * len(hits)
                    of_length += [length] * len(hits)
                    hashes.append(found[hits])
                    parts += [own_parts[j] for j in hits.tolist()]
            if at:
                yield pa.RecordBatch.from_arrays([batch["key"].take(pa.array(at)), pa.array(of_length, pa.int32()), pa.array(np.concatenate(hashes).view(np.int64)), pa.array(parts, pa.binary())], names=["key", "length", "shingle_hash", "shingle"])

    hits = keyed.mapInArrow(minima_of, f"doc_id {kind}, key {key}, length int, size_class int, shingle_hash long")
    signs = signed.select("item_id", "item_row", "length", "shingle_hash", "size_classes")
    met = lookup_join(hits, signs, ["length", "shingle_hash"], "key").filter(F.expr("array_contains(size_classes, size_class)"))
    candidates = written(met.select("doc_id", "key", "item_id", "item_row").distinct(), "leak-candidates")
    # The texts of the candidates, one of each.
    keys = candidates.select("key").distinct()
    texts = keyed.select("key", "text").join(F.broadcast(keys) if fits_broadcast(keys) else keys, "key", "left_semi")
    own = texts.groupBy("key").agg(F.first("text").alias("text")).mapInArrow(shingles_of, f"key {key}, length int, shingle_hash long, shingle binary")
    pairs = candidates.select("key", "item_row").distinct()
    asked = lookup_join(pairs, signed.select("item_row", "length", "shingle_hash", "shingle", "n_shingles"), ["item_row"], "key")
    same = asked.join(own, ["key", "length", "shingle_hash", "shingle"])
    shared = same.groupBy("key", "item_row").agg(F.count(F.lit(1)).alias("shared"), F.max("n_shingles").alias("n_shingles"))
    held = shared.withColumn("containment", F.col("shared") / F.col("n_shingles")).filter(F.col("containment") >= threshold).drop("n_shingles")
    found = lookup_join(candidates, written(held, "leaks"), ["key", "item_row"], "doc_id")
    return found.select("doc_id", F.col("key").alias("text_key"), "item_id", "shared", "containment")


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns.

    The list of rows to drop is broadcast when it is measured to be small, so the texts stay.
    """
    found = contained(docs, items, doc_id=doc_id, text=text, **how).select(F.col("text_key").alias("found_key")).distinct()
    found = written(found, "leaked-texts")
    names = docs.columns
    keyed = docs.select(F.struct(*names).alias("row"), text_key(whole(text)).alias("own_key"))
    small = F.broadcast(found) if fits_broadcast(found) else found
    return keyed.join(small, F.col("own_key") == F.col("found_key"), "left_anti").select("row.*")
