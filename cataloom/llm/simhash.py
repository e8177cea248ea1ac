"""SimHash near-duplicates with a Gray-order hierarchical index.

Fingerprints are 64 bits over word shingles.  Two fingerprints with at most ``distance`` differing
bits agree on one of ``distance + 1`` blocks of bits, so the distinct fingerprints are dealt to the
buckets of their block values; a bucket beyond ``bucket_rows`` is dealt again by the blocks of the
bits that are still free.  Inside a bucket the fingerprints are sorted by Gray rank, runs of
neighbours form the nodes of a tree, and each node holds the bits on which its members agree and
which its parent does not hold.  A search adds up differing bits from the root down and leaves a
whole group when the sum exceeds the distance.  A bucket returns at most one link per fingerprint:
a spanning forest of its links, never all pairs.

Null texts are empty texts; a text without words has fingerprint zero and is linked like any other.
Null ids are never a ``component_id`` unless a whole component has no other.  Repeated rows stay
repeated.  An empty table gives an empty table.  Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import sliced, whole, written
from .components import components

SEED = 42
BITS = 64
FAN = 8
BLOCK_ROWS = 65_536
FRONTIER = 2_000_000
SLICE = 65_536


def fingerprint(text: bytes, words_per_shingle: int = 3) -> int:
    """64-bit SimHash of a text in UTF-8."""
    words = text.lower().split()  # of bytes: lowers A-Z, splits at space and \t \n \v \f \r
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= words_per_shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - words_per_shingle + 1].tolist()
    ends = ends[words_per_shingle - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(starts), SLICE):
        shingles = [joined[a:b] for a, b in zip(starts[i : i + SLICE], ends[i : i + SLICE], strict=True)]
        hashes = np.array(list(map(xxhash.xxh64_intdigest, shingles, repeat(SEED))), ">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words_per_shingle: int = 3) -> DataFrame:
    """(id, text_hash, fp) of every row; ``text_hash`` tells rows of one id apart."""
    docs = docs.select(F.col(id_column), F.xxhash64(whole(text)).alias("text_hash"), whole(text).cast("binary").alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = np.array([fingerprint(t.as_py(), words_per_shingle) for t in batch.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], names=[id_column, "text_hash", "fp"])

    return docs.mapInArrow(run, f"`{id_column}` {kind}, text_hash long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each 64-bit code word in the reflected Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Trees over the fingerprints of many buckets, one root per bucket.

    ``levels[0]`` are the fingerprints, sorted by bucket and Gray rank; a node of level ``i + 1``
    covers up to ``FAN`` neighbours of level ``i``.  ``own`` holds the bits that a node's members
    share and its parent's do not.
    """

    def __init__(self, bucket: np.ndarray, codes: np.ndarray):
        order = np.lexsort((gray_rank(codes), bucket))
        self.codes, bucket = codes[order], bucket[order]
        self.bucket = bucket
        shared, last = np.full(len(codes), ~np.uint64(0)), np.arange(len(codes))
        self.levels = [{"pattern": self.codes, "own": shared.copy(), "last": last}]
        pattern = self.codes
        while True:
            begins = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            if len(begins) == len(bucket):
                break
            place = np.arange(len(bucket)) - np.repeat(begins, np.diff(np.r_[begins, len(bucket)]))
            first = np.flatnonzero(place % FAN == 0)
            count = np.diff(np.r_[first, len(bucket)])
            ones = np.bitwise_and.reduceat(pattern & shared, first)
            zeros = np.bitwise_and.reduceat(~pattern & shared, first)
            parent = np.repeat(np.arange(len(first)), count)
            up = ones | zeros
            self.levels[-1]["own"] = shared & ~up[parent]
            shared, pattern, last, bucket = up, ones, last[first + count - 1], bucket[first]
            self.levels.append({"pattern": pattern, "own": shared.copy(), "last": last, "first": first, "count": count})
        self.roots = bucket

    def links(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j), i < j, of linked places, for some of the fingerprints at a time."""
        begins = np.flatnonzero(np.r_[True, self.bucket[1:] != self.bucket[:-1]])
        sizes = np.diff(np.r_[begins, len(self.bucket)])
        root = np.repeat(np.arange(len(begins)), sizes)
        query = np.flatnonzero(sizes[root] > 1)
        turn = np.cumsum(sizes[root[query]]) // FRONTIER
        for part in np.split(query, np.flatnonzero(np.diff(turn)) + 1):
            if len(part):
                yield self._search(part, root[part], distance)

    def _search(self, query: np.ndarray, node: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
        apart = np.zeros(len(query), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            level = self.levels[depth]
            apart = apart + np.bitwise_count((self.codes[query] ^ level["pattern"][node]) & level["own"][node])
            stay = (apart <= distance) & (level["last"][node] > query)
            query, node, apart = query[stay], node[stay], apart[stay]
            if depth:
                count = level["count"][node]
                begin = np.repeat(level["first"][node] - (np.cumsum(count) - count), count)
                query, apart, node = np.repeat(query, count), np.repeat(apart, count), begin + np.arange(count.sum())
        return query, node


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the places of each pair one label, the least place of what is linked so far."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        open_ = low != high
        if not open_.any():
            return
        a, b = a[open_], b[open_]
        np.minimum.at(label, high[open_], low[open_])
        while (label[label] != label).any():
            label[:] = label[label]


def forest(bucket: np.ndarray, codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (code, code) that connect what is linked inside the buckets, at most one per code."""
    index = GrayIndex(bucket, codes)
    label = np.arange(len(codes))
    for a, b in index.links(distance):
        _merge(label, a, b)
    linked = np.flatnonzero(label != np.arange(len(codes)))
    return index.codes[linked], index.codes[label[linked]]


def _blocks(free: int, parts: int) -> list[int]:
    """Masks that split the set bits of ``free`` into ``parts`` runs."""
    places = [i for i in range(BITS) if free >> i & 1]
    return [sum(1 << i for i in chosen.tolist()) for chosen in np.array_split(np.array(places, dtype=object), parts)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _dealt(rows: DataFrame, paths: dict[int, int], parts: int) -> tuple[DataFrame, dict[int, int]]:
    """Rows (path, fp) once for each block of their path's free bits; the new paths' fixed bits."""
    chosen, fixed = [], {}
    for path, mask in paths.items():
        for block in _blocks(~mask & ((1 << BITS) - 1), parts):
            new = path * parts + len([1 for p in fixed if p // parts == path])
            fixed[new] = mask | block
            chosen.append(F.when(F.col("path") == path, F.struct(F.lit(new).alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(mask | block))).alias("held"))))
    cells = F.explode(F.filter(F.array(*chosen), lambda c: c.isNotNull())).alias("cell")
    return rows.select(cells, "fp").select("cell.path", "cell.held", "fp"), fixed


def links(codes: DataFrame, distance: int = 3, bucket_rows: int = 8192, levels: int = 3) -> DataFrame:
    """Distinct fingerprints (fp) -> links (u, v) that connect all pairs within ``distance`` bits."""
    rows, paths, parts, out = codes.withColumn("path", F.lit(0)), {0: 0}, distance + 1, []
    for level in range(levels):
        rows, paths = _dealt(rows, paths, parts)
        full = rows.groupBy("path", "held").count().filter(F.col("count") > bucket_rows).select("path", "held")
        if level + 1 == levels or full.isEmpty():
            out.append(rows)
            break
        out.append(rows.join(full, ["path", "held"], "left_anti"))
        rows = rows.join(full, ["path", "held"]).select("path", "fp")
    found = [_searched(part, distance) for part in out]
    whole_ = found[0]
    for more in found[1:]:
        whole_ = whole_.union(more)
    return whole_


def _searched(rows: DataFrame, distance: int) -> DataFrame:
    """Search the buckets (path, held); a task holds whole buckets of some ``BLOCK_ROWS`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0

        def searched(path, held, code):
            new = np.r_[True, (path[1:] != path[:-1]) | (held[1:] != held[:-1])]
            a, b = forest(np.cumsum(new), code.view(np.uint64), distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["u", "v"])

        def joined():
            return [np.concatenate(c) for c in zip(*waiting, strict=True)]

        for batch in batches:
            waiting.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            size += batch.num_rows
            if size < BLOCK_ROWS:
                continue
            path, held, code = joined()
            others = np.flatnonzero((path != path[-1]) | (held != held[-1]))
            cut = others[-1] + 1 if len(others) else 0  # the last bucket may go on in the next batch
            if cut:
                yield searched(path[:cut], held[:cut], code[:cut])
            waiting, size = [(path[cut:], held[cut:], code[cut:])], len(path) - cut
        if size:
            yield searched(*joined())

    dealt = rows.select("path", "held", "fp").repartition("path", "held").sortWithinPartitions("path", "held")
    return dealt.mapInArrow(run, "u long, v long")


def classes(marked: DataFrame, distance: int = 3) -> DataFrame:
    """(fp, root) of every distinct fingerprint of ``fingerprints``; linked ones have one root."""
    codes = marked.select("fp").distinct()
    roots = components(links(codes, distance)).select(F.col("node").alias("fp"), "root")
    return codes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words_per_shingle: int = 3, distance: int = 3) -> DataFrame:
    """(id, fingerprint, component_id) of every row."""
    marked = written(fingerprints(docs, id_column, text, words_per_shingle), "fingerprints")
    least = marked.groupBy("fp").agg(F.min(id_column).alias("least")).join(classes(marked, distance), "fp")
    ids = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = least.select("fp", "root").join(ids, "root")
    return marked.join(named, "fp").select(id_column, hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def _row_key(id_column: str, text_hash: Column) -> Column:
    """A string, never null, so that one exchange serves both the window and the join."""
    return F.concat_ws(":", F.col(id_column).cast("string"), text_hash.cast("string"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words_per_shingle: int = 3, distance: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the row with the least id, with all its columns.

    Null ids come last; of equal ids the least text hash stays, of equal rows any one.
    """
    marked = written(fingerprints(docs, id_column, text, words_per_shingle), "fingerprints")
    rank = F.struct(F.col(id_column).isNull().alias("no_id"), F.col(id_column).alias("id"), F.col("text_hash").alias("hash"))
    least = marked.groupBy("fp").agg(F.min(rank).alias("least")).join(classes(marked, distance), "fp")
    first = least.groupBy("root").agg(F.min("least").alias("stay")).select(_row_key("stay.id", F.col("stay.hash")).alias("key"))
    names = docs.columns
    copies = Window.partitionBy("key").orderBy(F.lit(0))
    keyed = docs.select(F.struct(*names).alias("row"), _row_key(id_column, F.xxhash64(whole(text))).alias("key")).withColumn("copy", F.row_number().over(copies))
    return keyed.filter("copy = 1").join(first, "key", "left_semi").select("row.*")
