"""Conversation prefix trie, built as a burst trie.

A conversation is a sequence of turn ids (128 hash bits of role and text).  Equal sequences are one
entry with the number of conversations and the least of them.  All entries begin in the container of the
root.  A container of more than ``CONTAINER`` entries bursts: its head, with the turns that all its
entries share, becomes part of the trie, and the entries go to containers of the next turn, without the
turns that are behind them.  Bursting goes on until every container is small; then each is sorted by its
suffixes and swept in that order by one task, which holds the turns of the current path and the children
that wait for their parent.  What containers sum up goes to the heads above them, level by level.  A
burst parts its container at a turn where entries differ, so there are as many rounds as such turns lie
above each other in containers that are too large, two or three in conversations as they are.

Conversations are ordered by turn, null first, and then by role and text; null roles and texts are empty;
repeated rows are turns of their own.  Rows without a ``conv_id`` belong to no conversation and are left
out.  An empty table gives an empty table: a trie needs a member.  Further columns are ignored.  A
conversation's turn ids, 16 bytes each, are one row; its texts never are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from .common import written

CONTAINER = 4096
GROUP = 5
HEADS = 9
# A block of near ids holds 2 ** ID_BITS of them.
ID_BITS = 12
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, seq string"


def numbered(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place, tid, size): the turns of each conversation from 0, their ids and UTF-8 bytes."""
    filled = turns.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")).filter("conv_id is not null")
    tid = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    return filled.select("conv_id", (F.row_number().over(order) - 1).alias("place"), tid.alias("tid"), F.octet_length("text").cast("long").alias("size"))


def borrowed(conv_id: Column, group: int = GROUP, heads: int = HEADS) -> tuple[Column, Column]:
    """The conversation whose first turns a rebuilt one begins with, and how many they are."""
    return conv_id - conv_id % group, F.crc32(conv_id.cast("string").cast("binary")) % heads


def rebuilt(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """(conv_id, tids, sizes) of every conversation: a head of another one, then its own turns behind.

    ``turns`` is a written table of :func:`numbered` turns.  A conversation is the base of at most
    ``group`` others, so no key of the join is large.
    """
    base, many = borrowed(F.col("conv_id"), group, heads)
    convs = turns.select("conv_id").distinct().select("conv_id", base.alias("base"), many.alias("h"))
    first = turns.filter(F.col("place") < heads - 1).filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), "place", "tid", "size")
    head = convs.join(first, "base").filter("place < h").select("conv_id", "place", "tid", "size")
    own = turns.filter(F.col("place") >= many).select("conv_id", "place", "tid", "size")
    some = head.unionByName(own).select("conv_id", F.struct("place", "tid", "size").alias("turn"))
    none = convs.select("conv_id", F.lit(None).cast(some.schema["turn"].dataType).alias("turn"))
    gathered = some.unionByName(none).groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return gathered.select("conv_id", F.col("turns.tid").alias("tids"), F.col("turns.size").alias("sizes"))


def _ends(members: DataFrame) -> DataFrame:
    """(seq, ends_sha256): a digest over the ids of a sequence's conversations, ascending.

    Ids are joined in blocks of near numbers first; the digest, a chain, then runs over the blocks.
    """
    block = F.shiftright("conv_id", ID_BITS)
    chunks = members.groupBy("seq", block.alias("block")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, state = None, None
        for batch in batches:
            done = []
            for s, ids in zip(batch["seq"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if s != seq:
                    if seq is not None:
                        done.append((seq, state.hexdigest()))
                    seq, state = s, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield from rows(done)
        if seq is not None:
            yield from rows([(seq, state.hexdigest())])

    def rows(done: list[tuple[str, str]]) -> Iterator[pa.RecordBatch]:
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["seq", "ends_sha256"])

    dealt = chunks.repartition("seq").sortWithinPartitions("seq", "block")
    return dealt.select("seq", "ids").mapInArrow(run, "seq string, ends_sha256 string")


class Sweep:
    """Nodes of one container from its sorted suffixes.

    A frame is [turn id, size of its text, conversations, least one, children that wait, leaves,
    saved, sequence that ends here]; a child waits until its parent's least conversation is known.
    """

    def __init__(self, head: tuple) -> None:
        self.head, self.parent, self.parent_least, self.depth, size = head
        self.path: list[list] = [[None, size, 0, None, [], 0, 0, None]]

    def add(self, tids: list[bytes], sizes: list[int], n: int, least: int, seq: str) -> Iterator[tuple]:
        path = self.path
        same = 0
        while same < len(tids) and same + 1 < len(path) and path[same + 1][0] == tids[same]:
            same += 1
        yield from self.back(same)
        path += [[t, s, 0, least, [], 0, 0, None] for t, s in zip(tids[same:], sizes[same:], strict=True)]
        last = path[-1]
        last[2], last[3], last[7] = n, least if last[3] is None else min(last[3], least), seq

    def back(self, depth: int) -> Iterator[tuple]:
        """Leave the path down to ``depth``; yields the nodes below what is left."""
        while len(self.path) > depth + 1:
            done = self.path.pop()
            yield from self.below(done, len(self.path))
            over = self.path[-1]
            over[2], over[3] = over[2] + done[2], done[3] if over[3] is None else min(over[3], done[3])
            over[4].append(self.row(done, len(self.path)))
            over[5] += over[4][-1][5]
            over[6] += over[4][-1][6]

    def row(self, frame: list, depth: int) -> list:
        _, size, n, least, children, leaves, saved, seq = frame
        return [least, self.depth + depth, None, n, len(children), leaves or 1, saved + (n - 1) * size, seq]

    def below(self, frame: list, depth: int) -> Iterator[tuple]:
        for child in frame[4]:
            child[2] = frame[3]
            yield (None, None, *child)

    def end(self) -> Iterator[tuple]:
        yield from self.back(0)
        yield from self.below(self.path[0], 0)
        top = self.row(self.path[0], 0)
        top[2] = self.parent_least
        yield (self.head, self.parent, *top)


def swept(entries: DataFrame) -> DataFrame:
    """Nodes of all containers; the node of a container's head has ``head`` and ``parent`` set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = None
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                if sweep is None or sweep.head != r["head"]:
                    if sweep is not None:
                        out += sweep.end()
                    sweep = Sweep((r["head"], r["parent"], r["parent_least"], r["depth"], r["size"]))
                out += sweep.add(r["tids"], r["sizes"], r["n"], r["least"], r["seq"])
            yield from rows(out)
        if sweep is not None:
            yield from rows(list(sweep.end()))

    def rows(out: list[tuple]) -> Iterator[pa.RecordBatch]:
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    names = ["head", "parent", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "seq"]
    types = [pa.string(), pa.string(), *[pa.int64()] * 7, pa.string()]
    dealt = entries.repartition("head").sortWithinPartitions("head", "tids")
    return dealt.mapInArrow(run, f"head string, parent string, {NODE}")


def _burst(active: DataFrame, container: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """Part the containers that are too large: (entries of the others, heads, entries of new containers)."""
    large = written(active.groupBy("head").agg(F.count(F.lit(1)).alias("entries")).filter(F.col("entries") > container).select("head"), "trie-large")
    if large.isEmpty():
        return None
    mark = F.lit(True).alias("large")
    small = active.join(F.broadcast(large) if large.count() <= 100_000 else large, "head", "left_anti")
    bursting = lookup_join(active, large.select("head", mark), ["head"], "seq").drop("large")
    one = bursting.groupBy("head").agg(
        F.min("tids").alias("low"),
        F.max("tids").alias("high"),
        F.sum("n").alias("n"),
        F.min("least").alias("least"),
        *[F.first(c).alias(c) for c in ("parent", "parent_least", "depth", "size")],
    )
    # All entries share the turns that the first and the last one in order share.
    shortest = F.least(F.size("low"), F.size("high"))
    apart = F.filter(F.sequence(F.lit(0), shortest), lambda i: (i == shortest) | (F.get("low", i) != F.get("high", i)))
    heads = written(one.withColumn("stem", F.array_min(apart).cast("int")), "trie-heads")
    info = heads.select("head", "stem", F.col("least").alias("head_least"))
    below = lookup_join(bursting, info, ["head"], "seq")
    inner = below.filter(F.size("tids") > F.col("stem"))
    rest = lambda c: F.slice(c, F.col("stem") + 2, F.greatest(F.size(c) - F.col("stem") - 1, F.lit(0)))
    child = inner.select(
        F.md5(F.concat("head", F.lit("/"), F.hex(F.get("tids", F.col("stem"))))).alias("head"),
        F.col("head").alias("parent"),
        F.col("head_least").alias("parent_least"),
        (F.col("depth") + F.col("stem") + 1).alias("depth"),
        F.get("sizes", F.col("stem")).alias("size"),
        "seq",
        rest("tids").alias("tids"),
        rest("sizes").alias("sizes"),
        "n",
        "least",
    )
    ended = below.filter(F.size("tids") == F.col("stem")).select("head", F.col("seq").alias("end_seq"))
    sizes = below.select("head", F.slice("sizes", F.lit(1), F.col("stem")).alias("stem_sizes"))
    stems = sizes.groupBy("head").agg(F.min("stem_sizes").alias("stem_sizes"))
    heads = written(heads.join(stems, "head").join(ended, "head", "left"), "trie-bursts")
    return small, heads, written(child, "trie-entries")


def _head_nodes(heads: DataFrame, tops: DataFrame) -> DataFrame:
    """Nodes of heads that have burst, with their stems, from the sums of the containers below."""
    sums = tops.groupBy(F.col("parent").alias("head")).agg(F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("below"))
    node = heads.join(sums, "head").select("*", F.explode(F.sequence(F.lit(0), F.col("stem"))).alias("i"))
    top, last = F.col("i") == 0, F.col("i") == F.col("stem")
    texts = F.concat(F.array("size"), "stem_sizes")
    behind = F.aggregate(F.slice(texts, F.col("i") + 1, F.size(texts)), F.lit(0).cast("long"), lambda a, b: a + b)
    return node.select(
        F.when(top, F.col("head")).alias("head"),
        F.when(top, F.col("parent")).alias("parent"),
        F.col("least").alias("conv_id"),
        (F.col("depth") + F.col("i")).alias("depth"),
        F.when(top, F.col("parent_least")).otherwise(F.col("least")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(last, F.col("children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("below") + (F.col("n") - 1) * behind).alias("saved_tokens"),
        F.when(last, F.col("end_seq")).alias("seq"),
    )


def trie(sequences: DataFrame, container: int = CONTAINER) -> DataFrame:
    """(conv_id, tids, sizes) -> a row per node of the trie."""
    seq = F.sha2(F.array_join(F.transform("tids", lambda t: F.hex(t)), ""), 256)
    members = written(sequences.select("conv_id", seq.alias("seq"), "tids", "sizes"), "trie-members")
    entries = members.groupBy("seq").agg(F.first("tids").alias("tids"), F.first("sizes").alias("sizes"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"))
    root = [F.lit("").alias("head"), F.lit(None).cast("string").alias("parent"), F.lit(None).cast("long").alias("parent_least"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("size")]
    active = written(entries.select(*root, "seq", "tids", "sizes", "n", "least"), "trie-entries")
    settled, levels = [], []
    while burst := _burst(active, container):
        small, heads, active = burst
        settled.append(small)
        levels.append(heads)
    for small in settled:
        active = active.unionByName(small)
    nodes = written(swept(active), "trie-nodes")
    every, tops = [nodes], nodes.filter("head is not null").select("parent", "n_leaves", "saved_tokens")
    for heads in reversed(levels):
        found = written(_head_nodes(heads, tops), "trie-nodes")
        every.append(found)
        tops = tops.unionByName(found.filter("head is not null").select("parent", "n_leaves", "saved_tokens"))
    nodes = every[0]
    for more in every[1:]:
        nodes = nodes.unionByName(more)
    digests = _ends(members.select("conv_id", "seq"))
    out = nodes.drop("head", "parent").join(digests, "seq", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))


def prefix_trie(turns: DataFrame, container: int = CONTAINER, **columns: str) -> DataFrame:
    """The trie of the rebuilt conversations of a table of turns."""
    return trie(rebuilt(written(numbered(turns, **columns), "trie-turns")), container)
