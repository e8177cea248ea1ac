"""Byte-level BPE encoding and decoding by recursive DuckDB queries, one database per partition.

A text is cut by the pattern of the vocabulary.  Each distinct word of some texts that is no token by
itself goes through a recursive query: its token positions are rows that join the merge table, and
the leftmost pair of the least rank is contracted until no pair of the word is in the table.  A word
of more than ``LONG_WORD`` bytes contracts, from the left, all pairs of the least rank in one step,
up to the first whose token makes a pair of a lower rank with a neighbour: the same contractions in the
same order, but steps for each rank and not for each pair, and only the last step is held.  Decoding
joins the ids with the vocabulary and aggregates the bytes in the order of the positions.

The vocabulary file is read once on the driver and broadcast: its size does not depend on the data.
Texts are handled in slices of some million characters and words in slices of bounded cost, so the
memory of a task is bounded by these and by its longest text; a database may take ``MEMORY`` and
``WORD_MEMORY`` for each byte of the longest unbroken word.

Null texts are empty texts and have no ids.  Each row is handled by itself: repeated rows and ids
stay, null ids are kept, an empty table gives an empty table, further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, whole

SLICE_CHARS = 2_000_000
# All steps of a slice's recursion are held, so a word costs its length squared.
SLICE_COST = 8_000_000
LEAST_COST = 400
LONG_WORD = 512
KNOWN_WORDS = 400_000
KNOWN_TOKENS = 4_000_000
PIECE_TOKENS = 200_000
# Megabytes, and bytes for each byte of a long word.
MEMORY = 200
WORD_MEMORY = 800

# ``least`` is rank and place of the pair that was contracted last; null ends a word.
CONTRACT = """
    WITH RECURSIVE step(word, ids, least) AS (
        SELECT word, ids, 0::BIGINT FROM words
        UNION ALL
        SELECT step.word,
               CASE WHEN pair.least IS NULL THEN step.ids
                    ELSE step.ids[:pair.least % 4294967296 - 1] || [pair.least // 4294967296] || step.ids[pair.least % 4294967296 + 2:] END,
               pair.least
        FROM step
        LEFT JOIN (
            SELECT token.word, min(merges.rank * 4294967296 + token.place) AS least
            FROM (SELECT word, ids, unnest(range(1, len(ids))) AS place FROM step WHERE least IS NOT NULL) token
            JOIN merges ON merges.pair = token.ids[token.place] * 4294967296 + token.ids[token.place + 1]
            GROUP BY token.word
        ) pair ON pair.word = step.word
        WHERE step.least IS NOT NULL
    )
    SELECT word, ids FROM step WHERE least IS NULL ORDER BY word
"""

# ``taken`` are the pairs of the least rank that do not overlap, from the left: in a run of such pairs
# every second one.  ``risky`` is one whose token has a pair of a lower rank with the token before or
# behind it; what stands right of it waits for the next step.
CONTRACT_LONG = """
    WITH RECURSIVE step(word, ids) USING KEY (word) AS (
        SELECT word, ids FROM words
        UNION
        SELECT word, list(CASE WHEN joined THEN least ELSE id END ORDER BY place)
        FROM (
            SELECT word, place, id, least, joined, lag(joined, 1, false) OVER (PARTITION BY word ORDER BY place) AS gone
            FROM (
                SELECT word, place, id, least,
                       taken AND place <= min(CASE WHEN taken AND risky THEN place ELSE 4294967296 END) OVER (PARTITION BY word) AS joined
                FROM (
                    SELECT pair.*, one.rank < least OR two.rank < least AS risky
                    FROM (
                        SELECT word, place, id, least, taken, lead(id, 2) OVER places AS behind,
                               CASE WHEN lag(taken, 2, false) OVER places THEN least ELSE lag(id) OVER places END AS before
                        FROM (
                            SELECT *, rank IS NOT DISTINCT FROM least AND (place - coalesce(max(CASE WHEN rank IS DISTINCT FROM least THEN place END) OVER (PARTITION BY word ORDER BY place), 0)) % 2 = 1 AS taken
                            FROM (
                                SELECT token.word, place, id, merges.rank, min(merges.rank) OVER (PARTITION BY token.word) AS least
                                FROM (SELECT word, unnest(ids) AS id, unnest(ids[2:]) AS next, generate_subscripts(ids, 1) AS place FROM step) token
                                LEFT JOIN merges ON merges.pair = token.id * 4294967296 + token.next
                            ) WHERE least IS NOT NULL
                        ) WINDOW places AS (PARTITION BY word ORDER BY place)
                    ) pair
                    LEFT JOIN merges one ON taken AND one.pair = before * 4294967296 + least
                    LEFT JOIN merges two ON taken AND two.pair = least * 4294967296 + behind
                )
            )
        ) WHERE NOT gone
        GROUP BY word
    )
    SELECT word, ids FROM step ORDER BY word
"""

DECODE = """
    SELECT piece, unhex(coalesce(string_agg(vocabulary.digits, '' ORDER BY token.place), '')) AS bytes
    FROM (SELECT piece, unnest(ids) AS id, generate_subscripts(ids, 1) AS place FROM pieces) token
    JOIN vocabulary ON vocabulary.id = token.id
    GROUP BY piece ORDER BY piece
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file: lines of base64 text and a number."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.cut = regex.compile(pattern).findall
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": f"{MEMORY}MB", "temp_directory": ""})
        self.db.execute("SET preserve_insertion_order = false")
        tokens = pa.table({"bytes": pa.array(ranks, pa.binary()), "id": pa.array(ranks.values(), pa.int64())})
        self.db.register("given", tokens)
        self.db.execute("CREATE TABLE vocabulary AS SELECT id, bytes, hex(bytes) AS digits FROM given")
        self.db.unregister("given")
        self.merge_table()
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.forget()

    def forget(self) -> None:
        """The words met so far: their places, and by place their ids and the ids as text."""
        self.words: dict[str, int] = {}
        self.begin, self.flat, self.shown = np.zeros(1, np.int64), np.empty(0, np.int32), []

    def merge_table(self) -> None:
        """Every pair of tokens that together are a token, with the rank of that token."""
        rows = [(self.ranks[t[:i]] << 32 | self.ranks[t[i:]], rank) for t, rank in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks]
        pairs = np.array(rows, np.int64).reshape(-1, 2)
        self.db.register("given", pa.table({"pair": pairs[:, 0], "rank": pairs[:, 1]}))
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.db.unregister("given")

    def contracted(self, query: str, raw: list[bytes]) -> list[np.ndarray]:
        """The ids of each word, by a recursive query."""
        offsets = pa.array(np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int32))
        ids = self.bytes[np.frombuffer(b"".join(raw), np.uint8)]
        self.db.register("words", pa.table({"word": pa.array(range(len(raw)), pa.int64()), "ids": pa.ListArray.from_arrays(offsets, pa.array(ids))}))
        out = self.db.sql(query).to_arrow_table().combine_chunks()
        self.db.unregister("words")
        lists = out.column("ids").chunk(0)
        return np.split(lists.values.to_numpy(), lists.offsets.to_numpy()[1:-1])

    def contracted_long(self, raw: bytes) -> np.ndarray:
        """The ids of one long word."""
        self.db.execute(f"SET memory_limit = '{MEMORY + len(raw) * WORD_MEMORY // 1_000_000}MB'")
        ids = self.contracted(CONTRACT_LONG, [raw])[0]
        self.db.execute(f"SET memory_limit = '{MEMORY}MB'")
        return ids

    def learn(self, words: list[str]) -> None:
        """Find the ids of words that were not met so far."""
        whole_words = [w.encode("utf-8", "surrogatepass") for w in words]
        costs = np.cumsum([max(LEAST_COST, min(len(r), LONG_WORD) ** 2) for r in whole_words])
        for places in np.split(np.arange(len(words)), np.flatnonzero(np.diff(costs // SLICE_COST)) + 1):
            raw = [whole_words[i] for i in places.tolist()]
            found = [np.array([self.ranks[r]]) if r in self.ranks else self.contracted_long(r) if len(r) > LONG_WORD else None for r in raw]
            open_ = [i for i, ids in enumerate(found) if ids is None]
            if open_:
                for i, ids in zip(open_, self.contracted(CONTRACT, [raw[i] for i in open_]), strict=True):
                    found[i] = ids
            self.words.update((words[i], len(self.shown) + k) for k, i in enumerate(places.tolist()))
            self.begin = np.r_[self.begin, self.begin[-1] + np.cumsum([len(x) for x in found], dtype=np.int64)]
            self.flat = np.concatenate([self.flat, *found]).astype(np.int32)
            self.shown += [",".join(map(str, x.tolist())) for x in found]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The places of each text's words."""
        if len(self.words) > KNOWN_WORDS or len(self.flat) > KNOWN_TOKENS:
            self.forget()
        cut = [self.cut(t) for t in texts]
        new: dict[str, None] = {}
        for words in cut:
            new.update(dict.fromkeys(w for w in words if w not in self.words))
        self.learn(list(new))
        return [[self.words[w] for w in words] for words in cut]

    def ids(self, places: list[int]) -> np.ndarray:
        at = np.array(places, np.int64)
        begin, count = self.begin[at], self.begin[at + 1] - self.begin[at]
        return self.flat[np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())]

    def digits(self, places: list[int]) -> str:
        return ",".join([self.shown[p] for p in places])

    def decode(self, lists: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids; long lists are decoded in pieces."""
        cuts = [(k, i, min(i + PIECE_TOKENS, len(ids))) for k, ids in enumerate(lists) for i in range(0, len(ids), PIECE_TOKENS)]
        out: list[list[bytes]] = [[] for _ in lists]
        group: list[tuple[int, int, int]] = []
        for n, cut in enumerate(cuts):
            group.append(cut)
            if n + 1 < len(cuts) and sum(b - a for _, a, b in group) < PIECE_TOKENS:
                continue
            offsets = pa.array(np.r_[0, np.cumsum([b - a for _, a, b in group])].astype(np.int32))
            ids = pa.array(np.concatenate([lists[k][a:b] for k, a, b in group]))
            self.db.register("pieces", pa.table({"piece": pa.array(range(len(group)), pa.int64()), "ids": pa.ListArray.from_arrays(offsets, ids)}))
            for (k, _, _), raw in zip(group, self.db.sql(DECODE).to_arrow_table().column("bytes").to_pylist(), strict=True):
                out[k].append(raw)
            self.db.unregister("pieces")
            group = []
        return [b"".join(parts) for parts in out]


def _slices(texts: Iterator[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= SLICE_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _over(docs: DataFrame, id_column: str, text: str, vocabulary: str, pattern: str, schema: str, columns: Callable[[Codec, list[str]], list[pa.Array]]) -> DataFrame:
    """Run ``columns`` over slices of texts, behind the id of each row."""
    docs = docs.select(F.col(id_column), whole(text).alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    names = [id_column, *(part.split()[0] for part in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in sliced(batches):
            codec = codec or Codec(ranks.value, pattern)
            done = 0
            for part in _slices(t.as_py() for t in batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(part)), *columns(codec, part)], names=names)
                done += len(part)

    return docs.mapInArrow(run, f"`{id_column}` {kind}, {schema}")


def encoded(docs: DataFrame, vocabulary: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids) of every row."""

    def columns(codec: Codec, texts: list[str]) -> list[pa.Array]:
        return [pa.array([codec.ids(p) for p in codec.encode(texts)], pa.list_(pa.int32()))]

    return _over(docs, id_column, text, vocabulary, pattern, "ids array<int>", columns)


def round_trip(docs: DataFrame, vocabulary: str, pattern: str, id_column: str = "doc_id", text: str = "text", bytes_too: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row; with ``bytes_too`` also ``decoded``."""

    def columns(codec: Codec, texts: list[str]) -> list[pa.Array]:
        places = codec.encode(texts)
        lists = [codec.ids(p) for p in places]
        raw = codec.decode(lists)
        out = [
            pa.array([len(x) for x in lists], pa.int64()),
            pa.array([hashlib.sha256(codec.digits(p).encode()).hexdigest() for p in places]),
            pa.array([hashlib.sha256(x).hexdigest() for x in raw]),
        ]
        return [*out, pa.array(raw, pa.binary())] if bytes_too else out

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", decoded binary" * bytes_too
    return _over(docs, id_column, text, vocabulary, pattern, schema, columns)
