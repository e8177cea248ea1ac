"""Quality rules: compression bands.

A document is compressed with zstandard as a whole and in fixed chunks.  Text that shrinks far more
than prose does is repetitive, text that hardly shrinks is noise; the limits depend on the length,
because short texts shrink little and long ones much.  A word-count and a repetition rule stand
before the bands.

Null texts are empty texts; an empty text has no words and fails.  A row is judged by its text alone,
so repeated rows, null or repeated ids and further columns change nothing; an empty table gives an
empty table.  Texts of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, whole

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
WINDOW = 8


@dataclass(frozen=True)
class Bands:
    """Limits of raw bytes per compressed byte.

    ``limits`` holds (smallest length in bytes, lowest ratio, highest ratio), rising by length.
    Chunks have the limits of their own length; their highest ratio is ``chunk_slack`` times higher,
    so that one table or list inside good text does not reject it.
    """

    limits: Sequence[tuple[int, float, float]] = (
        (0, 0.0, 2.0),
        (256, 1.10, 2.3),
        (512, 1.15, 2.5),
        (1024, 1.25, 2.7),
        (2048, 1.30, 3.0),
        (4096, 1.35, 3.3),
        (16384, 1.40, 3.8),
        (65536, 1.40, 4.5),
    )
    chunk: int = 4096
    chunk_slack: float = 1.5
    level: int = 3
    min_words: int = 20
    max_repeat_percent: int = 30

    def limit(self, size: int) -> tuple[float, float]:
        found = (0.0, float("inf"))
        for least, low, high in self.limits:
            if size >= least:
                found = (low, high)
        return found


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = ("ratio", "chunk_low", "chunk_high")
RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, chunk_low double, chunk_high double, base_failed boolean, kept boolean"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Number of words inside windows of ``window`` words that stand in the text twice or more.

    Windows are numbered by doubling: pairs of words, pairs of pairs, ... so equal numbers mean
    equal windows.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    rank = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    width = 1
    while width < window:
        pairs = rank[:-width] * (int(rank.max()) + 1) + rank[width:]
        rank = np.unique(pairs, return_inverse=True)[1]
        width *= 2
    twice = np.bincount(rank)[rank] > 1
    marks = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + window, -1)
    return int((np.cumsum(marks)[:-1] > 0).sum())


def measured(text: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple:
    """The columns of ``RESULT`` for one text in UTF-8."""
    words = text.split()  # of bytes: splits at space and \t \n \v \f \r only
    raw = np.frombuffer(text, np.uint8)
    points = int(((raw & 0xC0) != 0x80).sum())
    kinds = np.bincount(raw, minlength=256)
    lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
    n_repeat = repeated_words(words)
    ratios = [
        (len(piece), len(piece) / len(packer.compress(piece)))
        for piece in (text[i : i + bands.chunk] for i in range(0, len(text), bands.chunk))
    ]
    ratio = len(text) / len(packer.compress(text)) if text else 0.0
    failed = len(words) < bands.min_words or 100 * n_repeat > bands.max_repeat_percent * len(words)
    low, high = bands.limit(len(text))
    kept = not failed and low <= ratio <= high
    for size, value in ratios:
        low, high = bands.limit(size)
        kept = kept and low <= value <= high * bands.chunk_slack
    values = [value for _, value in ratios]
    return (
        len(words),
        points - int(kinds[list(BLANKS)].sum()),
        int(kinds[list(SYMBOLS)].sum()),
        len(lines) - len(set(lines)),
        n_repeat,
        ratio,
        min(values, default=0.0),
        max(values, default=0.0),
        failed,
        kept,
    )


def judge(docs: DataFrame, id_column: str = "doc_id", text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """One row per document: the id, the counts, the ratios, ``base_failed`` and ``kept``."""
    docs = docs.select(F.col(id_column), whole(text).cast("binary").alias("text"))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in sliced(batches):
            rows = [measured(t.as_py(), bands, packer) for t in batch.column(1)]
            columns = [pa.array(c) for c in zip(*rows, strict=True)]
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    names = [id_column, *COUNTS, *RATIOS, "base_failed", "kept"]
    return docs.mapInArrow(run, f"`{id_column}` {kind}, {RESULT}")


def keep(docs: DataFrame, text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` whose text passes, with all their columns."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=bands.level)
        for batch in sliced(batches):
            texts = batch.column(at).cast(pa.binary())
            yield batch.filter(pa.array([measured(t.as_py() or b"", bands, packer)[-1] for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
