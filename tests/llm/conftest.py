import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

pytest.importorskip("cataloom.llm")

# Odd rows that every operator has to take: null, empty and long texts, ties, repeated rows, null ids.
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "a"),
    (5, "éà ü " * 4000),
    (6, "same text here for two rows"),
    (6, "same text here for two rows"),
    (7, "same text here for two rows"),
    (None, "a row without an id"),
    (None, None),
    (8, "x" * 30000),
    (9, "7" * 5000 + " " + "ab." * 5000 + "@" * 500),
    (6, "another text of the same id"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with further columns whose names clash with results."""
    rows = [(i, t, "en", "s", 1.5, True, "old", 0) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double, kept boolean, fingerprint string, n_words int")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def documents(spark):
    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("no tables")
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
