"""Quality rules, encoding, classifier, licenses: against brute force, a library, held-out rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from cataloom.llm import bpe, classifier, licenses, quality, queries

from .conftest import ODD


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated))


def test_quality_counts(spark, documents):
    pick = random.Random(1)
    made = [" ".join(pick.choice("a b c\n d# é|".split(" ")) for _ in range(pick.randrange(60))) for _ in range(200)]
    made += ["one two three four five six seven eight nine ten\x1cx\x85y " * 3, "a\rb\x0bc\x0cd\n\n \n"]
    texts = made + [t for _, t in ODD] + [r["text"] for r in documents.collect()]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.judge(rows).collect():
        want = brute_quality(texts[r["doc_id"]])
        assert tuple(r[c] for c in quality.COUNTS) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_compression_bands(spark):
    pick = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    vocabulary = ["".join(pick.choice("etaoinshrdlu") for _ in range(pick.randrange(2, 9))) for _ in range(800)]
    prose = " ".join(pick.choice(vocabulary) for _ in range(3000))
    noise = " ".join(chr(pick.randrange(0x4E00, 0x9FA5)) + "".join(map(chr, pick.choices(range(0x100, 0x2FFF), k=20))) for _ in range(500))
    loop = " ".join(f"{w} {w}{w}" for w in ["lorem"] * 2000)
    mixed = prose + " " + " ".join(f"row{i % 7}" for i in range(4000))
    assert letters
    rows = spark.createDataFrame([(0, prose), (1, noise), (2, loop), (3, mixed)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in quality.judge(rows).collect()}
    packed = zstandard.ZstdCompressor(level=3).compress(prose.encode())
    assert got[0]["kept"] and got[0]["ratio"] == len(prose.encode()) / len(packed)
    assert not any(got[i]["kept"] for i in (1, 2, 3))
    assert not got[1]["base_failed"]  # the band rejects it
    assert [r["doc_id"] for r in quality.keep(rows).collect()] == [0]


def test_quality_odd_rows(odd, empty):
    got = quality.judge(odd)
    assert got.count() == len(ODD) and quality.judge(empty).count() == 0
    assert not got.filter("doc_id in (1, 2, 3, 4)").filter("kept or not base_failed").count()
    kept = quality.keep(odd)
    assert kept.schema == odd.schema and quality.keep(empty).count() == 0
    assert kept.count() == got.filter("kept").count()


def tiktoken_encoding():
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = queries.vocabulary()
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def test_bpe_is_that_of_the_library(spark, documents):
    own = tiktoken_encoding()
    pick = random.Random(3)
    pieces = ["the", "aaaa", "ab", " ", "  ", "\n", "é", "😀", "'s", "12345", "<|endoftext|>", "‍", "zzzzzzzz", "ing", "#*", "\x00"]
    made = ["".join(pick.choice(pieces) for _ in range(pick.randrange(40))) for _ in range(300)]
    texts = made + [t or "" for _, t in ODD] + ["a" * 3000, "word " * 300000] + [r["text"] for r in documents.collect()]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = bpe.round_trip(rows, *queries.vocabulary(), bytes_too=True).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = own.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded"] == texts[r["doc_id"]].encode()
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"]).hexdigest()
    some = bpe.encoded(rows.filter("doc_id < 20"), *queries.vocabulary()).collect()
    assert all(r["ids"] == own.encode_ordinary(texts[r["doc_id"]]) for r in some)


def test_bpe_forgets_words_without_a_change(monkeypatch):
    path, pattern = queries.vocabulary()
    codec = bpe.Codec(bpe.read_ranks(path), pattern)
    own = tiktoken_encoding()
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 5)
    monkeypatch.setattr(bpe, "SLICE_COST", 1200)
    monkeypatch.setattr(bpe, "PIECE_TOKENS", 4)
    for text in ["some words of a text, some more", "other wordings entirely", "some words of a text", ""]:
        ids = codec.ids(codec.encode([text])[0])
        assert ids.tolist() == own.encode_ordinary(text)
        assert codec.decode([ids, ids[:1]]) == [text.encode(), own.decode_bytes(ids[:1].tolist())]


def test_bpe_of_long_words(monkeypatch):
    path, pattern = queries.vocabulary()
    codec = bpe.Codec(bpe.read_ranks(path), pattern)
    own = tiktoken_encoding()
    pick = random.Random(7)
    drawn = ["".join(pick.choice(letters) for _ in range(700)) for letters in ("ab", "the", "etaoinshrdlu", "中文字é")]
    texts = ["a" * 513, "=" * 3000, " " * 3000, "é" * 600, *drawn, " ".join(drawn), " ".join(w[:500] for w in drawn)]
    for text, places in zip(texts, codec.encode(texts), strict=True):
        assert codec.ids(places).tolist() == own.encode_ordinary(text)
    million = codec.ids(codec.encode(["x" * 1_000_000])[0])
    assert len(million) == 500_000 and codec.decode([million]) == [b"x" * 1_000_000]
    # The long form gives what the short form gives, also where a contraction makes a pair of a lower rank.
    monkeypatch.setattr(bpe, "LONG_WORD", 0)
    codec.forget()
    short = ["".join(pick.choice("abcdeionrst") for _ in range(pick.randrange(2, 30))) for _ in range(60)]
    for text, places in zip(short, codec.encode(short), strict=True):
        assert codec.ids(places).tolist() == own.encode_ordinary(text)


def test_bpe_odd_rows(odd, empty):
    got = bpe.round_trip(odd, *queries.vocabulary())
    assert got.filter("n_tokens = 0").count() == 3 and bpe.round_trip(empty, *queries.vocabulary()).count() == 0


def test_classifier_on_held_out_rows(spark, documents):
    folder = "/root/testdata/sf0.01"
    got = queries.op5_quality_classifier(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = got.join(labels, "doc_id").filter("held_out").collect()
    right = {y: [r["predicted"] == y for r in rows if r["quality"] == y] for y in (0, 1)}
    assert all(np.mean(right[y]) > 0.8 for y in (0, 1)), {y: np.mean(v) for y, v in right.items()}
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got.collect())


def test_classifier_votes_are_those_of_all_neighbours():
    pick = np.random.default_rng(5)
    settings = classifier.Settings(neighbours=3, dims=16, rank=4)
    counts = pick.random((30, 16 + classifier.BUILD_TERMS * classifier.BUILD_BINS)).astype(np.float32)
    weights = np.ones(counts.shape[1], np.float32)
    model = classifier.Model(weights, classifier._axes(counts, settings), np.empty((0, 4)), (np.arange(30) % 3 == 0).astype(float), 1 / 3)
    model.vectors = model.project(counts)
    for row, score in zip(counts, model.scores(counts, settings), strict=True):
        latent = model.project(row[None])[0]
        near = sorted(range(30), key=lambda i: -float(model.vectors[i] @ latent))[:3]
        votes = [max(0.0, min(1.0, float(model.vectors[i] @ latent))) ** settings.sharpness for i in near]
        assert abs(score - sum(v * model.labels[i] for v, i in zip(votes, near, strict=True)) / sum(votes)) < 1e-5


def test_classifier_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(6, 1), (6, 0), (7, 1), (4, 0), (None, 1), (5, None), (9, 0), (9, 0)], "doc_id long, quality int")
    model = classifier.train(odd, labels)
    assert len(model.labels) == 3  # 7, 4 and 9: 6 contradicts itself
    got = classifier.scored(odd, model).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in got if r["doc_id"] in (1, 2)} == {model.prior}
    assert classifier.scored(empty, model).count() == 0
    nothing = classifier.train(odd, labels.filter("false"))
    assert {r["score"] for r in classifier.scored(odd, nothing).collect()} == {0.5}


def brute_licenses(text, templates, threshold):
    words = licenses.words_of(text)
    grams = list(zip(words, words[1:], strict=False))
    found = []
    for name, template in templates.items():
        w = licenses.words_of(template)
        wanted = Counter(zip(w, w[1:], strict=False))
        for a in range(len(grams)):
            for b in range(a + 1, len(grams) + 1):
                dice = 2 * (Counter(grams[a:b]) & wanted).total() / (b - a + wanted.total())
                if wanted and dice >= threshold:
                    found.append((-dice, -(b - a), name, a, b + 1))
    out, taken = [], []
    for one in sorted(found):
        if all(one[4] <= a or b <= one[3] for a, b in taken):
            taken.append((one[3], one[4]))
            out.append((one[2], one[3], one[4] - one[3], round(-one[0], 9)))
    return sorted(out, key=lambda x: x[1])


def test_licenses_are_those_of_all_passages(spark):
    templates = {k: v for k, v in licenses.TEMPLATES.items() if len(v) < 100} | {"none": "word", "empty": "", "twice": "a b a b a c"}
    pick = random.Random(4)
    parts = [v.split() for v in templates.values() if v]
    texts = []
    for _ in range(120):
        words = []
        for _ in range(pick.randrange(1, 4)):
            words += pick.choices(["a", "b", "the", "under", "license", "work"], k=pick.randrange(5))
            part = [w for w in pick.choice(parts) if pick.random() > 0.08]
            words += part
        texts.append(" ".join(words))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got: dict = {}
    for r in licenses.scanned(rows, templates=templates).collect():
        got.setdefault(r["doc_id"], []).append((r["license"], r["first_word"], r["n_words"], round(r["dice"], 9)))
    for i, text in enumerate(texts):
        want = brute_licenses(text, templates, licenses.THRESHOLD)
        assert sorted(got.get(i, []), key=lambda x: x[1]) == want, text
    assert len(got) > 60


def test_repeated_licenses_in_one_text():
    """A file of many notices, whole and cut at their ends, costs its length; each notice is found once."""
    scanner = licenses.Scanner(licenses.TEMPLATES)
    names = ["bsd-3-clause", "mit", "bsd-2-clause"]
    text = "\n".join(licenses.TEMPLATES[names[i % 3]] for i in range(200))
    found = scanner.scan(text)
    assert [f.template for f in found] == [names[i % 3] for i in range(200)] and all(f.dice == 1 for f in found)
    million = scanner.scan("\n".join([licenses.TEMPLATES["bsd-3-clause"]] * 700))
    assert [(f.template, f.dice) for f in million] == [("bsd-3-clause", 1.0)] * 700


def test_overlapping_passages_give_way_to_better_ones():
    """Passages that run into a better one are cut before it, as when all passages are compared."""
    pick = random.Random(11)
    for _ in range(150):
        templates = {n: " ".join(pick.choices("abc", k=pick.randrange(3, 9))) for n in ("one", "two", "three")}
        text = " ".join(pick.choices("abcd", k=60))
        got = [(f.template, f.begin, f.end - f.begin, round(f.dice, 9)) for f in licenses.Scanner(templates, 0.6).scan(text)]
        assert sorted(got) == sorted(brute_licenses(text, templates, 0.6)), (text, templates)


def test_licenses_odd_rows(spark, odd, empty):
    assert licenses.scanned(odd).count() == 0 and licenses.scanned(empty).count() == 0
    long_ = "foo bar. " * 2000 + licenses.TEMPLATES["mit"].replace(" ", "\n") + " the software is" * 2000
    rows = spark.createDataFrame([(1, long_), (1, long_), (None, "released UNDER the MIT-license")], "doc_id long, text string")
    got = licenses.scanned(rows).collect()
    assert Counter(r["license"] for r in got) == {"mit": 2, "mit-notice": 1}
    assert licenses.scanned(rows, templates={}).count() == 0
    assert F.col("doc_id") is not None


SIBLINGS = {
    "gpl-2.0-header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program",
    "agpl-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3",
    "lgpl-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3",
    "cc-by-nc-4.0-sentence": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
}


def test_sibling_licenses_get_their_own_names(spark):
    texts = [*licenses.TEMPLATES.items(), *SIBLINGS.items()]
    for name in ("bsd-2-clause", "bsd-3-clause", "unlicense"):
        assert "is provided" in licenses.TEMPLATES[name].lower()
    rows = spark.createDataFrame([(i, f"some words before. {t} and words behind") for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["license"], round(r["dice"], 9)) for r in licenses.scanned(rows).collect())
    assert [g[:2] for g in got] == [(i, name) for i, (name, _) in enumerate(texts)]
    assert all(g[2] == 1 for g in got[: len(licenses.TEMPLATES)])
