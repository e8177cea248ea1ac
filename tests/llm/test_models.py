"""Suffix tree scores, source divergence and the prefix trie against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cataloom.llm import divergence, suffix_tree, trie
from cataloom.llm.suffix_tree import Settings

from .conftest import ODD

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def small(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def tokens(text):
    return [*BLANK.findall(small(text)), ""]


def brute_scores(rows, settings):
    """(text, train) -> (n_tokens, n_known, tokens, base, score) with dictionaries and recursion."""
    texts = [tokens(t) for t, _ in rows]
    counts = Counter(w for ws, (_, learn) in zip(texts, rows, strict=True) if learn for w in ws)
    n = sum(counts.values())
    support = max(settings.least, math.ceil(settings.share * math.sqrt(n)))
    scale = n + len(counts) + 1
    known = {w for w, c in counts.items() if c >= support}
    coded = [[w if w in known else None for w in ws] for ws in texts]
    grams = Counter()
    for ws, (_, learn) in zip(coded, rows, strict=True):
        if learn:
            grams.update(tuple(ws[i : i + k]) for k in range(1, settings.depth + 2) for i in range(len(ws) - k + 1))
    root = {w: (counts[w] + 1) / scale for w in known}
    root[None] = (scale - sum(counts[w] + 1 for w in known)) / scale
    followers = defaultdict(list)
    for g, c in grams.items():
        if len(g) > 1 and c >= support:
            followers[g[:-1]].append(g[-1])

    def own(s, w):
        if not s:
            return root[w]
        if len(followers[s]) == len(root):
            return grams[(*s, w)] / sum(grams[(*s, v)] for v in followers[s])
        return (grams[(*s, w)] - settings.discount) / grams[s]

    left, factor, kept = {}, {}, set()
    for s, ws in followers.items():
        left[s] = 1 - sum(own(s, w) for w in ws)
        factor[s] = 1.0 if len(ws) == len(root) else left[s] / (1 - sum(own(s[1:], w) for w in ws))
        divergence_ = sum(own(s, w) * math.log(own(s, w) / own(s[1:], w)) for w in ws) + left[s] * math.log(factor[s])
        if grams[s] * divergence_ >= (len(ws) + 1) / 2 * math.log(n):
            kept |= {s[i:] for i in range(len(s))}

    def chance(s, w):
        if not s:
            return root[w]
        return own(s, w) if w in followers[s] else factor[s] * chance(s[1:], w)

    out = []
    for ws, cs in zip(texts, coded, strict=True):
        score = 0.0
        for i, c in enumerate(cs):
            state = next((tuple(cs[j:i]) for j in range(max(0, i - settings.depth), i) if tuple(cs[j:i]) in kept), ())
            score += math.log10(chance(state, c))
            if c is None:
                score += math.log10((counts[ws[i]] + 1) / scale / root[None])
        out.append((len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / scale) for w in ws), score))
    return out, kept


def lm_rows():
    pick = random.Random(3)
    made = []
    for _ in range(120):
        words = []
        for _ in range(pick.randrange(60)):
            # The third last word tells the next one, the last one whether it is large.
            at = pick.choice(words[-3:-2] * 9 + ["a", "b", "cc"])
            words.append(at if pick.random() < 0.95 else f"rare{pick.randrange(60)}")
        made.append(pick.choice([" ", "\n", "\t ", "\x0b"]).join(words))
    return [(i, t, bool(pick.random() < 0.8)) for i, t in enumerate([t for _, t in ODD] + made)]


@pytest.mark.parametrize("depth", [1, 3])
def test_suffix_tree_scores(spark, depth):
    settings = Settings(depth=depth, share=0.1)
    rows = lm_rows()
    docs = spark.createDataFrame([(*r, 9.9) for r in rows], "doc_id long, text string, learn boolean, score double").repartition(3)
    got = {r["doc_id"]: r for r in suffix_tree.scored(docs, F.col("learn"), settings=settings).collect()}
    want, kept = brute_scores([(t, learn) for _, t, learn in rows], settings)
    assert len(got) == len(rows)
    assert max(map(len, kept)) == depth
    for i, (n, known, total, base, score) in enumerate(want):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] == pytest.approx(score, rel=1e-9)
    assert sum(w[4] for w in want) > sum(w[3] for w in want)


@pytest.mark.parametrize("least", [1, 2])
def test_suffix_tree_scores_with_little_support(spark, least):
    """Small corpora: one or two occurrences are the share that counts."""
    rows = lm_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean").repartition(3)
    want, _ = brute_scores([(t, learn) for _, t, learn in rows], Settings(share=0, least=least))
    settings = Settings(chance=(least - 0.5) / want[0][2])
    assert settings.support(want[0][2]) == least
    got = {r["doc_id"]: r["score"] for r in suffix_tree.scored(docs, F.col("learn"), settings=settings).collect()}
    assert [got[i] for i in range(len(rows))] == pytest.approx([w[4] for w in want], rel=1e-9)


def test_suffix_tree_support_does_not_depend_on_the_size(spark, monkeypatch):
    """A corpus that is repeated has the same words and contexts with support, each as often."""
    trees, weigh = [], suffix_tree.weigh
    monkeypatch.setattr(suffix_tree, "weigh", lambda tree, settings: (trees.append(tree), weigh(tree, settings)))
    docs = spark.createDataFrame(lm_rows(), "doc_id long, text string, learn boolean")
    settings = Settings(chance=0.002)
    for times in (1, 6):
        more = docs.crossJoin(spark.range(times).select(F.lit(1).alias("one"))).drop("one")
        assert suffix_tree.scored(more, F.col("learn"), settings=settings).count() == docs.count() * times
    small, large = trees
    assert large.tokens == 6 * small.tokens
    assert list(small.symbols) == list(large.symbols)
    assert len(small.keys) == len(large.keys) == 4
    for a, b, m, n in zip(small.keys, large.keys, small.counts, large.counts, strict=True):
        assert list(a) == list(b)
        assert [6 * c for c in m] == list(n)


def test_suffix_tree_chances_sum_to_one():
    """Behind any state the symbols' chances are a distribution."""
    pick = np.random.default_rng(1)
    symbols = pick.integers(0, 4, 4000)
    symbols[1::2] = (symbols[::2] + pick.integers(0, 2, 2000)) % 4
    counts = np.bincount(symbols, minlength=4).astype(np.int64)
    tree = suffix_tree.Tree(4000, 3, np.arange(1, 4), [counts])
    gram = symbols.astype(np.int64)
    for level in range(1, 3):
        size = len(tree.counts[-1])
        if level > 1:
            gram = suffix_tree.places(tree.keys[-1], len(tree.counts[-2]), gram, np.arange(4000) < level - 1)
        ok = (gram[1:] >= 0) & (gram[:-1] >= 0)
        keys, n = np.unique((gram[:-1] * size + gram[1:])[ok], return_counts=True)
        tree.keys.append(keys[n >= 30])
        tree.counts.append(n[n >= 30])
    suffix_tree.weigh(tree, Settings())
    assert tree.kept[0].any()
    for before in ([], [1], [2, 3], [0, 1, 2], [3, 3, 3]):
        total = sum(10 ** suffix_tree.token_scores(tree, np.array([*before, s]), np.array([len(before) + 1]))[-1] for s in range(4))
        assert total == pytest.approx(1)


def test_suffix_tree_odd_tables(spark, odd, empty):
    assert suffix_tree.scored(empty, F.lit(True)).collect() == []
    got = suffix_tree.scored(odd, F.lit(None).cast("boolean")).collect()
    assert len(got) == len(ODD)
    assert all(r["score"] == r["base_score"] == 0 and r["train_tokens"] == 0 for r in got)
    assert sum(r["doc_id"] is None for r in got) == 2


def test_tokenised_as_the_pattern_says():
    texts = ["", " a  B\x1cc ", "\x0b\x0c\x85Ä ä x\x00y\r\nÀZ", "\n"]
    words, ids, lengths = suffix_tree.tokenised(pa.array(texts))
    assert [[words[i].decode() for i in part] for part in np.split(ids, np.cumsum(lengths)[:-1])] == [tokens(t) for t in texts]


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute_audit(rows):
    grp, df, n = defaultdict(Counter), Counter(), Counter()
    for lang, source, text in [tuple(v or "" for v in r) for r in rows]:
        terms = Counter(small(t) for t in TERM.findall(text))
        grp[lang][source] += 0
        for t, c in terms.items():
            df[lang, t] += 1
            n[lang, source, t] += c
    out = set()
    for lang, sources in grp.items():
        kept = [t for (name, t), c in df.items() if name == lang and c >= 3]
        total = {s: sum(n[lang, s, t] for t in kept) for s in sources}
        every = sum(total.values())
        p = {(s, t): 1 + 10**9 * (n[lang, s, t] + 1) // (total[s] + len(kept)) for s in sources for t in kept}
        q = {t: 1 + 10**9 * (sum(n[lang, s, t] for s in sources) + 1) // (every + len(kept)) for t in kept}
        for s in sources:
            pairs = [(b, sum((p[s, t] - p[b, t]) ** 2 // p[b, t] for t in kept)) for b in sources if b != s]
            terms = [(t, (p[s, t] - q[t]) ** 2 // q[t]) for t in kept if n[lang, s, t] and p[s, t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found = sorted(found, key=lambda v: (-v[1], v[0].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found) if part == "pair" or i < 200}
    return out


def test_divergence(spark, monkeypatch):
    pick = random.Random(5)
    words = [f"w{'abcdefgh'[i % 8]}{'xyz'[i % 3] * (i // 8 + 1)}" for i in range(300)] + ["Ünï", "ÜNÏ", "中文", "É", "a", "A"]
    text = lambda k: " ".join(pick.choices(words, [1 / (i + 1) for i in range(len(words))], k=k)) + pick.choice(["", "!", "9\x00-"])
    rows = [(pick.choice(["de", "en", None]), pick.choice(["s1", "s2", "s3", None, "Z"]), text(pick.randrange(80))) for _ in range(150)]
    rows += [("en", pick.choice(["s1", "s2"]), "the same words here HERE") for _ in range(120)] + [("fr", "s1", "one source")] * 4
    rows += [("en", "none", None), ("en", "none", " 12 "), ("xx", "a", "only twice"), ("xx", "b", "only twice")]
    docs = spark.createDataFrame([(i, t, lang, source, "old", 1) for i, (lang, source, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, term string, n int").repartition(5)
    monkeypatch.setattr(divergence, "PAIR_ROWS", 37)
    got = [tuple(r) for r in divergence.audit(docs).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute_audit(rows)
    monkeypatch.setattr(divergence, "fits_broadcast", lambda frame: False)
    assert set(map(tuple, divergence.audit(docs).collect())) == brute_audit(rows)


def test_divergence_odd_tables(odd, empty):
    assert divergence.audit(empty).collect() == []
    want = brute_audit([("en", "s", t) for _, t in ODD])
    assert {tuple(r) for r in divergence.audit(odd).collect()} == want


def test_chance_beyond_64_bits():
    count = np.array([8_999_999_999, 9_000_000_000, 10**15])
    assert divergence.chance(count, 10**15, 7).tolist() == [1 + 10**9 * (int(c) + 1) // (10**15 + 7) for c in count]


def brute_trie(rows, group=5, heads=9):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    plain = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    made = {}
    for c, own in plain.items():
        h = zlib.crc32(str(c).encode()) % heads
        made[c] = plain.get(c - int(math.fmod(c, group)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(made[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def chats():
    pick = random.Random(7)
    rows = []
    for c in [*range(60), -1, -5, -13, 10**12, 5, 5]:
        for t in range(pick.randrange(14)):
            same = pick.random() < 0.7
            rows.append((c, pick.choice([t, t, t, None, 3]), pick.choice(["user", None]) if not same else "user", f"turn {t}" if same else pick.choice(["é中", "", None, "x" * 5000, f"{pick.random()}"])))
    rows += [(c, t, "user", f"shared {t}") for c in range(1000, 1040) for t in range(12)]
    rows += [(2000 + c, t, "user", f"shared {t}") for c in range(12) for t in range(c + 1)]
    return rows + [(None, 1, "user", "x"), (None, None, None, None)] + rows[:5]


SCHEMA = "conv_id long, turn long, role string, text string, seq string, n int, head int"


@pytest.mark.parametrize("container", [1, 4, 4096])
def test_prefix_trie(spark, container):
    rows = chats()
    turns = spark.createDataFrame([(*r, "old", 1, 2) for r in rows], SCHEMA).repartition(3)
    got = trie.prefix_trie(turns, container).collect()
    assert sorted(map(tuple, got), key=str) == brute_trie(rows)


def test_prefix_trie_of_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(none).collect() == []
    only = spark.createDataFrame([(None, 1, "user", "x", "", 1, 1)], SCHEMA)
    assert trie.prefix_trie(only).collect() == []
    one = spark.createDataFrame([(3, None, None, None, "", 1, 1)], SCHEMA)
    assert sorted(map(tuple, trie.prefix_trie(one).collect()), key=str) == brute_trie([(3, None, None, None)])
