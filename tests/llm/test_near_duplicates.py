import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from policy_mart.llm import near_duplicates as nd
from policy_mart.llm._graph import components
from policy_mart.llm._text import shingles, word_hashes
from policy_mart.llm._work import Shelf

from .frames import empty, messy, words

DATA = "/root/testdata/sf0.01"


def shingles_by_hand(text, width=5):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return Counter(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else Counter()


def weighted(text):
    return {x: 1 + math.log(n) for x, n in shingles_by_hand(text).items()}


def similarity_by_hand(a, b):
    a, b = defaultdict(float, a), defaultdict(float, b)
    common, union = a.keys() & b.keys(), a.keys() | b.keys()
    if not common:
        return 0.0, 0.0
    return sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in union) for i in common), len(common) / len(union)


def classes_by_hand(rows, threshold=0.8):
    """The smallest key of each row's component, comparing every pair that shares a shingle."""
    texts = sorted({t for _, t in rows if t})
    sets = [weighted(t) for t in texts]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = Counter((a, b) for own in holders.values() for k, b in enumerate(own) for a in own[:k])
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (a, b), n in shared.items():
        if n >= 0.5 * max(len(sets[a]), len(sets[b])) * threshold and max(similarity_by_hand(sets[a], sets[b])) >= threshold:
            parent[find(a)] = find(b)
    keys = defaultdict(list)
    at = {t: i for i, t in enumerate(texts)}
    for key, t in rows:
        if t:
            keys[find(at[t])].append(key)
    least = {c: min((k for k in v if k is not None), default=None) for c, v in keys.items()}
    return [(key, least[find(at[t])] if t else key) for key, t in rows]


def test_words_and_shingles():
    texts = ["A b, c d-e f", None, "", "one two", "A B C d e f", "ünï 😀 wörd", "x " * 30]
    hashes, owner, count = shingles(texts)
    for i, t in enumerate(texts):
        assert sorted(count[owner == i].tolist()) == sorted(shingles_by_hand(t).values())
    assert set(hashes[owner == 0]) == set(hashes[owner == 4])
    w, o = word_hashes(["same same other", "same"])
    assert w[0] == w[1] == w[3] != w[2] and o.tolist() == [0, 0, 0, 1]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 12), st.integers(1, 6), min_size=1), st.dictionaries(st.integers(0, 12), st.integers(1, 6), min_size=1))
def test_similarity(a, b):
    arrays = [(np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
    assert nd.similarity(*arrays) == pytest.approx(similarity_by_hand(Counter(a), Counter(b)))


def test_signatures_estimate_probability_jaccard():
    r = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.8):
        common = r.integers(0, 2**63, 200, dtype=np.uint64)
        own = r.integers(0, 2**63, (2, int(200 * (1 - share) / share)), dtype=np.uint64)
        sets = [np.unique(np.concatenate([common, o])) for o in own]
        weights = [r.integers(1, 5, len(s)) for s in sets]
        sig = nd.signatures(np.concatenate(sets), np.repeat([0, 1], [len(s) for s in sets]), np.concatenate(weights), 2, 4000)
        expected, _ = nd.similarity((sets[0], weights[0]), (sets[1], weights[1]))
        assert (sig[0] == sig[1]).mean() == pytest.approx(expected, abs=0.03)
        assert (sig != 0).all()


def test_documents_against_all_pairs(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    got = {r["doc_id"]: r for r in nd.near_duplicates(docs).collect()}
    rows = [tuple(r) for r in docs.collect()]
    assert {k: r["class_id"] for k, r in got.items()} == dict(classes_by_hand(rows))
    sizes = Counter(r["class_id"] for r in got.values())
    assert all(r["class_rows"] == sizes[r["class_id"]] and r["kept"] == (k == r["class_id"]) for k, r in got.items())
    assert nd.one_of_each(docs).count() == len(sizes)


def test_a_large_group_and_chains(spark):
    r = random.Random(5)
    base = words(1, 60).split()
    rows = []
    for i in range(120):  # near copies: a word changed each
        own = base.copy()
        own[r.randrange(60)] = f"changed{i}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, words(2, 40)) for i in range(150)]
    chain = words(3, 200).split()
    rows += [(2000 + i, " ".join(chain[i * 8 : i * 8 + 100])) for i in range(10)]
    rows += [(3000 + i, words(50 + i, 30)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = nd.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == dict(classes_by_hand(rows))


def test_components(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(links, "a long, b long"), Shelf(spark, "t")).collect()}
    parent = {n: n for link in links for n in link}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {n: find(n) for a, b in links if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long"), Shelf(spark, "t")).isEmpty()


def test_messy_rows(spark):
    docs = messy(spark)
    found = nd.near_duplicates(docs)
    got = found.collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == Counter(classes_by_hand(rows))
    kept = nd.one_of_each(docs).collect()
    assert Counter(r["doc_id"] for r in kept)[1] == 1 and not any(r["doc_id"] == 105 for r in kept)
    assert sum(not r["text"] for r in kept) == 3  # nulls and empty texts stay
    assert nd.near_duplicates(empty(spark)).isEmpty() and nd.one_of_each(empty(spark)).isEmpty()
