import itertools
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from policy_mart.llm import packing

from .frames import empty, messy, rows_of

DATA = "/root/testdata/sf0.01"


def padding(lengths, counts, ends):
    return sum((next(e for e in ends if e >= n) - n) * c for n, c in zip(lengths, counts, strict=True))


@pytest.mark.parametrize("seed", range(12))
def test_boundaries_against_all_choices(seed):
    r = random.Random(seed)
    lengths = sorted(r.sample(range(200), r.randrange(1, 10)))
    counts = [r.randrange(1, 50) for _ in lengths]
    for buckets in (1, 2, 3, 4):
        best = min(
            padding(lengths, counts, [*inner, lengths[-1]])
            for k in range(buckets)
            for inner in itertools.combinations(lengths[:-1], min(k, len(lengths) - 1))
        )
        found = packing.best_boundaries(lengths, counts, buckets)
        assert len(found) <= buckets and found[-1] == lengths[-1] and padding(lengths, counts, found) == best


def test_boundaries_of_nothing():
    assert packing.best_boundaries([], [], 4) == []


def test_rounded_lengths(spark):
    n = [0, 1, 4095, 4096, 4097, 8191, 8193, 123_457, 2**40 + 1]
    frame = spark.createDataFrame([(x,) for x in n], "n long").select("n", packing.rounded(F.col("n")).alias("r"))
    for r in frame.collect():
        assert r["r"] >= r["n"] and (r["r"] == r["n"] if r["n"] <= 4096 else r["r"] <= r["n"] * (1 + 2**-11))


def check(rows, budget):
    batches = defaultdict(list)
    for r in rows:
        assert 0 <= r["length"] <= r["boundary"] and r["padding"] == r["boundary"] - r["length"]
        batches[r["bucket"], r["batch"]].append(r)
    last = {b: max(k[1] for k in batches if k[0] == b) for b, _ in batches}
    for (bucket, batch), held in batches.items():
        full = max(1, budget // max(held[0]["boundary"], 1))
        assert sorted(h["place"] for h in held) == list(range(len(held)))
        assert len(held) == full or (batch == last[bucket] and len(held) < full)
    for b, n in last.items():
        assert sorted(k[1] for k in batches if k[0] == b) == list(range(n + 1))


def test_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    rows = packing.pack(docs, buckets=6, budget=4000).collect()
    check(rows, 4000)
    histogram = Counter(len(r["text"].split()) for r in docs.collect())
    lengths = sorted(histogram)
    ends = packing.best_boundaries(lengths, [histogram[n] for n in lengths], 6)
    assert sorted({r["boundary"] for r in rows}) == ends
    assert sum(r["padding"] for r in rows) == padding(lengths, [histogram[n] for n in lengths], ends)


def test_given_lengths(spark):
    docs = spark.createDataFrame([(i, "x", i % 7) for i in range(50)] + [(99, "x", None)], "doc_id long, text string, tokens long")
    check(packing.pack(docs, length="tokens", buckets=3, budget=10).collect(), 10)


def test_messy_rows(spark):
    docs = messy(spark)
    got = packing.pack(docs, buckets=4, budget=100)
    check(got.collect(), 100)
    assert got.count() == docs.count()
    again = packing.pack(docs.repartition(7), buckets=4, budget=100)
    assert rows_of(got, "doc_id", "bucket", "batch", "place", "`a.b`") == rows_of(again, "doc_id", "bucket", "batch", "place", "`a.b`")
    assert packing.pack(empty(spark)).isEmpty()
