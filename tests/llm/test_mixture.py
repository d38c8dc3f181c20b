import math
from collections import defaultdict
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from policy_mart.llm import mixture

from .frames import empty, messy, rows_of

DATA = "/root/testdata/sf0.01"


def targets_by_hand(sizes, weights=(1, 2, 3), most=3):
    """Share by weight, cap, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: weight[s] * left / sum(weight[f] for f in free) for s in free}
        over = [s for s in free if share[s] >= most * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: most * sizes[s] for s in over}


def offset_by_hand(source, seed=0):
    group = "1" if source is None else f"0{source}"
    return int(md5(f"{seed}:{group}".encode()).hexdigest()[:8], 16) / 2**32


def mix_by_hand(rows, seed=0):
    """(doc_id, text, source) -> copies, by one running sum over each source."""
    by_source = defaultdict(list)
    for doc, text, source in rows:
        by_source[source].append((len((text or "").split()), md5(str("" if doc is None else doc).encode()).hexdigest(), doc))
    targets = targets_by_hand({s: sum(x[0] for x in v) for s, v in by_source.items()})
    out = []
    for source, docs in by_source.items():
        size = sum(x[0] for x in docs)
        rate = targets[source] / size if size else 0
        offset = offset_by_hand(source, seed)
        for i, (n, _, doc) in enumerate(sorted(docs, key=lambda x: x[:2])):
            out.append((doc, n, math.floor((i + 1) * rate + offset) - math.floor(i * rate + offset)))
    return out, targets


def test_against_a_running_sum(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "source")
    rows = [tuple(r) for r in docs.collect()]
    for seed in (0, 5):
        got = rows_of(mixture.mix_sources(docs, seed=seed), "doc_id", "size", "copies")
        expected, targets = mix_by_hand(rows, seed)
        assert got == sorted(expected, key=repr)
    by_source = {r["source"]: r["t"] for r in mixture.mix_sources(docs).groupBy("source").agg(F.first("target").alias("t")).collect()}
    assert by_source == pytest.approx(targets)


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000, "c": 10}, {"a": 0, None: 5}, {"a": 7}, {"a": 0}, {"b": 5, "a": 5, "c": 1, "d": 900, None: 3}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "s string, n long")
    got = {r["s"]: r["target"] for r in mixture.source_targets(frame, "s", "n").collect()}
    assert got == pytest.approx(targets_by_hand(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0))


def test_taken_is_near_target_with_a_hot_source(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("s"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)).alias("source"),
        F.expr("repeat('w ', cast(1 + id * 7919 % 300 as int))").alias("text"),
    )
    got = mixture.mix_sources(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most"))
    for r in got.collect():
        assert r["taken"] == pytest.approx(r["target"], rel=0.02, abs=300) and r["most"] <= 3


def test_offsets_are_random(spark):
    """Offsets fill [0, 1) evenly over sources and over seeds, and a document's copies average to what it expects."""
    drawn = spark.range(2000).select(F.concat(F.lit("0s"), F.col("id").cast("string")).alias("g"))
    offsets = [r["o"] for r in drawn.select(mixture.random_offset(F.col("g"), 7).alias("o")).collect()]
    assert len(set(offsets)) > 1990 and min(offsets) >= 0 and max(offsets) < 1
    assert [sum(k / 4 <= o < (k + 1) / 4 for o in offsets) for k in range(4)] == pytest.approx([500] * 4, abs=90)
    rows = [(i, "w " * 5, "a") for i in range(3)] + [(9, "w " * 12, "b")]
    totals = defaultdict(int)
    for seed in range(400):
        mixed, targets = mix_by_hand(rows, seed)
        for doc, _, copies in mixed:
            totals[doc] += copies
    for doc, _, source in rows:
        assert totals[doc] / 400 == pytest.approx(targets[source] / (15 if source == "a" else 12), abs=0.12)


def test_messy_rows(spark):
    docs = messy(spark)
    mixed = mixture.mix_sources(docs)
    assert mixed.count() == docs.count()
    assert rows_of(mixed, "doc_id", "size", "taken", "`a.b`") == rows_of(mixture.mix_sources(docs.repartition(5)), "doc_id", "size", "taken", "`a.b`")
    assert mixed.filter("text is null and size <> 0").isEmpty()
    copies = mixture.repeated(mixed, docs.columns)
    assert copies.columns == docs.columns and copies.count() == mixed.agg(F.sum("copies")).first()[0]
    assert mixture.mix_sources(empty(spark)).isEmpty()
