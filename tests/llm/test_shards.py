from collections import Counter, defaultdict
from hashlib import md5

from pyspark.sql import functions as F

from policy_mart.llm import shards

from .frames import empty, messy, rows_of

DATA = "/root/testdata/sf0.01"


def position(key):
    return int(md5(key.encode()).hexdigest()[:15], 16)


def by_hand(keys, n, vnodes):
    """The ring, walked key by key."""
    points = sorted((position(f"{s}:{v}"), s) for s in range(n) for v in range(vnodes))
    home = defaultdict(list)  # keys by arc, in ring order
    for k in keys:
        p = position(k)
        home[next((i for i, (q, _) in enumerate(points) if q >= p), 0)].append((p, k))
    cap = [len(keys) // n + (s < len(keys) % n) for s in range(n)]
    where, waiting, taken = {}, [], [0] * n
    late = defaultdict(list)
    for arc, (_, s) in enumerate(points):
        for _, k in sorted(home[arc]):
            if taken[s] < cap[s]:
                where[k], taken[s] = s, taken[s] + 1
            else:
                late[arc].append(k)
    for lap in range(2):
        for arc, (_, s) in enumerate(points):
            if lap == 0:
                waiting += late[arc]
            while waiting and taken[s] < cap[s]:
                where[waiting.pop(0)] = s
                taken[s] += 1
    return where


def test_against_a_walk(spark):
    keys = [str(i) for i in range(700)]
    docs = spark.createDataFrame([(int(k), "t") for k in keys], "doc_id long, text string")
    got = {str(r["doc_id"]): r["shard"] for r in shards.assign_shards(docs, 11, 8).collect()}
    assert got == by_hand(keys, 11, 8)


def test_equal_counts_and_gapless_slots(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    for n in (40, 7, 1, 1500):
        got = shards.assign_shards(docs, n).select("shard", "slot").collect()
        per = defaultdict(list)
        for r in got:
            per[r["shard"]].append(r["slot"])
        sizes = [len(per[s]) for s in range(n)]
        assert max(sizes) - min(sizes) <= 1 and len(got) == docs.count()
        assert all(sorted(v) == list(range(len(v))) for v in per.values())


def test_one_more_shard_moves_little(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    a = {r["doc_id"]: r["shard"] for r in shards.assign_shards(docs, 40).collect()}
    b = {r["doc_id"]: r["shard"] for r in shards.assign_shards(docs, 41).collect()}
    moved = Counter(a[k] != b[k] for k in a)[True] / len(a)
    assert 1 / 41 <= moved < 0.12


def test_messy_rows(spark):
    docs = messy(spark)
    got = shards.assign_shards(docs, 5)
    assert got.count() == docs.count()
    assert sorted(Counter(r["shard"] for r in got.collect()).values()) in ([4, 5, 5, 5, 5], [5, 5, 5, 5, 5], [4, 4, 5, 5, 5], [4, 4, 4, 5, 5], [4, 4, 4, 4, 5])
    again = shards.assign_shards(docs.repartition(7), 5)
    assert rows_of(got, "doc_id", "shard") == rows_of(again, "doc_id", "shard")
    assert shards.assign_shards(empty(spark), 5).isEmpty()
