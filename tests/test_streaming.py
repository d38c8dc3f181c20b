import datetime as dt
import functools
import random
import re

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from policy_mart.functions.dates import yyyymm
from policy_mart.functions.numbers import money_state, money_sum
from policy_mart.operators.rollup import additive_rollup, claims_rollup, finished, merge_states, rollup_states
from policy_mart.streaming import maintain

D = dt.date
SCHEMA = "k bigint, d date, v double, g string"
FILES = [
    [(1, D(2025, 1, 3), 1.5, "a"), (2, D(2025, 1, 4), 2.0, "b")],
    [(3, D(2025, 2, 3), 4.0, "a"), (1, D(2025, 1, 3), 1.5, "a")],  # key 1 again
    [(4, D(2025, 1, 9), 8.0, "a"), (4, D(2025, 1, 9), 9.0, "a")],  # late, and twice in a batch
]


@pytest.fixture
def stream(spark, tmp_path):
    """One file per batch; `add` lands another file."""
    folder = str(tmp_path / "in")

    def add(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)

    def read():
        return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)

    return add, read


def test_rollup_follows_the_stream(spark, stream, tmp_path):
    add, read = stream
    path, check = str(tmp_path / "t"), str(tmp_path / "c")

    def run():
        maintain.stream_rollup(read(), path, check, "d", "month", ["g"], {"v": "v"}, "n").awaitTermination()
        return sorted(map(tuple, maintain.rollup_so_far(spark, path, ["month", "g"], ["v"], ["n"]).collect()))

    add(FILES[0])
    add(FILES[1])
    run()
    add(FILES[2])
    streamed = run()
    everything = spark.createDataFrame(sum(FILES, []), SCHEMA)
    batch = additive_rollup(everything, "d", "month", ["g"], ["v"], extra={"n": F.count(F.lit(1))})
    assert streamed == sorted(map(tuple, batch.collect()))
    assert run() == streamed  # nothing new arrived

    folded = str(tmp_path / "folded")
    maintain.fold_rollup(spark, path, folded, ["month", "g"], ["v"], ["n"])
    again = maintain.rollup_so_far(spark, folded, ["month", "g"], ["v"], ["n"])
    assert sorted(map(tuple, again.collect())) == streamed
    assert len(list((tmp_path / "folded").glob("batch=*"))) == 2


def test_a_repeated_batch_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1.0)], "g string, v double")
    part = rows.groupBy("g").agg(money_state("v").alias("v"), F.count(F.lit(1)).alias("n"))
    for _ in range(2):
        maintain._write_batch(part, path, 0)
    maintain._write_batch(part, path, 1)
    assert [tuple(r) for r in maintain.rollup_so_far(spark, path, ["g"], ["v"], ["n"]).collect()] == [("a", 2.0, 2)]


def test_current_rows_follow_the_stream(spark, stream, tmp_path):
    add, read = stream
    path, check = str(tmp_path / "t"), str(tmp_path / "c")
    for rows in FILES:
        add(rows)
        maintain.stream_current(read(), path, check, ["g"], ["d", "v"]).awaitTermination()
    got = maintain.current_so_far(spark, path, ["g"], ["d", "v"])
    assert sorted((r.g, r.k) for r in got.collect()) == [("a", 3), ("b", 2)]


def test_append_keeps_rows_without_a_key(spark, stream, tmp_path):
    add, read = stream
    path, check = str(tmp_path / "t"), str(tmp_path / "c")
    add([(None, D(2025, 1, 3), 1.0, "a"), (None, D(2025, 1, 3), 1.0, "a"), (1, D(2025, 1, 3), 1.0, "a")])
    maintain.stream_append(read(), path, check, ["k"], "d", ["v"]).awaitTermination()
    got = maintain.streamed_fact(spark, path, read().schema)
    assert sorted((r.k or 0, r.yyyymm) for r in got.collect()) == [(0, 202501), (0, 202501), (1, 202501)]


def test_append_takes_late_rows_and_each_key_once(spark, stream, tmp_path):
    add, read = stream
    path, check = str(tmp_path / "t"), str(tmp_path / "c")
    for rows in FILES:
        add(rows)
        maintain.stream_append(read(), path, check, ["k"], "d", ["v"]).awaitTermination()
    fact = spark.read.parquet(path)
    assert sorted((r.k, r.v) for r in fact.collect()) == [(1, 1.5), (2, 2.0), (3, 4.0), (4, 9.0)]
    maintain.stream_append(read(), path, str(tmp_path / "c2"), ["k"], "d", ["v"]).awaitTermination()
    assert spark.read.parquet(path).count() == 4


def _bits(rows):
    return sorted((str(r[0]), r[1], r[2].hex(), r[3]) for r in rows)


@pytest.mark.parametrize("seed", range(3))
def test_any_split_into_parts_gives_the_same_sums_to_the_last_bit(spark, seed):
    """Amounts of many sizes and with more than four decimals, whose doubles depend on the order."""
    r = random.Random(seed)
    amounts = [r.choice([r.uniform(-1, 1) * 10 ** r.randrange(-9, 9), 0.1, 1 / 3, None]) for _ in range(600)]
    rows = [(i, D(2025, 1 + i % 2, 1), v, "ab"[i % 3 % 2], r.randrange(5)) for i, v in enumerate(amounts)]
    df = spark.createDataFrame(rows, "k bigint, d date, v double, g string, part int").cache()
    keys = ["month", "g"]
    whole = additive_rollup(df, "d", "month", ["g"], ["v"], extra={"n": F.count(F.lit(1))})
    parts = [rollup_states(df.filter(F.col("part") == p), "d", "month", ["g"], ["v"], extra={"n": F.count(F.lit(1))}) for p in range(5)]
    first = merge_states(parts[0].unionByName(parts[3]), keys, ["v"], ["n"])
    rest = merge_states(parts[4].unionByName(parts[1]).unionByName(parts[2]), keys, ["v"], ["n"])
    for stored in (functools.reduce(lambda a, b: a.unionByName(b), parts), rest.unionByName(first)):
        got = finished(merge_states(stored, keys, ["v"], ["n"]), ["v"])
        assert _bits(got.select(*whole.columns).collect()) == _bits(whole.collect())


def test_a_state_of_nothing_but_nulls(spark):
    df = spark.createDataFrame([(D(2025, 1, 1), None)], "d date, v double")
    stored = rollup_states(df, "d", "month", [], ["v"])
    assert finished(merge_states(stored, ["month"], ["v"]), ["v"]).first()["v"] == 0.0
    assert df.agg(money_sum("v")).first()[0] is None


def _fact_rows(spark, path, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).withColumn("yyyymm", yyyymm("d"))


def test_append_reads_the_months_of_the_batch_only(spark, stream, tmp_path):
    add, read = stream
    path, check = str(tmp_path / "t"), str(tmp_path / "c")
    add(FILES[0])
    maintain.stream_append(read(), path, check, ["k"], "d", ["v"]).awaitTermination()
    # Whoever opened this month would fail.
    broken = tmp_path / "t" / "yyyymm=202402"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"no parquet")
    add([(1, D(2025, 1, 3), 9.0, "a"), (7, D(2025, 1, 31), 1.0, "a")])
    maintain.stream_append(read(), path, check, ["k"], "d", ["v"]).awaitTermination()
    got = spark.read.schema(SCHEMA + ", yyyymm int").parquet(path).filter("yyyymm = 202501")
    assert sorted((r.k, r.v) for r in got.collect()) == [(1, 1.5), (2, 2.0), (7, 1.0)]
    rows = spark.createDataFrame(FILES[1], SCHEMA)
    plan = maintain.unseen(rows, path, ["k"], "d", ["v"], [202501])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*yyyymm#\d+ (IN|=) \(?202501", plan), plan


def test_rows_read_do_not_grow_with_other_months(spark, tmp_path):
    """The scan of the fact gives the keys of the batch's month, however many other months there are."""
    path = str(tmp_path / "t")
    months = [(100 * m + i, D(2020 + m // 12, 1 + m % 12, 5), 1.0, "a") for m in range(30) for i in range(50)]
    _fact_rows(spark, path, months).write.partitionBy("yyyymm").parquet(path)
    rows = spark.createDataFrame([(5, D(2020, 1, 5), 2.0, "b"), (9999, D(2020, 1, 6), 2.0, "b")], SCHEMA)
    new = maintain.unseen(rows, path, ["k"], "d", ["v"], maintain.months_of(rows, "d"))
    assert [r.k for r in new.collect()] == [9999]
    assert _scan_rows(new._jdf.queryExecution().executedPlan()) == 50


def _scan_rows(plan):
    """Rows out of the file scans of a plan that has run."""
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _scan_rows(plan.executedPlan())
    if name.endswith("QueryStageExec"):
        return _scan_rows(plan.plan())
    if name == "FileSourceScanExec":
        return plan.metrics().apply("numOutputRows").value()
    children = plan.children()
    return sum(_scan_rows(children.apply(i)) for i in range(children.size()))


CLAIMS = "op bigint, comp bigint, d date, v double, g string, claim bigint"


def _claims(seed, n):
    r = random.Random(seed)
    return [(1000 * seed + i, i % 3, D(2025, r.randrange(1, 4), 1 + i % 28), i / 4, "ab"[i % 2], r.randrange(6)) for i in range(n)]


def _paid(rows):
    return claims_rollup(rows, "d", "month", ["g"], "v", "claim")


def _claim_stream(spark, tmp_path):
    folder = str(tmp_path / "in")

    def add(rows):
        spark.createDataFrame(rows, CLAIMS).coalesce(1).write.mode("append").parquet(folder)

    def run(path, checkpoint):
        read = spark.readStream.schema(CLAIMS).option("maxFilesPerTrigger", 1).parquet(folder)
        maintain.stream_append(
            read, f"{path}/fact", checkpoint, ["op", "comp"], "d", ["v"], rollups=[(f"{path}/rollup", "month", _paid)]
        ).awaitTermination()

    return add, run


def _rollup_rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(f"{path}/rollup").drop("yyyymm").collect()))


def test_distinct_counts_follow_the_stream(spark, tmp_path):
    """Claims that come again in a later batch, late rows, and rows without a key or a date."""
    add, run = _claim_stream(spark, tmp_path)
    path = str(tmp_path / "t")
    batches = [_claims(1, 40), _claims(2, 30), [*_claims(1, 5), (None, 1, D(2025, 1, 2), 1.0, "a", 99), (5, 5, None, 1.0, "a", 1)], _claims(3, 1)]
    for rows in batches:
        add(rows)
        run(path, str(tmp_path / "c"))
    all_rows = spark.createDataFrame([*batches[0], *batches[1], batches[2][5], *batches[3]], CLAIMS)
    assert _rollup_rows(spark, path) == sorted(map(tuple, _paid(all_rows).collect()))
    before = {f.name for f in (tmp_path / "t" / "rollup").rglob("*.parquet")}
    add([(77, 0, D(2025, 2, 2), 1.0, "a", 1)])
    run(path, str(tmp_path / "c"))
    after = {f.name: f.parent.name for f in (tmp_path / "t" / "rollup").rglob("*.parquet")}
    assert {after[f] for f in set(after) - before} == {"yyyymm=202502"}


def test_a_batch_that_died_between_append_and_rollup_is_repaired(spark, tmp_path, monkeypatch):
    add, run = _claim_stream(spark, tmp_path)
    add(_claims(1, 40))
    run(str(tmp_path / "t"), str(tmp_path / "c"))
    add(_claims(2, 30))
    with monkeypatch.context() as m:
        m.setattr(maintain, "replace_partitions", _die)
        with pytest.raises(StreamingQueryException):
            run(str(tmp_path / "t"), str(tmp_path / "c"))
    clean = sorted(map(tuple, _paid(spark.createDataFrame(_claims(1, 40) + _claims(2, 30), CLAIMS)).collect()))
    assert _rollup_rows(spark, str(tmp_path / "t")) != clean
    run(str(tmp_path / "t"), str(tmp_path / "c"))
    assert _rollup_rows(spark, str(tmp_path / "t")) == clean
    assert spark.read.parquet(str(tmp_path / "t" / "fact")).count() == 70


def _die(*_):
    raise RuntimeError("died")
