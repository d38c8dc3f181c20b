"""One shuffle for what is loaded or summed by month, and what else findings of round 3 asked for."""

import datetime as dt

from pyspark.sql import functions as F

from policy_mart.functions.text import lenient_date, strip
from policy_mart.operators import load
from policy_mart.operators.rollup import claims_rollup
from policy_mart.plans import facts
from policy_mart.schemas import MOTOR_PREMIUMS
from policy_mart.sources.keyed_table import KeyedTable
from policy_mart.sources.readers import cast_to
from policy_mart.streaming.maintain import unseen
from tests.test_plans import plan_of

D = dt.date


def lines(spark):
    days = [D(2025, 1, 1 + n % 28) if n % 3 else D(2024, 12, 5) for n in range(200)]
    rows = [(None if n % 50 == 7 else n // 2, n % 7, day, float(n)) for n, day in enumerate(days)]
    return spark.createDataFrame([*rows, *rows[:20], (1, 1, None, 1.0)], "k long, l int, d date, v double")


def test_new_by_month_is_append_new_in_one_shuffle(spark, tmp_path):
    lines(spark).filter("d IS NOT NULL").write.parquet(str(tmp_path / "a"))
    source = spark.read.parquet(str(tmp_path / "a"))
    target = source.filter("v % 2 = 0").withColumn("yyyymm", F.date_format("d", "yyyyMM").cast("int"))
    for more in ({}, {"since": D(2025, 1, 1)}, {"together": ["k"]}):
        got = load.new_by_month(source, target, ["k", "l"], "d", **more)
        plan = plan_of(got)
        assert plan.count("Exchange") == 1 and "Join" not in plan
        bounds = {n: v for n, v in more.items() if n == "since"}
        want = load.append_new(source, target, ["k", "l"], "d", **bounds)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() > 20
    assert load.new_by_month(lines(spark), None, ["k"], "d").count() == 220


def test_fine_rollups_shuffle_rows_once_and_sum_behind(spark):
    fact = spark.range(40).select(*[(F.date_add(F.lit(D(2025, 1, 2)), F.col("id").cast("int")) if f.dataType.simpleString() == "date" else F.col("id").cast(f.dataType)).alias(f.name) for f in MOTOR_PREMIUMS.schema.fields])
    plan = plan_of(facts.motor_premiums_rollup(cast_to(fact, MOTOR_PREMIUMS.schema)))
    assert plan.count("Exchange") == 1 and "Aggregate" not in plan.split("Exchange")[1]
    df = lines(spark)
    plain, fine = (claims_rollup(df, "d", "m", ["l"], "v", "k", fine=by) for by in ((), ["l"]))
    assert plan_of(fine).count("Exchange") == 1
    assert sorted(map(str, fine.collect())) == sorted(map(str, plain.collect()))


def test_a_large_month_and_a_large_value_are_summed_by_many_tasks(spark):
    fact = spark.range(4000).select(*[(F.when(F.col("id") % 40 == 0, F.lit(D(2024, 12, 5))).otherwise(F.lit(D(2025, 1, 2))) if f.dataType.simpleString() == "date" else F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")) if f.name == "Op" else F.col("id")).cast(f.dataType).alias(f.name) for f in MOTOR_PREMIUMS.schema.fields])
    fact = fact.unionByName(fact.filter("Comp < 100"))
    small = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(small, "false")  # rows this few would be joined in one task
    try:
        rollup = facts.motor_premiums_rollup(fact)
        per_task = [r["count"] for r in rollup.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == 4000 and len(per_task) >= 6 and max(per_task) < 1000
        summed = rollup.agg(F.sum("PremioSupl"), F.count_distinct("FEmisionMes")).first()
        assert tuple(summed) == (sum(range(4000)) + sum(range(100)), 2)
    finally:
        spark.conf.unset(small)


def test_updates_are_worked_out_once(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", 4)
    table.write(spark.createDataFrame([(str(n), "old") for n in range(9)], "k string, v string"))
    calls = spark.sparkContext.accumulator(0)

    def new(k):
        calls.add(1)
        return "new"

    updates = spark.createDataFrame([("1",), ("2",), ("3",)], "k string").withColumn("v", F.udf(new)("k"))
    assert table.update(updates, ["v"]) == 3 and calls.value == 3
    assert table.read().filter("v = 'new'").count() == 3


def test_streamed_batches_are_shuffled_twice(spark, tmp_path):
    lines(spark).filter("k IS NOT NULL AND d IS NOT NULL").write.parquet(str(tmp_path / "b"))
    batch = spark.read.parquet(str(tmp_path / "b"))
    batch.filter("v < 100").withColumn("yyyymm", F.date_format("d", "yyyyMM").cast("int")).write.partitionBy("yyyymm").parquet(str(tmp_path / "f"))
    new = unseen(batch, str(tmp_path / "f"), ["k", "l"], "d", ["v"], [202412, 202501])
    assert plan_of(new).count("Exchange") == 2 and new.count() == batch.filter("v >= 100").select("k", "l").distinct().count()


def test_dates_and_ends_without_the_slow_parser(spark):
    texts = ["31/02/2001", "1/2/2001", "01/12/1999", "29/2/2000", "29/2/2001", "0/1/2001", "1/13/2001", "1/1/0000", "1/1/0001", "x", "", " 1/1/2001", "1/1/2001\n", "1/1/01", "001/1/2001", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for fmt in ("d/M/yyyy", "yyyy-M-d"):
        back = F.concat_ws("-", *[F.get(F.split("t", "/"), F.lit(i)) for i in (2, 1, 0)])
        c = F.col("t") if fmt[0] == "d" else F.when(F.col("t").isNotNull(), back)
        assert df.filter(~lenient_date(c, fmt).eqNullSafe(F.try_to_date(c, fmt))).collect() == []
        assert "rlike" in str(lenient_date(c, fmt)).lower()
    ends = spark.createDataFrame([(t,) for t in ["a", " a", "a ", " é ", "a b", "", "  ", "é", "a\n", None]], "t string")
    assert [r[0] for r in ends.select(strip("t")).collect()] == ["a", "a", "a", "é", "a b", "", "", "é", "a", None]
