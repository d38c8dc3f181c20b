"""What the plans look like, and how they hold up when one key has a third of all rows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from policy_mart.catalogue import QUERIES
from policy_mart.functions.numbers import units
from policy_mart.operators import controls, identity, keyed, load, profiles, rates, rollup, scd
from policy_mart.plans.mart import Mart
from policy_mart.schemas import CLAIM_REPORTS

SF_DIR = "/root/testdata/sf0.001"
ROWS = 60_000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def logical_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert bad not in plan


@pytest.fixture
def skewed(spark):
    """Sizes at which AQE takes a third of the test rows for a hot partition; no broadcasts."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, path):
    """A third of the rows have key 1; the others are spread."""
    i = F.col("id")
    df = spark.range(0, ROWS, 1, 16).select(
        F.when(i % 3 == 0, 1).otherwise(i).alias("k"),
        i.alias("n"),
        (i % 100).cast("int").alias("age"),
        F.lit(dt.date(2025, 1, 1)).alias("d"),
        F.sha2(i.cast("string"), 256).alias("payload"),
    )
    df.write.mode("overwrite").parquet(path)
    return spark.read.option("maxPartitionBytes", 1).parquet(path)


OPERATORS = {
    "append_new": lambda df: load.append_new(df, df.filter("n % 2 = 0 AND k <> 1"), ["k"], "d"),
    "missing_matches": lambda df: controls.missing_matches(df, df.filter("n > 100 AND k <> 1"), ["k"]),
    "with_group_stats": lambda df: keyed.with_group_stats(df, ["k"], F.max("n").alias("hi")),
    "with_flag": lambda df: keyed.with_flag(df, df, "k", "n", "flag"),
    "scd_delta": lambda df: scd.scd_delta(
        df, scd.latest_per_key(df.filter("n % 2 = 0"), ["k"], ["n"]), ["k"], ["age"], "d"
    ),
    "upsert": lambda df: scd.upsert_columns(
        df, df.groupBy("k").agg(F.max("payload").alias("payload")), "k", ["payload"]
    ),
    "widen_last_band": lambda df: rates.widen_last_band(df, ["k"], "n", "age"),
    "rate_band_join": lambda df: rates.rate_band_join(
        df, df.groupBy("k").agg(F.lit(0).alias("lo"), F.lit(99).alias("hi")), ["k"], "age", "lo", "hi", 1000
    ),
    "result_profile": lambda df: profiles.result_profile(
        df.select(
            F.col("k").alias("NroAsegurado"), F.col("n").alias("CodProductor"), F.col("n").alias("CodOrganizador"),
            F.col("d").alias("FechaMes"), units("n").alias("PrimaNeta"), units("n").alias("Importe"), "payload",
        ),
        df.groupBy(F.col("k").alias("NroPersona")).agg(F.max("n").alias("persona_key"), F.max("payload").alias("Nombre")),
        df.select(F.col("n").alias("CodProductor"), F.col("payload").alias("Nombre")),
        df.select(F.col("n").alias("CodOrganizador"), F.col("payload").alias("Nombre"), F.col("payload").alias("Grupo")),
        ["payload"], ["PrimaNeta"], "Importe",
    ),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_hot_keys_are_split(skewed, tmp_path, name):
    result = OPERATORS[name](hot(skewed, str(tmp_path / "hot")))
    result.collect()
    assert "isSkewJoin=true" in plan_of(result) or "skew=true" in plan_of(result)


def test_merging_persons_splits_hot_groups(skewed, tmp_path):
    """A third of the persons share one tax id, all others have an unusable one."""
    raw = hot(skewed, str(tmp_path / "hot")).select(
        (F.col("n") + 1).alias("NroPersona"), F.col("payload").alias("Nombre"), F.lit("x").alias("Domicilio"),
        F.lit(1).alias("Cp"), F.lit(0).alias("CpSufijo"), F.lit(0).alias("NroDocumento"),
        F.when(F.col("k") == 1, "20123456789").otherwise("999").alias("Cuit"), F.lit(None).cast("string").alias("FechaNac"),
        F.lit(1).alias("Sexo"), F.lit("_").alias("Bloqueado"), F.lit(0).alias("Grupo"),
    )
    persons = identity.normalise_persons(raw)
    usable = identity._valid(identity.invalid_tax_id(F.col("Cuit")))
    merged = identity._merge_groups(persons, usable, "Cuit", (), F.col("Grupo"))
    assert merged.filter("Grupo > 0").count() == ROWS // 3 + 1
    merged.collect()
    assert "skew=true" in plan_of(merged)


def test_latest_row_is_limited_before_the_shuffle(spark, tmp_path):
    plan = plan_of(scd.latest_per_key(hot(spark, str(tmp_path / "hot")), ["k"], ["n"]))
    assert re.search(r"Exchange hashpartitioning\(k.*\n.*WindowGroupLimit.*Partial", plan)


def test_rollups_add_up_before_the_shuffle(spark, tmp_path):
    plan = plan_of(rollup.additive_rollup(hot(spark, str(tmp_path / "hot")), "d", "m", ["k"], ["age"]))
    assert re.search(r"HashAggregate\(.*\n.*Exchange hashpartitioning.*\n.*HashAggregate\(.*partial_sum", plan)


def test_result_profile_reads_each_fact_once(spark):
    plan = plan_of(driver.queries()["result_profile"](spark, SF_DIR))
    assert len(re.findall(r"FileScan.*lineitem\.parquet", plan)) == 1
    assert len(re.findall(r"FileScan.*orders\.parquet", plan)) == 1
    assert "l_tax" not in plan and "o_totalprice" not in plan


def test_result_profile_sums_before_the_person_join_by_hash(skewed):
    plan = plan_of(driver.queries()["result_profile"](skewed, SF_DIR))
    assert "SortAggregate" not in plan
    below_persons = plan[plan.index("partial_sum(__high_PrimaNeta") :]
    assert "partial_sum(shiftright" in below_persons  # rows are summed before they meet the persons


def test_outer_totals_reuse_the_rollups_partitioning(skewed):
    plan = plan_of(driver.queries()["outer_premium_claims"](skewed, SF_DIR))
    top = plan[: plan.index("HashAggregate")]
    assert "FullOuter" in top and "Exchange" not in top


def test_target_months_are_pruned(spark, tmp_path):
    mart = Mart(spark, str(tmp_path))
    days = F.date_add(F.lit(dt.date(2024, 12, 1)), F.col("id").cast("int"))
    rows = spark.range(60).select(
        *[(days if f.name.startswith("Fecha") else F.col("id").cast(f.dataType)).alias(f.name) for f in CLAIM_REPORTS.schema.fields]
    )
    from policy_mart.plans.mart import load_fact

    load_fact(mart, CLAIM_REPORTS, rows, dt.date(2024, 12, 1))
    new = load.append_new(rows, mart.table(CLAIM_REPORTS), CLAIM_REPORTS.keys, "FechaDenuncia", dt.date(2025, 1, 1))
    plan = plan_of(new)
    scan = re.search(r"FileScan parquet.*", plan).group(0)
    assert re.search(r"PartitionFilters: \[.*yyyymm#\d+ >= 202501", scan)
    assert "Causa" not in re.search(r"ReadSchema: .*", scan).group(0)
