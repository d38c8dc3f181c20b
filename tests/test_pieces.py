"""Large loads in pieces by key, rollups for some months at a time, and no shuffle files kept (findings of round 4)."""

import datetime as dt
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from policy_mart.files import Files, file_bytes
from policy_mart.operators import dealing, load
from policy_mart.plans import facts
from policy_mart.plans import mart as plans_mart
from policy_mart.plans.mart import Mart, load_fact
from policy_mart.schemas import LIFE_PREMIUMS, MOTOR_PREMIUMS, OTHER_PREMIUMS
from policy_mart.sources import publish
from policy_mart.sources.writers import append_by_month, replace_partitions
from tests.test_plans import plan_of

D = dt.date
SINCE = D(1900, 1, 1)


def premiums(spark, table, path):
    """Lines in several months, some of them twice, some with a key that is null, from files."""
    def value(f):
        n = F.col("id")
        if f.dataType.simpleString() == "date":
            return F.date_add(F.lit(D(2024, 11, 20)), (n % 90).cast("int"))
        if f.name == "Op":
            return F.when(n % 60 != 7, F.expr("id DIV 3"))
        if f.name == "Comp":
            return F.when(n % 61 != 5, n % 3)
        return (n * 0.5 if f.dataType.simpleString() == "double" else n).cast(f.dataType)

    rows = spark.range(600).select(*[value(f).cast(f.dataType).alias(f.name) for f in table.schema.fields])
    rows.unionByName(rows.filter("Supl < 40")).write.parquet(path)
    return spark.read.parquet(path)


def content(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def small_pieces(monkeypatch):
    monkeypatch.setattr(dealing, "_SMALL", 1)
    monkeypatch.setattr(dealing, "_PIECE", 20_000)
    monkeypatch.setattr(dealing, "_COUNTED", 2)
    monkeypatch.setattr(plans_mart, "_SUMMED", 1)


def _load(mart, table, rows):
    if table is MOTOR_PREMIUMS:
        facts.load_motor_premiums(mart, rows, SINCE)
    elif table is OTHER_PREMIUMS:
        load_fact(mart, table, rows, SINCE, rollups=facts.OTHER_ROLLUPS)
    else:
        load_fact(mart, table, rows, SINCE)


@pytest.mark.parametrize(
    "table, rollup", [(MOTOR_PREMIUMS, "primas_automotores_agg"), (OTHER_PREMIUMS, "primas_rvarias_agg_reaseguro"), (LIFE_PREMIUMS, None)]
)
def test_a_load_in_pieces_is_a_whole_load(spark, tmp_path, monkeypatch, small_pieces, table, rollup):
    rows = premiums(spark, table, str(tmp_path / "source"))
    pieces, summed, stage, replace = [], [], publish.stage_write, plans_mart.replace_partitions

    def staged(df, *args):
        pieces.append(1 if not isinstance(df, list) else len(df))
        return stage(df, *args)

    monkeypatch.setattr("policy_mart.sources.writers.stage_write", staged)
    monkeypatch.setattr(plans_mart, "replace_partitions", lambda *a, **more: (summed.append(1), replace(*a, **more)))
    cut = Mart(spark, str(tmp_path / "cut"))
    _load(cut, table, rows.filter("Supl % 2 = 0"))
    _load(cut, table, rows)
    assert pieces[0] > 1 and max(pieces) > 1 and len(summed) == (8 if rollup else 0)  # four months, twice
    monkeypatch.setattr(dealing, "_SMALL", 1 << 40)
    monkeypatch.setattr(plans_mart, "_SUMMED", 1 << 40)
    pieces.clear(), summed.clear()
    whole = Mart(spark, str(tmp_path / "whole"))
    _load(whole, table, rows.filter("Supl % 2 = 0"))
    _load(whole, table, rows)
    assert set(pieces) == {1} and len(summed) == (2 if rollup else 0)
    assert content(cut.table(table)) == content(whole.table(table)) and cut.table(table).count() > 600
    for name in [rollup] if rollup else []:
        assert content(spark.read.parquet(cut.path(name))) == content(spark.read.parquet(whole.path(name)))


def test_pieces_share_no_key_and_leave_no_row(spark, tmp_path):
    rows = premiums(spark, MOTOR_PREMIUMS, str(tmp_path / "source"))
    parts = [load.new_by_month(rows, None, ["Op", "Supl", "Comp"], "FEmision", together=["Op"], piece=(i, 5)) for i in range(5)]
    keys = [{r.Op for r in p.select("Op").distinct().collect()} for p in parts]
    assert all(len(k) > 10 for k in keys) and len(set().union(*keys)) == sum(map(len, keys)) == 201
    assert sum(p.count() for p in parts) == rows.count()


def test_the_piece_is_chosen_in_front_of_joins_and_fills_the_tasks(spark, tmp_path):
    spark.range(4000).selectExpr("id k", "id % 7 p").write.parquet(str(tmp_path / "l"))
    spark.range(4000).selectExpr("id o", "id % 9 v").write.parquet(str(tmp_path / "o"))
    lines, orders = (spark.read.parquet(str(tmp_path / n)) for n in "lo")
    piece = dealing.in_piece(lines.join(orders.hint("merge"), F.col("k") == F.col("o")).withColumnRenamed("k", "Op"), ["Op"], (1, 4))
    plan = plan_of(piece)
    assert plan.count("pmod(xxhash64(piece") >= 2  # both sides
    assert "pmod" not in plan.split("Exchange")[0]
    for spread in (F.pmod(F.hash("Op"), F.lit(8)), F.pmod(F.xxhash64("Op"), F.lit(8))):  # of a join, and of `deal`
        assert piece.select(spread).distinct().count() == 8


def test_a_load_that_dies_in_a_later_piece_adds_nothing(spark, tmp_path, small_pieces):
    """Rows with a null key are always new, so pieces that stayed would be there twice after the next run."""
    rows = premiums(spark, LIFE_PREMIUMS, str(tmp_path / "source"))
    mart, clean = Mart(spark, str(tmp_path / "torn")), Mart(spark, str(tmp_path / "clean"))
    of = dealing.pieces(rows, ["Op"])
    assert of > 2
    last = dealing.in_piece(rows.filter("Op IS NOT NULL"), ["Op"], (of - 1, of)).first().Op
    broken = F.when(F.col("Op") == last, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("SaSupl"))
    with pytest.raises(Exception, match="lost"):
        load_fact(mart, LIFE_PREMIUMS, rows.withColumn("SaSupl", broken), SINCE)
    assert not Files(spark, mart.root).exists(mart.path(LIFE_PREMIUMS.name))
    load_fact(mart, LIFE_PREMIUMS, rows, SINCE)
    load_fact(clean, LIFE_PREMIUMS, rows, SINCE)
    assert content(mart.table(LIFE_PREMIUMS)) == content(clean.table(LIFE_PREMIUMS)) == content(rows.withColumn("yyyymm", F.date_format("FEmision", "yyyyMM").cast("int")))
    assert not Files(spark, mart.root).names(f"{mart.path(LIFE_PREMIUMS.name)}__staged")


def test_a_load_in_pieces_stops_at_the_gap_of_all_rows(spark, tmp_path, small_pieces):
    rows = premiums(spark, LIFE_PREMIUMS, str(tmp_path / "s"))
    # One operation has the only row of December: no piece but its own knows that month.
    only = rows.filter("month(FEmision) <> 12").unionByName(rows.filter("month(FEmision) = 12 AND Op IS NOT NULL").limit(1))
    only.write.parquet(str(tmp_path / "gap"))
    gap = spark.read.parquet(str(tmp_path / "gap"))
    mart = Mart(spark, str(tmp_path / "mart"))
    assert load_fact(mart, LIFE_PREMIUMS, gap, D(2024, 11, 1), stop_at_gap=True).months == (202411, 202412, 202501, 202502)
    later = Mart(spark, str(tmp_path / "later"))
    assert load_fact(later, LIFE_PREMIUMS, gap.filter("month(FEmision) <> 12"), D(2024, 11, 1), stop_at_gap=True).months == (202411,)


def test_small_and_fileless_sources_are_loaded_whole(spark, tmp_path):
    rows = premiums(spark, LIFE_PREMIUMS, str(tmp_path / "a b%20c"))
    assert file_bytes(rows, 1 << 40) == sum(f.stat().st_size for f in (tmp_path / "a b%20c").glob("*.parquet"))
    assert dealing.pieces(rows, ["Op"]) == 1 and dealing.pieces(spark.range(9).withColumnRenamed("id", "Op"), ["Op"]) == 1


def _shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f.name for folder in folders for f in Path(str(folder)).rglob("shuffle_*")}


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    days = F.date_add(F.lit(D(2025, 1, 1)), (F.col("id") % 60).cast("int"))
    rows = spark.range(2000).select(F.col("id").alias("k"), days.alias("d")).repartition(8, "k")
    before = _shuffle_files(spark)
    append_by_month(rows, str(tmp_path / "a"), "d")
    append_by_month([load.new_by_month(rows, None, ["k"], "d", piece=(i, 2)) for i in range(2)], str(tmp_path / "b"), "d", dealt=True)
    replace_partitions(rows.withColumn("yyyymm", F.month("d")), str(tmp_path / "c"))
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)  # they are removed in the background
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert all(spark.read.parquet(str(tmp_path / t)).count() == 2000 for t in "abc")


def test_tables_are_stored_compressed_well(spark, tmp_path):
    rows = premiums(spark, OTHER_PREMIUMS, str(tmp_path / "source"))
    mart = Mart(spark, str(tmp_path / "mart"))
    _load(mart, OTHER_PREMIUMS, rows)
    for name in (OTHER_PREMIUMS.name, "primas_rvarias_agg_reaseguro"):
        files = list(Path(mart.path(name)).rglob("*.parquet"))
        assert files and all(f.name.endswith(".zstd.parquet") for f in files)
