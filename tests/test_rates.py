import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from policy_mart.operators import rates
from policy_mart.operators.scd import current_rows, latest_per_key, scd_delta, upsert_columns
from policy_mart.plans import dims, reports
from policy_mart.plans.mart import Mart
from policy_mart.schemas import LIABILITY_RATES, MOTOR_COVERAGES, RATES, RATES_BY_RISK

D = dt.date
RATE = "NumTarifa bigint, Cap bigint, Air bigint, CodCobertura string, segmento_ant bigint, AntMinima bigint, AntMaxima bigint, TasaAnual double, fecha_desde date"
FLAGS = "CodCobertura string, Rt int, Rp int, It int, Ip int, At int, Ap int"


def test_widen_last_band(spark):
    df = spark.createDataFrame([("a", 1, 9), ("a", 2, 19), ("b", 1, 9)], "k string, seg int, hi int")
    got = rates.widen_last_band(df, ["k"], "seg", "hi")
    assert sorted(map(tuple, got.collect())) == [("a", 1, 9), ("a", 2, 200), ("b", 1, 200)]


def split(rate, base, flags):
    """The rules of one rate, read one after the other."""
    t = {c: base.get(c, 0.0) for c in ("C2", "C4", "C5", "B4", "B5")}
    it = t["B4"] * flags["It"]
    rt = max(min(rate - it, t["B5"]), 0) * flags["Rt"]
    at = max(min(rate - rt - it, t["C2"] - t["C5"] - t["C4"]), 0) * flags["At"]
    ip = max(min(rate - rt - it - at, t["C4"] - t["B4"]), 0) * flags["Ip"]
    rp = max(min(rate - rt - it - at - ip, t["C5"] - t["B5"]), 0) * flags["Rp"]
    ap = max(rate - rt - it - at - ip - rp, 0)
    return int(min(t.values()) > 0), it, rt, at, ip, rp, ap


@pytest.mark.parametrize("seed", range(4))
def test_decompose_rates(spark, seed):
    r = random.Random(seed)
    codes = ["C2", "C4", "C5", "B4", "B5", "D1", "X9"]
    rows, flags = [], {}
    for cap in (1, 2):
        for seg in (1, 2):
            for code in codes:
                if r.random() < 0.8:
                    rate = r.choice([0.009, 0.01, 998.0, 999.0, round(r.uniform(1, 60), 2), round(r.uniform(1, 60), 2)])
                    rows.append((11, cap, 1, code, seg, seg * 10, seg * 10 + 9, rate, D(2025, 1, 1)))
    for code in codes[:-1]:
        flags[code] = {x: r.randint(0, 1) for x in rates.RISKS}
    cover = spark.createDataFrame([(c, *[f[x] for x in ("Rt", "Rp", "It", "Ip", "At", "Ap")]) for c, f in flags.items()], FLAGS)
    got = rates.decompose_rates(spark.createDataFrame(rows, RATE), cover).collect()
    expected = {}
    for _, cap, _, code, seg, _, _, rate, _ in rows:
        if 0.01 <= rate <= 998:
            base = {c: max([x[7] for x in rows if x[1] == cap and x[3] == c], default=0.0) for c in codes[:5]}
            expected[cap, seg, code] = split(rate, base, flags.get(code, dict.fromkeys(rates.RISKS, 0)))
    out = {
        (x.Cap, x.segmento_ant, x.CodCobertura): (x.Habilitado, x.TasaIt, x.TasaRt, x.TasaAt, x.TasaIp, x.TasaRp, x.TasaAp)
        for x in got
    }
    assert out == expected


def test_parts_sum_to_the_rate_with_all_flags(spark):
    rows = [(11, 1, 1, c, 1, 0, 200, t, D(2025, 1, 1)) for c, t in
            {"C2": 40.0, "C4": 12.0, "C5": 15.0, "B4": 4.0, "B5": 6.0, "Z": 70.0}.items()]
    cover = spark.createDataFrame([(c, 1, 1, 1, 1, 1, 1) for c in ("C2", "C4", "C5", "B4", "B5", "Z")], FLAGS)
    for r in rates.decompose_rates(spark.createDataFrame(rows, RATE), cover).collect():
        parts = [r.TasaIt, r.TasaRt, r.TasaAt, r.TasaIp, r.TasaRp, r.TasaAp]
        assert min(parts) >= 0 and abs(sum(parts) - r.TasaAnual) < 1e-9 and r.Habilitado == 1


@pytest.mark.parametrize("width", [1, 7, 10, 500])
def test_rate_band_join_against_all_pairs(spark, width):
    r = random.Random(width)
    rows = [(i, r.choice("ab"), r.choice([None, r.randint(-15, 230)])) for i in range(150)]
    bands = [(j, r.choice("ab"), lo, lo + r.randint(-2, 60)) for j, lo in enumerate(r.randint(-20, 200) for _ in range(40))]
    left = spark.createDataFrame(rows, "i int, k string, age int")
    right = spark.createDataFrame(bands, "j int, k string, lo int, hi int")
    got = rates.rate_band_join(left, right, ["k"], "age", "lo", "hi", width)
    expected = sorted((i, j) for i, k, a in rows for j, k2, lo, hi in bands if k == k2 and a is not None and lo <= a <= hi)
    assert sorted((x.i, x.j) for x in got.collect()) == expected


def test_portfolio_takes_the_last_supplement(spark):
    df = spark.createDataFrame(
        [(1, 1, 0, 5, 10.0, 100.0), (1, 1, 2, 7, 30.0, 50.0), (1, 1, 1, 6, 20.0, None), (2, 1, 0, 1, 1.0, 1.0)],
        "Poliza int, Comp int, Supl int, Cap int, Sa double, Prima double",
    )
    got = rates.portfolio_premiums(df, ["Poliza", "Comp"], ["Supl"], {"Cap": "Cap", "Suma": "Sa"}, ("PrimaNeta", "Prima"))
    assert got.columns == ["Poliza", "Comp", "Cap", "Suma", "PrimaNeta"]
    assert sorted(map(tuple, got.collect())) == [(1, 1, 7, 30.0, 150.0), (2, 1, 1, 1.0, 1.0)]


def test_prorated_premium_sums(spark):
    row = {f"Tasa{x}": v for x, v in zip(rates.RISKS, (1.0, 2.0, 3.0, 4.0, 5.0, 5.0))} | {"p": 100.0, "t": 20.0}
    out = rates.prorate_risks(spark.createDataFrame([row]), "p", "t").first()
    assert sum(out[x] for x in rates.RISKS) == 100.0 == out.Total + out.Parcial == out.Robo + out.Incendio + out.Accidente
    zero = rates.prorate_risks(spark.createDataFrame([row | {"t": 0.0}]), "p", "t").first()
    assert zero.Rt is None and zero.Total is None


def test_scd_delta(spark):
    schema = "k int, a int, b double, since date"
    current = spark.createDataFrame(
        [(1, 1, 1.0, D(2025, 1, 1)), (2, 1, 1.0, D(2025, 1, 1)), (3, 1, 1.0, D(2025, 1, 1)), (4, None, 1.0, D(2025, 1, 1))], schema
    )
    source = spark.createDataFrame(
        [
            (1, 1, 1.0, D(2026, 1, 1)),  # newer but the same
            (2, 9, 1.0, D(2024, 1, 1)),  # changed but older
            (3, 1, 2.0, D(2025, 6, 1)),  # changed and newer
            (4, 5, 1.0, D(2025, 6, 1)),  # from null
            (5, 1, 1.0, D(2020, 1, 1)),  # new
        ],
        schema,
    )
    got = scd_delta(source, current, ["k"], ["a", "b"], "since")
    assert sorted(r.k for r in got.collect()) == [3, 4, 5]
    assert got.columns == source.columns


def test_latest_per_key_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (None, 1, "n"), (None, None, "m")], "k int, v int, t string")
    got = latest_per_key(df, ["k"], ["v", "t"])
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, 5, "b"), (None, 1, "n")], key=str)


def test_upsert_columns(spark):
    df = spark.createDataFrame([("a", "old", 1), ("b", "old", 2), ("a", "old", 3), (None, "old", 4)], "k string, x string, n int")
    new = spark.createDataFrame([("a", "new"), ("b", None)], "k string, x string")
    got = upsert_columns(df, new, "k", ["x"])
    assert sorted(map(tuple, got.collect()), key=lambda t: t[2]) == [
        ("a", "new", 1), ("b", "old", 2), ("a", "new", 3), (None, "old", 4)
    ]


def raw_rates(spark, *rows):
    return spark.createDataFrame(
        list(rows), "NumTarifa int, Cap int, Air int, CodCobertura string, Tasa float, Ant_ int, Min int, Max int, Fecha date"
    )


def test_rates_load_and_split(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "mart"))
    cover = spark.createDataFrame([("C2", 1, "Todo", 1, 1, 1, 1, 1, 1, 1)], ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in MOTOR_COVERAGES.schema.fields[:-1]))
    dims.load_motor_coverages(mart, cover.withColumn("Rt", F.lit(0)), dt.datetime(2025, 1, 1))
    dims.load_motor_coverages(mart, cover, dt.datetime(2025, 2, 1))
    assert [r.Rt for r in dims.motor_coverages(mart).collect()] == [1]

    first = [(11, 1, 1, "C2", 10.0, 1, 0, 9, D(2025, 1, 1)), (11, 1, 1, "C2", 12.0, 2, 10, 19, D(2025, 1, 1))]
    assert dims.load_rates(mart, raw_rates(spark, *first)).count() == 2
    second = [
        (11, 1, 1, "C2", 11.0, 1, 0, 9, D(2025, 3, 1)),  # changed and newer
        (11, 1, 1, "C2", 99.0, 2, 10, 19, D(2024, 3, 1)),  # changed and older
        (11, 2, 1, "C2", 5.0, 1, 0, 9, D(2025, 3, 1)),  # new
    ]
    current = dims.load_rates(mart, raw_rates(spark, *second))
    assert sorted((r.Cap, r.segmento_ant, r.AntMaxima, r.TasaAnual) for r in current.collect()) == [
        (1, 1, 9, 11.0), (1, 2, 200, 12.0), (2, 1, 200, 5.0)
    ]
    assert mart.table(RATES).count() == 4
    dims.load_rates(mart, raw_rates(spark, *second))
    assert mart.table(RATES).count() == 4
    assert mart.table(RATES_BY_RISK).count() == 3


def test_liability_rates(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "mart"))
    schema = "NumTarifa int, Cap int, Var int, RcSl float, RcCl float, RcExt float, RcAp float, RcObl float, Fecha date"

    def load(*rows):
        return dims.load_liability_rates(mart, spark.createDataFrame(list(rows), schema)).count()

    assert load((1, 1, 1, 1.0, 1.0, 1.0, 1.0, 1.0, D(2025, 1, 1))) == 1
    assert load((1, 1, 1, 1.0, 2.0, 1.0, 1.0, 1.0, D(2025, 2, 1)), (1, 1, 2, 1.0, 1.0, 1.0, 1.0, 1.0, D(2025, 1, 1))) == 2
    assert load((1, 1, 1, 1.0, 2.0, 1.0, 1.0, 1.0, D(2025, 3, 1))) == 2
    history = mart.table(LIABILITY_RATES)
    assert history.count() == 3
    current = current_rows(history, LIABILITY_RATES.keys, "fecha_desde").filter("Var = 1").first()
    assert current.RcCl == 2.0


def test_vehicles_with_default_tariff(spark):
    vehicles = spark.createDataFrame(
        [(0, 4, 1, 1, "C2", 3, D(2025, 3, 1)), (5, 4, 2, 1, "A2", 3, D(2025, 3, 1)), (5, 4, 3, 1, "C2", 3, D(2025, 2, 28))],
        "TarifaHija bigint, CodRama bigint, Poliza bigint, Componente bigint, CodCoberturaAut string, Ant int, Fecha date",
    ).withColumns({"CvaCapitulo": F.lit(1), "CvaVariante": F.lit(1)})
    chosen = reports.vehicles_in_force(vehicles, D(2025, 3, 1))
    premiums = spark.createDataFrame([(4, 1, 1, 1, 1, 1, 9.0, 50.0)], "CodRama bigint, Poliza bigint, Comp bigint, Cap bigint, Var bigint, Air bigint, Sa double, PrimaNeta double")
    got = reports.vehicles_with_premiums(chosen, premiums).collect()
    assert [(r.Poliza, r.NumTarifa) for r in got] == [(1, 11)]


def _bands(spark, *data):
    return spark.createDataFrame([(1, *d) for d in data], "k int, band string, lo double, hi double")


def _held(df):
    return sorted((r.v, r.band) for r in df.collect())


def test_bands_of_any_width_and_without_ends(spark):
    data = [("narrow", 10.0, 12.0), ("point", 5.0, 5.0), ("wide", 0.0, 9_999_999.0), ("huge", -1e300, 1e300), ("none", 9.0, 3.0),
            ("up", 100.0, None), ("down", None, 6.0), ("all", None, None), ("inf", 1.0, float("inf"))]
    values = [-5.0, 0.0, 5.0, 6.0, 11.5, 12.0, 12.5, 99.9, 100.0, 5e6, 9_999_999.0, 1e12, 1e301, None]
    rows = spark.createDataFrame([(1, v) for v in values] + [(2, 5.0)], "k int, v double")
    bands = _bands(spark, *data)
    for open_ends in (False, True):

        def holds(v, lo, hi, open_ends=open_ends):
            if not open_ends and (lo is None or hi is None):
                return False
            return (lo is None or v >= lo) and (hi is None or v <= hi)

        expected = sorted((v, b) for v in values if v is not None for b, lo, hi in data if holds(v, lo, hi))
        assert _held(rates.rate_band_join(rows, bands, ["k"], "v", "lo", "hi", open_ends=open_ends)) == expected
    assert _held(rates.rate_band_join(rows, bands.limit(0), ["k"], "v", "lo", "hi")) == []


def test_a_band_has_few_bins_however_wide(spark):
    """Bands up to 10 ** 15 wide: the join side with the bands has at most ten rows of each."""
    r = random.Random(1)
    data = [(str(i), lo, lo + 10.0 ** r.uniform(-2, 15)) for i in range(300) for lo in [r.uniform(-1e6, 1e6)]]
    bands = _bands(spark, *data)
    value = [r.choice([lo, hi, (lo + hi) / 2, hi + 1e-3]) for _, lo, hi in data]
    rows = spark.createDataFrame([(1, v) for v in value], "k int, v double")
    joined = rates.rate_band_join(rows, bands, ["k"], "v", "lo", "hi")
    assert _held(joined) == sorted((v, b) for v in value for b, lo, hi in data if lo <= v <= hi)
    levels = bands.select("lo", "hi", rates._band_level("lo", "hi", 10).alias("l"))
    spans = levels.select((F.floor(F.col("hi") / (10 * F.pow(F.lit(8.0), "l"))) - F.floor(F.col("lo") / (10 * F.pow(F.lit(8.0), "l"))) + 1).alias("n"))
    assert spans.agg(F.max("n")).first()[0] <= rates._BINS + 1
    assert "CartesianProduct" not in joined._jdf.queryExecution().toString() and "NestedLoop" not in joined._jdf.queryExecution().toString()
