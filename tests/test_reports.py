import datetime as dt

import pytest
from pyspark.sql import functions as F

from policy_mart.functions.numbers import units
from policy_mart.operators import controls, profiles, rollup, stats
from policy_mart.plans import dims, facts, reports
from policy_mart.plans.mart import Mart
from policy_mart.schemas import CLAIM_PAYMENTS, CLAIM_REPORTS, OPERATIONS, ORGANIZERS, PERSONS, PRODUCERS

D = dt.date


def filled(spark, table, *rows, **defaults):
    """Rows of a mart table given as dicts; other columns are null."""
    names = list({k: None for r in rows for k in r})
    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in names)
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    rest = {c: F.lit(defaults.get(c)).cast(kinds[c]) for c in table.columns if c not in names}
    return df.withColumns(rest).select(*table.columns)


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    mart = Mart(spark, str(tmp_path_factory.mktemp("mart")))
    ops = filled(
        spark, OPERATIONS,
        {"Op": 1, "Suplemento": 0, "CodRama": 4, "NroAsegurado": 1, "CodOrganizador": 1, "CodProductor": 1, "FEmision": D(2025, 1, 5), "PrimaNeta": 100.0, "RecAdm": 5.0, "CodTipoOp": 1, "ProvinciaAsegurado": "BA", "CpAsegurado": 1000, "CpSufijoAsegurado": 1},
        {"Op": 2, "Suplemento": 0, "CodRama": 4, "NroAsegurado": 2, "CodOrganizador": 1, "CodProductor": 1, "FEmision": D(2025, 1, 25), "PrimaNeta": 50.0, "RecAdm": None, "CodTipoOp": 2, "ProvinciaAsegurado": "BA", "CpAsegurado": 1000, "CpSufijoAsegurado": 2},
        {"Op": 3, "Suplemento": 0, "CodRama": 7, "NroAsegurado": 3, "CodOrganizador": 9, "CodProductor": 9, "FEmision": D(2025, 1, 25), "PrimaNeta": 0.0, "RecAdm": 9.0, "CodTipoOp": 3, "ProvinciaAsegurado": "BA", "CpAsegurado": 1000, "CpSufijoAsegurado": 3},
    )
    paid = filled(
        spark, CLAIM_PAYMENTS,
        {"CodRama": 4, "Siniestro": 5, "NroLiquidacion": 1, "CodItemPago": "a", "FechaPago": D(2025, 1, 9), "NroAsegurado": 1, "CodOrganizador": 1, "CodProductor": 1, "Importe": 30.0},
        {"CodRama": 4, "Siniestro": 5, "NroLiquidacion": 2, "CodItemPago": "a", "FechaPago": D(2025, 1, 12), "NroAsegurado": 1, "CodOrganizador": 1, "CodProductor": 1, "Importe": 10.0},
        {"CodRama": 4, "Siniestro": 6, "NroLiquidacion": 1, "CodItemPago": "a", "FechaPago": D(2025, 2, 9), "NroAsegurado": 4, "CodOrganizador": 1, "CodProductor": 2, "Importe": 7.0},
    )
    seen = filled(
        spark, CLAIM_REPORTS,
        {"Op": 1, "CodRama": 4, "Siniestro": 5, "Comp": 1, "FechaDenuncia": D(2025, 1, 7), "CodOrganizador": 1, "CodProductor": 1},
        {"Op": 1, "CodRama": 4, "Siniestro": 8, "Comp": 1, "FechaDenuncia": D(2025, 1, 8), "CodOrganizador": 1, "CodProductor": 1},
    )
    from policy_mart.plans.mart import load_fact

    load_fact(mart, OPERATIONS, ops, D(2025, 1, 1), rollups=[("sehpm151t_perfiles_agg", "FEmisionMes", facts.operations_profile_rollup)])
    load_fact(mart, CLAIM_PAYMENTS, paid, D(2025, 1, 1), rollups=[("sinpagt_perfiles_agg", "FechaPagoMes", facts.claim_payments_rollup), ("sinpagt_agentes_agg", "FechaPagoMes", facts.claim_payments_agents_rollup)])
    load_fact(mart, CLAIM_REPORTS, seen, D(2025, 1, 1))
    persons = filled(
        spark, PERSONS,
        {"NroPersona": 1, "persona_key": 10, "Nombre": "Ana", "version": 1},
        {"NroPersona": 1, "persona_key": 20, "Nombre": "Ana B", "version": 2},
        {"NroPersona": 2, "persona_key": 20, "Nombre": "Aaa", "version": 2},
        {"NroPersona": 3, "persona_key": 3, "Nombre": "Eva", "version": 2},
    )
    persons.write.parquet(mart.path(PERSONS.name))
    filled(spark, PRODUCERS, {"CodProductor": 1, "Nombre": "P1"}).write.parquet(mart.path(PRODUCERS.name))
    # An organizer in two groups has two rows; reports must not count its premium twice.
    filled(
        spark, ORGANIZERS,
        {"CodOrganizador": 1, "Nombre": "O1", "Grupo": "G1", "CodGrupo": 1},
        {"CodOrganizador": 1, "Nombre": "O1", "Grupo": "G2", "CodGrupo": 2},
    ).write.parquet(mart.path(ORGANIZERS.name))
    return mart


def test_person_profile(mart):
    got = {(r.persona_key, r.CodProductor, r.Mes): r for r in reports.person_profile(mart).collect()}
    assert set(got) == {(20, 1, 1), (None, 2, 2)}  # zero premium without claims is dropped
    r = got[20, 1, 1]
    assert (r.PrimaNeta, r.RecAdm, r.RecFin, r.PremioNeto, r.ImporteSiniestro, r.Resultado) == (150.0, 5.0, 0.0, 155.0, 40.0, 115.0)
    assert (r.Nombre, r.NomProductor, r.NomOrganizador, r.GrupoOrganizador, r["Año"]) == ("Ana B", "P1", "O1", "G2", 2025)
    r = got[None, 2, 2]  # claims of an unknown person and without premium
    assert (r.PrimaNeta, r.Resultado, r.NomProductor) == (0.0, -7.0, None)


def test_agents_profile(mart):
    got = {(r.CodRama, r.CodProductor, r.Mes): r for r in reports.agents_profile(mart).collect()}
    assert set(got) == {(4, 1, 1), (7, 9, 1), (4, 2, 2)}
    r = got[4, 1, 1]
    assert (r.PrimaNeta, r.ImporteSiniestro, r.Resultado, r.SiniestrosPagados, r.Denuncias) == (150.0, 40.0, 115.0, 1, 2)
    assert (r.FullOrganizador, r.FullProductor, r.Rama) == ("1 - O1", "1 - P1", "")
    assert got[4, 2, 2].FullProductor is None and got[4, 2, 2].Denuncias == 0


def test_current_persons(mart):
    assert {r.NroPersona: r.persona_key for r in dims.current_persons(mart).collect()} == {1: 20, 2: 20, 3: 3}


def test_best_postal_suffix(mart):
    assert [tuple(r) for r in reports.best_postal_suffix(mart).collect()] == [("BA", 1000, 1)]


def test_rollup_total_is_fact_total(mart):
    fact = mart.table(CLAIM_PAYMENTS).agg(F.sum("Importe")).first()[0]
    kept = mart.spark.read.parquet(mart.path("sinpagt_perfiles_agg")).agg(F.sum("Importe")).first()[0]
    assert fact == kept == 47.0


def test_outer_totals_equal_combined_parts(spark):
    a = spark.createDataFrame([(1, 10.0), (2, 20.0)], "k int, a double")
    b = spark.createDataFrame([(2, 5.0), (3, 7.0)], "k int, b double")
    joined = profiles.outer_totals(a, b, ["k"], ["a", "b"])
    in_units = [df.withColumn(c, units(c)) for df, c in ((a, "a"), (b, "b"))]
    stacked = profiles.combine_measures(in_units, ["k"], ["a", "b"])
    expected = [(1, 10.0, 0.0), (2, 20.0, 5.0), (3, 0.0, 7.0)]
    assert sorted(map(tuple, joined.select("k", "a", "b").collect())) == expected
    assert sorted(map(tuple, stacked.select("k", "a", "b").collect())) == expected


def test_daily_monthly_summary(spark):
    counts = {D(2025, 1, 1): 4, D(2025, 1, 2): 2, D(2025, 1, 3): 4, D(2025, 1, 5): 2, D(2025, 2, 1): 3}
    df = spark.createDataFrame([(d,) for d, n in counts.items() for _ in range(n)], "d date")
    got = {r.Mes: r for r in stats.daily_monthly_summary(df, "d").collect()}
    r = got[202501]
    assert (r.maxFecha, r.Maximo, r.minFecha, r.Minimo) == (D(2025, 1, 1), 4, D(2025, 1, 2), 2)
    assert (r.Dias, r.Promedio, r.Gap, r.Std, r.Q1, r.Q2, r.Q3, r.Cola) == (4, 3.0, 2, 1.0, 2.0, 3.0, 4.0, "N")
    assert (got[202502].Std, got[202502].Cola) == (0.0, "N")


def test_tail_labels(spark):
    def tail(*counts):
        days = [D(2025, 1, i + 1) for i, n in enumerate(counts) for _ in range(n)]
        return stats.daily_monthly_summary(spark.createDataFrame([(d,) for d in days], "d date"), "d").first().Cola

    assert tail(1, 1, 7) == "D" and tail(1, 8, 9) == "I"


def test_best_by_metric_prefers_the_lower_candidate_on_ties(spark):
    df = spark.createDataFrame([("g", 2, 5.0), ("g", 1, 2.0), ("g", 1, 3.0), ("g", 0, None), ("h", 9, -1.0)], "g string, c int, m double")
    assert {r.g: r.c for r in stats.best_by_metric(df, ["g"], "c", "m").collect()} == {"g": 1, "h": 9}


def test_control_row_of_an_empty_rollup(spark):
    fact = spark.createDataFrame([(D(2025, 1, 1),), (D(2025, 3, 1),)], "d date")
    row = rollup.control_row(fact, "d", fact.limit(0), "d").first().asDict()
    assert row == {"min_fact": 202501, "max_fact": 202503, "months_fact": 2, "min_rollup": None, "max_rollup": None, "months_rollup": 0}


@pytest.mark.parametrize("n, shown", [(0, 0), (1, 1), (5, 5), (6, 1), (40, 1)])
def test_missing_summary(spark, n, shown):
    left = spark.createDataFrame([(i, f"v{i}") for i in range(n + 3)], "k int, v string")
    right = spark.createDataFrame([(n,), (n + 1,), (n + 2,)], "k int")
    missing = controls.missing_matches(left, right, ["k"])
    rows = controls.missing_summary(missing).collect()
    assert len(rows) == shown and all(r.Faltantes == n and r.k < n for r in rows)


def test_commission_control(spark):
    base = {"CodRama": 4, "CodProductor": 1, "PrimaNeta": 1.0, "BonifPrima": 5.0, "PrimaTarifa": 100.0, "FEmision": D(2025, 1, 1), "Suplemento": 0}
    rows = [
        base | {"Op": 1, "Poliza": 10},
        base | {"Op": 2, "Poliza": 20},  # commission of type 3 only
        base | {"Op": 3, "Poliza": 30},  # commission of type 4
        base | {"Op": 4, "Poliza": 40, "PrimaTarifa": 0.0},  # no percentage
        base | {"Op": 5, "Poliza": 50, "BonifPrima": 10.0},  # not below the limit
        base | {"Op": 6, "Poliza": 60, "CodProductor": 9999},
        base | {"Op": 7, "Poliza": 70, "PrimaNeta": 0.0},
        base | {"Op": 8, "Poliza": 80, "CodRama": 7},
    ]
    ops = filled(spark, OPERATIONS, *rows).withColumn("CodProductorCom", F.col("CodProductor"))
    com = spark.createDataFrame([(2, 0, 3), (3, 0, 4), (1, 1, 4)], "ICOPER bigint, ICSUOP bigint, ICTINT int")
    got = reports.operations_without_commission(ops, com).collect()
    assert [(r.Op, r["%Bonif."]) for r in got] == [(2, 5.0), (1, 5.0)]


def test_compare_commissions(spark):
    listed = spark.createDataFrame([(1030, "5"), (1040, "6"), (1030, "7")], "codigo_ramo int, nro_poliza string")
    ops = spark.createDataFrame(
        [(4, 5, 100.0, 10.0, 90.0, 1, 2, 9.0, 18.0), (44, 6, 1.0, 1.0, 0.0, 1, 2, 1.0, 1.0), (44, 7, 1.0, 1.0, 5.0, 1, 2, 1.0, 1.0)],
        "cod_rama int, nro_poliza bigint, prima_tarifa double, bon_prima double, prima_neta double, cod_org bigint, cod_prod bigint, com_org double, com_prod double",
    )
    prod = spark.createDataFrame([(2, "P")], "CodProductor bigint, Nombre string")
    org = spark.createDataFrame([(1, "O")], "CodOrganizador bigint, Nombre string")
    got = {r.nro_poliza: r for r in controls.compare_commissions(listed, ops, prod, org).collect()}
    assert (got[5]["%com_org"], got[5]["%com_prod"], got[5]["%com_total"], got[5].nom_org) == (10.0, 20.0, 30.0, "O")
    assert got[6]["%com_total"] is None and got[6].com_total == 2.0
    assert got[7].prima_neta is None and got[7].cod_rama == 4


CASE = "dominio string, poliza string, cliente string, activa int, cod_productor bigint, nom_productor string, cod_organizador bigint, nom_organizador string"


def test_comparison_from_the_mart(mart, spark):
    raw = spark.createDataFrame(
        [(4, 5, 1, 1, 10.0, 90.0, 9.0, 18.0, 2025, 6, 0), (4, 5, 1, 1, 10.0, 90.0, 9.0, 18.0, 2025, 6, 1),
         (4, 5, 1, 1, 10.0, 90.0, 9.0, None, 2025, 7, 0), (4, 5, 1, 1, 10.0, 90.0, 9.0, 18.0, 2025, 5, 0),
         (7, 5, 1, 1, 10.0, 90.0, 9.0, 18.0, 2025, 6, 0)],
        "M1RAMA bigint, M1POLI bigint, M1ORG1 bigint, M1PRO1 bigint, MABPRE double, MAPRIM double, ComOrg double, ComProd double, M1FEMA int, M1FEMM int, M1SUOP int",
    )
    listed = spark.createDataFrame([(1030, 5), (1030, 6)], "codigo_ramo int, nro_poliza int")
    got = reports.commission_comparison(mart, listed, raw).collect()
    assert [(r.nro_poliza, r.prima_tarifa, r.nom_org, r["%com_total"]) for r in got] == [(5, 100.0, "O1", 30.0), (6, None, None, None)]


def test_agents_profile_table(mart, spark):
    for _ in range(2):
        reports.load_agents_profile(mart)
    assert spark.read.parquet(mart.path("ss_perfil_agentes")).count() == 3


def test_enrich_cases(spark):
    cases = spark.createDataFrame(
        [
            ("A", "123456789", "", 1, None, None, None, None),  # longer text, policy 1234567
            ("B", "123456789", "x", 0, 5, "old", 5, "old"),  # same policy: updated too
            ("C", "s/n", "", 1, None, None, None, None),  # no number
            ("D", "77", "", 0, None, None, None, None),  # not active
            ("E", "88", "", 1, None, None, None, None),  # no snapshot in the motor branches
            ("F", "99", "", 1, 1, "keep", None, None),  # unknown producer keeps the old name
        ],
        CASE,
    )
    snapshots = spark.createDataFrame(
        [
            (4, 1234567, D(2025, 1, 1), 1, 1, 1), (44, 1234567, D(2025, 3, 1), 2, 2, 2), (7, 1234567, D(2025, 9, 1), 3, 3, 3),
            (7, 88, D(2025, 1, 1), 1, 1, 1), (4, 77, D(2025, 1, 1), 1, 1, 1), (4, 99, D(2025, 1, 1), 1, 404, 1),
        ],
        "CodRama int, Poliza bigint, Fecha date, NroAsegurado bigint, CodProductor bigint, CodOrganizador bigint",
    )
    persons = spark.createDataFrame([(1, "Uno"), (2, "Dos")], "NroPersona bigint, Nombre string")
    prod = spark.createDataFrame([(1, "P1"), (2, "P2")], "CodProductor bigint, Nombre string")
    org = spark.createDataFrame([(1, "O1"), (2, "O2")], "CodOrganizador bigint, Nombre string")
    got = {r.dominio: r for r in controls.enrich_cases(cases, snapshots, persons, prod, org).collect()}
    for d in "AB":
        assert (got[d].cliente, got[d].cod_productor, got[d].nom_productor, got[d].nom_organizador) == ("Dos", 2, "P2", "O2")
    assert got["C"].cliente == got["D"].cliente == got["E"].cliente == ""
    assert (got["F"].cliente, got["F"].cod_productor, got["F"].nom_productor) == ("Uno", 404, "keep")
    more = controls.enrich_case_producers(cases, snapshots, prod, org, ["CodProductor"]).collect()
    more = {r.dominio: r for r in more}
    assert (more["A"].cod_productor, more["A"].cliente, more["F"].cod_productor) == (2, "", 1)
    assert more["C"].cod_productor is None and more["D"].cod_productor is None


def test_organizers_and_localities(spark):
    raw = spark.createDataFrame(
        [(1, 3, 10, "o'higgins"), (1, 3, 10, "o'higgins"), (2, 3, 11, "LIBRE"), (3, 4, 12, "x"), (4, 3, 13, " ana ")],
        "ININNA bigint, ININTA int, INNRDF bigint, DFNOMB string",
    )
    raw = raw.withColumns({c: F.lit("1") for c in dims.INTERMEDIARY_COLUMNS if c != "DFNOMB"})
    rel = spark.createDataFrame([(1, 7), (4, 8)], "GJINTE bigint, GJGRUP bigint")
    groups = spark.createDataFrame([(7, " norte grande")], "GPGRUP bigint, GPNOGR string")
    got = {r.CodOrganizador: (r.Nombre, r.CodGrupo, r.Grupo) for r in dims.organizers(raw, rel, groups).collect()}
    assert got == {1: ("O'Higgins", 7, "Norte Grande"), 4: ("Ana", None, None)}
    assert dims.organizers(raw, rel, groups).count() == 2
    assert [r.CodProductor for r in dims.producers(raw).collect()] == [3]
    places = spark.createDataFrame([(1, 0, "  VILLA-maria", "B"), (2, 0, "x", "Z")], "LOCOPO bigint, LOCOPS bigint, LOLOCA string, LOPROC string")
    prov = spark.createDataFrame([("B", 2, "buenos aires")], "PRPROC string, PRRPRO bigint, PRPROD string")
    out = {r.Cp: (r.Localidad, r.Provincia) for r in dims.localities(places, prov).collect()}
    assert out == {1: ("Villa-Maria", "Buenos Aires"), 2: ("X", None)}


def test_dimension_loads(spark, tmp_path):
    from policy_mart.schemas import LOCALITIES, OTHER_COVERAGES

    mart = Mart(spark, str(tmp_path))
    prov = spark.createDataFrame([("B", 2, "buenos aires")], "PRPROC string, PRRPRO bigint, PRPROD string")
    for n in (2, 1):
        places = spark.createDataFrame([(i, 0, "x", "B") for i in range(n)], "LOCOPO bigint, LOCOPS bigint, LOLOCA string, LOPROC string")
        dims.load_localities(mart, places, prov)
        assert mart.table(LOCALITIES).count() == n
    cover = spark.createDataFrame([(4, 1, "Robo", 1.5, "x")], "CodRama int, CodCobertura int, Cobertura string, Pormilaje double, Informe string")
    assert dims.load_other_coverages(mart, cover) and not dims.load_other_coverages(mart, cover.limit(0))
    assert mart.table(OTHER_COVERAGES).count() == 1


def test_persons_load(spark, tmp_path):
    mart = Mart(spark, str(tmp_path))
    raw = spark.createDataFrame(
        [(1, "ana", "x", 1, 0, 5000000, "20123456789", "1980-01-01", 1, "S", 0)],
        "DFNRDF bigint, DFNOMB string, DFDOMI string, DFCOPO bigint, DFCOPS bigint, DFNRDO bigint, DFCUIT string, DFFNAC string, DFSEXO int, DFBLOQ string, DFNRD1 bigint",
    )
    dims.load_persons(mart, raw, dt.datetime(2025, 1, 1))
    dims.load_persons(mart, raw.withColumn("DFNOMB", F.lit("eva")), dt.datetime(2025, 1, 2))
    assert mart.table(PERSONS).count() == 2
    got = dims.current_persons(mart).collect()
    assert [(r.Nombre, r.persona_key, r.Bloqueado, r.NroDocumento) for r in got] == [("Eva", 1, 1, "5000000")]
    dims.write_person_reports(mart, raw)
    for name in dims.PERSON_REPORTS:
        assert spark.read.parquet(mart.path(f"person_reports/{name}")).count() == 0


def test_a_claim_of_two_insured_counts_once(spark):
    one = {"CodRama": 4, "Siniestro": 5, "FechaPago": D(2025, 1, 9), "CodOrganizador": 1, "CodProductor": 1, "Importe": 30.0}
    paid = filled(spark, CLAIM_PAYMENTS, one | {"NroAsegurado": 1}, one | {"NroAsegurado": 2})
    got = facts.claim_payments_agents_rollup(paid).collect()
    assert [(r.siniestros_pagados, r.Importe) for r in got] == [(1, 60.0)]
    per_insured = facts.claim_payments_rollup(paid).collect()
    assert [r.siniestros_pagados for r in per_insured] == [1, 1]
