"""Writes that die on the way, tables updated in place, versions by difference, compaction by sizes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from policy_mart.files import Files
from policy_mart.functions.dates import MONTH
from policy_mart.operators.load import append_new
from policy_mart.plans import cases, dims, facts, reports
from policy_mart.plans.mart import Mart, load_fact
from policy_mart.schemas import CLAIM_REPORTS, OPERATIONS, ORGANIZERS, PRODUCERS, SNAPSHOTS
from policy_mart.sources import publish, versions, writers
from policy_mart.sources.keyed_table import BUCKET, KeyedTable
from policy_mart.sources.readers import malformed_lines, read_delimited
from policy_mart.sources.writers import append_by_month, compact_fragmented, full_refresh, staged
from pyspark.sql.types import StructType

D = dt.date
SCHEMA = "k bigint, d date, v string"


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def content(spark, path):
    return sorted((r.k, r.v) for r in spark.read.parquet(path).collect())


def files_of(path):
    return {str(f.relative_to(path)) for f in path.rglob("*.parquet")}


class Dies:
    """Lets so many moves happen, then fails."""

    def __init__(self, monkeypatch, after):
        self.left, move = after, Files.move

        def counted(files, path, target):
            if self.left == 0:
                raise RuntimeError("lost")
            self.left -= 1
            move(files, path, target)

        monkeypatch.setattr(Files, "move", counted)


# --- appends


def _reports(spark, *data):
    df = spark.createDataFrame(list(data), "Op bigint, FechaDenuncia date, Siniestro bigint")
    kinds = {f.name: f.dataType for f in CLAIM_REPORTS.schema.fields}
    return df.withColumns({c: F.lit(None).cast(t) for c, t in kinds.items() if c not in df.columns}).withColumn("Comp", F.lit(1))


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_an_append_that_dies_half_way_ends_like_one_clean_run(spark, tmp_path, monkeypatch, moves):
    """Every key has two rows in different months' files and a duplicate; a rerun must not take some for all."""
    source = _reports(spark, *[(k, D(2025, m, 1 + k), 100 * k + s) for k in range(1, 5) for m in (1, 2, 3) for s in (0, 1)])
    clean, torn = Mart(spark, str(tmp_path / "clean")), Mart(spark, str(tmp_path / "torn"))
    load_fact(clean, CLAIM_REPORTS, source)
    with monkeypatch.context() as m:
        Dies(m, moves)
        with pytest.raises(RuntimeError):
            load_fact(torn, CLAIM_REPORTS, source)
    load_fact(torn, CLAIM_REPORTS, source)

    def loaded(mart):
        return sorted((r.Op, r.FechaDenuncia, r.Siniestro) for r in mart.table(CLAIM_REPORTS).collect())

    assert loaded(torn) == loaded(clean) and len(loaded(clean)) == 24
    assert not Files(spark, torn.root).names(f"{torn.path(CLAIM_REPORTS.name)}__staged")


def test_an_append_that_dies_while_writing_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    append_by_month(rows(spark, (1, D(2025, 1, 1), "a")), path, "d")
    bad = rows(spark, (2, D(2025, 1, 2), "b"), (3, D(2025, 2, 2), "x")).withColumn(
        "v", F.when(F.col("v") == "x", F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="lost"):
        append_by_month(bad, path, "d")
    assert content(spark, path) == [(1, "a")]
    # The next load throws the torn folder away.
    append_by_month(rows(spark, (4, D(2025, 2, 1), "d")), path, "d")
    assert content(spark, path) == [(1, "a"), (4, "d")]
    assert not list((tmp_path / "t__staged").iterdir())


def test_appends_give_months_and_keep_duplicates(spark, tmp_path):
    path = str(tmp_path / "t")
    written = append_by_month(rows(spark, (1, D(2025, 1, 1), "a"), (1, D(2025, 1, 1), "a"), (2, D(2025, 3, 1), "b")), path, "d")
    assert (written.rows, written.months) == (3, (202501, 202503))
    new = append_new(rows(spark, (1, D(2025, 1, 9), "z"), (3, D(2025, 3, 1), "c")), spark.read.parquet(path), ["k"], "d", months=[202501, 202503])
    assert [r.k for r in new.collect()] == [3]
    assert append_by_month(rows(spark), path, "d").rows == 0


# --- refreshes


def _counting_source(spark, folder):
    """Ten rows whose every computation leaves a file."""
    folder.mkdir(exist_ok=True)
    where = str(folder)

    def note(batches):
        import uuid

        open(f"{where}/{uuid.uuid4().hex}", "w").close()
        yield from batches

    return spark.range(10, numPartitions=1).mapInArrow(note, "id bigint")


def test_a_guarded_refresh_runs_its_source_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert full_refresh(_counting_source(spark, tmp_path / "runs"), path, guard_empty=True)
    assert len(list((tmp_path / "runs").iterdir())) == 1
    assert not full_refresh(spark.range(0), path, guard_empty=True)
    assert spark.read.parquet(path).count() == 10


def test_a_refresh_whose_source_fails_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    full_refresh(spark.range(5), path)
    with pytest.raises(Exception, match="lost"):
        full_refresh(spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long"))), path)
    assert spark.read.parquet(path).count() == 5
    assert full_refresh(spark.range(7), path) and spark.read.parquet(path).count() == 7
    assert not list((tmp_path / "t__staged").iterdir())


@pytest.mark.parametrize("moves", [0, 1])
def test_a_refresh_that_dies_while_publishing_is_ended(spark, tmp_path, monkeypatch, moves):
    path = str(tmp_path / "t")
    full_refresh(spark.range(5), path)
    with monkeypatch.context() as m:
        Dies(m, moves)
        with pytest.raises(RuntimeError):
            full_refresh(spark.range(9), path)
    assert publish.finish(spark, path) == 1
    assert spark.read.parquet(path).count() == 9
    assert publish.finish(spark, path) == 0 and not list((tmp_path / "t__staged").iterdir())


def test_a_table_may_be_refreshed_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    full_refresh(spark.range(5), path)
    full_refresh(spark.read.parquet(path).selectExpr("id + 10 AS id"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [10, 11, 12, 13, 14]


def test_replaced_months_that_die_half_way_are_ended(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    append_by_month(rows(spark, (1, D(2025, 1, 1), "a"), (2, D(2025, 2, 1), "b"), (3, D(2025, 3, 1), "c")), path, "d")
    new = rows(spark, (9, D(2025, 1, 1), "x"), (8, D(2025, 2, 1), "y")).withColumn(MONTH, F.when(F.col("k") == 9, 202501).otherwise(202502))
    with monkeypatch.context() as m:
        Dies(m, 1)
        with pytest.raises(RuntimeError):
            writers.replace_partitions(new, path)
    publish.finish(spark, path)
    assert content(spark, path) == [(3, "c"), (8, "y"), (9, "x")]


def test_a_staged_copy_goes_with_its_block(spark):
    with staged(spark.range(3), "copy") as copy:
        where = copy.inputFiles()[0].rsplit("/", 1)[0]
        assert copy.count() == 3
    assert not Files(spark, where).exists(where)


# --- tables by key


def _keyed(spark, tmp_path, n=200):
    table = KeyedTable(spark, str(tmp_path / "keyed"), "k", 16)
    table.write(spark.createDataFrame([(f"p{i % 150}" if i else None, i, "old" if i % 2 else None) for i in range(n)], "k string, n int, v string"))
    return table


def test_updates_change_the_rows_of_their_keys_only(spark, tmp_path):
    table = _keyed(spark, tmp_path)
    before, files = {r.n: (r.k, r.v) for r in table.read().collect()}, files_of(tmp_path / "keyed")
    updates = spark.createDataFrame([("p3", "new"), ("p7", None), ("absent", "x"), (None, "y")], "k string, v string")
    assert table.update(updates, ["v"]) == 2  # rows 3 and 153
    after = {r.n: (r.k, r.v) for r in table.read().collect()}
    assert {n: v for n, v in after.items() if v != before[n]} == {3: ("p3", "new"), 153: ("p3", "new")} and len(after) == 200
    now = files_of(tmp_path / "keyed")
    changed = {f.split("/")[0] for f in files ^ now}
    assert len(changed) == 1 and len(now & files) > 10
    # The same update again, and one of nothing, leave every file.
    assert table.update(updates, ["v"]) == 0 and table.update(updates.limit(0), ["v"]) == 0
    assert files_of(tmp_path / "keyed") == now and BUCKET not in table.read().columns


def test_an_update_that_dies_is_ended_by_the_next_use(spark, tmp_path, monkeypatch):
    table = _keyed(spark, tmp_path)
    updates = spark.createDataFrame([(f"p{i}", "new") for i in range(150)], "k string, v string")
    with monkeypatch.context() as m:
        Dies(m, 3)
        with pytest.raises(RuntimeError):
            table.update(updates, ["v"])
    got = {r.n: r.v for r in table.read().collect()}
    assert len(got) == 200 and all(v == "new" for n, v in got.items() if n)


def test_cases_are_filled_in_the_mart(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "mart"))

    def put(table, data, ddl):
        df = spark.createDataFrame(data, ddl)
        missing = {f.name: F.lit(None).cast(f.dataType) for f in table.schema.fields if f.name not in df.columns}
        df = df.withColumns(missing).select(*table.columns)
        (append_by_month(df, mart.path(table.name), table.date_col) if table.by_month else df.write.parquet(mart.path(table.name)))

    put(SNAPSHOTS, [(4, 70, D(2025, 1, 1), 1, 5, 6), (44, 70, D(2025, 2, 1), 2, 7, 8)], "CodRama int, Poliza int, Fecha date, NroAsegurado int, CodProductor int, CodOrganizador int")
    put(OPERATIONS, [(1, 0, 4, 71, D(2025, 1, 1), 9, 6)], "Op int, Suplemento int, CodRama int, Poliza int, FEmision date, CodProductor int, CodOrganizador int")
    put(PRODUCERS, [(7, "Prod 7"), (9, "Prod 9")], "CodProductor int, Nombre string")
    put(ORGANIZERS, [(8, "Org 8", 1), (8, "Org 8", 2), (6, "Org 6", 1)], "CodOrganizador int, Nombre string, CodGrupo int")
    people = spark.createDataFrame([(2, "ana")], "DFNRDF bigint, DFNOMB string").withColumns(
        {c: F.lit(None).cast("string") for c in dims.PERSON_COLUMNS if c not in ("DFNRDF", "DFNOMB")}
    )
    dims.load_persons(mart, people, dt.datetime(2025, 1, 1))
    data = [("A", "0000070 x", "", 1, None), ("B", "0000071", "known", 1, None), ("C", "0000070 x", "", 0, 1), ("D", "none", "", 1, 1)]
    ddl = "dominio string, poliza string, cliente string, activa int, cod_productor bigint, nom_productor string, cod_organizador bigint, nom_organizador string"
    cases.load_cases(mart, spark.createDataFrame([(*d, None, None, None) for d in data], ddl))
    assert cases.fill_clients(mart) == 2 and cases.fill_producers(mart) == 1
    got = {r.dominio: (r.cliente.lower(), r.cod_productor, r.nom_productor, r.nom_organizador) for r in cases.cases_table(mart).read().collect()}
    filled = ("ana", 7, "Prod 7", "Org 8")
    assert got == {"A": filled, "B": ("known", 9, "Prod 9", "Org 6"), "C": filled, "D": ("", 1, None, None)}
    assert cases.fill_clients(mart) == 0 and cases.fill_producers(mart) == 0


# --- versions


VERSIONED = "a bigint, b string, v double, t timestamp"


def _version(spark, *data, at=1):
    return spark.createDataFrame([(*d, dt.datetime(2025, 1, at)) for d in data], VERSIONED)


def test_versions_are_appended_by_difference(spark, tmp_path):
    path, keys, schema = str(tmp_path / "t"), ["a", "b"], StructType.fromDDL(VERSIONED)

    def load(df, version):
        return versions.append_difference(df, path, keys, version, ["t"])

    def now():
        return sorted(((r.a, r.b, r.v) for r in versions.current(spark, path, schema, keys).collect()), key=repr)

    first = [(1, "x", 1.0), (2, "x", None), (None, "n", 3.0), (4, None, 4.0)]
    assert load(_version(spark, *first), 1) == 4
    # The load's time is no change; nothing is appended, and no file is added.
    files = files_of(tmp_path / "t")
    assert load(_version(spark, *first, at=2), 2) == 0 and {f for f in files_of(tmp_path / "t") - files} == set()
    second = [(1, "x", 1.5), (2, "x", None), (None, "n", None), (5, "y", 5.0)]
    assert load(_version(spark, *second, at=3), 3) == 4  # two changed, one new, one gone
    assert now() == sorted(second, key=repr)
    assert load(_version(spark, *first, at=4), 4) == 4  # the gone one is back, the new one gone
    assert now() == sorted(first, key=repr)
    assert versions.versions(spark, path, schema).count() == 12
    versions.compact_versions(spark, path, schema, keys)
    assert now() == sorted(first, key=repr) and versions.versions(spark, path, schema).count() == 4
    assert load(_version(spark, *first, at=5), 5) == 0
    assert load(_version(spark).limit(0), 6) == 4 and now() == []


def test_of_rows_of_one_key_the_last_counts(spark, tmp_path):
    path, schema = str(tmp_path / "t"), StructType.fromDDL(VERSIONED)
    df = _version(spark, (1, "x", 1.0), (1, "x", 9.0), (1, "x", 5.0))
    for _ in range(2):
        versions.append_difference(df, path, ["a", "b"], 1, ["t"], ties=["v"])
    assert [r.v for r in versions.versions(spark, path, schema).collect()] == [9.0]


def test_a_version_that_dies_while_publishing_is_appended_once(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), StructType.fromDDL(VERSIONED)
    df = _version(spark, *[(i, "x", float(i)) for i in range(50)]).repartition(3)
    with monkeypatch.context() as m:
        Dies(m, 0)
        with pytest.raises(RuntimeError):
            versions.append_difference(df, path, ["a"], 1, ["t"])
    assert versions.append_difference(df, path, ["a"], 2, ["t"]) == 0
    assert versions.versions(spark, path, schema).count() == 50


# --- counts per day


def test_the_report_reads_counts_per_day_only(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "mart"))

    def raw(*days):
        df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "Poliza bigint, Fecha date")
        return df.withColumns({n: F.lit(None).cast("string") for n in SNAPSHOTS.columns if n not in df.columns})

    days = [D(2025, 2, 4)] * 3 + [D(2025, 2, 5)] + [D(2025, 3, 1)] * 2
    facts.load_vehicle_snapshots(mart, raw(*days[:3]), D(2025, 3, 9))
    with pytest.MonkeyPatch.context() as m:  # dies between the snapshots and their counts
        m.setattr("policy_mart.plans.mart.refresh_rollup", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            facts.load_vehicle_snapshots(mart, raw(*days), D(2025, 3, 9))
    facts.load_vehicle_snapshots(mart, raw(*days), D(2025, 3, 9))
    report = reports.monthly_vehicle_counts(mart)
    from policy_mart.operators.stats import daily_monthly_summary

    whole = daily_monthly_summary(mart.table(SNAPSHOTS), "Fecha").orderBy(F.desc("Mes"))
    assert report.collect() == whole.collect() and [r.Maximo for r in report.collect()] == [2, 3]
    assert all("/vigentes_vehiculos_dia_cantidad/" in f for f in report.inputFiles())


# --- compaction


def test_months_in_too_many_files_are_rewritten_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(5):
        append_by_month(rows(spark, *[(100 * i + j, D(2025, 1, 1 + i), "a") for j in range(20)]), path, "d")
    append_by_month(rows(spark, (1, D(2025, 2, 1), "b")), path, "d")
    before, files = content(spark, path), files_of(tmp_path / "t")
    assert compact_fragmented(spark, path, sort=["k"]) == {202501: 1}
    assert content(spark, path) == before
    now = files_of(tmp_path / "t")
    assert len([f for f in now if "202501" in f]) == 1 and {f for f in now if "202502" in f} == {f for f in files if "202502" in f}
    assert compact_fragmented(spark, path, sort=["k"]) == {} and files_of(tmp_path / "t") == now


def test_files_are_as_many_as_the_bytes_ask_for(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(12):
        append_by_month(rows(spark, *[(1000 * i + j, D(2025, 1, 1), f"{j * 7919 % 1000}") for j in range(1000)]), path, "d")
    size = writers.month_files(spark, path).first()["bytes"]
    wanted = compact_fragmented(spark, path, file_bytes=size // 3)[202501]
    assert wanted in (3, 4) and writers.month_files(spark, path).first()["files"] == wanted
    assert spark.read.parquet(path).count() == 12000


# --- ANSI files


def test_ansi_signs_and_malformed_lines(spark, tmp_path):
    lines = ["N\x80;Texto;N\x80;Valor", "1;\x93caf\xe9\x94 \x85;x;1,5", "2;corto;y", "3;largo;z;2,5;extra", "4;\x8a\x9f \x81;;", ""]
    (tmp_path / "f.csv").write_bytes("\n".join(lines).encode("iso-8859-1"))
    schema = StructType.fromDDL("n bigint, t string, other string, v double")
    columns = {"N€": "n", "Texto": "t", "N€ (2)": "other", "Valor": "v"}
    got = sorted(map(tuple, read_delimited(spark, str(tmp_path / "f.csv"), columns, schema).collect()))
    assert got == [(1, "“café” …", "x", 1.5), (4, "ŠŸ \x81", None, None)]
    bad = malformed_lines(spark, str(tmp_path / "f.csv"))
    assert sorted(r.line for r in bad.collect()) == ["2;corto;y", "3;largo;z;2,5;extra"] and bad.count() == 2
