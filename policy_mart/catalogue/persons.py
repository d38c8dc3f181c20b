"""Person identity and its reports over persons derived from customer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import identity
from ..plans.dims import PERSON_COLUMNS, current_persons, load_persons
from ..plans.mart import Mart
from ..sources import versions
from ..workdir import work_dir
from .registry import query
from .standins import PERSONS_SQL, raw_persons

# Short ranges, so that groups have several lists at small scale factors.
_LIST = 40


def _normalised(spark, sf_dir):
    return identity.normalise_persons(raw_persons(spark, sf_dir))


def _report(df, *lists):
    """Member lists as text, so that engines compare them alike."""
    return df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in lists})


_RESOLVED_SQL = f"""
{PERSONS_SQL},
h AS (SELECT *, NroPersona IN (SELECT Grupo FROM persons) AS head FROM persons),
f AS (SELECT * REPLACE (CASE WHEN head THEN NroPersona ELSE Grupo END AS Grupo, CASE WHEN head AND Bloqueado = 'S' THEN '_' ELSE Bloqueado END AS Bloqueado) FROM h),
w1 AS (SELECT *, count(*) OVER c AS n, min(Grupo) OVER c AS lo, max(Grupo) OVER c AS hi, max(NroPersona) OVER c AS p FROM f WINDOW c AS (PARTITION BY Cuit)),
m1 AS (SELECT * EXCLUDE (n, lo, hi, p) REPLACE (CASE WHEN NOT mal_cuit AND n > 1 AND lo <> hi THEN hi WHEN NOT mal_cuit AND n > 1 AND hi = 0 THEN p ELSE Grupo END AS Grupo) FROM w1),
w2 AS (SELECT *, count(*) OVER c AS n, min(Grupo) OVER c AS lo, max(Grupo) OVER c AS hi, max(NroPersona) OVER c AS p FROM m1 WINDOW c AS (PARTITION BY NroDocumento, Sexo)),
resolved AS (SELECT *, CASE WHEN NOT mal_doc AND n > 1 AND lo <> hi THEN hi WHEN NOT mal_doc AND n > 1 AND hi = 0 THEN p WHEN Grupo = 0 THEN NroPersona ELSE Grupo END AS persona_key FROM w2)"""


@query(
    "person_groups",
    f"""
WITH {_RESOLVED_SQL}
SELECT NroPersona, persona_key, Cuit, CAST(NroDocumento AS VARCHAR) AS NroDocumento, Sexo, Nombre, Domicilio, CAST(Cp AS VARCHAR) AS Cp,
  CAST(CpSufijo AS VARCHAR) AS CpSufijo, CAST(Bloqueado = 'S' AS SMALLINT) AS Bloqueado, CAST(head AS SMALLINT) AS EsDelegado FROM resolved
""",
)
def person_groups(spark, sf_dir):
    return identity.resolve_persons(raw_persons(spark, sf_dir))


@query(
    "person_current",
    f"""
WITH {_RESOLVED_SQL}
SELECT NroPersona, persona_key, Cuit, CAST(NroDocumento AS VARCHAR) AS NroDocumento, Sexo, Nombre, Domicilio, CAST(Cp AS VARCHAR) AS Cp,
  CAST(CpSufijo AS VARCHAR) AS CpSufijo, CAST(Bloqueado = 'S' AS SMALLINT) AS Bloqueado, CAST(head AS SMALLINT) AS EsDelegado FROM resolved
""",
)
def person_current(spark, sf_dir):
    """Every person's latest version after two loads, the first with all persons blocked."""
    mart = Mart(spark, work_dir(spark, "persons"))
    raw = raw_persons(spark, sf_dir).withColumnsRenamed({name: source for source, name in PERSON_COLUMNS.items()})
    load_persons(mart, raw.withColumn("DFBLOQ", F.lit("S")), dt.datetime(2024, 1, 1))
    load_persons(mart, raw, dt.datetime(2024, 2, 1))
    return current_persons(mart).drop("last_update")


_VERSIONED = ["NroPersona", "Nombre", "Domicilio", "Cp", "Bloqueado"]


@query(
    "person_versions",
    f"""
WITH {PERSONS_SQL}
SELECT NroPersona, Nombre, Domicilio, Cp, CASE WHEN NroPersona % 3 = 0 THEN 'S' ELSE Bloqueado END AS Bloqueado FROM persons WHERE NroPersona % 5 <> 0
""",
)
def person_versions(spark, sf_dir):
    """Persons appended by difference: all, the same again (no rows), then some blocked and others gone;
    current after the old versions were dropped."""
    path = work_dir(spark, "person-versions")
    first = _normalised(spark, sf_dir).select(*_VERSIONED)
    schema = first.schema

    def load(rows, version):
        return versions.append_difference(rows, path, ["NroPersona"], version)

    load(first, 1)
    assert load(first, 2) == 0
    blocked = F.when(F.col("NroPersona") % 3 == 0, "S").otherwise(F.col("Bloqueado"))
    load(first.filter("NroPersona % 5 <> 0").withColumn("Bloqueado", blocked), 3)
    versions.compact_versions(spark, path, schema, ["NroPersona"])
    return versions.current(spark, path, schema, ["NroPersona"])


@query(
    "person_reports_1",
    f"""
WITH {PERSONS_SQL},
g AS (SELECT Grupo, count(*) FILTER (Bloqueado = '_') AS "No Bloqueados", count(*) FILTER (Bloqueado = 'S') AS Bloqueados FROM persons WHERE Grupo > 0 GROUP BY ALL)
SELECT Grupo, Nombre, NroPersona, NroDocumento, Cuit, Bloqueado, "No Bloqueados", Bloqueados FROM persons JOIN g USING (Grupo) WHERE "No Bloqueados" > 1
""",
)
def report_1(spark, sf_dir):
    return identity.groups_with_several_unblocked(_normalised(spark, sf_dir))


_PERSON_COLUMNS = "NroPersona, Nombre, Domicilio, Cp, CpSufijo, NroDocumento, Cuit, FechaNac, Sexo, Bloqueado, Grupo"


@query(
    "person_reports_2",
    f"""
WITH {PERSONS_SQL}
SELECT {_PERSON_COLUMNS} FROM persons WHERE NroPersona IN (SELECT Grupo FROM persons) AND NroPersona <> Grupo
""",
)
def report_2(spark, sf_dir):
    return identity.heads_in_another_group(_normalised(spark, sf_dir))


_LISTS_SQL = f"""
size AS (SELECT Grupo, count(DISTINCT NroPersona) AS PersonasEnElGrupo FROM persons WHERE Grupo > 0 GROUP BY ALL),
lists AS (SELECT Grupo, NroPersona // {_LIST} AS Tramo, string_agg(CAST(NroPersona AS VARCHAR), ',' ORDER BY NroPersona) AS Personas_del_grupo
  FROM (SELECT DISTINCT Grupo, NroPersona FROM persons WHERE Grupo > 0) GROUP BY ALL)"""


@query(
    "person_reports_3",
    f"""
WITH {PERSONS_SQL}, {_LISTS_SQL}
SELECT {_PERSON_COLUMNS}, PersonasEnElGrupo, Tramo, Personas_del_grupo
FROM persons JOIN size USING (Grupo) JOIN lists USING (Grupo) WHERE NroPersona IN (SELECT Grupo FROM persons) AND Bloqueado = 'S'
""",
)
def report_3(spark, sf_dir):
    """Blocked heads with the lists of their groups' members."""
    return _report(identity.blocked_heads(_normalised(spark, sf_dir), _LIST), "Personas_del_grupo")


@query(
    "person_member_lists",
    f"""
WITH {PERSONS_SQL}, {_LISTS_SQL}
SELECT Grupo, PersonasEnElGrupo, Tramo, Personas_del_grupo FROM lists JOIN size USING (Grupo)
""",
)
def member_lists(spark, sf_dir):
    return _report(identity.group_member_lists(_normalised(spark, sf_dir), _LIST), "Personas_del_grupo")


@query(
    "person_reports_4",
    f"""
WITH {PERSONS_SQL},
v AS (SELECT * FROM persons WHERE NOT (mal_cuit AND mal_doc)),
w AS (SELECT *, CASE WHEN NOT mal_cuit THEN count(*) OVER (PARTITION BY Cuit) END AS Pers_x_Cuit, max(Grupo) OVER (PARTITION BY Cuit) AS MaxGrupo_x_Cuit,
  CASE WHEN NOT mal_doc THEN count(*) OVER (PARTITION BY NroDocumento) END AS Pers_x_Dni, max(Grupo) OVER (PARTITION BY NroDocumento) AS MaxGrupo_x_Dni FROM v)
SELECT {_PERSON_COLUMNS}, Pers_x_Dni, MaxGrupo_x_Dni, Pers_x_Cuit, MaxGrupo_x_Cuit FROM w
WHERE Pers_x_Dni > 1 AND MaxGrupo_x_Dni = 0 AND Pers_x_Cuit > 1 AND MaxGrupo_x_Cuit = 0
""",
)
def report_4(spark, sf_dir):
    return identity.duplicates_without_group(_normalised(spark, sf_dir))


@query(
    "person_reports_5",
    f"""
WITH {PERSONS_SQL},
v AS (SELECT * FROM persons WHERE NOT (mal_cuit AND mal_doc)),
c AS (SELECT Cuit, count(*) AS Pers_x_Cuit, count(DISTINCT Grupo) AS Gru_x_Cuit FROM v WHERE NOT mal_cuit GROUP BY ALL),
d AS (SELECT NroDocumento, count(*) AS Pers_x_Dni, count(DISTINCT Grupo) AS Gru_x_Dni FROM v WHERE NOT mal_doc GROUP BY ALL),
w AS (SELECT v.*, Pers_x_Cuit, Gru_x_Cuit, Pers_x_Dni, Gru_x_Dni FROM v LEFT JOIN c USING (Cuit) LEFT JOIN d USING (NroDocumento) WHERE Gru_x_Dni > 1 OR Gru_x_Cuit > 1)
SELECT {', '.join('w.' + c.strip() for c in _PERSON_COLUMNS.split(','))}, Pers_x_Cuit, Gru_x_Cuit, Pers_x_Dni, Gru_x_Dni,
  h.Nombre AS Nombre_grupo, h.NroDocumento AS NroDocumento_grupo, h.Cuit AS Cuit_grupo, h.Bloqueado AS Bloqueado_grupo
FROM w LEFT JOIN persons h ON w.Grupo = h.NroPersona
""",
)
def report_5(spark, sf_dir):
    return identity.incoherent_groups(_normalised(spark, sf_dir))
