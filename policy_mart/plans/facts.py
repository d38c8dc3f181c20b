"""Fact loads: policy operations, claim payments and reports, premiums, vehicle snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_from_parts, from_month
from ..functions.numbers import half_even, money_sum, net_of_discount, or_zero_money, truncated
from ..functions.text import lenient_date, strip
from ..operators.load import first_date
from ..operators.rollup import additive_rollup, claims_rollup
from ..operators.stats import daily_counts
from ..schemas import (
    CLAIM_PAYMENTS,
    CLAIM_REPORTS,
    DAILY_VEHICLES,
    LIFE_PREMIUMS,
    MOTOR_PREMIUMS,
    OPERATIONS,
    OTHER_PREMIUMS,
    SNAPSHOTS,
)
from ..sources.readers import read_delimited
from ..sources.writers import Written
from .mart import Mart, load_fact, load_snapshots

# Source column -> mart column, in the sources' order.
OPERATION_COLUMNS = {
    "M1OPER": "Op",
    "M1SUOP": "Suplemento",
    "M1TIOU": "CodTipoOp",
    "M1STOU": "CodSubTipoOp",
    "M1PVNR": "PlVidaNvaRen",
    "M1RAMA": "CodRama",
    "M1POLI": "Poliza",
    "M1ASEN": "NroAsegurado",
    "M1COPOA": "CpAsegurado",
    "M1COPSA": "CpSufijoAsegurado",
    "M1NOMBA": "NombreAsegurado",
    "M1NOLOA": "LocalidadAsegurado",
    "M1PRLOA": "ProvinciaAsegurado",
    "M1ORG1": "CodOrganizador",
    "M1PRO1": "CodProductor",
    "MASAOP": "SumaAsegurada",
    "MAPRIM": "PrimaNeta",
    "MAREFI": "RecFin",
    "MAREAD": "RecAdm",
    "MADERE": "DerEmision",
    "MASERI": "SellRiesgo",
    "MAIMPI": "ImpInt",
    "MASERS": "ServSoc",
    "MATSSN": "TasaSsn",
    "MAIPR1": "Iva",
    "MAIPR3": "IvaPercepcion",
    "MAIPR4": "IvaRespNoInscr",
    "MABPRI": "BonifPrima",
    "MAIPR2": "Acc",
    "MAIPR5": "RecCapital",
    "CodIntOrg": "CodOrganizadorComision",
    "ComOrg": "ComOrganizador",
    "CodIntProd": "CodProductorComision",
    "ComProd": "ComProductor",
}
OPERATION_DATES = {  # mart column -> year, month and day columns
    "FEmision": ("M1FEMA", "M1FEMM", "M1FEMD"),
    "FVigDesde": ("M1FIOA", "M1FIOM", "M1FIOD"),
    "FVigHasta": ("M1FVOA", "M1FVOM", "M1FVOD"),
}
ORGANIZER_CODES = {3873: 9105}
PRODUCER_CODES = {9105: 3873}
CLAIM_PAYMENT_COLUMNS = {
    "LC_RAMA": "CodRama",
    "LD_SINI": "Siniestro",
    "LC_LIQN": "NroLiquidacion",
    "LD_ITEC": "CodItemPago",
    "LC_FPAG": "FechaPago",
    "DC_CAUC": "CodCausa",
    "PO_ASEN": "NroAsegurado",
    "PO_ORG1": "CodOrganizador",
    "PO_PRO1": "CodProductor",
    "LC_MOVT": "TipoMovimiento",
    "LC_LIQT": "TipoLiquidacion",
    "LC_CLRE": "Clasereserva",
    "LC_ACRT": "TipoAcreedor",
    "LC_ACRC": "CodAcreedor",
    "LC_COMA": "CodMayorAuxiliar",
    "LC_NRMA": "NroMayorAuxiliar",
    "LC_MDPA": "Pagado",
    "LC_MARP": "Proceso",
    "LC_IVSI": "EstadoIngreso",
    "LC_CFRE": "CantFrentes",
    "LD_OPER": "Op",
    "LD_BENN": "NroBeneficiario",
    "LD_TIPR": "TipoReserva",
    "LD_RIEC": "CodRiesgo",
    "LD_COBR": "CoberturaReservada",
    "LD_ITED": "ItemPago",
    "DC_FDEN": "FechaDenuncia",
    "DC_FSIN": "FechaOcurrencia",
    "DC_LUDI": "DireccionSiniestro",
    "DC_COPO": "CpSiniestro",
    "DC_MDFT": "MarcaFueraTermino",
    "DC_TERM": "CodTerminado",
    "DC_COUB": "CodUbicacion",
    "DP_MSFV": "FueraVigencia",
    "DP_MAPA": "PolizaAnulada",
    "DP_MPEC": "EnCaducidad",
    "DP_MCDB": "ComponenteBaja",
    "DP_NRDF": "Conductor",
    "DP_COSN": "CondHabitual",
    "PO_POLI": "Poliza",
    "DP_SUOP": "Supl",
    "LD_POCO": "Comp",
    "C1_COBL": "CodCoberturaAut",
    "C1_VHVU": "SumaAseguradaAut",
    "B1_RPRO": "CodInderProvinciaAut",
    "B1_VHMC": "CodMarcaAu",
    "B1_VHMO": "CodModeloAut",
    "B1_VHA": "AnioVehiculoAut",
    "B1_VHNI": "OrigenVehiculoAut",
    "B1_VHCT": "CodTipoVehiculoAut",
    "B1_VHUV": "CodUsoVehiculoAut",
    "LD_IIAU": "Importe",
}
CLAIM_REPORT_COLUMNS = {
    "DPOPER": "Op",
    "DCRAMA": "CodRama",
    "POPOLI": "Poliza",
    "POPOSP": "Supl",
    "DPPOCO": "Comp",
    "DCSINI": "Siniestro",
    "FEDENU": "FechaDenuncia",
    "FESINI": "FechaSiniestro",
    "DCCAUC": "CodCausa",
    "TACAUD": "Causa",
    "DCLUDI": "DireccionSiniestro",
    "DCCOPO": "CpSiniestro",
    "POORG1": "CodOrganizador",
    "POPRO1": "CodProductor",
    "POASEN": "NroAsegurado",
}
MOTOR_PREMIUM_UNUSED = [
    "AnioMesEmision", "AnioEmision", "MesEmision", "DiaEmision", "estadopoliza", "ant", "relPriPreSupl",
]
OTHER_PREMIUM_COLUMNS = {
    "PremioBrutoSupl": "PremioBrutoSuplemento",
    "PrimaTarifaSupl": "PrimaTarifaSuplemento",
    "PrimaCoberturaEmitida": "PrimaTarifaCobertura",
    "PrimaNetaSupl": "PrimaNetaSuplemento",
    "PrimaCoberturaNeta": "PrimaNetaCobertura",
}
LIFE_PREMIUM_COLUMNS = {
    "PremioBrutoSupl": "PremioBrutoSuplemento",
    "PrimaTarifaSupl": "PrimaTarifaSuplemento",
    "BonPrimaPctSupl": "BonPrimaPctSuplemento",
    "PrimaNetaSupl": "PrimaNetaSuplemento",
}
FILE_COLUMNS = {  # header in the file, where one occurs twice -> mart column
    "FEC_EMI": "FEmision",
    "VIG_DESDE": "FVigDesde",
    "VIG_HASTA": "FVigHasta",
    "NUMERO DE OPERACION": "Op",
    "CODIGO DE RAMA DE SEGURO": "CodRama",
    "NUMERO DE LA POLIZA": "Poliza",
    "SUPLEMENTO DE LA OPERACION": "Supl",
    "NUMERO DE COMPONENTE": "Comp",
    "NUMERO DE INTERMEDIARIO": "CodOrganizador",
    "NUMERO DE INTERMEDIARIO (2)": "CodProductor",
    "CODIGO DE RIESGO": "CodRiesgo",
    "DESCRIPCION DEL RIESGO": "Riesgo",
    "CODIGO DE COBERTURA": "CodCobertura",
    "DESCRIPCION DE LA COBERTURA": "Cobertura",
    "CODIGO DE PROVINCIA": "CodProvincia",
    "SUMA ASEGURADA POR COBERTURA": "SaCobertura",
    "PREMIO BRUTO": "PremioBrutoSuplemento",
    "% BONIFICACION SOBRE PRIMA": "BonPrimaPorc",
    "PORMILAJE DE PRIMA": "Pormilaje",
    "PRIMA DE TARIFA": "PrimaTarifaSuplemento",
    "PRIMA POR COBERTURA": "PrimaTarifaCobertura",
}
FIRST_SNAPSHOT_DAY = dt.date(2025, 2, 4)


def _renamed(raw: DataFrame, columns: dict[str, str]) -> DataFrame:
    return raw.select(*[F.col(source).alias(name) for source, name in columns.items()])


def _recoded(column: str, codes: dict[int, int]):
    value = F.col(column)
    for old, new in codes.items():
        value = F.when(F.col(column) == old, F.lit(new)).otherwise(value)
    return value


def prepare_operations(raw: DataFrame) -> DataFrame:
    """Rename, build the dates from their parts, derive tariff premium and gross price, and
    exchange two intermediary codes. Missing amounts are 0."""
    dates = {name: date_from_parts(*parts) for name, parts in OPERATION_DATES.items()}
    derived = {
        "PrimaTarifa": F.col("MAPRIM") + F.col("MABPRI"),
        "PremioBruto": F.col("MAIPR5") + F.col("MAPREM"),
    }
    named = raw.withColumns({**dates, **derived}).select(
        *[F.col(source).alias(name) for source, name in OPERATION_COLUMNS.items()], *dates, *derived
    )
    amounts = [f.name for f in OPERATIONS.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return named.withColumns(
        {
            "CodOrganizador": _recoded("CodOrganizador", ORGANIZER_CODES),
            "CodProductor": _recoded("CodProductor", PRODUCER_CODES),
            **{c: or_zero_money(c) for c in amounts},
        }
    ).select(*OPERATIONS.columns)


OPERATION_SUMS = [
    "PrimaNeta", "RecFin", "RecAdm", "DerEmision", "SellRiesgo", "ImpInt", "ServSoc", "TasaSsn", "Iva",
    "IvaPercepcion", "IvaRespNoInscr", "BonifPrima", "Acc", "RecCapital", "PrimaTarifa", "PremioBruto",
    "ComOrganizador", "ComProductor",
]
OPERATION_DIMS = [
    "CodRama", "CodOrganizador", "CodProductor", "CodTipoOp", "CodSubTipoOp", "Poliza", "NroAsegurado",
]
OPERATION_PROFILE_DIMS = ["CodRama", "CodOrganizador", "CodProductor", "NroAsegurado"]


def operations_rollup(operations: DataFrame, dims: list[str] = OPERATION_DIMS) -> DataFrame:
    """Monthly sums, the insured sum in whole millions, and the number of operations."""
    extra = {
        "SumaAseguradaMillones": truncated(money_sum("SumaAsegurada") / 1_000_000),
        "Cantidad": F.count(F.lit(1)).cast("int"),
    }
    return additive_rollup(operations, "FEmision", "FEmisionMes", dims, OPERATION_SUMS, extra=extra)


def operations_profile_rollup(operations: DataFrame) -> DataFrame:
    return operations_rollup(operations, OPERATION_PROFILE_DIMS)


def load_operations(mart: Mart, raw: DataFrame, since: dt.date, stop_at_gap: bool = False) -> Written:
    rollups = [
        ("sehpm151t_agg", "FEmisionMes", operations_rollup),
        ("sehpm151t_perfiles_agg", "FEmisionMes", operations_profile_rollup),
    ]
    year, month, _ = OPERATION_DATES["FEmision"]
    recent = raw.filter(from_month(year, month, since))  # the built date can not be filtered by the source
    return load_fact(mart, OPERATIONS, prepare_operations(recent), since, stop_at_gap, rollups)


def prepare_claim_payments(raw: DataFrame) -> DataFrame:
    return _renamed(raw, CLAIM_PAYMENT_COLUMNS).withColumn("CodItemPago", F.trim("CodItemPago"))


def claim_payments_rollup(payments: DataFrame) -> DataFrame:
    dims = ["CodRama", "CodOrganizador", "CodProductor", "NroAsegurado"]
    return claims_rollup(payments, "FechaPago", "FechaPagoMes", dims, "Importe", "Siniestro", fine=["NroAsegurado"])


def claim_payments_agents_rollup(payments: DataFrame) -> DataFrame:
    """At the agents' grain, since numbers of different claims cannot be added over insured."""
    dims = ["CodRama", "CodOrganizador", "CodProductor"]
    return claims_rollup(payments, "FechaPago", "FechaPagoMes", dims, "Importe", "Siniestro")


def load_claim_payments(mart: Mart, raw: DataFrame, stop_at_gap: bool = False) -> Written:
    """Starts at the source's earliest payment; an empty source loads nothing."""
    rows = prepare_claim_payments(raw)
    since = first_date(rows, "FechaPago")
    if since is None:
        return Written(0, ())
    rollups = [
        ("sinpagt_perfiles_agg", "FechaPagoMes", claim_payments_rollup, True),
        ("sinpagt_agentes_agg", "FechaPagoMes", claim_payments_agents_rollup),
    ]
    return load_fact(mart, CLAIM_PAYMENTS, rows, since.replace(day=1), stop_at_gap, rollups)


def load_claim_reports(mart: Mart, raw: DataFrame, since: dt.date, stop_at_gap: bool = False) -> Written:
    return load_fact(mart, CLAIM_REPORTS, _renamed(raw, CLAIM_REPORT_COLUMNS), since, stop_at_gap)


MOTOR_ROLLUP_DIMS = [
    "CodOrganizador", "CodProductor", "CodRama", "CodCoberturaAut", "CodTipoVeh", "CodUsoVeh",
    "AnioComponente", "Origen", "FVigDesde", "FVigHasta", "Op", "Comp", "Supl", "Poliza", "SaComponente",
    "Cap", "Var", "Air",
]
MOTOR_ROLLUP_SUMS = [
    "PrimaTarifaSupl", "BonPrimaSupl", "PremioSupl", "PremioCobradoSupl", "PrimaTarifaComp",
    "PrimaRcTarifaComp", "PrimaCascoTarifaComp", "PrimaNetaComp", "PrimaRcNetaComp", "PrimaCascoNetaComp",
]


def motor_premiums_rollup(premiums: DataFrame) -> DataFrame:
    """The dimensions hold the fact's keys, so there are about as many groups as lines."""
    keys = ["Op", "Comp", "Supl"]
    return additive_rollup(premiums, "FEmision", "FEmisionMes", MOTOR_ROLLUP_DIMS, MOTOR_ROLLUP_SUMS, fine=keys)


def load_motor_premiums(mart: Mart, raw: DataFrame, since: dt.date, stop_at_gap: bool = False) -> Written:
    rows = raw.drop(*MOTOR_PREMIUM_UNUSED)
    rollups = [("primas_automotores_agg", "FEmisionMes", motor_premiums_rollup, True)]
    return load_fact(mart, MOTOR_PREMIUMS, rows, since, stop_at_gap, rollups)


OTHER_ROLLUP_DIMS = [
    "CodRama", "CodOrganizador", "CodProductor", "CodRiesgo", "Riesgo", "CodCobertura", "Cobertura", "CodProvincia",
]


def other_premiums_rollup(premiums: DataFrame) -> DataFrame:
    """Monthly sums per insured sum in millions, rounded half to even, with its extremes."""
    return additive_rollup(
        premiums,
        "FEmision",
        "FEmisionMes",
        OTHER_ROLLUP_DIMS,
        {
            "SaCoberturaSuma": "SaCobertura",
            "PrimaTarifaCobertura": "PrimaTarifaCobertura",
            "PrimaNetaCobertura": "PrimaNetaCobertura",
        },
        buckets={"SaCoberturaMillones": half_even(F.col("SaCobertura") / 1_000_000)},
        extra={"SaCoberturaMin": F.min("SaCobertura"), "SaCoberturaMax": F.max("SaCobertura")},
        fine=["CodProductor", "CodRiesgo", "CodCobertura"],
    )


OTHER_ROLLUPS = [("primas_rvarias_agg_reaseguro", "FEmisionMes", other_premiums_rollup, True)]


def prepare_other_premiums(raw: DataFrame) -> DataFrame:
    """The table has no discount percentage; it is loaded as 0."""
    named = raw.withColumnsRenamed(OTHER_PREMIUM_COLUMNS)
    end = lenient_date(F.col("FVigHasta").cast("string"), "d/M/yyyy")
    return named.withColumns({"FVigHasta": end, "BonPrimaPorc": F.lit(0.0)}).select(*OTHER_PREMIUMS.columns)


def load_other_premiums(mart: Mart, raw: DataFrame, since: dt.date, stop_at_gap: bool = False) -> Written:
    return load_fact(mart, OTHER_PREMIUMS, prepare_other_premiums(raw), since, stop_at_gap, OTHER_ROLLUPS)


def read_premium_file(spark: SparkSession, path: str, formula: str = "intended") -> DataFrame:
    """Other-branch premiums from the delimited export, with the net premiums computed."""
    kinds = {f.name: f for f in OTHER_PREMIUMS.schema.fields}
    raw = read_delimited(spark, path, FILE_COLUMNS, T.StructType([kinds[n] for n in FILE_COLUMNS.values()]))
    return raw.withColumns(
        {
            "PrimaNetaSuplemento": net_of_discount("PrimaTarifaSuplemento", "BonPrimaPorc", formula),
            "PrimaNetaCobertura": net_of_discount("PrimaTarifaCobertura", "BonPrimaPorc", formula),
        }
    ).select(*OTHER_PREMIUMS.columns)


def load_premium_file(mart: Mart, path: str, formula: str = "intended", stop_at_gap: bool = False) -> Written:
    """Starts at the file's earliest month; a file without dates loads nothing."""
    rows = read_premium_file(mart.spark, path, formula)
    since = first_date(rows, "FEmision")
    if since is None:
        return Written(0, ())
    return load_fact(mart, OTHER_PREMIUMS, rows, since.replace(day=1), stop_at_gap, OTHER_ROLLUPS, whole=True)


def load_life_premiums(mart: Mart, raw: DataFrame, since: dt.date, stop_at_gap: bool = False) -> Written:
    return load_fact(mart, LIFE_PREMIUMS, raw.withColumnsRenamed(LIFE_PREMIUM_COLUMNS), since, stop_at_gap)


def prepare_snapshots(raw: DataFrame) -> DataFrame:
    return raw.withColumns({c: strip(c) for c in ("NroMotor", "NroChasis", "Dominio")}).select(*SNAPSHOTS.columns)


def load_vehicle_snapshots(
    mart: Mart, raw: DataFrame, today: dt.date, first: dt.date = FIRST_SNAPSHOT_DAY
) -> Written:
    """Load the missing days up to yesterday, and renew the counts per day of their months."""
    yesterday = today - dt.timedelta(days=1)
    counts = (DAILY_VEHICLES.name, "Fecha", lambda rows: daily_counts(rows, "Fecha", "cantidad"))
    return load_snapshots(mart, SNAPSHOTS, prepare_snapshots(raw), first, yesterday, [counts])
