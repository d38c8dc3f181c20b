"""Table schemas, keys and date columns of the mart.

Spark has no unsigned types, so the sources' 32-bit codes are `bigint`. Amounts are `double` and are
summed as whole numbers of small units (`functions.numbers`).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    keys: tuple[str, ...]
    date_col: str | None = None
    sort: tuple[str, ...] = field(default=())
    #: Keys by which a month's rows are dealt out to tasks; those that share them are stored side by side.
    together: tuple[str, ...] = field(default=())

    @property
    def schema(self) -> T.StructType:
        """Read by Spark's own parser, so a session must be running."""
        return T.StructType.fromDDL(self.ddl)

    @property
    def by_month(self) -> bool:
        """Facts are stored in one partition per month, sorted; dimensions and histories are not."""
        return bool(self.sort)

    @property
    def columns(self) -> list[str]:
        """The names, one column being declared per line."""
        return [line.split()[0].strip("`") for line in self.ddl.strip().splitlines()]


# Table layouts, keys and sort orders.
OPERATIONS = Table(
    "sehpm151t",
    """
    Op bigint,
    Suplemento bigint,
    CodTipoOp bigint,
    CodSubTipoOp bigint,
    PlVidaNvaRen bigint,
    CodRama bigint,
    Poliza bigint,
    NroAsegurado bigint,
    CpAsegurado bigint,
    CpSufijoAsegurado bigint,
    NombreAsegurado string,
    LocalidadAsegurado string,
    ProvinciaAsegurado string,
    CodOrganizador bigint,
    CodProductor bigint,
    SumaAsegurada double,
    PrimaNeta double,
    RecFin double,
    RecAdm double,
    DerEmision double,
    SellRiesgo double,
    ImpInt double,
    ServSoc double,
    TasaSsn double,
    Iva double,
    IvaPercepcion double,
    IvaRespNoInscr double,
    BonifPrima double,
    Acc double,
    RecCapital double,
    FEmision date,
    FVigDesde date,
    FVigHasta date,
    PrimaTarifa double,
    PremioBruto double,
    CodOrganizadorComision bigint,
    ComOrganizador double,
    CodProductorComision bigint,
    ComProductor double
    """,
    ("Op", "Suplemento"),
    "FEmision",
    ("CodOrganizador", "CodProductor", "NroAsegurado", "CpAsegurado", "CpSufijoAsegurado", "Op", "Suplemento"),
)

CLAIM_PAYMENTS = Table(
    "sinpagt",
    """
    CodRama bigint,
    Siniestro bigint,
    NroLiquidacion bigint,
    CodItemPago string,
    FechaPago date,
    CodCausa bigint,
    NroAsegurado bigint,
    CodOrganizador bigint,
    CodProductor bigint,
    TipoMovimiento string,
    TipoLiquidacion string,
    Clasereserva bigint,
    TipoAcreedor string,
    CodAcreedor bigint,
    CodMayorAuxiliar string,
    NroMayorAuxiliar bigint,
    Pagado string,
    Proceso string,
    EstadoIngreso string,
    CantFrentes bigint,
    Op bigint,
    NroBeneficiario bigint,
    TipoReserva string,
    CodRiesgo string,
    CoberturaReservada bigint,
    ItemPago string,
    FechaDenuncia date,
    FechaOcurrencia date,
    DireccionSiniestro string,
    CpSiniestro bigint,
    MarcaFueraTermino string,
    CodTerminado string,
    CodUbicacion string,
    FueraVigencia string,
    PolizaAnulada string,
    EnCaducidad string,
    ComponenteBaja string,
    Conductor bigint,
    CondHabitual string,
    Poliza bigint,
    Supl bigint,
    Comp bigint,
    CodCoberturaAut string,
    SumaAseguradaAut double,
    CodInderProvinciaAut bigint,
    CodMarcaAu string,
    CodModeloAut string,
    AnioVehiculoAut bigint,
    OrigenVehiculoAut string,
    CodTipoVehiculoAut bigint,
    CodUsoVehiculoAut bigint,
    Importe double
    """,
    ("CodRama", "Siniestro", "NroLiquidacion", "CodItemPago"),
    "FechaPago",
    ("CodRama", "CodOrganizador", "CodProductor", "NroAsegurado", "CodCausa", "CodItemPago"),
    ("CodRama", "Siniestro"),
)

CLAIM_REPORTS = Table(
    "denupet",
    """
    Op bigint,
    CodRama bigint,
    Poliza bigint,
    Supl bigint,
    Comp bigint,
    Siniestro bigint,
    FechaDenuncia date,
    FechaSiniestro date,
    CodCausa bigint,
    Causa string,
    DireccionSiniestro string,
    CpSiniestro bigint,
    CodOrganizador bigint,
    CodProductor bigint,
    NroAsegurado bigint
    """,
    ("Op", "Siniestro", "Comp"),
    "FechaDenuncia",
    ("Op", "Siniestro", "Comp"),
)

MOTOR_PREMIUMS = Table(
    "primas_automotores",
    """
    FEmision date,
    FVigDesde date,
    FVigHasta date,
    Op bigint,
    Comp bigint,
    Supl bigint,
    CodRama bigint,
    Poliza bigint,
    SaComponente double,
    Cap bigint,
    Var bigint,
    Air bigint,
    Origen string,
    AnioComponente bigint,
    CodCoberturaAut string,
    CodTipoVeh bigint,
    CodUsoVeh bigint,
    PrimaTarifaSupl double,
    BonPrimaSupl double,
    PremioSupl double,
    PremioCobradoSupl double,
    CodOrganizador bigint,
    CodProductor bigint,
    PrimaTarifaComp double,
    PrimaRcTarifaComp double,
    PrimaCascoTarifaComp double,
    PrimaNetaComp double,
    PrimaRcNetaComp double,
    PrimaCascoNetaComp double
    """,
    ("Op", "Supl", "Comp"),
    "FEmision",
    ("Op", "CodRama", "Poliza", "Supl", "Comp", "CodCoberturaAut"),
    ("Op",),
)

OTHER_PREMIUMS = Table(
    "primas_rvarias",
    """
    FEmision date,
    FVigDesde date,
    FVigHasta date,
    Op bigint,
    CodRama bigint,
    Poliza bigint,
    Supl bigint,
    Comp bigint,
    CodOrganizador bigint,
    CodProductor bigint,
    CodRiesgo bigint,
    Riesgo string,
    CodCobertura bigint,
    Cobertura string,
    CodProvincia string,
    SaCobertura double,
    PremioBrutoSuplemento double,
    BonPrimaPorc double,
    Pormilaje double,
    PrimaTarifaSuplemento double,
    PrimaTarifaCobertura double,
    PrimaNetaSuplemento double,
    PrimaNetaCobertura double
    """,
    ("Op", "Supl", "Comp", "CodCobertura"),
    "FEmision",
    ("CodRama", "CodOrganizador", "CodProductor", "CodCobertura", "CodProvincia"),
    ("Op",),
)

LIFE_PREMIUMS = Table(
    "primas_vida",
    """
    FEmision date,
    FVigDesde date,
    Op bigint,
    CodRama bigint,
    Poliza bigint,
    Supl bigint,
    Comp bigint,
    CodOrganizador bigint,
    CodProductor bigint,
    CodCobertura bigint,
    Cobertura string,
    CodProvincia string,
    SaSupl double,
    PremioBrutoSuplemento double,
    PrimaTarifaSuplemento double,
    BonPrimaPctSuplemento double,
    PrimaNetaSuplemento double,
    PrimaTarifaCobertura double,
    PrimaNetaCobertura double
    """,
    ("Op", "Supl", "Comp", "CodCobertura"),
    "FEmision",
    ("CodRama", "CodOrganizador", "CodProductor", "CodCobertura", "CodProvincia"),
    ("Op",),
)

SNAPSHOTS = Table(
    "vigentes_vehiculos_dia",
    """
    CodOrganizador bigint,
    CodProductor bigint,
    CodRama bigint,
    Poliza bigint,
    Supl bigint,
    Componente bigint,
    FVigDesde date,
    FVigHasta date,
    NroAsegurado bigint,
    NomAsegurado string,
    CpAsegurado bigint,
    CpSufijoAsegurado bigint,
    CodMarca string,
    CodModelo string,
    CodSubModelo string,
    Marca string,
    Modelo string,
    SubModelo string,
    CvaCapitulo bigint,
    CvaVariante bigint,
    CvaDescripcion string,
    AnioVehiculo bigint,
    CodUsoVehiculo bigint,
    CodTipoVehiculo bigint,
    CodCoberturaAut string,
    SumaAsegurada double,
    NroMotor string,
    NroChasis string,
    Origen string,
    NroPersonaPagador bigint,
    NroPersonaTomador bigint,
    CodCarroceria string,
    NomProductor string,
    DomicilioProductor string,
    CpProductor bigint,
    CpSufijoProductor bigint,
    LocalidadProductor string,
    CodProvinciaProductor string,
    ProvinciaProductor string,
    CodProvinciaInderProductor bigint,
    MatriculoProductor bigint,
    CodGrupoOrganizador bigint,
    GrupoOrganizador string,
    TarifaMadreLetra string,
    TarifaHija bigint,
    Dominio string,
    Ant int,
    Fecha date
    """,
    ("Fecha", "CodRama", "Poliza", "Componente"),
    "Fecha",
    ("Fecha", "CodOrganizador", "CodProductor", "CodCoberturaAut", "NroAsegurado"),
)

DAILY_VEHICLES = Table(
    "vigentes_vehiculos_dia_cantidad",
    """
    Fecha date,
    cantidad bigint
    """,
    ("Fecha",),
    "Fecha",
    ("Fecha",),
)

PERSONS = Table(
    "dim_daf",
    """
    NroPersona bigint,
    persona_key bigint,
    Cuit string,
    NroDocumento string,
    Sexo string,
    Nombre string,
    Domicilio string,
    Cp string,
    CpSufijo string,
    Bloqueado smallint,
    EsDelegado smallint,
    last_update timestamp,
    version bigint
    """,
    ("NroPersona",),
)

ORGANIZERS = Table(
    "dim_organizadores",
    """
    CodOrganizador bigint,
    NroPersona bigint,
    Nombre string,
    Domicilio string,
    Cp bigint,
    CpSufijo bigint,
    Localidad string,
    CodProvincia string,
    TipoDoc string,
    NroDoc bigint,
    Cuit string,
    Provincia string,
    CodInderProvincia string,
    Matricula bigint,
    CodGrupo bigint,
    Grupo string
    """,
    ("CodOrganizador",),
)

PRODUCERS = Table(
    "dim_productores",
    """
    CodProductor bigint,
    NroPersonaProductor bigint,
    Nombre string,
    Domicilio string,
    Cp bigint,
    CpSufijo bigint,
    Localidad string,
    CodProvincia string,
    TipoDoc string,
    NroDoc bigint,
    Cuit string,
    Provincia string,
    CodInderProvincia string,
    Matricula bigint
    """,
    ("CodProductor",),
)

LOCALITIES = Table(
    "dim_localidades",
    """
    Cp bigint,
    CpSufijo bigint,
    Localidad string,
    CodProvinciaStr string,
    CodProvInder bigint,
    Provincia string
    """,
    ("Cp", "CpSufijo"),
)

MOTOR_COVERAGES = Table(
    "dim_coberturas_aut",
    """
    CodCobertura string,
    OrCobertura bigint,
    CatCobertura string,
    OrCatCobertura bigint,
    Rt int,
    Rp int,
    It int,
    Ip int,
    At int,
    Ap int,
    version bigint
    """,
    ("CodCobertura",),
)

OTHER_COVERAGES = Table(
    "dim_coberturas_rv",
    """
    CodRama bigint,
    CodCobertura bigint,
    Cobertura string,
    Pormilaje double,
    Informe string
    """,
    ("CodRama", "CodCobertura"),
)

RATES = Table(
    "dim_tasas_scd",
    """
    NumTarifa bigint,
    Cap bigint,
    Air bigint,
    CodCobertura string,
    segmento_ant bigint,
    AntMinima bigint,
    AntMaxima bigint,
    TasaAnual double,
    fecha_desde date
    """,
    ("NumTarifa", "Cap", "Air", "CodCobertura", "segmento_ant"),
    "fecha_desde",
)

LIABILITY_RATES = Table(
    "dim_rc_scd",
    """
    NumTarifa bigint,
    Cap bigint,
    Var bigint,
    RcSl double,
    RcCl double,
    RcExt double,
    RcAp double,
    RcObl double,
    fecha_desde date
    """,
    ("NumTarifa", "Cap", "Var"),
    "fecha_desde",
)

RATES_BY_RISK = Table(
    "tasas_aut_x_riesgo",
    """
    NumTarifa bigint,
    Cap bigint,
    Air bigint,
    segmento_ant bigint,
    AntMinima bigint,
    AntMaxima bigint,
    CodCobertura string,
    TasaAnual double,
    Habilitado int,
    TasaIt double,
    TasaRt double,
    TasaAt double,
    TasaIp double,
    TasaRp double,
    TasaAp double
    """,
    ("NumTarifa", "Cap", "Air", "segmento_ant", "CodCobertura"),
)
