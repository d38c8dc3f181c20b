"""Yearly rates: age bands, their split into six risks, and premiums prorated by risk.

Risks: R theft, I fire, A accident; t total loss, p partial. A rate row has NumTarifa, Cap, Air,
CodCobertura, segmento_ant, AntMinima, AntMaxima and TasaAnual. Rates are not negative.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import money_sum, or_zero, or_zero_money
from .keyed import join_unique, with_group_stats

RISKS = ("Rt", "It", "Rp", "Ip", "At", "Ap")

# The coverages the split is built on, the coverage prefix left out of the coarse
# pivot, the oldest age, and the rate limits of the split and of the premium report.
BASE_COVERAGES = ("C2", "C4", "C5", "B4", "B5")
EXCLUDED_PREFIX = "D"
OLDEST_AGE = 200
SPLIT_LIMITS = (0.01, 998.0)
REPORT_LIMITS = (0.5, 998.9)

# The report's subtotals.
SUBTOTALS = {
    "Total": ("Rt", "It", "At"),
    "Parcial": ("Rp", "Ip", "Ap"),
    "Robo": ("Rt", "Rp"),
    "Incendio": ("It", "Ip"),
    "Accidente": ("At", "Ap"),
}


def widen_last_band(df: DataFrame, keys: Sequence[str], segment: str, upper: str, widest: int = OLDEST_AGE) -> DataFrame:
    """Let the last segment of each key reach `widest`."""
    last = with_group_stats(df, keys, F.max(segment).alias("__last"))
    is_last = F.col(segment) == F.col("__last")
    return last.withColumn(upper, F.when(is_last, F.lit(widest)).otherwise(F.col(upper))).select(*df.columns)


def conditional_pivot(
    df: DataFrame, keys: Sequence[str], code_col: str, value: str, codes: Sequence[str], prefix: str = "t"
) -> DataFrame:
    """One column per code: its highest value in the group, 0 where the code is missing."""
    cells = [or_zero_money(F.max(F.when(F.col(code_col) == c, F.col(value)))).alias(f"{prefix}{c}") for c in codes]
    return df.groupBy(*keys).agg(*cells)


def decompose_rates(
    current: DataFrame, coverages: DataFrame, limits: tuple[float, float] = SPLIT_LIMITS
) -> DataFrame:
    """Split every rate into the six risks.

    The base coverages' rates count at two grains, within the rate's age segment and over all
    segments, whichever is higher. The highest rate over all segments is never below the one of a
    single segment, so the coarse pivot alone gives the base rates, with one join. Each risk then
    takes what the ones before it left of the rate, up to its own base rate; `Ap` is the rest.
    """
    keys = ["NumTarifa", "Cap", "Air"]
    base = current.filter(~F.col("CodCobertura").startswith(EXCLUDED_PREFIX))
    pivot = conditional_pivot(base, keys, "CodCobertura", "TasaAnual", BASE_COVERAGES)
    kept = current.filter(F.col("TasaAnual").between(*limits))
    rows = join_unique(kept, pivot, keys, match_nulls=True)

    flags = coverages.select("CodCobertura", *[or_zero(r).alias(f"__f{r}") for r in RISKS])
    rows = join_unique(rows, flags, ["CodCobertura"])

    def flag(risk: str) -> Column:
        return or_zero(f"__f{risk}")

    def share(taken: Sequence[str], ceiling: Column) -> Column:
        """What is left of the rate after the risks already `taken`, between 0 and `ceiling`."""
        left = F.col("TasaAnual")
        for risk in taken:
            left = left - F.col(f"Tasa{risk}")
        return F.greatest(F.least(left, ceiling), F.lit(0.0))

    t = {c: or_zero_money(f"t{c}") for c in BASE_COVERAGES}
    steps = [
        ("Rt", ["It"], t["B5"]),
        ("At", ["Rt", "It"], t["C2"] - t["C5"] - t["C4"]),
        ("Ip", ["Rt", "It", "At"], t["C4"] - t["B4"]),
        ("Rp", ["Rt", "It", "At", "Ip"], t["C5"] - t["B5"]),
    ]
    rows = rows.withColumn("TasaIt", t["B4"] * flag("It"))
    for risk, taken, ceiling in steps:
        rows = rows.withColumn(f"Tasa{risk}", share(taken, ceiling) * flag(risk))
    rest = share(["Rt", "It", "At", "Ip", "Rp"], F.col("TasaAnual"))
    enabled = F.least(*t.values()) > 0
    return rows.withColumns({"TasaAp": rest, "Habilitado": enabled.cast("int")}).select(
        *keys, "segmento_ant", "AntMinima", "AntMaxima", "CodCobertura", "TasaAnual", "Habilitado",
        "TasaIt", "TasaRt", "TasaAt", "TasaIp", "TasaRp", "TasaAp",
    )


def rate_band_join(
    df: DataFrame, bands: DataFrame, keys: Sequence[str], value: str, lo: str, hi: str, bin_width: int = 10,
    open_ends: bool = False,
) -> DataFrame:
    """Each row with the bands of its keys that hold its value, both ends included.

    Bands are cut into bins, and the bin joins as one more equality key: a row meets only the bands that
    touch its bin, and a hot key's rows spread over the bins. Bins of `bin_width` serve bands of up to
    `_BINS` bins; wider ones have bins eight times as wide, and so on, so that no band has more than
    `_BINS` + 1 of them, however wide. Bands without an end, or of more levels than `_LEVELS`, join by
    the keys alone. A row is looked up once per level that the bands have, which their table is asked for first.

    A null end holds nothing, as in SQL's BETWEEN; with `open_ends` the band goes on without end there.
    A null value is in no band.
    """
    below, above = F.col(value) >= F.col(lo), F.col(value) <= F.col(hi)
    if open_ends:
        below, above = F.col(lo).isNull() | below, F.col(hi).isNull() | above
        sound = F.coalesce(F.col(lo) <= F.col(hi), F.lit(True))
    else:
        sound = F.col(lo) <= F.col(hi)
    kept = bands.filter(sound).withColumn("__level", _band_level(lo, hi, bin_width))
    levels = sorted(r["__level"] for r in kept.select("__level").distinct().collect())  # _LEVELS + 2 at most
    level_bin = F.lit(None).cast("array<bigint>")
    row_bins = []
    for level in levels:
        width = bin_width * _STEP**level
        whole = F.lit(0).cast("bigint")
        cut = F.array(whole) if level == _OPEN else F.sequence(_bin(lo, width), _bin(hi, width))
        level_bin = F.when(F.col("__level") == level, cut).otherwise(level_bin)
        row_bins.append(F.struct(F.lit(level).alias("__level"), (whole if level == _OPEN else _bin(value, width)).alias("__bin")))
    binned = kept.withColumn("__bin", F.explode(level_bin))
    if not levels:
        rows = df.withColumns({"__level": F.lit(0), "__bin": F.lit(0).cast("bigint")})
    elif len(levels) == 1:
        rows = df.withColumns({"__level": F.lit(levels[0]), "__bin": row_bins[0]["__bin"]})
    else:
        rows = df.withColumn("__at", F.explode(F.array(*row_bins))).select(*df.columns, "__at.__level", "__at.__bin")
    joined = rows.join(binned, [*keys, "__level", "__bin"], "inner")
    return joined.filter(F.col(value).isNotNull() & below & above).drop("__level", "__bin")


#: Bins of a band at its level, by how much the levels' bins grow, and the number of levels; the level of bands without an end.
_BINS, _STEP, _LEVELS, _OPEN = 8, 8, 16, -1


def _band_level(lo: str, hi: str, width: int) -> Column:
    """The first level at which a band has about `_BINS` bins."""
    bins = (F.col(hi).cast("double") - F.col(lo).cast("double")) / width
    level = F.ceil(F.log(float(_STEP), bins / _BINS)).cast("int")
    bounded = bins <= float(_BINS) * float(_STEP) ** _LEVELS
    return F.when(F.coalesce(bounded, F.lit(False)), F.greatest(F.lit(0), level)).otherwise(F.lit(_OPEN))


def _bin(c: str, width: int) -> Column:
    return F.floor(F.col(c) / width).cast("bigint")


def portfolio_premiums(
    premiums: DataFrame, keys: Sequence[str], order_cols: Sequence[str], latest: Mapping[str, str], total: tuple[str, str]
) -> DataFrame:
    """Per component: attributes of its last supplement and the sum of one premium column.

    `latest` maps output names to columns, `total` is (output name, column). One aggregation reads
    the rows once; the last supplement is picked per map task before the shuffle.
    """
    last = F.max_by(
        F.struct(*[F.col(c).alias(n) for n, c in latest.items()]), F.struct(*[F.col(c) for c in order_cols])
    )
    grouped = premiums.groupBy(*keys).agg(
        last.alias("__last"), or_zero_money(money_sum(total[1])).alias(total[0])
    )
    return grouped.select(*keys, *[F.col(f"__last.{n}").alias(n) for n in latest], total[0])


def prorate_risks(df: DataFrame, premium: str, rate: str) -> DataFrame:
    """The premium of each risk, in proportion to its part of the rate, and the subtotals."""
    parts = {r: F.try_divide(F.col(f"Tasa{r}") * F.col(premium), F.col(rate)) for r in RISKS}
    with_parts = df.withColumns(parts)
    sums = {}
    for name, risks in SUBTOTALS.items():
        added = F.col(risks[0])
        for r in risks[1:]:
            added = added + F.col(r)
        sums[name] = added
    return with_parts.withColumns(sums)
