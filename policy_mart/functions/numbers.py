"""Numbers: exact money sums, rounding rules, safe ratios and percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col

# An amount is a whole number of ten-thousandths and a remainder in units of 1e-12. Sums of whole
# numbers do not depend on the order of rows, and amounts of four decimals are summed exactly. The
# ten-thousandths are kept in two sums, of the low bits and of the rest, which leaves room for any
# number of rows: they fail only beyond 9e20, and then with an error.
SCALE = 10_000
REST_SCALE = 1e12
# A remainder this small next to its amount is what a double cannot tell from four decimals.
_NOISE = 4e-15
UNITS_TYPE = "struct<whole:bigint,rest:bigint>"
_LOW_BITS = 20
_LOW_MASK = (1 << _LOW_BITS) - 1


def _whole(c: Column) -> Column:
    return F.rint(c * SCALE).cast("bigint")


def _rest(c: Column) -> Column:
    left = c - _whole(c) / float(SCALE)
    return F.when(F.abs(left) > F.abs(c) * _NOISE, F.rint(left * REST_SCALE).cast("bigint")).otherwise(
        F.lit(0).cast("bigint")
    )


def units(c: Column | str) -> Column:
    """An amount in units: ten-thousandths and the remainder. Null for null."""
    value = _col(c).cast("double")
    return F.when(value.isNotNull(), F.struct(_whole(value).alias("whole"), _rest(value).alias("rest")))


def high_part(whole: Column) -> Column:
    return F.shiftright(whole, _LOW_BITS)


def low_part(whole: Column) -> Column:
    return whole.bitwiseAND(F.lit(_LOW_MASK).cast("bigint"))


def amount(high: Column, low: Column, rest: Column) -> Column:
    """The amount of summed parts; exactly rounded below 9e11 if there is no remainder."""
    whole = (high.cast("double") * float(1 << _LOW_BITS) + low.cast("double")) / SCALE
    return whole + rest.cast("double") / REST_SCALE


def money_sum(c: Column | str) -> Column:
    """Sum of an amount that does not depend on task order or on retries, as sums of doubles do.

    It costs about twice a sum of doubles; a decimal sum costs five times one.
    """
    value = _col(c).cast("double")
    whole = _whole(value)
    return amount(F.sum(high_part(whole)), F.sum(low_part(whole)), F.sum(_rest(value)))


def money_state(c: Column | str) -> Column:
    """What `money_sum` adds up, kept as whole numbers: the states of parts add up to that of the whole."""
    value = _col(c).cast("double")
    whole = _whole(value)
    sums = {"high": high_part(whole), "low": low_part(whole), "rest": _rest(value)}
    return F.struct(*[F.sum(part).alias(name) for name, part in sums.items()])


def merged_state(c: Column | str) -> Column:
    """Sum of states."""
    return F.struct(*[F.sum(_col(c)[name]).alias(name) for name in ("high", "low", "rest")])


def state_amount(c: Column | str) -> Column:
    """The amount that `money_sum` gives for the rows of a state, to the last bit."""
    state = _col(c)
    return amount(state["high"], state["low"], state["rest"])


class UnitSums:
    """Sums of units columns under their names, to be combined exactly after the aggregation."""

    def __init__(self, names):
        self.names = list(names)

    def aggregates(self) -> list[Column]:
        return [
            agg
            for n in self.names
            for agg in (
                F.sum(high_part(F.col(n)["whole"])).alias(f"__high_{n}"),
                F.sum(low_part(F.col(n)["whole"])).alias(f"__low_{n}"),
                F.sum(F.col(n)["rest"]).alias(f"__rest_{n}"),
            )
        ]

    def merged(self) -> list[Column]:
        """Sums of the sums that `aggregates` gave."""
        names = [f"__{kind}_{n}" for n in self.names for kind in ("high", "low", "rest")]
        return [F.sum(c).alias(c) for c in names]

    def total(self, plus, minus=()) -> Column:
        """Amount of the sums of `plus` less those of `minus`; a missing sum counts as 0."""

        def part(kind: str) -> Column:
            value = F.lit(0).cast("bigint")
            for n in plus:
                value = value + or_zero(f"__{kind}_{n}")
            for n in minus:
                value = value - or_zero(f"__{kind}_{n}")
            return value

        return amount(part("high"), part("low"), part("rest"))


def or_zero(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def or_zero_money(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(0.0))


def half_even(c: Column | str, scale: int = 0) -> Column:
    """Round half to even: 0.5 -> 0, 1.5 -> 2, 2.5 -> 2."""
    return F.bround(_col(c), scale)


def truncated(c: Column | str) -> Column:
    """Whole part, towards zero."""
    return _col(c).cast("int")


def percent(part: Column | str, whole: Column | str) -> Column:
    """`part * 100 / whole`, null when `whole` is zero."""
    return F.try_divide(_col(part) * 100, _col(whole))


def net_of_discount(amount: Column | str, pct: Column | str, formula: str = "intended") -> Column:
    """Amount less a percentage.

    `formula="as_loaded"` repeats the file loader's `amount * (100 - pct / 100)`, for comparing
    with data loaded that way.
    """
    if formula == "intended":
        return _col(amount) * (1 - _col(pct) / 100)
    if formula == "as_loaded":
        return _col(amount) * (100 - _col(pct) / 100)
    raise ValueError(f"unknown formula: {formula}")
