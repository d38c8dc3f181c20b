"""Text columns: trimming, title case, labels and lenient parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A mark that never occurs in source text; it carries word breaks through initcap.
_BREAK = "\u0001 "

_PLAIN_DATES = {  # format -> digits of it, and their order in a date
    "yyyy-M-d": (r"^((?!0000)[0-9]{4})-([0-9]{1,2})-([0-9]{1,2})\z", "$1-$2-$3"),
    "d/M/yyyy": (r"^([0-9]{1,2})/([0-9]{1,2})/((?!0000)[0-9]{4})\z", "$3-$2-$1"),
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove any leading and trailing white space, not only spaces. Most texts show by their ends that there is none."""
    text = _col(c)
    plain = F.substring(text, 1, 1).between("!", "~") & F.substring(text, -1, 1).between("!", "~")
    return F.when(plain, text).otherwise(F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))


def title_case(c: Column | str) -> Column:
    """Upper-case the first letter after every character that is not a letter or digit.

    `initcap` alone breaks words on spaces only, which would give `O'higgins`.
    """
    broken = F.regexp_replace(_col(c), r"([^\p{L}\p{N}])", f"$1{_BREAK}")
    return F.replace(F.initcap(broken), F.lit(_BREAK), F.lit(""))


def clean_name(c: Column | str) -> Column:
    return title_case(strip(c))


def lenient_date(c: Column | str, fmt: str = "yyyy-M-d") -> Column:
    """Parse a date; text that is not one becomes null instead of an error.

    Plain digits are put in order and cast: the parser of formats takes ten times as long to refuse a day
    that no month has.
    """
    text = _col(c)
    parsed = F.try_to_date(text, fmt)
    if fmt not in _PLAIN_DATES:
        return parsed
    plain, ordered = _PLAIN_DATES[fmt]
    return F.when(text.rlike(plain), F.regexp_replace(text, plain, ordered).try_cast("date")).otherwise(parsed)


def decimal_comma(c: Column | str) -> Column:
    """`1.234,56` -> 1234.56; text that is no number becomes null."""
    plain = F.replace(F.replace(strip(c), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return plain.try_cast("double")


def leading_number(c: Column | str, digits: int) -> Column:
    """The first `digits` characters as a number, null where they are not numeric."""
    return F.substring(_col(c).cast("string"), 1, digits).try_cast("bigint")


def labelled(code: Column | str, name: Column | str) -> Column:
    """`12 - Name`; null when either part is null."""
    return F.concat(_col(code).cast("string"), F.lit(" - "), _col(name))
