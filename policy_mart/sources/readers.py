"""Typed reads: parquet tables, database tables, delimited files and parameterised SQL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import Files
from ..functions.text import decimal_comma, lenient_date, strip


#: "ANSI" as Windows programs in Western Europe and America write it.
ANSI = "windows-1252"
_MALFORMED = "_malformed"


def _observed(df: DataFrame, rejected: Observation | None, parsed: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Count, in the same pass, the values per column that are there but do not parse."""
    if rejected is None or not parsed:
        return df
    counts = [F.count_if(raw.isNotNull() & value.isNull()).alias(name) for name, (raw, value) in parsed.items()]
    return df.observe(rejected, *counts)


def cast_to(df: DataFrame, schema: T.StructType, rejected: Observation | None = None) -> DataFrame:
    """The schema's columns with its types. Text that does not fit becomes null, and `rejected`
    gets the number of such values per column; a numeric overflow is an error, since it would lose
    data."""
    kinds = dict(df.dtypes)
    texts = [f for f in schema.fields if kinds[f.name] == "string" and not isinstance(f.dataType, T.StringType)]
    parsed = {f.name: (F.col(f.name), F.col(f.name).try_cast(f.dataType)) for f in texts}

    def typed(field: T.StructField):
        if field.name in parsed:
            return parsed[field.name][1].alias(field.name)
        return F.col(field.name).cast(field.dataType).alias(field.name)

    return _observed(df, rejected, parsed).select(*[typed(f) for f in schema.fields])


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if schema is None else cast_to(df, schema)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows where nothing has been written yet."""
    if not Files(spark, path).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def jdbc_options(
    url: str, table: str, split: tuple[str, Any, Any, int] | None = None, fetch_rows: int = 10_000
) -> dict[str, str]:
    """Options of a database scan. `table` is a name or a `(query) alias`.

    `split` (column, lowest, highest, parts) reads in parallel ranges; without it one task reads
    the whole table, so give it for every fact.
    """
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_rows)}
    if split is not None:
        column, low, high, parts = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(parts),
        }
    return options


def read_jdbc(
    spark: SparkSession, options: Mapping[str, str], schema: T.StructType | None = None
) -> DataFrame:
    """Database scan. Filters and column choices on the result are sent to the database."""
    df = spark.read.format("jdbc").options(**options).load()
    return df if schema is None else cast_to(df, schema)


def query(spark: SparkSession, sql: str, **parameters: Any) -> DataFrame:
    """SQL with named parameters (`:fecha`), bound as values and never as text."""
    return spark.sql(sql, args=parameters)


def _headers(names: Sequence[str]) -> list[str]:
    """The file's own headers, with `X (2)` for the second column of the same header `X`.

    Spark tells equal headers apart by adding each one's position.
    """
    bare = [n.removesuffix(str(i)) for i, n in enumerate(names)]
    headers: list[str] = []
    for name, base in zip(names, bare):
        header = base if bare.count(base) > 1 else name
        earlier = sum(h == header or h.startswith(f"{header} (") for h in headers)
        headers.append(f"{header} ({earlier + 1})" if earlier else header)
    return headers


def _ansi_signs() -> tuple[str, str]:
    """The bytes 0x80 to 0x9F as ISO-8859-1 reads them, and what windows-1252 has there; five are unused."""
    pairs = [(chr(b), bytes([b]).decode("cp1252", "ignore")) for b in range(0x80, 0xA0)]
    used = [(read, meant) for read, meant in pairs if meant]
    return "".join(r for r, _ in used), "".join(m for _, m in used)


def _decoded(text: Column, encoding: str) -> Column:
    if encoding != ANSI:
        return text
    # Text of as many bytes as characters is ASCII and has none of the signs.
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(F.translate(text, *_ansi_signs()))


def _delimited(spark: SparkSession, path: str, sep: str, encoding: str) -> tuple[list[str], DataFrame]:
    """The headers, and the lines as texts `_c0`, `_c1`, ..., with `_MALFORMED` set to the whole line
    where it has more or fewer fields than there are headers.

    Spark does not know windows-1252, which differs from ISO-8859-1 in 27 bytes; these are put right.
    """
    reader = spark.read.option("sep", sep).option("header", True).option("encoding", "ISO-8859-1" if encoding == ANSI else encoding)
    found = reader.csv(path).columns
    names = [f"_c{i}" for i in range(len(found))]
    texts = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _MALFORMED]])
    # All fields have to be parsed for their number to be known.
    lines = reader.schema(texts).option("columnNameOfCorruptRecord", _MALFORMED).option("columnPruning", False).csv(path)
    signs = dict(zip(*_ansi_signs(), strict=True)) if encoding == ANSI else {}
    headers = ["".join(signs.get(c, c) for c in h) for h in _headers(found)]
    return headers, lines.select(*[_decoded(F.col(n), encoding).alias(n) for n in texts.names])


def malformed_lines(spark: SparkSession, path: str, sep: str = ";", encoding: str = ANSI) -> DataFrame:
    """The lines (`line`) that `read_delimited` leaves out."""
    _, lines = _delimited(spark, path, sep, encoding)
    # Spark refuses a query that reads no other column; the second condition is never true.
    found = F.col(_MALFORMED).isNotNull() | F.col("_c0").rlike("(?!)")
    return lines.filter(found).select(F.col(_MALFORMED).alias("line"))


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str],
    schema: T.StructType,
    sep: str = ";",
    encoding: str = ANSI,
    date_format: str = "d/M/yyyy",
    rejected: Observation | None = None,
) -> DataFrame:
    """Delimited file with a header, decimal commas and day-first dates.

    `columns` maps headers to the schema's columns; the second column of a repeated header `X` is
    `X (2)`. Other columns are left out, and values that do not parse become null; `rejected` gets
    the number of such values per column. Lines with too many or too few fields are left out, since
    their values may stand in the wrong columns; `malformed_lines` has them.
    """
    headers, lines = _delimited(spark, path, sep, encoding)
    sound = lines.filter(F.col(_MALFORMED).isNull())
    raw = sound.select(*[F.col(f"_c{headers.index(h)}").alias(n) for h, n in columns.items()])

    def parsed(field: T.StructField):
        if isinstance(field.dataType, T.DoubleType):
            value = decimal_comma(field.name)
        elif isinstance(field.dataType, T.DateType):
            value = lenient_date(strip(field.name), date_format)
        elif isinstance(field.dataType, T.StringType):
            value = F.col(field.name)
        else:
            value = strip(field.name).try_cast(field.dataType)
        return value.alias(field.name)

    filled = {f.name: F.when(strip(f.name) != "", strip(f.name)) for f in schema.fields if not isinstance(f.dataType, T.StringType)}
    checked = {f.name: (filled[f.name], parsed(f)) for f in schema.fields if f.name in filled}
    return _observed(raw, rejected, checked).select(*[parsed(f) for f in schema.fields])
