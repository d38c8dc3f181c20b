"""Streamed rollups and projections over the driver's events, compared with their batch results."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import MONTH
from ..operators.rollup import claims_rollup
from ..streaming.maintain import (
    current_so_far,
    rollup_so_far,
    stream_append,
    stream_current,
    stream_rollup,
    streamed_fact,
)
from ..workdir import work_dir
from .registry import query, table, total
from .standins import day


_BATCHES = 3


def _in_batches(rows, key):
    """A table as a stream of files that comes in several batches, each with rows of all dates."""
    path = work_dir(rows.sparkSession, "stream-source")
    rows.repartition(2 * _BATCHES, key).write.parquet(path)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)


def event_stream(spark, sf_dir):
    return _in_batches(table(spark, sf_dir, "events"), "event_id").withColumn("day", day("ts"))


@query(
    "stream_rollup",
    f"SELECT CAST(ts AS DATE) AS day, event_type, {total('value', 'value')}, count(*) AS n FROM events GROUP BY ALL",
)
def rollup(spark, sf_dir):
    """Events per day and type, summed batch by batch."""
    path = work_dir(spark, "stream-rollup")
    stream_rollup(
        event_stream(spark, sf_dir), f"{path}/table", f"{path}/checkpoint", "day", "day", ["event_type"],
        {"value": "value"}, "n", by=F.col("day"),
    ).awaitTermination()
    return rollup_so_far(spark, f"{path}/table", ["day", "event_type"], ["value"], ["n"])


@query(
    "stream_current",
    """
SELECT user_id, event_id, event_type, value, CAST(ts AS DATE) AS day FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""",
)
def current(spark, sf_dir):
    """Latest event per user, kept batch by batch."""
    path = work_dir(spark, "stream-current")
    stream_current(
        event_stream(spark, sf_dir), f"{path}/table", f"{path}/checkpoint", ["user_id"], ["ts", "event_id"]
    ).awaitTermination()
    newest = current_so_far(spark, f"{path}/table", ["user_id"], ["ts", "event_id"])
    return newest.select("user_id", "event_id", "event_type", "value", "day")


@query(
    "stream_append",
    """
SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day, CAST(year(ts) * 100 + month(ts) AS INTEGER) AS yyyymm FROM events
""",
)
def append(spark, sf_dir):
    """The events streamed into a fact twice: the second run finds every key loaded."""
    path = work_dir(spark, "stream-append")
    events = event_stream(spark, sf_dir)
    for run in ("first", "second"):
        stream_append(events, f"{path}/table", f"{path}/{run}", ["event_id"], "day", ["ts"]).awaitTermination()
    fact = streamed_fact(spark, f"{path}/table", events.schema)
    return fact.select("event_id", "user_id", "event_type", "value", "day", "yyyymm")


@query(
    "stream_distinct",
    f"""
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, l_returnflag, l_suppkey, {total('l_extendedprice', 'paid')},
  count(DISTINCT l_partkey) AS siniestros_pagados
FROM lineitem GROUP BY ALL
""",
)
def distinct(spark, sf_dir):
    """Amounts and different parts per month and supplier, kept while the lines come in batches, each with late rows."""
    path = work_dir(spark, "stream-distinct")
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").select(*columns, day("l_shipdate").alias("shipped"))

    def paid(rows):
        priced = rows.withColumnRenamed("l_extendedprice", "paid")
        return claims_rollup(priced, "shipped", "month", ["l_returnflag", "l_suppkey"], "paid", "l_partkey", fine=["l_suppkey"])

    stream_append(
        _in_batches(lines, "l_orderkey"), f"{path}/fact", f"{path}/checkpoint", ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"],
        "shipped", ["l_suppkey"], rollups=[(f"{path}/rollup", "month", paid, True)],
    ).awaitTermination()
    return spark.read.parquet(f"{path}/rollup").drop(MONTH)
