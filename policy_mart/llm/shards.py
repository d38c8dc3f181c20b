"""Sharding by a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._work import name, others

#: Ring positions are the first 60 bits of a digest; a cell is the part of the ring that shares its first 12.
_HEX, _CELL_BITS = 15, 12


def _position(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, _HEX), 16, 10).cast("long")


def _cell(position: str) -> Column:
    return F.shiftright(position, 4 * _HEX - _CELL_BITS)


def ring(spark: SparkSession, shards: int, vnodes: int) -> DataFrame:
    """The arcs of the ring, clockwise: `arc` from 0, its owner `shard` and its last position `_llm_end`.

    Each shard puts `vnodes` points on the ring; an arc ends at a point and belongs to its shard.
    One more shard adds points and moves none. The number of rows is `shards * vnodes`.
    """
    points = spark.range(shards * vnodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        _position(F.md5(F.concat_ws(":", (F.col("id") % shards).cast("string"), F.floor(F.col("id") / shards).cast("string")))).alias("_llm_end"),
    )
    return points.select(
        (F.row_number().over(Window.orderBy("_llm_end", "shard")) - 1).alias("arc"), "shard", "_llm_end"
    )


def _cells(arcs: DataFrame, arcs_all: int) -> DataFrame:
    """Per ring cell the arcs that reach into it, in order; what follows the last point is arc 0."""
    top = (1 << (4 * _HEX)) - 1
    begin = F.coalesce(F.lag("_llm_end").over(Window.orderBy("arc")) + 1, F.lit(0))
    pieces = arcs.select("arc", begin.alias("_llm_begin"), "_llm_end")
    last = arcs.filter(F.col("arc") == arcs_all - 1).select(
        F.lit(0).alias("arc"), (F.col("_llm_end") + 1).alias("_llm_begin"), F.lit(top).alias("_llm_end")
    )
    pieces = pieces.unionByName(last).filter("_llm_begin <= _llm_end")
    split = pieces.select(
        F.explode(F.sequence(_cell("_llm_begin"), _cell("_llm_end"))).alias("_llm_cell"),
        F.struct(F.col("_llm_end").alias("until"), "arc").alias("_llm_piece"),
    )
    return split.groupBy("_llm_cell").agg(F.sort_array(F.collect_list("_llm_piece")).alias("_llm_pieces"))


def _plan(loads: DataFrame, shards: int) -> DataFrame:
    """Per arc: how many of its keys stay with its shard, and where the others go.

    `loads` has one row per arc (`arc`, `shard`, `rows`). Shards take floor(n / shards) keys and
    the first n mod shards of them one more. A shard's own keys come first, in ring order. Those
    beyond its capacity wait in ring order, and the walk round the ring, twice at most, gives
    every arc's shard as many of the waiting keys as it has room for. All arrays here are bounded by
    the number of arcs, a parameter.
    """
    per_shard = Window.partitionBy("shard")
    along = per_shard.orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n = F.sum("rows").over(everything)
    arcs = loads.select(
        "arc",
        "shard",
        "rows",
        F.coalesce(F.sum("rows").over(along), F.lit(0)).alias("before"),
        F.sum("rows").over(per_shard).alias("home"),
        ((n - n % shards) / shards + F.when(F.col("shard") < n % shards, 1).otherwise(0)).cast("long").alias("cap"),
    )
    arcs = arcs.withColumn(
        "waiting", F.greatest(F.lit(0), F.least("rows", F.col("before") + F.col("rows") - F.col("cap"))).cast("long")
    )
    arcs = arcs.withColumn(
        "waiting_before",
        F.coalesce(F.sum("waiting").over(Window.orderBy("arc").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    room = F.greatest(F.lit(0), F.col("cap") - F.col("home")).cast("long")
    one = arcs.agg(
        F.sort_array(F.collect_list(F.struct("arc", "shard", "rows", "before", "waiting", "waiting_before"))).alias("arcs"),
        F.transform(F.sort_array(F.collect_set(F.struct("shard", room.alias("room")))), lambda x: x["room"]).alias("rooms"),
        F.transform(F.sort_array(F.collect_set(F.struct("shard", "cap"))), lambda x: x["cap"]).alias("caps"),
        F.sum("waiting").alias("total"),
    )
    walk = one.select(
        "arcs",
        F.expr(
            """aggregate(
              concat(transform(arcs, a -> named_struct('shard', a.shard, 'tail', a.waiting_before + a.waiting)),
                     transform(arcs, a -> named_struct('shard', a.shard, 'tail', total))),
              named_struct('head', 0L, 'rooms', rooms, 'parts',
                           array_repeat(named_struct('first', 0L, 'until', 0L, 'shard', 0, 'slot', 0L), 0)),
              (s, v) -> if(v.tail > s.head and s.rooms[v.shard] > 0,
                named_struct(
                  'head', s.head + least(v.tail - s.head, s.rooms[v.shard]),
                  'rooms', transform(s.rooms, (r, i) -> if(i = v.shard, r - least(v.tail - s.head, r), r)),
                  'parts', concat(s.parts, array(named_struct(
                    'first', s.head, 'until', s.head + least(v.tail - s.head, s.rooms[v.shard]),
                    'shard', v.shard, 'slot', caps[v.shard] - s.rooms[v.shard])))),
                s),
              s -> s.parts)"""
        ).alias("parts"),
    )
    return walk.select(
        F.explode(
            F.expr(
                """transform(arcs, a -> named_struct(
                     'arc', a.arc, 'home', a.shard, 'before', a.before, 'stay', a.rows - a.waiting, 'waiting_before', a.waiting_before,
                     'parts', if(a.waiting > 0, filter(parts, p -> p.until > a.waiting_before
                                                           and p.first < a.waiting_before + a.waiting), slice(parts, 1, 0))))"""
            )
        ).alias("p")
    ).select("p.*")


def assign_shards(docs: DataFrame, shards: int = 40, vnodes: int = 64, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with `shard` (0 to shards - 1) and `slot` (its place in the shard, gapless from 0).

    A key's digest is a place on the ring, and the next point clockwise names its shard. Loads are
    bounded at equal counts: no two shards differ by more than one row. Keys of an over-full shard
    continue clockwise to shards with room; all others stay, so a changed number of shards
    moves few rows beyond those that the new points claim.

    Only counts per arc are gathered; documents are numbered within their arc, of which there are
    `shards * vnodes`, so an arc holds that fraction of the rows. Rows without key are placed by
    their text. Rows that agree in key, size and text are numbered in any order. Empty tables give empty
    tables; `shard` and `slot` replace input columns of that name.
    """
    spark = docs.sparkSession
    arcs_all = shards * vnodes
    rest = others(docs, "shard", "slot")
    digest = F.md5(F.coalesce(name(key).cast("string"), name(text), F.lit("")))
    arcs = ring(spark, shards, vnodes)
    placed = docs.select(
        *rest, _position(digest).alias("_llm_pos"), name(key).alias("_llm_key"), F.xxhash64(name(text)).alias("_llm_text")
    )
    placed = placed.withColumn("_llm_cell", _cell("_llm_pos")).join(F.broadcast(_cells(arcs, arcs_all)), "_llm_cell")
    placed = placed.withColumn("_llm_arc", F.expr("filter(_llm_pieces, p -> p.until >= _llm_pos)[0].arc")).drop("_llm_pieces", "_llm_cell")
    counts = placed.groupBy(F.col("_llm_arc").alias("arc")).agg(F.count(F.lit(1)).alias("rows"))
    loads = arcs.select("arc", "shard").join(counts, "arc", "left").na.fill(0, ["rows"])
    plan = _plan(loads, shards).withColumnsRenamed({c: f"_llm_{c}" for c in ("arc", "home", "before", "stay", "waiting_before", "parts")})
    own = Window.partitionBy("_llm_arc").orderBy("_llm_pos", "_llm_key", "_llm_text")
    out = placed.withColumn("_llm_rn", F.row_number().over(own) - 1).join(F.broadcast(plan), "_llm_arc")
    out = out.withColumn("_llm_w", F.col("_llm_waiting_before") + F.col("_llm_rn") - F.col("_llm_stay")).withColumn(
        "_llm_part", F.expr("get(filter(_llm_parts, p -> p.first <= _llm_w and _llm_w < p.until), 0)")
    )
    stays = F.col("_llm_rn") < F.col("_llm_stay")
    return out.select(
        *rest,
        F.when(stays, F.col("_llm_home")).otherwise(F.col("_llm_part.shard")).cast("int").alias("shard"),
        F.when(stays, F.col("_llm_before") + F.col("_llm_rn"))
        .otherwise(F.col("_llm_part.slot") + F.col("_llm_w") - F.col("_llm_part.first"))
        .cast("long")
        .alias("slot"),
    )
