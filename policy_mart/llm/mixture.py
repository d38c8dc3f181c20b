"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._ranks import ranked
from ._work import name, others

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, source: str, size: str, weights: Sequence[float] = (1, 2, 3), most: float = 3.0
) -> DataFrame:
    """One row per source of `sizes` (one row per source with its size): its target.

    Sources take `weights` in turn, by code point and null last, and share the sum of all sizes in
    that proportion. No target passes `most` times its source's size; what that leaves over is
    shared again by weight among the others, until none is above. Sources are few next to rows:
    the two windows over all of them hold one row per source.
    """
    turn = (F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    cap = F.col(size) * F.lit(float(most))
    rows = sizes.withColumn("_llm_w", weight).withColumn("_llm_cap", cap)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # The sources whose cap is reached first, in the order in which they reach it.
    filling = Window.orderBy(F.col("_llm_cap") / F.col("_llm_w"), F.col(source).asc_nulls_last())
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.withColumn("_llm_total", F.sum(size).over(everything).cast("double"))
        .withColumn("_llm_w_all", F.sum("_llm_w").over(everything))
        .withColumn("_llm_c_before", F.coalesce(F.sum("_llm_cap").over(earlier), F.lit(0.0)))
        .withColumn("_llm_w_before", F.coalesce(F.sum("_llm_w").over(earlier), F.lit(0.0)))
        .withColumn(
            "_llm_full",
            F.col("_llm_cap") * (F.col("_llm_w_all") - F.col("_llm_w_before"))
            <= F.col("_llm_w") * (F.col("_llm_total") - F.col("_llm_c_before")),
        )
        .withColumn("_llm_c_full", F.coalesce(F.sum(F.when(F.col("_llm_full"), F.col("_llm_cap"))).over(everything), F.lit(0.0)))
        .withColumn("_llm_w_full", F.coalesce(F.sum(F.when(F.col("_llm_full"), F.col("_llm_w"))).over(everything), F.lit(0.0)))
    )
    left = F.col("_llm_total") - F.col("_llm_c_full")
    share = F.col("_llm_w") * left / (F.col("_llm_w_all") - F.col("_llm_w_full"))
    return rows.select(
        source, size, F.when(F.col("_llm_full"), F.col("_llm_cap")).otherwise(share).cast("double").alias("target")
    )


def random_offset(group: Column, seed: int) -> Column:
    """A source's offset in [0, 1): 32 bits of a digest of the seed and the source, so that reruns agree."""
    drawn = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), group)), 1, 8)
    return F.conv(drawn, 16, 10).cast("double") / F.lit(float(1 << 32))


def mix_sources(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: Sequence[float] = (1, 2, 3),
    most: float = 3.0,
    seed: int = 0,
) -> DataFrame:
    """`docs` with `size`, `source_size`, `target`, `copies` and `taken`.

    A source's documents expect `target / source_size` copies each. Prefix sums of the expected
    copies, moved by one random offset in [0, 1) for the source, give a document one copy for each integer
    they cross on it; another `seed` draws other offsets, so over seeds each document gets what it expects. Documents stand in the order of their size and then of their key's digest:
    neighbours have like sizes, so the words taken stay near the target, and the order is the same
    in every run. A source is cut into sizes and digest ranges; no task holds a source or all
    copies of a text, and only counts are summed over the sizes of a size class and the classes
    of a source.

    Null or wordless texts have size 0 and get copies like others; a source without words has
    target 0 and gets none. A null source is a source. Rows that agree in key, size and text share
    their place in any order. Empty tables give empty tables. Output columns replace input columns
    of the same name.
    """
    rest = others(docs, "size", "source_size", "target", "copies", "taken")
    digest = F.md5(F.coalesce(name(key).cast("string"), F.lit("")))
    sized = docs.select(
        *rest,
        words(name(text)).alias("size"),
        name(source).alias("_llm_source"),
        digest.alias("_llm_digest"),
        name(key).alias("_llm_key"),
        F.xxhash64(name(text)).alias("_llm_text"),
    )
    bits = F.length(F.bin("size"))
    sized = sized.select(
        "*",
        F.concat(F.when(F.col("_llm_source").isNull(), F.lit("1")).otherwise(F.lit("0")), F.coalesce("_llm_source", F.lit(""))).alias("_llm_group"),
        (bits * 64 + F.expr("shiftright(size, greatest(length(bin(size)) - 6, 0))")).alias("_llm_class"),
        F.substring("_llm_digest", 1, 2).alias("_llm_range"),
    )
    sizes = sized.groupBy("_llm_group").agg(F.first("_llm_source").alias("_llm_s"), F.sum("size").alias("source_size"))
    targets = source_targets(sizes.select("_llm_s", "source_size"), "_llm_s", "source_size", weights, most).select(
        F.concat(F.when(F.col("_llm_s").isNull(), F.lit("1")).otherwise(F.lit("0")), F.coalesce("_llm_s", F.lit(""))).alias("_llm_group"),
        "source_size",
        "target",
    )
    order = ["_llm_digest", "_llm_key", "_llm_text"]
    places = ranked(sized, ["_llm_group", "_llm_class", "size", "_llm_range"], order, "_llm_rank")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = random_offset(F.col("_llm_group"), seed)
    crossed = F.floor((F.col("_llm_rank") + 1) * rate + offset) - F.floor(F.col("_llm_rank") * rate + offset)
    out = places.join(targets, "_llm_group").withColumn("copies", crossed.cast("long"))
    return out.select(*rest, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeated(mixed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The documents of a mix, each as many times as it has copies."""
    times = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_llm_copy")
    return mixed.filter(F.col("copies") > 0).select(*[name(c) for c in columns], times).drop("_llm_copy")
