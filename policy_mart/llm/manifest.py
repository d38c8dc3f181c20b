"""Merkle manifest of a dataset, and proofs by a recursive query."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._work import Shelf, name

#: The tree over the groups' roots; the groups' own trees count from 0.
TOP = -1


@dataclass(frozen=True)
class Layout:
    """How the tree is stored and climbed. None of the numbers changes a hash."""

    levels: int = 9  # levels that a node row spans
    shared: int = 1 << 10  # leaves that climb through the same copy of a node row
    task_rows: int = 1 << 18  # rows that one task sorts, about

def leaf_hash(fields: Sequence[Column | str]) -> Column:
    """Lowercase hex sha256 of the fields, one after the other: `-` for null, else the UTF-8 byte count, `:` and the value."""
    parts = []
    for f in fields:
        value = (F.col(f) if isinstance(f, str) else f).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def merkle_manifest(rows: DataFrame, leaf: Column, tampered: Column, key: str = "doc_id", group: str = "lang", layout: Layout = Layout()) -> DataFrame:
    """Every row with its leaf, its group's root, the dataset's root, its proof, and the root that its tampered leaf folds to.

    `leaf` is the hash of a row, `tampered` the hash of what is held against it, null where that is the row
    itself. Per group the leaves ascend by key; every two consecutive nodes become the hash of their hex
    digests, a last one alone the hash of its own, until one is left, the group's root. The groups' roots, by
    group, give the root in the same way. Columns: the key, `leaf`, `subroot`, `root`, `proof_sha256`
    (hash of the siblings from leaf to root, left to right), `folded_root` and `verified`.

    The tree is stored as node rows: a row holds the digests of nine levels over 512 nodes and is
    linked to its parent row. A recursive query starts at all leaves and goes up a row at a time; every
    step appends the siblings passed and folds the digest. A row that many leaves climb through is
    stored once per 1,024 leaves, so no task gets all of them.

    Null keys come first, as does a null group, which is a group like any other. Rows of equal keys
    stand in the order of their leaves. Repeated rows have the same leaf and proofs of their own. Empty
    and long texts are fields like others. Other columns are not read, whatever their names, except by
    the two hashes. Of no rows there is no result row.
    """
    spark = rows.sparkSession
    shelf = Shelf(spark, "manifest")
    leaves = shelf.put(
        rows.select(
            name(key).alias("doc"), name(group).alias("grp"), F.unhex(leaf).alias("hash"), F.unhex(tampered).alias("other"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    numbered = _numbered(leaves, ["grp", "doc", "hash", "other", "row"], "g", layout, shelf).drop("row")
    groups = _numbered(numbered.groupBy("grp").agg(F.min("g").alias("first"), F.count(F.lit(1)).alias("leaves")), ["grp"], "tree", layout, shelf)
    spread = _stretches(layout, groups, "tree", "first", "leaves", F.col("grp").alias("_grp"))
    placed = shelf.put(
        numbered.withColumn("_stretch", _stretch_of(layout, F.col("g")))
        .join(spread, (F.col("_stretch") == F.col("_of")) & F.col("grp").eqNullSafe(F.col("_grp")))
        .select("g", "tree", "first", "leaves", (F.col("g") - F.col("first")).alias("pos"), "doc", "hash", F.coalesce("other", "hash").alias("held"))
    )
    sizes = groups.agg(F.count(F.lit(1)).alias("n"), F.max("leaves").alias("most")).first()
    if not sizes["n"]:
        return shelf.last(_result(placed.withColumns({"subroot": F.lit(None).cast("binary"), "proof": F.lit(None).cast("string"), "folded": F.col("held")}), key, None))
    trees, subroots, _ = _build(placed.select("tree", "pos", "hash", "first", "leaves"), sizes["most"], TOP, layout, shelf)
    lower = subroots.select(
        F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("pos"), "hash", F.lit(0).cast("bigint").alias("first"), F.lit(sizes["n"]).cast("bigint").alias("leaves")
    )
    tops, top, steps = _build(lower, sizes["n"], None, layout, shelf)
    nodes = shelf.put(_shared(layout, trees).unionByName(_shared_tops(layout, tops, groups, steps)))
    climbed = _climb(placed, nodes, layout, shelf)
    proofs = climbed.groupBy("g").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("step", "siblings"))), lambda s: F.lower(F.hex(s["siblings"]))), "").alias("proof"),
        F.max_by("hash", "step").alias("folded"),
    )
    roots = _stretches(layout, groups.join(subroots.withColumnRenamed("hash", "subroot"), "tree"), F.col("tree").alias("_tree"), "subroot")
    found = (
        placed.join(proofs, "g")
        .withColumn("_stretch", _stretch_of(layout, F.col("g")))
        .join(roots, (F.col("_stretch") == F.col("_of")) & (F.col("tree") == F.col("_tree")))
    )
    return shelf.last(_result(found, key, top.first()["hash"].hex()))


def _result(found: DataFrame, key: str, root: str | None) -> DataFrame:
    return found.select(
        F.col("doc").alias(key),
        F.lower(F.hex("hash")).alias("leaf"),
        F.lower(F.hex("subroot")).alias("subroot"),
        F.lit(root).cast("string").alias("root"),
        F.sha2("proof", 256).alias("proof_sha256"),
        F.lower(F.hex("folded")).alias("folded_root"),
        (F.lower(F.hex("folded")) == F.lit(root).cast("string")).alias("verified"),
    )


def _numbered(df: DataFrame, order: Sequence[str], number: str, layout: Layout, shelf: Shelf) -> DataFrame:
    """`df` with its rows' numbers in the order given, from 0: places within ranges, and the rows of the ranges before.

    No two rows may agree in all of `order`, so that ranges are of about the same size.
    """
    ranges = max(-(-df.count() // layout.task_rows), df.sparkSession.sparkContext.defaultParallelism)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    in_order = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    held = shelf.put(in_order.withColumn("_range", F.spark_partition_id()).withColumn("_place", place))
    # A row per range.
    earlier = F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    before = held.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows")).select("_range", F.coalesce(earlier, F.lit(0)).alias("_before"))
    return shelf.put(held.join(before, "_range").select(*df.columns, (F.col("_before") + F.col("_place")).alias(number)))


def _stretch_of(layout: Layout, g: Column) -> Column:
    return F.floor(g / layout.shared)


def _stretches(layout: Layout, groups: DataFrame, *columns: Column | str) -> DataFrame:
    """A group's columns, once per stretch (`_of`) of `layout.shared` rows that it has rows in, for joins that a frequent group does not skew."""
    return groups.select(*columns, F.explode(F.sequence(_stretch_of(layout, F.col("first")), _stretch_of(layout, F.col("first") + F.col("leaves") - 1))).alias("_of"))


def _build(nodes: DataFrame, most: int, above: int | None, layout: Layout, shelf: Shelf) -> tuple[DataFrame, DataFrame, int]:
    """The node rows of all trees, (tree, hash) of their roots, and the number of steps.

    `nodes`: (tree, pos, hash) of the lowest level, with the first leaf and the number of leaves of the
    tree; `most` is the largest of these numbers. A step hashes `layout.levels` levels at once, each
    stretch of nodes by itself, so steps grow with the logarithm of the largest tree. The root of a tree is the
    node of its number in the tree above.
    """
    kept, roots, step = [], [], 0
    schema = "tree bigint, block bigint, first bigint, leaves bigint, last boolean, levels array<binary>, hash binary"
    levels = layout.levels
    while True:
        span = 1 << (levels * step)
        last = F.floor((F.col("leaves") + span - 1) / span) <= 1 << levels
        blocks = nodes.withColumn("block", F.shiftright("pos", levels)).withColumn("last", last)
        built = shelf.put(blocks.groupBy("tree", "block", "first", "leaves", "last").applyInArrow(_levels(levels), schema))
        up = lambda inner, outer, kind: F.when(F.col("last"), outer).otherwise(inner).cast(kind)
        own = F.lit(None) if above is None else F.col("tree")
        kept.append(
            built.select(
                "tree", F.lit(step).alias("step"), "block", "first", "leaves", "levels",
                up(F.col("tree"), F.lit(above), "bigint").alias("up_tree"),
                up(F.lit(step + 1), F.lit(None if above is None else 0), "int").alias("up_step"),
                up(F.shiftright("block", levels), F.shiftright(own.cast("bigint"), levels), "bigint").alias("up_block"),
                up(F.col("block"), own, "bigint").alias("up_pos"),
            )
        )
        roots.append(built.filter("last").select("tree", "hash"))
        step += 1
        if most <= 1 << (levels * step):
            return reduce(DataFrame.unionByName, kept), reduce(DataFrame.unionByName, roots), step
        nodes = built.filter("not last").select("tree", F.col("block").alias("pos"), "hash", "first", "leaves")


def _levels(most: int):
    """For a stretch of nodes: the digests of every level but the last one's, and the last one's."""

    def hashed(group: pa.Table) -> pa.Table:
        in_order = group.sort_by("pos")
        last = in_order["last"][0].as_py()
        nodes, levels = in_order["hash"].to_pylist(), []
        while len(nodes) > 1 or (not last and len(levels) < most):
            levels.append(b"".join(nodes))
            text = [n.hex() for n in nodes]
            nodes = [hashlib.sha256("".join(text[i : i + 2]).encode()).digest() for i in range(0, len(text), 2)]
        columns = {c: in_order[c].slice(0, 1) for c in ("tree", "block", "first", "leaves", "last")}
        return pa.table(columns | {"levels": pa.array([levels], pa.list_(pa.binary())), "hash": pa.array(nodes, pa.binary())})

    return hashed


def _copies(layout: Layout, nodes: DataFrame) -> DataFrame:
    """Node rows, one for each `layout.shared` consecutive leaves between `_from` and `_to`, which climb through them."""
    share = F.explode(F.sequence(_stretch_of(layout, F.col("_from")), _stretch_of(layout, F.col("_to"))))
    return nodes.select("tree", "step", "block", share.alias("share"), "levels", "up_tree", "up_step", "up_block", "up_pos")


def _shared(layout: Layout, trees: DataFrame) -> DataFrame:
    span = F.pow(F.lit(2), (F.col("step") + 1) * layout.levels).cast("bigint")
    begin = F.col("first") + F.col("block") * span
    return _copies(layout, trees.withColumns({"_from": begin, "_to": F.least(begin + span, F.col("first") + F.col("leaves")) - 1}))


def _shared_tops(layout: Layout, tops: DataFrame, groups: DataFrame, steps: int) -> DataFrame:
    """The node rows of the tree over the groups; the leaves below are those of its groups."""
    spans = [
        groups.groupBy(F.shiftright("tree", layout.levels * (step + 1)).alias("block"))
        .agg(F.min("first").alias("_from"), (F.max(F.col("first") + F.col("leaves")) - 1).alias("_to"))
        .withColumn("step", F.lit(step))
        for step in range(steps)
    ]
    return _copies(layout, tops.join(reduce(DataFrame.unionByName, spans), ["step", "block"]))


def _climb(leaves: DataFrame, nodes: DataFrame, layout: Layout, shelf: Shelf) -> DataFrame:
    """(g, step, siblings, hash): for every leaf and node row above it the siblings passed and the digest folded so far.

    A sibling that does not exist, beside the last node of a level, is the empty string, which leaves
    the other alone in its hash. The recursion's limit on rows is lifted while it runs: its rows grow
    with the leaves, its steps with their logarithm.
    """
    spark = leaves.sparkSession
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    query = f"""
        WITH RECURSIVE climb (g, at_step, tree, step, block, pos, hash, siblings) AS (
          SELECT g, 0, tree, 0, shiftright(pos, {layout.levels}), pos, held, CAST(NULL AS BINARY) FROM {{leaves}}
          UNION ALL
          SELECT g, at_step + 1, up_tree, up_step, up_block, up_pos,
            unhex(aggregate(passed, lower(hex(hash)), (h, s) ->
              sha2(CASE WHEN s.on_left THEN concat(s.sibling, h) ELSE concat(h, s.sibling) END, 256))),
            unhex(array_join(transform(passed, s -> s.sibling), ''))
          FROM (
            SELECT c.g, c.at_step, c.hash, n.up_tree, n.up_step, n.up_block, n.up_pos,
              transform(n.levels, (level, i) -> named_struct(
                'on_left', (shiftright(c.pos, i) & 1) = 1,
                'sibling', lower(hex(substring(level, CAST(32 * (shiftright(c.pos % {1 << layout.levels}, i) ^ 1) + 1 AS INT), 32))))) AS passed
            FROM climb c JOIN {{nodes}} n
              ON c.tree = n.tree AND c.step = n.step AND c.block = n.block AND c.g DIV {layout.shared} = n.share
          )
        )
        SELECT g, at_step AS step, siblings, hash FROM climb WHERE at_step > 0
        """
    spark.conf.set(limit, "-1")
    try:
        return shelf.put(spark.sql(query, leaves=leaves.select("g", "tree", "pos", "held"), nodes=nodes))
    finally:
        if before is None:
            spark.conf.unset(limit)
        else:
            spark.conf.set(limit, before)
