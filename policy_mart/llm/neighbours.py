"""Embedding near-duplicates by NN-descent."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._graph import components
from ._work import Shelf, name, runs

#: A group that one local join compares at once; larger ones are cut into such parts.
GROUP = 128
#: Vectors are compared in full in blocks of so many.
BLOCK = 256
#: Sets of random planes that give the first neighbours.
TABLES = 8
#: Groups of vectors by their number of links, which the audit asks alike: none, 1 to 3, 4 to 15, and so on.
STRATA = 6


def packed(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, str]:
    """(key, vec) of every row, and the number format of vec's bytes. vec is null where the vector is null, zero, empty or holds
    null or non-finite components: such vectors can be compared with nothing."""
    v = name(vector)
    kind = "<f4" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "<f8"
    sound = F.size(v) > 0
    sound = sound & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    sound = F.coalesce(sound & F.exists(v, lambda x: x != 0), F.lit(False))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [None if x is None else np.asarray(x, kind).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.binary())], names=["key", "vec"])

    values = F.when(sound, v if kind == "<f4" else v.cast("array<double>"))
    return vectors.select(name(key).cast("long"), values).mapInArrow(pack, "key long, vec binary"), kind


def comparable(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, str]:
    """(id, vec) of the rows with a key whose vectors can be compared, each once, and the number format of vec's bytes.

    Vectors of one key that differ all stay. Vectors of different dimensions have no cosine with each other.
    """
    rows, kind = packed(vectors, key, vector)
    return rows.filter("key IS NOT NULL AND vec IS NOT NULL").select(F.col("key").alias("id"), "vec").distinct(), kind


def same_length(rows: pa.RecordBatch | pa.Table, column: str) -> Iterator[pa.RecordBatch | pa.Table]:
    """The rows by the length of their vectors, most often one."""
    if rows.num_rows < 2:
        if rows.num_rows:
            yield rows
        return
    length = pc.binary_length(rows.column(column))
    ends = pc.min_max(length)
    if ends["min"].as_py() == ends["max"].as_py():
        yield rows
        return
    length = np.asarray(length)
    for n in np.unique(length):
        yield rows.take(pa.array(np.flatnonzero(length == n)))


def rows_of(column: pa.Array, kind: str) -> np.ndarray:
    """The vectors of a column, as they are, in double precision."""
    cells = column.to_pylist()
    return np.frombuffer(b"".join(cells), kind).reshape(len(cells), -1).astype(np.float64)


def unit_rows(column: pa.Array, kind: str) -> np.ndarray:
    """The vectors of a column as rows of length 1, in double precision."""
    x = rows_of(column, kind)
    return x / norms(x)[:, None]


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths without overflow: the largest component is taken out first."""
    top = np.abs(x).max(axis=1)
    return top * np.sqrt(((x / top[:, None]) ** 2).sum(axis=1))


def _local_join(members: DataFrame, k: int, threshold: float, kind: str) -> DataFrame:
    """(a, b, sim): each member's best others in its group, if better than the worst it has, and links
    that span each piece of the group's links, so that no link measured is lost to the components.

    `members` has group, id, worst, vec and root; members of one root are not compared. Groups are of bounded size.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in (part for whole in runs(batches, ["group"]) for part in same_length(whole, "vec")):
            n = group.num_rows
            if n < 2:
                continue
            ids = group.column("id").to_numpy()
            ids, at = np.unique(ids, return_index=True)
            worst = group.column("worst").to_numpy()[at]
            x = unit_rows(group.column("vec").combine_chunks().take(pa.array(at)), kind)
            n, top = len(ids), min(k, len(ids) - 1)
            if n < 2:
                continue
            root = group.column("root").to_numpy()[at]
            sims = x @ x.T
            sims[root[:, None] == root[None, :]] = -2.0
            best = np.argpartition(-sims, top - 1, axis=1)[:, :top]
            value = np.take_along_axis(sims, best, axis=1)
            better = (value > worst[:, None]) & (value > -2.0)
            a, c = np.nonzero(better)
            b, value = best[a, c], value[a, c]
            # Spanning links keep all that is linked in one piece, however short the lists.
            leaf, hub = _spanning(sims >= threshold)
            a, b, value = np.concatenate([a, leaf]), np.concatenate([b, hub]), np.concatenate([value, sims[leaf, hub]])
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a]), pa.array(ids[b]), pa.array(value)], names=["a", "b", "sim"]
                )

    return (
        members.select("group", "id", "worst", "vec", "root")
        .repartition("group")
        .sortWithinPartitions("group")
        .mapInArrow(join, "a long, b long, sim double")
    )


def _spanning(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The links of a spanning forest of a symmetric matrix, from the nodes with the most links."""
    degree = linked.sum(axis=1)
    waiting = degree > 0
    leaves, hubs, todo = [], [], []
    while todo or waiting.any():
        if not todo:
            todo.append(int(np.where(waiting, degree, -1).argmax()))
            waiting[todo[0]] = False
        hub = todo.pop()
        new = np.flatnonzero(linked[hub] & waiting)
        waiting[new] = False
        todo.extend(new.tolist())
        leaves.append(new)
        hubs.append(np.full(len(new), hub))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *leaves]), np.concatenate([none, *hubs])


def _by_planes(vectors: DataFrame, tables: int, bits: int, seed: int, kind: str) -> DataFrame:
    """(table, code, id, vec, root): on which side of `bits` random planes through 0 a vector lies, for each table.

    Vectors of different dimensions have different codes.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in (part for whole in batches for part in same_length(whole, "vec")):
            x = unit_rows(batch.column(1), kind)
            d = x.shape[1]
            if d not in planes:
                planes = {d: np.random.default_rng(seed).standard_normal((d, tables * bits))}
            side = (x @ planes[d] > 0).reshape(len(x), tables, bits)
            codes = side @ (1 << np.arange(bits, dtype=np.int64)) + (d << 40)
            rows = pa.array(np.repeat(np.arange(len(x)), tables))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(tables, dtype=np.int64), len(x))), pa.array(codes.ravel()), *[batch.column(i).take(rows) for i in range(3)]],
                names=["table", "code", "id", "vec", "root"],
            )

    return vectors.select("id", "vec", "root").mapInArrow(code, "table long, code long, id long, vec binary, root long")


def _cut(rows: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """`rows` with `group`: their keys, larger groups being cut at random into parts of about GROUP rows."""
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_here"))
    parts = F.ceil(F.col("rows_here") / F.lit(GROUP))
    return rows.join(sizes, keys).withColumn("group", F.xxhash64(*keys, F.pmod(salt, parts)))


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k most similar of each node's neighbours found."""
    once = found.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return once.withColumn("place", place).filter(F.col("place") <= k)


def descend(
    vectors: DataFrame,
    kind: str,
    shelf: Shelf,
    threshold: float,
    k: int,
    rounds: int,
    settled: float,
    seed: int,
    near: DataFrame | None = None,
    tables: int = TABLES,
) -> tuple[list[DataFrame], DataFrame]:
    """The links (a, b, sim) at the threshold that NN-descent comes by, and the lists it ends with.

    `vectors` has id, vec and root; vectors of one root are not compared and in no list of each other. `near` are
    lists of any root, whose nodes meet in the groups too: a way to the members next to a neighbour.

    It starts from neighbours on the same side of random planes. In each round a node's
    neighbours, and the nodes it is a neighbour of, meet in a group of their own and are
    compared; each keeps its k best. It ends when a round finds new links for no more than the fraction
    `settled` of the nodes. A group is cut into parts of bounded size, so a node with very many
    reverse neighbours costs no task more than others. With `near` a round counts all that is new in the
    lists, as they get close to a link before they hold one.
    """
    n = vectors.count()
    bits = max(1, min(40, int(np.ceil(np.log2(max(n, 2) / 16)))))
    coded = shelf.put(_by_planes(vectors, tables, bits, seed, kind))
    start = _cut(coded, ["table", "code"], F.xxhash64("id", "table")).withColumn("worst", F.lit(-2.0))
    found = shelf.put(_local_join(start, k, threshold, kind))
    shelf.drop(coded)
    graph = shelf.put(_best(found, k))
    links = [found.filter(F.col("sim") >= threshold)]
    for turn in range(rounds):
        worst = graph.groupBy(F.col("a").alias("id")).agg(
            F.when(F.count(F.lit(1)) < k, F.lit(-2.0)).otherwise(F.min("sim")).alias("worst")
        )
        described = vectors.join(worst, "id", "left").select("id", F.coalesce("worst", F.lit(-2.0)).alias("worst"), "vec", "root")
        edges = (
            graph.select(F.col("a").alias("hub"), F.col("b").alias("id"))
            .unionByName(graph.select(F.col("b").alias("hub"), F.col("a").alias("id")))
            .unionByName(graph.select(F.col("a").alias("hub"), F.col("a").alias("id")))
        )
        if near is not None:
            edges = edges.unionByName(near.select(F.col("a").alias("hub"), F.col("b").alias("id")))
        edges = edges.distinct()
        members = _cut(edges, ["hub"], F.xxhash64("id", F.lit(turn))).select("group", "id").join(described, "id")
        found = shelf.put(_local_join(members, k, threshold, kind))
        linked = found.filter(F.col("sim") >= threshold)
        fresh = (linked if near is None else found).join(graph.select("a", "b"), ["a", "b"], "left_anti").agg(F.count_distinct("a")).first()[0]
        links.append(linked)
        old = graph
        graph = shelf.put(_best(graph.select("a", "b", "sim").unionByName(found), k))
        shelf.drop(old)
        if fresh <= settled * n:
            break
    return links, graph


def bridges(
    vectors: DataFrame, kind: str, shelf: Shelf, known: list[DataFrame], graph: DataFrame, threshold: float, k: int, rounds: int, settled: float, seed: int
) -> tuple[list[DataFrame], DataFrame]:
    """All links found, and the components (node, root) they make.

    A list of `k` links has no room for what lies behind them. While there are such lists, the descent is repeated
    between components only, with lists of members of others, until it finds no more link.
    """
    roots = shelf.put(components(reduce(DataFrame.unionByName, known).select("a", "b"), shelf))
    full = graph.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("worst"))
    if full.filter((F.col("n") >= k) & (F.col("worst") >= threshold)).isEmpty():
        return known, roots
    while True:
        placed = vectors.select("id", "vec").join(roots.withColumnRenamed("node", "id"), "id", "left")
        placed = shelf.put(placed.select("id", "vec", F.coalesce("root", "id").alias("root")))
        found, lists = descend(placed, kind, shelf, threshold, k, rounds, settled, seed, graph)
        more = shelf.put(reduce(DataFrame.unionByName, found).select("a", "b", "sim"))
        shelf.drop(placed, lists)
        if more.isEmpty():
            return known, roots
        known = [*known, more]
        roots = shelf.put(components(reduce(DataFrame.unionByName, known).select("a", "b"), shelf))


def _full_links(members: DataFrame, shelf: Shelf, threshold: float, kind: str) -> DataFrame:
    """(id, n_links) of the nodes of components (root, id, vec): all their links, each counted.

    A component is measured from its root. Two vectors within half the threshold's angle of it are
    surely linked, and counted without being compared. The others, if any, are compared with all of
    the component, in pairs of blocks. No pair is emitted.
    """
    centre = members.filter("id = root").select("root", F.col("vec").alias("centre"))
    half = np.cos(np.arccos(threshold) / 2) + 1e-9

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in same_length(whole, "vec")):
            near = (unit_rows(batch.column(2), kind) * unit_rows(batch.column(3), kind)).sum(axis=1) >= half
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(3)], pa.array(near)], names=["root", "id", "vec", "near"]
            )

    measured = members.join(centre, "root").select("root", "id", "vec", "centre")
    measured = shelf.put(measured.mapInArrow(measure, "root long, id long, vec binary, near boolean"))
    sizes = measured.groupBy("root").agg(
        F.count_if("near").alias("n_near"), F.count_if(~F.col("near")).alias("n_far")
    )
    measured = measured.join(sizes, "root")
    sure = measured.select("id", F.when(F.col("near"), F.col("n_near") - 1).otherwise(0).cast("long").alias("n"))
    # Blocks of far vectors, then blocks of near ones; near blocks meet far blocks only.
    far_blocks = F.ceil(F.col("n_far") / F.lit(BLOCK))
    near_blocks = F.ceil(F.col("n_near") / F.lit(BLOCK))
    lot = F.xxhash64("id", F.lit("block"))
    open_rows = measured.filter("n_far > 0").withColumn(
        "block", F.when(F.col("near"), far_blocks + F.pmod(lot, near_blocks)).otherwise(F.pmod(lot, far_blocks)).cast("int")
    )
    partners = F.when(F.col("near"), F.sequence(F.lit(0), (far_blocks - 1).cast("int"))).otherwise(
        F.sequence(F.lit(0), (far_blocks + near_blocks - 1).cast("int"))
    )
    meeting = open_rows.withColumn("partner", F.explode(partners)).select(
        "root", F.least("block", "partner").alias("lower"), F.greatest("block", "partner").alias("upper"), "id", "vec", "block"
    )
    group = ["root", "lower", "upper"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, group):
            ids, block = part.column("id").to_numpy(), part.column("block").to_numpy()
            x = unit_rows(part.column("vec").combine_chunks(), kind)
            linked = x @ x.T >= threshold
            np.fill_diagonal(linked, False)
            if block.min() != block.max():  # two blocks meet here; each meets itself elsewhere
                linked &= block[:, None] != block[None, :]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(linked.sum(axis=1).astype(np.int64))], names=["id", "n"]
            )

    counted = meeting.repartition(*group).sortWithinPartitions(*group).mapInArrow(count, "id long, n long")
    return sure.unionByName(counted).groupBy("id").agg(F.sum("n").alias("n_links"))


def audit_recall(vectors: DataFrame, kind: str, links: DataFrame, threshold: float, sample: int) -> float:
    """The share of a vector's true neighbours, at the threshold, that the links (id, n_links) hold, on
    average over the vectors with any: about `sample` queries, each compared with every vector.

    The queries come in equal parts from strata by the number of links held, and count as often as their
    stratum has vectors, so neither large groups nor small ones outweigh the rest.
    """
    held = F.coalesce("n_links", F.lit(0))
    layer = F.least(F.ceil(F.log2(held + 1.0) / 2), F.lit(STRATA - 1)).cast("int")
    known = links.select("id", "n_links")
    layered = vectors.select("id", "vec").join(known, "id", "left").withColumn("layer", layer)
    sizes = {x["layer"]: x["count"] for x in layered.groupBy("layer").count().collect()}
    if not sizes:
        return 1.0
    each = max(1, sample // len(sizes))
    parts = [layered.filter(F.col("layer") == i).orderBy(F.xxhash64("id", F.lit("audit"))).limit(each) for i in sizes]
    queries = reduce(DataFrame.unionByName, parts).select("id", "vec", "layer").collect()
    ids = np.array([q["id"] for q in queries])
    length = np.array([len(q["vec"]) for q in queries])
    asked_by = {int(n): np.flatnonzero(length == n) for n in np.unique(length)}
    x = {n: unit_rows(pa.array([bytes(queries[i]["vec"]) for i in at], pa.binary()), kind) for n, at in asked_by.items()}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), np.int64)
        for batch in (part for whole in batches for part in same_length(whole, "vec")):
            n = len(batch.column(1)[0].as_py())
            if n in x:
                near = unit_rows(batch.column(1), kind) @ x[n].T >= threshold
                total[asked_by[n]] += (near & (batch.column(0).to_numpy()[:, None] != ids[asked_by[n]][None, :])).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], names=["id", "n"])

    true = vectors.select("id", "vec").mapInArrow(compare, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    got = {x["id"]: x for x in true.join(known, "id", "left").collect()}
    asked = {i: sum(q["layer"] == i for q in queries) for i in sizes}
    weight = total = 0.0
    for q in queries:
        n, share = got[q["id"]]["n"], sizes[q["layer"]] / asked[q["layer"]]
        if n:
            weight += share
            total += share * min(n, got[q["id"]]["n_links"] or 0) / n
    return total / weight if weight else 1.0


def near_vectors(
    embeddings: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.95,
    k: int = 8,
    rounds: int = 6,
    settled: float = 0.01,
    recall: float = 0.99,
    audit: int = 256,
) -> DataFrame:
    """Per vector: key, `n_links`, `component_id`, `kept`.

    Two vectors are linked at cosine `threshold` or more, in double precision. NN-descent gives about the
    `k` nearest of each vector, and the links on the way make components. Where lists are
    saturated with links, the descent is repeated between components (see `bridges`). Within a component
    every link is counted exactly.
    A bounded sample of vectors is compared with all to audit the recall; if it is below
    `recall`, the descent goes on with lists twice as long from twice as many other planes, up to four times in
    all, and then fails: a result below `recall` is not given.

    Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do those of
    different dimensions with each other. Equal vectors are linked like any others. Rows that agree in key and
    vector are one vector, and each gives its result; differing vectors of one key are vectors of their own.
    Rows with a null key come back with no link and a null component. Columns other than key and vector
    are not read, whatever their names. An empty table gives an empty table.
    """
    shelf = Shelf(embeddings.sparkSession, "nn-descent")
    rows, kind = packed(embeddings, key, vector)
    rows = shelf.put(rows)
    sound = shelf.put(rows.filter("key IS NOT NULL AND vec IS NOT NULL").distinct())
    # The key numbers a vector, unless it has several.
    repeated = not sound.groupBy("key").count().filter("count > 1").isEmpty()
    number = F.monotonically_increasing_id() if repeated else F.col("key")
    vectors = shelf.put(sound.withColumn("id", number).withColumn("root", F.col("id")))
    known: list[DataFrame] = []
    for attempt in range(4):
        found, graph = descend(vectors, kind, shelf, threshold, k << attempt, rounds, settled, attempt, tables=TABLES << attempt)
        known, roots = bridges(vectors, kind, shelf, known + found, graph, threshold, k << attempt, rounds, settled, seed=attempt)
        members = shelf.put(roots.withColumnRenamed("node", "id").join(vectors.select("id", "vec"), "id"))
        links = shelf.put(_full_links(members, shelf, threshold, kind).join(members.select("id", "root"), "id"))
        reached = audit_recall(vectors, kind, links, threshold, audit)
        if reached >= recall:
            break
    else:
        raise RuntimeError(f"near_vectors: recall {reached:.4f} after {attempt + 1} attempts, below {recall}")
    linked = links.join(vectors.select("id", F.col("key").alias("own"), F.col("vec").alias("own_vec")), "id")
    least = linked.groupBy("root").agg(F.min("own").alias("component"))
    found = linked.join(least, "root").select("own", "own_vec", "n_links", "component")
    out = rows.join(found, (F.col("key") == F.col("own")) & (F.col("vec") == F.col("own_vec")), "left")
    component = F.coalesce("component", "key")
    return shelf.last(
        out.select(
            F.col("key").alias(key),
            F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
            component.alias("component_id"),
            (F.col("key") == component).alias("kept"),
        )
    )
