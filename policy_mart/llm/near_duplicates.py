"""Near-duplicate texts by ProbMinHash signatures, banding and exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._graph import components
from ._ranks import ranked
from ._text import chunks, mix64, shingles
from ._work import Shelf, name, others, runs

_STEP = np.uint64(0xD1342543DE82EF95)
#: Texts of a block, and shingles that are compared at once.
BLOCK, COLUMNS = 128, 8192


def signatures(hashes: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int, size: int) -> np.ndarray:
    """ProbMinHash signatures (n x size) of weighted shingles.

    Each shingle sends a Poisson process of arrivals at the rate of its weight, each to a random one of the
    `size` registers. A register keeps the shingle that arrives first, so two texts agree
    in a register with the probability Jaccard of their weights. Shingles go on arriving in rounds, and one
    stops as soon as its clock passes the latest register of its text: nothing it sends can win then.
    """
    first = np.full(n * size, np.inf)
    winner = np.zeros(n * size, np.uint64)
    clock = np.zeros(len(hashes))
    state = hashes.copy()
    hashes, owner, rate = hashes.copy(), owner.copy(), weight.astype(np.float64)
    while len(hashes):
        state = mix64(state + _STEP)
        # The upper 53 bits give the waiting time, and a second scrambling the register.
        clock = clock - np.log1p(-((state >> np.uint64(11)).astype(np.float64) * 2.0**-53)) / rate
        at = owner * size + (mix64(state ^ _STEP) % np.uint64(size)).astype(np.int64)
        np.minimum.at(first, at, clock)
        won = first[at] == clock
        winner[at[won]] = hashes[won]
        latest = first.reshape(n, size).max(axis=1)
        going = clock < latest[owner]
        state, clock, hashes, owner, rate = state[going], clock[going], hashes[going], owner[going], rate[going]
    return winner.reshape(n, size)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band of a signature's registers."""
    n, size = signature.shape
    rows = size // bands
    parts = signature[:, : bands * rows].reshape(n, bands, rows)
    key = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64))[None, :], (n, bands)).copy()
    for r in range(rows):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[float, float]:
    """Probability Jaccard and plain Jaccard of two weighted sets, each (sorted hashes, weights).

    Probability Jaccard is the sum, over common elements i, of 1 / sum_j max(a_j / a_i, b_j / b_i). With the
    common elements ordered by a / b, the inner sum is a suffix sum of a and a prefix sum of b.
    """
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0, 0.0
    plain = len(ia) / (len(a[0]) + len(b[0]) - len(ia))
    x, y = a[1][ia].astype(np.float64), b[1][ib].astype(np.float64)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    only_a, only_b = float(a[1].sum()) - x.sum(), float(b[1].sum()) - y.sum()
    above = np.cumsum(x[::-1])[::-1] + only_a  # elements whose a weighs as much or more
    below = np.cumsum(y) - y + only_b
    return float((1.0 / (above / x + below / y)).sum()), plain


def importance(count: np.ndarray) -> np.ndarray:
    """The weight of a shingle that a text has `count` times: dampened, so that a phrase repeated over and over
    does not outweigh all the rest of two texts."""
    return 1.0 + np.log(count)


def _banded(texts: DataFrame, width: int, size: int, bands: int) -> DataFrame:
    """(node, key): the band keys of texts (columns node, text); none for texts without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1).to_pylist()
            for a, b in chunks(column):
                hashes, owner, count = shingles(column[a:b], width)
                present, owner = np.unique(owner, return_inverse=True)
                if not len(present):
                    continue
                keys = band_keys(signatures(hashes, owner, importance(count), len(present), size), bands)
                rows = pa.array(np.repeat(a + present, bands))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), pa.array(keys.ravel())], names=["node", "key"]
                )

    return texts.select("node", "text").mapInArrow(sign, "node binary, key long")


def _verified(pairs: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar: by whole texts, joined to the pairs by node."""
    both = (
        pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .select("a", "b", "text_a", "text_b")
    )

    def weighted(text: str) -> tuple[np.ndarray, np.ndarray]:
        hashes, _, count = shingles([text], width)
        order = np.argsort(hashes)
        return hashes[order], importance(count[order])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sets = None, None  # the pairs of a node often follow one another
        for batch in batches:
            keep = []
            ids, left, right = batch.column(0), batch.column(2), batch.column(3)
            for i in range(batch.num_rows):
                node = ids[i].as_py()
                if node != held:
                    held, sets = node, weighted(left[i].as_py())
                keep.append(max(similarity(sets, weighted(right[i].as_py()))) >= threshold)
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    return both.mapInArrow(verify, "a binary, b binary")


def _prefix_pairs(nodes: DataFrame, texts: DataFrame, shelf: Shelf, width: int, threshold: float) -> DataFrame:
    """(a, b): the pairs of nodes (columns node, root, centre) of different roots and centres that could be
    similar; no similar pair is missing.

    Each node lists its shingles by how few nodes have them. If fractions u and v of two texts' weight are not
    common, their probability Jaccard is at most (1 - u)(1 - v) / (1 - u v), and their plain Jaccard is just that, u and v
    being fractions of the number. All that stands before a pair's first common shingle is not common. So the
    lists meet only where what stands before a shingle on either side leaves room for `threshold`. A passage that
    many texts share comes last in their lists and makes no pairs of them, unless it is nearly all they have.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3).to_pylist()
            for a, b in chunks(column):
                hashes, owner, count = shingles(column[a:b], width)
                weight = importance(count)
                at = pa.array(a + owner)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at),
                        batch.column(1).take(at),
                        batch.column(2).take(at),
                        pa.array(hashes.view(np.int64)),
                        pa.array(weight),
                        pa.array(np.bincount(owner, weight, minlength=b - a)[owner]),
                        pa.array(np.bincount(owner, minlength=b - a)[owner]),
                    ],
                    names=["node", "root", "centre", "shingle", "weight", "all_weight", "all_n"],
                )

    schema = "node binary, root binary, centre binary, shingle long, weight double, all_weight double, all_n long"
    rows = shelf.put(texts.join(nodes, "node").select("node", "root", "centre", "text").mapInArrow(listed, schema))
    # Shingles of one node alone come first in every list; it is enough to know how many there are.
    spread = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("nodes"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    ordered = Window.partitionBy("node").orderBy("nodes", "shingle")
    whole = Window.partitionBy("node")
    n_before = F.col("all_n") - F.count(F.lit(1)).over(whole) + F.row_number().over(ordered) - 1
    weight_before = F.col("all_weight") - F.sum("weight").over(whole) + F.sum("weight").over(ordered) - F.col("weight")
    placed = rows.join(spread.filter("nodes > 1"), "shingle").select(
        "shingle", "node", "root", "centre", "lo", "hi", (n_before / F.col("all_n")).alias("u_n"), (weight_before / F.col("all_weight")).alias("u_w")
    )
    least = F.lit(threshold - 1e-9)
    room = (1 - F.col("u_n") >= least) | (1 - F.col("u_w") >= least)
    prefix = shelf.put(placed.filter(room & (F.col("lo") < F.col("hi"))).drop("lo", "hi"))
    other = prefix.select("shingle", *[F.col(c).alias(f"{c}_a") for c in ("node", "root", "centre", "u_n", "u_w")])

    def bound(u: str):
        v = F.col(f"{u}_a")
        return (1 - F.col(u)) * (1 - v) >= least * (1 - F.col(u) * v)

    apart = (F.col("root") != F.col("root_a")) & (F.col("centre") != F.col("centre_a")) & (F.col("node_a") < F.col("node"))
    met = prefix.join(other, "shingle").filter(apart & (bound("u_n") | bound("u_w")))
    return met.select(F.col("node_a").alias("a"), F.col("node").alias("b"))


def _block_links(nodes: DataFrame, texts: DataFrame, width: int, threshold: float) -> DataFrame:
    """(a, b): the similar pairs of nodes (columns node, root, centre) of the same centre and different roots.

    Around an original there may be thousands of texts that are nearly, but not quite, similar to each other.
    They are compared in pairs of blocks: products of matrices give what two texts have in common, and
    only links come out. Blocks are in the order of roots, and those of one root alone do not meet.
    """
    cells = nodes.select("*", F.hex(F.substring("root", 1, 1)).alias("roots"), F.hex(F.substring("node", 1, 1)).alias("part"))
    placed = ranked(cells, ["centre", "roots", "root", "part"], ["node"], "rank")
    placed = placed.select("node", "root", "centre", F.floor(F.col("rank") / BLOCK).cast("int").alias("block"))
    spread = placed.groupBy("centre", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    other = spread.select("centre", *[F.col(c).alias(f"{c}_b") for c in ("block", "lo", "hi")])
    meet = (F.col("block") <= F.col("block_b")) & ((F.col("lo") != F.col("hi_b")) | (F.col("hi") != F.col("lo_b")))
    pairs = spread.join(other, "centre").filter(meet).select("centre", F.col("block").alias("i"), F.col("block_b").alias("j"))
    sides = pairs.select("centre", "i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    rows = (
        sides.join(placed, ["centre", "block"])
        .join(texts, "node")
        .select(F.xxhash64("centre", "i", "j").alias("group"), "i", "j", "block", "node", "root", "text")
        .repartition("group")
        .sortWithinPartitions("group", "i", "j")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["group", "i", "j"]):
            a, b = _links_in(part, width, threshold)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return rows.mapInArrow(compare, "a binary, b binary")


def _links_in(part: pa.Table, width: int, threshold: float) -> tuple[list[bytes], list[bytes]]:
    """The similar pairs of different roots between two blocks (or within one) of texts."""
    block, node, root = (part.column(c).to_pylist() for c in ("block", "node", "root"))
    left = [k for k, x in enumerate(block) if x == part.column("i")[0].as_py()]
    right = [k for k, x in enumerate(block) if x == part.column("j")[0].as_py()]
    hashes, owner, count = shingles(part.column("text").to_pylist(), width)
    weight = importance(count)
    all_n, all_w = np.bincount(owner, minlength=len(block)), np.bincount(owner, weight, minlength=len(block))
    _, column, times = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = times[column] > 1  # what one text has alone is common to none
    order = np.flatnonzero(shared)[np.argsort(column[shared], kind="stable")]
    column, row, weight_of = column[order], owner[order], weight[order]
    common, common_x, common_y = (np.zeros((len(left), len(right))) for _ in range(3))
    edges = np.flatnonzero(np.diff(column, prepend=-1))  # where a column begins
    for first in range(0, len(edges), COLUMNS):
        a = edges[first]
        b = edges[first + COLUMNS] if first + COLUMNS < len(edges) else len(column)
        _, c = np.unique(column[a:b], return_inverse=True)
        has, weighs = np.zeros((2, len(block), c.max() + 1), np.float32)
        has[row[a:b], c], weighs[row[a:b], c] = 1.0, weight_of[a:b]
        common += has[left] @ has[right].T
        common_x += weighs[left] @ has[right].T
        common_y += has[left] @ weighs[right].T
    plain = common / np.maximum(all_n[left][:, None] + all_n[right][None, :] - common, 1)
    x, y = common_x / np.maximum(all_w[left][:, None], 1e-300), common_y / np.maximum(all_w[right][None, :], 1e-300)
    most = x * y / np.maximum(x + y - x * y, 1e-300)  # what probability Jaccard can be, at most
    apart = np.array([[root[p] != root[q] for q in right] for p in left], bool).reshape(common.shape)
    if left == right:
        apart &= np.triu(np.ones_like(apart), 1)
    found: tuple[list[bytes], list[bytes]] = ([], [])
    sets: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for p, q in zip(*np.nonzero(apart & ((plain >= threshold) | (most >= threshold - 1e-4))), strict=True):
        pair = []
        for k in (left[p], right[q]):
            if k not in sets:
                own = owner == k
                by = np.argsort(hashes[own])
                sets[k] = (hashes[own][by], weight[own][by])
            pair.append(sets[k])
        if max(similarity(*pair)) >= threshold:
            found[0].append(node[left[p]])
            found[1].append(node[right[q]])
    return found


def classes(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    width: int = 5,
    threshold: float = 0.8,
    size: int = 160,
    bands: int = 32,
    star_rounds: int = 1,
) -> DataFrame:
    """One row per distinct text (`node`, its digest): `class_id`, `class_rows`, the text (`first_node`)
    and number of rows (`repeats`) of the class's first key. See `near_duplicates`."""
    shelf = Shelf(docs.sparkSession, "near-duplicates")
    node = F.unhex(F.md5(name(text)))
    source = docs.select(node.alias("node"), name(text).alias("text")).filter(F.length("text") > 0)
    banded = shelf.put(_banded(source, width, size, bands).distinct())
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    buckets = shelf.put(banded.join(shared, "key"))
    shelf.drop(banded)
    nodes = buckets.select("node").distinct()
    texts = shelf.put(source.join(nodes, "node", "left_semi").dropDuplicates(["node"]))

    # The node that meets most others, such as the original of many copies, is the first centre.
    degree = buckets.join(buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key").groupBy("node").agg(F.sum("n").alias("degree"))
    buckets = shelf.put(buckets.join(degree, "node"))

    tried: list[tuple[DataFrame, DataFrame]] = []  # pairs, and those of them that are linked
    roots: DataFrame | None = None
    for turn in range(star_rounds + 1):
        members = buckets if roots is None else buckets.join(roots, "node", "left")
        root = F.col("node") if roots is None else F.coalesce("root", "node")
        members = members.select("key", "node", "degree", root.alias("root"))
        # Buckets that lie in one component have nothing left to say.
        spread = members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi")
        members = members.join(spread.select("key"), "key", "left_semi")
        if turn < star_rounds:
            lot = -F.col("degree") if turn == 0 else F.xxhash64(F.lit(turn), "node")
            lot = F.struct(lot.alias("lot"), "node", "root")
            centre = members.groupBy("key").agg(F.min(lot).alias("c"))
            centre = centre.select("key", F.col("c.node").alias("a"), F.col("c.root").alias("root_a"))
            pairs = members.join(centre, "key").filter("root <> root_a").select("a", F.col("node").alias("b"))
        else:
            centre = members.groupBy("key").agg(F.max(F.struct("degree", "node")).alias("c"))
            nodes = members.join(centre, "key").groupBy("node", "root").agg(F.max("c").alias("c"))
            nodes = shelf.put(nodes.select("node", "root", F.col("c.node").alias("centre")))
            pairs = _prefix_pairs(nodes, texts, shelf, width, threshold)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        for seen, _ in tried:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        pairs = shelf.put(pairs)
        found = _verified(pairs, texts, width, threshold)
        if turn == star_rounds:
            found = found.unionByName(_block_links(nodes, texts, width, threshold))
        found = shelf.put(found)
        tried.append((pairs, found))
        if not found.isEmpty():
            roots = components(reduce(DataFrame.unionByName, [f for _, f in tried]), shelf)

    rows = docs.filter(F.length(name(text)) > 0).groupBy(node.alias("node"), name(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    first = F.struct(F.col("key").isNull().alias("none"), F.col("key").alias("key"), "node", F.col("n").alias("repeats"))
    own = rows.groupBy("node").agg(F.sum("n").alias("n"), F.min(first).alias("first"))
    if roots is None:
        joined = own.withColumn("root", F.col("node"))
    else:
        joined = own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    whole = joined.groupBy("root").agg(F.sum("n").alias("class_rows"), F.min("first").alias("first"))
    table = joined.select("node", "root").join(whole, "root").select(
        "node",
        F.col("first.key").alias("class_id"),
        "class_rows",
        F.col("first.node").alias("first_node"),
        F.col("first.repeats").alias("repeats"),
    )
    return shelf.last(table)


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """`docs` with `class_id`, `class_rows` and `kept`: classes of copies and near copies.

    Equal texts are one node. Two nodes are linked if they share a band of their ProbMinHash
    signatures and their exact probability Jaccard, or plain Jaccard, over shingles of `width`
    words weighted by dampened count is `threshold` or more; a pair at 0.8 shares no band with probability
    3e-6. Classes are the components of the links; `class_id` is the smallest key in the class,
    and the row with it, in the first of its texts, is `kept`. Rows that agree in key and text are the
    same document and share `kept`; `one_of_each` leaves one of them.

    A bucket never emits its pairs. In star rounds each bucket's nodes are verified against one node of it, first the
    one that meets most others, then, in further rounds, one by lot, and components found so far are left out, so a group of thousands of near copies costs
    a few verifications a node. The nodes of buckets that are still in several components are then
    compared without loss: those around the same centre in blocks (`_block_links`), which emit links only, and
    others where an exact prefix filter lets them meet (`_prefix_pairs`).

    Null texts and texts without words are classes of their own, except equal non-empty ones. Keys may be null or
    repeat: a null key is never the smallest unless the class has no other. Output columns replace input columns of the same name. An empty
    table gives an empty table. For `settings` see `classes`.
    """
    return _with_classes(docs, classes(docs, text, key, **settings), text, key)


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", **settings) -> DataFrame:
    """The kept documents of `near_duplicates`, once each. Only if a kept document is repeated are rows
    compared, by key and text. Null and empty texts are no copies of each other, so all of them stay."""
    table = classes(docs, text, key, **settings)
    kept = _with_classes(docs, table, text, key).filter("kept")
    columns = [name(c) for c in docs.columns]
    if table.filter("repeats > 1").isEmpty():
        return kept.select(*columns)
    same = [name(key).alias("_llm_key"), F.md5(name(text)).alias("_llm_text"), (F.coalesce(F.length(name(text)), F.lit(0)) == 0).alias("_llm_blank")]
    rows = kept.select(*columns, *same)
    once = rows.filter(~F.col("_llm_blank")).dropDuplicates(["_llm_key", "_llm_text"])
    return once.unionByName(rows.filter("_llm_blank")).select(*columns)


def _with_classes(docs: DataFrame, table: DataFrame, text: str, key: str) -> DataFrame:
    rest = others(docs, "class_id", "class_rows", "kept")
    frame = docs.select(*rest, F.unhex(F.md5(name(text))).alias("_llm_node"), name(key).alias("_llm_key"))
    table = table.select(*[F.col(c).alias(f"_llm_{c}") for c in ("node", "class_id", "class_rows", "first_node")])
    out = frame.join(table, "_llm_node", "left")
    alone = F.col("_llm_class_rows").isNull()
    is_first = F.col("_llm_key").eqNullSafe(F.col("_llm_class_id")) & (F.col("_llm_node") == F.col("_llm_first_node"))
    return out.select(
        *rest,
        F.when(alone, F.col("_llm_key")).otherwise(F.col("_llm_class_id")).alias("class_id"),
        F.coalesce("_llm_class_rows", F.lit(1).cast("long")).alias("class_rows"),
        (alone | is_first).alias("kept"),
    )
