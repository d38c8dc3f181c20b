"""Approximate nearest neighbours: a navigable small-world graph per shard, results merged."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush, heappushpop
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._work import Shelf, runs
from .neighbours import comparable, norms, unit_rows

#: Rows of a shard, which one task indexes, and queries that search a shard together.
SHARD_ROWS = 4096
QUERY_BLOCK = 2048

INDEX = "dim int, shard int, ids binary, starts binary, vec binary, entry int, nodes array<binary>, offsets array<binary>, targets array<binary>"


class Graph:
    """A hierarchical navigable small-world graph over the rows of a matrix of unit vectors."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.entry = 0
        self.levels: list[dict[int, list[int]]] = []  # neighbours per level and node

    def near(self, q: np.ndarray, start: list[tuple[float, int]], level: int, width: int) -> list[tuple[float, int]]:
        """The `width` most similar nodes that a best-first walk from `start` meets, best first."""
        links, x = self.levels[level], self.x
        seen = {i for _, i in start}
        waiting = [(-s, i) for s, i in start]
        waiting.sort()
        best = sorted(start)  # a heap, the worst first
        while len(best) > width:
            heappop(best)
        while waiting:
            distance, i = heappop(waiting)
            if len(best) >= width and -distance < best[0][0]:
                break
            new = [j for j in links[i] if j not in seen]
            if not new:
                continue
            seen.update(new)
            for s, j in zip((x[new] @ q).tolist(), new, strict=True):
                if len(best) < width:
                    heappush(best, (s, j))
                    heappush(waiting, (-s, j))
                elif s > best[0][0]:
                    heappushpop(best, (s, j))
                    heappush(waiting, (-s, j))
        return sorted(best, reverse=True)

    def spread(self, candidates: list[tuple[float, int]], most: int) -> list[int]:
        """Of candidates, best first, those more similar to the node than to any chosen before, and then the
        best of the others: close ones alone would cut a tight group off from the rest."""
        if len(candidates) <= most:
            return [i for _, i in candidates]
        at = [i for _, i in candidates]
        between = self.x[at] @ self.x[at].T
        chosen: list[int] = []
        closest = np.full(len(at), -2.0)
        for c, (s, _) in enumerate(candidates):
            if s > closest[c]:
                chosen.append(c)
                if len(chosen) == most:
                    break
                np.maximum(closest, between[c], out=closest)
        room = (most - len(chosen)) // 2
        if room > 0:
            held = set(chosen)
            chosen += [c for c in range(len(at)) if c not in held][:room]
        return [at[c] for c in chosen]

    @staticmethod
    def build(x: np.ndarray, links: int, width: int, seed: int) -> Graph:
        """Nodes come in one by one; a node's top level is geometric, as a function of the seed."""
        g = Graph(x)
        top_of = (-np.log(1.0 - np.random.default_rng(seed).random(len(x))) / np.log(links)).astype(int)
        for i in range(len(x)):
            q, top = x[i], int(top_of[i])
            highest = len(g.levels) - 1
            if highest >= 0:
                found = [(float(x[g.entry] @ q), g.entry)]
                for level in range(highest, top, -1):
                    found = g.near(q, found, level, 1)
                for level in range(min(top, highest), -1, -1):
                    found = g.near(q, found, level, width)
                    most = 2 * links if level == 0 else links
                    chosen = g.spread(found, links)
                    table = g.levels[level]
                    table[i] = chosen
                    for j in chosen:
                        back = table[j]
                        back.append(i)
                        if len(back) > most:
                            s = x[back] @ x[j]
                            order = np.argsort(-s, kind="stable")
                            table[j] = g.spread([(float(s[o]), back[o]) for o in order], most)
            while len(g.levels) <= top:
                g.levels.append({i: []})
                g.entry = i
        return g

    def flat(self) -> tuple[list[bytes], list[bytes], list[bytes]]:
        """Per level the nodes, where each one's neighbours start, and the neighbours, as flat arrays."""
        nodes, offsets, targets = [], [], []
        for table in self.levels:
            order = sorted(table)
            nodes.append(np.array(order, np.int32).tobytes())
            offsets.append(np.cumsum([0, *[len(table[i]) for i in order]], dtype=np.int32).tobytes())
            targets.append(np.array([j for i in order for j in table[i]], np.int32).tobytes())
        return nodes, offsets, targets

    @staticmethod
    def load(x: np.ndarray, entry: int, nodes: list[bytes], offsets: list[bytes], targets: list[bytes]) -> Graph:
        g = Graph(x)
        g.entry = entry
        for n, o, t in zip(nodes, offsets, targets, strict=True):
            at, flat = np.frombuffer(o, np.int32), np.frombuffer(t, np.int32).tolist()
            g.levels.append(
                {int(i): flat[a:b] for i, a, b in zip(np.frombuffer(n, np.int32), at[:-1], at[1:], strict=True)}
            )
        return g

    def search(self, q: np.ndarray, k: int, width: int) -> list[int]:
        found = [(float(self.x[self.entry] @ q), self.entry)]
        for level in range(len(self.levels) - 1, 0, -1):
            found = self.near(q, found, level, 1)
        return [i for _, i in self.near(q, found, 0, max(width, k))[:k]]


def sharded(vectors: DataFrame) -> DataFrame:
    """(dim, shards, shard, id, vec): about SHARD_ROWS rows of one dimension go to a shard, by a hash of the id."""
    rows = vectors.withColumn("dim", F.octet_length("vec"))
    sizes = rows.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("shards"))
    lot = F.pmod(F.xxhash64("id"), F.col("shards")).cast("int")
    return rows.join(sizes, "dim").select("dim", "shards", lot.alias("shard"), "id", "vec")


def build_index(vectors: DataFrame, kind: str, shards: int, links: int = 12, width: int = 64) -> DataFrame:
    """One row per shard: its distinct vectors, their ids, and their graph as flat neighbour arrays.

    `vectors` has the shard of each row (`sharded`), of one dimension.

    Equal vectors are one node, whose ids lie in order from its place in `starts`. A shard holds the rows that a hash of the id gives it, about SHARD_ROWS; every row is indexed.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["dim", "shard"]):
            dim, shard = part.column("dim")[0].as_py(), part.column("shard")[0].as_py()
            order = np.argsort(part.column("id").to_numpy())
            part = part.take(pa.array(order))
            node_of: dict[bytes, int] = {}
            node = np.array([node_of.setdefault(v, len(node_of)) for v in part.column("vec").to_pylist()])
            ids = part.column("id").to_numpy()[np.argsort(node, kind="stable")]
            starts = np.append(0, np.cumsum(np.bincount(node)))
            column = pa.array(list(node_of), pa.binary())
            g = Graph.build(unit_rows(column, kind), links, width, seed=shard)
            nodes, offsets, targets = g.flat()
            yield pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([dim], pa.int32()),
                    "shard": pa.array([shard], pa.int32()),
                    "ids": pa.array([ids.tobytes()], pa.binary()),
                    "starts": pa.array([starts.astype(np.int64).tobytes()], pa.binary()),
                    "vec": pa.array([b"".join(column.to_pylist())], pa.binary()),
                    "entry": pa.array([g.entry], pa.int32()),
                    "nodes": pa.array([nodes], pa.list_(pa.binary())),
                    "offsets": pa.array([offsets], pa.list_(pa.binary())),
                    "targets": pa.array([targets], pa.list_(pa.binary())),
                }
            )

    rows = vectors.select("dim", "shard", "id", "vec")
    return rows.repartition(shards, "dim", "shard").sortWithinPartitions("dim", "shard").mapInArrow(index, INDEX)


def search_index(index: DataFrame, queries: DataFrame, kind: str, k: int, width: int = 96) -> DataFrame:
    """(query_id, query_no, vec_id, score): each shard's k best others of each query (columns id, vec), the smaller id first among equals.

    Queries travel in blocks of one dimension, each block to every shard of it; a shard small next to the width is
    compared in full. `query_no` tells vectors of one key apart.
    """
    n = queries.count()
    blocks = max(1, ceil(n / QUERY_BLOCK))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(batches, ["dim", "block"]):
            yield pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array([part.column("dim")[0].as_py()], pa.int32()),
                    "shards": pa.array([part.column("shards")[0].as_py()], pa.int32()),
                    "q_nos": pa.array([part.column("no").to_numpy().tobytes()], pa.binary()),
                    "q_ids": pa.array([part.column("id").to_numpy().tobytes()], pa.binary()),
                    "q_vec": pa.array([b"".join(part.column("vec").to_pylist())], pa.binary()),
                }
            )

    lot = F.pmod(F.xxhash64("id", F.lit("q")), F.lit(blocks)).cast("int")
    dealt = queries.select(F.octet_length("vec").alias("dim"), lot.alias("block"), "id", "vec", F.xxhash64("vec").alias("no"))
    # A row per dimension.
    dealt = dealt.join(index.groupBy("dim").agg((F.max("shard") + 1).alias("shards")), "dim")
    blocked = dealt.repartition(blocks, "dim", "block").sortWithinPartitions("dim", "block")
    blocked = blocked.mapInArrow(gather, "dim int, shards int, q_nos binary, q_ids binary, q_vec binary")
    to_all = blocked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                ids, q_ids = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["q_ids"], np.int64)
                starts = np.frombuffer(r["starts"], np.int64)
                x = np.frombuffer(r["vec"], kind).reshape(len(starts) - 1, -1).astype(np.float64)
                q = np.frombuffer(r["q_vec"], kind).reshape(len(q_ids), -1).astype(np.float64)
                nx, nq = norms(x), norms(q)
                g = Graph.load(x / nx[:, None], r["entry"], r["nodes"], r["offsets"], r["targets"])
                unit = q / nq[:, None]
                nos = np.frombuffer(r["q_nos"], np.int64)
                found_q, found_id, found_score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
                found_no = [np.zeros(0, np.int64)]
                for j in range(len(q_ids)):
                    near = np.arange(len(x)) if len(x) <= width else np.array(g.search(unit[j], max(width, k + 1), width))
                    score = (q[j] * x[near]).sum(axis=1) / (nq[j] * nx[near])
                    # Of copies, the k smallest ids beside the query's own are enough.
                    copies = [ids[starts[v] : min(starts[v + 1], starts[v] + k + 1)] for v in near]
                    score = np.repeat(score, [len(c) for c in copies])
                    own = np.concatenate(copies)
                    score, own = score[own != q_ids[j]], own[own != q_ids[j]]
                    first = np.lexsort((own, -score))[:k]
                    found_q.append(np.full(len(first), q_ids[j]))
                    found_no.append(np.full(len(first), nos[j]))
                    found_id.append(own[first])
                    found_score.append(score[first])
                a, b, score = np.concatenate(found_q), np.concatenate(found_id), np.concatenate(found_score)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(np.concatenate(found_no)), pa.array(b), pa.array(score)],
                    names=["query_id", "query_no", "vec_id", "score"],
                )

    pairs = to_all.repartition("dim", "shard").join(index, ["dim", "shard"])
    return pairs.select("ids", "starts", "vec", "entry", "nodes", "offsets", "targets", "q_ids", "q_vec", "q_nos").mapInArrow(
        search, "query_id long, query_no long, vec_id long, score double"
    )


def nearest(
    embeddings: DataFrame,
    queries: DataFrame | None = None,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    every: int = 50,
    width: int = 96,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest others that the shards' graphs find.

    Queries are `queries` (same columns), or every row whose key `every` divides. Nearness is the cosine in double
    precision of the original vectors; ties go to the smaller key. A query with fewer candidates
    gets all of them. Vectors that are null, zero, or hold null or non-finite components take no part, and
    vectors of other dimensions than the query's are no candidates. Rows that agree in key and vector are one; differing
    vectors of one key are all candidates, but not of a query of that key, and each is a query of its own. Columns other
    than key and vector are not read, whatever their names. An empty table gives an empty table. The index
    is written to the shared folder, a row per shard, and read from there.
    """
    shelf = Shelf(embeddings.sparkSession, "small-worlds")
    sound, kind = comparable(embeddings, key, vector)
    vectors = shelf.put(sound)
    asked = vectors.filter(F.pmod(F.col("id"), F.lit(every)) == 0)
    if queries is not None:
        asked, asked_kind = comparable(queries, key, vector)
        if asked_kind != kind:
            raise ValueError("queries and vectors differ in their number format")
    shards = max(1, ceil(vectors.count() / SHARD_ROWS))
    index = shelf.put(build_index(sharded(vectors), kind, shards))
    found = search_index(index, asked, kind, k, width)
    place = F.row_number().over(Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
