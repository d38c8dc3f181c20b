"""Packing into length buckets whose boundaries minimise padding."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._ranks import ranked
from ._work import name, others
from .mixture import words

#: Lengths up to 2^12 stand for themselves; longer ones are rounded up to 12 leading bits. So the
#: histogram has at most 4,096 + 2,048 entries for each further doubling of the longest text.
_BITS = 12


def rounded(length: Column) -> Column:
    """The length's entry in the histogram: the length itself, or a little above it."""
    bits = F.greatest(F.length(F.bin(length)) - _BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", length + F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1, bits), bits).cast("long")


def best_boundaries(lengths: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """Upper boundaries of at most `buckets` buckets over a histogram, with the least padding.

    Padding is the sum of boundary minus length. `best[j]` is the least padding of the first j
    lengths in k buckets; the next layer tries every beginning of the last bucket. The cost of a
    bucket fulfils the quadrangle inequality, so the best beginning never moves back as j grows, and
    each layer is solved by halves, L log L instead of L squared. Ties go to the earliest beginning.
    """
    size = np.asarray(lengths, np.float64)
    n = len(size)
    if n == 0:
        return []
    rows = np.concatenate([[0.0], np.cumsum(np.asarray(counts, np.float64))])
    total = np.concatenate([[0.0], np.cumsum(size * np.asarray(counts, np.float64))])

    def cost(i, j):
        """Padding of one bucket over lengths i to j - 1."""
        return size[j - 1] * (rows[j] - rows[i]) - (total[j] - total[i])

    best = np.full(n + 1, np.inf)
    best[0] = 0.0
    best[1:] = cost(0, np.arange(1, n + 1))
    choices = []
    for _ in range(min(buckets, n) - 1):
        nxt, choice = best.copy(), np.full(n + 1, -1)
        pending = [(1, n, 0, n - 1)]
        while pending:
            low, high, first, last = pending.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(last, j - 1) + 1)
            values = best[i] + cost(i, j)
            at = int(np.argmin(values))
            if values[at] < nxt[j]:
                nxt[j], choice[j] = values[at], i[at]
            pivot = int(i[at])
            pending.append((low, j - 1, first, pivot))
            pending.append((j + 1, high, pivot, last))
        choices.append(choice)
        best = nxt
    ends, j = [], n
    for choice in reversed(choices):
        if j == 0:
            break
        if choice[j] < 0:  # fewer buckets do as well
            continue
        ends.append(j)
        j = int(choice[j])
    if j:
        ends.append(j)
    return [int(size[e - 1]) for e in reversed(ends)]


def pack(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    length: str | None = None,
    buckets: int = 16,
    budget: int = 16_384,
) -> DataFrame:
    """`docs` with `length`, `bucket`, `boundary`, `batch`, `place` and `padding`.

    Lengths are words unless the column `length` holds them (such as tokens). The global histogram
    of lengths, the only thing the driver gets, gives at most `buckets` boundaries with the least
    padding. Inside a bucket, documents stand in the order of their key's digest, and a
    batch takes as many as fit in `budget` at the boundary's length, at least one: a text longer
    than the budget is a batch of its own, whole. `batch` counts from 0 inside the bucket and
    `place` inside the batch; all batches of a bucket but its last are full.

    Null and empty texts have length 0 and share the lowest bucket. Rows that agree in key and text
    stand in any order. Output columns replace input columns of the same name. An empty table
    gives an empty table.
    """
    rest = others(docs, "length", "bucket", "boundary", "batch", "place", "padding")
    measured = F.coalesce(name(length).cast("long"), F.lit(0)) if length else words(name(text))
    histogram = (
        docs.select(measured.alias("n")).groupBy(rounded(F.col("n")).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    )
    found = sorted((r["n"], r["rows"]) for r in histogram.collect())
    ends = best_boundaries([n for n, _ in found], [c for _, c in found], buckets)
    ends = ends or [0]
    sized = docs.select(
        *rest,
        measured.alias("length"),
        F.md5(F.coalesce(name(key).cast("string"), F.lit(""))).alias("_llm_digest"),
        name(key).alias("_llm_key"),
        F.xxhash64(name(text)).alias("_llm_text"),
    )
    bucket = F.lit(len(ends) - 1)
    for i in reversed(range(len(ends) - 1)):
        bucket = F.when(F.col("length") <= ends[i], i).otherwise(bucket)
    sized = sized.withColumn("bucket", bucket.cast("int")).withColumn(
        "_llm_range", F.substring("_llm_digest", 1, 3)
    )
    order = ["_llm_digest", "_llm_key", "_llm_text"]
    placed = ranked(sized, ["bucket", "_llm_range"], order, "_llm_rank")
    boundary = F.element_at(F.array(*[F.lit(e).cast("long") for e in ends]), F.col("bucket") + 1)
    placed = placed.withColumn("boundary", boundary)
    per_batch = F.greatest(F.expr(f"{int(budget)} div greatest(boundary, 1)"), F.lit(1).cast("long"))
    return placed.select(
        *rest,
        "length",
        "bucket",
        "boundary",
        ((F.col("_llm_rank") - F.col("_llm_rank") % per_batch) / per_batch).cast("long").alias("batch"),
        (F.col("_llm_rank") % per_batch).alias("place"),
        (F.col("boundary") - F.col("length")).alias("padding"),
    )
