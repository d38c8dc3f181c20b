"""Quality by perplexity: an interpolated modified Kneser-Ney model of characters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import chunks, code_points, mix64
from ._work import Shelf, name, others

#: What stands before a text.
START = "\n"
#: Most entries of a model that is sent to every task; a larger one is joined. An entry takes 24 bytes there.
SENT_ENTRIES = 2_000_000


def _padded(texts: Sequence[str | None], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts, each behind `order` - 1 start marks, and where each text's own begin.

    Runs of white space are one blank and digits are 0, so that layout and numbers don't count.
    """
    clean = [START * (order - 1) + " ".join((t or "").split()) for t in texts]
    codes = code_points("".join(clean)).copy() if clean else np.zeros(0, np.uint32)
    codes[(codes >= 48) & (codes <= 57)] = 48
    sizes = np.array([len(c) for c in clean], np.int64)
    return codes.astype(np.uint64), np.cumsum(sizes) - sizes


def _windows(codes: np.ndarray, starts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The first positions of the n-grams that lie in one text, and the text of each."""
    sizes = np.diff(np.append(starts, len(codes))) - order + 1
    owner = np.repeat(np.arange(len(starts)), sizes)
    return np.arange(len(owner)) + owner * (order - 1), owner


def _hash(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the n code points from each position."""
    h = np.full(len(at), np.uint64(n + 1))
    for k in range(n):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += codes[at + k]
    return mix64(h)


def count_ngrams(texts: DataFrame, order: int) -> DataFrame:
    """(gram, n): how often each n-gram of the highest order occurs in all texts of a frame's first
    column. Tasks count first and send each of their n-grams once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, grams, counts = np.zeros(0, np.uint64), np.zeros((0, order), np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            column = batch.column(0).to_pylist()
            for a, b in chunks(column):
                codes, starts = _padded(column[a:b], order)
                at, _ = _windows(codes, starts, order)
                key, first, n = np.unique(_hash(codes, at, order), return_index=True, return_counts=True)
                gram = codes[at[first][:, None] + np.arange(order)[None, :]] if len(at) else grams[:0]
                keys, where = np.unique(np.concatenate([keys, key]), return_inverse=True)
                summed = np.bincount(where, np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
                merged = np.zeros((len(keys), order), np.uint64)
                merged[where] = np.concatenate([grams, gram])
                grams, counts = merged, summed
        for i in range(0, len(keys), 50_000):
            rows = grams[i : i + 50_000].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            parts = [rows[j : j + order] for j in range(0, len(rows), order)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts, pa.string()), pa.array(counts[i : i + 50_000])], names=["gram", "n"]
            )

    return texts.mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> list[float]:
    """The discounts of n-grams seen once, twice and more often, from the counts of counts."""
    row = counts.agg(*[F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (row[f"n{k}"] for k in (1, 2, 3, 4))
    if not (n1 and n2):  # too few counts for an estimate
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(found)]


def train(texts: DataFrame, shelf: Shelf, order: int = 5) -> DataFrame:
    """The model (gram, size, p, back): probability of a gram's last character after the others, and
    the weight that it gives, as a context, to the next lower order.

    The highest order counts occurrences, each lower one the distinct characters in front. Counts are
    joined to the totals of their contexts, and probabilities to those of the next lower order, by
    shuffles on the gram; the lowest order is mixed with equal shares of all characters and one
    unseen.
    """
    counts = {order: shelf.put(count_ngrams(texts, order))}
    for size in range(order - 1, 0, -1):
        above = counts[size + 1]
        counts[size] = shelf.put(above.groupBy(F.substring("gram", 2, size).alias("gram")).agg(F.count(F.lit(1)).alias("n")))
    lower: DataFrame | None = None
    back: dict[int, DataFrame] = {}
    grams: dict[int, DataFrame] = {}
    for size in range(1, order + 1):
        c = counts[size]
        d = _discounts(c)
        off = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        context = F.substring("gram", 1, size - 1)
        totals = c.groupBy(context.alias("context")).agg(
            F.sum("n").cast("double").alias("total"), F.sum(off).alias("freed")
        )
        totals = totals.select("context", "total", (F.col("freed") / F.col("total")).alias("back"))
        rows = c.select("gram", "n", context.alias("context"), F.substring("gram", 2, size - 1).alias("suffix"))
        rows = rows.withColumn("kept", F.greatest(F.col("n") - off, F.lit(0.0))).join(totals, "context")
        if size == 1:
            characters = c.count() + 1
            p = F.col("kept") / F.col("total") + F.col("back") / F.lit(float(characters))
            unseen = totals.select((F.col("back") / F.lit(float(characters))).alias("p"))
            grams[0] = unseen.select(F.lit("").alias("gram"), F.lit(0).alias("size"), "p")
        else:
            rows = rows.join(lower.select(F.col("gram").alias("suffix"), F.col("p").alias("p_lower")), "suffix")
            p = F.col("kept") / F.col("total") + F.col("back") * F.col("p_lower")
            back[size - 1] = totals.select(F.col("context").alias("gram"), "back")
        lower = shelf.put(rows.select("gram", p.alias("p")))
        grams[size] = lower.withColumn("size", F.lit(size))
    out = []
    for size in range(order + 1):
        # A context of start marks alone is no gram, but gives weight all the same.
        with_back = grams[size].select("gram", "size", "p")
        if size in back:
            with_back = with_back.join(back[size], "gram", "full").select(
                "gram", F.lit(size).alias("size"), "p", "back"
            )
        else:
            with_back = with_back.withColumn("back", F.lit(None).cast("double"))
        out.append(with_back)
    return shelf.put(reduce(DataFrame.unionByName, out))


def _keyed(model: DataFrame) -> DataFrame:
    """(key, size, log_p, log_back) of a model: grams by their hash, absent values as NaN."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column(0).to_pylist()
            sizes = np.array([len(g) for g in grams], np.int64)
            codes = code_points("".join(grams)).astype(np.uint64)
            starts = np.cumsum(sizes) - sizes
            keys = np.zeros(len(grams), np.uint64)
            for size in np.unique(sizes):
                here = np.flatnonzero(sizes == size)
                keys[here] = _hash(codes, starts[here], int(size))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *batch.columns[1:]], names=["key", "log_p", "log_back"])

    nan = F.lit(float("nan"))
    logs = model.select("gram", F.coalesce(F.log("p"), nan).alias("log_p"), F.coalesce(F.log("back"), nan).alias("log_back"))
    return logs.mapInArrow(hashed, "key long, log_p double, log_back double")


class Tables:
    """The model as sorted arrays: log-probabilities and log-weights by the hash of a gram."""

    def __init__(self, keyed: pa.Table, order: int):
        self.order = order
        keys = keyed.column("key").to_numpy().view(np.uint64)
        by = np.argsort(keys)
        self.keys = keys[by]
        self.log_p = keyed.column("log_p").to_numpy()[by]
        self.log_back = keyed.column("log_back").to_numpy()[by]
        nothing = _hash(np.zeros(0, np.uint64), np.zeros(1, np.int64), 0)
        self.unseen = float(self.log_p[np.searchsorted(self.keys, nothing[0])])

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return at, self.keys[at] == keys

    def score(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The log-probability of the last character of each full-order gram: that of the longest
        end of the gram in the model, after the weights of the longer contexts it is not seen in."""
        key, first, where = np.unique(_hash(codes, at, self.order), return_index=True, return_inverse=True)
        begin, total = at[first], np.zeros(len(key))
        open_ = np.arange(len(key))
        for size in range(self.order, 0, -1):
            place, known = self.find(_hash(codes, begin[open_] + self.order - size, size))
            known &= ~np.isnan(self.log_p[place])
            total[open_[known]] += self.log_p[place[known]]
            open_ = open_[~known]
            if not len(open_):
                break
            if size > 1:
                place, known = self.find(_hash(codes, begin[open_] + self.order - size, size - 1))
                weight = self.log_back[place]
                known &= ~np.isnan(weight)
                total[open_[known]] += weight[known]
        total[open_] += self.unseen
        return total[where]


def _scored_by_task(docs: DataFrame, text: str, model: DataFrame, order: int, kept: list) -> DataFrame:
    """`kept` columns with _llm_chars and _llm_log, by a model that every task holds."""
    tables = Tables(_keyed(model).toArrow(), order)
    shared = docs.sparkSession.sparkContext.broadcast(tables)

    @F.pandas_udf("chars long, log double")
    def score(texts: pd.Series) -> pd.DataFrame:
        column = [t if isinstance(t, str) else None for t in texts]
        chars, logs = [], []
        for a, b in chunks(column):
            codes, starts = _padded(column[a:b], order)
            at, owner = _windows(codes, starts, order)
            chars.append(np.bincount(owner, minlength=b - a))
            logs.append(np.bincount(owner, shared.value.score(codes, at) if len(at) else None, minlength=b - a))
        empty = np.zeros(0)
        return pd.DataFrame(
            {"chars": np.concatenate([empty, *chars]).astype(np.int64), "log": np.concatenate([empty, *logs])}
        )

    found = docs.select(*kept, score(name(text)).alias("_llm_s"))
    columns = [name(c) for c in found.columns if c != "_llm_s"]
    return found.select(*columns, F.col("_llm_s.chars").alias("_llm_chars"), F.col("_llm_s.log").alias("_llm_log"))


def _scored_by_joins(docs: DataFrame, text: str, model: DataFrame, order: int, kept: list, shelf: Shelf) -> DataFrame:
    """The same by joins on the gram, for a model too large to send: the distinct n-grams of all texts
    are scored once, and each text, known by its digest, adds up the scores of its own."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1).to_pylist()
            for a, b in chunks(column):
                codes, starts = _padded(column[a:b], order)
                at, owner = _windows(codes, starts, order)
                if not len(at):
                    continue
                key = _hash(codes, at, order) ^ mix64(owner.astype(np.uint64) + np.uint64(1))
                _, first, n = np.unique(key, return_index=True, return_counts=True)
                flat = codes[at[first][:, None] + np.arange(order)[None, :]].astype("<u4").tobytes()
                joined = flat.decode("utf-32-le", "surrogatepass")
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(a + owner[first])),
                        pa.array([joined[j : j + order] for j in range(0, len(joined), order)], pa.string()),
                        pa.array(n),
                    ],
                    names=["doc", "gram", "n"],
                )

    digest = F.md5(name(text))
    texts = docs.select(digest.alias("doc"), name(text).alias("text")).filter("doc is not null").dropDuplicates(["doc"])
    rows = shelf.put(texts.mapInArrow(grams, "doc string, gram string, n long"))
    seen = rows.select("gram").distinct().withColumn("log", F.lit(0.0)).withColumn("done", F.lit(False))
    for size in range(order, 0, -1):
        end = F.substring("gram", order - size + 1, size)
        p = model.filter((F.col("size") == size) & F.col("p").isNotNull()).select(
            F.col("gram").alias("end"), F.log("p").alias("log_p")
        )
        seen = seen.withColumn("end", end).join(p, "end", "left")
        hit = ~F.col("done") & F.col("log_p").isNotNull()
        seen = seen.select(
            "gram",
            F.when(hit, F.col("log") + F.col("log_p")).otherwise(F.col("log")).alias("log"),
            (F.col("done") | hit).alias("done"),
        )
        if size > 1:
            b = model.filter((F.col("size") == size - 1) & F.col("back").isNotNull()).select(
                F.col("gram").alias("context"), F.log("back").alias("log_b")
            )
            seen = seen.withColumn("context", F.substring("gram", order - size + 1, size - 1)).join(b, "context", "left")
            more = F.when(F.col("done") | F.col("log_b").isNull(), 0.0).otherwise(F.col("log_b"))
            seen = seen.select("gram", (F.col("log") + more).alias("log"), "done")
    unseen = float(np.log(model.filter("size = 0").first()["p"]))
    seen = seen.select("gram", F.when(F.col("done"), F.col("log")).otherwise(F.col("log") + F.lit(unseen)).alias("log"))
    totals = rows.join(seen, "gram").groupBy("doc").agg(
        F.sum("n").alias("_llm_chars"), F.sum(F.col("n") * F.col("log")).alias("_llm_log")
    )
    totals = totals.withColumnRenamed("doc", "_llm_doc")
    found = docs.select(*kept, digest.alias("_llm_doc")).join(totals, "_llm_doc", "left").drop("_llm_doc")
    return found.withColumn("_llm_chars", F.coalesce("_llm_chars", F.lit(0).cast("long")))


def score_quality(
    docs: DataFrame,
    trusted: DataFrame,
    text: str = "text",
    lang: str = "lang",
    order: int = 5,
    fences: float = 4.0,
    prior_chars: int = 100,
    sent_entries: int = SENT_ENTRIES,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """`docs`, or `columns` of it, with `n_scored` (characters), `perplexity` (per character), `adjusted`, `threshold` and `kept`.

    The model learns from all of `trusted` (its column `text`). A short text's perplexity says little, so
    `adjusted` mixes it, on the log scale, with `prior_chars` characters at the median of its
    language. Each language's threshold lies `fences` times its interquartile range above the upper quartile of
    the log of `adjusted`, over all its documents: quartiles do not move with what lies far out,
    and documents above the threshold are not kept. A null language is a language of its own. A
    model of at most `sent_entries` n-grams, counted first, is sent to the tasks; a larger one is joined, with
    the same result.

    Null and empty texts have no perplexity and are not kept. Without trusted text, nothing has a
    perplexity, and all but those are kept. Ties are kept. Output columns replace input columns of
    the same name. An empty table gives an empty table.
    """
    shelf = Shelf(docs.sparkSession, "kneser-ney")
    kept = others(
        docs.select(*[name(c) for c in columns]) if columns else docs, "n_scored", "perplexity", "adjusted", "threshold", "kept"
    )
    kept.append(name(lang).alias("_llm_language"))
    known = trusted.select(name(text)).filter(name(text).rlike(r"\S"))
    model = train(known, shelf, order)
    entries = model.count()
    if entries == 0:
        content = F.coalesce(name(text).rlike(r"\S"), F.lit(False))
        return docs.select(
            *kept[:-1],
            F.lit(0).cast("long").alias("n_scored"),
            F.lit(None).cast("double").alias("perplexity"),
            F.lit(None).cast("double").alias("adjusted"),
            F.lit(None).cast("double").alias("threshold"),
            content.alias("kept"),
        )
    if entries <= sent_entries:
        scored = _scored_by_task(docs, text, model, order, kept)
    else:
        scored = _scored_by_joins(docs, text, model, order, kept, shelf)
    scored = shelf.last(scored)
    bits = F.when(F.col("_llm_chars") > 0, -F.col("_llm_log") / F.col("_llm_chars"))
    scored = scored.withColumn("_llm_bits", bits)

    def by_language(frame: DataFrame, column: str, *quantiles: float) -> DataFrame:
        found = frame.groupBy("_llm_language").agg(F.percentile_approx(column, list(quantiles), 100_000).alias("_llm_q"))
        found = found.withColumnRenamed("_llm_language", "_llm_lang")
        return frame.join(found, F.col("_llm_language").eqNullSafe(F.col("_llm_lang")), "left").drop("_llm_lang")

    middle = by_language(scored, "_llm_bits", 0.5)
    weight = F.col("_llm_chars") + F.lit(prior_chars)
    mixed = (F.col("_llm_bits") * F.col("_llm_chars") + F.element_at("_llm_q", 1) * prior_chars) / weight
    middle = middle.withColumn("_llm_adjusted", mixed).drop("_llm_q")
    fenced = by_language(middle, "_llm_adjusted", 0.25, 0.75)
    lower, upper = F.element_at("_llm_q", 1), F.element_at("_llm_q", 2)
    limit = upper + F.lit(fences) * (upper - lower)
    return fenced.select(
        *[name(c) for c in scored.columns if not c.startswith("_llm_")],
        F.col("_llm_chars").alias("n_scored"),
        F.exp("_llm_bits").alias("perplexity"),
        F.exp("_llm_adjusted").alias("adjusted"),
        F.exp(limit).alias("threshold"),
        F.coalesce(F.col("_llm_adjusted") <= limit, F.lit(False)).alias("kept"),
    )
