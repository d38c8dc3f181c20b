"""Language identification: FTRL logistic regression on TF-IDF character n-grams, calibrated."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import chunks, is_letter, joined, mix64
from ._work import name, others

#: What a text without letters is.
UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """`sample` bounds the rows that the weights are fitted on, over all languages together; the
    document frequencies behind them count every training row."""

    orders: tuple[int, ...] = (1, 2, 3)
    dimensions: int = 1 << 15
    sample: int = 2400
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-3
    held_for_calibration: int = 5


@dataclass(frozen=True)
class Model:
    """Weights are dimensions x languages; their size is bounded by the settings and the sample."""

    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    settings: Settings


def term_counts(texts: Sequence[str | None], settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of the hashed character n-grams of texts, ordered by text; and whether each text has a letter.

    N-grams run over lower-cased letters, any run of other characters being one blank; they do not
    cross texts.
    """
    codes, starts = joined(texts)
    letter = is_letter(codes)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    first_of_text = np.zeros(len(codes), bool)
    first_of_text[starts[:-1]] = True
    # Of other characters only the first after a letter, or of a text, stays, as a blank.
    keep = letter | np.concatenate([[True], letter[:-1]]) | first_of_text
    c = np.where(letter, codes, 32)[keep].astype(np.uint64)
    owner = owner[keep]
    mask = np.uint64(settings.dimensions - 1)
    keys = []
    for n in settings.orders:
        m = len(c) - n + 1
        if m <= 0:
            continue
        h = np.full(m, np.uint64(n))
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + c[k : k + m]
        same = owner[:m] == owner[n - 1 :]
        term = (mix64(h) & mask).astype(np.int64)[same]
        keys.append(owner[:m][same] * settings.dimensions + term)
    has = np.bincount(owner[c != 32], minlength=len(texts)) > 0
    if not keys:
        none = np.zeros(0, np.int64)
        return none, none, none, has
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return key // settings.dimensions, key % settings.dimensions, count, has


def _unit_vectors(text: np.ndarray, term: np.ndarray, count: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """The TF-IDF values, with dampened counts, of vectors of length 1."""
    value = (1.0 + np.log(count)) * idf[term]
    norm = np.sqrt(np.bincount(text, value * value, minlength=n))
    return value / np.maximum(norm, 1e-12)[text]


def document_frequencies(texts: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """How many of the texts have each term, and the number of texts: partial counts per task, summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(settings.dimensions, np.int64), 0
        for batch in batches:
            column = batch.column(0).to_pylist()
            for first, until in chunks(column):
                _, term, _, _ = term_counts(column[first:until], settings)
                seen += np.bincount(term, minlength=settings.dimensions)
                rows += until - first
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array([*at.tolist(), -1], pa.int64()), "n": pa.array([*seen[at].tolist(), rows], pa.int64())}
        )

    got = texts.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    frequency = np.zeros(settings.dimensions, np.int64)
    real = got[got.term >= 0]
    frequency[real.term.to_numpy()] = real.n.to_numpy()
    return frequency, int(got[got.term < 0].n.sum())


def train(labelled: DataFrame, text: str, lang: str, key: str, settings: Settings = Settings()) -> Model | None:
    """The model of rows with text and language; None if there are none.

    Every row counts towards the document frequencies. The weights are fitted on a sample of at most
    about `settings.sample` rows, an equal share for each language, drawn by the digest of key and text.
    """
    rows = labelled.filter(name(text).isNotNull() & name(lang).isNotNull())
    by_language = rows.groupBy(name(lang).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(settings.sample).collect()
    if not by_language:
        return None
    frequency, total = document_frequencies(rows.select(name(text)), settings)
    idf = np.log((1.0 + total) / (1.0 + frequency)) + 1.0
    share = max(1, settings.sample // len(by_language))
    rate = F.lit(0.0)
    for r in by_language:
        rate = F.when(name(lang) == r["lang"], F.lit(min(1.0, share / r["count"]))).otherwise(rate)
    draw = F.pmod(F.xxhash64(name(key).cast("string"), name(text)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    fold = F.pmod(F.xxhash64(F.lit("calibration"), name(key).cast("string"), name(text)), F.lit(settings.held_for_calibration))
    chosen = rows.filter(draw < rate).select(name(text).alias("text"), name(lang).alias("lang"), fold.alias("fold"), draw.alias("draw"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for first, until in chunks(texts):
                n = until - first
                owner, term, count, _ = term_counts(texts[first:until], settings)
                value = _unit_vectors(owner, term, count, idf, n).astype(np.float32)
                cut = np.searchsorted(owner, np.arange(n + 1))
                pairs = list(zip(cut[:-1], cut[1:], strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([term[a:b].astype(np.int32).tobytes() for a, b in pairs], pa.binary()),
                        pa.array([value[a:b].tobytes() for a, b in pairs], pa.binary()),
                        *[batch.column(i).slice(first, n) for i in (1, 2, 3)],
                    ],
                    names=["terms", "values", "lang", "fold", "draw"],
                )

    sample = chosen.mapInArrow(vectors, "terms binary, values binary, lang string, fold long, draw double")
    data = sample.orderBy("draw", "lang").limit(settings.sample + settings.sample // 2).collect()
    languages = tuple(sorted({r["lang"] for r in data}))
    if not languages:
        return None
    examples = [
        (np.frombuffer(r["terms"], np.int32), np.frombuffer(r["values"], np.float32), languages.index(r["lang"])) for r in data
    ]
    held = [e for e, r in zip(examples, data, strict=True) if r["fold"] == 0]
    fitted = [e for e, r in zip(examples, data, strict=True) if r["fold"] != 0] or examples
    weights, bias = follow_the_regularised_leader(fitted, len(languages), settings)
    temperature = calibrate(held or fitted, weights, bias)
    return Model(languages, idf.astype(np.float32), weights.astype(np.float32), bias, temperature, settings)


def follow_the_regularised_leader(examples: list, n: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Sparse multinomial weights. Per coordinate, z sums the gradients less the shift of the leader
    and g the squared gradients; a weight is 0 until |z| passes l1, and l2 shrinks the rest."""
    z, g = np.zeros((s.dimensions + 1, n)), np.zeros((s.dimensions + 1, n))
    order = np.random.default_rng(0)

    def solve(zi, gi):
        rate = (s.beta + np.sqrt(gi)) / s.alpha + s.l2
        return np.where(np.abs(zi) <= s.l1, 0.0, -(zi - np.sign(zi) * s.l1) / rate)

    for _ in range(s.epochs):
        for i in order.permutation(len(examples)):
            term, value, label = examples[i]
            at = np.append(term, s.dimensions)  # the last row is the bias
            x = np.append(value, 1.0).astype(np.float64)
            zi, gi = z[at], g[at]
            w = solve(zi, gi)
            error = _softmax(x @ w)
            error[label] -= 1.0
            gradient = x[:, None] * error[None, :]
            grown = gi + gradient * gradient
            z[at] = zi + gradient - (np.sqrt(grown) - np.sqrt(gi)) / s.alpha * w
            g[at] = grown
    w = solve(z, g)
    return w[:-1], w[-1]


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def calibrate(examples: list, weights: np.ndarray, bias: np.ndarray) -> float:
    """The temperature with the least log loss on held-out examples: a search on a log scale.

    Labels are smoothed by one example in n + 2, as n right answers prove no more than that; without
    it, a model that makes no mistake there would be given certainty.
    """
    scores = np.array([value @ weights[term] + bias for term, value, _ in examples])
    labels = np.array([label for _, _, label in examples])
    n, classes = scores.shape
    if classes < 2:
        return 1.0
    smooth = np.full(scores.shape, 1.0 / (n + 2) / (classes - 1))
    smooth[np.arange(n), labels] = 1.0 - 1.0 / (n + 2)

    def loss(temperature: float) -> float:
        shifted = scores / temperature
        shifted -= shifted.max(axis=1, keepdims=True)
        return float((smooth * (np.log(np.exp(shifted).sum(axis=1, keepdims=True)) - shifted)).sum(axis=1).mean())

    low, high = np.log(0.05), np.log(20.0)
    golden = (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(np.exp(a)) <= loss(np.exp(b)) else (a, high)
    return float(np.exp((low + high) / 2))


def scores_of(model: Model, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
    """The language of each text and its calibrated probability."""
    owner, term, count, has = term_counts(texts, model.settings)
    value = _unit_vectors(owner, term, count, model.idf, len(texts)).astype(np.float32)
    total = np.zeros((len(texts), len(model.languages)))
    for k in range(len(model.languages)):
        total[:, k] = np.bincount(owner, value * model.weights[term, k], minlength=len(texts)) + model.bias[k]
    p = _softmax(total / model.temperature)
    best = p.argmax(axis=1)
    found = [model.languages[b] if h else UNDETERMINED for b, h in zip(best, has, strict=True)]
    return found, np.where(has, p[np.arange(len(texts)), best], 0.0)


def predict(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`, from whole texts only.

    Null texts and texts without a letter are `und` with score 0, and so is every text if there is
    no model. Ties go to the language first by code point. Long texts are taken whole, a task
    holding one of them at a time. Output columns replace input columns of the same name.
    """
    rest = others(docs, "lang_pred", "score")
    if model is None:
        return docs.select(*rest, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def identify(texts: pd.Series) -> pd.DataFrame:
        column = [t if isinstance(t, str) else None for t in texts]
        languages, scores = [], []
        for first, until in chunks(column):
            found, p = scores_of(shared.value, column[first:until])
            languages += found
            scores += p.tolist()
        return pd.DataFrame({"lang_pred": languages, "score": np.asarray(scores, np.float64)})

    found = docs.select(*rest, identify(name(text)).alias("_llm_found"))
    kept = [name(c) for c in found.columns if c != "_llm_found"]
    return found.select(*kept, F.col("_llm_found.lang_pred").alias("lang_pred"), F.col("_llm_found.score").alias("score"))


def training_fold(key: str = "doc_id"):
    """The rows that may be learned from; the others are held out."""
    return F.pmod(F.crc32(F.coalesce(name(key).cast("string"), F.lit("")).cast("binary")), F.lit(3)) != 1


def identify_languages(
    docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", settings: Settings = Settings()
) -> DataFrame:
    """`docs` with `held_out`, `lang_pred` and `score`: learned from the training fold's rows with
    text and language, predicted for all rows. A null key belongs to the fold of an empty key."""
    model = train(docs.filter(training_fold(key)), text, lang, key, settings)
    rest = others(docs, "held_out", "lang_pred", "score")
    return predict(docs.select(*rest, (~training_fold(key)).alias("held_out")), model, text)
