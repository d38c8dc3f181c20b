import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from policy_mart.llm import quality
from policy_mart.llm._work import Shelf

from .frames import empty, messy, words

DATA = "/root/testdata/sf0.01"


def padded(text, order):
    return quality.START * (order - 1) + "".join("0" if c in "0123456789" else c for c in " ".join((text or "").split()))


class ByHand:
    """Interpolated modified Kneser-Ney, by its definition."""

    def __init__(self, texts, order):
        self.order = order
        self.counts = {order: Counter()}
        for t in texts:
            p = padded(t, order)
            self.counts[order].update(p[i : i + order] for i in range(len(p) - order + 1))
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.off, self.context = {}, {}
        for n, c in self.counts.items():
            of = Counter(c.values())
            d = [0.5, 1.0, 1.5]
            if of[1] and of[2]:
                y = of[1] / (of[1] + 2 * of[2])
                d = [1 - 2 * y * of[2] / of[1], 2 - 3 * y * of[3] / of[2], 3 - 4 * y * of[4] / of[3] if of[3] else 1.5]
                d = [min(max(x, 0.05), k + 0.95) for k, x in enumerate(d)]
            self.off[n] = d
            totals = defaultdict(lambda: [0, 0.0])
            for g, k in c.items():
                totals[g[:-1]][0] += k
                totals[g[:-1]][1] += d[min(k, 3) - 1]
            self.context[n] = dict(totals)

    def p(self, gram):
        n = len(gram)
        if n == 0:
            return 1 / (len(self.counts[1]) + 1)
        lower = self.p(gram[1:])
        if gram[:-1] not in self.context[n]:
            return lower
        total, freed = self.context[n][gram[:-1]]
        k = self.counts[n].get(gram, 0)
        return (max(k - self.off[n][min(k, 3) - 1], 0) if k else 0) / total + freed / total * lower

    def perplexity(self, text):
        p = padded(text, self.order)
        logs = [math.log(self.p(p[i : i + self.order])) for i in range(len(p) - self.order + 1)]
        return math.exp(-sum(logs) / len(logs)) if logs else None


@pytest.mark.parametrize("sent", [10**9, 0])
def test_perplexity_by_definition(spark, sent):
    texts = [words(i, 25) for i in range(30)] + ["Other  text, 12\n34!", "😀", "zzz"]
    trusted = spark.createDataFrame([(t,) for t in texts[:20]], "text string")
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = ByHand(texts[:20], 4)
    got = quality.score_quality(docs, trusted, order=4, sent_entries=sent).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r["perplexity"] == pytest.approx(model.perplexity(r["text"]), rel=1e-9)


def test_learns_five_characters_by_default(spark):
    texts = [words(i, 25) for i in range(30)]
    trusted = spark.createDataFrame([(t,) for t in texts[:20]], "text string")
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    model = ByHand(texts[:20], 5)
    for r in quality.score_quality(docs, trusted).collect():
        assert r["perplexity"] == pytest.approx(model.perplexity(r["text"]), rel=1e-9)


def test_probabilities_sum_to_one():
    model = ByHand([words(i, 20) for i in range(10)], 3)
    letters = [*model.counts[1], "unseen"]
    for context in ["", "a", "aw", "zz"]:
        total = sum(model.p((context + c)[-3:]) for c in letters[:-1])
        back = model.p("☃") if not context else None
        assert 0.9 < total < 1.0 and (back is None or total + back == pytest.approx(1.0))


def test_documents_good_stay_and_bad_go(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    good = labels.filter("quality = 1 and toxic = 0").select("doc_id")
    got = quality.score_quality(docs, docs.join(good, "doc_id", "left_semi"), columns=["doc_id", "lang"])
    got = got.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r["quality"]: r["kept"] for r in got.collect()}
    assert kept[1] > 0.99 and kept[0] < 0.2


def test_messy_rows(spark):
    docs = messy(spark)
    got = quality.score_quality(docs, docs.filter("doc_id < 5")).collect()
    assert len(got) == docs.count()
    for r in got:
        blank = not (r["text"] or "").strip()
        assert (r["perplexity"] is None) == blank and (not r["kept"] if blank else r["n_scored"] > 0)
    joined = quality.score_quality(docs, docs.filter("doc_id < 5"), sent_entries=0)
    pairs = lambda rows: sorted((str(r["doc_id"]), str(r["perplexity"])[:12], r["kept"], r["a.b"] or 0) for r in rows)
    assert pairs(joined.collect()) == pairs(got)
    assert quality.score_quality(empty(spark), docs).isEmpty()
    nothing = quality.score_quality(docs, empty(spark)).collect()
    assert all(r["perplexity"] is None and r["kept"] == bool((r["text"] or "").strip()) for r in nothing)


def test_counts_cover_all_rows(spark):
    texts = [words(i, 300) for i in range(40)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(7)
    got = {r["gram"]: r["n"] for r in quality.count_ngrams(frame, 3).collect()}
    assert got == dict(ByHand(texts, 3).counts[3])
    assert quality.train(frame, Shelf(spark, "t"), 3).filter("size = 3").count() == len(got)
