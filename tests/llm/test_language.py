from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from policy_mart.llm import language

from .frames import empty, messy

DATA = "/root/testdata/sf0.1"


def test_held_out_accuracy_and_calibration(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    rows = language.identify_languages(docs).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["held_out"] == (crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    right = np.mean([r["lang_pred"] == r["lang"] for r in held])
    assert right > 0.99 and np.mean([r["score"] for r in held]) == pytest.approx(right, abs=0.01)


def test_only_the_training_fold_teaches(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").limit(600)
    lied = docs.withColumn("lang", F.when(~language.training_fold(), "xx").otherwise(F.col("lang")))
    assert {r["lang_pred"] for r in language.identify_languages(lied).collect()} <= {"de", "en", "es", "fr"}


def test_term_counts_against_a_plain_count():
    settings = language.Settings()
    texts = ["Ab,  c1d", None, "", "ÀB ab", "x"]
    text, term, count, has = language.term_counts(texts, settings)
    assert has.tolist() == [True, False, False, True, True]
    grams = ["ab c d", "", "", "àb ab", "x"]
    for i, g in enumerate(grams):
        distinct = {}
        own = count[text == i]
        padded = g + " "  # what follows a text is one blank
        for n in settings.orders:
            for k in range(len(padded) - n + 1):
                distinct[padded[k : k + n]] = distinct.get(padded[k : k + n], 0) + 1
        assert sorted(own.tolist()) == sorted(distinct.values())


def test_elastic_net_and_order():
    rng = np.random.default_rng(1)
    s = language.Settings(dimensions=64, epochs=20)
    examples = []
    for i in range(200):
        label = i % 3
        terms = np.unique(np.append(rng.integers(10, 60, 5), label)).astype(np.int32)
        examples.append((terms, np.full(len(terms), 0.5, np.float32), label))
    dense, _ = language.follow_the_regularised_leader(examples, 3, s)
    sparse, _ = language.follow_the_regularised_leader(examples, 3, language.Settings(dimensions=64, epochs=20, l1=2.0))
    small, _ = language.follow_the_regularised_leader(examples, 3, language.Settings(dimensions=64, epochs=20, l2=10.0))
    assert [int(dense[i].argmax()) for i in range(3)] == [0, 1, 2]
    assert (sparse == 0).sum() > (dense == 0).sum() and np.abs(small).sum() < np.abs(dense).sum()


def test_temperature_answers_doubt():
    weights, bias = np.eye(4)[:, :2] * 8, np.zeros(2)
    sure = [(np.array([i % 2], np.int32), np.ones(1), i % 2) for i in range(40)]
    wrong = sure[:20] + [(t, v, 1 - y) for t, v, y in sure[20:30]]
    assert language.calibrate(wrong, weights, bias) > language.calibrate(sure, weights, bias)


def test_messy_rows(spark):
    docs = messy(spark)
    got = language.identify_languages(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        blank = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == blank and (r["score"] == 0 if blank else 0 < r["score"] <= 1)
    assert language.identify_languages(empty(spark)).isEmpty()
    unlabelled = language.identify_languages(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}
