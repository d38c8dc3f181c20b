import importlib
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from policy_mart.llm._work import Shelf

from .frames import empty, messy
from .test_lines import by_hand as lines_by_hand
from .test_mixture import mix_by_hand
from .test_near_duplicates import classes_by_hand

DATA = "/root/testdata/sf0.01"
REPO = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's result, each on the one before."""
    shelf = Shelf(spark, "stages")
    docs = [spark.read.parquet(f"{DATA}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(shelf.put(stage(spark, docs[-1], DATA)))
    return docs


def test_language_stage_keeps_clean_documents(stages):
    before, after = stages[0], stages[1]
    assert after.columns == before.columns
    lost = before.join(after, "doc_id", "left_anti").collect()
    assert all(not any(c.isalpha() for c in r["text"] or "") for r in lost) or len(lost) <= 0.002 * before.count()


def test_line_stage_by_hand(stages):
    before = {r["doc_id"]: r for r in stages[1].collect()}
    gone = lines_by_hand([r["text"] for r in before.values()])
    for r in stages[2].collect():
        own = before[r["doc_id"]]["text"].split("\n")
        drop = set(gone[before[r["doc_id"]]["text"]])
        assert r["text"] == "\n".join(x for i, x in enumerate(own) if i not in drop)


def test_near_duplicate_stage_by_hand(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    assert {r["doc_id"] for r in stages[3].collect()} == {c for _, c in classes_by_hand(rows)}


def test_mixture_stage_by_hand(stages):
    expected, _ = mix_by_hand([(r["doc_id"], r["text"], r["source"]) for r in stages[3].collect()])
    got = Counter(r["doc_id"] for r in stages[4].collect())
    assert got == Counter({doc: n for doc, _, n in expected if n})


def test_packing_stage_loses_nothing(stages):
    columns = stages[4].columns
    assert stages[5].columns[: len(columns)] == columns
    assert stages[5].select(columns).exceptAll(stages[4]).isEmpty() and stages[4].exceptAll(stages[5].select(columns)).isEmpty()


def test_run_is_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, DATA)
    key = ["doc_id", "length", "bucket", "boundary", "padding"]
    assert got.columns == stages[5].columns
    assert got.select(key).exceptAll(stages[5].select(key)).isEmpty() and got.count() == stages[5].count()


def test_messy_and_empty_documents(spark):
    columns = ["doc_id", "text", "lang", "source", "n_chars", "`a.b`", "node"]
    for docs in (messy(spark).select(columns), empty(spark).select(columns)):
        for _, stage in corpus_pipeline.STAGES:
            docs = Shelf(spark, "messy").put(stage(spark, docs, DATA))
    assert docs.isEmpty()


def test_entry_lists_the_operators():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_entry_without_the_subpackage(monkeypatch):
    class Gone:
        def find_spec(self, name, path=None, target=None):
            if name.startswith("policy_mart.llm") or name == "corpus_pipeline":
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    for name in [n for n in sys.modules if n.startswith("policy_mart.llm") or n in ("corpus_pipeline", "__spark_entry__")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [Gone(), *sys.meta_path])
    entry = importlib.import_module("__spark_entry__")
    assert len(entry.queries()) > 50 and not any(n.startswith("op") and n[2].isdigit() for n in entry.queries())
    monkeypatch.delitem(sys.modules, "__spark_entry__")


def test_nothing_else_imports_the_subpackage():
    for path in (REPO / "policy_mart").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text()


def test_row_numbers_of_hot_groups(spark):
    from policy_mart.llm._ranks import ranked

    rows = spark.range(2000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 5).alias("g"), (F.col("id") * 7919 % 100).alias("p"), "id"
    ).withColumn("q", F.floor(F.col("p") / 10))
    got = ranked(rows, ["g", "q", "p"], ["id"], "rank").collect()
    for g in {r["g"] for r in got}:
        own = sorted((r for r in got if r["g"] == g), key=lambda r: (r["p"], r["id"]))
        assert [r["rank"] for r in own] == list(range(len(own)))
