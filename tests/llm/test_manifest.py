import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from policy_mart.llm import manifest, queries

from .frames import empty, messy, messy_rows, rows_of

DATA = "/root/testdata/sf0.001"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    """All levels over `nodes`."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def path_of(levels, pos):
    """(is the sibling on the left, sibling) per level, the sibling empty where there is none."""
    out = []
    for level in levels[:-1]:
        other = pos ^ 1
        out.append((other < pos, level[other] if other < len(level) else ""))
        pos >>= 1
    return out


def by_hand(rows):
    """Of rows (doc_id, source, lang, n_chars, text): the result rows."""
    first = lambda v: (v is not None, v)
    leaves = [(r[2], r[0], h(*map(field, r)), r) for r in rows]
    groups = sorted({r[0] for r in leaves}, key=lambda g: (g is not None, (g or "").encode()))
    trees, members = {}, {}
    for g in groups:
        members[g] = sorted((x for x in leaves if x[0] == g), key=lambda x: (first(x[1]), x[2]) if x[1] is not None else ((False, 0), x[2]))
        trees[g] = climb([x[2] for x in members[g]])
    top = climb([trees[g][-1][0] for g in groups])
    out = []
    for k, g in enumerate(groups):
        for pos, (_, doc_id, leaf, row) in enumerate(members[g]):
            way = path_of(trees[g], pos) + path_of(top, k)
            folded = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and row[3] is not None:
                folded = h(*map(field, (*row[:3], row[3] + 1, row[4])))
            for left, sibling in way:
                folded = h(sibling, folded) if left else h(folded, sibling)
            root = top[-1][0]
            out.append((doc_id, leaf, trees[g][-1][0], root, h(*(s for _, s in way)), folded, folded == root))
    return out


def applied(spark, rows, layout=manifest.Layout()):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, g int, tree string, hash string, pos int")
    other = manifest.leaf_hash([*fields[:3], F.col("n_chars") + 1, "text"])
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest.merkle_manifest(docs.repartition(3), manifest.leaf_hash(fields), F.when(changed, other), layout=layout)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def same(got, expected):
    return rows_of(got, *COLUMNS) == sorted(expected, key=repr)


def case(n, langs, step=1):
    return [(step * i, f"s{i % 3}", langs[i % len(langs)], i, f"text {i}") for i in range(n)]


def extra(rows):
    return [(*r, 1, "t", "h", 2) for r in rows]


def test_query_against_definition(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert same(queries.QUERIES["op12_merkle"](spark, DATA), by_hand(rows))


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_node_rows_of_few_levels_and_many_groups(spark, levels):
    """Several steps in the groups' trees and in the tree over them, and rows stored more than once."""
    langs = ["en"] * 11 + ["de", "fr", None, "x", "é", "y", "z"]
    rows = case(90, langs, 5)
    layout = manifest.Layout(levels=levels, shared=4, task_rows=20)
    assert same(applied(spark, extra(rows), layout), by_hand(rows))


def test_trees_of_every_small_size(spark):
    rows = [(100 * n + i, "s", f"g{n:02}", 1, None) for n in range(1, 20) for i in range(n)]
    assert same(applied(spark, extra(rows)), by_hand(rows))


def test_one_leaf_is_the_root(spark):
    rows = [(7, None, None, None, "")]
    got = applied(spark, extra(rows))
    assert same(got, by_hand(rows))
    row = got.first()
    assert row["leaf"] == row["root"] == row["folded_root"] and row["proof_sha256"] == h("") and row["verified"]


def test_only_tampered_rows_fail(spark):
    rows = case(600, ["en", "de"])
    got = applied(spark, extra(rows)).collect()
    assert {r["doc_id"] for r in got if not r["verified"]} == {i for i in range(600) if zlib.crc32(str(i).encode()) % 7 == 0}


def test_messy_rows(spark):
    """Nulls, long texts, repeated rows and keys, clashing columns."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    got = manifest.merkle_manifest(messy(spark), manifest.leaf_hash(fields), F.lit(None).cast("string"))
    expected = by_hand([(r[0], r[3], r[2], r[4], r[1]) for r in messy_rows()])
    assert rows_of(got, *COLUMNS[:5]) == sorted((e[:5] for e in expected), key=repr)
    assert all(r["verified"] for r in got.collect())


def test_repeated_rows_take_different_places(spark):
    rows = [(5, "s", "en", 1, "same")] * 40 + case(20, ["en"], 9)
    got = applied(spark, extra(rows))
    assert same(got, by_hand(rows))
    # Whole subtrees of equal leaves have equal hashes, so only places beside other leaves differ.
    assert got.filter("doc_id = 5").select("proof_sha256").distinct().count() > 1


def test_no_rows(spark):
    got = manifest.merkle_manifest(empty(spark), manifest.leaf_hash(["doc_id", "text"]), F.lit(None).cast("string"))
    assert got.columns == COLUMNS and got.collect() == []


def test_the_session_keeps_its_recursion_limit(spark):
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    applied(spark, extra(case(5, ["a"])))
    assert spark.conf.get(limit, None) == before
