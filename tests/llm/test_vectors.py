import numpy as np
import pytest

from policy_mart.llm import ann, neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec int, `root` int, n_links string, rank int"
EXTRA = (0, "i", 1, 2, "n", 3)
DATA = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame([(i, v if v is None else [None if x is None else float(x) for x in v], *EXTRA) for i, v in rows], SCHEMA)


def cosines(x):
    x = np.asarray(x, np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = x @ x.T
    np.fill_diagonal(s, -2)
    return s


def links_by_hand(ids, x, threshold=0.95):
    near = cosines(x) >= threshold
    out, seen = {}, set()
    for i in np.argsort(ids):
        if i in seen:
            continue
        todo, members = [i], {i}
        while todo:
            for j in np.flatnonzero(near[todo.pop()]):
                if j not in members:
                    members.add(j)
                    todo.append(j)
        seen |= members
        for j in members:
            out[int(ids[j])] = (int(near[j].sum()), int(ids[list(members)].min()))
    return out


def clustered(seed=0):
    """Alone, in pairs, in a tight large group, in a wide group (not all linked), and in a chain."""
    r = np.random.default_rng(seed)
    d = 32
    parts = [r.standard_normal((500, d))]
    parts.append(np.repeat(r.standard_normal((40, d)), 2, axis=0) + 0.05 * r.standard_normal((80, d)))
    parts.append(r.standard_normal(d) + 0.02 * r.standard_normal((400, d)))
    parts.append(r.standard_normal(d) + 0.22 * r.standard_normal((300, d)))
    a, b = r.standard_normal((2, d))
    parts.append(np.array([np.cos(t) * a + np.sin(t) * b for t in np.linspace(0, 1.5, 12)]))
    x = np.concatenate(parts).astype(np.float32)
    return r.permutation(len(x) * 3)[: len(x)], x


def test_links_against_all_pairs(spark):
    ids, x = clustered()
    got = neighbours.near_vectors(frame(spark, zip(ids.tolist(), x.tolist(), strict=True))).collect()
    expected = links_by_hand(ids, x)
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == expected
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_large_groups_that_touch_in_one_pair(spark):
    r = np.random.default_rng(7)
    d = 32
    a, b = np.linalg.qr(r.standard_normal((d, 2)))[0].T
    at = lambda t: np.cos(t) * a + np.sin(t) * b
    groups = [at(t) + 0.015 * r.standard_normal((1000, d)) for t in (0.0, 0.6)]
    x = np.concatenate([*groups, [at(0.145), at(0.455)], r.standard_normal((2000, d))]).astype(np.float32)
    ids = r.permutation(len(x))
    expected = links_by_hand(ids, x)
    assert len({expected[int(i)][1] for i in ids[:2002]}) == 1
    got = neighbours.near_vectors(frame(spark, zip(ids.tolist(), x.tolist(), strict=True))).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == expected


def test_embeddings_table(spark):
    e = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = e.collect()
    expected = links_by_hand(np.array([r["vec_id"] for r in rows]), [r["embedding"] for r in rows])
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in neighbours.near_vectors(e).collect()} == expected


MESSY = [
    (0, [1, 0, 0]),
    (50, [1, 0.01, 0]),
    (100, [0, 1, 0]),
    (3, None),
    (4, [0, 0, 0]),
    (5, [1, None, 0]),
    (6, [float("nan"), 1, 0]),
    (7, [float("inf"), 1, 0]),
    (8, []),
    (9, [1, 0]),
    (None, [1, 0, 0]),
    (None, None),
    (150, [1, 0, 0]),
    (150, [1, 0, 0]),
    (200, [1e-30, 0, 0]),
    (250, [3e38, 0, 0]),
]


def test_messy_vectors(spark):
    got = {r["vec_id"]: r for r in neighbours.near_vectors(frame(spark, MESSY)).collect() if r["vec_id"] is not None}
    assert all(got[i]["n_links"] == 4 and got[i]["component_id"] == 0 for i in (0, 50, 150, 200, 250))
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in (100, 3, 4, 5, 6, 7, 8, 9))
    assert neighbours.near_vectors(frame(spark, MESSY)).count() == len(MESSY)
    assert neighbours.near_vectors(frame(spark, [])).isEmpty()
    found = ann.nearest(frame(spark, MESSY)).collect()
    assert {r["query_id"] for r in found} == {0, 50, 100, 150, 200, 250}
    by = {q: [(r["rank"], r["vec_id"]) for r in found if r["query_id"] == q] for q in (0, 100)}
    assert sorted(by[0])[:3] == [(1, 150), (2, 200), (3, 250)] and len(by[100]) == 5
    assert ann.nearest(frame(spark, [])).isEmpty()
    assert ann.nearest(frame(spark, [(50, [1, 2])])).isEmpty()


def test_search_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 400)
    ids, x = clustered(4)
    s = cosines(x)
    found = ann.nearest(frame(spark, zip(ids.tolist(), x.tolist(), strict=True)), every=10).collect()
    at = {int(i): k for k, i in enumerate(ids)}
    hits, asked = 0, [i for i in at if i % 10 == 0]
    for i in asked:
        mine = [r for r in found if r["query_id"] == i]
        order = np.lexsort((ids, -s[at[i]]))[:5]
        hits += len({int(ids[j]) for j in order} & {r["vec_id"] for r in mine})
        assert sorted(r["rank"] for r in mine) == [1, 2, 3, 4, 5]
        for r in mine:
            assert r["score"] == pytest.approx(s[at[i], at[r["vec_id"]]], abs=1e-12)
    assert hits / (5 * len(asked)) >= 0.9


def test_flat_arrays_hold_the_graph():
    x = neighbours.unit_rows(ann.pa.array([row.tobytes() for row in np.random.default_rng(1).standard_normal((300, 8))]), "<f8")
    g = ann.Graph.build(x, 6, 32, 0)
    h = ann.Graph.load(x, g.entry, *g.flat())
    assert h.levels == g.levels and h.search(x[5], 3, 40) == g.search(x[5], 3, 40) and h.search(x[5], 1, 40) == [5]


def test_audit_sees_lost_links(spark):
    ids, x = clustered(1)
    vectors, kind = neighbours.comparable(frame(spark, zip(ids.tolist(), x.tolist(), strict=True)), "vec_id", "embedding")
    true = links_by_hand(ids, x)
    rows = [(i, n if i % 2 else 0) for i, (n, _) in true.items()]
    halved = spark.createDataFrame(rows, "id long, n_links long")
    assert 0.3 < neighbours.audit_recall(vectors, kind, halved, 0.95, 10_000) < 0.7


def test_audit_counts_small_groups(spark):
    r = np.random.default_rng(3)
    group = r.standard_normal(32) + 0.02 * r.standard_normal((300, 32))
    pairs = np.repeat(r.standard_normal((60, 32)), 2, axis=0) + 0.02 * r.standard_normal((120, 32))
    x = np.concatenate([group, pairs])
    vectors, kind = neighbours.comparable(frame(spark, enumerate(x.tolist())), "vec_id", "embedding")
    lost = spark.createDataFrame([(i, 299) for i in range(300)], "id long, n_links long")
    assert neighbours.audit_recall(vectors, kind, lost, 0.95, 64) == pytest.approx(300 / 420)


def test_ties_beyond_the_width(spark):
    r = np.random.default_rng(5)
    same = r.standard_normal(8)
    x = [same if i % 2 else r.standard_normal(8) for i in range(400)]
    found = ann.nearest(frame(spark, [(i, v.tolist()) for i, v in enumerate(x)]), every=25).collect()
    for q in range(25, 400, 50):
        mine = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == q)
        assert mine == [(1, 1), (2, 3), (3, 5), (4, 7), (5, 9)]


def rows_by_hand(rows, threshold=0.95):
    """(key, n_links, component) of every row: each different (key, vector) is a vector, dimensions apart."""
    nodes = list(dict.fromkeys((i, tuple(v)) for i, v in rows))
    unit = [np.array(v) / np.linalg.norm(v) for _, v in nodes]
    near = [[a != b and len(x) == len(y) and x @ y >= threshold for b, y in enumerate(unit)] for a, x in enumerate(unit)]
    root = list(range(len(nodes)))
    for _ in nodes:
        root = [min([root[a], *(root[b] for b in range(len(nodes)) if near[a][b])]) for a in range(len(nodes))]
    least = {r: min(nodes[a][0] for a in range(len(nodes)) if root[a] == r) for r in root}
    found = {n: (sum(near[a]), least[root[a]]) for a, n in enumerate(nodes)}
    return sorted((i, *found[i, tuple(v)]) for i, v in rows)


MIXED = [
    *[(i, [1.0, 0.001 * i, 0.0]) for i in range(6)],
    *[(10 + i, [1.0, 0.002 * i]) for i in range(3)],  # parallel, of another dimension
    (20, [0.0, 1.0]),
    (1, [0.0, 0.0, 1.0]),  # another vector of key 1
    (30, [0.0, 0.0, 2.0]),
    (40, [1.0, 0.0]),
    (40, [0.0, 0.0, 1.0]),
    (40, [0.0, 0.0, 1.0]),
    (50, [5.0]),
    (51, [7.0]),
]


def test_links_of_all_dimensions_and_of_every_vector_of_a_key(spark):
    got = neighbours.near_vectors(frame(spark, MIXED)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == rows_by_hand(MIXED)
    only = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0])]
    got = neighbours.near_vectors(frame(spark, only)).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == [(1, 0, 1), (1, 1, 1), (2, 1, 1)]


def test_an_unsound_vector_gets_no_link_from_its_keys_other_vector(spark):
    got = neighbours.near_vectors(frame(spark, [(1, [1.0, 0.0]), (1, None), (2, [1.0, 0.0])])).collect()
    assert sorted((r["vec_id"], r["n_links"]) for r in got) == [(1, 0), (1, 1), (2, 1)]


def test_search_in_all_dimensions_and_over_every_vector_of_a_key(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 3)
    found = ann.nearest(frame(spark, MIXED), every=10).collect()
    nodes = list(dict.fromkeys((i, tuple(v)) for i, v in MIXED))
    expected = []
    for i, v in nodes:
        if i % 10 == 0:
            others = [(-float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)), j) for j, w in nodes if j != i and len(w) == len(v)]
            expected += [(i, n, j, round(-s, 9)) for n, (s, j) in enumerate(sorted((round(s, 12), j) for s, j in others)[:5], 1)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in found) == sorted(expected)
