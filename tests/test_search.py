"""Smart search: against brute force, whatever the cells, and on edge cases."""

import numpy as np
import pytest

from postmill.operators.search import build_index, embed_texts, open_index, semantic_search, unit_vectors

KINDS = "id bigint, vector array<double>, cell string, tile string, query string, own int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", "y", "z", 1) for i, v in rows], KINDS)


def plain(rows, queries, k, exclude=False):
    def usable(v):
        return v is not None and len(v) == 4 and None not in v and np.isfinite(v).all() and any(v)

    def unit(v):
        v = np.array(v) / np.abs(v).max()
        return v / np.linalg.norm(v)

    known = [(i, unit(v)) for i, v in rows if i is not None and usable(v)]
    result = []
    for q, v in queries:
        if q is None or not usable(v):
            continue
        v = unit(v)
        near = sorted((-round(float(u @ v), 9), i) for i, u in known if not (exclude and i == q))
        result += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(near[:k])]
    return sorted(result)


def found(result):
    return sorted((r.query_id, r.rank, r.id, r.similarity) for r in result.collect())


def same(got, want):
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want], atol=2e-9)


def vectors(n):
    rng = np.random.default_rng(n)
    centers = rng.normal(size=(7, 4))
    rows = [(i, (centers[i % 7] + 0.3 * rng.normal(size=4)).tolist()) for i in range(n)]
    # A third is one and the same vector.
    rows += [(n + i, [1.0, 2.0, 3.0, 4.0]) for i in range(n // 2)]
    odd = [None, [], [0, 0, 0, 0], [1, None, 2, 3], [float("nan")] * 4, [float("inf"), 0, 0, 1], [1.0, 2.0]]
    rows += [(2 * n + i, v) for i, v in enumerate(odd)] + [(None, [1.0, 0, 0, 0]), (3, [0, 0, 0, 1e-300]), (5, [1e300, 1, 1, 1])]
    return rows


@pytest.mark.parametrize("cells,tile,query_tile", [(None, 50, 3), (1, 1000, 1000), (40, 7, 1)])
def test_search_is_exact(spark, cells, tile, query_tile, tmp_path):
    rows = vectors(200)
    index = build_index(frame(spark, rows), f"{tmp_path}/index", cells=cells, tile=tile)
    queries = [r for i, r in enumerate(rows) if i % 9 == 0 or i > 290]
    result = semantic_search(index, frame(spark, queries), 6, query_tile=query_tile, exclude_same_id=True)
    same(found(result), plain(rows, queries, 6, exclude=True))
    again = semantic_search(open_index(spark, f"{tmp_path}/index"), frame(spark, queries[:4]), 400)
    same(found(again), plain(rows, queries[:4], 400))


def test_bound_on_probes(spark):
    rows = vectors(300)
    index = build_index(frame(spark, rows), cells=12)
    queries = frame(spark, rows[::10])
    want = {(q, i) for q, _, i, _ in plain(rows, rows[::10], 5)}
    got = {(q, i) for q, _, i, _ in found(semantic_search(index, queries, 5, max_probes=3))}
    assert len(got & want) >= 0.8 * len(want)


def test_empty_sides(spark):
    rows = frame(spark, vectors(20))
    nothing = build_index(rows.limit(0))
    assert semantic_search(nothing, rows, 3).count() == 0
    index = build_index(rows)
    assert semantic_search(index, rows.limit(0), 3).count() == 0
    assert semantic_search(index, rows.where("size(vector) = 2"), 3).count() == 0


def test_no_pair_of_all(spark):
    rows = frame(spark, vectors(50))
    plan = semantic_search(build_index(rows), rows, 3)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_unit_vectors(spark):
    found = {r.id: r.vector for r in unit_vectors(frame(spark, vectors(10)), "id", "vector").collect()}
    assert np.allclose([np.linalg.norm(v) for v in found.values()], 1)
    assert set(found) == {*range(15), 26}


def test_texts_are_embedded(spark):
    class Encoder:
        def __call__(self, texts):
            return [[float(len(t)), float(t.count("a"))] for t in texts]

    table = spark.createDataFrame([(1, "aab"), (2, None), (3, "")], "id int, text string")
    rows = {r.id: r.vector for r in embed_texts(table, Encoder).collect()}
    assert rows == {1: [3.0, 2.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}
