"""Smart search: what meets a query is counted by shelf, not by cell."""

import numpy as np

from postmill.operators import search
from test_search import found, frame, plain, same


def test_a_query_goes_once_to_a_shelf(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(400)] + [(400 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)]
    index = search.build_index(frame(spark, rows), cells=30)
    queries, written, write = rows[::10], {}, search._written

    def counted(table, name):
        made = write(table, name)
        written[name] = max(written.get(name, 0), made.count())
        return made

    monkeypatch.setattr(search, "_written", counted)
    result = search.semantic_search(index, frame(spark, queries), 6, exclude_same_id=True)
    same(found(result), plain(rows, queries, 6, exclude=True))
    assert 0 < written["probes"] <= len(queries)


def test_unit_vectors_are_made_in_one_pass(spark):
    rows = frame(spark, [(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [1e300, 1e300, 0.0]), (4, []), (5, [None, 1.0]), (6, [-2.0])])
    made = search.unit_vectors(rows, "id", "vector")
    assert "transform(" not in made._jdf.queryExecution().optimizedPlan().toString()
    got = {r.id: r.vector for r in made.collect()}
    assert set(got) == {1, 3, 6} and np.allclose(got[1], [0.6, 0.8]) and got[6] == [-1.0]
    assert np.allclose(got[3], [0.5**0.5, 0.5**0.5, 0.0])
