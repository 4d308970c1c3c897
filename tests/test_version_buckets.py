"""Repeated and changed mails of a stream: many messages of a bucket in one state."""

import random

from pyspark.sql import functions as F

from postmill.streaming import versions
from test_versions import feed, result


def plain(runs):
    """By message and run, contents in the order of their first time."""
    seen, want = {}, []
    for rows in runs:
        for i, s, t, _ in sorted(rows, key=lambda r: r[1]):
            contents = seen.setdefault(i, [])
            if t not in contents:
                contents.append(t)
                want.append((i, s, t, len(contents), "new" if len(contents) == 1 else "changed"))
    return sorted(want)


def test_state_is_by_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "BUCKETS", 4, raising=False)
    rng = random.Random(5)
    runs = []
    for start in (0, 40):
        rows = [(f"m{rng.randrange(150)}", start + rng.randrange(40), f"t{rng.randrange(4)}", "in") for _ in range(600)]
        # Contents of a message that differ have different times, so that their order is certain.
        runs.append(list({(i, s): (i, s, t, f) for i, s, t, f in rows}.values()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        last = [feed(spark, tmp_path, rows)[-1] for rows in runs][-1]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert result(spark, tmp_path) == plain(runs)
    assert 0 < last.stateOperators[0].numRowsTotal < 40


def test_forgotten_one_by_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "BUCKETS", 1, raising=False)
    feed(spark, tmp_path, [("a", 0, "x", "in"), ("c", 2, "x", "in"), ("e", 9, "x", "in")])
    feed(spark, tmp_path, [("clock", 111, "x", "in")])  # a is forgotten at 100
    feed(spark, tmp_path, [("clock", 113, "x", "in")])  # c at 102, between two sweeps
    feed(spark, tmp_path, [("c", 114, "x", "in"), ("e", 114, "x", "in"), ("a", 114, "x", "in")])
    feed(spark, tmp_path, [("c", 115, "x", "in"), ("c", 116, "y", "in"), ("e", 116, "x", "in")])
    got = [r for r in result(spark, tmp_path) if r[0] != "clock"]
    assert got == [
        ("a", 0, "x", 1, "new"), ("a", 114, "x", 1, "new"),
        ("c", 2, "x", 1, "new"), ("c", 114, "x", 1, "new"), ("c", 116, "y", 2, "changed"),
        ("e", 9, "x", 1, "new"),
    ]


def test_keys_of_other_kinds(spark):
    rows = spark.sql(
        "select 1.5D as d, timestamp'2024-01-01 00:00:00.000001' as t, 7L as n, array(1, 2) as a, 'k' as s, 0.0D as z, -0.0D as y"
    )
    texts = {c: rows.select(versions._text(rows, c).alias("x")).first().x for c in rows.columns}
    assert texts["s"] == "k" and texts["t"].endswith("000001") and len(set(texts.values())) == 6
    zeros = spark.sql("select explode(array(0.0D, -0.0D)) as z")
    assert zeros.select(versions._text(zeros, "z").alias("x")).agg(F.countDistinct("x")).first()[0] == 1
