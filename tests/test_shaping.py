import hashlib

import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from postmill.operators.shaping import (
    batch_plan,
    cap_items,
    cap_sequences,
    length_batches,
    tokenizer_tokens,
    word_tokens,
)
from postmill.session import shared_dir


def test_word_tokens(apply):
    texts = ["", " a b\n c ", "\x1f", "one"]
    assert apply(word_tokens, texts) == [t.split() for t in texts]


def test_sequences_are_cut(spark):
    table = spark.createDataFrame([("a b c d",), ("a",), ("",)], "text string")
    rows = cap_sequences(table, limit=2).collect()
    assert [(r.n_tokens, r.tokens) for r in rows] == [(4, ["a", "b"]), (1, ["a"]), (0, [])]


def test_own_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")

    def encoder():
        model = tokenizers.models.WordLevel({"a": 1, "b": 2, "?": 0}, unk_token="?")
        tokenizer = tokenizers.Tokenizer(model)
        tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
        return lambda text: tokenizer.encode(text).ids

    table = spark.createDataFrame([("a b x a",)], "text string")
    row = cap_sequences(table, limit=3, tokens=tokenizer_tokens(encoder)).first()
    assert (row.n_tokens, row.tokens) == (4, [1, 2, 0])


def test_batch_tokenizer(spark):
    class Encoder:
        def __call__(self, texts):
            assert isinstance(texts, list) and None not in texts
            return [[ord(c) for c in t] for t in texts]

    table = spark.createDataFrame([(1, "ab"), (2, None), (3, ""), (4, "c")], "id int, text string")
    rows = cap_sequences(table, limit=1, tokens=tokenizer_tokens(make_batch_encoder=Encoder)).collect()
    assert {r.id: r.tokens for r in rows} == {1: [97], 2: None, 3: [], 4: [99]}
    for wrong in ({}, {"make_encoder": Encoder, "make_batch_encoder": Encoder}):
        with pytest.raises(ValueError, match="either"):
            tokenizer_tokens(**wrong)


@pytest.mark.parametrize("rows", [1, 15, 64, 1000, 5000])
def test_length_batches(spark, rows):
    table = spark.range(rows).select("id", (F.xxhash64("id") % 50 + 50).alias("length"))
    out = sorted(length_batches(table, "id", "length").collect(), key=lambda r: r.position)
    order = sorted(range(rows), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert [r.id for r in out] == order
    assert [r.position for r in out] == list(range(rows))
    per = 50
    places = sorted((r.batch, r.slot, r.length, r.position) for r in out)
    assert [(b, s) for b, s, _, _ in places] == [divmod(i, 16) for i in range(rows)]
    for at in range(0, rows, per * 16):
        chunk = places[at : at + per * 16]
        assert [p[2] for p in chunk] == sorted((p[2] for p in chunk), reverse=True)
        assert {p[3] // (per * 16) for p in chunk} == {at // (per * 16)}
    other = length_batches(table, "id", "length", seed=1).orderBy("position")
    assert rows < 64 or [r.id for r in other.collect()] != order


def test_batch_plan(spark):
    row = batch_plan(spark.range(33)).first()
    assert (row.examples, row.steps_per_epoch, row.total_steps) == (33, 3, 6)
    assert batch_plan(spark.range(0)).first().total_steps == 0


def test_cap_items(spark):
    table = spark.range(10_000, numPartitions=40).select(
        F.concat(F.lit("p"), F.col("id").cast("string")).alias("path"), "id"
    )
    first = sorted(f"p{i}" for i in range(10_000))[:777]
    assert sorted(r.path for r in cap_items(table, 777, "path").collect()) == first
    assert cap_items(table, 0, "path").count() == 10_000
    assert cap_items(table, -1, "path").count() == 10_000
    assert cap_items(table, 20_000, "path").count() == 10_000
    assert cap_items(table.where("id < 0"), 5, "path").count() == 0


def test_cap_filters_at_the_scan(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = cap_items(table, 10, "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(doc_id" in plan and "Exchange" not in plan


def test_cap_by_any_ordered_key(spark):
    rows = spark.range(3000, numPartitions=7).selectExpr(
        "(id * 7919 % 3000 - 1500) * 1000003 as number",
        "concat('/mail/user', id % 40, '/', repeat('x', id % 3), id) as path",
        "concat('\u00e9\U0001f600', id) as odd",
        "encode(concat('\uffff', id * 31 % 3000), 'UTF-8') as raw",
        "timestamp_seconds(id * 7919 % 3000 - 1500) as at",
        "date_add(date'1970-01-02', int(id * 7919 % 3000 - 1500)) as day",
        "if(id % 3 = 0, null, id) as some",
    ).cache()
    for key in rows.columns:
        keys = sorted((r[0] for r in rows.select(key).collect() if r[0] is not None), key=lambda k: k.encode() if isinstance(k, str) else k)
        for limit in (1, 2, 255, len(keys) // 2, len(keys) - 1, len(keys), len(keys) + 1):
            found = [r[0] for r in cap_items(rows, limit, key, bucket_rows=16).select(key).collect()]
            assert sorted(found, key=lambda k: k.encode() if isinstance(k, str) else k) == keys[:limit]
    with pytest.raises(ValueError, match="double"):
        cap_items(rows.selectExpr("cast(number as double) as d"), 5, "d")


def test_cap_of_repeated_keys(spark):
    rows = spark.range(1000).selectExpr("if(id < 900, 'same', concat('z', id)) as k")
    assert cap_items(rows, 10, "k", bucket_rows=4).count() == 900
    assert cap_items(rows, 905, "k", bucket_rows=4).count() == 905


def test_no_task_of_a_cap_sorts_more_than_a_bucket(spark, monkeypatch):
    """For half of the table, rounds bring at most 257 counts each, and one bucket is sorted."""
    rows = spark.range(40_000, numPartitions=16).selectExpr("concat('/very/long/prefix/', md5(string(id))) as path")
    collected, sorted_rows = [], []
    collect, order = DataFrame.collect, DataFrame.orderBy
    monkeypatch.setattr(DataFrame, "collect", lambda self: collected.append(collect(self)) or collected[-1])
    monkeypatch.setattr(DataFrame, "orderBy", lambda self, *c: sorted_rows.append(self.count()) or order(self, *c))
    frame = cap_items(rows, 20_000, "path", bucket_rows=500)
    monkeypatch.undo()
    assert frame.count() == 20_000
    assert len(sorted_rows) == 1 and sorted_rows[0] <= 500
    assert 1 <= len(collected) <= 5 and max(map(len, collected)) <= 257


def test_shared_folder_is_cleared(spark):
    other = spark.newSession()
    path = shared_dir(other, "kept")
    spark.range(3).write.parquet(path)
    folder = path.rpartition("/")[0]
    assert spark.sparkContext.applicationId in folder
    # Not the whole of this session's folder, which other tests read from.
    class Session:
        conf, sparkContext, _jvm = other.conf, other.sparkContext, other._jvm

    import postmill.session as session

    plain = session.shared_dir
    try:
        session.shared_dir = lambda _, name: f"{path}/{name}"
        assert session.clear_shared(Session) and not session.clear_shared(Session)
    finally:
        session.shared_dir = plain


def test_shared_folder_is_required_on_a_cluster(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Cluster:
        class conf:  # noqa: N801 - stands in for the session's attribute
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "yarn"}.get(key, default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster(), "x")
