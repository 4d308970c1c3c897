"""The pipeline on planted cases, stage by stage; the operators' queries at a small size."""

import random

import __spark_entry__ as entry
import corpus_pipeline
from check import compare, connect
from conftest import SMALL
from postmill.llm.queries import ORACLE, QUERIES


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


def test_sql(spark):
    db = connect(SMALL)
    for name in ORACLE:
        assert compare(spark, db, SMALL, name) is None, name


def test_stages_on_planted_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rng = random.Random(1)
    words = [w for r in docs.where("lang = 'en'").limit(60).collect() for w in r.text.split()]
    words = [w for w in words if w.isalpha() and not w.isupper()]

    def line(n):
        return " ".join(rng.choices(words, k=n))

    def text():
        return "\n".join(line(40) + "." for _ in range(6))

    clean = {90_000 + i: text() for i in range(20)}
    passage = line(60)
    one, item = text(), spark.read.parquet(f"{SMALL}/benchmark.parquet").first().text
    near = one.split()
    near[50] = "changed"
    planted = {
        91_000: one, 91_001: one, 91_002: " ".join(near),
        91_003: text() + "\n" + passage, 91_004: text() + "\n" + passage, 91_005: text() + "\n" + item,
    }
    extra = [(i, t, "en", "src1", len(t)) for i, t in (clean | planted).items()]
    now = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    good = corpus_pipeline.good_documents(spark, now, SMALL)
    assert good.columns == docs.columns
    kept = {r.doc_id for r in good.select("doc_id").collect()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    fine = {r.doc_id for r in labels if r.quality and not r.toxic}
    toxic = {r.doc_id for r in labels if r.toxic}
    assert len(fine & kept) >= 0.95 * len(fine) and len(toxic & kept) <= 0.3 * len(toxic)

    lines = corpus_pipeline.without_repeated_lines(spark, now, SMALL)
    assert lines.columns == docs.columns
    texts = {r.doc_id: r.text for r in lines.where("doc_id >= 90000").collect()}
    assert {i: texts[i] for i in clean} == clean
    assert 91_001 not in texts and passage in texts[91_003] and passage not in texts[91_004]
    assert all(r.n_chars == len(r.text) for r in lines.where("doc_id = 91004").collect())

    unique = {r.doc_id for r in corpus_pipeline.one_of_each_group(spark, now, SMALL).select("doc_id").collect()}
    assert set(clean) | {91_000} <= unique and not {91_001, 91_002} & unique

    safe = {r.doc_id for r in corpus_pipeline.without_benchmark(spark, now, SMALL).select("doc_id").collect()}
    assert set(clean) <= safe and 91_005 not in safe


def test_run(spark):
    pieces = corpus_pipeline.run(spark, SMALL).collect()
    assert pieces and all(p.length == len(p.token_bytes) // 4 for p in pieces)
