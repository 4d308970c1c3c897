"""Repeated ids with different rows, clashing column names, empty tables, nulls: every operator
and every stage of the pipeline. Candidate pairs of documents that share a passage."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SMALL
from postmill.llm import near_dup
from postmill.llm.line_dedup import dedup_lines
from postmill.llm.metric_join import link_vectors
from postmill.llm.near_dup import drop_near_duplicates, near_duplicates
from postmill.llm.queries import QUERIES
from postmill.llm.word_tokens import WordStore, gathered

VOCABULARY = [f"word{i}" for i in range(4000)]


def text(rng, n):
    return " ".join(rng.choices(VOCABULARY, k=n))


def components(nodes, linked):
    label = {n: i for i, n in enumerate(nodes)}
    again = True
    while again:
        again = False
        for a, b in linked:
            low = min(label[a], label[b])
            again |= label[a] != label[b]
            label[a] = label[b] = low
    return label


def shingles(t):
    words = t.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_classes(rows):
    """By position: the least id of the class."""
    sets = [shingles(t) for _, t in rows]
    linked = []
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                linked.append((i, j))
    label = components(range(len(rows)), linked)
    return [min(rows[j][0] for j in label if label[j] == label[i]) for i in range(len(rows))]


def test_near_duplicates_of_repeated_ids(spark):
    rng = random.Random(1)
    base = [text(rng, 60) for _ in range(6)]
    rows = [(1, base[0]), (1, base[1]), (3, base[0] + " more"), (4, base[1] + " other"), (5, base[2])]
    rows += [(5, base[3]), (6, base[2] + " x"), (2, base[3] + " y"), (7, base[4]), (7, base[4]), (8, ""), (8, base[5]), (9, base[5])]
    for turn in range(3):
        rng.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4 - turn)
        got = sorted((r.doc_id, r.class_id) for r in near_duplicates(docs).collect())
        assert got == sorted((i, c) for (i, _), c in zip(rows, plain_classes(rows), strict=True))
    kept = sorted({r.doc_id for r in drop_near_duplicates(docs).collect()})
    assert kept == [1, 2, 5, 7, 8]


def clustered(rng, n):
    """Documents around one base, with more and more words of their own."""
    base = rng.choices(VOCABULARY, k=120)
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(120), rng.randint(0, 6)):
            words[at] = f"own{i}x{at}"
        yield " ".join(words)


@pytest.mark.parametrize("weighted", [False, True])
def test_near_duplicates_of_a_cluster(spark, weighted):
    rng = random.Random(2)
    rows = list(enumerate([*clustered(rng, 60), *clustered(rng, 40), *(text(rng, 80) for _ in range(20))], 10))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.class_id for r in near_duplicates(docs, bands=60, rows=2, weighted=weighted).collect()}
    assert got == {i: c for (i, _), c in zip(rows, plain_classes(rows), strict=True)}


def candidate_pairs(spark, monkeypatch, docs):
    counts = {}
    rare = near_dup._rare_pairs

    def counted(*arguments):
        pairs = rare(*arguments)
        counts["pairs"] = pairs.count()
        return pairs

    monkeypatch.setattr(near_dup, "_rare_pairs", counted)
    found = near_duplicates(docs)
    assert found.where("not kept").count() == 0
    return counts.get("pairs", 0)


def test_a_shared_passage_makes_no_pairs(spark, monkeypatch):
    """Twice as many documents with one passage have at most twice as many candidate pairs."""
    rng = random.Random(3)
    passage = text(rng, 140)
    rows = [(i, text(rng, 30) + " " + passage + " " + text(rng, 30)) for i in range(300)]
    few, many = (
        candidate_pairs(spark, monkeypatch, spark.createDataFrame(rows[:n], "doc_id bigint, text string"))
        for n in (150, 300)
    )
    assert many <= 2 * max(few, 10)


def test_lines_of_repeated_ids(spark):
    long = "a first line of eight plain words here"
    other = "the second line has also got eight words"
    rows = [
        (1, f"{long}\nunique one of this text\n{other}"), (1, "short"), (1, f"short\n{other} too"),
        (2, f"x\n{long} now"), (3, "short"), (3, "not short"), (0, other), (4, None), (4, ""), (None, long),
    ]
    for parts in (1, 4):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
        found = dedup_lines(docs, min_words=1, partner_words=7).collect()
        texts = {}
        for r in found:
            texts.setdefault(r.doc_id, []).append(r.text)
        assert len(found) == len(rows)
        assert texts[0] == [other] and texts[2] == ["x"] and texts[None] == [long]
        assert sorted(texts[3]) == ["", "not short"] and sorted(texts[4], key=str) == ["", None]
        # Of the texts of id 1, each loses what an earlier text of any id has, and no more.
        assert sorted(texts[1], key=len)[-1] == f"{long}\nunique one of this text"
        assert sum(t.split("\n").count("short") for t in texts[1]) == 1
        assert not any(other in t for t in texts[1])


def test_links_of_repeated_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01])]
    rows += [(int(i), v.tolist()) for i, v in zip(rng.integers(3, 30, 60), rng.normal(size=(60, 2)), strict=True)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    unit = np.array([v for _, v in rows]) / np.linalg.norm([v for _, v in rows], axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    label = components(range(len(rows)), list(zip(*np.nonzero(near), strict=True)))
    least = [min(rows[j][0] for j in label if label[j] == label[i]) for i in range(len(rows))]
    want = sorted((rows[i][0], int(near[i].sum()) - 1, least[i]) for i in range(len(rows)))
    for cell in (8, 1000):
        got = sorted((r.vec_id, r.n_links, r.component_id) for r in link_vectors(frame, cell=cell).collect())
        assert got == want


CLASHES = (
    "id", "part", "pm_id", "pm_part", "pm_lines", "pm_gone", "pm_leak", "PM_ID_", "__pm_id", "__pm_lines", "several",
    "w", "p", "key", "line", "lines", "hash", "halves", "words", "kept", "class_id", "rep", "f1", "f2", "gone", "mask",
    "grade", "features", "score", "places", "output", "form", "n", "n_dropped", "token_bytes", "start", "spans",
)


def with_clashes(frame):
    return frame.withColumns({c: F.lit(f"own {c}") for c in CLASHES})


STAGES = corpus_pipeline.STAGES


@pytest.mark.parametrize("number", range(len(STAGES)))
def test_stage_with_clashing_columns(spark, number):
    name, stage = STAGES[number]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = [(700_001, None, None, None, None), (700_002, "", "en", "s", 0), (None, "no id", "en", "s", 5)]
    docs = docs.unionByName(spark.createDataFrame([*odd, odd[1]], docs.schema))
    plain = stage(spark, docs, SMALL)
    rich = stage(spark, with_clashes(docs), SMALL)
    columns = docs.columns if number < len(STAGES) - 1 else ["doc_id", "doc_tokens", "length"]
    key = lambda r: repr(r)
    got, want = (sorted(map(tuple, f.select(columns).collect()), key=key) for f in (rich, plain))
    assert got == want
    if number < len(STAGES) - 1:
        assert plain.columns == docs.columns and rich.columns == with_clashes(docs).columns
        assert rich.where(" or ".join(f"`{c}` != 'own {c}'" for c in CLASHES)).count() == 0
    empty = stage(spark, docs.limit(0), SMALL)
    assert empty.count() == 0 and empty.columns == plain.columns


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "op8_revisits"])
def test_query_with_clashing_columns(spark, name, tmp_path):
    for table in ("documents", "pages", "embeddings", "labels", "benchmark"):
        frame = spark.read.parquet(f"{SMALL}/{table}.parquet")
        free = [c for c in CLASHES if c not in frame.columns]
        frame.withColumns({c: F.lit(f"own {c}") for c in free}).write.parquet(f"{tmp_path}/{table}.parquet")
    key = lambda r: repr(r)
    rich, plain = (QUERIES[name](spark, str(f)) for f in (tmp_path, SMALL))
    assert rich.columns == plain.columns
    if name not in ("op2_packing", "op7_language_model", "op6_secrets", "op9_quality"):  # as their tasks are dealt
        assert sorted(map(tuple, rich.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)
    else:
        assert rich.count() > 0


def test_word_store():
    store = WordStore(limit=8)
    rng = np.random.default_rng(5)
    known = {}
    for _ in range(60):
        new = np.unique(rng.integers(0, 200, 5).astype(np.uint64))
        store.make_room(len(new))
        at, there = store.find(new)
        new = new[~there]
        lengths = rng.integers(0, 4, len(new))
        ids = rng.integers(0, 99, lengths.sum()).astype(np.uint32)
        ends = np.cumsum(lengths)
        for h, end, n in zip(new.tolist(), ends, lengths, strict=True):
            known[h] = ids[end - n : end].tolist()
        store.add(new, ids, ends)
        assert len(store.keys) <= 8 and (np.diff(store.keys.astype(np.int64)) > 0).all()
        for h, begin, n in zip(store.keys.tolist(), store.begin, store.length, strict=True):
            assert gathered(store.ids, np.array([begin]), np.array([n])).tolist() == known[h]
        store.uses[:1] += 5
