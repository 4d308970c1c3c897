"""Brute force for what was held by accuracy or at other settings: the ordinal regression, and
line dedup as the query and the pipeline ask for it."""

import math
import random

import numpy as np
import pytest

from postmill.llm.line_dedup import EDIT_WORDS, dedup_lines
from postmill.llm.maxent_lm import CLASSES, KINDS, SLOTS, Statistics, _predicted
from postmill.llm.ordinal_quality import Model, fit
from test_corpus_operators import edits


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def likelihood(weights, thresholds, rows, grades):
    """The log likelihood of the cumulative-link model, a row at a time."""
    total = 0.0
    for features, grade in zip(rows, grades, strict=True):
        score = sum(weights[f] for f in features)
        upper = sigmoid(thresholds[grade] - score) if grade < len(thresholds) else 1.0
        lower = sigmoid(thresholds[grade - 1] - score) if grade else 0.0
        total += math.log(max(upper - lower, 1e-12))
    return total


def climbed(rows, grades, names, levels):
    """The best likelihood that steps along numeric gradients find."""
    place = [0.0] * len(names) + [i - (levels - 2) / 2 for i in range(levels - 1)]

    def value(x):
        return likelihood(dict(zip(names, x, strict=False)), sorted(x[len(names) :]), rows, grades)

    rate, best = 0.02, value(place)
    for _ in range(120):
        slope = []
        for i in range(len(place)):
            moved = list(place)
            moved[i] += 1e-5
            slope.append((value(moved) - best) / 1e-5)
        while rate > 1e-6:
            tried = [x + rate * s for x, s in zip(place, slope, strict=True)]
            new = value(tried)
            if new > best:
                place, best, rate = tried, new, rate * 1.5
                break
            rate /= 2
    return best


def test_regression_finds_the_best_likelihood():
    rng = random.Random(1)
    names, weights, thresholds = [3, 11, 40], {3: 1.5, 11: -2.0, 40: 0.5}, [-1.0, 0.7]
    rows = [sorted(rng.sample(names, rng.randint(1, 3))) for _ in range(240)]
    grades = []
    for row in rows:
        score, draw = sum(weights[f] for f in row), rng.random()
        grades.append(sum(draw > sigmoid(t - score) for t in thresholds))
    features = [np.array(r, np.int64) for r in rows]
    model = fit(features, np.array(grades), 3, steps=800, sparsity=0.0, ridge=0.0)
    ours = likelihood(model.weights, model.thresholds.tolist(), rows, grades)
    best = climbed(rows, grades, names, 3)
    chance = likelihood(dict.fromkeys(names, 0.0), climb_start(grades), rows, grades)
    assert ours >= best - 0.5
    assert ours > chance + 10
    assert model.thresholds[0] < model.thresholds[1] and np.count_nonzero(model.weights) == 3


def climb_start(grades):
    shares = [sum(g <= k for g in grades) / len(grades) for k in range(2)]
    return [math.log(s / (1 - s)) for s in shares]


def test_regression_probabilities():
    rng = np.random.default_rng(2)
    model = Model(rng.normal(size=50), np.array([-1.0, 0.5, 2.0]))
    features = [rng.choice(50, rng.integers(1, 9), replace=False) for _ in range(30)]
    found = model.reach(features)
    for row, own in zip(found, features, strict=True):
        score = sum(model.weights[f] for f in own)
        assert np.allclose(row, [1 - sigmoid(t - score) for t in model.thresholds])
        assert (np.diff(row) <= 0).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_as_the_query_asks(spark, seed):
    """Every line with a letter or digit for equality, lines of 8 words or more for edits, with
    earlier lines of 7 or more; all other lines stay."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    base = [rng.choices(words, k=rng.choice([1, 1, 2, 3, 5, 6, 7, 7, 8, 8, 9, 12])) for _ in range(30)]
    rows = []
    for i in range(70):
        lines = []
        for _ in range(rng.randint(0, 7)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 1, 1, 2])):
                k = rng.randrange(len(line))
                line[k : k + rng.randint(0, 1)] = rng.choice([[], [rng.choice(words)]]) if len(line) > 1 else line[k : k + 1]
            lines.append(rng.choice([" ", "  ", " - "]).join(line or ["***"]))
        rows.append((i, "\n".join([*lines, "***", ""])))
    seen, want = [], {}
    for i, t in rows:
        kept = []
        for line in t.split("\n"):
            own = "".join(c.lower() if c.isalnum() else " " for c in line).split()
            gone = own and any(
                own == w or (len(own) >= 8 and len(w) >= 7 and abs(len(w) - len(own)) < 2 and edits(own, w) <= 1)
                for w in seen
            )
            if own:
                seen.append(own)
            if not gone:
                kept.append(line)
        want[i] = "\n".join(kept)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = dedup_lines(docs, min_words=1, partner_words=EDIT_WORDS - 1)
    assert {r.doc_id: r.text for r in found.collect()} == want


def test_chances_of_the_classes():
    """They add up to 1, and the context changes them."""
    rng = np.random.default_rng(0)
    stats = Statistics(rng.integers(1, 9, CLASSES), rng.integers(10, 90, CLASSES), rng.integers(0, 9, CLASSES))
    weights = rng.normal(size=(KINDS, SLOTS, CLASSES)).astype(np.float32)
    found = _predicted(weights, stats.bias.astype(np.float32), rng.integers(0, SLOTS, (KINDS, 5)).astype(np.uint16))
    assert (found > 0).all() and not np.allclose(found[0], found[1])
    total = found.astype(float).sum(axis=1)
    assert np.allclose(total, 1, atol=1e-5)
