"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade <= k) = logistic(threshold_k - w.x) with one vector of weights w for all grades and
ordered thresholds. x are the hashed words of the text and their beginnings, each once, and
shares of letters, signs and the like, in steps. The model gives each document its expected grade and the
probability of reaching the wanted grade.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from postmill.llm.staging import id_and_text, prepare
from postmill.llm.words import Block, blocks, by_blocks, table

SLOTS = 1 << 18
STEMS = (4, 5, 7)  # lengths of the word beginnings that are features
SAMPLE_ROWS = 6000
STEPS = 120
SPARSITY = 2.0  # L1 weight: a word needs evidence from a few documents to count at all
RIDGE = 0.02
THRESHOLD = 0.5
_SHARES = 10
_LEVELS = 12
_SIZE = SLOTS + _SHARES * _LEVELS


def _slots(hashes: np.ndarray, kind: int) -> np.ndarray:
    return ((hashes >> np.uint64(kind)) % np.uint64(SLOTS)).astype(np.uint32)


def _features(block: Block) -> list[np.ndarray]:
    """For each text, the sorted numbers of the features that it has."""
    codes = block.codes
    starts, ends = block.words()
    first = block.first(starts)
    words = _slots(block.hashes(starts, ends), 0)
    stems = []  # (slots, first one of each text), by length
    for size in STEMS:
        own = starts[ends - starts >= size]
        stems.append((_slots(block.hashes(own, own + size), size), block.first(own)))

    def share(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[block.ends] - total[block.starts]

    size = np.maximum(block.ends - block.starts, 1)
    count = np.maximum(np.diff(first), 1)
    word, space = table("word")[codes], table("space")[codes]
    upper = share(table("upper")[codes])
    feeds = share(codes == 10)
    odd = ~word & ~space & (codes != 44) & (codes != 46)
    chars = np.concatenate(([0], np.cumsum(ends - starts)))
    letters = np.maximum(chars[first[1:]] - chars[first[:-1]], 1)
    distinct = np.array([len(np.unique(words[a:b])) for a, b in zip(first[:-1], first[1:], strict=True)])
    shares = [
        upper / letters,
        share(table("digit")[codes]) / letters,
        share(odd) / count,
        share((codes == 33) | (codes == 63)) / count,
        share(codes == 124) / count,
        share((codes == 44) | (codes == 46)) / count,
        share(space) / size,
        letters / count / 20,
        feeds / count,
        distinct / count,
    ]
    edges = np.array([0.002, 0.01, 0.03, 0.07, 0.12, 0.2, 0.3, 0.45, 0.6, 0.8, 0.95])
    levels = np.stack([np.searchsorted(edges, s, "right") for s in shares], axis=1)
    places = (levels + SLOTS + np.arange(_SHARES) * _LEVELS).astype(np.uint32)
    kinds = [(words, first), *stems]
    return [
        np.concatenate([np.unique(np.concatenate([x[f[i] : f[i + 1]] for x, f in kinds])), own])
        for i, own in enumerate(places)
    ]


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray  # ascending; one fewer than there are grades

    def reach(self, features: list[np.ndarray]) -> np.ndarray:
        """P(grade > k) for each text and threshold k."""
        sizes = np.array([len(f) for f in features])
        row = np.repeat(np.arange(len(sizes)), sizes)
        score = np.bincount(row, self.weights[np.concatenate(features)], len(sizes))
        return 1 / (1 + np.exp(np.clip(self.thresholds - score[:, None], -500, 500)))


def fit(
    features: list[np.ndarray],
    grades: np.ndarray,
    levels: int,
    steps: int = STEPS,
    sparsity: float = SPARSITY,
    ridge: float = RIDGE,
) -> Model:
    """Maximum likelihood with L1 and L2 penalties, by accelerated proximal gradient steps
    scaled by how often each feature occurs."""
    counts = np.bincount(np.concatenate(features), minlength=_SIZE) if features else np.zeros(_SIZE)
    share = np.array([(grades <= k).mean() if len(grades) else 0.5 for k in range(levels - 1)])
    share = share.clip(1e-3, 1 - 1e-3)
    theta = np.maximum.accumulate(np.log(share / (1 - share)) + np.arange(levels - 1) * 1e-6)
    weights = np.zeros(_SIZE)
    if not features or len(np.unique(grades)) < 2:
        return Model(weights, theta)
    # A feature of one row tells nothing about others; the rest are numbered anew.
    used = np.flatnonzero(counts > 1)
    number = np.cumsum(counts > 1, dtype=np.int32) - 1
    features = [number[f[counts[f] > 1]] for f in features]
    sizes = np.array([len(f) for f in features])
    flat = np.concatenate(features)
    row = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    shape = used >= SLOTS
    weights = np.zeros(len(used))
    seen = np.full(len(used), 1e-8) + 0.25 * counts[used]
    rate = 0.6
    moment, slope, slope_theta = np.zeros(len(used)), np.zeros(len(used)), np.full(levels - 1, 1e-8)
    top, bottom = grades < levels - 1, grades > 0
    for step in range(1, steps + 1):
        score = np.bincount(row, weights[flat], len(sizes))

        def below(k: np.ndarray) -> np.ndarray:
            return 1 / (1 + np.exp(np.clip(score - theta[k], -500, 500)))

        upper = np.where(top, below(np.minimum(grades, levels - 2)), 1.0)
        lower = np.where(bottom, below(np.maximum(grades - 1, 0)), 0.0)
        inside = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / inside, lower * (1 - lower) / inside
        error = dl - du  # of the log likelihood, by the score
        pull = np.bincount(flat, error[row], len(used)) - ridge * weights
        moment = 0.9 * moment + 0.1 * pull
        slope = 0.95 * slope + 0.05 * pull**2
        scale = np.sqrt(slope / (1 - 0.95**step)) + 0.05 * seen + 1e-3
        move = rate * (moment / (1 - 0.9**step)) / scale
        weights = weights + move
        cut = rate * sparsity / scale
        cut[shape] *= 0.1
        weights = np.sign(weights) * np.maximum(np.abs(weights) - cut, 0)
        change = np.bincount(np.minimum(grades, levels - 2), du * top, levels - 1)
        change -= np.bincount(np.maximum(grades - 1, 0), dl * bottom, levels - 1)
        slope_theta += change**2
        theta = np.maximum.accumulate(theta + rate * change / np.sqrt(slope_theta))
        theta = theta + np.arange(levels - 1) * 1e-6
        rate = 0.6 / math.sqrt(1 + step / 20)
    every = np.zeros(_SIZE)
    every[used] = weights
    return Model(every, theta)


def grade(quality: Column, toxic: Column) -> Column:
    """The graded rating of two flags: 0 toxic, 1 poor, 2 good; null where a flag is."""
    return F.when(quality.isNull() | toxic.isNull(), None).when(toxic != 0, 0).when(quality != 0, 2).otherwise(1)


def train_model(
    documents: DataFrame,
    ratings: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    levels: int = 3,
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit on ``sample_rows`` rated documents at most, the first ones by a hash of the id.

    ``ratings`` has ``id_column`` and ``grade`` (0 to ``levels`` - 1). Rows without an id or
    a grade, or with one outside the range, are left out; of an id's different grades the
    least counts. The sample's ids are taken first and broadcast, being bounded, so the
    documents are read once and not shuffled. With fewer than two grades in the sample, all
    documents get the same probabilities, those of the ratings.
    """
    prepare(documents.sparkSession)
    rated = ratings.where(f"`{id_column}` is not null and grade between 0 and {levels - 1}")
    rated = rated.groupBy(F.col(f"`{id_column}`").cast("bigint").alias("rated")).agg(
        F.min("grade").cast("int").alias("grade")
    )
    # More ids than rows are wanted, as some ids may have no document.
    picked = rated.orderBy(F.xxhash64("rated"), "rated").limit(2 * sample_rows)
    docs = id_and_text(documents, id_column, text_column)

    def work(ids: list[int], block: Block) -> pa.RecordBatch:
        rows = [f.astype(np.uint32).tobytes() for f in _features(block)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, pa.binary())], ["id", "features"])

    some = docs.join(F.broadcast(picked), docs.id == picked.rated, "left_semi")
    sparse = some.mapInArrow(by_blocks(work), "id bigint, features binary").dropDuplicates(["id"])
    rows = (
        sparse.join(F.broadcast(picked), sparse.id == picked.rated)
        .orderBy(F.xxhash64("id"), "id")
        .select("features", "grade")
        .limit(sample_rows)
        .collect()
    )
    features = [np.frombuffer(r.features, np.uint32) for r in rows]
    return fit(features, np.array([r.grade for r in rows], np.int64), levels)


def rate_documents(
    documents: DataFrame,
    model: Model,
    id_column: str = "doc_id",
    text_column: str = "text",
    wanted: int = 2,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, expected_grade, tail, keep) of every row: the expected grade, the probability
    of grade ``wanted`` or better, and whether that is ``threshold`` at least.

    Null and empty texts are rated like a text without words; null ids and repeated rows
    like any other row; whole texts are read, in blocks. An empty table gives an empty
    result. Only the two named columns are read. Row-local: no shuffle.
    """
    prepare(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def work(ids: list, block: Block) -> pa.RecordBatch:
        reach = sent.value.reach(_features(block))
        tail = reach[:, wanted - 1]
        columns = [pa.array(ids, pa.int64()), pa.array(reach.sum(axis=1)), pa.array(tail), pa.array(tail >= threshold)]
        return pa.RecordBatch.from_arrays(columns, ["id", "expected_grade", "tail", "keep"])

    two = documents.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    )
    result = "id bigint, expected_grade double, tail double, keep boolean"
    return two.mapInArrow(by_blocks(work), result).withColumnRenamed("id", id_column)


def keep_good(documents: DataFrame, model: Model, text_column: str = "text", **options) -> DataFrame:
    """``documents`` that the model keeps, all their columns unchanged.

    Each row is judged by its own text alone: a null text as an empty one, a very long text as a
    whole, rows that repeat an id or a text one by one, rows without an id as well. An empty table
    is returned as it is.
    """
    prepare(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)
    wanted, threshold = options.get("wanted", 2), options.get("threshold", THRESHOLD)

    @F.arrow_udf(BooleanType())
    def good(texts: pa.Array) -> pa.Array:
        found = [np.empty(0)]
        for a in range(0, len(texts), 256):
            for _, block in blocks(texts.slice(a, 256).to_pylist()):
                found.append(sent.value.reach(_features(block))[:, wanted - 1])
        return pa.array(np.concatenate(found) >= threshold)

    return documents.where(good(F.coalesce(F.col(f"`{text_column}`"), F.lit(""))))
