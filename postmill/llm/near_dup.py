"""Near duplicates: weighted signatures from hashed darts, joined by bands, verified exactly.

Each element of a weighted set owns a region: its weight wide, and unbounded in rank. Darts
fall on the plane by hash alone, one for each unit of area, so equal elements of two sets
see the same darts. A dart belongs to one of ``k`` coordinates by its hash, and a set's
signature is the dart of least rank of each coordinate. Only ranks up to about
(k ln k + 2k) / weight are thrown, however large the set is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from postmill.llm.components import components
from postmill.llm.staging import free_name, id_and_text, joined_with, staged
from postmill.llm.words import (
    _ODD, _STEP, Block, binary, by_blocks, mixed, release, signed, windows, word_sets,
)

BANDS, ROWS = 25, 5
SHINGLE = 5
SIMILARITY = 0.8
BROADCAST_IDS = 1_000_000
HUB_ROUNDS = 1  # after the first
LEVEL = 1.05  # by so much the weights of one level differ
_SLACK = 1e-6  # of a weight, for rounding errors
_UNIT = 2.0**-53


def _multiple(value: np.uint64, times: int) -> np.uint64:
    return np.uint64(int(value) * times & 0xFFFFFFFFFFFFFFFF)


def dart_signatures(sets: list[np.ndarray], k: int, weights: list[np.ndarray] | None = None) -> np.ndarray:
    """A row of ``k`` dart hashes for each non-empty set of 64-bit elements.

    ``weights`` are positive and default to 1. Weights are cut into layers of doubling
    width; the darts of a layer are a Poisson process in rank whose gaps are drawn by hash.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    weight = np.ones(len(element)) if weights is None else np.concatenate(weights).astype(float)
    total = np.bincount(owner, weight, len(sets))
    layer = np.zeros(len(element), np.int64)
    if weights is not None:
        depth = np.ceil(np.log2(weight + 1)).astype(np.int64).clip(1)
        layer = np.arange(depth.sum()) - np.repeat(np.cumsum(depth) - depth, depth)
        element, owner, weight = (np.repeat(x, depth) for x in (element, owner, weight))
    width = 2.0**layer
    seed = mixed(element + layer.astype(np.uint64) * _ODD)
    limit = (k * math.log(k) + 2 * k) / total
    result = np.zeros((len(sets), k), np.uint64)
    best = np.full(len(sets) * k, np.inf)
    pending = np.arange(len(element))
    while len(pending):
        alive, rank, number = pending, np.zeros(len(pending)), 0
        while len(alive):
            number += 1
            dart = mixed(seed[alive] + _multiple(_STEP, number))
            rank = rank - np.log(((dart >> np.uint64(11)).astype(float) + 0.5) * _UNIT) / width[alive]
            near = rank <= limit[owner[alive]]
            alive, rank, dart = alive[near], rank[near], dart[near]
            second = mixed(dart + _ODD)
            across = ((second >> np.uint64(11)).astype(float) * _UNIT + 1) * width[alive] - 1
            hit = across < weight[alive]
            cell = owner[alive[hit]] * k + ((second[hit] & np.uint64(0xFFFFFFFF)) % np.uint64(k)).astype(np.int64)
            np.minimum.at(best, cell, rank[hit])
            won = rank[hit] == best[cell]
            result.reshape(-1)[cell[won]] = second[hit][won]
        # A set with a coordinate that no dart reached throws again, twice as far.
        missing = np.isinf(best.reshape(len(sets), k)).any(axis=1) & (sizes > 0)
        best.reshape(len(sets), k)[missing] = np.inf
        limit[missing] *= 2
        pending = np.flatnonzero(missing[owner])
    return result


def _bands(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signatures.reshape(len(signatures), bands, rows)
    total = np.zeros(parts.shape[:2], np.uint64) + np.arange(bands, dtype=np.uint64) * _ODD
    for r in range(rows):
        total = mixed(total * _STEP + parts[:, :, r])
    return total


def _weighted_sets(block: Block, n: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """As ``word_sets``, with how often each shingle occurs."""
    starts, ends = block.words()
    hashes = block.hashes(starts, ends)
    shingles, first = windows(hashes, n), block.first(starts)
    sets, counts = [], []
    for a, b in zip(first[:-1], first[1:], strict=True):
        own = shingles[a : b - n + 1] if b - a >= n else windows(hashes[a:b], max(1, b - a))
        found, times = np.unique(own, return_counts=True)
        sets.append(found)
        counts.append(times)
    return sets, counts


def _summary(bands: int, rows: int, n: int, weighted: bool):
    """(id, f1, f2, bands): 128 bits of the set with its weights, and its band keys; all three
    are null for a text without words."""

    def work(ids: list[int], block: Block) -> pa.RecordBatch:
        if weighted:
            sets, weights = _weighted_sets(block, n)
        else:
            sets, weights = list(word_sets(block, n)), None
        full = np.array([len(s) > 0 for s in sets], bool)
        some = np.flatnonzero(full)
        sets = [sets[i] for i in some]
        weights = weights and [weights[i] for i in some]
        keys = np.empty((0, bands), np.uint64)
        if len(some):
            keys = _bands(dart_signatures(sets, bands * rows, weights), bands, rows)
        offsets = np.append(0, np.cumsum(full * bands)).astype(np.int32)
        listed = pa.ListArray.from_arrays(pa.array(offsets), signed(keys.reshape(-1)), mask=pa.array(~full))
        place = pa.array(np.where(full, np.cumsum(full) - 1, 0), mask=~full)
        prints = [signed(x).take(place) for x in _prints(sets, weights)]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *prints, listed], ["id", "f1", "f2", "bands"]
        )

    return by_blocks(work)


def _prints(sets: list[np.ndarray], weights: list[np.ndarray] | None) -> list[np.ndarray]:
    """128 bits of each set with its weights, as two arrays."""
    marked = sets if weights is None else [
        s + w.astype(np.uint64) * _STEP for s, w in zip(sets, weights, strict=True)
    ]
    return [
        np.array([mixed(s + _multiple(_ODD, x)).sum() for s in marked], np.uint64) for x in (1, 2)
    ]


def _sets(n: int, weighted: bool):
    def work(ids: list[int], block: Block) -> pa.RecordBatch:
        if weighted:
            sets, weights = _weighted_sets(block, n)
            prints = _prints(sets, weights)
        else:
            sets, weights = list(word_sets(block, n)), [np.empty(0, np.int64)] * len(ids)
            prints = _prints(sets, None)
        columns = [*map(signed, prints), binary(sets), binary(weights)]
        return pa.RecordBatch.from_arrays(columns, ["f1", "f2", "elements", "weights"])

    return by_blocks(work)


@F.arrow_udf(DoubleType())
def _similarity(a: pa.Array, wa: pa.Array, b: pa.Array, wb: pa.Array) -> pa.Array:
    """Weighted Jaccard similarity: the sum of minima over the sum of maxima."""

    def one(*row: pa.Scalar) -> float:
        x, u, y, v = (value.as_buffer() for value in row)
        left, right = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        if not u.size:
            merged = np.concatenate([left, right])
            merged.sort(kind="stable")
            common = int((merged[1:] == merged[:-1]).sum())
            return common / (len(merged) - common)
        _, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
        p, q = np.frombuffer(u, np.int64), np.frombuffer(v, np.int64)
        common = int(np.minimum(p[i], q[j]).sum())
        return common / (int(p.sum()) + int(q.sum()) - common)

    return pa.array([one(*row) for row in zip(a, wa, b, wb, strict=True)], pa.float64())


def _linked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("elements").alias("ea"), F.col("weights").alias("wa"))
    right = sets.select(F.col("id").alias("b"), F.col("elements").alias("eb"), F.col("weights").alias("wb"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(_similarity("ea", "wa", "eb", "wb") >= similarity).select("a", "b")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")
    ).distinct()


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, comp, total, element, weight) of sets (id, comp, elements, weights)."""
    for batch in batches:
        for i in range(batch.num_rows):
            elements = np.frombuffer(batch.column("elements")[i].as_py(), np.uint64)
            weights = np.frombuffer(batch.column("weights")[i].as_py(), np.int64)
            weights = weights if len(weights) else np.ones(len(elements), np.int64)
            same = [np.full(len(elements), batch.column(c)[i].as_py(), np.int64) for c in ("id", "comp")]
            total = np.full(len(elements), weights.sum(), np.int64)
            columns = [*map(pa.array, same), pa.array(total), signed(elements), pa.array(weights)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "comp", "total", "element", "weight"])
    release()


def _hub_pairs(members: DataFrame, turn: int) -> DataFrame:
    """Each member of a bucket with its hub, or if that is of its own component, with the
    first member of another one. Who is first is drawn anew for each bucket and ``turn``."""
    drawn = F.struct(F.xxhash64("id", "key", F.lit(turn)).alias("draw"), "id", "comp")
    ranked = members.withColumn("first", drawn)
    one = ranked.groupBy("key").agg(F.min("first").alias("one"))
    two = (
        ranked.join(one, "key")
        .where("comp != one.comp")
        .groupBy("key")
        .agg(F.min("first").alias("two"), F.first("one").alias("one"))
    )
    hub = F.when(F.col("comp") == F.col("one.comp"), F.col("two.id")).otherwise(F.col("one.id"))
    return _ordered(members.join(two, "key").select("id", hub.alias("other")))


def _rare_pairs(split: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs of documents of different components that may be similar, by rare shingles.

    ``split`` has (key, id, comp); candidates are among its ids. For sets of weights m <= n to be
    similar, s (m + n) / (1 + s) of the weight must be common. So in any order of all shingles,
    here the rarest first, they share one before which either has no more than the rest of its
    weight. What many documents share stands behind that: a common passage makes no pairs, and
    neither does a document with too much of its own. As the bound depends on both weights, the
    smaller set goes by its level, a range of weights, and the larger one to each level that
    its partners may have. Members of one component are not paired: in each group the
    largest component meets the others only.
    """
    listed = sets.join(split.select("id", "comp").distinct(), "id")
    rows = listed.select("id", "comp", "elements", "weights").mapInArrow(
        _elements, "id bigint, comp bigint, total bigint, element bigint, weight bigint"
    )
    # A shingle of one component only joins nothing, but takes its place in the order.
    spread = rows.groupBy("element").agg(
        F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")
    )
    spread = staged(spread.where("n > 1 and low != high").select("element", "n"), "shared-shingles")
    in_order = Window.partitionBy("id").orderBy("n", "element")
    earlier = F.sum("weight").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    shared = F.sum("weight").over(Window.partitionBy("id"))
    total = F.col("total")
    # What stands before: all that is not shared, then the rarer shared ones.
    before = total - shared + F.coalesce(earlier, F.lit(0))
    ranked = rows.join(spread, "element").withColumn("before", before)
    part = similarity / (1 + similarity)
    level = F.floor(F.log(total) / math.log(LEVEL)).cast("int")
    steps = math.ceil(-math.log(similarity) / math.log(LEVEL))
    levels = F.sequence(level - steps, level)
    dealt = ranked.where(F.col("before") <= total * (1 - similarity) + _SLACK).select(
        "element", "id", "comp", "total", "before", level.alias("own"), F.explode(levels).alias("level")
    )
    least = F.greatest(total * similarity, F.pow(F.lit(LEVEL), F.col("level")))
    room = total - (F.least(least, total) + total) * part + _SLACK
    dealt = dealt.where(F.col("before") <= room).withColumn(
        "small", (F.col("level") == F.col("own")) & (F.col("before") <= total * (1 - 2 * part) + _SLACK)
    )
    first = staged(dealt.drop("own"), "rare-shingles")
    sizes = first.groupBy("element", "level", "comp").agg(F.count("*").alias("n"))
    most = (
        sizes.groupBy("element", "level")
        .agg(F.max_by("comp", F.struct("n", "comp")).alias("most"), F.count("*").alias("comps"))
        .where("comps > 1")
    )
    met = first.join(most, ["element", "level"]).withColumn("others", F.col("comp") != F.col("most"))
    # Side 0 holds the other components, side 1 the largest, which never meets itself.
    sides = F.when(F.col("others"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    left = met.where("small").select("element", "level", F.explode(sides).alias("side"), "id", "comp", "total", "before")
    right = met.select(
        "element", "level", F.when(F.col("others"), 0).otherwise(1).alias("side"), F.col("id").alias("other"),
        F.col("comp").alias("other_comp"), F.col("total").alias("other_total"), F.col("before").alias("other_before"),
    )
    larger = (total < F.col("other_total")) | ((total == F.col("other_total")) & (F.col("id") < F.col("other")))
    rest = F.least(total - F.col("before"), F.col("other_total") - F.col("other_before"))
    fits = rest + _SLACK >= (total + F.col("other_total")) * part
    pairs = left.join(right, ["element", "level", "side"])
    return _ordered(pairs.where((F.col("comp") != F.col("other_comp")) & larger & fits).select("id", "other"))


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    weighted: bool = False,
    broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """(id, class_id, kept): one row per document; a class is a connected group of documents.

    Two documents are linked when their sets of ``shingle`` words in a row (runs of letters
    and digits, in lower case; a shorter text is one shingle) have a Jaccard similarity of
    ``similarity`` or more; with ``weighted``, when their multisets do. ``class_id`` is the
    least id of the class, and ``kept`` whether that is the document's own.

    Candidates share one of ``bands`` keys of ``rows`` coordinates each: at the defaults, a
    pair of similarity 0.8 has none in 5 of 100,000 cases. Every candidate pair that may be
    similar is either compared exactly or already in one class: first, in ``HUB_ROUNDS`` + 1
    rounds of linear work, each member of a bucket with a hub of it, which joins the usual bucket
    of copies; then, of the buckets that still hold several classes, the pairs that share one of
    their rare shingles, without which they are not similar (``_rare_pairs``).

    Texts without words, null ones among them, are classes of their own. Rows without an id
    have no row in the result, and rows that repeat an id have one row each, linked by their own
    texts. An empty table gives an empty result. Only the two named columns are read.

    Equal sets are one representative before any band travels, so a group of copies costs
    one row. Joins on hot buckets are plain joins, which adaptive execution splits.
    """
    docs = id_and_text(documents, id_column, text_column)
    kinds = "id bigint, f1 bigint, f2 bigint, bands array<bigint>"
    marked = staged(docs.mapInArrow(_summary(bands, rows, shingle, weighted), kinds), "bands")
    # A set has a number of its own, since documents of one id may differ.
    alike = staged(
        marked.where("f1 is not null")
        .groupBy("f1", "f2")
        .agg(F.min("id").alias("least"), F.first("bands").alias("bands"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "representatives",
    )
    keys = alike.select(F.explode("bands").alias("key"), F.col("rep").alias("id"))
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    members = staged(keys.join(shared, "key", "left_semi"), "buckets")

    some = members.select("id").distinct().join(alike.select(F.col("rep").alias("id"), "least"), "id")
    wanted = staged(some.select(F.col("least").alias("w")).distinct(), "candidates")
    texts = joined_with(docs, wanted, F.expr("id = w"), "left_semi", wanted.count(), broadcast_ids)
    kinds = "f1 bigint, f2 bigint, elements binary, weights binary"
    made = texts.mapInArrow(_sets(shingle, weighted), kinds)
    numbered = made.join(alike.select("f1", "f2", F.col("rep").alias("id")), ["f1", "f2"])
    sets = staged(numbered.dropDuplicates(["f1", "f2"]).select("id", "elements", "weights"), "sets")

    hubs = members.groupBy("key").agg(F.min("id").alias("other"))
    pairs = _ordered(members.join(hubs, "key").where("id != other").select("id", "other"))
    edges = staged(_linked(pairs, sets, similarity), "links")
    classes = staged(components(edges), "classes")
    for turn in range(HUB_ROUNDS + 1):
        split = _split_members(members, classes)
        if split.isEmpty():
            break
        last = turn == HUB_ROUNDS
        pairs = _rare_pairs(split, sets, similarity) if last else _hub_pairs(split, turn)
        links = staged(_linked(pairs, sets, similarity), "links")
        # The classes so far are stars, which stand for all earlier links.
        stars = classes.select(F.col("node").alias("a"), F.col("component").alias("b"))
        classes = staged(components(stars.unionByName(links)), "classes")

    named = alike.select("f1", "f2", "rep", "least").join(
        classes.withColumnRenamed("node", "rep"), "rep", "left"
    )
    single = named.where("component is null").select("f1", "f2", F.col("least").alias("class_id"))
    several = named.where("component is not null")
    least = several.groupBy("component").agg(F.min("least").alias("class_id"))
    own = single.unionByName(several.join(least, "component").select("f1", "f2", "class_id"))
    with_class = marked.select("id", "f1", "f2").join(own, ["f1", "f2"]).select("id", "class_id")
    lone = marked.where("f1 is null").select("id")
    every = with_class.unionByName(lone.withColumn("class_id", F.col("id")))
    return every.select(
        F.col("id").alias(id_column), "class_id", (F.col("id") == F.col("class_id")).alias("kept")
    )


def _split_members(members: DataFrame, classes: DataFrame) -> DataFrame:
    """(key, id, comp) of all members of the buckets that hold more than one component."""
    named = members.join(classes, members.id == classes.node, "left").select(
        "key", "id", F.coalesce("component", "id").alias("comp")
    )
    several = named.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    several = several.where("low != high").select("key")
    return staged(named.join(several, "key", "left_semi"), "split")


def drop_near_duplicates(documents: DataFrame, id_column: str = "doc_id", broadcast_ids: int = BROADCAST_IDS, **options) -> DataFrame:
    """``documents`` with one of each class of near duplicates, the one of the least id.

    Rows without an id stay. Of rows that repeat an id, all stay if one of them is kept, so a
    repeated row is not a duplicate of itself. Other columns pass through, whatever their names.
    Null and empty texts, and an empty table, are returned as they are.
    """
    found = near_duplicates(documents, id_column, broadcast_ids=broadcast_ids, **options)
    name = free_name(documents, "gone")
    by_id = found.groupBy(F.col(f"`{id_column}`").alias(name)).agg(F.max("kept").alias("kept"))
    gone = staged(by_id.where("not kept").select(name), "gone")
    same = F.col(f"`{id_column}`").cast("bigint") == F.col(name)
    return joined_with(documents, gone, same, "left_anti", gone.count(), broadcast_ids)
