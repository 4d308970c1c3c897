"""Filter interaction audit: what each filter removes, in every order of the filters.

Every document falls into one of 2^k cells, by which of ``k`` filters it fails. Per part of
the corpus, a walk in Gray code goes through all subsets of filters and turns one filter on
or off at a time: each cell keeps a counter of the active filters that it fails, and the
survivors change by the cells whose counter leaves or reaches zero. The states so stored, one
for each subset, give every step of every order by a difference.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.staging import prepare, staged

MAX_FILTERS = 7  # 7! orders are 35,280 rows for each part
_MEASURES = ("rows", "good", "toxic")
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_ROWS = 60_000  # of a result batch


def words(text: Column) -> Column:
    """The words of a text, in order: runs of anything but blanks and line breaks of ASCII."""
    return F.array_remove(F.split(text, r"[ \t-\r]+"), "")


def _size(array: Column) -> Column:
    return F.size(array).cast("bigint")


#: Failure conditions over ``text``, ``words`` (its array) and ``n_words``.
TEXT_FILTERS: dict[str, Callable[[], Column]] = {
    "A": lambda: F.col("n_words") < 200,
    "B": lambda: 100 * _size(F.array_distinct("words")) < 50 * F.col("n_words"),
    "C": lambda: 100 * F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("bigint")
    > 2 * F.length("text"),
    "D": lambda: F.col("text").rlike("[#$%&*|]"),
}
REPEATED = "E"


def failure_masks(
    documents: DataFrame,
    filters: Mapping[str, Callable[[], Column]] = TEXT_FILTERS,
    repeated: bool = True,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "source",
) -> DataFrame:
    """(id, part, mask, n): rows by id and the filters that they fail, bit i for the i-th.

    With ``repeated``, one bit more is set where a smaller id has the same text, in any part.
    A null text is empty and so equals other empty texts, a null part is the empty string. A
    null id is neither smaller nor larger than another, so its row repeats nothing. Rows that
    repeat id and text are equal in all bits. Only the three named columns are read.

    Texts are read once and never travel: their SHA-256 does. A group of copies is one row
    for each task in the search for its least id, and whether a row has that id is a join by
    id and hash, so that a group of any size is dealt over all tasks.
    """
    prepare(documents.sparkSession)
    read = documents.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{part_column}`").cast("string"), F.lit("")).alias("part"),
    )
    split = read.withColumn("words", words(F.col("text")))
    counted = split.withColumn("n_words", _size(F.col("words")))
    mask = F.lit(0)
    for i, fails in enumerate(filters.values()):
        mask = mask + F.when(fails(), F.lit(1 << i)).otherwise(F.lit(0))
    columns = ["id", "part", mask.cast("int").alias("mask")]
    if not repeated:
        found = counted.select(*columns)
        return found.groupBy("id", "part", "mask").agg(F.count("*").alias("n"))
    print_ = F.unhex(F.sha2("text", 256)).alias("print")
    marked = staged(counted.select(*columns, print_), "filter-masks")
    rows = marked.groupBy("id", "print", "part", "mask").agg(F.count("*").alias("n"))
    known = rows.where("id is not null")
    first = (
        marked.where("id is not null")
        .groupBy("print")
        .agg(F.min("id").alias("id"))
        .withColumn("first", F.lit(True))
    )
    bit = F.when(F.col("first").isNull(), F.lit(1 << len(filters))).otherwise(F.lit(0))
    known = known.join(first, ["id", "print"], "left").withColumn("mask", F.col("mask") + bit)
    nameless = marked.where("id is null").groupBy("id", "part", "mask").agg(F.count("*").alias("n"))
    return known.select("id", "part", "mask", "n").unionByName(nameless)


def failure_cells(masks: DataFrame, labels: DataFrame, label_id: str = "doc_id") -> DataFrame:
    """(part, mask, rows, good, toxic): counts of ``failure_masks`` rows by cell.

    ``labels`` has ``quality`` and ``toxic``; a document is good (toxic) if any of its labels
    says 1. Labels that repeat, have no id or no value count nothing twice.
    """
    says = [
        F.max(F.coalesce(F.col(name) == 1, F.lit(False)).cast("int")).alias(alias)
        for name, alias in (("quality", "good"), ("toxic", "toxic"))
    ]
    named = labels.where(F.col(label_id).isNotNull())
    by_id = named.groupBy(F.col(label_id).cast("bigint").alias("id")).agg(*says)
    known = masks.where("id is not null").join(by_id, "id", "left")
    nameless = masks.where("id is null").select("*", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    shares = [
        F.sum(F.col("n") * F.coalesce(F.col(name), F.lit(0))).alias(name) for name in ("good", "toxic")
    ]
    return (
        known.unionByName(nameless).groupBy("part", "mask").agg(F.sum("n").alias("rows"), *shares)
    )


def subset_states(cells: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters: the last axis but one goes from masks to subsets.

    ``cells`` are counts (parts, 2^k masks, measures). Subsets are visited in Gray code, so
    each turn adds or takes away the cells of one filter only.
    """
    masks = np.arange(cells.shape[1])
    active = np.zeros(len(masks), np.int64)  # of each cell, the active filters it fails
    alive = cells.sum(axis=1)
    states = np.empty_like(cells)
    states[:, 0] = alive
    subset = 0
    for turn in range(1, len(masks)):
        bit = turn & -turn
        subset ^= bit
        failing = masks[(masks & bit) > 0]
        if subset & bit:
            alive = alive - cells[:, failing[active[failing] == 0]].sum(axis=1)
            active[failing] += 1
        else:
            active[failing] -= 1
            alive = alive + cells[:, failing[active[failing] == 0]].sum(axis=1)
        states[:, subset] = alive
    return states


def order_steps(states: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Counts (parts, orders, steps, columns of ``_COUNTS``) by differences of the states.

    ``orders`` lists filter numbers in the order they are applied.
    """
    bits = 1 << orders
    after = np.bitwise_or.accumulate(bits, axis=1)
    before = after ^ bits
    kept = states[:, after]
    lost = states[:, before] - kept
    removed = lost[..., 0]
    everything = states.shape[1] - 1
    single = np.arange(orders.shape[1])
    failing = states[:, [0], 0] - states[:, 1 << single, 0]
    unique = states[:, everything ^ (1 << single), 0] - states[:, [everything], 0]
    total = np.stack([np.where(orders == f, removed, 0).sum(axis=(1, 2)) for f in single], axis=1)
    return np.stack(
        [
            kept[..., 0],
            removed,
            failing[:, orders] - removed,
            unique[:, orders],
            lost[..., 1],
            lost[..., 2],
            total[:, orders],
        ],
        axis=-1,
    )


def _audit_parts(names: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    cells = 1 << len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = np.array(list(permutations(range(len(names)))), np.int64)
        listed = ["".join(names[f] for f in order) for order in orders]
        per_part = orders.size
        steps = np.tile(np.arange(1, len(names) + 1, dtype=np.int32), len(orders))
        many = max(1, _ROWS // per_part)
        for batch in batches:
            for start in range(0, batch.num_rows, many):
                some = batch.slice(start, many)
                parts = some.column(0).to_pylist()
                counts = np.zeros((len(parts), cells, len(_MEASURES)), np.int64)
                for i, found in enumerate(some.column(1).to_pylist()):
                    for cell in found:
                        counts[i, cell["mask"]] = [cell[m] for m in _MEASURES]
                result = order_steps(subset_states(counts), orders).reshape(-1, len(_COUNTS))
                columns = [
                    pa.array([p for p in parts for _ in range(per_part)], pa.string()),
                    pa.array([o for o in listed for _ in names] * len(parts), pa.string()),
                    pa.array(np.tile(steps, len(parts))),
                    *(pa.array(result[:, c].copy()) for c in range(len(_COUNTS))),
                ]
                head = ["part", "filter_order", "step"]
                yield pa.RecordBatch.from_arrays(columns, [*head, *_COUNTS])

    return run


def audit_cells(cells: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """One row for each part, order of the filters and step, from counts by cell.

    ``cells`` has ``part``, ``mask``, ``rows``, ``good`` and ``toxic``, each mask once for a
    part; ``names`` are the filters' names by bit. Columns: ``part``, ``filter_order`` (the
    names joined), ``step`` from 1, and for the step's filter within the part: ``kept`` (rows
    after the step), ``removed``, ``redundant`` (fail it, but were removed earlier),
    ``unique_fails`` (fail it and no other), ``good_lost`` and ``toxic_lost`` (of the removed),
    ``shapley`` (its removed, summed over all orders). Parts without rows do not occur, so an
    empty table has an empty result.

    One row of at most 2^k cells for each part goes to Python; parts are dealt over tasks.
    """
    if not 1 <= len(names) <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters, not {len(names)}")
    prepare(cells.sparkSession)
    listed = F.collect_list(F.struct("mask", *_MEASURES)).alias("cells")
    kinds = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in _COUNTS)
    return cells.groupBy("part").agg(listed).mapInArrow(_audit_parts(names), kinds)


def audit_filters(
    documents: DataFrame,
    labels: DataFrame,
    filters: Mapping[str, Callable[[], Column]] = TEXT_FILTERS,
    repeated: str | None = REPEATED,
    id_column: str = "doc_id",
    text_column: str = "text",
    part_column: str = "source",
) -> DataFrame:
    """The audit of ``audit_cells`` over whole texts; see ``failure_masks`` and
    ``failure_cells`` for what nulls and repeated rows do. ``repeated`` names the filter that
    removes texts which a smaller id has, or is None to leave that out."""
    masks = failure_masks(documents, filters, repeated is not None, id_column, text_column, part_column)
    names = (*filters, repeated) if repeated else tuple(filters)
    return audit_cells(failure_cells(masks, labels, id_column), names)
