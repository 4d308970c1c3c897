"""Smart search: the nearest vectors to each query, through an inverted file of cells.

Vectors are dealt to the nearest of a number of centroids and written by cell. The triangle
inequality on angles bounds from below how near any member of a cell can be to a query, so a
query probes cells from the best bound on and stops at the first whose bound is beyond its
``k``-th hit. The result is exact; the centroids decide only how much work it takes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postmill.session import shared_dir, ship_package

SAMPLE_ROWS = 20_000  # the centroids are fitted on at most so many vectors
MAX_CELLS = 4_096
TILE = 20_000  # vectors of a cell that one task holds
QUERY_TILE = 2_000
PROBES = (4, 16)  # cells a query probes in the first rounds; the last takes all it needs
DIGITS = 9  # similarities are compared after rounding, so that equal vectors tie
_SLACK = 1e-6  # of an angle, for rounding errors
_BATCH = 4_096

STORED = "id bigint, vector array<double>, tile int, angle double, cell int"
_HITS = "query long, id long, similarity double"


@dataclass(frozen=True)
class VectorIndex:
    """A written index: ``vectors`` by cell below ``path``, and the ``centroids`` in their order."""

    spark: SparkSession
    path: str
    centroids: np.ndarray

    @property
    def vectors(self) -> DataFrame:
        return self.spark.read.schema(STORED).parquet(f"{self.path}/vectors")

    def cells(self) -> DataFrame:
        """``cell, n, tiles, least, most``: counts, and the angles to the centroid; at most one
        row for each centroid."""
        return self.vectors.groupBy("cell").agg(
            F.count("*").alias("n"),
            (F.max("tile") + 1).alias("tiles"),
            F.min("angle").alias("least"),
            F.max("angle").alias("most"),
        )


def unit_vectors(table: DataFrame, id_column: str, vector_column: str, size: int | None = None) -> DataFrame:
    """``id, vector`` of unit length in double precision, of those vectors that have a direction.

    A null or zero vector, one with a null or non-finite component, and one that has not
    ``size`` components if that is given, is left out, and so are rows without an id.
    """
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    read = table.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), vector.alias("v"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    read = read.where(F.col("id").isNotNull() & (F.size("v") > 0) & whole)
    if size is not None:
        read = read.where(F.size("v") == size)
    return read.mapInArrow(_to_unit, "id bigint, vector array<double>")


def _to_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column("v")
        sizes = column.value_lengths().to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        values = np.asarray(column.flatten())
        # The largest component first, so that no square overflows or vanishes.
        largest = np.maximum.reduceat(np.abs(values), ends[:-1])
        values = values / np.repeat(np.where(largest > 0, largest, 1), sizes)
        norm = np.sqrt(np.add.reduceat(values * values, ends[:-1]))
        values = values / np.repeat(np.where(largest > 0, norm, 1), sizes)
        vectors = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
        made = pa.RecordBatch.from_arrays([batch.column("id"), vectors], ["id", "vector"])
        yield made.filter(pa.array(largest > 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _fit(vectors: DataFrame, cells: int, sample_rows: int) -> np.ndarray:
    """Centroids of the sample: the first vectors by a hash of id and vector."""
    spark = vectors.sparkSession
    picked = vectors.withColumn("h", F.xxhash64("id", "vector")).orderBy("h").limit(sample_rows)
    path = shared_dir(spark, "index-sample")
    picked.select("vector").write.parquet(path)
    sample = spark.read.parquet(path)
    points = sample.select(array_to_vector("vector").alias("features"))
    model = KMeans(k=cells, seed=1, maxIter=10, distanceMeasure="cosine").fit(points)
    found = np.array([c for c in model.clusterCenters()], float)
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def _assign(centroids: np.ndarray):
    names = ["id", "vector", "angle", "cell"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _BATCH):
                batch = whole.slice(start, _BATCH)
                near = np.clip(_matrix(batch.column("vector")) @ centroids.T, -1, 1)
                cell = near.argmax(axis=1)
                angle = np.arccos(near[np.arange(len(near)), cell])
                columns = [*batch.columns, pa.array(angle), pa.array(cell.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def build_index(
    table: DataFrame,
    path: str | None = None,
    id_column: str = "id",
    vector_column: str = "vector",
    cells: int | None = None,
    sample_rows: int = SAMPLE_ROWS,
    tile: int = TILE,
) -> VectorIndex:
    """Write an index of all usable vectors of ``table`` to ``path`` in shared storage.

    The centroids, by default the square root of the number of vectors and at most
    ``MAX_CELLS``, come from spherical k-means over at most ``sample_rows`` vectors, the first by
    hash; every vector is indexed. Vectors have the size that most of the table's have (of
    equally frequent sizes the smallest); others are left out, as are those that
    ``unit_vectors`` leaves out. Rows may repeat ids. A cell of any size is dealt into tiles of
    about ``tile`` vectors by hash, which are tasks and files of their own.
    """
    spark = table.sparkSession
    ship_package(spark)
    path = path or shared_dir(spark, "vector-index")
    usable = unit_vectors(table, id_column, vector_column)
    sizes = usable.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    if common is None:
        usable.select("id", "vector", F.lit(0).alias("tile"), F.lit(0.0).alias("angle"), F.lit(0).alias("cell")).where(
            "false"
        ).write.parquet(f"{path}/vectors")
        return VectorIndex(spark, path, np.zeros((0, 1)))
    usable = usable.where(F.size("vector") == common.size)
    cells = min(cells or math.isqrt(common.n), MAX_CELLS, common.n)
    # One cell needs no fit, and k-means asks for two.
    centroids = _fit(usable, cells, sample_rows) if cells > 1 else np.eye(1, common.size)
    kinds = "id bigint, vector array<double>, angle double, cell int"
    dealt = usable.mapInArrow(_assign(centroids), kinds)
    staged = shared_dir(spark, "dealt")
    dealt.write.parquet(staged)
    dealt = spark.read.schema(kinds).parquet(staged)
    counts = dealt.groupBy("cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    # By row of the written table, so that rows that are equal in all are dealt as well.
    number = dealt.withColumn("tile", F.xxhash64(F.monotonically_increasing_id()))
    tiled = number.join(F.broadcast(counts), "cell")
    tiled = tiled.withColumn("tile", F.pmod("tile", F.col("tiles")).cast("int"))
    tiled = tiled.select("id", "vector", "tile", "angle", "cell").repartition("cell", "tile")
    tiled.sortWithinPartitions("cell", "tile").write.partitionBy("cell").parquet(f"{path}/vectors")
    spark.createDataFrame(list(enumerate(centroids.tolist())), "cell int, vector array<double>").write.parquet(
        f"{path}/centroids"
    )
    return VectorIndex(spark, path, centroids)


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    """An index that ``build_index`` has written."""
    rows = spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()  # MAX_CELLS at most
    return VectorIndex(spark, path, np.array([r.vector for r in rows]))


def _bounds(centroids: np.ndarray, cells: np.ndarray, least: np.ndarray, most: np.ndarray):
    """For batches of (query, vector): (query, cells and bounds from the best on)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _BATCH // 8):
                batch = whole.slice(start, _BATCH // 8)
                near = np.clip(_matrix(batch.column("vector")) @ centroids.T, -1, 1)
                angle = np.arccos(near[:, cells])
                bound = np.maximum(np.maximum(angle - most, least - angle), 0)
                order = bound.argsort(axis=1, kind="stable")
                ends = np.arange(0, order.size + 1, order.shape[1], dtype=np.int32)
                columns = [
                    batch.column("query"),
                    pa.ListArray.from_arrays(ends, pa.array(cells[order].reshape(-1).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(np.take_along_axis(bound, order, 1).reshape(-1))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["query", "cells", "bounds"])

    return run


def _shelves(cells: list, size: int) -> dict[int, int]:
    """A shelf for each cell: cells of one tile that follow each other share one, up to ``size`` vectors."""
    shelves, held, shelf = {}, 0, -1
    for row in cells:
        if row.tiles > 1 or held + row.n > size or shelf < 0:
            shelf += 1
            held = 0
        held += row.n if row.tiles == 1 else size
        shelves[row.cell] = shelf
    return shelves


def _by_shelf(shelf_of: np.ndarray):
    """For batches of (query, floor, limit, cells and bounds): the cells within the limit, by shelf."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, _BATCH // 8):
                batch = whole.slice(start, _BATCH // 8)
                cells, bounds = batch.column("cells"), batch.column("bounds")
                row = np.repeat(np.arange(len(cells)), cells.value_lengths().to_numpy())
                kept = np.asarray(bounds.flatten()) <= np.asarray(batch.column("limit"))[row]
                row, cell = row[kept], np.asarray(cells.flatten())[kept]
                if not len(row):
                    continue
                shelf = shelf_of[cell]
                order = np.lexsort((cell, shelf, row))
                row, cell, shelf = row[order], cell[order], shelf[order]
                first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (shelf[1:] != shelf[:-1])])
                ends = np.append(first, len(row)).astype(np.int32)
                columns = [
                    batch.column("query").take(pa.array(row[first])),
                    batch.column("floor").take(pa.array(row[first])),
                    pa.array(shelf[first].astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(cell.astype(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["query", "floor", "shelf", "cells"])

    return run


def _best_of_tile(k: int) -> Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The ``k`` best members of a tile for each query, of the cells that it probes there, and none
    below its ``floor``."""

    def run(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": [], "id": [], "similarity": []}).astype({"query": "int64", "id": "int64"})
        if vectors.empty or queries.empty:
            return empty
        order = np.argsort(vectors["cell"].to_numpy(), kind="stable")
        ids, held = vectors["id"].to_numpy()[order], vectors["cell"].to_numpy()[order]
        members = np.stack(vectors["vector"].to_numpy())[order]
        by_id = np.argsort(ids, kind="stable")
        risen = ids[by_id]
        cells, starts = np.unique(held, return_index=True)
        ends = np.append(starts[1:], len(held))
        asked, numbers = np.stack(queries["vector"].to_numpy()), queries["query"].to_numpy()
        floors = queries["floor"].to_numpy(float)
        floors = np.where(np.isnan(floors), -np.inf, floors)
        own = queries["own"].to_list()
        wanted = queries["cells"].to_list()
        parts = []
        step = max(1, (4 << 20) // len(ids))  # similarities held at once
        edge = 10.0**-DIGITS  # rounding moves a similarity by less
        for start in range(0, len(asked), step):
            mine = slice(start, start + step)
            probed = np.stack([np.isin(cells, c) for c in wanted[mine]])
            if probed.all():
                near = asked[mine] @ members.T
            else:
                near = np.full((len(probed), len(ids)), -np.inf)
                for place in np.flatnonzero(probed.any(axis=0)):
                    some = np.flatnonzero(probed[:, place])
                    own_cell = slice(starts[place], ends[place])
                    near[some, own_cell] = asked[mine][some] @ members[own_cell].T
            for row, name in enumerate(own[mine]):
                if name is not None and not pd.isna(name):
                    low, high = np.searchsorted(risen, name, "left"), np.searchsorted(risen, name, "right")
                    near[row, by_id[low:high]] = -np.inf
            least = floors[mine].copy()
            # A query without a floor, or with many members above it, takes the k-th best of this tile.
            many = np.flatnonzero((near >= (least - edge)[:, None]).sum(axis=1) > 4 * k)
            if len(many) and near.shape[1] > k:
                kth = -np.partition(-near[many], k - 1, axis=1)[:, k - 1]
                least[many] = np.maximum(least[many], kth)
            above = near >= np.where(np.isfinite(least), least - edge, -2.0)[:, None]
            row, column = np.nonzero(above)
            similarity, found = np.round(near[row, column], DIGITS), ids[column]
            # By similarity, and of two that tie the smaller id.
            order = np.lexsort((found, -similarity, row))
            row = row[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row, "left")
            best = order[rank < k]
            parts.append((numbers[mine][row[rank < k]], found[best], similarity[best]))
        query, found, similarity = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pd.DataFrame({"query": query, "id": found, "similarity": similarity})

    return run


def _first(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best hits of each query. Tasks cut their own to ``k`` before the exchange."""
    best = Window.partitionBy("query").orderBy(F.desc("similarity"), "id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = shared_dir(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def semantic_search(
    index: VectorIndex,
    queries: DataFrame,
    k: int,
    id_column: str = "id",
    vector_column: str = "vector",
    exclude_same_id: bool = False,
    max_probes: int | None = None,
    probes: tuple[int, ...] = PROBES,
    query_tile: int = QUERY_TILE,
) -> DataFrame:
    """``query_id, rank, id, similarity``: the ``k`` nearest vectors to each query by cosine.

    Similarities are rounded to ``DIGITS`` digits, and of equal ones the smaller id comes first.
    ``exclude_same_id`` leaves out vectors with the query's own id. Queries that repeat an id
    have ``k`` rows each; queries without a usable vector of the index's size, and all queries
    to an empty index, have none; a query has fewer rows if there are fewer vectors.

    The result is exact unless ``max_probes`` bounds how many cells a query probes. In rounds,
    each query that is not done probes its next cells by bound; it is done when the next
    bound is beyond its ``k``-th hit. Between rounds only hits and probes are kept, ``k`` rows and
    the open cells of a query.

    Small cells share a shelf of ``TILE`` vectors at most. A shelf meets its queries in blocks, a tile of
    vectors with ``query_tile`` queries at most, so neither a large cell nor one that all queries
    probe is one task, and a query goes once to a shelf, with the list of its cells there. What is
    broadcast are centroids and cell statistics, at most ``MAX_CELLS`` rows.
    """
    spark = index.spark
    ship_package(spark)
    result = "query_id bigint, rank int, id bigint, similarity double"
    cells = sorted(index.cells().collect(), key=lambda r: r.cell)  # MAX_CELLS at most
    if not cells:
        return spark.createDataFrame([], result)
    size = index.centroids.shape[1]
    asked = unit_vectors(queries, id_column, vector_column, size)
    asked = asked.withColumnRenamed("id", "query_id")
    # Written before it is used again, so that the number of a row stays the same.
    asked = _written(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    numbers = np.array([r.cell for r in cells])
    least, most = (np.array([getattr(r, x) for r in cells]) for x in ("least", "most"))
    order = asked.select("query", "vector").mapInArrow(
        _bounds(index.centroids, numbers, least, most),
        "query bigint, cells array<int>, bounds array<double>",
    )
    if max_probes is not None:
        order = order.select("query", *(F.slice(c, 1, max_probes).alias(c) for c in ("cells", "bounds")))
    order = _written(order, "probe-orders")
    shelves = _shelves(cells, TILE)
    shelf_of = np.full(numbers.max() + 1, -1)
    shelf_of[list(shelves)] = list(shelves.values())
    tiles = spark.createDataFrame(list({shelves[r.cell]: r.tiles for r in cells}.items()), "shelf int, tiles int")
    places = spark.createDataFrame(list(shelves.items()), "cell int, shelf int")
    vectors = index.vectors.join(F.broadcast(places), "cell")
    hits = spark.createDataFrame([], _HITS)
    done = 0
    for count in (*probes, None):
        worst = hits.groupBy("query").agg(
            F.when(F.count("*") >= k, F.min("similarity")).alias("worst")
        )
        near = F.greatest(F.least(F.col("worst") - 10.0**-DIGITS, F.lit(1.0)), F.lit(-1.0))
        limit = F.when(F.col("worst").isNotNull(), F.acos(near) + _SLACK).otherwise(F.lit(4.0))
        open_ = order.join(worst, "query", "left").withColumn("limit", limit)
        left = [F.slice(c, done + 1, count or len(cells)).alias(c) for c in ("cells", "bounds")]
        probed = open_.select("query", F.col("worst").alias("floor"), "limit", *left).mapInArrow(
            _by_shelf(shelf_of), "query bigint, floor double, shelf int, cells array<int>"
        )
        probed = _written(probed, "probes")
        busy = probed.groupBy("shelf").agg(F.ceil(F.count("*") / query_tile).cast("int").alias("parts"))
        busy = busy.join(F.broadcast(tiles), "shelf").collect()  # MAX_CELLS at most
        if not busy:
            if count is None or not _more(order, hits, done + count):
                break
            done += count
            continue
        blocks = spark.createDataFrame([tuple(r) for r in busy], "shelf int, parts int, tiles int")
        part = F.pmod(F.xxhash64("query"), F.col("parts")).cast("int")
        mine = probed.join(F.broadcast(blocks), "shelf").withColumn("part", part)
        mine = mine.withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        own = F.col("query_id") if exclude_same_id else F.lit(None).cast("bigint")
        mine = mine.join(asked.select("query", "vector", own.alias("own")), "query")
        theirs = vectors.join(F.broadcast(blocks.drop("tiles")), "shelf").withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        )
        keys = ("shelf", "tile", "part")
        met = (
            theirs.select(*keys, "cell", "id", "vector")
            .groupBy(*keys)
            .cogroup(mine.select(*keys, "query", "own", "floor", "cells", "vector").groupBy(*keys))
            .applyInPandas(_best_of_tile(k), _HITS)
        )
        hits = _written(_first(hits.unionByName(met), k).drop("rank"), "hits")
        if count is None:
            break
        done += count
    found = _first(hits, k).join(asked.select("query", "query_id"), "query")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "similarity")


def _more(order: DataFrame, hits: DataFrame, done: int) -> bool:
    """Whether there are cells left after the first ``done``."""
    return not order.where(F.size("cells") > done).isEmpty()


def embed_texts(
    table: DataFrame, make_encoder: Callable[[], Callable[[list[str]], list[list[float]]]], text: str | Column = "text"
) -> DataFrame:
    """Add ``vector``: what a user's encoder makes of the texts, in batches.

    An encoder is made once for each task and partition; it gets a list of texts (null is empty) and
    returns as many vectors.
    """
    ship_package(table.sparkSession)

    @F.pandas_udf("array<double>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make_encoder()
        for texts in batches:
            found = [None if v is None else [float(x) for x in v] for v in encoder(texts.fillna("").tolist())]
            if len(found) != len(texts):
                raise ValueError(f"{len(found)} vectors for {len(texts)} texts")
            yield pd.Series(found)

    column = F.col(text) if isinstance(text, str) else text
    return table.withColumn("vector", encode(column))
