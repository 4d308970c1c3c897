"""Embedding near-duplicates: an exact metric range join over unit vectors.

On unit vectors, a cosine of at least c is a distance of at most sqrt(2 - 2c). Pivots part
the vectors into cells, each vector at home with its nearest pivot. A vector is also copied
into every other cell that may hold a vector within the range. The bound is the triangle
inequality's, in its sharper form for Euclidean space: the distance to the plane between two
pivots. Then every cell is joined by itself, at home against all members, in tiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.components import components
from postmill.llm.staging import prepare, staged

COSINE = 0.95
CELL = 4096  # vectors that a cell is meant to have at home: one block of homes
MAX_PIVOTS = 1024
MEMBERS = 8192  # of a cell, members in one tile
HOMES = 4096  # and homes
_ROWS = 256
_SLACK = 1e-9


def unit_vectors(data: list[bytes]) -> np.ndarray:
    """Vectors of 64-bit floats, scaled to length 1; scaled by the largest first, so that
    no square overflows or vanishes."""
    rows = np.stack([np.frombuffer(x, np.float64) for x in data])
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, vector) to (id, size, vector as bytes); null for vectors that link with nothing."""
    for batch in batches:
        packed, sizes = [], []
        for row in batch.column(1):
            values = row.values.to_numpy(zero_copy_only=False).astype(np.float64) if row.is_valid else None
            usable = values is not None and len(values) and np.isfinite(values).all() and values.any()
            packed.append((values + 0.0).tobytes() if usable else None)
            sizes.append(len(values) if usable else 0)
        columns = [batch.column(0), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "size", "vector"])


def _cells(pivots: dict[int, np.ndarray], reach: float):
    """(cell, home, id, n, vector): each vector's home cell, and those it is copied to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array(batch.column(1).to_pylist())
            data = batch.column(3).to_pylist()
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                own = pivots[int(size)]
                between = np.sqrt(np.maximum(2 - 2 * own @ own.T, 0))
                for a in range(0, len(rows), 2048):
                    part = rows[a : a + 2048]
                    near = unit_vectors([data[i] for i in part]) @ own.T
                    home = near.argmax(axis=1)
                    best = near[np.arange(len(part)), home]
                    # (d_j^2 - d_home^2) / (2 d(j, home)): how far the plane between them is.
                    gap = (best[:, None] - near) <= (reach + _SLACK) * between[home]
                    gap |= near >= best[:, None] - _SLACK
                    gap[np.arange(len(part)), home] = True
                    who, cell = np.nonzero(gap)
                    take = pa.array(part[who])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array((cell + (int(size) << 32)).astype(np.int64)),
                            pa.array(cell == home[who]),
                            batch.column(0).take(take),
                            batch.column(2).take(take),
                            batch.column(3).take(take),
                        ],
                        ["cell", "home", "id", "n", "vector"],
                    )

    return run


def _joined(cosine: float):
    """One tile: links of its homes, and a star for each connected group of its vectors."""

    def run(tile: pa.Table) -> pa.Table:
        home = tile.column("side").to_numpy() == 0
        ids = tile.column("id").to_numpy()
        weight = tile.column("n").to_numpy()
        vectors = unit_vectors(tile.column("vector").to_pylist())
        left, right = np.flatnonzero(home), np.flatnonzero(~home)
        every, name = np.unique(ids, return_inverse=True)
        group = np.arange(len(every))
        links = np.zeros(len(left), np.int64)
        for a in range(0, len(left), _ROWS):
            mine = left[a : a + _ROWS]
            close = vectors[mine] @ vectors[right].T >= cosine
            close &= ids[mine][:, None] != ids[right]
            links[a : a + _ROWS] = close @ weight[right]
            x, y = np.nonzero(close)
            x, y = name[mine[x]], name[right[y]]
            while True:  # join the groups of linked vectors, by their least names
                p, q = group[x], group[y]
                apart = p != q
                if not apart.any():
                    break
                low, high = np.minimum(p, q)[apart], np.maximum(p, q)[apart]
                np.minimum.at(group, high, low)
                while (group[group] != group).any():
                    group = group[group]
        star = np.flatnonzero(group != np.arange(len(group)))
        return pa.table(
            {
                "id": pa.array(np.concatenate([ids[left], every[star]])),
                "links": pa.array(np.concatenate([links, np.full(len(star), -1)])),
                "to": pa.array(np.concatenate([ids[left], every[group[star]]])),
            }
        )

    return run


def link_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    cosine: float = COSINE,
    cell: int = CELL,
    max_pivots: int = MAX_PIVOTS,
) -> DataFrame:
    """(id, n_links, component_id, kept): one row for each vector.

    Vectors are linked when their cosine, in double precision, is ``cosine`` (above 0) or
    more. ``n_links`` counts the other rows linked directly, ``component_id`` is the least
    id that links reach, and ``kept`` whether that is the vector's own.

    A vector that is null, empty, zero, or has a null or non-finite component links with
    nothing; vectors of different lengths do not either. Rows without an id are left out.
    Rows that repeat an id are one vector each, in one result row each. An empty table gives
    an empty result. Only the two named columns are read.

    The result is exact, whatever the pivots are: these, ``max_pivots`` at most for each
    length of vectors, one for every ``cell`` vectors, are the first ones by their hash.
    Equal vectors are one before they are joined. A tile has a bounded number of homes and
    members and gives back a count for each home and one edge for each vector at most, so a
    large group of near copies gives many tiles and few rows.
    """
    prepare(vectors.sparkSession)
    two = vectors.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{vector_column}`").alias("v")
    ).where("id is not null")
    packed = staged(two.mapInArrow(_packed, "id bigint, size int, vector binary"), "vectors")
    # A distinct vector has a number of its own, since vectors of one id may differ.
    alike = staged(
        packed.where("vector is not null")
        .groupBy("size", "vector")
        .agg(F.min("id").alias("least"), F.count("*").alias("n"))
        .select(F.monotonically_increasing_id().alias("id"), "least", "size", "n", "vector"),
        "distinct-vectors",
    )
    pivots = {}
    for size, count in alike.groupBy("size").count().collect():  # a row for each length
        wanted = min(max_pivots, -(-count // cell))
        first = alike.where(F.col("size") == size).orderBy(F.xxhash64("vector"), "vector").limit(wanted)
        pivots[size] = unit_vectors([r.vector for r in first.select("vector").collect()])
    reach = float(np.sqrt(2 - 2 * cosine))
    kinds = "cell bigint, home boolean, id bigint, n bigint, vector binary"
    placed = staged(alike.drop("least").mapInArrow(_cells(pivots, reach), kinds), "cells")

    # Homes and members of a cell, each in blocks; a tile is a block of either.
    sizes = placed.groupBy("cell").agg(
        F.ceil(F.count("*") / MEMBERS).cast("int").alias("across"),
        F.ceil(F.count_if("home") / HOMES).cast("bigint").alias("down"),
    )
    sized = placed.join(sizes, "cell").where("down > 0")
    deal = F.xxhash64("id")
    as_home = sized.where("home").select(
        "cell", F.pmod(deal, "down").alias("row"), F.explode(F.sequence(F.lit(0), F.col("across") - 1)).alias("column"),
        F.lit(0).alias("side"), "id", "n", "vector",
    )
    as_member = sized.select(
        "cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("down") - 1)).alias("row"),
        F.pmod(deal, "across").cast("int").alias("column"), F.lit(1).alias("side"), "id", "n", "vector",
    )
    tiles = as_home.unionByName(as_member).groupBy("cell", "row", "column")
    met = staged(tiles.applyInArrow(_joined(cosine), "id bigint, links bigint, to bigint"), "met")

    links = met.where("links >= 0").groupBy("id").agg(F.sum("links").alias("links"))
    edges = met.where("links < 0").select(F.col("id").alias("a"), F.col("to").alias("b")).distinct()
    classes = components(edges)
    counted = alike.join(links, "id", "left").select(
        "id", "least", "size", "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    named = counted.join(classes.withColumnRenamed("node", "id"), "id", "left")
    single = named.where("component is null").select(
        "size", "vector", "n_links", F.col("least").alias("component_id")
    )
    several = named.where("component is not null")
    least = several.groupBy("component").agg(F.min("least").alias("component_id"))
    known = single.unionByName(
        several.join(least, "component").select("size", "vector", "n_links", "component_id")
    )
    linked = packed.where("vector is not null").join(known, ["size", "vector"])
    alone = packed.where("vector is null").select(
        "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id")
    )
    every = linked.select("id", "n_links", "component_id").unionByName(alone)
    return every.select(
        F.col("id").alias(id_column),
        "n_links",
        "component_id",
        (F.col("id") == F.col("component_id")).alias("kept"),
    )
