"""Tables that are read more than once, written to the shared folder; and small helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.session import shared_dir, ship_package


#: What a batch of rows for Python may have, so that a worker's memory stays bounded.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20),
}


def prepare(spark: SparkSession) -> None:
    """Make the package importable in workers, and bound the batches that they get."""
    ship_package(spark)
    for key, value in BATCH.items():
        spark.conf.set(key, value)


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Write ``frame`` to the shared folder and read it back: a cut of the lineage that
    outlives executors."""
    spark = frame.sparkSession
    path = shared_dir(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def free_name(frame: DataFrame, name: str) -> str:
    """A column name that ``frame`` has not, in any case."""
    taken = {column.lower() for column in frame.columns}
    name = f"pm_{name}"
    while name in taken:
        name += "_"
    return name


def id_and_text(frame: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Rows with an id, as (id, text) only, so that no other column can clash; null is ''."""
    prepare(frame.sparkSession)
    return frame.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    ).where("id is not null")


def joined_with(
    frame: DataFrame, small: DataFrame, condition, how: str, rows: int, bound: int
) -> DataFrame:
    """A join that broadcasts ``small`` only if its counted ``rows`` are within ``bound``."""
    return frame.join(F.broadcast(small) if rows <= bound else small, condition, how)
