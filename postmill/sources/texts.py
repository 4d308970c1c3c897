"""Ad-hoc text input and the sample mailbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.fixed_values import SAMPLE_BODY, SAMPLE_LIMIT
from postmill.functions.pytext import WS, strip


def read_text_bodies(spark: SparkSession, path: str) -> DataFrame:
    """Each file as one body, with its path."""
    return (
        spark.read.text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))
    )


def nonblank_bodies(table: DataFrame, body: str = "body") -> DataFrame:
    """Trim the bodies and drop rows with nothing left."""
    return table.where(F.col(body).rlike(f"[^{WS}]")).withColumn(body, strip(F.col(body)))


def sample_messages(
    spark: SparkSession, limit: int = SAMPLE_LIMIT, as_of: Column | None = None
) -> DataFrame:
    """Sample messages in the shape a mailbox provider returns."""
    number = F.col("id")
    return spark.range(limit).select(
        F.concat(F.lit("stub-"), number.cast("string")).alias("id"),
        F.concat(F.lit("Sample message "), (number + 1).cast("string")).alias("subject"),
        F.lit(SAMPLE_BODY).alias("body"),
        (F.current_timestamp() if as_of is None else as_of).alias("received_at"),
    )
