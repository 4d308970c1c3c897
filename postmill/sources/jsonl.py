"""JSON Lines tables: clean mails and chat examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postmill.schemas import CHAT_EXAMPLE, CLEAN_EMAIL
from postmill.sources.committed import committed_paths, write_json_lines

CORRUPT = "_corrupt_record"


def _read(spark: SparkSession, path: str, schema: StructType, strict: bool) -> DataFrame:
    paths = committed_paths(spark, path)
    if not paths:
        kinds = schema if strict else StructType([*schema.fields]).add(CORRUPT, "string")
        return spark.createDataFrame([], kinds)
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)
    return (
        spark.read.schema(StructType([*schema.fields]).add(CORRUPT, "string"))
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(paths)
    )


def write_clean_emails(table: DataFrame, path: str) -> int:
    """Overwrite ``path`` with clean mails; returns how many.

    The old output is there until the new one is complete (``committed``).
    """
    return write_json_lines(table.select(*CLEAN_EMAIL.names), path)


def read_clean_emails(spark: SparkSession, path: str, *, strict: bool = True) -> DataFrame:
    """Clean mails. Blank lines are skipped; line separators inside strings survive.

    ``strict`` stops at a line that is no record, or that has no ``clean_text``. Otherwise
    such a line becomes a row with its text in ``_corrupt_record``, or with null.
    """
    table = _read(spark, path, CLEAN_EMAIL, strict)
    if strict:
        missing = F.raise_error(F.lit("a record without clean_text")).cast("string")
        table = table.withColumn("clean_text", F.coalesce("clean_text", missing))
    return table


def write_chat_examples(table: DataFrame, path: str) -> int:
    """Overwrite ``path`` with chat examples; returns how many were kept, as the tasks report it."""
    return write_json_lines(table.select(*CHAT_EXAMPLE.names), path)


def read_chat_examples(spark: SparkSession, path: str, *, strict: bool = True) -> DataFrame:
    return _read(spark, path, CHAT_EXAMPLE, strict)
