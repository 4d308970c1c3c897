"""Incremental runs of the cleaner over mails that keep arriving.

The cleaner keeps no state, so a micro-batch is cleaned like a table. Each micro-batch
overwrites the folder of its own number: one that is run again after a failure leaves
its rows once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from postmill.operators.cleaning import accepted, clean_emails, clean_records, quarantined
from postmill.schemas import RAW_MAIL
from postmill.session import shared_dir
from postmill.sources.maildir import is_mail_name
from postmill.sources.mime import parse_mails


def _start(stream: DataFrame, write, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _save(table: DataFrame, output: str, number: int) -> None:
    target = f"{output}/batch={number}"
    table.write.mode("overwrite").option("ignoreNullFields", "false").json(target)


def stream_raw_mails(spark: SparkSession, folder: str, max_files: int = 100_000) -> DataFrame:
    """New mail files as a stream. Names hidden from Spark's file sources are not seen."""
    stream = (
        spark.readStream.format("binaryFile")
        .schema(RAW_MAIL)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
    )
    return stream.where(is_mail_name(stream["path"]))


def start_mail_stream(
    raw: DataFrame, output: str, checkpoint: str, **trigger: str | bool
) -> StreamingQuery:
    """Clean mails into ``output/clean``, failures into ``output/quarantine``.

    ``raw`` are raw mails, or parsed ones as ``stream_mail_files`` gives them.
    """

    def write(batch: DataFrame, number: int) -> None:
        # Both outputs read the cleaned records, which are written once to the shared folder.
        made = clean_records(parse_mails(batch) if "content" in batch.columns else batch)
        staged = shared_dir(batch.sparkSession, "stream-records")
        made.write.parquet(staged)
        records = batch.sparkSession.read.schema(made.schema).parquet(staged)
        _save(accepted(records), f"{output}/clean", number)
        _save(quarantined(records), f"{output}/quarantine", number)

    return _start(raw, write, checkpoint, trigger)


def start_email_stream(
    emails: DataFrame, key: str, output: str, checkpoint: str, **trigger: str | bool
) -> StreamingQuery:
    """Clean mails that come as rows with ``subject`` and ``body`` into ``output``."""

    def write(batch: DataFrame, number: int) -> None:
        _save(clean_emails(batch), output, number)

    return _start(emails, write, checkpoint, trigger)
