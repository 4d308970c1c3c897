"""The mail cleaner as DataFrame steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.fixed_values import BODY_LIMIT, CORPUS_NAME
from postmill.functions.cleaning import (
    extract_urls,
    normalize_whitespace,
    truncate_thread,
    visible_text,
    with_subject,
)
from postmill.schemas import CLEAN_EMAIL
from postmill.sources.mime import body_text


def _free_names(table: DataFrame, *names: str) -> list[str]:
    """The names, made longer where the table has them."""
    taken = {column.lower() for column in table.columns}
    found = []
    for name in names:
        while name in taken:
            name += "_"
        found.append(name)
    return found


def clean_emails(
    mails: DataFrame,
    *,
    subject: str | Column = "subject",
    body: str | Column = "body",
    limit: int = BODY_LIMIT,
) -> DataFrame:
    """Add ``clean_text`` and ``urls``; all work is row-local, nothing is shuffled.

    Links are taken from the text without quotes and signature but before it is cut
    to ``limit`` characters, and the subject line is not counted in them.
    """
    subject = F.col(subject) if isinstance(subject, str) else subject
    body = F.col(body) if isinstance(body, str) else body
    # Texts that are used more than once are columns of their own, or Spark would run
    # the regular expressions behind them once per use.
    visible, flat = _free_names(mails, "visible_text", "flat_text")
    staged = mails.withColumn(visible, visible_text(body)).withColumns(
        {
            flat: normalize_whitespace(F.col(visible)),
            "urls": extract_urls(F.col(visible)),
        }
    )
    text = with_subject(subject, truncate_thread(F.col(flat), limit))
    return staged.withColumn("clean_text", text).drop(visible, flat)


def clean_records(
    parsed: DataFrame, source: str = CORPUS_NAME, limit: int = BODY_LIMIT
) -> DataFrame:
    """Clean-mail records of all parsed mails, with ``error`` for those that failed."""
    bodies = parsed.select(
        F.lit(source).alias("source"),
        "path",
        F.coalesce("subject", F.lit("")).alias("subject"),
        body_text(F.col("body_kind"), F.col("body")).alias("body"),
        "error",
    )
    return clean_emails(bodies, limit=limit).select(*CLEAN_EMAIL.names, "error")


def accepted(records: DataFrame) -> DataFrame:
    """The records of the mails that did not fail."""
    return records.where(F.col("error").isNull()).drop("error")


def quarantined(records: DataFrame) -> DataFrame:
    """Path and reason of the mails that failed."""
    return records.where(F.col("error").isNotNull()).select("path", "error")
