"""The jobs from mail files to training text, each ending in a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.fixed_values import BODY_LIMIT, CHAT_TEACHER_BUDGET, CORPUS_NAME
from postmill.functions.chat import CHATML, ChatTemplate, render_chat
from postmill.functions.cleaning import hard_cut
from postmill.functions.prompts import chat_teacher_messages, summary_messages
from postmill.operators.cleaning import accepted, clean_records, quarantined
from postmill.operators.inference import Teacher, chat_requests
from postmill.operators.labelling import (
    LENIENT_TEACHER,
    STRICT_TEACHER,
    chat_examples,
    label_requests,
)
from postmill.operators.shaping import cap_items
from postmill.session import shared_dir
from postmill.sources.jsonl import read_clean_emails, write_chat_examples, write_clean_emails
from postmill.sources.mail_source import read_mail_files


def clean_corpus(
    spark: SparkSession, mail_root: str, output: str, *, source: str = CORPUS_NAME, limit: int = BODY_LIMIT
) -> DataFrame:
    """Mail folder, or an address such as ``s3://bucket/mail``, to clean-mail JSON Lines; returns the
    failures, path and reason.

    The records are written once to the shared folder, already cleaned and cut to
    length: output and failures are both read from there, no mail is opened twice, and
    whole bodies are never stored. ``limit`` is the length that a cleaned body is cut to.
    """
    staged = shared_dir(spark, "records")
    clean_records(read_mail_files(spark, mail_root), source, limit).write.parquet(staged)
    records = spark.read.parquet(staged)
    write_clean_emails(accepted(records), output)
    return quarantined(records)


def strict_requests(clean: DataFrame) -> DataFrame:
    messages = summary_messages(F.col("subject"), F.col("clean_text"))
    return chat_requests(clean.withColumn("messages", messages), "path")


def lenient_requests(clean: DataFrame) -> DataFrame:
    messages = chat_teacher_messages(F.col("subject"), hard_cut(F.col("clean_text")))
    return chat_requests(
        clean.withColumn("messages", messages), "path", max_new_tokens=CHAT_TEACHER_BUDGET
    )


def label_corpus(
    spark: SparkSession,
    clean_path: str,
    output: str,
    teacher: Teacher,
    *,
    lenient: bool = False,
    limit: int = 0,
    run_dir: str | None = None,
    slices: int = 1,
) -> DataFrame:
    """Clean mails to chat examples in JSON Lines; returns the label table.

    ``limit`` keeps the first mails by path; 0, the default, keeps all.
    """
    clean = cap_items(read_clean_emails(spark, clean_path), limit, "path")
    requests = lenient_requests(clean) if lenient else strict_requests(clean)
    policy = LENIENT_TEACHER if lenient else STRICT_TEACHER
    labels = label_requests(requests, teacher, policy, run_dir, slices)
    write_chat_examples(chat_examples(labels), output)
    return labels


def training_text(examples: DataFrame, template: ChatTemplate = CHATML) -> DataFrame:
    """Chat examples to the one column a trainer reads."""
    return examples.select(render_chat(F.col("messages"), template).alias("text"))
