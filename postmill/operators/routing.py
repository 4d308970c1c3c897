"""Task requests: check the task, render its prompt, serve it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.fixed_values import TASKS
from postmill.functions.prompts import output_budget, task_error, task_messages
from postmill.functions.pytext import WS
from postmill.operators.cleaning import clean_emails
from postmill.operators.inference import Teacher
from postmill.operators.labelling import SERVING, label_requests

BLANK_ERROR = "no email content"


def route_requests(requests: DataFrame) -> DataFrame:
    """Add ``messages``, ``max_new_tokens`` and ``route_error`` to task requests."""
    optional = ("tone", "style", "length", "categories", "attachments")
    given = {name: F.col(name) for name in optional if name in requests.columns}
    return requests.withColumns(
        {
            "messages": task_messages(F.col("task"), F.col("subject"), F.col("body"), **given),
            "max_new_tokens": output_budget(F.col("task")),
            "route_error": task_error(F.col("task")),
        }
    )


def serve_requests(
    requests: DataFrame,
    teacher: Teacher,
    *,
    id_column: str = "id",
    clean: bool = True,
    run_dir: str | None = None,
    slices: int = 1,
) -> DataFrame:
    """Answer task requests: ``id, label, status, attempts, error``.

    Bodies are cleaned without their subject, or with ``clean=False`` sent as they are,
    blank ones too. Summaries are validated, retried and repaired; the other tasks' replies
    are taken as they are. Requests with a blank body or a bad task are not sent but come
    back as ``rejected`` with the reason.
    """
    bodies = requests.withColumn("blank", F.lit(False))
    if clean:
        has_content = F.coalesce(F.col("body").rlike(f"[^{WS}]"), F.lit(False))
        bodies = (
            clean_emails(requests.withColumn("blank", ~has_content), subject=F.lit(""))
            .withColumn("body", F.col("clean_text"))
            .drop("clean_text", "urls")
        )
    reason = F.when(F.col("blank"), F.lit(BLANK_ERROR)).otherwise(F.col("route_error"))
    routed = route_requests(bodies).withColumn("route_error", reason)
    good = routed.where(F.col("route_error").isNull()).select(
        F.col(id_column).alias("id"),
        "messages",
        "max_new_tokens",
        (F.lower("task") != "summarize").alias("free_form"),
    )
    answers = label_requests(good, teacher, SERVING, run_dir, slices)
    rejected = routed.where(F.col("route_error").isNotNull()).select(
        F.col(id_column).alias("id"),
        F.lit(None).cast("string").alias("label"),
        F.lit("rejected").alias("status"),
        F.lit(0).alias("attempts"),
        F.col("route_error").alias("error"),
    )
    return answers.drop("messages").unionByName(rejected)


def multitask_mix(mails: DataFrame) -> DataFrame:
    """One request for each mail and task: ``task`` is added, or replaced."""
    return mails.withColumn("task", F.explode(F.array(*map(F.lit, TASKS))))
