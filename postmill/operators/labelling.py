"""Label chat requests: draft, validate, retry once, then drop or repair."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from postmill.functions.chat import with_reply
from postmill.functions.prompts import correction
from postmill.functions.pytext import strip
from postmill.functions.summary import coerce_summary, is_lenient_summary, is_strict_summary
from postmill.operators.inference import Teacher
from postmill.session import shared_dir


@dataclass(frozen=True)
class LabelPolicy:
    """What makes a reply valid and what becomes of one that stays invalid."""

    validator: str  # strict or lenient
    on_invalid: str  # drop or coerce
    correction: str  # serving, teacher or chat
    strip_reply: bool

    def is_valid(self, reply: Column) -> Column:
        check = {"strict": is_strict_summary, "lenient": is_lenient_summary}[self.validator]
        return F.coalesce(check(reply), F.lit(False))


STRICT_TEACHER = LabelPolicy("strict", "drop", "teacher", strip_reply=False)
LENIENT_TEACHER = LabelPolicy("lenient", "drop", "chat", strip_reply=True)
SERVING = LabelPolicy("strict", "coerce", "serving", strip_reply=True)


def _unanswered(requests: DataFrame, path: str) -> DataFrame:
    """The requests that the attempt table has no reply to, as they are asked now."""
    spark = requests.sparkSession
    error = StructField("error", StringType())
    known = StructType([requests.schema["id"], requests.schema["asked"], error])
    # Adds no row, but a run that was never started then has an empty table to look into.
    spark.createDataFrame([], known).write.mode("append").parquet(path)
    answered = spark.read.schema(known).parquet(path).where("error is null")
    return requests.join(answered, ["id", "asked"], "left_anti")


def _current(answers: DataFrame, requests: DataFrame) -> DataFrame:
    """Of an attempt table that several runs wrote: the newest answer to each of ``requests``."""
    asked = answers.join(requests.select("id", "asked"), ["id", "asked"], "left_semi")
    newest = asked.groupBy("id").agg(F.max_by(F.struct(*answers.columns), "answered_at").alias("row"))
    return newest.select("row.*")


def _attempt(
    requests: DataFrame,
    teacher: Teacher,
    policy: LabelPolicy,
    path: str,
    resume: bool,
    slices: int,
) -> DataFrame:
    """Ask the teacher and write the judged replies before anything branches on them.

    Without the written table each later branch would call the model again. The table
    is also what a rerun resumes from.
    """
    text = F.to_json(F.struct("messages", "max_new_tokens", "free_form"))
    requests = requests.withColumn("asked", F.xxhash64(text, F.lit(repr(policy))))
    spark = requests.sparkSession
    if slices > 1:
        # Written once by slice, so that the source is not read for each of them.
        by_slice = shared_dir(spark, "requests")
        number = F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int")
        requests.withColumn("slice", number).write.partitionBy("slice").parquet(by_slice)
        kinds = StructType([*requests.schema.fields, StructField("slice", IntegerType())])
        sliced = spark.read.schema(kinds).parquet(by_slice)
    for number in range(slices):
        part = requests if slices == 1 else sliced.where(F.col("slice") == number).drop("slice")
        if resume:
            part = _unanswered(part, path)
        replied = teacher(part)
        if policy.strip_reply:
            replied = replied.withColumn("reply", strip(F.col("reply")))
        silent = F.when(F.col("free_form") & F.col("reply").isNull(), F.lit("no reply"))
        replied = replied.withColumn("error", F.coalesce("error", silent))
        valid = F.col("free_form") | policy.is_valid(F.col("reply"))
        judged = replied.withColumns(
            {"valid": F.col("error").isNull() & valid, "answered_at": F.current_timestamp()}
        )
        judged.write.mode("append").parquet(path)
    answers = spark.read.schema(judged.schema).parquet(path)
    answers = _current(answers, requests) if resume else answers
    return answers.drop("asked", "answered_at")


def label_requests(
    requests: DataFrame,
    teacher: Teacher,
    policy: LabelPolicy,
    run_dir: str | None = None,
    slices: int = 1,
) -> DataFrame:
    """One row per request: ``id, messages, label, status, attempts, error``.

    ``status`` is ``accepted``, ``coerced``, ``dropped`` or ``failed`` (the call itself);
    only the first two have a label. Nothing is joined in a first run: the attempt table
    carries the prompt along, so the retry is a filter.

    Pass a ``run_dir`` in shared storage to resume a run that was stopped. What was answered
    without an error, to the same prompt under the same policy, is not asked again; of
    several answers the newest counts, and requests of other runs have no row. A task's replies
    are kept when its job ends, so split a run of days into ``slices``: each is a job of its
    own over a hash slice of the ids, and a crash costs at most one of them.
    """
    resume = run_dir is not None
    run_dir = run_dir or shared_dir(requests.sparkSession, "labels")
    first = _attempt(requests, teacher, policy, f"{run_dir}/attempt=1", resume, slices)
    pending = first.where(~F.col("valid") & F.col("error").isNull()).select(
        "id",
        correction(F.col("messages"), F.col("reply"), policy.correction).alias("messages"),
        "max_new_tokens",
        "free_form",
    )
    second = _attempt(pending, teacher, policy, f"{run_dir}/attempt=2", resume, slices)

    # A retry's request ends in the correction turns; the label goes with the first prompt.
    added = 2 if policy.correction == "chat" else 1
    prompt = F.slice("messages", F.lit(1), F.size("messages") - added)
    settled = first.where(F.col("valid") | F.col("error").isNotNull())
    attempts = settled.withColumn("attempts", F.lit(1)).unionByName(
        second.withColumn("messages", prompt).withColumn("attempts", F.lit(2))
    )
    status = F.when(F.col("error").isNotNull(), "failed").when(F.col("valid"), "accepted")
    label = F.when(F.col("valid"), F.col("reply"))
    if policy.on_invalid == "coerce":
        status = status.otherwise("coerced")
        label = label.when(F.col("error").isNull(), coerce_summary(F.col("reply")))
    else:
        status = status.otherwise("dropped")
    return attempts.select(
        "id", "messages", label.alias("label"), status.alias("status"), "attempts", "error"
    )


def chat_examples(labels: DataFrame) -> DataFrame:
    """Chat examples of the labelled rows: id and messages with the reply."""
    return labels.where(F.col("label").isNotNull()).select(
        "id", with_reply(F.col("messages"), F.col("label")).alias("messages")
    )


def label_stats(labels: DataFrame) -> DataFrame:
    """Rows per status and attempt; partial counts are merged, so few rows are shuffled."""
    return labels.groupBy("status", "attempts").agg(F.count("*").alias("n"))
