"""Resumed label runs, replies that are missing, turns without content, samples, reply fields."""

import pytest
from pyspark.sql import functions as F

from postmill.functions.chat import render_chat
from postmill.functions.prompts import summary_messages
from postmill.functions.replies import parse_task_reply
from postmill.operators.inference import chat_requests, model_teacher
from postmill.operators.labelling import SERVING, STRICT_TEACHER, label_requests
from postmill.operators.shaping import sample_items
from postmill.plans.stub_teacher import GOOD
from postmill.session import shared_dir


class Named:
    def __init__(self, name):
        self.name = name

    def generate(self, messages, max_new_tokens):
        if self.name == "down":
            raise RuntimeError("down")
        return None if self.name == "silent" else GOOD.replace("{n}", self.name)


def asked(spark, rows, text="mail"):
    table = spark.range(rows).withColumn("body", F.concat(F.lit(text), F.col("id").cast("string")))
    messages = summary_messages(F.lit("s"), F.col("body"))
    return chat_requests(table.withColumn("messages", messages), "id")


def run(requests, name, folder, slices=1):
    teacher = model_teacher(lambda: Named(name), on_error="skip")
    return label_requests(requests, teacher, STRICT_TEACHER, folder, slices)


@pytest.mark.parametrize("slices", [1, 3])
def test_fewer_requests_than_the_run_before(spark, slices):
    folder = shared_dir(spark, "run")
    assert run(asked(spark, 50), "one", folder, slices).count() == 50
    again = run(asked(spark, 10), "two", folder, slices).collect()
    assert sorted(r.id for r in again) == list(range(10))
    assert all("one characters" in r.label for r in again)


def test_failed_calls_are_asked_again(spark):
    folder = shared_dir(spark, "run")
    assert {r.status for r in run(asked(spark, 10), "down", folder).collect()} == {"failed"}
    healed = run(asked(spark, 10), "one", folder).collect()
    assert len(healed) == 10 and {r.status for r in healed} == {"accepted"}


def test_a_changed_prompt_is_asked_again(spark):
    folder = shared_dir(spark, "run")
    run(asked(spark, 5), "one", folder).count()
    new = run(asked(spark, 5, "other"), "two", folder).collect()
    assert len(new) == 5 and all("two characters" in r.label for r in new)


def test_no_reply_is_not_accepted(spark):
    free = asked(spark, 3).withColumn("free_form", F.lit(True))
    teacher = model_teacher(lambda: Named("silent"))
    rows = label_requests(free, teacher, SERVING).collect()
    assert {(r.status, r.label, r.error) for r in rows} == {("failed", None, "no reply")}


def test_a_turn_without_content_stays(spark):
    kind = "messages array<struct<role: string, content: string>>"
    row = spark.createDataFrame([([("system", "a"), ("user", None), ("assistant", "b")],)], kind)
    text = row.select(render_chat(F.col("messages"))).first()[0]
    assert text.count("<|im_start|>") == text.count("<|im_end|>") == 3


def test_samples(spark):
    table = spark.range(4000).withColumnRenamed("id", "k")
    some = {r.k for r in sample_items(table, 0.25, "k").collect()}
    assert 850 < len(some) < 1150
    assert some == {r.k for r in sample_items(table.repartition(7), 0.25, "k").collect()}
    assert some < {r.k for r in sample_items(table, 0.5, "k").collect()}
    assert sample_items(table, 1, "k").count() == 4000 and sample_items(table, 0, "k").count() == 0


def test_reply_fields(spark):
    cases = [
        ("phishing", "LABEL: Phishing\nReason: odd link", ("Phishing", "odd link", True)),
        ("spam", "label: maybe\nreason: x", ("maybe", "x", False)),
        ("spam", "label:\nreason: x", (None, "x", False)),
        ("categorize", "reason: x\r\n category: hr \r\n", ("hr", "x", True)),
        ("Attachment", "summary: a\nchecks: b", ("a", "b", True)),
        ("phishing", None, (None, None, False)),
        ("reply", "label: ham", (None, None, None)),
        (None, "x", (None, None, None)),
    ]
    rows = spark.createDataFrame([c[:2] for c in cases], "task string, reply string")
    found = rows.select(parse_task_reply(F.col("task"), F.col("reply")).alias("p")).collect()
    assert [tuple(r.p) for r in found] == [c[2] for c in cases]
