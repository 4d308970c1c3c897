import os

import pytest
from pyspark.sql import functions as F

from postmill.functions.prompts import summary_messages
from postmill.functions.summary import PREFIXES, is_strict_summary
from postmill.operators.inference import chat_requests, model_teacher
from postmill.operators.labelling import (
    LENIENT_TEACHER,
    SERVING,
    STRICT_TEACHER,
    chat_examples,
    label_requests,
    label_stats,
)
from postmill.operators.routing import serve_requests

GOOD = "\n".join(f"{p} x" for p in PREFIXES)


class Scripted:
    """Replies by the words in the mail; every call leaves a line in a file."""

    def __init__(self, log):
        self.log = log

    def generate(self, messages, max_new_tokens):
        body, retry = messages[1]["content"], messages[-1]["role"] == "user" and len(messages) > 2
        with open(self.log, "a") as file:
            file.write(f"{retry} {max_new_tokens} {len(messages)}\n")
        if "broken" in body:
            raise RuntimeError("down")
        if "first" in body or (retry and "second" in body):
            return f"  {GOOD}\n"
        return "one line"


class Refusing:
    def generate(self, messages, max_new_tokens):
        raise AssertionError("asked again")


def requests(spark, bodies):
    rows = spark.createDataFrame(list(enumerate(bodies)), "path long, body string").repartition(3)
    messages = summary_messages(F.lit("s"), F.col("body"))
    return chat_requests(rows.withColumn("messages", messages), "path", max_new_tokens=9)


def calls(log):
    return open(log).read().splitlines() if os.path.exists(log) else []


@pytest.fixture
def log(tmp_path):
    return str(tmp_path / "calls")


def test_strict_flow(spark, log):
    labels = label_requests(
        requests(spark, ["first", "second", "never", "first"]),
        model_teacher(lambda: Scripted(log)),
        STRICT_TEACHER,
    )
    rows = {r.id: r for r in labels.collect()}
    assert [(rows[i].status, rows[i].attempts) for i in range(4)] == [
        ("accepted", 1), ("accepted", 2), ("dropped", 2), ("accepted", 1),
    ]
    assert rows[0].label == f"  {GOOD}\n" and rows[2].label is None
    assert all(len(r.messages) == 2 for r in rows.values())
    examples = {r.id: r.messages for r in chat_examples(labels).collect()}
    assert sorted(examples) == [0, 1, 3]
    assert [m.role for m in examples[1]] == ["system", "user", "assistant"]
    # However often the labels are read, each request is asked once, and retried once.
    assert len(calls(log)) == 6
    assert {line.split()[1] for line in calls(log)} == {"9"}


def test_lenient_flow_shows_the_draft(spark, log):
    labels = label_requests(
        requests(spark, ["second", "never"]), model_teacher(lambda: Scripted(log)), LENIENT_TEACHER
    )
    rows = {r.id: r for r in labels.collect()}
    assert rows[0].label == GOOD and len(rows[0].messages) == 2
    assert rows[1].status == "dropped"
    assert sorted(line.split()[2] for line in calls(log)) == ["2", "2", "4", "4"]


def test_serving_flow_repairs(spark, log):
    labels = label_requests(
        requests(spark, ["never", "first"]), model_teacher(lambda: Scripted(log)), SERVING
    )
    rows = {r.id: r for r in labels.collect()}
    assert rows[0].status == "coerced" and rows[0].label.startswith("1) Purpose: one line\n2) Key")
    assert labels.select(F.every(is_strict_summary(F.col("label")))).first()[0]


def test_error_policies(spark, log):
    bodies = ["first", "broken", "never"]
    skipping = model_teacher(lambda: Scripted(log), on_error="skip")
    labels = label_requests(requests(spark, bodies), skipping, STRICT_TEACHER)
    rows = {r.id: r for r in labels.collect()}
    assert rows[1].status == "failed" and rows[1].error == "RuntimeError: down"
    counts = {(r.status, r.attempts): r.n for r in label_stats(labels).collect()}
    assert counts == {("accepted", 1): 1, ("failed", 1): 1, ("dropped", 2): 1}
    with pytest.raises(Exception, match="down"):
        label_requests(requests(spark, bodies), model_teacher(lambda: Scripted(log)), STRICT_TEACHER)


def test_rerun_resumes(spark, log, tmp_path):
    run_dir = str(tmp_path / "run")
    bodies = ["first", "second", "never"]
    first = label_requests(
        requests(spark, bodies), model_teacher(lambda: Scripted(log)), STRICT_TEACHER, run_dir
    )
    expected = sorted(first.collect())
    again = label_requests(requests(spark, bodies), model_teacher(Refusing), STRICT_TEACHER, run_dir)
    assert sorted(again.collect()) == expected
    before = len(calls(log))
    grown = label_requests(
        requests(spark, [*bodies, "first"]), model_teacher(lambda: Scripted(log)), STRICT_TEACHER, run_dir
    )
    assert grown.count() == 4 and len(calls(log)) == before + 1


def test_slices_give_the_same_labels(spark, log):
    bodies = ["first", "second", "never"] * 7
    teacher = model_teacher(lambda: Scripted(log))
    whole = label_requests(requests(spark, bodies), teacher, STRICT_TEACHER).collect()
    before = len(calls(log))
    sliced = label_requests(requests(spark, bodies), teacher, STRICT_TEACHER, slices=3).collect()
    assert sorted(sliced) == sorted(whole) and len(calls(log)) == 2 * before


def test_stopped_run_keeps_its_slices(spark, log, tmp_path):
    """A run that dies halfway is taken up where the last finished slice ended."""
    run_dir = str(tmp_path / "run")
    bodies = ["first"] * 8 + ["broken"] + ["first"] * 8
    with pytest.raises(Exception, match="down"):
        label_requests(
            requests(spark, bodies), model_teacher(lambda: Scripted(log)), STRICT_TEACHER, run_dir, 6
        )
    kept = 0
    if os.path.exists(f"{run_dir}/attempt=1"):
        kept = spark.read.parquet(f"{run_dir}/attempt=1").count()
    open(log, "w").close()
    skipping = model_teacher(lambda: Scripted(log), on_error="skip")
    labels = label_requests(requests(spark, bodies), skipping, STRICT_TEACHER, run_dir, 6)
    assert labels.where("status = 'accepted'").count() == 16
    assert labels.where("status = 'failed'").count() == 1
    assert len(calls(log)) == 17 - kept


def test_callers_and_pauses(spark, log):
    import time

    teacher = model_teacher(
        lambda: Scripted(log), max_callers=1, pause_seconds=0.2, pause_if=lambda r: "1)" in (r or "")
    )
    asked = teacher(requests(spark, ["first", "never", "first"]))
    assert asked.rdd.getNumPartitions() == 1
    start = time.perf_counter()
    asked.collect()
    assert time.perf_counter() - start >= 0.4
    with pytest.raises(ValueError):
        model_teacher(Refusing, on_error="ignore")


def test_serving_requests(spark, log):
    rows = [
        (0, "summarize", "s", "never \n--\nsignature"),
        (1, "Reply", None, "never"),
        (2, "search", "s", "x"),
        (3, "paint", "s", "x"),
        (4, "spam", "s", "  \n"),
    ]
    table = spark.createDataFrame(rows, "id int, task string, subject string, body string")
    out = {r.id: r for r in serve_requests(table, model_teacher(lambda: Scripted(log))).collect()}
    assert sorted(out) == [0, 1, 2, 3, 4]
    assert out[0].status == "coerced" and out[0].attempts == 2
    assert (out[1].label, out[1].status, out[1].attempts) == ("one line", "accepted", 1)
    assert [out[i].status for i in (2, 3, 4)] == ["rejected"] * 3
    assert out[4].error == "no email content" and out[4].label is None
    assert sorted(line.split()[1] for line in calls(log)) == ["256"] * 3
    raw = serve_requests(table.where("id = 0"), model_teacher(lambda: Scripted(log)), clean=False)
    assert raw.first().status == "coerced"
