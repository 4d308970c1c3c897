from pyspark.sql import functions as F

from postmill import fixed_values as fixed
from postmill.functions.chat import ChatTemplate, render_chat, render_prompt, with_reply
from postmill.functions.prompts import (
    chat_teacher_messages,
    correction,
    fill,
    output_budget,
    summary_messages,
)
from postmill.operators.routing import route_requests
from postmill.schemas import TASK_REQUEST

ODD_BODY = "braces {subject} {0} {{x}} and \\ and $1"


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_fill_substitutes_once(spark):
    values = {"a": F.lit("{b}"), "b": F.lit(ODD_BODY)}
    row = one(spark, fill("x{a}y{b}{a}", values).alias("t"))
    assert row.t == "x{a}y{b}{a}".format(a="{b}", b=ODD_BODY)


def test_summary_prompts(spark):
    row = one(
        spark,
        summary_messages(F.lit(""), F.lit(ODD_BODY)).alias("bare"),
        summary_messages(F.lit("s"), F.lit(None).cast("string")).alias("empty"),
        chat_teacher_messages(F.lit("  s "), F.lit("b")).alias("chat"),
        chat_teacher_messages(F.lit(None).cast("string"), F.lit("b")).alias("chat_bare"),
    )
    assert [m.role for m in row.bare] == ["system", "user"]
    assert row.bare[1].content == fixed.SUMMARY_USER.format(subject="(no subject)", body=ODD_BODY)
    assert row.empty[1].content == fixed.SUMMARY_USER.format(subject="s", body="")
    assert row.chat[0].content == fixed.CHAT_TEACHER_SYSTEM
    assert row.chat[1].content == "Subject: s\n\nEmail:\nb"
    assert row.chat_bare[1].content == "Subject: \n\nEmail:\nb"


def request(task, **given):
    row = {name: None for name in TASK_REQUEST.names}
    return tuple({**row, "task": task, "subject": "s", "body": ODD_BODY, **given}.values())


def routed(spark, *requests):
    return route_requests(spark.createDataFrame(list(requests), TASK_REQUEST)).collect()


def test_every_task_is_routed(spark):
    rows = routed(spark, *[request(t.upper()) for t in fixed.TASKS])
    systems = {"summarize": fixed.SUMMARY_SYSTEM, **fixed.TASK_SYSTEM}
    users = {"summarize": fixed.SUMMARY_USER, **fixed.TASK_USER}
    for task, row in zip(fixed.TASKS, rows, strict=True):
        assert row.route_error is None
        assert row.messages[0].content == systems[task]
        assert row.messages[1].content == users[task].format(
            subject="s", body=ODD_BODY, tone="neutral", length="short", style="professional",
            categories=", ".join(fixed.DEFAULT_CATEGORIES), attachments="(none provided)",
        )
        assert row.max_new_tokens == (256 if task in ("summarize", "reply", "rewrite") else 160)


def test_given_values_are_used(spark):
    rows = routed(
        spark,
        request("reply", tone="warm", length="long"),
        request("rewrite", style="short"),
        request("categorize", categories=["A", "B"]),
        request("categorize", categories=[]),
        request("attachment", attachments=["a.pdf", "b.xls"]),
        request("attachment", attachments=[]),
    )
    users = [r.messages[1].content for r in rows]
    assert "tone=warm; length=long." in users[0]
    assert users[1].endswith("Rewrite style: short.")
    assert users[2].endswith("from: A, B.")
    assert users[3].endswith("from: " + ", ".join(fixed.DEFAULT_CATEGORIES) + ".")
    assert "Attachments: a.pdf, b.xls\n" in users[4]
    assert "Attachments: (none provided)\n" in users[5]


def test_bad_tasks_are_named(spark):
    rows = routed(spark, request("Search"), request("Translate"), request(None))
    assert [r.messages for r in rows] == [None] * 3
    assert [r.route_error for r in rows] == [
        fixed.SEARCH_ERROR, "unknown task: translate", "unknown task: null",
    ]


def test_corrections(spark):
    first = summary_messages(F.lit("s"), F.lit("b"))
    styles = ("serving", "teacher", "chat")
    row = one(spark, *[correction(first, F.lit("bad"), s).alias(s) for s in styles])
    assert [[m.role for m in row[s][2:]] for s in styles] == [["user"], ["user"], ["assistant", "user"]]
    assert row.chat[2].content == "bad"
    assert [row[s][-1].content for s in styles] == [
        fixed.SERVING_CORRECTION, fixed.TEACHER_CORRECTION, fixed.CHAT_TEACHER_CORRECTION,
    ]


def test_chat_rendering(spark):
    prompt = summary_messages(F.lit("s"), F.lit("b"))
    brackets = ChatTemplate(opening="[{role}] ", closing=" [/]", prefix="<s>")
    row = one(
        spark,
        render_chat(with_reply(prompt, F.lit("r"))).alias("text"),
        render_prompt(prompt).alias("prompt"),
        render_chat(with_reply(prompt, F.lit("r")), brackets).alias("other"),
    )
    assert row.text == row.prompt + "r<|im_end|>\n"
    assert row.prompt.startswith(f"<|im_start|>system\n{fixed.SUMMARY_SYSTEM}<|im_end|>\n<|im_start|>user\n")
    assert row.prompt.endswith("<|im_end|>\n<|im_start|>assistant\n")
    assert row.other.startswith("<s>[system] ") and row.other.endswith("[assistant] r [/]")


def test_budget(spark):
    tasks = ["summarize", "REPLY", "rewrite", "spam", "phishing", "categorize", "attachment"]
    rows = spark.createDataFrame([(t,) for t in tasks], "task string")
    budgets = [r.n for r in rows.select(output_budget(F.col("task")).alias("n")).collect()]
    assert budgets == [256, 256, 256, 160, 160, 160, 160]
