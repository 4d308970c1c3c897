"""Prompt columns: chat messages for every task, correction turns, output budgets."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill import fixed_values as fixed
from postmill.functions.pytext import strip
from postmill.schemas import CHAT_MESSAGES


def turn(role: str, content: Column | str) -> Column:
    content = F.lit(content) if isinstance(content, str) else content
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def fill(template: str, values: Mapping[str, Column]) -> Column:
    """Put columns into the ``{name}`` places of a template.

    The text between the places is literal and so are the values: braces inside a
    mail body are not read as places.
    """
    pieces = re.split(r"\{(\w+)\}", template)
    columns = [
        values[piece] if at % 2 else F.lit(piece)
        for at, piece in enumerate(pieces)
        if at % 2 or piece
    ]
    return F.concat(*columns)


def subject_or_default(subject: Column) -> Column:
    return F.when(F.length(subject) > 0, subject).otherwise(F.lit(fixed.DEFAULT_SUBJECT))


def _body(body: Column) -> Column:
    return F.coalesce(body, F.lit(""))


def summary_messages(subject: Column, body: Column) -> Column:
    user = fill(
        fixed.SUMMARY_USER, {"subject": subject_or_default(subject), "body": _body(body)}
    )
    return F.array(turn("system", fixed.SUMMARY_SYSTEM), turn("user", user))


def chat_teacher_messages(subject: Column, body: Column) -> Column:
    """The chat teacher's own prompt: the subject is trimmed and may stay empty."""
    user = fill(
        fixed.CHAT_TEACHER_USER,
        {"subject": strip(F.coalesce(subject, F.lit(""))), "body": _body(body)},
    )
    return F.array(turn("system", fixed.CHAT_TEACHER_SYSTEM), turn("user", user))


def listed(items: Column, default: str) -> Column:
    """List entries joined by a comma; ``default`` for a missing or empty list."""
    return F.when(F.size(items) > 0, F.array_join(items, ", ")).otherwise(F.lit(default))


def task_error(task: Column) -> Column:
    """Why a task name cannot be routed; null for one that can."""
    name = F.lower(task)
    return (
        F.when(name.isin(*fixed.TASKS), F.lit(None).cast("string"))
        .when(name == fixed.TASK_WITHOUT_INDEX, F.lit(fixed.SEARCH_ERROR))
        .otherwise(F.concat(F.lit("unknown task: "), F.coalesce(name, F.lit("null"))))
    )


def task_messages(
    task: Column,
    subject: Column,
    body: Column,
    *,
    tone: Column | None = None,
    style: Column | None = None,
    length: Column | None = None,
    categories: Column | None = None,
    attachments: Column | None = None,
) -> Column:
    """Messages of the row's task; null where ``task_error`` names a reason."""

    def or_default(value: Column | None, default: str) -> Column:
        return F.lit(default) if value is None else F.coalesce(value, F.lit(default))

    def or_listed(items: Column | None, default: str) -> Column:
        return F.lit(default) if items is None else listed(items, default)

    values = {
        "subject": subject_or_default(subject),
        "body": _body(body),
        "tone": or_default(tone, fixed.DEFAULT_TONE),
        "style": or_default(style, fixed.DEFAULT_STYLE),
        "length": or_default(length, fixed.DEFAULT_LENGTH),
        "categories": or_listed(categories, ", ".join(fixed.DEFAULT_CATEGORIES)),
        "attachments": or_listed(attachments, fixed.NO_ATTACHMENTS),
    }
    system_texts = {"summarize": fixed.SUMMARY_SYSTEM, **fixed.TASK_SYSTEM}
    user_texts = {"summarize": fixed.SUMMARY_USER, **fixed.TASK_USER}
    name = F.lower(task)
    system, user = F.lit(None), F.lit(None)
    for known in fixed.TASKS:
        system = F.when(name == known, F.lit(system_texts[known])).otherwise(system)
        user = F.when(name == known, fill(user_texts[known], values)).otherwise(user)
    messages = F.array(turn("system", system), turn("user", user))
    return F.when(name.isin(*fixed.TASKS), messages).cast(CHAT_MESSAGES)


def output_budget(task: Column) -> Column:
    """Most tokens a reply to the task may have."""
    name = F.lower(task)
    return F.when(
        name.isin("summarize", "reply", "rewrite"), F.lit(fixed.LONG_BUDGET)
    ).otherwise(F.lit(fixed.SHORT_BUDGET))


def correction(messages: Column, draft: Column, style: str) -> Column:
    """The messages of the retry after an invalid draft.

    ``serving`` and ``teacher`` append one user turn; ``chat`` shows the draft as the
    assistant's turn first.
    """
    if style == "serving":
        added = F.array(turn("user", fixed.SERVING_CORRECTION))
    elif style == "teacher":
        added = F.array(turn("user", fixed.TEACHER_CORRECTION))
    elif style == "chat":
        added = F.array(turn("assistant", draft), turn("user", fixed.CHAT_TEACHER_CORRECTION))
    else:
        raise ValueError(f"unknown correction style: {style}")
    return F.concat(messages, added.cast(CHAT_MESSAGES))
