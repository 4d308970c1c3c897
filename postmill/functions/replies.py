"""Fields of the replies to the classifying tasks, whose formats the prompts fix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.fixed_values import DEFAULT_CATEGORIES, REPLY_FIELDS, REPLY_LABELS


def _field(reply: Column, name: str) -> Column:
    """What follows ``name:`` at the beginning of a line, in any case; null without one."""
    found = F.rtrim(F.regexp_extract(reply, rf"(?im)^[ \t]*{name}[ \t]*:[ \t]*([^\r\n]*)", 1))
    return F.when(F.length(found) > 0, found)


def parse_task_reply(task: Column, reply: Column, categories: Column | None = None) -> Column:
    """Struct of ``answer``, ``detail`` and ``valid``.

    ``answer`` is the label, category or summary, ``detail`` the reason or checks. A reply is
    valid if it has both and, of the tasks with fixed labels, the answer is one of them in
    any case; a category must be among ``categories``, or the default ones where there are
    none. Of tasks without such a format all three are null.
    """
    name = F.lower(task)
    default = F.array(*map(F.lit, DEFAULT_CATEGORIES))
    allowed = default if categories is None else F.when(F.size(categories) > 0, categories).otherwise(default)
    answer = detail = valid = F.lit(None)
    for known, (first, second) in REPLY_FIELDS.items():
        one, two = _field(reply, first), _field(reply, second)
        if known in REPLY_LABELS:
            fits = F.lower(one).isin(*REPLY_LABELS[known])
        elif known == "categorize":
            fits = F.array_contains(F.transform(allowed, F.lower), F.lower(one))
        else:
            fits = F.lit(True)
        here = name == known
        complete = F.coalesce(one.isNotNull() & two.isNotNull() & fits, F.lit(False))
        answer = F.when(here, one).otherwise(answer)
        detail = F.when(here, two).otherwise(detail)
        valid = F.when(here, complete).otherwise(valid)
    return F.struct(answer.alias("answer"), detail.alias("detail"), valid.alias("valid"))
