"""Chat examples and chat-template rendering."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.functions.prompts import turn
from postmill.schemas import CHAT_MESSAGES


@dataclass(frozen=True)
class ChatTemplate:
    """How a model spells turns. The default is the public ChatML form.

    ``{role}`` in ``opening`` stands for the turn's role.
    """

    opening: str = "<|im_start|>{role}\n"
    closing: str = "<|im_end|>\n"
    prefix: str = ""

    def opening_for(self, role: Column) -> Column:
        before, _, after = self.opening.partition("{role}")
        return F.concat(F.lit(before), role, F.lit(after))


CHATML = ChatTemplate()


def with_reply(messages: Column, reply: Column) -> Column:
    """The finished chat example: the prompt and the assistant's turn."""
    return F.concat(messages, F.array(turn("assistant", reply)).cast(CHAT_MESSAGES))


def render_chat(messages: Column, template: ChatTemplate = CHATML) -> Column:
    """The text to train on. A turn without content stays, as an empty one."""
    turns = F.transform(
        messages,
        lambda m: F.concat(
            template.opening_for(F.coalesce(m["role"], F.lit(""))),
            F.coalesce(m["content"], F.lit("")),
            F.lit(template.closing),
        ),
    )
    return F.concat(F.lit(template.prefix), F.array_join(turns, ""))


def render_prompt(messages: Column, template: ChatTemplate = CHATML) -> Column:
    """The text to generate from: it ends with the opening of the assistant's turn."""
    return F.concat(render_chat(messages, template), template.opening_for(F.lit("assistant")))
