"""A deterministic model stand-in for checks: its replies follow from the prompt's length."""

from __future__ import annotations

GOOD = (
    "1) Purpose: note\n2) Key details: {n} characters\n3) Action needed: N/A\n"
    "4) Deadline/Date: N/A\n5) Important context/links: N/A"
)
# Replies to the first prompt by its length modulo 7, and to the retry modulo 3.
FIRST = (
    GOOD,
    GOOD.lower(),
    GOOD.replace(": note\n", ":\n\n"),
    "Here it is:\n1) Purpose: note",
    GOOD.replace("3) A", "9) A").replace("1) Purpose", "1) Deadline/Date"),
    GOOD.replace("2) Key", "  2) Key"),
    "",
)
RETRY = (GOOD, "Sorry.\n1) Purpose: {n}", "")


class StubClient:
    """Answers by rule; with ``fail_every`` it fails on prompts of such lengths."""

    def __init__(self, fail_every: int = 0):
        self.fail_every = fail_every

    def generate(self, messages: list[dict[str, str]], max_new_tokens: int | None) -> str:
        length = len(messages[1]["content"])
        if self.fail_every and length % self.fail_every == 0:
            raise RuntimeError(f"no reply to {length}")
        replies = FIRST if len(messages) == 2 else RETRY
        return replies[length % len(replies)].replace("{n}", str(length))
