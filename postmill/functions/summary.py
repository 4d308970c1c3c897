"""The five-line summary schema: two validators and the repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.fixed_values import MISSING_VALUE, SUMMARY_LABELS
from postmill.functions.pytext import BLANK, ENDS, WS, strip

PREFIXES = tuple(f"{i}) {label}:" for i, label in enumerate(SUMMARY_LABELS, 1))

# Between two summary lines only blank lines may stand. Whitespace that ends in a line
# break is matched as one run, not line by line, so that a draft of many blank lines
# does not deepen the matcher's stack.
_BREAK = rf"[{ENDS}](?:[{WS}]*[{ENDS}])?"
# The rest of a line is never given back: what follows it is a break or the end. Plain
# ASCII stands first in the class because most characters are settled by it.
_REST = rf"[ -~[^{ENDS}]]*+"


def _literal(words: str) -> str:
    return words.replace(")", r"\)")


STRICT = r"\A" + _BREAK.join(_literal(prefix) + _REST for prefix in PREFIXES) + r"\z"

_ANY_LINE = (
    rf"[{BLANK}]*\p{{Nd}}\)[{BLANK}]*(?iu:{'|'.join(SUMMARY_LABELS)}):[{BLANK}]*[^{WS}]{_REST}"
)
LENIENT = r"\A" + _BREAK.join([_ANY_LINE] * len(PREFIXES)) + r"\z"


def is_strict_summary(text: Column) -> Column:
    """Five non-blank lines that begin with the five prefixes in order."""
    return strip(text).rlike(STRICT)


def is_lenient_summary(text: Column) -> Column:
    """Five non-blank lines, each with a number, any of the labels and some content."""
    return strip(text).rlike(LENIENT)


def coerce_summary(text: Column) -> Column:
    """Force a draft into five lines, by position.

    A line that has the prefix of its place is kept, another one gets it put in front,
    a missing one is filled in, and lines after the fifth are dropped.
    """
    # A line break takes the blank lines and the indent after it along. The split stops
    # after five lines, however long the draft goes on.
    lines = F.split(strip(text), rf"[{ENDS}][{WS}]*", len(PREFIXES) + 1)

    def placed(index: int, prefix: str) -> Column:
        line = strip(F.get(lines, F.lit(index)))
        return (
            F.when(F.coalesce(F.length(line), F.lit(0)) == 0, F.lit(f"{prefix} {MISSING_VALUE}"))
            .when(F.startswith(line, F.lit(prefix)), line)
            .otherwise(F.concat(F.lit(f"{prefix} "), line))
        )

    return F.concat_ws("\n", *[placed(i, p) for i, p in enumerate(PREFIXES)])

