"""Cleaning of mail text as column expressions.

Each step is one regular expression over the whole text rather than an array of
lines with lambdas, so that the steps stay inside whole-stage code generation and
no row is blown up into an array.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postmill.fixed_values import (
    BODY_LIMIT,
    CUT_MARK,
    QUOTE_HEADER_LABELS,
    QUOTE_INTRO_END,
    QUOTE_INTRO_START,
    QUOTE_TITLE,
    SIGNATURE_MARKERS,
    URL_TAIL,
)
from postmill.functions.pytext import BLANK, WS, collapse_whitespace, strip, unify_lines

# From the first line that looks like a quote header to the end of the text. A header
# label counts only with something after it, since the line is compared trimmed.
QUOTED_REST = (
    f"(?m)^[{BLANK}]*(?:"
    f"(?iu:{QUOTE_INTRO_START}).*(?iu:{QUOTE_INTRO_END})[{BLANK}]*$"
    f"|(?iu:{'|'.join(QUOTE_HEADER_LABELS)}):[{BLANK}]+[^{WS}]"
    f"|(?iu:{QUOTE_TITLE})[{BLANK}]*$"
    ")(?s:.*)"
)
# The greedy group runs up to the last line that begins with a marker.
LAST_SIGNATURE = rf"(?sm)\A(.*)^[{BLANK}]*(?:{'|'.join(SIGNATURE_MARKERS)}).*\z"

# Line breaks that the matcher's ``^`` and ``$`` do not know.
SILENT_BREAK = r"[\x0b\f\x1c\x1d\x1e]"

# A link ends at its last character that is not tail punctuation. One with nothing
# but tail punctuation after the slashes still counts, as the bare scheme. The long s
# is the one character beyond ASCII that equals a letter of the scheme but for case.
URL = rf"(?i)http[s\x{{17f}}]?://(?:[^{WS}]*[^{WS}{URL_TAIL}]|(?=[{URL_TAIL}]))"


def _without_quotes(lines: Column) -> Column:
    return F.regexp_replace(lines, QUOTED_REST, "")


def _without_signature(lines: Column) -> Column:
    return F.regexp_replace(lines, LAST_SIGNATURE, "$1")


def strip_quoted_history(text: Column) -> Column:
    """Cut at the first quote header line."""
    return strip(_without_quotes(unify_lines(text)))


def remove_signature(text: Column) -> Column:
    """Cut at the last line that begins with a signature marker."""
    return strip(_without_signature(unify_lines(strip(text))))


def visible_text(body: Column) -> Column:
    """Body without quoted history and signature; a missing body is empty.

    Up to whitespace this is ``remove_signature(strip_quoted_history(body))``. Trimming
    and unifying of line breaks are left out for the steps that follow: they treat all
    whitespace alike, and each of the two is another pass over the text.
    """
    lines = F.regexp_replace(F.coalesce(body, F.lit("")), SILENT_BREAK, "\n")
    return _without_signature(_without_quotes(lines))


def normalize_whitespace(text: Column) -> Column:
    return collapse_whitespace(text)


def extract_urls(text: Column) -> Column:
    """Distinct links, sorted."""
    return F.sort_array(F.array_distinct(F.regexp_extract_all(text, F.lit(URL), F.lit(0))))


def truncate_thread(text: Column, limit: int = BODY_LIMIT) -> Column:
    """Cut an over-long text at its last space before the limit and mark the cut."""
    head = F.regexp_replace(F.substring(text, 1, limit), r" [^ ]*\z", "")
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(head, F.lit(CUT_MARK)))


def hard_cut(text: Column, limit: int = BODY_LIMIT) -> Column:
    return F.substring(F.coalesce(text, F.lit("")), 1, limit)


def with_subject(subject: Column, text: Column) -> Column:
    """Put the subject on a line of its own before the text, if there is one."""
    line = F.concat(F.lit("Subject: "), subject, F.lit("\n"))
    return F.concat(F.when(F.length(subject) > 0, line).otherwise(""), text)
