"""Whitespace and line rules of Python strings, as Spark columns.

Java's ``\\s`` is ASCII only and Spark's ``trim`` strips plain spaces only, while
mail text holds no-break spaces, Unicode line separators and control characters.
The constants are bodies of character classes that Java regex and RE2 read alike.
Java tests the single characters of a class by one bit set and ``\\p{Z}`` by one table
look-up; a class written as ranges is tried range by range and takes twice as long.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# All characters that Python counts as whitespace.
WS = r"\p{Z}\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85"
# Those that end a line, and the others.
ENDS = r"\n\x0b\f\r\x1c\x1d\x1e\x85\x{2028}\x{2029}"
BLANK = r"\p{Zs}\t\x1f"
LINE_BREAK = r"[\v\x1c\x1d\x1e](?:(?<=\r)\n)?"  # Java only

WS_CHARS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WS_CHARS))


def unify_lines(text: Column) -> Column:
    """Turn every line break into ``\\n``."""
    return F.regexp_replace(text, LINE_BREAK, "\n")


def split_lines(text: Column) -> Column:
    """The lines of a text; a final line break starts no further line."""
    body = F.regexp_replace(unify_lines(text), r"\n\z", "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(body, "\n", -1))


def collapse_whitespace(text: Column) -> Column:
    """Every whitespace run becomes one space; none is left at the ends."""
    return F.trim(F.regexp_replace(text, f"[{WS}]+", " "))
