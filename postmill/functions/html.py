"""HTML to text as column expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks the places where markup stood. U+FDD0 is a code point that Unicode keeps
# free of characters, so no text uses it.
GAP = "\ufdd0"

_ATTRS = r"""(?:=[ \t\n\r\f]*"[^"]*"|=[ \t\n\r\f]*'[^']*'|=|[^>=]++)*+(?:>|\z)"""
_WESTERN = {
    code: bytes([code]).decode("cp1252", "ignore")
    for code in range(0x80, 0xA0)
    if bytes([code]).decode("cp1252", "ignore")
}
_UNREAD = ("script", "style", "template")


def markup_pattern() -> str:
    """Comments, unread subtrees, tags and declarations, as one alternation.

    Ruby annotations (``rt``, ``rp``) are unread up to the next one or the end of their ruby.

    One pass from the left decides what each ``<`` opens, so markup inside a script
    string or a comment does not count. Quoted attribute values may hold ``>``.
    """
    attrs = _ATTRS
    unread = "|".join(rf"<{t}\b{attrs}.*?(?:</{t}\b[^>]*+(?:>|\z)|\z)" for t in _UNREAD)
    ruby = rf"<r[tp]\b{attrs}.*?(?=</?(?:rt|rp|ruby)\b|\z)"
    return rf"(?is)<!--.*?(?:-->|\z)|{unread}|{ruby}|</?[a-z]{attrs}|<[!?][^>]*(?:>|\z)"


def html_to_text(html: Column) -> Column:
    """Text nodes joined by one space; scripts, styles and comments are left out."""
    gaps = F.regexp_replace(F.coalesce(html, F.lit("")), markup_pattern(), GAP)
    text = F.regexp_replace(F.btrim(gaps, F.lit(GAP)), f"{GAP}+", " ")
    return decode_references(text)


def decode_references(text: Column) -> Column:
    """Replace character references. Each is read once: ``&amp;lt;`` gives ``&lt;``."""
    names = F.create_map(*[F.lit(x) for n, c in sorted(name2codepoint.items()) for x in (n, chr(c))])

    def decoded(piece: Column, index: Column) -> Column:
        name = F.regexp_extract(piece, r"^([a-zA-Z][a-zA-Z0-9]*);", 1)
        named = F.try_element_at(names, name)
        number = F.regexp_extract(piece, r"^#0*([0-9]{1,7})(?![0-9])", 1)
        hexed = F.regexp_extract(piece, r"^#[xX]0*([0-9a-fA-F]{1,6})(?![0-9a-fA-F])", 1)
        code = F.when(number != "", number).otherwise(F.conv(hexed, 16, 10))
        numeric = F.when(
            piece.rlike(r"^#(?:[0-9]|[xX][0-9a-fA-F])"),
            F.concat(
                _character(code.cast("int")),
                F.regexp_replace(piece, r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", ""),
            ),
        )
        spelled = F.concat(named, F.regexp_replace(piece, "^[^;]*;", ""))
        return F.when(index == 0, piece).otherwise(
            F.coalesce(spelled, numeric, F.concat(F.lit("&"), piece))
        )

    return F.array_join(F.transform(F.split(text, "&", -1), decoded), "")


def _character(code: Column) -> Column:
    """The character of a code point; empty for one that may not occur in markup.

    Numbers from 128 to 159 are meant in windows-1252, where that has a character.
    """
    allowed = (
        code.isin(9, 10, 13)
        | code.between(0x20, 0xD7FF)
        | code.between(0xE000, 0xFFFD)
        | code.between(0x10000, 0x10FFFF)
    )
    as_bytes = F.unhex(F.lpad(F.hex(code.cast("bigint")), 8, "0"))
    western = F.create_map(*[F.lit(x) for pair in _WESTERN.items() for x in pair])
    meant = F.when(code.between(0x80, 0x9F), F.try_element_at(western, code))
    return F.coalesce(meant, F.when(allowed, F.decode(as_bytes, "UTF-32")).otherwise(""))
