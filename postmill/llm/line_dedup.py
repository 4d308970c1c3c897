"""Line dedup: equal lines and lines within one word edit, by a deletion-neighbourhood join.

A line is its words: runs of letters and digits, in lower case, and in scripts that put no
blanks between words every letter, mark and digit by itself. Two lines are within one
edit when deleting a word from both at the same place, or from one of them, gives the same
variant. So every line gives its variants as hashed keys with the place of the deletion,
equal keys meet, the earliest line of a key is the partner of the others, and the words of
both are compared again. A line goes when an earlier one equals it or is within the bound.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from postmill.llm.staging import free_name, id_and_text, joined_with, staged
from postmill.llm.words import (
    _ODD, _STEP, _STEP_INVERSE, Block, _powers, binary, by_blocks, mixed, signed, table,
)

MIN_WORDS = 3
EDIT_WORDS = 8
BROADCAST_LINES = 1_000_000  # line numbers, of 8 bytes each
_LINE = (1 << 32) - 1  # the bits of a line's number; those above tell texts of one id apart

# Code points of scripts without blanks between words (Thai, Lao, Myanmar,
# Khmer, Kana, Bopomofo, Han).
UNSPACED = (
    (0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3005, 0x3007), (0x3040, 0x312F),
    (0x31A0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F),
    (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
)


@cache
def _unspaced() -> np.ndarray:
    """By code point: a letter, mark or digit of a script without blanks."""
    found = np.zeros(0x110000, bool)
    for a, b in UNSPACED:
        found[a : b + 1] = [unicodedata.category(chr(c))[0] in "LMN" for c in range(a, b + 1)]
    return found


def _words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block."""
    single = np.zeros(len(block.codes) + 2, bool)
    single[1:-1] = _unspaced()[block.codes]
    inside = single.copy()
    inside[1:-1] |= table("word")[block.codes]
    parts = single[1:] | single[:-1] | (inside[1:] != inside[:-1])  # between two code points
    return np.flatnonzero(inside[1:-1] & parts[:-1]), np.flatnonzero(inside[1:-1] & parts[1:]) + 1


class _Sums:
    """Hashes of any run of words of a block in constant time."""

    def __init__(self, words: np.ndarray) -> None:
        size = 1 << max(18, len(words).bit_length())
        self.inverse = _powers(int(_STEP_INVERSE), size)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * _powers(int(_STEP), size)[: len(words)], out=self.sums[1:])

    def raw(self, a: np.ndarray, b: np.ndarray, base: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.inverse[base]

    def hashes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _closed(self.raw(a, b, a), b - a)


def _closed(total: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    return mixed(total + np.asarray(length).astype(np.uint64) * _ODD)


def _line_rows(min_words: int, partner_words: int):
    """(id, line, words, hash, halves) of the judged lines of a block, from texts with an
    (id, part) each; a line's number comes after its text's part."""

    def rows(ids: list[dict], block: Block) -> pa.RecordBatch:
        feeds = np.flatnonzero(block.codes == 10)
        starts, ends = _words(block)
        line = np.searchsorted(feeds, starts)
        cut = np.flatnonzero(np.diff(line, prepend=-1))
        a, b = cut, np.append(cut[1:], len(line))
        if not len(cut):
            a = b = cut
        keep = b - a >= min_words
        a, b = a[keep], b[keep]
        line = line[a]
        text = np.searchsorted(block.ends, starts[a]) if len(a) else a
        number = line - np.searchsorted(feeds, block.starts)[text]
        sums = _Sums(block.hashes(starts, ends))
        n = b - a
        near = np.flatnonzero(n >= partner_words)
        keys = []
        for short in (0, 1):  # halves of this length, and of lines one word shorter
            left = (n[near] - short) // 2
            right = (n[near] - short) - left
            keys.append(sums.hashes(a[near], a[near] + left))
            keys.append(sums.hashes(b[near] - right, b[near]) + np.uint64(1))
        halves = np.stack(keys, axis=1).view(np.int64) if len(near) else np.empty((0, 4), np.int64)
        offsets = np.zeros(len(a) + 1, np.int32)
        offsets[1:] = np.cumsum(np.where(n >= partner_words, 4, 0))
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.array(halves.reshape(-1)))
        columns = [
            pa.array(np.array([x["id"] for x in ids], np.int64)[text]),
            pa.array(number + np.array([x["part"] for x in ids], np.int64)[text]),
            pa.array(n.astype(np.int32)),
            signed(sums.hashes(a, b)),
            listed,
        ]
        return pa.RecordBatch.from_arrays(columns, ["id", "line", "n", "hash", "halves"])

    return by_blocks(rows)


def _line_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The word hashes of named lines: (id, text, lines) to (id, line, words)."""
    for batch in batches:
        for i in range(batch.num_rows):
            lines = batch.column(2)[i].as_py()
            texts = batch.column(1)[i].as_py().split("\n")
            block = Block([texts[k & _LINE] for k in lines])
            starts, ends = _words(block)
            hashes, first = block.hashes(starts, ends), block.first(starts)
            parts = [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
            columns = [
                pa.array([batch.column(0)[i].as_py()] * len(lines), pa.int64()),
                pa.array(lines, pa.int64()),
                binary(parts),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "line", "words"])


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashed line itself (place -1), and without each of its words."""
    for batch in batches:
        for i in range(batch.num_rows):
            words = np.frombuffer(batch.column(2)[i].as_py(), np.uint64)
            sums, n = _Sums(words), len(words)
            place = np.arange(n)
            whole = sums.sums[n]
            rest = sums.sums[place] + (whole - sums.sums[place + 1]) * _STEP_INVERSE
            keys = np.append(_closed(rest, n - 1), _closed(np.array([whole]), n))
            columns = [
                signed(keys),
                pa.array(np.append(place, -1).astype(np.int32)),
                pa.array(np.full(n + 1, batch.column(0)[i].as_py(), np.int64)),
                pa.array(np.full(n + 1, batch.column(1)[i].as_py(), np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "place", "id", "line"])


@F.arrow_udf(BooleanType())
def _within_one(left: pa.Array, right: pa.Array) -> pa.Array:
    """Whether two word sequences are within one insertion, deletion or replacement."""

    def near(x: pa.Scalar, y: pa.Scalar) -> bool:
        a, b = (np.frombuffer(value.as_buffer(), np.uint64) for value in (x, y))
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1:
            return False
        differ = np.flatnonzero(a != b[: len(a)])
        if not len(differ):
            return True
        at = differ[0]
        rest = a[at + 1 :] if len(a) == len(b) else a[at:]
        return np.array_equal(rest, b[at + 1 :])

    return pa.array([near(x, y) for x, y in zip(left, right, strict=True)], pa.bool_())


def _part(text: Column) -> Column:
    """31 bits of a text's hash, above the bits of its lines' numbers."""
    return F.shiftleft(F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit((1 << 31) - 1)), 32)


def _with_parts(docs: DataFrame, bound: int) -> DataFrame:
    """(id, text, part): 0, or by the text's hash where an id has several texts."""
    mark = F.xxhash64("text")
    texts = docs.groupBy("id").agg(F.min(mark).alias("low"), F.max(mark).alias("high"))
    several = staged(texts.where("low != high").select(F.col("id").alias("several")), "repeated-ids")
    found = joined_with(docs, several, F.expr("id = several"), "left", several.count(), bound)
    part = F.when(F.col("several").isNotNull(), _part(F.col("text"))).otherwise(F.lit(0))
    return found.select("id", "text", part.cast("bigint").alias("part"))


def _edited(docs: DataFrame, distinct: DataFrame, edit_words: int, bound: int) -> DataFrame:
    """Distinct lines of ``edit_words`` words at least that have an earlier one within one word
    edit: (id, line, to_id, to_line)."""
    # Lines within one edit share their first or their last half, or one of a line a word
    # shorter. Only lines that share such a key can have a partner, so only these are expanded.
    halves = distinct.select(F.explode(F.array_distinct("halves")).alias("half"), "id", "line")
    shared = halves.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    some = halves.join(shared, "half", "left_semi").select("id", "line").distinct()
    part = F.col("line").bitwiseAND(F.lit(~_LINE)).alias("p")
    by_text = some.groupBy(F.col("id").alias("w"), part)
    wanted = staged(by_text.agg(F.sort_array(F.collect_list("line")).alias("lines")), "lines")
    count = wanted.agg(F.sum(F.size("lines") + 2)).first()[0] or 0
    with_text = joined_with(
        docs, wanted, F.expr("id = w and part = p"), "inner", count, bound
    ).select("id", "text", "lines")
    words = staged(
        with_text.mapInArrow(_line_words, "id bigint, line bigint, words binary")
        .dropDuplicates(["id", "line"]),
        "line-words",
    )
    variants = words.mapInArrow(_variants, "key bigint, place int, id bigint, line bigint")
    groups = variants.groupBy("key", "place").agg(
        F.min(F.struct("id", "line")).alias("first"), F.count("*").alias("n")
    )
    # By key: the earliest line that is the variant itself, and the earliest that becomes it.
    ends = groups.groupBy("key").agg(
        F.min(F.when(F.col("place") < 0, F.col("first"))).alias("itself"),
        F.min(F.when(F.col("place") >= 0, F.col("first"))).alias("shortened"),
        F.sum("n").alias("all"),
    )
    ends = ends.where("all > 1").drop("all")
    best = F.when(F.col("place") < 0, F.col("shortened")).otherwise(F.least("first", "itself"))
    met = (
        groups.join(ends, "key")
        .select("key", "place", best.alias("best"))
        .where("best is not null")
    )
    own = F.struct("id", "line")
    long = words.where(F.length("words") >= 8 * edit_words)  # a hash of 8 bytes for each word
    partners = (
        long.mapInArrow(_variants, "key bigint, place int, id bigint, line bigint")
        .join(met, ["key", "place"])
        .where(F.col("best") < own)
        .groupBy("id", "line")
        .agg(F.min("best").alias("best"))
        .select("id", "line", F.col("best.id").alias("to_id"), F.col("best.line").alias("to_line"))
    )
    others = words.select(
        F.col("id").alias("to_id"), F.col("line").alias("to_line"), F.col("words").alias("others")
    )
    return (
        partners.join(words, ["id", "line"])
        .join(others, ["to_id", "to_line"])
        .where(_within_one("words", "others"))
        .select("id", "line", "to_id", "to_line")
    )


def dropped_lines(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_words: int = MIN_WORDS,
    edit_words: int = EDIT_WORDS,
    edit_bound: int = 1,
    broadcast_lines: int = BROADCAST_LINES,
    partner_words: int | None = None,
) -> DataFrame:
    """(id, part, lines): for each document that loses lines, their numbers, from 0, ascending.

    ``part`` is 0, or for an id of several texts the hash of the one that is meant.
    """
    if edit_bound not in (0, 1):
        raise ValueError("edit_bound must be 0 or 1")
    docs = _with_parts(id_and_text(documents, id_column, text_column), broadcast_lines)
    kinds = "id bigint, line bigint, n int, hash bigint, halves array<bigint>"
    named = docs.select(F.struct("id", "part").alias("id"), "text")
    lines = staged(named.mapInArrow(_line_rows(min_words, edit_words if partner_words is None else partner_words), kinds), "lines")
    first = lines.groupBy("hash").agg(F.min(F.struct("id", "line", "halves")).alias("first"))
    kept = distinct = staged(first.select("first.*"), "distinct-lines")
    if edit_bound:
        edited = _edited(docs, distinct, edit_words, broadcast_lines)
        kept = distinct.join(edited, ["id", "line"], "left_anti")
    gone = lines.select("id", "line").join(kept.select("id", "line"), ["id", "line"], "left_anti")
    part = F.col("line").bitwiseAND(F.lit(~_LINE)).alias("part")
    number = F.col("line").bitwiseAND(F.lit(_LINE)).cast("int")
    return gone.groupBy("id", part).agg(F.array_sort(F.collect_set(number)).alias("lines"))


@F.arrow_udf(StringType())
def _cut(text: pa.Array, lines: pa.Array) -> pa.Array:
    """Texts without the lines of these numbers."""

    def cut(x: str, numbers: list[int]) -> str:
        gone = set(numbers)
        return "\n".join(s for i, s in enumerate(x.split("\n")) if i not in gone)

    rows = zip(text, lines, strict=True)
    return pa.array([cut(x.as_py(), n.as_py()) if x.is_valid else None for x, n in rows], pa.string())


#: A condition on the result would else be moved below it, and every text be cut twice, by two workers.
_without = _cut.asNondeterministic()


def dedup_lines(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_words: int = MIN_WORDS,
    edit_words: int = EDIT_WORDS,
    edit_bound: int = 1,
    broadcast_lines: int = BROADCAST_LINES,
    dropped_column: str = "dropped_lines",
    partner_words: int | None = None,
) -> DataFrame:
    """``documents`` with repeated lines taken out, and the numbers of these in a new column.

    Lines end at line feeds. A line goes when a line of an earlier document, or an earlier
    one of its own, equals it, or has at least ``edit_words`` words and is within
    ``edit_bound`` word edits (0 or 1) of it. The earlier line of an edit has
    ``partner_words`` words at least, by default ``edit_words``; one less finds all. Earlier means a smaller (id, line). Lines of
    fewer than ``min_words`` words stay, and those without a letter or digit. The earliest of a chain always stays.

    Rows without an id are returned as they are; equal rows share one verdict, and of texts of
    one id that with the smaller hash is earlier. Null and empty texts stay, and an empty table is
    returned as it is. ``dropped_column`` is null where nothing went; a column of
    that name is replaced. Other columns pass through, whatever their names.

    Shuffled are hashes of lines, not texts; only lines that share half of their words with
    another give variants. Frequent lines are sums by key before they travel. The numbers of
    dropped lines are broadcast up to ``broadcast_lines`` of them, else joined by shuffle.
    """
    one, two, three = (free_name(documents, name) for name in ("id", "part", "lines"))
    gone = staged(
        dropped_lines(
            documents, id_column, text_column, min_words, edit_words, edit_bound, broadcast_lines, partner_words
        ),
        "dropped-lines",
    ).select(F.col("id").alias(one), F.col("part").alias(two), F.col("lines").alias(three))
    count = gone.agg(F.sum(F.size(three) + 2)).first()[0] or 0
    text, lines = F.col(f"`{text_column}`"), F.col(three)
    same = F.col(f"`{id_column}`").cast("bigint") == F.col(one)
    same = same & ((F.col(two) == 0) | (F.col(two) == _part(text)))
    changed = joined_with(documents, gone, same, "left", count, broadcast_lines)
    cut = _without(F.when(lines.isNotNull(), text), lines)
    kept = F.when(lines.isNotNull(), cut).otherwise(text)
    names = [c for c in documents.columns if c.lower() != dropped_column.lower()]
    columns = [kept.alias(c) if c == text_column else F.col(f"`{c}`") for c in names]
    return changed.select(*columns, lines.alias(dropped_column))
