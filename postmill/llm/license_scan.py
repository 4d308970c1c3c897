"""License scans: templates with optional and replaceable regions, as token automata.

A template's words become the positions of an automaton, one bit each. A literal position
takes its own word, a replaceable region is a run of positions that take any word, and an
optional region may be skipped. A text is accepted at a place if every mandatory word of the
template stands there, in order and with nothing between, so a changed word is no match.

Automata run only where a template's anchor stands, its longest literal run outside all
regions: one forward from the anchor, and one over the reversed template backward from it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.license_templates import PHRASES, TEMPLATES
from postmill.llm.staging import prepare
from postmill.llm.words import Block, by_blocks, windows

ANCHOR_WORDS = 5  # of an anchor's run, as many are looked for by hash
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_MARK = re.compile(r"<<(optional|end|var;\d+;\d+)>>")
_PLACE = "struct<kind:string,label:string,start:bigint,stop:bigint,mandatory:int>"
_KINDS = f"id bigint, n_words bigint, places array<{_PLACE}>"


class Var(NamedTuple):
    """A replaceable region of ``low`` to ``high`` words."""

    low: int
    high: int


class Optional(NamedTuple):
    """A region that may be left out."""

    parts: tuple


def text_words(text: str) -> list[str]:
    """Words of a text: runs of digits, letters a to z after lower-casing A-Z, and signs beyond ASCII."""
    return _WORD.findall(text.translate(_LOWER))


def parse_template(markup: str) -> tuple:
    """Words, ``Var`` and ``Optional`` in order. Wrong markup is a ``ValueError``."""
    stack: list[list] = [[]]
    at = 0
    for mark in _MARK.finditer(markup):
        stack[-1].extend(text_words(markup[at : mark.start()]))
        at = mark.end()
        name, *bounds = mark.group(1).split(";")
        if name == "optional":
            stack.append([])
        elif name == "var":
            low, high = map(int, bounds)
            if low > high or not high:
                raise ValueError(f"no region of {low} to {high} words")
            stack[-1].append(Var(low, high))
        elif len(stack) == 1:
            raise ValueError("an end without its start")
        else:
            parts = tuple(stack.pop())
            stack[-1].append(Optional(parts))
    stack[-1].extend(text_words(markup[at:]))
    if len(stack) > 1:
        raise ValueError("an optional region without an end")
    return tuple(stack[0])


def reversed_parts(parts: Sequence) -> tuple:
    return tuple(
        Optional(reversed_parts(p.parts)) if isinstance(p, Optional) else p for p in reversed(parts)
    )


class Automaton:
    """Positions as bits: ``takes`` by word, ``any`` for those that take every word, and
    ``skips`` from any of some positions to a later one, by their first position."""

    def __init__(self, parts: Sequence) -> None:
        self.takes: dict[str, int] = {}
        self.any = 0
        self.size = 0
        self.skips: list[tuple[int, int]] = []
        self._add(parts)
        self.skips.sort(key=lambda s: s[0] & -s[0])
        self.end = 1 << self.size
        self.start = self._closed(1)

    def _add(self, parts: Sequence) -> None:
        for part in parts:
            begin = self.size
            if isinstance(part, Var):
                self.any |= ((1 << part.high) - 1) << begin
                self.size += part.high
                free = ((1 << (part.high - part.low)) - 1) << (begin + part.low)
                if free:
                    self.skips.append((free, 1 << self.size))
            elif isinstance(part, Optional):
                self._add(part.parts)
                if self.size > begin:
                    self.skips.append((1 << begin, 1 << self.size))
            else:
                self.takes[part] = self.takes.get(part, 0) | 1 << begin
                self.size += 1

    def _closed(self, active: int) -> int:
        for source, target in self.skips:
            if active & source:
                active |= target
        return active

    def longest(self, words: Sequence[str]) -> int | None:
        """How many of the first ``words`` the longest accepted run has, or None."""
        active, best = self.start, None
        for count, word in enumerate(words):
            if active & self.end:
                best = count
            active &= self.any | self.takes.get(word, 0)
            if not active:
                return best
            active = self._closed(active << 1)
        return len(words) if active & self.end else best


class Template:
    """A compiled template: its anchor, and the automata before and after the anchor's start."""

    def __init__(self, label: str, markup: str) -> None:
        self.label = label
        self.parts = parse_template(markup)
        runs, begin = [], None
        for i, part in enumerate((*self.parts, None)):
            if isinstance(part, str):
                begin = i if begin is None else begin
            elif begin is not None:
                runs.append((begin - i, begin, i))
                begin = None
        if not runs:
            raise ValueError(f"the template of {label} has no word outside its regions")
        _, begin, end = min(runs)
        self.anchor = self.parts[begin : min(end, begin + ANCHOR_WORDS)]
        self.before = Automaton(reversed_parts(self.parts[:begin]))
        self.after = Automaton(self.parts[begin:])
        self.mandatory = mandatory_words(self.parts)

    def place(self, words: Sequence[str], anchor: int) -> tuple[int, int] | None:
        """The longest place with its anchor at ``anchor``, as start and end among ``words``."""
        ahead = self.after.longest(words[anchor : anchor + self.after.size])
        if ahead is None:
            return None
        back = self.before.longest(words[max(0, anchor - self.before.size) : anchor][::-1])
        return None if back is None else (anchor - back, anchor + ahead)


def mandatory_words(parts: Sequence) -> int:
    """Words that every accepted text has, replaceable ones by their least number."""
    sizes = (1 if isinstance(p, str) else p.low if isinstance(p, Var) else 0 for p in parts)
    return sum(sizes)


@lru_cache(4)
def compiled(templates: tuple[tuple[str, str], ...]) -> tuple[Template, ...]:
    return tuple(Template(label, markup) for label, markup in templates)


def _word_spans(block: Block) -> tuple[np.ndarray, np.ndarray]:
    codes = block.codes
    low = codes | np.uint32(32)
    inside = ((codes >= 48) & (codes < 58)) | ((low >= 97) & (low < 123)) | (codes >= 128)
    return block.spans(inside)


@lru_cache(4)
def _key_tables(phrases: tuple[tuple[str, ...], ...]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: the sorted hashes of the phrases of so many words, and their numbers."""
    tables = {}
    for n in sorted({len(p) for p in phrases}):
        numbers = [i for i, p in enumerate(phrases) if len(p) == n]
        hashes = []
        for i in numbers:
            block = Block([" ".join(phrases[i])])
            hashes.append(windows(block.hashes(*_word_spans(block), "ascii"), n)[0])
        order = np.argsort(hashes, kind="stable")
        tables[n] = (np.array(hashes, np.uint64)[order], np.array(numbers)[order])
    return tables


def phrase_places(block: Block, spans, phrases: tuple[tuple[str, ...], ...]) -> list[list[tuple[int, int]]]:
    """For each text, (first word, phrase number) wherever a phrase's words stand in a row.

    Hashes find the places, the words themselves decide.
    """
    starts, ends = spans
    hashes = block.hashes(starts, ends, "ascii")
    first = block.first(starts)
    found: list[list[tuple[int, int]]] = [[] for _ in block.texts]
    for n, (keys, numbers) in _key_tables(phrases).items():
        seen = windows(hashes, n)
        place = np.searchsorted(keys, seen)
        hit = np.flatnonzero(keys[np.minimum(place, len(keys) - 1)] == seen)
        owner = np.searchsorted(first, hit, "right") - 1
        whole = hit + n <= first[owner + 1]
        for at, text in zip(hit[whole].tolist(), owner[whole].tolist(), strict=True):
            own = words_of(block, spans, text, at, at + n)
            key = place[at]
            while key < len(keys) and keys[key] == seen[at]:
                if own == list(phrases[numbers[key]]):
                    found[text].append((at - int(first[text]), int(numbers[key])))
                key += 1
    return found


def words_of(block: Block, spans, text: int, begin: int, end: int) -> list[str]:
    """The words number ``begin`` to ``end`` of a block, which belong to one text."""
    starts, ends = spans
    source, shift = block.texts[text], int(block.starts[text])
    pairs = zip(starts[begin:end].tolist(), ends[begin:end].tolist(), strict=True)
    return [source[a - shift : b - shift].translate(_LOWER) for a, b in pairs]


def _scan(phrases: tuple[tuple[str, str], ...], templates: tuple[tuple[str, str], ...]):
    names = tuple(label for _, label in phrases)
    sought = tuple(tuple(text_words(p)) for p, _ in phrases)

    def work(ids: list[int | None], block: Block) -> pa.RecordBatch:
        machines = compiled(templates)
        spans = _word_spans(block)
        first = block.first(spans[0])
        keys = (*sought, *(m.anchor for m in machines))
        places = []
        for text, hits in enumerate(phrase_places(block, spans, keys)):
            rows = []
            taken: dict[int, int] = {}  # by template, where its last place ends
            for at, number in sorted(hits):
                if number < len(sought):
                    rows.append(("base", names[number], at, at + len(sought[number]), len(sought[number])))
                    continue
                machine = machines[number - len(sought)]
                begin, end = int(first[text]), int(first[text + 1])
                low = max(begin, begin + at - machine.before.size)
                near = words_of(block, spans, text, low, min(end, begin + at + machine.after.size))
                place = machine.place(near, begin + at - low)
                if place is None:
                    continue
                start, stop = (low - begin + x for x in place)
                if start >= taken.get(number, 0):
                    taken[number] = stop
                    rows.append(("template", machine.label, start, stop, machine.mandatory))
            rows.sort(key=lambda r: (r[2], r[3], r[0], r[1]))
            fields = ("kind", "label", "start", "stop", "mandatory")
            places.append([dict(zip(fields, r, strict=True)) for r in rows])
        kind = pa.list_(
            pa.struct(
                [("kind", pa.string()), ("label", pa.string()), ("start", pa.int64()),
                 ("stop", pa.int64()), ("mandatory", pa.int32())]
            )
        )
        columns = [pa.array(ids, pa.int64()), pa.array(np.diff(first)), pa.array(places, kind)]
        return pa.RecordBatch.from_arrays(columns, ["id", "n_words", "places"])

    return by_blocks(work)


def scan_licenses(
    documents: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    phrases: dict[str, str] = PHRASES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n_words, places): one row for each document, with where license wording stands.

    A place has ``kind`` (``base`` for one of the ``phrases``, ``template``), ``label``, the
    word numbers ``start`` and ``stop`` (exclusive) in the whole text, and ``mandatory``, how
    many words had to match. Phrases count at every place, also overlapping ones. A template
    counts at its longest place around an anchor, and not again before that place ends; places
    of different templates may overlap. Places are in the order of their starts.

    Words are runs of digits, letters (A-Z lower-cased) and all signs beyond ASCII, so
    punctuation never matters. Null and empty texts have no words and an empty list. A null id
    and repeated rows are scanned like any other row. An empty table gives an empty result.
    Only the two named columns are read. Wrong markup is a ``ValueError``.

    No shuffle: a task holds one block of texts, or one longer text, and an automaton reads no
    more words around an anchor than its template can have.
    """
    prepare(documents.sparkSession)
    templates = tuple((label, markup) for label, markup in templates)
    compiled(templates)
    two = documents.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    )
    found = two.mapInArrow(_scan(tuple(phrases.items()), templates), _KINDS)
    return found.withColumnRenamed("id", id_column)
