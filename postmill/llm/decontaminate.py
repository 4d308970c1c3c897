"""Benchmark decontamination: copied passages, and questions with other numbers or names.

Each text gives two rows of tokens. In the literal one a token is a word in lower case; in
the template one, numbers, units and names are typed placeholders. A capitalised word that
opens a sentence may be a name or not, so templates are read both ways, and either reading
may match. Windows of all are
hashed and joined by hash with those of the benchmark items; matching windows that lie on
one line of (place in document - place in item) form a run. The slots of a template run
must be filled consistently: equal values where the item has equal ones. Where one slot
contradicts another, the run is parted into its longest consistent pieces, and a piece
counts if a value that it repeats is filled equally, as a bare piece of a question whose
filling is known to be wrong says nothing.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.staging import free_name, id_and_text, joined_with, staged
from postmill.llm.words import _STEP, Block, by_blocks, mixed, signed, table, windows

WINDOW = 8
ANCHOR = 4  # tokens by which a window of few plain tokens is found
MIN_LITERALS = 5  # of a template window, tokens that are not placeholders
BENCHMARK_CHARS = 8 << 20  # a benchmark up to this size is sent to every task
BROADCAST_IDS = 1_000_000

# Words that are read as numbers, and words that are units after a number.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
    "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy "
    "eighty ninety hundred thousand million billion"
).split()
UNIT_WORDS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles meter meters metre "
    "metres kilometer kilometers mg g kg gram grams kilogram kilograms ton tons oz ounce ounces "
    "lb lbs pound pounds ml l liter liters litre litres gallon gallons ms s sec second seconds "
    "min minute minutes h hr hour hours day days week weeks month months year years mph kmh "
    "percent cent cents dollar dollars usd euro euros eur degree degrees celsius fahrenheit"
).split()

_PLAIN, _NUMBER, _UNIT, _NAME = 0, 1, 2, 3
_MARKS = mixed(np.arange(1, 4, dtype=np.uint64) << np.uint64(50))
_RESULT = "id bigint, item_id bigint, kind string, start bigint, stop bigint, words bigint"


class Tokens(NamedTuple):
    """Tokens of a block: their spans, keys, types, and the first one of each text."""

    starts: np.ndarray
    ends: np.ndarray
    keys: np.ndarray
    types: np.ndarray
    first: np.ndarray


def _word_set(words: list[str]) -> np.ndarray:
    block = Block(words)
    return np.sort(block.hashes(*block.words()))


_NUMBERS, _UNITS = _word_set(NUMBER_WORDS), _word_set(UNIT_WORDS)


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.searchsorted(ordered, values).clip(max=len(ordered) - 1)] == values


def _literal(block: Block) -> Tokens:
    starts, ends = block.words()
    hashes = block.hashes(starts, ends)
    return Tokens(starts, ends, hashes, np.zeros(len(starts), np.int8), block.first(starts))


def _template(block: Block, literal: Tokens, opened: bool) -> Tokens:
    """Typed tokens. Digits joined by a point or comma are one number; a unit follows a
    number; a name is a capitalised word with those that follow it directly. The first
    word of a sentence is one only if ``opened``."""
    starts, ends, codes = literal.starts, literal.ends, block.codes
    if not len(starts):
        return literal
    digits = np.concatenate(([0], np.cumsum(table("digit")[codes])))
    number = (digits[ends] - digits[starts]) == ends - starts
    number |= _member(literal.keys, _NUMBERS)
    stops = np.concatenate(([0], np.cumsum(np.isin(codes, [ord(c) for c in ".!?:;\n|"]))))
    before = np.concatenate(([0], ends[:-1]))
    opening = stops[starts] > stops[before]
    opening[0] = True
    name = table("upper")[codes[starts]] & ~number
    if not opened:
        name &= ~opening
    after_number = np.concatenate(([False], number[:-1])) & ~opening
    unit = after_number & _member(literal.keys, _UNITS)
    types = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, _PLAIN)))
    point = np.isin(codes[before], [ord("."), ord(",")]) & (starts - before == 1)
    same = types[1:] == types[:-1]
    joins = np.zeros(len(types), bool)
    joins[1:] = same & (((types[1:] == _NUMBER) & point[1:]) | ((types[1:] == _NAME) & ~opening[1:]))
    joins[literal.first[:-1][literal.first[:-1] < len(joins)]] = False
    head = np.flatnonzero(~joins)
    last = np.append(head[1:], len(types)) - 1
    keys = np.where(types == _PLAIN, literal.keys, _MARKS[np.maximum(types, 1) - 1])
    first = np.searchsorted(head, literal.first)
    return Tokens(starts[head], ends[last], keys[head], types[head].astype(np.int8), first)


def _readings(block: Block) -> dict[str, Tokens]:
    """The tokens of each reading; both ``template`` and ``opened`` give template runs."""
    literal = _literal(block)
    return {
        "exact": literal,
        "template": _template(block, literal, False),
        "opened": _template(block, literal, True),
    }


def _windows(tokens: Tokens, n: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows within one text that have ``least`` plain tokens."""
    count = len(tokens.keys) - n + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    place = np.arange(count)
    text_end = tokens.first[np.searchsorted(tokens.first, place, "right").clip(max=len(tokens.first) - 1)]
    total = np.concatenate(([0], np.cumsum(tokens.types == _PLAIN)))
    plain = total[n:] - total[:-n]
    ok = (place + n <= text_end) & (plain >= least)
    return place[ok], windows(tokens.keys, n)[ok]


def _polynomial(keys: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
    """What ``windows`` mixes, at some places only."""
    total = np.zeros(len(places), np.uint64)
    for k in range(n):
        total = total * _STEP + keys[places + k]
    return total


class Shape(NamedTuple):
    """A kind of windows. Those of an ``anchor`` are not windows themselves, but the tokens by which
    sparse windows, with few plain tokens and of any size, are found."""

    reading: str
    size: int
    anchor: bool


def _found(tokens: Tokens, shape: Shape, min_literals: int) -> tuple[np.ndarray, np.ndarray]:
    if shape.reading == "exact":
        return _windows(tokens, shape.size, 0)
    return _windows(tokens, shape.size, 1 if shape.anchor else min(min_literals, shape.size))


def _anchor(tokens: Tokens, a: int, b: int) -> tuple[int, int]:
    """Of a sparse window, the first ``ANCHOR`` tokens in a row with the most plain ones, at least
    one: their place and number."""
    size = min(ANCHOR, b - a)
    total = np.concatenate(([0], np.cumsum(tokens.types[a:b] == _PLAIN)))
    return a + int(np.argmax(total[size:] - total[:-size])), size


def _item_windows(tokens: Tokens, reading: str, n: int, min_literals: int) -> set[tuple[int, int, bool]]:
    """(start, end, sparse) of the windows of one item, which leave none of its tokens out.

    An item that is shorter than ``n`` is one window. A template window that has not enough
    plain tokens grows to the right until it has, then to the left, up to the whole item.
    """
    count = len(tokens.keys)
    if reading == "exact":
        size = min(n, count)
        return {(p, p + size, False) for p in range(count - size + 1)} if size else set()
    total = np.concatenate(([0], np.cumsum(tokens.types == _PLAIN)))
    found = set()
    for p in range(max(1, count - n + 1) if total[-1] else 0):
        a, b = p, min(p + n, count)
        if total[b] - total[a] >= min(min_literals, b - a):
            found.add((a, b, False))
            continue
        b = max(b, min(count, int(np.searchsorted(total, total[a] + min_literals))))
        if total[b] - total[a] < min_literals:
            a = max(0, int(np.searchsorted(total, total[b] - min_literals, "right")) - 1)
        found.add((a, b, True))
    return found


def _item_keys(tokens: Tokens, reading: str, n: int, min_literals: int) -> Iterator[tuple[Shape, int, int, int, int]]:
    """(shape, hash, place, start, end) by which a text's tokens are looked up: of each window of an
    item the window itself, or its anchor."""
    for a, b, sparse in sorted(_item_windows(tokens, reading, n, min_literals)):
        place, size = _anchor(tokens, a, b) if sparse else (a, b - a)
        (key,) = mixed(_polynomial(tokens.keys, np.array([place]), size)).tolist()
        yield Shape(reading, size, sparse), key, place, a, b


class Item(NamedTuple):
    number: int
    values: list[str]
    types: list[int]
    keys: np.ndarray


class Index:
    """The windows of benchmark items, by shape.

    There are few shapes whatever the items are: windows of up to ``n`` tokens, and anchors of up
    to ``ANCHOR``. So a text is hashed a bounded number of times, and sparse windows cost only where
    their anchor stands.
    """

    def __init__(self, ids: list[int], texts: list[str], n: int, min_literals: int) -> None:
        self.ids = ids
        self.items: dict[str, list[Item]] = defaultdict(list)
        held: dict[Shape, list] = defaultdict(list)
        self.min_literals = min_literals
        for number, text in enumerate(texts):
            block = Block([text])
            for kind, tokens in _readings(block).items():
                low = text.lower() if len(text.lower()) == len(text) else text
                spans = zip(tokens.starts.tolist(), tokens.ends.tolist(), strict=True)
                values = [low[a:b] for a, b in spans]
                self.items[kind].append(Item(number, values, tokens.types.tolist(), tokens.keys))
                for shape, key, place, a, b in _item_keys(tokens, kind, n, min_literals):
                    held[shape].append((key, number, place, a, b))
        self.tables = {}
        for shape, rows in held.items():
            rows.sort()
            self.tables[shape] = (np.array([r[0] for r in rows], np.uint64), [r[1:] for r in rows])

    def matches(self, block: Block) -> Iterator[tuple]:
        """(text, item, kind, start, stop, words) of the runs in the block's texts."""
        by_kind = _readings(block)
        lines: dict[tuple, set[tuple[int, int]]] = defaultdict(set)
        for shape, (hashes, entries) in self.tables.items():
            tokens = by_kind[shape.reading]
            places, found = _found(tokens, shape, self.min_literals)
            hit = np.flatnonzero(_member(found, hashes))
            if not len(hit):
                continue
            places, found = places[hit], found[hit]
            low, high = np.searchsorted(hashes, found, "left"), np.searchsorted(hashes, found, "right")
            text = np.searchsorted(tokens.first, places, "right") - 1
            items = self.items[shape.reading]
            for p, t, i, j in zip(places.tolist(), text.tolist(), low.tolist(), high.tolist(), strict=True):
                for number, place, a, b in entries[i:j]:
                    begin, end = p - place + a, p - place + b
                    if shape.anchor and not (
                        tokens.first[t] <= begin
                        and end <= tokens.first[t + 1]
                        and np.array_equal(tokens.keys[begin:end], items[number].keys[a:b])
                    ):
                        continue
                    lines[shape.reading, t, number, p - place].add((begin, end))
        for (kind, t, number, shift), found_at in lines.items():
            for run in _runs(found_at):
                yield from self._run(block, by_kind[kind], kind, t, number, shift, run)

    def _run(self, block, tokens, kind, t, number, shift, run) -> Iterator[tuple]:
        offset = int(block.starts[t])
        begin, end = run[0][0], max(stop for _, stop in run)
        pieces = [(begin, end)]
        if kind != "exact":
            item = self.items[kind][number]
            text = block.texts[t]
            slots = []
            for k in range(begin, end):
                if item.types[k - shift] != _PLAIN:
                    mine = text[int(tokens.starts[k]) - offset : int(tokens.ends[k]) - offset]
                    slots.append((k, (item.types[k - shift], item.values[k - shift]), mine.lower()))
            pieces = _consistent(slots, run, begin, end)
        for begin, end in pieces:
            a, b = int(tokens.starts[begin]) - offset, int(tokens.ends[end - 1]) - offset
            yield t, self.ids[number], "exact" if kind == "exact" else "template", a, b, end - begin


def _runs(windows: Iterable[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Windows that overlap or adjoin, as lists in their order."""
    run: list[tuple[int, int]] = []
    reach = 0
    for window in sorted(windows):
        if run and window[0] > reach:
            yield run
            run, reach = [], 0
        run.append(window)
        reach = max(reach, window[1])
    if run:
        yield run


def _consistent(slots: list[tuple], run: list[tuple[int, int]], begin: int, end: int) -> list[tuple[int, int]]:
    """The run, if each value of the item is filled in one way; else those of its longest
    consistent pieces that have a whole window and fill a repeated value equally."""
    pieces, start, first = [], begin, 0  # the piece's first token, and its first slot
    last: dict[tuple, int] = {}  # by value of the item, the last slot with it
    for i, (k, value, mine) in enumerate(slots):
        j = last.get(value, -1)
        if j >= first and slots[j][2] != mine:
            pieces.append((start, k, first, i))
            start, first = slots[j][0] + 1, j + 1
        last[value] = i
    if not pieces:
        return [(begin, end)]
    pieces.append((start, end, first, len(slots)))
    kept = []
    for start, stop, i, j in pieces:
        inside = [w for w in run if start <= w[0] and w[1] <= stop]
        for part in _runs(inside):
            a, b = part[0][0], max(w[1] for w in part)
            values = [value for k, value, _ in slots[i:j] if a <= k < b]
            if len(set(values)) < len(values):
                kept.append((a, b))
    return kept


def _best(rows: Iterator[tuple]) -> list[tuple]:
    """The longest run of each text, item and kind; of equal ones, the first."""
    best: dict[tuple, tuple] = {}
    for row in rows:
        old = best.get(row[:3])
        if old is None or (-row[5], row[3]) < (-old[5], old[3]):
            best[row[:3]] = row
    return list(best.values())


def _batch(ids: list[int], rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    columns = [list(c) for c in zip(*[(ids[r[0]], *r[1:]) for r in rows], strict=True)] or [[]] * 6
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in _RESULT.split(", ")])


def _hash_rows(min_literals: int, shapes: list[Shape]):
    """(hash, id) of all windows of the wanted shapes."""

    def work(ids: list[int], block: Block) -> pa.RecordBatch:
        by_kind = _readings(block)
        hashes, owners = [], []
        for shape in shapes:
            tokens = by_kind[shape.reading]
            places, found = _found(tokens, shape, min_literals)
            hashes.append(found)
            owners.append(np.array(ids, np.int64)[np.searchsorted(tokens.first, places, "right") - 1])
        return pa.RecordBatch.from_arrays(
            [signed(np.concatenate(hashes)), pa.array(np.concatenate(owners))], ["hash", "id"]
        )

    return by_blocks(work)


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    min_literals: int = MIN_LITERALS,
    benchmark_chars: int = BENCHMARK_CHARS,
) -> DataFrame:
    """(id, item_id, kind, start, stop, words): the longest run of each item in each document.

    ``kind`` is ``exact`` or ``template``; ``start`` and ``stop`` are code points of the
    document, ``words`` the run's tokens. A run has ``window`` tokens at least, or all
    tokens of a shorter item; each window of a template run has ``min_literals`` tokens
    that are not placeholders. A stretch of an item where ``window`` tokens have fewer of
    them must match over as many more tokens as it takes, at most over the whole item. An
    item that has only placeholders has no template.

    Null and empty texts and items, and rows without an id, match nothing; repeated rows give
    repeated results, repeated items one. Empty tables give an empty result. Only the named
    columns are read.

    The benchmark's size is checked: up to ``benchmark_chars`` characters it is sent to all
    tasks, and the documents are read once without a shuffle. A larger one is joined by
    window hash, and the texts of the pairs that share one are compared in the same way.
    """
    docs = id_and_text(documents, id_column, text_column)
    items = id_and_text(benchmark, item_column, item_text).dropDuplicates(["id"])
    size = items.agg(F.sum(F.length("text") + 16)).first()[0] or 0
    if size <= benchmark_chars:
        rows = items.orderBy("id").collect()  # of checked size
        index = Index([r.id for r in rows], [r.text for r in rows], window, min_literals)
        sent = docs.sparkSession.sparkContext.broadcast(index)

        def work(ids: list[int], block: Block) -> pa.RecordBatch:
            return _batch(ids, _best(sent.value.matches(block)))

        found = docs.mapInArrow(by_blocks(work), _RESULT)
    else:
        found = _by_join(docs, items, window, min_literals)
    return found.withColumnsRenamed({"id": id_column})


def _by_join(docs: DataFrame, items: DataFrame, window: int, min_literals: int) -> DataFrame:
    """The same result through a join by window hash, for a benchmark of any size."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = {
                    (*shape, key)
                    for reading, tokens in _readings(Block([text])).items()
                    for shape, key, *_ in _item_keys(tokens, reading, window, min_literals)
                }
                columns = list(zip(*sorted(rows), strict=True)) or [[]] * 4
                kinds = [pa.string(), pa.int64(), pa.bool_(), pa.uint64()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                arrays[3] = signed(arrays[3].to_numpy())
                arrays.append(pa.array([number] * len(rows), pa.int64()))
                yield pa.RecordBatch.from_arrays(arrays, [*Shape._fields, "hash", "item"])

    kinds = "reading string, size bigint, anchor boolean, hash bigint, item bigint"
    of_items = staged(items.mapInArrow(keys, kinds), "item-windows")
    # Three readings times ``window`` sizes, and two times ``ANCHOR``, at most.
    wanted = sorted(Shape(*r) for r in of_items.select(*Shape._fields).distinct().collect())
    of_docs = docs.mapInArrow(_hash_rows(min_literals, wanted), "hash bigint, id bigint")
    by_hash = of_items.select("hash", "item").distinct()
    pairs = staged(of_docs.join(by_hash, "hash").select("id", "item").distinct(), "leak-pairs")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["item"] != last or index is None:  # the rows are in the order of items
                    last = row["item"]
                    index = Index([last], [row["item_text"]], window, min_literals)
                yield _batch([row["id"]], _best(index.matches(Block([row["text"]]))))

    texts = items.select(F.col("id").alias("item"), F.col("text").alias("item_text"))
    both = docs.join(pairs, "id").join(texts, "item").select("id", "text", "item", "item_text")
    return both.sortWithinPartitions("item").mapInArrow(compare, _RESULT)


def drop_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    broadcast_ids: int = BROADCAST_IDS,
    **options,
) -> DataFrame:
    """``documents`` without those that hold a passage or a re-parameterised question of the
    benchmark; rows without an id stay."""
    leaks = find_leaks(documents, benchmark, id_column, **options)
    name = free_name(documents, "leak")
    ids = staged(leaks.select(F.col(f"`{id_column}`").alias(name)).distinct(), "leaks")
    same = F.col(f"`{id_column}`").cast("bigint") == F.col(name)
    return joined_with(documents, ids, same, "left_anti", ids.count(), broadcast_ids)
