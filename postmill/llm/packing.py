"""Packing: sum-of-squares online packing of tokenized documents into fixed windows.

Each task packs the documents of its partition one by one. A level array counts the open
windows by how full they are, and a document goes where the sum of the squared counts
grows least. Documents may be cut, so full windows are cut off a long one at once, and
windows that stay open are filled up from the emptiest ones.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.staging import prepare
from postmill.llm.word_tokens import WordTokenizer
from postmill.llm.words import release, text_blocks

WINDOW = 4096
END_ID = 2
MAX_OPEN = 256  # windows a task keeps open before it fills them up
_OUT_BYTES = 1 << 20
_PIECES = (
    "id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, sequence_tokens bigint, padded_tokens bigint, token_bytes binary"
)


class Piece(NamedTuple):
    doc: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, size: int) -> tuple[Piece, Piece]:
        head, tail = self.ids[:size], self.ids[size:]
        return self._replace(ids=head), self._replace(ids=tail, start=self.start + size)


class Packer:
    """The open windows of one task; ``add`` and ``finish`` return closed ones."""

    def __init__(self, window: int = WINDOW, max_open: int = MAX_OPEN) -> None:
        self.window, self.max_open = window, max_open
        self.count = np.zeros(window + 1, np.int64)
        self.at: dict[int, list[list[Piece]]] = defaultdict(list)
        self.open = 0

    def _level(self, size: int) -> int:
        """The level to put ``size`` ids on: least growth of the sum of squares, fullest first."""
        room = self.window - size
        here, then = self.count[1 : room + 1], self.count[size + 1 : self.window + 1]
        growth = 2 * (then - here) + 2
        growth[-1:] -= 1  # a window that gets full leaves the array
        growth = np.where(here > 0, growth, np.iinfo(np.int64).max)
        best = room - 1 - int(growth[::-1].argmin()) if room else 0
        if not room or growth[best] >= 2 * self.count[size] + 1:
            return 0
        return best + 1

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece.ids) >= self.window:
            head, piece = piece.cut(self.window)
            yield [head]
        size = len(piece.ids)
        if not size:
            return
        level = self._level(size)
        held: list[Piece] = []
        if level:
            held = self.at[level].pop()
            self.count[level] -= 1
            self.open -= 1
        held.append(piece)
        if level + size == self.window:
            yield held
            return
        self.at[level + size].append(held)
        self.count[level + size] += 1
        self.open += 1
        if self.open > self.max_open:
            yield from self._settle()

    def _settle(self) -> Iterator[list[Piece]]:
        """Fill the fullest windows with pieces of the emptiest, until one at most is open."""
        levels = sorted((k for k, v in self.at.items() if v), reverse=True)
        queue = [(k, held) for k in levels for held in self.at[k]]
        self.at.clear()
        self.count[:] = 0
        self.open = 0
        first, last = 0, len(queue) - 1
        while first < last:
            level, held = queue[first]
            while level < self.window and first < last:
                other, donor = queue[last]
                piece = donor.pop()
                size = min(len(piece.ids), self.window - level)
                if size < len(piece.ids):
                    head, piece = piece.cut(len(piece.ids) - size)
                    donor.append(head)
                held.append(piece)
                level += size
                queue[last] = (other - size, donor)
                last -= not donor
            queue[first] = (level, held)
            if level == self.window:
                yield held
                first += 1
        if first == last:
            level, held = queue[first]
            if level == self.window:
                yield held
            elif level:
                self.at[level].append(held)
                self.count[level] += 1
                self.open += 1

    def finish(self) -> Iterator[list[Piece]]:
        """Close all windows. The last one is cut into powers of two, which need no padding."""
        yield from self._settle()
        rest = next((held for v in self.at.values() for held in v), [])
        self.at.clear()
        self.count[:] = 0
        self.open = 0
        left = sum(len(piece.ids) for piece in rest)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            held = []
            while size:
                piece, rest = rest[0], rest[1:]
                if len(piece.ids) > size:
                    piece, tail = piece.cut(size)
                    rest = [tail, *rest]
                held.append(piece)
                size -= len(piece.ids)
            yield held


def _padded(size: int, window: int) -> int:
    return size if size & (size - 1) == 0 else window


def pack_documents(
    documents: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    max_open: int = MAX_OPEN,
    end_id: int = END_ID,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pieces of all documents: which ids of which document stand where in which sequence.

    Columns: the id; ``start`` (its document's ids before the piece), ``length``,
    ``doc_tokens`` (with ``end_id``, which ends every document), ``sequence_id``, ``offset``
    (in the sequence, without gaps), ``sequence_tokens``, ``padded_tokens`` (the window,
    or the sequence's own length where that is a power of two) and ``token_bytes`` (the ids,
    unsigned 32-bit, little-endian).

    A null or empty text is one ``end_id``; a null id and repeated rows are packed like any
    other row; a very long text becomes many full windows; an empty table gives no pieces.
    Only the two named columns are read.

    No shuffle: a task holds a block of texts, ``max_open`` windows at most and one level
    array. Its result depends only on its rows in their order, so a task that is run again
    gives the same sequences; sequence ids hold the partition's number.
    """
    prepare(documents.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_path)  # with its store of words, for this task
        packer = Packer(window, max_open)
        sequence = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*rows, strict=True)]
            kinds = [pa.int64()] * 8 + [pa.binary()]
            names = [x.split()[0] for x in _PIECES.split(", ")]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        def closed(sequences: Iterator[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, held, rows
            for pieces in sequences:
                offset, total = 0, sum(len(p.ids) for p in pieces)
                for p in pieces:
                    size = len(p.ids)
                    content = p.ids.astype("<u4", copy=False).tobytes()
                    rows.append(
                        (p.doc, p.start, size, p.doc_tokens, sequence, offset, total,
                         _padded(total, window), content)
                    )
                    offset += size
                held += 4 * total
                sequence += 1
                if held >= _OUT_BYTES:
                    yield flush()
                    rows, held = [], 0

        for batch in batches:
            for ids, block in text_blocks(batch):
                for number, found in zip(ids, tokenizer.encode(block.texts), strict=True):
                    found = np.append(found, np.uint32(end_id))
                    yield from closed(packer.add(Piece(number, 0, found, len(found))))
        del tokenizer
        yield from closed(packer.finish())
        if rows:
            yield flush()
        release()

    two = documents.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    )
    return two.mapInArrow(pack, _PIECES).withColumnRenamed("id", id_column)

