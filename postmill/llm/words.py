"""Words and their hashes over blocks of texts, in numpy.

A block is a number of whole texts laid end to end as code points, with a line feed after
each. Everything below works on arrays of a block, so that a task's memory depends on
``BLOCK_CHARS`` (or on its longest single text), not on how many rows a partition has.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa

BLOCK_CHARS = 1 << 18
_ROWS = 256  # of a batch, turned into Python strings at a time
_ODD = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_STEP_INVERSE = np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(32))
    x = x * _ODD
    x = x ^ (x >> np.uint64(29))
    x = x * _STEP
    return x ^ (x >> np.uint64(32))


@lru_cache(4)
def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, np.uint64(base), np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


@cache
def table(kind: str) -> np.ndarray:
    """By code point: ``word`` (letter or digit), ``lower``, ``digit``, ``upper``, ``space``."""
    points = map(chr, range(0x110000))
    if kind == "lower":
        # A letter whose lower case has several code points stays as it is.
        low = (c.lower() for c in points)
        return np.fromiter(
            (ord(x) if len(x) == 1 else i for i, x in enumerate(low)), np.uint32, 0x110000
        )
    test = {"word": str.isalnum, "digit": str.isdigit, "upper": str.isupper, "space": str.isspace}
    return np.fromiter(map(test[kind], points), bool, 0x110000)


@cache
def _values(fold: str) -> np.ndarray:
    """By code point, a random 64-bit value; letters of one case class share it."""
    points = np.arange(0x110000, dtype=np.uint64)
    if fold == "lower":
        points = table("lower").astype(np.uint64)
    elif fold == "ascii":
        points[65:91] += np.uint64(32)
    return mixed(points + np.uint64(1))


class Block:
    """Code points of some whole texts, and where each text starts."""

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        joined = "\n".join([*texts, ""])
        self.codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs where ``inside`` holds."""
        padded = np.zeros(len(inside) + 2, np.int8)
        padded[1:-1] = inside
        edges = np.flatnonzero(np.diff(padded))
        return edges[::2], edges[1::2]

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Runs of letters and digits."""
        return self.spans(table("word")[self.codes])

    def hashes(self, starts: np.ndarray, ends: np.ndarray, fold: str = "lower") -> np.ndarray:
        """A 64-bit hash of each span, equal for equal spans wherever they stand.

        A polynomial in an odd base: prefix sums give each span's value times a power of the
        base, which the base's inverse removes.
        """
        size = 1 << max(18, int(len(self.codes)).bit_length())
        sums = np.zeros(len(self.codes) + 1, np.uint64)
        terms = _values(fold)[self.codes] * _powers(int(_STEP), size)[: len(self.codes)]
        np.cumsum(terms, out=sums[1:])
        found = (sums[ends] - sums[starts]) * _powers(int(_STEP_INVERSE), size)[starts]
        return mixed(found + (ends - starts).astype(np.uint64) * _ODD)

    def first(self, starts: np.ndarray) -> np.ndarray:
        """For each text, the index of its first span; one entry more at the end."""
        return np.append(np.searchsorted(starts, self.starts), len(starts))


def release() -> None:
    """Hand freed memory back to the system: Spark keeps idle workers, which would hold it.

    The C library's part is done where that is glibc.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each ``n`` values in a row, in their order."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total = total * _STEP + hashes[k : k + count]
    return mixed(total)


def text_blocks(batch: pa.RecordBatch, chars: int = BLOCK_CHARS) -> Iterator[tuple[list, Block]]:
    """Ids and blocks of a batch of (id, text)."""
    for start in range(0, batch.num_rows, _ROWS):
        part = batch.slice(start, _ROWS)
        ids = part.column(0).to_pylist()
        for begin, block in blocks(part.column(1).to_pylist(), chars):
            yield ids[begin : begin + len(block.texts)], block


def blocks(texts: list[str | None], chars: int = BLOCK_CHARS) -> Iterator[tuple[int, Block]]:
    """Blocks of about ``chars`` code points with the index of their first text; null is empty.

    A text is never cut: one that is longer makes a block by itself.
    """
    begin, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if held and size + len(text) > chars:
            yield begin, Block(held)
            begin, held, size = i, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield begin, Block(held)


def by_blocks(
    work: Callable[[list, Block], pa.RecordBatch | None], chars: int = BLOCK_CHARS
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` over (id, text): ``work`` gets a block and its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, block in text_blocks(batch, chars):
                out = work(ids, block)
                if out is not None and out.num_rows:
                    yield out
        release()

    return run


def word_sets(block: Block, n: int = 5) -> Iterator[np.ndarray]:
    """For each text, the sorted hashes of its shingles of ``n`` words, each once.

    A text of fewer words has one shingle of all of them; a text without words has none.
    """
    starts, ends = block.words()
    hashes = block.hashes(starts, ends)
    shingles = windows(hashes, n)
    first = block.first(starts)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= n:
            yield np.unique(shingles[a : b - n + 1])
        else:
            yield windows(hashes[a:b], b - a) if b > a else hashes[:0]


def binary(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))
