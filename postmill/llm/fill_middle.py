"""Fill-in-middle: texts cut at two token ranks, found by descending an indexable skip list.

Every token of a text is a node. Express lanes hold fewer and fewer of the nodes, drawn by
hash, and each link carries its width in units (tokens) and in code points. A rank is reached
by going along a lane while its links fit into what is left, then a lane down; the widths
passed give the place of the cut in code points exactly, without a walk over all tokens.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.llm.staging import prepare
from postmill.llm.words import Block, by_blocks, mixed

SENTINELS = ("<P>", "<S>", "<M>")
PLAIN_PERCENT, SPM_PERCENT = 10, 20
SEED = 1
_FANOUT_BITS = 2  # a node is in the next lane with a probability of 1/4
_KINDS = (
    "id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
)


class Lane(NamedTuple):
    """Nodes of one height of all texts of a block, and a last one that ends the block."""

    nodes: np.ndarray  # token numbers
    units: np.ndarray  # width of the link to the next node, in tokens
    chars: np.ndarray  # the same in code points
    down: np.ndarray  # where the node is in the lane below


def token_starts(block: Block) -> np.ndarray:
    """Where the tokens of all texts start: runs of A-Z and a-z, and every other code point."""
    low = block.codes | np.uint32(32)
    letter = (low >= 97) & (low <= 122) & (block.codes < 128)
    start = ~letter
    start[:1] = True
    start[1:] |= ~letter[:-1]
    start[block.ends] = False
    return np.flatnonzero(start)


class SkipLists:
    """One indexable skip list for each text of a block, in common arrays.

    The first token of a text is in all lanes and serves as the list's head.
    """

    def __init__(self, block: Block) -> None:
        starts = token_starts(block)
        self.first = block.first(starts)
        self.units = np.diff(self.first)
        full = self.units > 0
        self.heads = self.first[:-1][full]
        # The place after a text's last token is where its final link leads.
        owner = np.repeat(np.arange(len(self.units)), self.units)
        ends = block.ends[owner]
        last = self.first[1:][owner]
        within = np.arange(len(starts)) - self.first[:-1][owner]
        draw = mixed(within.astype(np.uint64) + np.uint64(1))
        self.lanes: list[Lane] = []
        nodes = np.arange(len(starts))
        below: np.ndarray | None = None
        while True:
            same = np.zeros(len(nodes), bool)
            same[:-1] = owner[nodes[1:]] == owner[nodes[:-1]]
            after = np.append(nodes[1:], 0)
            to = np.where(same, after, last[nodes])
            place = np.where(same, starts[after] if len(starts) else 0, ends[nodes])
            down = nodes if below is None else np.searchsorted(below, nodes)
            bottom = len(starts) if below is None else len(below)
            self.lanes.append(
                Lane(
                    nodes,
                    np.append(to - nodes, np.iinfo(np.int64).max),
                    np.append(place - starts[nodes], 0),
                    np.append(down, bottom),
                )
            )
            if len(nodes) <= len(self.heads):
                break
            below = nodes
            shift = np.uint64(_FANOUT_BITS * (len(self.lanes) - 1))
            drawn = (draw[nodes] >> shift) & np.uint64((1 << _FANOUT_BITS) - 1) == 0
            if len(self.lanes) * _FANOUT_BITS >= 64:
                drawn[:] = False
            nodes = nodes[drawn | (within[nodes] == 0)]

    def places(self, ranks: np.ndarray) -> np.ndarray:
        """For each text, the code points before its token number ``ranks`` (0 to all)."""
        result = np.zeros(len(self.units), np.int64)
        full = self.units > 0
        left = ranks[full].astype(np.int64)
        passed = np.zeros(len(left), np.int64)
        top = self.lanes[-1]
        at = np.searchsorted(top.nodes, self.heads)
        for lane in reversed(self.lanes):
            go = np.flatnonzero(lane.units[at] <= left)
            while len(go):
                here = at[go]
                left[go] -= lane.units[here]
                passed[go] += lane.chars[here]
                at[go] += 1
                go = go[lane.units[at[go]] <= left[go]]
            at = lane.down[at]
        result[full] = passed
        return result


def draws(number: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the SHA-256 of the seed and an id."""
    digest = hashlib.sha256(f"{seed}:{number}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def _transform(sentinels: tuple[str, str, str], plain_percent: int, spm_percent: int, seed: int):
    p, s, m = sentinels

    def work(ids: list[int | None], block: Block) -> pa.RecordBatch:
        lists = SkipLists(block)
        drawn = [draws(i, seed) for i in ids]
        units = lists.units
        picks = np.array([d[:2] for d in drawn], np.int64).reshape(-1, 2) % (units + 1)[:, None]
        picks.sort(axis=1)
        one, two = lists.places(picks[:, 0]), lists.places(picks[:, 1])
        rows = []
        for i, text in enumerate(block.texts):
            a, b = int(one[i]), int(two[i])
            plain = ids[i] is None or not text or drawn[i][2] % 100 >= 100 - plain_percent
            if plain or any(x in text for x in sentinels):
                rows.append((ids[i], int(units[i]), "plain", None, None, text))
                continue
            spm = drawn[i][3] % 100 < spm_percent
            head, middle, tail = text[:a], text[a:b], text[b:]
            out = f"{s}{tail}{p}{head}{m}{middle}" if spm else f"{p}{head}{s}{tail}{m}{middle}"
            rows.append((ids[i], int(units[i]), "spm" if spm else "psm", a, b - a, out))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = [x.split()[0] for x in _KINDS.split(", ")]
        columns = zip(zip(*rows, strict=True), kinds, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names)

    return by_blocks(work)


def fill_in_middle(
    documents: DataFrame,
    sentinels: tuple[str, str, str] = SENTINELS,
    plain_percent: int = PLAIN_PERCENT,
    spm_percent: int = SPM_PERCENT,
    seed: int = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): one row for each document.

    A text of ``n`` tokens (runs of A-Z and a-z, and single other code points) is cut before
    two token ranks, drawn by a hash of ``seed`` and id, into prefix, middle and suffix.
    ``psm`` puts out prefix, suffix, middle, ``spm`` suffix, prefix, middle, each with its
    sentinel before it; ``spm_percent`` of the cut texts are ``spm``, by hash. The text itself
    is put out as ``plain`` for ``plain_percent`` of the ids, and where it is empty, holds a
    sentinel, or has no id; lengths of the parts (in code points) are then null.

    A null text is empty. Rows that repeat an id are cut by the same draws, each in its own
    text. An empty table gives an empty result. Only the two named columns are read.

    No shuffle: a task holds the skip lists of one block of texts, or of one longer text.
    """
    prepare(documents.sparkSession)
    if not all(sentinels) or any(x[0] in y[1:] for x in sentinels for y in sentinels):
        raise ValueError("a sentinel's first sign may stand only at the start of sentinels")
    if any(x != y and y.startswith(x) for x in sentinels for y in sentinels) or len(set(sentinels)) != 3:
        raise ValueError("no sentinel may begin another")
    two = documents.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    )
    done = two.mapInArrow(_transform(sentinels, plain_percent, spm_percent, seed), _KINDS)
    return done.withColumnRenamed("id", id_column)


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made of, from the output and its form alone."""
    p, s, m = sentinels
    at_m = F.instr(output, m)

    def between(begin: Column, end: Column) -> Column:
        return F.substring(output, begin, end - begin)

    middle = between(at_m + len(m), F.length(output) + 1)
    at_s, at_p = F.instr(output, s), F.instr(output, p)
    psm = F.concat(between(F.lit(len(p) + 1), at_s), middle, between(at_s + len(s), at_m))
    spm = F.concat(between(at_p + len(p), at_m), middle, between(F.lit(len(s) + 1), at_p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
