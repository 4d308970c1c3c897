"""Secret scans: fixed patterns, and a linear-chain conditional random field over tokens.

The field tags each token of a line as the begin of a secret, inside one, or outside. Its
features are the token's shape, the words beside it, and how much the file looks like code
or settings. It is trained here, on lines whose tags come from the fixed patterns, so that
it learns what such values look like and where they stand, and finds others of the kind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.staging import prepare, staged
from postmill.llm.words import Block, by_blocks, table

# The patterns of the base scan, and the order of their kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")
ASSIGN_LENGTH = 6

SAMPLE_LINES = 2000  # lines with a base secret, and as many without, to train on
SAMPLE_TOKENS = 200  # of a training line: those around its secret, or around a place by hash
GRADIENT_STEPS = 150
_OUT, _BEGIN, _IN = 0, 1, 2
_HASHED = 1 << 12
_SHAPES = 1 << 11
_FILE = 8
_FEATURES = 2 * _SHAPES + 3 * _HASHED + 64 + _FILE * 8
_NEVER = -1e9


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base scan, sorted; a kind's matches do not overlap."""
    found = []
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LENGTH:
                found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in sorted(spans))


# ----------------------------------------------------------------------------- features
class Tokens(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    line: np.ndarray  # number of the line in the block
    features: np.ndarray  # a row of feature numbers for each token


def _class_table() -> np.ndarray:
    """By code point: 0 blank, 1 sign that parts tokens, and the rest part of a token:
    2 other, 3 lower, 4 upper, 5 digit, 6 one of + / _ . - and the like."""
    kinds = np.full(0x110000, 2, np.int8)
    kinds[table("space")] = 0
    kinds[[ord(c) for c in "\"'`=:;,()[]{}<>|!?*&^%$#@~\\"]] = 1
    kinds[ord("a") : ord("z") + 1] = 3
    kinds[ord("A") : ord("Z") + 1] = 4
    kinds[ord("0") : ord("9") + 1] = 5
    kinds[[ord(c) for c in "+/_.-"]] = 6
    return kinds


_CLASSES: list[np.ndarray] = []


def _sums(flags: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=total[1:], dtype=np.int32)
    return total


def _tokens(block: Block) -> Tokens:
    """Tokens are runs without blanks and parting signs; full stops at their end are not theirs."""
    if not _CLASSES:
        _CLASSES.append(_class_table())
    codes = block.codes
    kinds = _CLASSES[0][codes]
    starts, ends = block.spans(kinds >= 2)
    ends = np.where((codes[ends - 1] == 46) & (ends - starts > 1), ends - 1, ends)
    n = len(starts)
    feeds = np.flatnonzero(codes == 10)
    line = np.searchsorted(feeds, starts)
    if not n:
        return Tokens(starts, ends, line, np.empty((0, 9), np.int32))

    def count(flags: np.ndarray) -> np.ndarray:
        total = _sums(flags)
        return total[ends] - total[starts]

    size = ends - starts
    lower, upper, digit, sign = (count(kinds == k) for k in (3, 4, 5, 6))
    hexadecimal = count((kinds == 5) | ((codes >= 97) & (codes <= 102)))
    change = np.zeros(len(codes), bool)
    change[1:] = kinds[1:] != kinds[:-1]
    turns = count(change) - change[starts]

    def level(value: np.ndarray, steps: list[float]) -> np.ndarray:
        return np.searchsorted(np.array(steps), value, "right")

    length = level(size, [4, 6, 9, 12, 16, 20, 24, 32, 48, 65])  # 0..10
    digits = level(digit / size, [0.001, 0.15, 0.3, 0.6, 0.999])  # 0..5
    cases = (upper > 0) * 2 + (lower > 0)
    variety = level(turns / size, [0.001, 0.1, 0.25, 0.45])  # 0..4
    first_upper = (kinds[starts] == 4) & (upper == 1)
    whole_hex = hexadecimal == size
    shape = ((length * 6 + digits) * 4 + cases) * 2 + whole_hex  # below 528
    finer = ((variety * 4 + cases) * 6 + digits) * 3 + level(sign, [1, 3])  # below 360
    hashes = block.hashes(starts, ends)

    def beside(step: int) -> np.ndarray:
        """Hash of the word beside, on the same line; 0 without one."""
        other = np.zeros(n, np.uint64)
        if step < 0:
            other[-step:] = np.where(line[-step:] == line[:step], hashes[:step], 0)
        else:
            other[:-step] = np.where(line[:-step] == line[step:], hashes[step:], 0)
        return (other % np.uint64(_HASHED)).astype(np.int64)

    previous = np.concatenate(([0], ends[:-1]))
    gap = starts - previous
    gap[0] = min(gap[0], 3)
    mark = _sums((codes == 61) | (codes == 58))
    quote = _sums((codes == 34) | (codes == 39) | (codes == 96))
    same = np.concatenate(([False], line[1:] == line[:-1]))
    set_to = ((mark[starts] - mark[previous]) > 0) & same
    quoted = ((quote[starts] - quote[previous]) > 0) & same
    place = set_to * 2 + quoted + 4 * same + 8 * (gap > 3) + 16 * first_upper
    # Of the file: the share of its tokens that stand after a sign of assignment.
    text = np.searchsorted(block.ends, starts)
    total = np.bincount(text, minlength=len(block.texts))
    shares = np.bincount(text, set_to, len(block.texts)) / np.maximum(total, 1)
    file = level(shares, [0.001, 0.01, 0.03, 0.08, 0.15, 0.3, 0.5])[text]
    word = (hashes % np.uint64(_HASHED)).astype(np.int64)
    bases = np.cumsum([0, _SHAPES, _SHAPES, _HASHED, _HASHED, _HASHED, 64])
    both = file * 8 + set_to * 4 + np.minimum(digits, 3)
    columns = [shape, finer, beside(-1), beside(1), word, place, both]
    features = np.stack(columns, axis=1) + bases
    return Tokens(starts, ends, line, features.astype(np.int32))


# --------------------------------------------------------------------------------- model
class Model(NamedTuple):
    weights: np.ndarray  # by feature and tag
    moves: np.ndarray  # from tag, to tag

    def spans(
        self, block: Block, taken: list[list[tuple[int, int, int]]] | None = None
    ) -> list[list[tuple[int, int]]]:
        """For each text, the spans that the most likely tags of its lines name. Tokens that
        touch a ``taken`` span (start, kind, end) are cut out of them."""
        tokens = _tokens(block)
        found: list[list[tuple[int, int]]] = [[] for _ in block.texts]
        if not len(tokens.starts):
            return found
        tags = viterbi(self._scores(tokens.features), tokens.line, self.moves)
        inside = tags != _OUT
        if taken is not None:
            inside &= ~_touched(block, tokens, taken)
        runs_on = np.zeros(len(tags), bool)  # the token goes on with the span of the one before
        runs_on[1:] = inside[:-1] & (tags[1:] == _IN) & (tokens.line[1:] == tokens.line[:-1])
        begin = np.flatnonzero(inside & ~runs_on)
        if not len(begin):
            return found
        text = np.searchsorted(block.ends, tokens.starts[begin])
        for k, t in zip(begin.tolist(), text.tolist(), strict=True):
            last = k
            while last + 1 < len(tags) and inside[last + 1] and runs_on[last + 1]:
                last += 1
            offset = int(block.starts[t])
            found[t].append((int(tokens.starts[k]) - offset, int(tokens.ends[last]) - offset))
        return found

    def _scores(self, features: np.ndarray) -> np.ndarray:
        total = np.zeros((len(features), 3), np.float32)
        for column in range(features.shape[1]):
            total += self.weights[features[:, column]]
        return total


def _touched(block: Block, tokens: Tokens, taken: list[list[tuple[int, int, int]]]) -> np.ndarray:
    """Whether a token shares a code point with a taken span."""
    depth = np.zeros(len(block.codes) + 1, np.int32)
    for offset, spans in zip(block.starts.tolist(), taken, strict=True):
        for a, _, b in spans:
            depth[offset + a] += 1
            depth[offset + b] -= 1
    covered = _sums(np.cumsum(depth[:-1]) > 0)
    return covered[tokens.ends] > covered[tokens.starts]


def viterbi(scores: np.ndarray, line: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The best tags of each line, all lines of a block step by step together."""
    cut = np.flatnonzero(np.diff(line, prepend=-1))
    sizes = np.diff(np.append(cut, len(line)))
    order = np.argsort(-sizes, kind="stable")
    cut, sizes = cut[order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), "left")
    tags = np.empty(len(line), np.int8)
    back = np.zeros((len(line), 3), np.int8)
    best = scores[cut] + np.array([0, 0, _NEVER])  # a line cannot begin inside
    for step in range(1, len(active)):
        at = cut[: active[step]] + step
        paths = best[: active[step], :, None] + moves
        back[at] = paths.argmax(axis=1)
        best[: active[step]] = paths.max(axis=1) + scores[at]
    now = best.argmax(axis=1)
    for step in range(len(active) - 1, -1, -1):
        at = cut[: active[step]] + step
        tags[at] = now[: active[step]]
        now[: active[step]] = back[at, now[: active[step]]]
    return tags


def _lattice(features: np.ndarray, mask: np.ndarray, weights: np.ndarray, moves: np.ndarray):
    """Tag and move probabilities of padded lines by the forward-backward sums, in logs."""
    lines, steps, _ = features.shape
    scores = weights[features].sum(axis=2)
    ahead = np.empty((steps, lines, 3))
    ahead[0] = scores[:, 0] + np.array([0, 0, _NEVER])

    def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for t in range(1, steps):
        step = log_sum(ahead[t - 1][:, :, None] + moves, 1) + scores[:, t]
        ahead[t] = np.where(mask[:, t, None], step, ahead[t - 1])
    total = log_sum(ahead[-1], 1)
    behind = np.zeros((lines, 3))
    tag = np.empty((lines, steps, 3))
    move = np.zeros((3, 3))
    for t in range(steps - 1, -1, -1):
        tag[:, t] = np.exp(ahead[t] + behind - total[:, None]) * mask[:, t, None]
        if t:
            there = scores[:, t] + behind
            pair = ahead[t - 1][:, :, None] + moves + there[:, None] - total[:, None, None]
            move += (np.exp(pair) * mask[:, t, None, None]).sum(axis=0)
            behind = np.where(mask[:, t, None], log_sum(moves + there[:, None], 2), behind)
    return tag, move


def fit(lines: list[tuple[str, list[tuple[int, int]]]], steps: int = GRADIENT_STEPS) -> Model:
    """Maximum likelihood by adaptive gradient steps over (line, spans of its secrets)."""
    weights = np.zeros((_FEATURES, 3))
    moves = np.zeros((3, 3))
    moves[_OUT, _IN] = _NEVER
    rows = []
    for text, spans in lines:
        block = Block([text])
        tokens = _tokens(block)
        tags = np.zeros(len(tokens.starts), np.int8)
        for a, b in spans:
            inside = np.flatnonzero((tokens.starts >= a) & (tokens.ends <= b))
            tags[inside] = _IN
            tags[inside[:1]] = _BEGIN
        if len(tags):
            middle = int(np.flatnonzero(tags)[0]) if tags.any() else _order(text) % len(tags)
            begin = max(0, min(middle - SAMPLE_TOKENS // 2, len(tags) - SAMPLE_TOKENS))
            rows.append((tokens.features[begin : begin + SAMPLE_TOKENS], tags[begin : begin + SAMPLE_TOKENS]))
    if not any(tags.any() for _, tags in rows):
        weights[:, _OUT] = 1.0  # nothing to learn from: all outside
        return Model(weights.astype(np.float32), moves)
    rows.sort(key=lambda row: len(row[1]))
    batches = [rows[i : i + 256] for i in range(0, len(rows), 256)]
    seen, seen_moves = np.full(weights.shape, 1e-2), np.full(moves.shape, 1e-2)
    for _ in range(max(3, steps // len(batches))):
        for batch in batches:
            longest = max(len(tags) for _, tags in batch)
            features = np.zeros((len(batch), longest, batch[0][0].shape[1]), np.int64)
            gold = np.zeros((len(batch), longest), np.int64)
            mask = np.zeros((len(batch), longest), bool)
            for i, (own, tags) in enumerate(batch):
                features[i, : len(tags)], gold[i, : len(tags)], mask[i, : len(tags)] = own, tags, True
            tag, move = _lattice(features, mask, weights, moves)
            error = (np.eye(3)[gold] * mask[:, :, None] - tag).reshape(-1, 3)
            change = np.zeros_like(weights)
            flat = features.reshape(-1, features.shape[2])
            for tag_number in range(3):
                for column in range(flat.shape[1]):
                    change[:, tag_number] += np.bincount(
                        flat[:, column], error[:, tag_number], len(weights)
                    )
            change -= 0.02 * weights
            follows = mask[:, 1:]
            counts = np.zeros((3, 3))
            np.add.at(counts, (gold[:, :-1][follows], gold[:, 1:][follows]), 1)
            steer = np.where(moves <= _NEVER, 0, counts - move - 0.02 * np.maximum(moves, -50))
            seen += change**2
            seen_moves += steer**2
            weights += 0.3 * change / np.sqrt(seen)
            moves += 0.3 * steer / np.sqrt(seen_moves)
    return Model(weights.astype(np.float32), moves)


def fit_doubting(lines: list[tuple[str, list[tuple[int, int]]]]) -> Model:
    """Fit without the lines that have no base secret but may hold another one: those where
    a model of the other half of the lines finds something."""
    halves = (lines[::2], lines[1::2])
    kept = []
    for own, other in (halves, halves[::-1]):
        model = fit(other)
        found = model.spans(Block([line for line, _ in own])) if own else []
        kept += [row for row, extra in zip(own, found, strict=True) if row[1] or not extra]
    return fit(kept)


# ---------------------------------------------------------------------------------- scan
def _sampler(limit: int):
    """Of each task, the ``limit`` lines with base secrets that come first by hash, and as
    many of those without one, of all lines of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[dict[int, str], dict[int, str]] = ({}, {})

        bound = [1 << 63, 1 << 63]  # ranks from here on are not among the first

        def put(secret: bool, line: str) -> None:
            own, rank = held[secret], _order(line)
            if rank >= bound[secret]:
                return
            own[rank] = _around(line)
            if len(own) > 2 * limit:
                ranks = sorted(own)
                bound[secret] = ranks[limit]
                for rank in ranks[limit:]:
                    del own[rank]

        for batch in batches:
            for text in map(str, batch.column(0)):
                secret = bool(base_spans(text))
                for line in text.split("\n"):
                    if line:
                        put(secret and bool(base_spans(line)), line)
        for secret in (True, False):
            ranks = sorted(held[secret])[:limit]
            yield pa.RecordBatch.from_pydict(
                {
                    "line": pa.array([held[secret][r] for r in ranks], pa.string()),
                    "secret": pa.array([secret] * len(ranks), pa.bool_()),
                    "rank": pa.array(ranks, pa.int64()),
                }
            )

    return run


def _order(line: str) -> int:
    digest = hashlib.blake2b(line.encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "big") >> 1


def _around(line: str, reach: int = 2000) -> str:
    spans = base_spans(line)
    middle = spans[0][0] if spans else _order(line) % max(len(line), 1)
    return line[max(0, middle - reach) : middle + reach] if len(line) > 2 * reach else line


def _values_of(line: str) -> list[tuple[int, int]]:
    """The secret values of a line by the base scan: what is assigned, not the name it has."""
    spans = [(a, b) for a, kind, b in base_spans(line) if kind]
    for m in ASSIGN.finditer(line):
        if m.end(2) - m.start(2) >= ASSIGN_LENGTH:
            spans.append(m.span(2))
    return spans


def train_model(
    documents: DataFrame, text_column: str = "text", sample_lines: int = SAMPLE_LINES
) -> Model:
    """Fit on ``sample_lines`` lines with a base secret and as many without, of all lines the
    first ones by a hash of the line: a bounded sample, the same for the same table however it is
    partitioned. Equal lines count once."""
    prepare(documents.sparkSession)
    texts = documents.select(F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"))
    lines = texts.mapInArrow(_sampler(sample_lines), "line string, secret boolean, rank bigint")
    lines = staged(lines, "secret-lines")
    kept = []
    for name in (True, False):
        top = lines.where(F.col("secret") == name).select("rank", "line").distinct()
        kept += [r.line for r in top.orderBy("rank").limit(sample_lines).collect()]
    return fit_doubting([(line, _values_of(line)) for line in kept])


def scan_secrets(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    model: Model | None = None,
) -> DataFrame:
    """(id, spans: array of (kind, start, stop)) of every row; places are code points.

    Kinds ``assign``, ``access`` and ``hex`` come from the fixed patterns. Spans of kind
    ``crf`` are what the field finds beside them, without the tokens that touch one of them.
    Spans are sorted by start, then by kind as listed. ``model`` is trained on the table
    itself by default. A field finds a secret's value, not the name it is assigned to.

    Null and empty texts have no spans; null ids and repeated rows are scanned like any
    other row; whole texts are read, in blocks, whatever their length; an empty table gives
    an empty result, and a table without any base secret has no ``crf`` spans. Only the two
    named columns are read. Row-local after training.
    """
    model = model or train_model(documents, text_column)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def work(ids: list, block: Block) -> pa.RecordBatch:
        rows = []
        base = [base_spans(text) for text in block.texts]
        for spans, extra in zip(base, sent.value.spans(block, base), strict=True):
            spans += [(a, 3, b) for a, b in extra]
            rows.append([{"kind": KINDS[k], "start": a, "stop": b} for a, k, b in sorted(spans)])
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, kind)], ["id", "spans"])

    two = documents.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    )
    result = "id bigint, spans array<struct<kind: string, start: bigint, stop: bigint>>"
    return two.mapInArrow(by_blocks(work), result).withColumnRenamed("id", id_column)
