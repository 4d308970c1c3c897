"""Language-model scoring: hashed maximum entropy with a class-factored softmax.

P(word | before) = P(class | before) P(word | class). The class of a word follows from its
first two letters. The class is predicted by a log-linear model whose features are hashed:
the word before, the two words before, the word before that one (a skip), and the classes
of the two words before. Within its class a word has its share of the training tokens.

The texts are read once, into blocks of token numbers with the block's own vocabulary.
Corpus counts come from the vocabularies, in packed parts by hash bucket. The weights are
trained on every training token: each task takes gradient steps over its blocks from the
common weights, and the tasks' changes are averaged by their tokens, round by round.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.staging import prepare, staged
from postmill.llm.words import _ODD, _STEP, Block, mixed, release, text_blocks

CLASSES = 64  # with one for the end of a text
SLOTS = 1 << 12  # hashed places of each kind of feature
KINDS = 4
ROUNDS = 2
BATCH = 1 << 14
RATE = 0.1
BLOCK_TOKENS = 1 << 20
BUCKET_WORDS = 1 << 19  # vocabulary entries that one bucket of the counting sums, about
_SLABS = 16
_END = mixed(np.array([0x454E44], np.uint64))[0]

_BLOCK = (
    "block bigint, ids array<bigint>, sizes binary, held binary, words binary, classes binary, "
    "counts binary, tokens binary, entries bigint, train_tokens bigint"
)


def held_out(doc_id: int | None) -> bool:
    """Whether a document is scored only: crc32 of its id as text, modulo 5, is 1."""
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


# ---------------------------------------------------------------------------------- blocks
def _blanks(codes: np.ndarray) -> np.ndarray:
    return (codes == 32) | ((codes >= 9) & (codes <= 13))


def _tokens(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes and classes of all texts, an end after each text, and the texts' sizes."""
    starts, ends = block.spans(~_blanks(block.codes))
    hashes = block.hashes(starts, ends, "ascii")
    low = block.codes[np.stack([starts, np.minimum(starts + 1, ends - 1)])].astype(np.uint64)
    low[(low >= 65) & (low <= 90)] += np.uint64(32)
    low[1][ends - starts == 1] = 0
    pair = mixed(low[0] * np.uint64(0x110000) + low[1])
    kinds = (pair % np.uint64(CLASSES - 1) + np.uint64(1)).astype(np.uint8)
    first = block.first(starts)
    at = first[1:]
    sizes = np.diff(first) + 1
    return np.insert(hashes, at, _END), np.insert(kinds, at, 0), sizes


def _planes(values: np.ndarray) -> bytes:
    """The number of bytes that the largest value needs, then byte by byte: all first bytes
    before all second ones."""
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    values = np.zeros((planes.shape[1], 8), np.uint8)
    values[:, :width] = planes.T
    return values.view("<i8").reshape(-1)


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    ids: list[int | None] = []
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def close() -> pa.RecordBatch:
        hashes, kinds, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
        words, at, tokens = np.unique(hashes, return_index=True, return_inverse=True)
        out = np.array([held_out(i) for i in ids], bool)
        train = np.repeat(~out, sizes)
        counts = np.bincount(tokens[train], minlength=len(words))
        row = {
            "block": [number],
            "ids": pa.array([ids], pa.list_(pa.int64())),
            "sizes": [sizes.astype(np.int64).tobytes()],
            "held": [out.tobytes()],
            "words": [words.tobytes()],
            "classes": [kinds[at].tobytes()],
            "counts": [_planes(counts)],
            "tokens": [_planes(tokens)],
            "entries": [len(words)],
            "train_tokens": [int(train.sum())],
        }
        return pa.RecordBatch.from_pydict(row)

    for batch in batches:
        for numbers, block in text_blocks(batch):
            found = _tokens(block)
            ids += numbers
            held.append(found)
            size += len(found[0])
            if size >= BLOCK_TOKENS:
                yield close()
                ids, held, size, number = [], [], 0, number + 1
    if held:
        yield close()
    release()


# ---------------------------------------------------------------------------------- counts
def _by_bucket(words: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buckets that a vocabulary has words in, where each begins, and the words' order."""
    bucket = (mixed(words) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    here, begin = np.unique(bucket[order], return_index=True)
    return here, begin, order


def _parts(buckets: int):
    """Each block's vocabulary, packed by hash bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words = np.frombuffer(row["words"], np.uint64)
                classes = np.frombuffer(row["classes"], np.uint8)
                counts = _from_planes(row["counts"])
                here, begin, order = _by_bucket(words, buckets)
                split = [np.split(x[order], begin[1:]) for x in (words, classes, counts)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "bucket": pa.array(here),
                        "block": pa.array([row["block"]] * len(here), pa.int64()),
                        "words": [x.tobytes() for x in split[0]],
                        "classes": [x.tobytes() for x in split[1]],
                        "counts": [_planes(x) for x in split[2]],
                    }
                )

    return run


def _total(rows: list[dict]) -> pa.RecordBatch:
    """Sum one bucket. Each block gets back the totals of its words there, in their order."""
    words = np.concatenate([np.frombuffer(r["words"], np.uint64) for r in rows])
    classes = np.concatenate([np.frombuffer(r["classes"], np.uint8) for r in rows])
    counts = np.concatenate([_from_planes(r["counts"]) for r in rows]).astype(np.int64)
    _, at, inverse = np.unique(words, return_index=True, return_inverse=True)
    total = np.bincount(inverse, counts).astype(np.int64)
    kinds = classes[at]
    stats = [
        np.bincount(kinds, weight, CLASSES).astype(np.int64)
        for weight in (total > 0, total, total == 1, total == 2)
    ]
    back, begin = [], 0
    for r in rows:
        end = begin + len(r["words"]) // 8
        back.append(_planes(total[inverse[begin:end]]))
        begin = end
    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array([r["block"] for r in rows] + [-1], pa.int64()),
            "bucket": pa.array([rows[0]["bucket"]] * (len(rows) + 1), pa.int32()),
            "totals": pa.array([*back, b""], pa.binary()),
            "stats": pa.array(
                [None] * len(rows) + [np.concatenate(stats).tolist()], pa.list_(pa.int64())
            ),
        }
    )


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of buckets that come one after the other."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and row["bucket"] != rows[0]["bucket"]:
                yield _total(rows)
                rows = []
            rows.append(row)
    if rows:
        yield _total(rows)


class Statistics(NamedTuple):
    """By class: distinct words, tokens, and words seen once and twice, in training documents."""

    words: np.ndarray
    tokens: np.ndarray
    once: np.ndarray
    twice: np.ndarray | int = 0

    @property
    def unseen(self) -> np.ndarray:
        """Mass kept in each class for words that training has not seen."""
        return self.once + 0.5

    @property
    def unseen_words(self) -> np.ndarray:
        """How many words share that mass: Chao's estimate of the words not seen, and so many
        at least that none is likelier than a word seen once."""
        once = self.once.astype(float)
        return np.maximum(self.unseen, once * (once - 1) / (2 * (self.twice + 1.0)))

    @property
    def bias(self) -> np.ndarray:
        return np.log((self.tokens + self.unseen) / (self.tokens + self.unseen).sum())


# ----------------------------------------------------------------------------------- model
def _features(hashes: np.ndarray, kinds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A row of places in the weights for each kind of feature."""
    starts = np.cumsum(sizes) - sizes
    in_text = np.arange(len(hashes)) - np.repeat(starts, sizes)

    def before(values: np.ndarray, step: int) -> np.ndarray:
        shifted = np.zeros_like(values)
        shifted[step:] = values[:-step]
        shifted[in_text < step] = 0
        return shifted

    one, two = before(hashes, 1), before(hashes, 2)
    c1, c2 = (before(kinds, s).astype(np.uint64) for s in (1, 2))
    rows = [one, mixed(one * _STEP + two), mixed(two + _ODD), mixed(c1 * np.uint64(CLASSES) + c2)]
    return np.stack([(r % np.uint64(SLOTS)).astype(np.uint16) for r in rows])


def _predicted(weights: np.ndarray, bias: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Probabilities of the classes for tokens with these features."""
    scores = weights[0][places[0]] + bias
    for kind in range(1, KINDS):
        scores += weights[kind][places[kind]]
    scores -= scores.max(axis=1, keepdims=True)
    np.exp(scores, out=scores)
    scores /= scores.sum(axis=1, keepdims=True)
    return scores


def _learn(weights, seen, bias, places, kinds, rate: float) -> None:
    """Adaptive gradient steps over batches of tokens, in place."""
    for a in range(0, len(kinds), BATCH):
        here, gold = places[:, a : a + BATCH], kinds[a : a + BATCH]
        error = -_predicted(weights, bias, here)
        error[np.arange(len(gold)), gold] += 1
        by_class = np.ascontiguousarray(error.T, np.float64)
        for kind in range(KINDS):
            counts = np.bincount(here[kind], minlength=SLOTS)
            slots = np.flatnonzero(counts)
            sums = np.empty((CLASSES, SLOTS))
            for number, column in enumerate(by_class):
                sums[number] = np.bincount(here[kind], column, SLOTS)
            change = (sums[:, slots].T / counts[slots, None]).astype(np.float32)
            seen[kind][slots] += change**2
            weights[kind][slots] += rate * change / np.sqrt(seen[kind][slots])


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    words = np.frombuffer(row["words"], np.uint64)
    classes = np.frombuffer(row["classes"], np.uint8)
    tokens = _from_planes(row["tokens"])
    sizes = np.frombuffer(row["sizes"], np.int64)
    return words, tokens, classes[tokens], sizes, np.frombuffer(row["held"], bool)


def _round(sent, bias: np.ndarray, turn: int, rounds: int, rate: float):
    """One task's share of a round: its change of the weights, in slabs, and its tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = sent.value
        weights, seen, total = start.copy(), np.full_like(start, 1e-3), 0
        for batch in batches:
            for row in batch.to_pylist():
                words, tokens, kinds, sizes, held = _unpacked(row)
                # Each text is a training text of one round only.
                mine = ~held & (np.arange(len(held)) % rounds == turn)
                use = np.repeat(mine, sizes)
                if use.any():
                    places = _features(words[tokens], kinds, sizes)
                    _learn(weights, seen, bias, places[:, use], kinds[use], rate)
                    total += int(use.sum())
        if total:
            change = (weights - start).astype(np.float16).reshape(_SLABS, -1)
            yield pa.RecordBatch.from_pydict(
                {
                    "slab": pa.array(np.arange(_SLABS, dtype=np.int32)),
                    "change": [x.tobytes() for x in change],
                    "tokens": pa.array([total] * _SLABS, pa.int64()),
                }
            )
            del change
        del weights, seen
        release()

    return run


def _summed(batches: Iterator[pa.RecordBatch], weigh: bool) -> Iterator[pa.RecordBatch]:
    """The sum of each slab's changes, row by row; with ``weigh``, by the tasks' tokens."""
    found: dict[tuple[int, int], list] = {}
    for batch in batches:
        for row in batch.to_pylist():
            kind = np.float16 if weigh else np.float32
            value = np.frombuffer(row["change"], kind).astype(np.float64)
            held = found.setdefault((row["slab"], row["part"]), [0.0, 0])
            held[0] = held[0] + value * (row["tokens"] if weigh else 1)
            held[1] += row["tokens"]
    if found:
        yield pa.RecordBatch.from_pydict(
            {
                "slab": pa.array([k[0] for k in found], pa.int32()),
                "part": pa.array([k[1] for k in found], pa.int32()),
                "change": [v[0].astype(np.float32).tobytes() for v in found.values()],
                "tokens": pa.array([v[1] for v in found.values()], pa.int64()),
            }
        )


def train(table: DataFrame, bias: np.ndarray, rounds: int = ROUNDS, rate: float = RATE) -> np.ndarray:
    """Weights of fixed size (kinds x slots x classes), whatever the corpus has.

    A round's changes are summed in two steps, so that no task reads all tasks' changes.
    """
    weights = np.zeros((KINDS, SLOTS, CLASSES), np.float32)
    context = table.sparkSession.sparkContext
    kinds = "slab int, part int, change binary, tokens bigint"
    texts = table.select("sizes", "held", "words", "classes", "tokens")
    for turn in range(rounds):
        sent = context.broadcast(weights)
        work = _round(sent, bias.astype(np.float32), turn, rounds, rate)
        changes = texts.mapInArrow(work, "slab int, change binary, tokens bigint")
        changes = changes.withColumn("part", (F.spark_partition_id() % 32).cast("int"))
        some = changes.select("slab", "part", "change", "tokens").repartition("slab", "part")
        some = some.mapInArrow(partial(_summed, weigh=True), kinds).withColumn("part", F.lit(0)).repartition("slab")
        rows = some.mapInArrow(partial(_summed, weigh=False), kinds).collect()  # the weights, of fixed size
        if not rows:
            break
        step = np.zeros((_SLABS, weights.size // _SLABS))
        for r in rows:
            step[r.slab] = np.frombuffer(r.change, np.float32) / max(r.tokens, 1)
        weights = weights + step.reshape(weights.shape).astype(np.float32)
    return weights


# --------------------------------------------------------------------------------- scoring
_SCORES = (
    "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def _scored(sent, stats: Statistics, buckets: int):
    tokens_all, words_all = int(stats.tokens.sum()), int(stats.words.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value, stats.bias.astype(np.float32)
        size = stats.tokens + stats.unseen
        for batch in batches:
            for row in batch.to_pylist():
                words, tokens, kinds, sizes, held = _unpacked(row)
                here, begin, order = _by_bucket(words, buckets)
                count = np.empty(len(words), np.int64)
                place = dict(zip(here.tolist(), np.split(order, begin[1:]), strict=True))
                for part in row["parts"]:
                    count[place[part["bucket"]]] = _from_planes(part["totals"])
                classes = np.frombuffer(row["classes"], np.uint8)
                base = np.log10((count + 0.5) / (tokens_all + 0.5 * (words_all + 1)))
                share = np.where(count > 0, count, (stats.unseen / stats.unseen_words)[classes]) / size[classes]
                own = np.log10(share)[tokens]
                places = _features(words[tokens], kinds, sizes)
                for a in range(0, len(kinds), BATCH):
                    found = _predicted(weights, bias, places[:, a : a + BATCH])
                    gold = kinds[a : a + BATCH]
                    own[a : a + BATCH] += np.log10(found[np.arange(len(gold)), gold].astype(float).clip(1e-30))
                text = np.repeat(np.arange(len(sizes)), sizes)
                columns = [
                    pa.array(row["ids"], pa.int64()),
                    pa.array(held),
                    pa.array(sizes),
                    pa.array(np.bincount(text, count[tokens] > 0, len(sizes)).astype(np.int64)),
                    pa.array(np.full(len(sizes), tokens_all)),
                    pa.array(np.bincount(text, base[tokens], len(sizes))),
                    pa.array(np.bincount(text, own, len(sizes))),
                ]
                names = [x.split()[0] for x in _SCORES.split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def score_documents(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rounds: int = ROUNDS,
    rate: float = RATE,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Tokens are runs without ASCII blanks, A-Z in lower case, and one end for each text; a
    text with null counts as empty and has the end alone. Documents that ``held_out`` names
    are scored only; all others are also learnt from. ``base_score`` is the smoothed
    unigram log10 probability of the text, ``score`` the model's. A word that training has
    not seen is one of its class's unseen words, which share the mass that words seen once
    have there; their number is estimated from the words seen once and twice.

    A null id is no held-out one, and repeated rows count as often as they occur. Words are
    known by a 64-bit hash. Only the two named columns are read; an empty table gives an
    empty result.

    Counts and vocabulary cover the whole corpus and grow with it; they never meet in one
    task or on the driver. The weights have a fixed size. Every training token is in one
    gradient step, in the round that its text's place in its block names.
    """
    prepare(documents.sparkSession)
    two = documents.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    )
    table = staged(two.mapInArrow(_to_blocks, _BLOCK), "token-blocks")
    entries = table.agg(F.sum("entries")).first()[0] or 0
    buckets = max(64, -(-entries // BUCKET_WORDS))
    part = "bucket int, block bigint, words binary, classes binary, counts binary"
    parts = table.select("block", "words", "classes", "counts").mapInArrow(_parts(buckets), part)
    summed = parts.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    total = "block bigint, bucket int, totals binary, stats array<bigint>"
    totals = staged(summed.mapInArrow(_totals, total), "word-totals")
    sums = {
        r.pos: r.n
        for r in totals.where("stats is not null")
        .select(F.posexplode("stats").alias("pos", "n"))
        .groupBy("pos")
        .agg(F.sum("n").alias("n"))
        .collect()  # four numbers for each class
    }
    values = np.array([sums.get(i, 0) for i in range(4 * CLASSES)], np.int64).reshape(4, CLASSES)
    stats = Statistics(*values)
    weights = train(table, stats.bias, rounds, rate)
    sent = documents.sparkSession.sparkContext.broadcast(weights)
    back = totals.where("block >= 0").groupBy("block")
    back = back.agg(F.collect_list(F.struct("bucket", "totals")).alias("parts"))
    both = table.drop("entries", "train_tokens", "counts").join(back, "block", "left")
    return both.mapInArrow(_scored(sent, stats, buckets), _SCORES).withColumnRenamed("id", id_column)
