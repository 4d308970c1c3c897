"""Shaping of rendered examples for a trainer: caps, length-grouped batches, batch counts."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DataType,
    DateType,
    IntegralType,
    StringType,
    TimestampType,
)

from postmill.fixed_values import (
    ACCUMULATION_STEPS,
    BATCH_SIZE,
    EPOCHS,
    SEED,
    SEQUENCE_LIMIT,
)
from postmill.functions.pytext import WS
from postmill.session import shared_dir

HASH_DIGITS = 3  # 16**3 buckets of the shuffled order, unless more are asked for
CHUNK_BATCHES = 50  # batches that are sorted by length together
BUCKET_ROWS = 10_000  # keys that one task may sort


def word_tokens(text: Column) -> Column:
    """Whitespace-separated words, the counter used when no tokenizer is given."""
    return F.regexp_extract_all(text, F.lit(f"[^{WS}]+"), F.lit(0))


def tokenizer_tokens(
    make_encoder: Callable[[], Callable[[str], list[int]]] | None = None,
    *,
    make_batch_encoder: Callable[[], Callable[[list[str]], list[list[int]]]] | None = None,
):
    """Token ids from a user's tokenizer, made once per Python worker and task.

    Give an encoder of one text, or one of a list of texts, which is called for a batch at once.
    A null text has no tokens and is null.
    """
    if (make_encoder is None) == (make_batch_encoder is None):
        raise ValueError("either an encoder of one text or one of a batch")

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = (make_encoder or make_batch_encoder)()
        for texts in batches:
            known = texts.drop_null().to_pylist()
            found = list(map(encoder, known)) if make_encoder else list(encoder(known))
            if len(found) != len(known):
                raise ValueError(f"{len(found)} rows of tokens for {len(known)} texts")
            place = iter(found)
            rows = [list(next(place)) if valid else None for valid in texts.is_valid().to_pylist()]
            yield pa.array(rows, pa.list_(pa.int32()))

    return encode


def cap_sequences(
    examples: DataFrame,
    text: str = "text",
    limit: int = SEQUENCE_LIMIT,
    tokens: Callable[[Column], Column] = word_tokens,
) -> DataFrame:
    """Add ``tokens``, cut to ``limit``, and ``n_tokens``, the count before the cut.

    Examples are not packed together: one row stays one sequence.
    """
    counted = examples.withColumn("tokens", tokens(F.col(text)))
    return counted.withColumns(
        {
            "n_tokens": F.size("tokens").cast("bigint"),
            "tokens": F.slice("tokens", 1, limit),
        }
    )


def length_batches(
    examples: DataFrame,
    id_column: str,
    length: str,
    *,
    batch_size: int = BATCH_SIZE * ACCUMULATION_STEPS,
    seed: int = SEED,
    chunk_batches: int = CHUNK_BATCHES,
    hash_digits: int = HASH_DIGITS,
) -> DataFrame:
    """Group examples of like length: ``id, length, position, batch, slot``.

    The examples are shuffled by a seeded hash of their id, the shuffled order is cut
    into chunks of ``chunk_batches`` batches (the last may be shorter), and each chunk is sorted by length, longest first. The
    order is global but no task sees all of it: a position is the number of rows in the
    lower hash buckets plus the rank inside the bucket. Ids must be unique; the hash
    then fills all buckets evenly whatever the data.

    Id, length and hash are first written to the shared folder, since they are read
    twice, for the counts and for the ranks, and the texts behind them should be read once.
    """
    narrow = examples.select(
        F.col(id_column).alias("id"),
        F.col(length).cast("bigint").alias("length"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string"))).alias("hash"),
    ).withColumn("bucket", F.substring("hash", 1, hash_digits))
    path = shared_dir(examples.sparkSession, "lengths")
    narrow.write.parquet(path)
    hashed = examples.sparkSession.read.schema(narrow.schema).parquet(path)
    # At most 16**hash_digits rows, however large the input: one task sums them, all read them.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy("bucket")
        .agg(F.count("*").alias("n"))
        .select(
            "bucket",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        )
    )
    in_bucket = Window.partitionBy("bucket").orderBy("hash", "id")
    placed = (
        hashed.withColumn("rank", F.row_number().over(in_bucket))
        .join(F.broadcast(offsets), "bucket")
        .withColumn("position", F.col("offset") + F.col("rank") - 1)
        .withColumn("chunk", F.floor(F.col("position") / (chunk_batches * batch_size)))
    )
    in_chunk = Window.partitionBy("chunk").orderBy(F.desc("length"), "position")
    ranked = placed.withColumn("at", F.row_number().over(in_chunk) - 1)
    return ranked.select(
        "id",
        "length",
        "position",
        (F.col("chunk") * chunk_batches + F.floor(F.col("at") / batch_size)).alias("batch"),
        (F.col("at") % batch_size).cast("bigint").alias("slot"),
    )


def batch_plan(
    examples: DataFrame,
    *,
    batch_size: int = BATCH_SIZE,
    accumulation: int = ACCUMULATION_STEPS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """One row: examples, optimizer steps per epoch, steps in all."""
    steps = F.ceil(F.col("examples") / (batch_size * accumulation)).cast("bigint")
    return examples.agg(F.count("*").alias("examples")).select(
        "examples", steps.alias("steps_per_epoch"), (steps * epochs).alias("total_steps")
    )


def ordered_bytes(key: Column, kind: DataType) -> Column:
    """``key`` as bytes in the same order: texts as UTF-8, numbers and times as fixed hex digits."""
    if isinstance(kind, StringType):
        return F.encode(key, "UTF-8")
    if isinstance(kind, BinaryType):
        return key
    if isinstance(kind, TimestampType):
        key = F.unix_micros(key)
    elif isinstance(kind, DateType):
        key = F.unix_date(key)
    elif not isinstance(kind, IntegralType):
        raise ValueError(f"rows are not capped by a key of type {kind.simpleString()}")
    # With the sign bit turned, negative numbers come first.
    turned = key.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))
    return F.encode(F.lpad(F.hex(turned), 16, "0"), "UTF-8")


def cutoff_key(table: DataFrame, limit: int, key: str, bucket_rows: int = BUCKET_ROWS) -> Column | None:
    """The ``limit``-th key in order as a literal, or None if there are not so many.

    Found by refining a histogram: rows are counted by the first byte in which keys differ, the
    bucket that holds the ``limit``-th key is taken, and its keys are counted by the next byte in
    which they differ, until a bucket has at most ``bucket_rows`` keys, which one task sorts. A
    round counts at most 257 buckets, each with its least and greatest key, so bytes that all keys
    of a bucket share take no round of their own.
    """
    kind = table.schema[key].dataType
    known = table.select(F.col(f"`{key}`").alias("key")).where("key is not null")
    known = known.withColumn("b", ordered_bytes(F.col("key"), kind))
    ends = [F.count("*").alias("n")]
    ends += [f(c).alias(f"{name}_{c}") for c in ("key", "b") for name, f in (("low", F.min), ("high", F.max))]
    bucket = known.agg(*ends).first()
    if bucket.n < limit:
        return None
    while bucket.n > bucket_rows and bucket.low_b != bucket.high_b:
        shared = len(os.path.commonprefix([bytes(bucket.low_b), bytes(bucket.high_b)]))
        # By the keys themselves, which the scan can compare with its statistics.
        inside = known.where(F.col("key").between(F.lit(bucket.low_key), F.lit(bucket.high_key)))
        # The digit is empty where a key ends there, and such a key comes first.
        digit = F.substring("b", shared + 1, 1).alias("digit")
        for bucket in sorted(inside.groupBy(digit).agg(*ends).collect(), key=lambda r: bytes(r.digit)):
            if bucket.n >= limit:
                break
            limit -= bucket.n
    if bucket.low_b == bucket.high_b:
        return F.lit(bucket.low_key)
    last = known.where(F.col("key").between(F.lit(bucket.low_key), F.lit(bucket.high_key)))
    return F.lit(last.orderBy("key").limit(limit).agg(F.max("key")).first()[0])


def cap_items(table: DataFrame, limit: int, key: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The first ``limit`` rows by a unique key; all rows when ``limit`` is not positive.

    Rows without a key are not kept, and rows that repeat the last key all are. The cut-off key is
    found on the key column alone (``cutoff_key``), before the result is read; the wide rows are then filtered
    at the scan. Keys are texts, bytes, whole numbers, dates or timestamps; others are a ``ValueError``.
    """
    if limit <= 0:
        return table
    cutoff = cutoff_key(table, limit, key, bucket_rows)
    column = F.col(f"`{key}`")
    return table.where(column.isNotNull() if cutoff is None else column <= cutoff)


def sample_items(table: DataFrame, fraction: float, key: str, seed: int = SEED) -> DataFrame:
    """About ``fraction`` of the rows, chosen by a seeded hash of the key: row-local, and the
    same rows in every run. Rows without a key are not chosen."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    if fraction >= 1:
        return table.where(F.col(key).isNotNull())
    return table.where(F.substring(digest, 1, 8) < f"{int(max(fraction, 0) * 2**32):08x}")
