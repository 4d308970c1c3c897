"""The model hook: a user's client called for each chat request, in Arrow batches."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from postmill.schemas import CHAT_MESSAGES, REPLY
from postmill.session import ship_package

Teacher = Callable[[DataFrame], DataFrame]


class Client(Protocol):
    """What a model connection must offer. It is made once per partition, on the executor.

    How to sample is the client's business; ``fixed_values`` has the usual settings.
    A client may also have ``generate_batch(messages, max_new_tokens)``, lists of either in
    and a list of replies out; it is then called instead, for ``batch_size`` requests at once.
    """

    def generate(self, messages: list[dict[str, str]], max_new_tokens: int | None) -> str: ...


class _Pace:
    """Turns of one caller of several: ``interval`` seconds apart, the first after ``offset``."""

    def __init__(self, interval: float, offset: float) -> None:
        self.interval = interval
        self.turn = time.monotonic() + offset

    def wait(self) -> None:
        """Sleep until it is this caller's turn. Turns that passed unused are not caught up."""
        now = time.monotonic()
        if now < self.turn:
            time.sleep(self.turn - now)
        self.turn = max(self.turn, now) + self.interval


def _shared_pace(calls_per_second: float) -> _Pace:
    """The pace of this task, of all that run at once in its barrier stage."""
    context = BarrierTaskContext.get()
    callers = len(context.getTaskInfos())
    return _Pace(callers / calls_per_second, context.partitionId() / calls_per_second)


def model_teacher(
    make_client: Callable[[], Client],
    *,
    on_error: str = "fail",
    batch_size: int = 32,
    max_callers: int | None = None,
    pause_seconds: float = 0.0,
    pause_if: Callable[[str | None], bool] | None = None,
    calls_per_second: float | None = None,
    profile: ResourceProfile | None = None,
) -> Teacher:
    """A DataFrame step that adds ``reply`` and ``error`` to chat requests.

    ``on_error`` is ``fail`` (a failing call ends the job) or ``skip`` (the row gets
    the reason in ``error``; the rows of a batch call that fails are asked one by one).
    ``batch_size`` bounds a batch call. ``max_callers`` bounds how many clients call at once;
    ``pause_seconds`` is slept after each call, or after those ``pause_if`` accepts.
    ``calls_per_second`` holds for the whole job: the ``max_callers`` tasks of a barrier stage, which
    run all at once or not at all, share it, each calling in its turn; the cluster must have as many
    free slots. ``profile`` asks for executors and task resources of its own for the model's
    stage, such as GPUs, where the cluster manager knows stage-level scheduling.
    Calls cost money and their replies differ, so write the result before using it
    twice, as ``label_requests`` does, and leave ``spark.speculation`` off.
    """
    if on_error not in ("fail", "skip"):
        raise ValueError(f"unknown error policy: {on_error}")
    if calls_per_second is not None and (calls_per_second <= 0 or not max_callers):
        raise ValueError("a rate needs to be above 0, and max_callers to share it")

    def ask(requests: DataFrame) -> DataFrame:
        ship_package(requests.sparkSession)
        schema = StructType([*requests.schema.fields, *REPLY.fields])

        def pause(replies: list[str | None]) -> None:
            if pause_seconds and (pause_if is None or any(map(pause_if, replies))):
                time.sleep(pause_seconds)

        def together(client: Client, pace: _Pace | None, messages: list, budgets: list) -> list[tuple] | None:
            """Replies of a batch call; none if the rows are to be asked one by one."""
            if not hasattr(client, "generate_batch"):
                return None
            if pace:
                pace.wait()
            try:
                replies = list(client.generate_batch(messages, budgets))
                if len(replies) != len(messages):
                    raise ValueError(f"{len(replies)} replies to {len(messages)} requests")
            except Exception:
                if on_error == "fail":
                    raise
                return None
            pause(replies)
            return [(reply, None) for reply in replies]

        def alone(client: Client, pace: _Pace | None, messages: list[dict[str, str]], budget: int | None) -> tuple:
            reply = error = None
            if pace:
                pace.wait()
            try:
                if hasattr(client, "generate"):
                    reply = client.generate(messages, budget)
                else:
                    (reply,) = client.generate_batch([messages], [budget])
            except Exception as failure:
                if on_error == "fail":
                    raise
                error = f"{type(failure).__name__}: {failure}"
            pause([reply])
            return reply, error

        def call(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            client = None
            pace = _shared_pace(calls_per_second) if calls_per_second else None
            for whole in batches:
                client = client or make_client()
                for start in range(0, whole.num_rows, batch_size):
                    batch = whole.slice(start, batch_size)
                    messages = batch.column("messages").to_pylist()
                    budgets = batch.column("max_new_tokens").to_pylist()
                    found = together(client, pace, messages, budgets)
                    if found is None:
                        found = [alone(client, pace, *row) for row in zip(messages, budgets, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns, *(pa.array(c, pa.string()) for c in zip(*found, strict=True))],
                        names=schema.names,
                    )

        if max_callers:
            # Not coalesce, which would run what makes the prompts in as few tasks.
            requests = requests.repartition(max_callers, "id")
        return requests.mapInArrow(call, schema, barrier=calls_per_second is not None, profile=profile)

    return ask


def chat_requests(
    table: DataFrame, id_column: str, messages: str = "messages", max_new_tokens: int | None = None
) -> DataFrame:
    """Requests in the shape the hook reads: id, messages, budget, free form or not."""
    return table.select(
        F.col(id_column).alias("id"),
        F.col(messages).cast(CHAT_MESSAGES).alias("messages"),
        F.lit(max_new_tokens).cast("int").alias("max_new_tokens"),
        F.lit(False).alias("free_form"),
    )
