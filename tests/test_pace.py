"""One rate for a whole job, shared by the callers."""

import os
import time

import pytest

from postmill.operators.inference import _Pace, chat_requests, model_teacher


class Logging:
    """Notes the time of each call in a file of its process."""

    def __init__(self, folder):
        self.file = open(os.path.join(folder, f"{os.getpid()}-{time.monotonic_ns()}"), "a")

    def generate(self, messages, max_new_tokens):
        self.file.write(f"{time.time()}\n")
        self.file.flush()
        return messages[0]["content"]


class Batched(Logging):
    def generate_batch(self, messages, budgets):
        return [self.generate(m, b) for m, b in zip(messages[:1], budgets[:1], strict=True)] * len(messages)


def requests(spark, n):
    rows = spark.range(n).selectExpr("id", "array(struct('user' as role, string(id) as content)) as messages")
    return chat_requests(rows, "id")


def times(folder):
    return sorted(float(line) for name in os.listdir(folder) for line in open(os.path.join(folder, name)))


@pytest.mark.parametrize("callers", [1, 4])
def test_calls_of_a_job(spark, tmp_path, callers):
    folder = str(tmp_path)
    teacher = model_teacher(lambda: Logging(folder), max_callers=callers, calls_per_second=25)
    replies = teacher(requests(spark, 50)).collect()
    assert sorted(int(r.reply) for r in replies) == list(range(50))
    found = times(folder)
    assert len(found) == 50 and len(os.listdir(folder)) == callers
    # 25 a second, and one more of each caller in a window, since clocks of tasks start apart.
    for start in found:
        assert sum(start <= t < start + 1 for t in found) <= 25 + callers
    assert found[-1] - found[0] >= 1.5 if callers == 1 else found[-1] - found[0] >= 0.9


def test_a_batch_is_one_call(spark, tmp_path):
    folder = str(tmp_path)
    teacher = model_teacher(lambda: Batched(folder), max_callers=2, calls_per_second=10, batch_size=10)
    assert teacher(requests(spark, 60)).count() == 60
    found = times(folder)
    assert 6 <= len(found) <= 8
    assert found[-1] - found[0] >= 0.4


def test_a_rate_needs_callers():
    for wrong in ({"calls_per_second": 5}, {"calls_per_second": 0, "max_callers": 2}):
        with pytest.raises(ValueError, match="max_callers"):
            model_teacher(Logging, **wrong)


def test_turns_are_not_caught_up():
    pace = _Pace(0.05, 0)
    pace.wait()
    time.sleep(0.2)
    start = time.monotonic()
    for _ in range(3):
        pace.wait()
    assert time.monotonic() - start >= 0.09
