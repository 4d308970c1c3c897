from postmill.operators.inference import chat_requests, model_teacher


class Batches:
    """Replies with the size of the call; refuses a batch that holds a bad request."""

    def generate_batch(self, messages, budgets):
        assert len(messages) == len(budgets)
        if any(m[0]["content"] == "bad" for m in messages):
            raise RuntimeError("bad")
        return [f"{len(messages)}" for _ in messages]


def requests(spark, contents):
    rows = [(i, [("user", c)]) for i, c in enumerate(contents)]
    table = spark.createDataFrame(rows, "id int, messages array<struct<role:string,content:string>>")
    return chat_requests(table.coalesce(1), "id")


def test_requests_are_asked_in_batches(spark):
    rows = model_teacher(Batches, batch_size=4)(requests(spark, ["x"] * 10)).orderBy("id").collect()
    assert [r.reply for r in rows] == ["4"] * 8 + ["2"] * 2
    assert all(r.error is None for r in rows)


def test_a_failing_batch_is_asked_row_by_row(spark):
    teacher = model_teacher(Batches, batch_size=3, on_error="skip")
    rows = teacher(requests(spark, ["x", "bad", "x", "x"])).orderBy("id").collect()
    assert [r.reply for r in rows] == ["1", None, "1", "1"]
    assert rows[1].error == "RuntimeError: bad"
