"""Labelled records of several shapes."""

import json

from pyspark.sql import functions as F

from postmill.sources.labelled import inferred_schema, read_labelled, read_variants

RECORDS = [
    ({"messages": [{"role": "user", "content": "a b"}, {"role": "assistant", "content": None}], "id": 1, "prompt": "kept"}, [("user", "a b"), ("assistant", None)], {"id": 1, "prompt": "kept"}, None),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r", "x": 1}, {"from": "tool", "value": "t"}], "n": {"b": [1.5, None], "a": "é"}}, [("user", "q"), ("assistant", "r"), ("tool", "t")], {"n": {"a": "é", "b": [1.5, None]}}, None),
    ({"prompt": "p", "response": "r"}, [("user", "p"), ("assistant", "r")], None, None),
    ({"prompt": "p", "completion": "c", "system": "s", "z": True}, [("system", "s"), ("user", "p"), ("assistant", "c")], {"z": True}, None),
    ({"prompt": "p"}, None, {"prompt": "p"}, "no known shape"),
    ({"messages": "text"}, None, {"messages": "text"}, "no known shape"),
    ({}, None, {}, "no known shape"),
    ([1], None, [1], "no JSON object"),
    (None, None, None, "no JSON object"),
]


def test_shapes(spark, tmp_path):
    lines = [json.dumps(r, ensure_ascii=False) for r, *_ in RECORDS]
    lines += ["", "  ", "{broken", '{"a": 1, "a": 2}']
    (tmp_path / "in.jsonl").write_bytes("\n".join(lines).encode())
    rows = read_labelled(spark, str(tmp_path)).coalesce(1).collect()
    assert len(rows) == len(RECORDS) + 2
    for row, (_, messages, extra, error) in zip(rows, RECORDS, strict=False):
        assert row.messages == (messages and [tuple(m) for m in messages]) and row.error == error
        assert (json.loads(row.extra) if row.extra else None) == extra
    assert [(r.extra, r.error) for r in rows[-2:]] == [("{broken", "no JSON object"), ('{"a": 1, "a": 2}', "no JSON object")]


def test_schema_of_all_shapes(spark, tmp_path):
    lines = [json.dumps(r) for r, *_ in RECORDS[:4]]
    (tmp_path / "in.jsonl").write_text("\n".join(lines))
    found = inferred_schema(read_variants(spark, str(tmp_path))).first()
    assert found.rows == 4
    assert all(f"{key}: " in found.schema for key in ("messages", "conversations", "prompt", "completion", "n", "z"))
    empty = read_variants(spark, str(tmp_path)).where("false")
    assert inferred_schema(empty).first().rows == 0


def test_one_scan(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"prompt": "p", "response": "r"}\n')
    frame = read_labelled(spark, str(tmp_path)).select(F.size("messages"), "extra")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan
