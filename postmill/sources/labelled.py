"""Labelled records of uneven shapes: JSON Lines read as variants, one pass, nothing lost.

Files of several tools hold the same thing under different keys: messages of role and
content, turns of from and value, or a prompt with its response. Each line is parsed to a
variant, brought into chat messages by whichever shape fits, and its other keys are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.sources.committed import committed_paths

# The names that speakers have in turns of from and value.
SPEAKERS = {"human": "user", "gpt": "assistant", "system": "system"}
SHAPE_KEYS = ("messages", "conversations", "system", "prompt", "response", "completion")
_MESSAGES = "array<struct<role:string,content:string>>"


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """``value, record``: each line that is not blank, and it as a variant, null if it is no JSON.

    Line separators inside strings survive. A line with a key twice, or beyond Spark's
    limit for one variant, is null as well.
    """
    lines = spark.read.option("lineSep", "\n").text(committed_paths(spark, path))
    lines = lines.where(F.col("value").rlike(r"[^ \t\r\n]"))
    return lines.withColumn("record", F.try_parse_json("value"))


def inferred_schema(records: DataFrame, column: str = "record") -> DataFrame:
    """One row: ``schema`` of all variants, as merged partial results, and how many ``rows`` there are."""
    return records.agg(
        F.schema_of_variant_agg(F.col(column)).alias("schema"), F.count("*").alias("rows")
    )


def _as_messages(record: Column) -> Column:
    """Chat messages of a record of any known shape; null without one."""
    chat = F.try_variant_get(record, "$.messages", _MESSAGES)
    turns = F.try_variant_get(record, "$.conversations", "array<struct<from:string,value:string>>")
    names = F.create_map(*[F.lit(x) for pair in SPEAKERS.items() for x in pair])

    def said(turn: Column) -> Column:
        role = F.coalesce(F.try_element_at(names, F.lower(turn["from"])), turn["from"])
        return F.struct(role.alias("role"), turn["value"].alias("content"))

    def text(key: str) -> Column:
        return F.try_variant_get(record, f"$.{key}", "string")

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    reply = F.coalesce(text("response"), text("completion"))
    pair = F.array(message("system", text("system")), message("user", text("prompt")), message("assistant", reply))
    pair = F.filter(pair, lambda m: (m["role"] != "system") | m["content"].isNotNull())
    whole = text("prompt").isNotNull() & reply.isNotNull()
    return F.coalesce(chat, F.transform(turns, said), F.when(whole, pair))


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """``messages, extra, error``: one row for each line that is not blank.

    ``extra`` is a JSON object of all keys that the messages do not come from, in the order of
    their names, null without any. ``error`` is set, and ``messages`` null, where the line is
    no JSON object or has no known shape; then ``extra`` has the whole line.
    """
    rows = read_variants(spark, path)
    messages = _as_messages(F.col("record"))
    keys = F.col("record").try_cast("map<string,variant>")
    used = F.when(F.try_variant_get("record", "$.messages", "variant").isNotNull(), F.array(F.lit("messages")))
    used = used.when(
        F.try_variant_get("record", "$.conversations", "variant").isNotNull(), F.array(F.lit("conversations"))
    ).otherwise(F.array(*map(F.lit, SHAPE_KEYS)))
    staged = rows.select("value", messages.alias("messages"), keys.alias("keys"), used.alias("used"))
    others = F.map_filter("keys", lambda k, v: ~F.array_contains("used", k))
    error = F.when(F.col("keys").isNull(), "no JSON object").when(F.col("messages").isNull(), "no known shape")
    known = F.when(F.cardinality(others) > 0, F.to_json(others))
    return staged.select(
        "messages", F.when(error.isNotNull(), F.col("value")).otherwise(known).alias("extra"), error.alias("error")
    )
