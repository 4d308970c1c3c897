"""The committing sink: all of an output or nothing, and its count."""

import os

import pytest
from pyspark.sql import functions as F

from postmill.sources.committed import FORMAT, committed_paths, read_manifest, write_json_lines
from postmill.sources.jsonl import read_clean_emails, write_clean_emails

KINDS = "source string, path string, subject string, clean_text string, urls array<string>"


def mails(spark, n, text="t"):
    return spark.range(n).selectExpr(
        "'a' as source", "cast(id as string) as path", "null as subject", f"'{text}' as clean_text", "array('http://x') as urls"
    )


def files(path):
    return sorted(n for n in os.listdir(path) if n.startswith("part-"))


def test_overwriting_replaces_all(spark, tmp_path):
    path = str(tmp_path / "out")
    assert write_clean_emails(mails(spark, 50).repartition(7), path) == 50
    first = files(path)
    assert write_clean_emails(mails(spark, 20, "new").repartition(3), path) == 20
    assert len(files(path)) == 3 and not set(first) & set(files(path))
    back = read_clean_emails(spark, path)
    assert back.count() == 20 and back.where("clean_text = 'new'").count() == 20
    assert spark.read.schema(KINDS).json(path).count() == 20  # plain readers as well
    assert read_manifest(path)["rows"] == 20
    assert write_clean_emails(mails(spark, 0), path) == 0
    assert read_clean_emails(spark, path).count() == 0 and files(path) == []


def test_a_failing_task_leaves_the_old_output(spark, tmp_path):
    path = str(tmp_path / "out")
    write_clean_emails(mails(spark, 30), path)
    before = files(path)
    bad = F.when(F.col("path") == "77", F.raise_error(F.lit("lost"))).otherwise(F.col("clean_text")).cast("string")
    with pytest.raises(Exception, match="lost"):
        write_clean_emails(mails(spark, 100).repartition(8).withColumn("clean_text", bad), path)
    assert read_clean_emails(spark, path).count() == 30
    assert files(path) == before and read_manifest(path)["rows"] == 30


def test_unfinished_files_are_not_read(spark, tmp_path):
    path = str(tmp_path / "out")
    write_clean_emails(mails(spark, 4), path)
    with open(f"{path}/part-other-00000-1-0.json", "w") as file:
        file.write('{"path": "half')
    assert read_clean_emails(spark, path).count() == 4
    assert write_clean_emails(mails(spark, 5), path) == 5
    assert not any("other" in name for name in files(path))


def test_appending_and_small_files(spark, tmp_path):
    path = f"file://{tmp_path}/out"
    assert write_json_lines(mails(spark, 6), path) == 6
    assert write_json_lines(mails(spark, 4), path, append=True) == 4
    assert read_clean_emails(spark, path).count() == 10 == read_manifest(path)["rows"]
    lines = mails(spark, 9).coalesce(1).select(F.col("path").alias("value"))
    lines.write.format(FORMAT).mode("overwrite").option("path", path).option("fileBytes", "1").save()
    assert len(committed_paths(spark, path)) == 9
    assert sorted(r.value for r in spark.read.text(committed_paths(spark, path)).collect()) == list("012345678")


def test_paths_without_a_manifest(spark, tmp_path):
    assert committed_paths(spark, str(tmp_path)) == [str(tmp_path)]
    assert committed_paths(spark, "viewfs:///x") == ["viewfs:///x"]
