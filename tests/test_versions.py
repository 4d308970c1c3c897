"""Repeated and changed mails of a stream against plain Python, with restarts."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from postmill.streaming.versions import mail_versions

START = datetime(2024, 1, 1)
KINDS = "id string, at timestamp, text string, folder string"


def feed(spark, tmp_path, rows, **options):
    """Add rows to the source and run the stream over them; returns its last progress."""
    table = [(i, None if s is None else START + timedelta(seconds=s), t, f) for i, s, t, f in rows]
    spark.createDataFrame(table, KINDS).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(KINDS).parquet(str(tmp_path / "in"))
    found = mail_versions(stream, "id", "at", ["text"], delay="10 seconds", horizon_seconds=100)
    query = (
        found.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query.recentProgress


def result(spark, tmp_path):
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    return sorted((r.id, int((r.at - START).total_seconds()), r.text, r.version, r.kind) for r in rows)


def test_each_content_once(spark, tmp_path):
    feed(spark, tmp_path, [("a", 5, "x", "in"), ("a", 1, "x", "sent"), ("a", 7, "y", "in"), ("b", 3, None, "in"), (None, 1, "z", "in"), ("n", None, "z", "in")])
    assert result(spark, tmp_path) == [("a", 1, "x", 1, "new"), ("a", 7, "y", 2, "changed"), ("b", 3, None, 1, "new")]
    # Repeats, a return to an old content, and a change, after a restart.
    feed(spark, tmp_path, [("a", 9, "x", "in"), ("a", 8, "y", "in"), ("b", 20, "new text", "in"), ("c", 50, "x", "in")])
    assert result(spark, tmp_path)[-2:] == [("b", 20, "new text", 2, "changed"), ("c", 50, "x", 1, "new")]
    assert len(result(spark, tmp_path)) == 5
    # Far behind the latest, which is 50: dropped whatever it is.
    feed(spark, tmp_path, [("a", 30, "late", "in"), ("d", 39, "late", "in"), ("c", 60, "x", "in")])
    assert len(result(spark, tmp_path)) == 5


def test_state_is_dropped_behind_the_watermark(spark, tmp_path):
    first = feed(spark, tmp_path, [(f"m{i}", i % 50, f"text {i}", "in") for i in range(200)])
    assert first[-1].stateOperators[0].numRowsTotal > 0
    last = feed(spark, tmp_path, [("other", 1000, "x", "in")])
    rows = [p.stateOperators[0].numRowsTotal for p in last if p.stateOperators]
    assert rows[-1] < 10 < max(rows[0], first[-1].stateOperators[0].numRowsTotal)
    # Forgotten, so new again; the one that is remembered is a repeat.
    feed(spark, tmp_path, [("m7", 1001, "text 7", "in"), ("other", 1002, "x", "in")])
    again = [r for r in result(spark, tmp_path) if r[0] in ("m7", "other")]
    assert again == [("m7", 7, "text 7", 1, "new"), ("m7", 1001, "text 7", 1, "new"), ("other", 1000, "x", 1, "new")]


def test_other_columns_pass(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    feed(spark, tmp_path, [("a", 1, "x", "in")])
    row = spark.read.parquet(str(tmp_path / "out")).first()
    assert row.folder == "in" and len(row.fingerprint) == 64
    assert spark.read.parquet(str(tmp_path / "out")).where(F.col("kind").isNull()).count() == 0
    feed(spark, tmp_path, [("b", 1000, "x", "in")])
    feed(spark, tmp_path, [("a", 1001, "x", "in")])  # forgotten by the stream's time, not the zone's
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert spark.read.parquet(str(tmp_path / "out")).where("id = 'a'").count() == 2
