"""Mails as a data source: batch against the folder reader, streams that stop and go on."""

import os
import time

import pytest
from pyspark.sql import functions as F

from postmill.sources.filesystems import ArrowFiles, MountedFiles, open_files
from postmill.sources.mail_source import (
    MailReader,
    MailStreamReader,
    list_files,
    plan_splits,
    read_mail_files,
    stream_mail_files,
    write_mail_files,
)
from postmill.operators.cleaning import accepted, clean_records, quarantined
from postmill.sources.maildir import read_mails
from postmill.streaming.incremental import start_mail_stream
from test_sources import MAILS, mail, relative


@pytest.fixture
def maildir(tmp_path):
    for name, content in MAILS.items():
        path = tmp_path / "mail" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return str(tmp_path / "mail")


def records(frame):
    return sorted((r.path, r.subject, r.body_kind, r.body, r.error) for r in frame.collect())


def test_batch_equals_the_folder_reader(spark, maildir):
    want = records(read_mails(spark, maildir))
    assert records(read_mail_files(spark, maildir)) == want
    assert records(read_mail_files(spark, maildir, split_bytes=1)) == want
    by_address = records(read_mail_files(spark, f"file://{maildir}"))
    assert [(p.removeprefix("file://"), *rest) for p, *rest in by_address] == want
    assert all(p.startswith("file:///") for p, *_ in by_address)


def test_bad_entries_are_rows(spark, tmp_path):
    os.mkdir(tmp_path / "a")
    for name in (b"/a/1.", b"/a/\xff."):
        with open(os.fsencode(tmp_path) + name, "wb") as file:
            file.write(mail("s", "body"))
    os.symlink(tmp_path / "nowhere", tmp_path / "a" / "gone.")
    rows = {os.path.basename(r.path): r for r in read_mail_files(spark, str(tmp_path)).collect()}
    assert rows["1."].error is None and rows["\\xff."].error.startswith("UnicodeEncodeError")
    assert set(rows) == {"1.", "\\xff."}
    listed = list_files(spark, str(tmp_path))
    os.remove(tmp_path / "a" / "1.")
    lost = spark.read.format("mails").option("manifest", plan_splits(listed)).load()
    assert {r.error.split(":")[0] for r in lost.collect()} == {"UnicodeEncodeError", "FileNotFoundError"}
    with pytest.raises(FileNotFoundError):
        list_files(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="no file system"):
        read_mail_files(spark, "nofs://x/y")
    assert read_mail_files(spark, str(tmp_path / "a")).where("error is null").count() == 0
    os.mkdir(tmp_path / "empty")
    assert read_mail_files(spark, str(tmp_path / "empty")).count() == 0


def test_conditions_reach_the_reader(spark, maildir):
    frame = read_mail_files(spark, maildir)
    some = frame.where(F.col("path").contains("/bob/") & ~F.col("path").endswith("3.") & F.col("subject").isNotNull())
    assert relative([r.path for r in some.collect()], maildir) == [
        "bob/1.", "bob/2.", "bob/5.", "bob/6.", "bob/deep/er/still/7.",
    ]
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("Filter") :].split("\n")[0]
    assert "Contains" not in filters and "EndsWith" not in filters


def test_splits_hold_about_as_many_bytes(spark, tmp_path):
    sizes = [10, 100_000, 30_000] * 40
    rows = [(f"/mail/{i}.", n, 0, None) for i, n in enumerate(sizes)]
    files = spark.createDataFrame(rows, "path string, size bigint, changed bigint, error string")
    target = plan_splits(files, split_bytes=400_000)
    splits = spark.read.parquet(target).groupBy("split").agg(F.sum(F.col("size") + (16 << 10)).alias("bytes"), F.count("*").alias("n")).collect()
    assert sum(s.n for s in splits) == 120
    assert max(s.bytes for s in splits) <= 400_000 + 100_000 + (16 << 10) and len(splits) <= 30
    parts = MailReader(target).partitions()
    assert len(parts) == len(splits) and all(len(p.files) == 1 for p in parts)


def test_both_file_systems(tmp_path):
    files, root = open_files(str(tmp_path))
    arrow, address = open_files(f"file://{tmp_path}")
    assert isinstance(files, MountedFiles) and isinstance(arrow, ArrowFiles)
    files.write(f"{root}/a/b", b"one")
    arrow.write(f"{address}/a/c", b"two")
    arrow.write(f"{address}/a/c", b"three")
    mounted = sorted((e.path, e.is_folder, e.size) for e in files.entries(f"{root}/a"))
    assert mounted == [(f"{root}/a/b", False, 3), (f"{root}/a/c", False, 5)]
    assert sorted((e.path.removeprefix("file://"), e.is_folder, e.size) for e in arrow.entries(f"{address}/a")) == mounted
    assert arrow.read(f"{address}/a/b") == b"one" and files.read(f"{root}/a/c") == b"three"
    for one, path in ((files, f"{root}/a/b"), (arrow, f"{address}/a/c")):
        one.delete(path)
        one.delete(path)
    assert not list(files.entries(f"{root}/a"))


def test_mails_are_written(spark, tmp_path):
    rows = [("/x/_sent/1.", bytearray(mail("s", "b"))), ("y", None)]
    table = spark.createDataFrame(rows, "path string, content binary")
    assert [r.error for r in write_mail_files(table, str(tmp_path / "out")).collect()] == [None, None]
    assert records(read_mail_files(spark, str(tmp_path / "out"))) == records(read_mails(spark, str(tmp_path / "out")))
    (tmp_path / "file").write_text("")
    failed = write_mail_files(table, str(tmp_path / "file")).collect()
    assert all(r.error.startswith(("NotADirectory", "FileExists")) for r in failed)


def run(spark, maildir, tmp_path, **options):
    frame = stream_mail_files(spark, maildir, str(tmp_path / "log"), settleSeconds="0", **options)
    query = (
        frame.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
    )
    return query.trigger(processingTime="0 seconds").start()


def wait(query, rows, spark, tmp_path):
    for _ in range(300):
        if query.exception():
            raise query.exception()
        try:
            if spark.read.parquet(str(tmp_path / "out")).count() >= rows:
                return
        except Exception:  # noqa: BLE001 - nothing is written yet
            pass
        time.sleep(0.2)
    raise AssertionError("no rows in time")


def test_stream_goes_on_after_a_stop(spark, maildir, tmp_path):
    """Names with an underscore are seen, nothing is read twice, a changed mail is read again."""
    visible = len(MAILS) - 1
    first = run(spark, maildir, tmp_path, maxFilesPerTrigger="5", filesPerTask="2")
    wait(first, 5, spark, tmp_path)
    first.stop()
    for name in ("ann/_sent_mail/new", "ann/.hid/_new"):
        with open(f"{maildir}/{name}", "wb") as file:
            file.write(mail(name, "late"))
    second = run(spark, maildir, tmp_path, maxFilesPerTrigger="5", filesPerTask="2")
    wait(second, visible + 2, spark, tmp_path)
    second.processAllAvailable()
    second.stop()
    assert records(spark.read.parquet(str(tmp_path / "out"))) == records(read_mails(spark, maildir))
    time.sleep(0.05)
    with open(f"{maildir}/8.", "wb") as file:
        file.write(mail("top", "changed"))
    third = run(spark, maildir, tmp_path)
    wait(third, visible + 3, spark, tmp_path)
    third.stop()
    tops = spark.read.parquet(str(tmp_path / "out")).where("path like '%/8.'").collect()
    assert sorted(r.body.strip() for r in tops) == ["changed", "level"]


def test_offsets_go_by_the_log(maildir, tmp_path):
    log = str(tmp_path / "log")
    one = MailStreamReader(maildir, log, 4, 0, 3)
    start = one.initialOffset()
    first = one.latestOffset()
    again = MailStreamReader(maildir, log, 4, 0, 3)  # a restart before the offset was used
    second = again.latestOffset()
    assert (first["listing"], second["listing"]) == (1, 2)
    read = lambda reader, a, b: sorted(p for s in reader.partitions(a, b) for batch in reader.read(s) for p in batch.column("path").to_pylist())
    both = read(again, start, second)
    assert both == sorted(read(one, start, first) + read(again, first, second)) and len(set(both)) == 8
    assert max(len(s.files) for s in again.partitions(start, second)) == 1
    waiting = MailStreamReader(maildir, str(tmp_path / "other"), 4, 3600, 3)
    assert waiting.latestOffset() == start and waiting.partitions(start, start) == []


def test_cleaned_stream_equals_batch(spark, maildir, tmp_path):
    """Hidden names as well, cleaned and in quarantine, from a stream that is started twice."""
    output, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        frame = stream_mail_files(spark, maildir, str(tmp_path / "log"), settleSeconds="0", maxFilesPerTrigger="4")
        query = start_mail_stream(frame, output, state, processingTime="0 seconds")
        query.processAllAvailable()
        query.stop()
    batch = clean_records(read_mail_files(spark, maildir))
    expected = accepted(batch)
    found = spark.read.schema(expected.schema).json(f"{output}/clean").select(expected.columns)
    assert sorted(found.collect()) == sorted(expected.collect()) and found.count() == len(MAILS) - 2
    lost = spark.read.schema("path string, error string").json(f"{output}/quarantine")
    assert sorted(lost.select("path", "error").collect()) == sorted(quarantined(batch).collect())
