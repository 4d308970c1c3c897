import base64
import json
import os
from email.message import EmailMessage

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postmill.operators.cleaning import accepted, clean_records, quarantined
from postmill.plans.corpus import clean_corpus, label_corpus, training_text
from postmill.sources.jsonl import (
    read_chat_examples,
    read_clean_emails,
    write_chat_examples,
    write_clean_emails,
)
from postmill.sources.maildir import (
    _list_folders,
    list_mails,
    read_binary_mails,
    read_mails,
    read_raw_mails,
)
from postmill.sources.mime import body_text, parse_mails
from postmill.sources.texts import nonblank_bodies, read_text_bodies, sample_messages
from postmill.streaming.incremental import start_mail_stream, stream_raw_mails


def mail(subject=None, text=None, html=None):
    message = EmailMessage()
    if subject is not None:
        message["Subject"] = subject
    if text is not None:
        message.set_content(text)
        if html is not None:
            message.add_alternative(html, subtype="html")
    elif html is not None:
        message.set_content(html, subtype="html")
    return message.as_bytes()


def attachment_first():
    message = EmailMessage()
    message["Subject"] = "mixed"
    message.set_content("<p>page</p>", subtype="html")
    message.add_attachment("notes", filename="notes.txt")
    return message.as_bytes()


BAD_CHARSET = b"Subject: bad\nContent-Type: text/plain; charset=nope\n\ncaf\xe9\n"
BINARY = b"Content-Type: image/png\nContent-Transfer-Encoding: base64\n\n" + base64.b64encode(b"\x89x")

MAILS = {
    "ann/inbox/1.": mail("Plan", "hello there\r\nhttp://a.example/x.\n\nThanks\nAnn"),
    "ann/_sent_mail/1.": mail("café \U0001f600", "sent"),
    "ann/inbox/_u": mail(None, "no subject"),
    "ann/.hid/5.": mail("hidden folder", "x"),
    "ann/inbox/.dot": mail("dot file", "x"),
    "bob/1.": mail("both", "plain part", "<p>html part</p>"),
    "bob/2.": mail("html", None, "<style>p{}</style><p>a</p><p>b &amp; c</p>"),
    "bob/3.": BAD_CHARSET,
    "bob/4.": BINARY,
    "bob/5.": attachment_first(),
    "bob/6.": mail("empty plain", "", "<p>page</p>"),
    "bob/deep/er/still/7.": b"",
    "8.": mail("top", "level"),
}


@pytest.fixture(scope="module")
def maildir(tmp_path_factory):
    root = tmp_path_factory.mktemp("maildir")
    for name, content in MAILS.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    return str(root)


def relative(paths, root):
    return sorted(os.path.relpath(p.removeprefix("file:"), root) for p in paths)


def test_listing_sees_hidden_folders_but_no_dot_files(spark, maildir):
    listed = [r.path for r in list_mails(spark, maildir).collect()]
    assert relative(listed, maildir) == sorted(set(MAILS) - {"ann/inbox/.dot"})
    assert sorted(r.path for r in list_mails(spark, f"file://{maildir}").collect()) == sorted(listed)
    with pytest.raises(ValueError, match="read_binary_mails"):
        list_mails(spark, "s3://bucket/mail")


def test_bad_entries_are_rows_with_a_reason(spark, tmp_path):
    root = os.fsencode(tmp_path)
    os.mkdir(root + b"/a")
    for name in (b"/a/1.", b"/a/\xff."):
        with open(root + name, "wb") as file:
            file.write(mail("s", "body"))
    rows = {os.path.basename(r.path): r for r in read_mails(spark, str(tmp_path)).collect()}
    assert rows["1."].error is None and rows["1."].body.strip() == "body"
    assert rows["\\xff."].error.startswith("UnicodeEncodeError") and rows["\\xff."].body is None
    gone = pa.RecordBatch.from_pydict({"path": [str(tmp_path / "gone"), str(tmp_path / "a")]})
    (first, second) = _list_folders([gone], strict=False)
    assert first.column("error")[0].as_py().startswith("FileNotFoundError")
    assert second.num_rows == 2
    with pytest.raises(FileNotFoundError):
        list(_list_folders([gone], strict=True))
    lost = spark.createDataFrame([(str(tmp_path / "gone"),)], "path string")
    assert read_raw_mails(lost).first().content is None


def test_strict_reading_wants_the_clean_text(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"path": "a"}\n')
    assert read_clean_emails(spark, str(tmp_path), strict=False).first().clean_text is None
    with pytest.raises(Exception, match="without clean_text"):
        read_clean_emails(spark, str(tmp_path)).collect()


def test_mails_are_parsed(spark, maildir):
    parsed = read_mails(spark, maildir)
    rows = {
        os.path.relpath(r.path, maildir): r
        for r in parsed.select(
            "*", body_text(F.col("body_kind"), F.col("body")).alias("text")
        ).collect()
    }
    texts = {name: row.text for name, row in rows.items()}
    assert rows["ann/_sent_mail/1."].subject == "café \U0001f600"
    assert rows["ann/inbox/_u"].subject == ""
    assert texts["bob/1."] == "plain part"
    assert texts["bob/2."].split() == ["a", "b", "&", "c"]
    assert texts["bob/3."] == ""
    assert texts["bob/5."] == "notes"
    assert texts["bob/6."] == ""
    assert texts["bob/deep/er/still/7."] == ""
    assert rows["bob/4."].error == "TypeError: the body is binary" and texts["bob/4."] is None


def test_raw_readers_agree(spark, maildir):
    raw = read_raw_mails(list_mails(spark, maildir))
    assert {r.length for r in raw.collect()} == {
        len(c) for n, c in MAILS.items() if n != "ann/inbox/.dot"
    }
    folders = [maildir, f"{maildir}/ann/_sent_mail", f"{maildir}/ann/.hid"]
    seen = relative([r.path for r in read_binary_mails(spark, *folders).collect()], maildir)
    # Spark's file source cannot see an empty file or a name that starts with an underscore.
    unseen = {"ann/inbox/.dot", "ann/inbox/_u", "bob/deep/er/still/7."}
    assert seen == sorted(set(MAILS) - unseen)


def test_unreadable_file_is_reported(spark, maildir):
    gone = spark.createDataFrame([(f"{maildir}/gone",)], "path string")
    row = read_raw_mails(gone).first()
    assert row.content is None and row.length is None


def test_clean_corpus(spark, maildir, tmp_path):
    out = str(tmp_path / "clean")
    failures = clean_corpus(spark, maildir, out).collect()
    assert [os.path.relpath(f.path, maildir) for f in failures] == ["bob/4."]
    rows = {os.path.relpath(r.path, maildir): r for r in read_clean_emails(spark, out).collect()}
    assert len(rows) == len(MAILS) - 2
    assert rows["ann/inbox/1."].asDict() == {
        "source": "enron",
        "path": f"{maildir}/ann/inbox/1.",
        "subject": "Plan",
        "clean_text": "Subject: Plan\nhello there http://a.example/x.",
        "urls": ["http://a.example/x"],
    }


def test_label_corpus(spark, maildir, tmp_path):
    from postmill.operators.inference import model_teacher
    from postmill.plans.stub_teacher import StubClient

    clean, out = str(tmp_path / "clean"), str(tmp_path / "labelled")
    clean_corpus(spark, maildir, clean)
    for lenient in (False, True):
        labels = label_corpus(
            spark, clean, out, model_teacher(StubClient), lenient=lenient, limit=6
        )
        assert labels.count() == 6
        examples = read_chat_examples(spark, out)
        assert examples.count() == labels.where("label is not null").count() > 0
        assert training_text(examples).columns == ["text"]
    everything = label_corpus(spark, clean, out, model_teacher(StubClient))
    assert everything.count() == len(MAILS) - 2


def test_stream_equals_batch(spark, maildir, tmp_path):
    output, state = str(tmp_path / "out"), str(tmp_path / "state")
    folders = stream_raw_mails(spark, f"{maildir}/bob", max_files=2)
    start_mail_stream(folders, output, state).awaitTermination()
    batch = parse_mails(read_binary_mails(spark, f"{maildir}/bob"))
    expected = accepted(clean_records(batch))
    columns, schema = expected.columns, expected.schema
    streamed = spark.read.schema(schema).json(f"{output}/clean")
    assert sorted(streamed.select(columns).collect()) == sorted(expected.collect())
    failed = spark.read.schema("path string, error string").json(f"{output}/quarantine")
    assert sorted(failed.select("path", "error").collect()) == sorted(quarantined(batch).collect())
    # A second run with the same state finds nothing new.
    start_mail_stream(stream_raw_mails(spark, f"{maildir}/bob"), output, state).awaitTermination()
    assert spark.read.schema(schema).json(f"{output}/clean").count() == streamed.count()


def test_surrogates_are_quarantined(spark):
    raw = spark.createDataFrame([("p", bytearray(b"Subject: \xff\xfe\n\nok"))], "path string, content binary")
    row = parse_mails(raw).first()
    assert (row.error is None) != (row.body is None)


def test_clean_jsonl(spark, tmp_path):
    path = str(tmp_path / "clean")
    rows = [
        ("a", "p1", "s   \x85", "t\né\U0001f600", ["http://x"]),
        ("a", "p2", None, "", []),
    ]
    table = spark.createDataFrame(rows, "source string, path string, subject string, clean_text string, urls array<string>")
    write_clean_emails(table.limit(1), path)
    assert write_clean_emails(table, path) == 2
    lines = [r.value for r in spark.read.option("lineSep", "\n").text(path).collect()]
    assert any("é\U0001f600" in line for line in lines)
    assert all(set(json.loads(line)) == set(table.columns) for line in lines)
    assert sorted(read_clean_emails(spark, path).collect(), key=lambda r: r.path) == table.collect()


def test_jsonl_reading_modes(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('{"source":"a","path":"p","subject":"s","clean_text":"t","urls":[]}\n\n  \nnot json\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_clean_emails(spark, str(path)).collect()
    rows = read_clean_emails(spark, str(path), strict=False).collect()
    assert sorted(r._corrupt_record or "" for r in rows) == ["", "not json"]


def test_chat_jsonl(spark, tmp_path):
    path = str(tmp_path / "chat")
    schema = "id int, messages array<struct<role:string,content:string>>"
    table = spark.createDataFrame([(1, [("user", "a\nb"), ("assistant", "c")])], schema)
    assert write_chat_examples(table, path) == 1
    assert read_chat_examples(spark, path).first().messages == table.first().messages


def test_texts(spark, tmp_path):
    (tmp_path / "a.txt").write_text("  one\n two  \n")
    (tmp_path / "b.txt").write_text(" 　\n")
    bodies = nonblank_bodies(read_text_bodies(spark, str(tmp_path))).collect()
    assert [r.body for r in bodies] == ["one\n two"]


def test_sample_messages(spark):
    rows = sample_messages(spark, as_of=F.lit("2024-05-06 07:08:09").cast("timestamp")).collect()
    assert [(r.id, r.subject) for r in rows] == [
        (f"stub-{i}", f"Sample message {i + 1}") for i in range(3)
    ]
    assert rows[0].body.endswith("\n\nThanks!") and rows[0].received_at.year == 2024
    assert sample_messages(spark, 0).count() == 0
