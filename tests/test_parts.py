"""Parts of mails against the email package, in SQL and as a function."""

from email.message import EmailMessage

from pyspark.sql import functions as F

from postmill.operators.routing import route_requests
from postmill.sources.parts import attachment_names, register_mail_parts, with_parts
from test_sources import BAD_CHARSET, BINARY, attachment_first, mail


def nested():
    inner = EmailMessage()
    inner["Subject"] = "inner"
    inner.set_content("inside")
    inner.add_attachment(b"\x00\x01", maintype="image", subtype="png", filename="p é.png")
    message = EmailMessage()
    message.set_content("hello")
    message.add_alternative("<p>hello</p>", subtype="html")
    message.add_attachment("a,b\n", subtype="csv", filename="t.csv")
    message.add_attachment(inner)
    return message.as_bytes()


MAILS = [
    ("nested", nested()), ("plain", mail("s", "text")), ("charset", BAD_CHARSET), ("binary", BINARY),
    ("first", attachment_first()), ("empty", b""), ("null", None), ("junk", b"\xff\xfe\x00 no mail"),
]


def table(spark):
    rows = [(k, None if c is None else bytearray(c), "x", 7) for k, c in MAILS]
    return spark.createDataFrame(rows, "path string, content binary, file_name_of string, part int")


def test_parts(spark):
    rows = with_parts(table(spark)).orderBy("path", "part_no").collect()
    found = {}
    for r in rows:
        found.setdefault(r.path, []).append((r.part_no, r.content_type, r.file_name, r.is_attachment, r.size, r.error))
    assert set(found) == {k for k, _ in MAILS}
    assert found["nested"] == [
        (0, "text/plain", None, False, 6, None), (1, "text/html", None, False, 13, None), (2, "text/csv", "t.csv", True, 4, None),
        (3, "text/plain", None, False, 7, None), (4, "image/png", "p é.png", True, 2, None),
    ]
    assert found["charset"][0][5].startswith("LookupError")
    assert found["binary"] == [(0, "image/png", None, False, 2, None)]
    assert [p[2] for p in found["first"]] == [None, "notes.txt"]
    assert found["empty"] == found["null"] == [(0, "text/plain", None, False, 0, None)]
    assert rows[0].file_name_of == "x" and rows[0].part == 7


def test_parts_in_sql(spark):
    register_mail_parts(spark)
    table(spark).createOrReplaceTempView("some_mails")
    found = spark.sql("select path, part_no, size from some_mails, lateral mail_parts(content) where is_attachment")
    assert sorted((r.path, r.part_no, r.size) for r in found.collect()) == [("first", 1, 6), ("nested", 2, 4), ("nested", 4, 2)]


def test_names_reach_the_prompt(spark):
    names = attachment_names(table(spark))
    rows = {r.path: r.attachments for r in names.collect()}
    assert rows["nested"] == ["t.csv", "p é.png"] and rows["plain"] == [] and rows["null"] == []
    requests = names.select(
        F.lit("attachment").alias("task"), F.col("path").alias("subject"), F.lit("b").alias("body"), "attachments"
    )
    users = {r.subject: r.messages[1].content for r in route_requests(requests).collect()}
    assert "t.csv, p é.png" in users["nested"] and "t.csv" not in users["plain"]
