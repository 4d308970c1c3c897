"""Mail-shaped inputs derived row by row from the test tables.

The tables hold prose and web pages without the traits of mail. These expressions add
them: quotes, signatures, links, MIME structure, model drafts. They are SQL that both
Spark and DuckDB read, every row of a table gives one row, and whole texts are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


SUBJECT = """
case doc_id % 3 when 0 then '' when 1 then null
  else concat('Re: item ', cast(doc_id as string)) end"""

BODY = """
case doc_id % 8
  when 0 then text
  when 1 then concat(text, chr(10), 'Thanks,', chr(10), 'Ann')
  when 2 then concat(text, chr(10), 'On Mon, Bob <bob@example.com> wrote:', chr(10),
                     '> old http://old.example.com/x')
  when 3 then concat(text, ' See https://example.com/d/', cast(doc_id as string),
                     '). Also HTTP://EX.org/a, and', chr(9), chr(160),
                     'http://b.example.com/q?x=1.', chr(10), '--', chr(10),
                     'http://sig.example.com')
  when 4 then concat('Thanks for the note', chr(10), text)
  when 5 then concat(text, chr(13), chr(10), '-----Original Message-----', chr(13), chr(10),
                     'From: x@y.example', chr(13), chr(10), 'old')
  when 6 then concat('  ', text, chr(10), 'From:', chr(10), 'tail', chr(10), chr(10))
  else null end"""

BLANKABLE = f"case when doc_id % 5 = 0 then concat(chr(9), ' ', chr(160), chr(10)) else {BODY} end"

_FLAT = "replace(text, chr(10), ' ')"
_LINES = (
    "concat('1) Purpose: note ', cast(doc_id as string), chr(10))",
    f"concat('2) Key details: ', {_FLAT}, chr(10))",
    "concat('3) Action needed: N/A', chr(10))",
    "concat('4) Deadline/Date: ', lang, chr(10))",
    "concat('5) Important context/links: ', source)",
)
_GOOD = f"concat({', '.join(_LINES)})"

DRAFT = f"""
case doc_id % 7
  when 0 then {_GOOD}
  when 1 then lower({_GOOD})
  when 2 then concat('1) Purpose:', chr(10), chr(10), {', '.join(_LINES[1:])})
  when 3 then concat('Here it is:', chr(10), {_LINES[0]})
  when 4 then concat('2) Key details: ', {_FLAT}, chr(10), '1) Purpose: x', chr(10),
                     '9) Action needed: y', chr(10), {', '.join(_LINES[3:])})
  when 5 then concat({_LINES[0]}, '  ', {', '.join(_LINES[1:])})
  else '' end"""

TASK = """
case doc_id % 9 when 0 then 'summarize' when 1 then 'reply' when 2 then 'Rewrite'
  when 3 then 'phishing' when 4 then 'SPAM' when 5 then 'categorize'
  when 6 then 'attachment' when 7 then 'search' else 'translate' end"""
TONE = "case when doc_id % 2 = 0 then 'friendly' else null end"
STYLE = "case when doc_id % 4 = 0 then 'short' else null end"
LENGTH = "case when doc_id % 3 = 0 then 'long' else null end"

# A model's reply to a request: some with a wrong label, some without their second line.
REPLY = """
concat(case lower(task)
  when 'phishing' then concat('Label: ', case doc_id % 4 when 0 then 'PHISHING' when 1 then 'benign ' else 'maybe' end)
  when 'spam' then concat('label:', case doc_id % 4 when 0 then 'spam' when 1 then ' ham' else '' end)
  when 'categorize' then concat('category: ', case doc_id % 4 when 0 then 'finance' when 1 then 'Support' else 'Nothing' end)
  when 'attachment' then concat('  summary: file ', cast(doc_id as string))
  else 'free text' end,
  case when doc_id % 3 = 0 then '' else concat(chr(10),
    case lower(task) when 'attachment' then 'checks' else 'reason' end, ': see ', cast(doc_id as string)) end)"""

MAIL_PATH = """
concat('/mail/user', cast(doc_id % 100 as string), case doc_id % 5
  when 0 then '/_sent_mail/' when 1 then '/.archive/' when 2 then '/inbox/.'
  when 3 then '/inbox/_' else '/inbox/' end, cast(doc_id as string), '.')"""

# Mails as they arrive at a stream: for each run, which documents, their times and texts.
ARRIVALS = (
    (("true", "1700000000 + doc_id % 1000", "text"),),
    (
        ("doc_id % 3 = 0", "1700001000 + doc_id % 10", "text"),
        ("doc_id % 5 = 0", "1700001000 + doc_id % 10", "concat(text, ' v2')"),
    ),
    (("doc_id % 7 = 0", "1700172800 + 0 * doc_id", "text"),),
    (
        ("doc_id % 11 = 0", "1700172860 + 0 * doc_id", "text"),
        ("doc_id % 13 = 0", "1700005000 + 0 * doc_id", "concat(text, ' late')"),
    ),
)

# Where an empty file stands beside the mails.
EMPTY_EVERY = 97
EMPTY_PATH = "concat('/mail/empty/_', cast(doc_id as string))"

BOUNDARY = "=_postmill"
MAIL_SHAPES = 11


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", *columns)


def emails(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, subject, body``."""
    return documents(spark, folder, "text").selectExpr(
        "doc_id", f"{SUBJECT} as subject", f"{BODY} as body"
    )


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    """``conv_id, messages``: the turns of each conversation, in their order.

    All turns of a conversation come into one row, as a chat example is one; its length is the
    conversation's.
    """
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    said = F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    return table(spark, folder, "conversations").groupBy("conv_id").agg(said.alias("messages"))


def drafts(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, subject, body, draft``: mails with a model's reply to each."""
    return documents(spark, folder, "text", "lang", "source").selectExpr(
        "doc_id", f"{SUBJECT} as subject", f"{BODY} as body", f"{DRAFT} as draft"
    )


def labelled_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``value``: each document as a labelled record, in one of three shapes with keys of their own."""
    text, number = F.coalesce("text", F.lit("")), F.col("doc_id")
    meta = F.struct(F.col("lang").alias("lang"), F.col("source").alias("from"))

    def pairs(first: str, second: str, names: tuple[str, str]) -> Column:
        made = [
            F.struct(F.lit(name).alias(first), content.alias(second))
            for name, content in zip(names, (text, F.col("source")), strict=True)
        ]
        return F.array(*made)

    shapes = [
        F.struct(number.alias("id"), pairs("role", "content", ("user", "assistant")).alias("messages"), meta.alias("meta")),
        F.struct(pairs("from", "value", ("human", "gpt")).alias("conversations"), number.alias("id")),
        F.struct(text.alias("prompt"), F.col("source").alias("response"), F.lit("x").alias("system")),
    ]
    value = F.lit(None).cast("string")
    for shape, made in enumerate(shapes):
        value = F.when(number % len(shapes) == shape, F.to_json(made)).otherwise(value)
    rows = documents(spark, folder, "text", "lang", "source").where("doc_id is not null and source is not null and lang is not null")
    return rows.select(value.alias("value"))


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id`` and the columns of a task request."""
    rows = documents(spark, folder, "text").selectExpr(
        "doc_id",
        f"{TASK} as task",
        f"{SUBJECT} as subject",
        f"{BODY} as body",
        f"{TONE} as tone",
        f"{STYLE} as style",
        f"{LENGTH} as length",
    )
    names = F.array(F.lit("Billing"), F.lit("Finance"))
    files = F.array(
        F.concat(F.lit("report"), F.col("doc_id").cast("string"), F.lit(".pdf")), F.lit("a.xlsx")
    )
    return rows.withColumns(
        {
            "categories": F.when(F.col("doc_id") % 2 == 0, names),
            "attachments": F.when(F.col("doc_id") % 2 == 0, files).otherwise(F.array().cast("array<string>")),
        }
    )


def _part(kind: str, content: Column, charset: str = "utf-8") -> Column:
    head = f"Content-Type: {kind}; charset={charset}\nContent-Transfer-Encoding: 8bit\n\n"
    return F.concat(F.lit(f"--{BOUNDARY}\n{head}"), content, F.lit("\n"))


def _multipart(*parts: Column) -> Column:
    head = f"Content-Type: multipart/alternative; boundary=\"{BOUNDARY}\"\n\n"
    return F.concat(F.lit(head), *parts, F.lit(f"--{BOUNDARY}--\n"))


def _nested(first: Column, *others: Column) -> Column:
    """A mixed mail whose first part is itself a multipart."""
    outer = f"{BOUNDARY}_outer"
    head = f"Content-Type: multipart/mixed; boundary=\"{outer}\"\n\n"
    parts = []
    for part in others:
        parts += [F.lit(f"--{outer}\n"), F.substring_index(part, f"--{BOUNDARY}\n", -1)]
    return F.concat(F.lit(f"{head}--{outer}\n"), first, *parts, F.lit(f"--{outer}--\n"))


def _single(kind: str, content: Column) -> Column:
    head = f"Content-Type: {kind}; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n"
    return F.concat(F.lit(head), content)


def _encoded(kind: str, content: Column) -> Column:
    head = f"Content-Type: {kind}; charset=utf-8\nContent-Transfer-Encoding: base64\n\n"
    return F.concat(F.lit(head), F.base64(F.encode(content, "UTF-8")), F.lit("\n"))


def raw_mail(variant: Column, subject: Column, text: Column, html: Column) -> Column:
    """RFC-822 bytes in one of ``MAIL_SHAPES`` shapes, by variant number."""
    empty = F.lit("")
    shapes = [
        _single("text/plain", text),
        _multipart(_part("text/plain", text), _part("text/html", F.lit("<p>other</p>"))),
        _multipart(_part("text/html", F.lit("<p>other</p>")), _part("text/plain", text)),
        _multipart(_part("text/html", html)),
        _single("text/html", html),
        _encoded("text/html", html),
        _multipart(_part("text/plain", text, "no-such-set"), _part("text/html", html)),
        _encoded("text/plain", text),
        _multipart(_part("text/plain", empty), _part("text/html", html)),
        _encoded("application/octet-stream", text),
        _nested(
            _multipart(_part("text/html", html), _part("text/plain", text)),
            _part("text/plain", F.lit("an attachment")),
        ),
    ]
    body = F.lit(None).cast("string")
    for number, shape in enumerate(shapes):
        body = F.when(variant == number, shape).otherwise(body)
    encoded_word = F.concat(F.lit("=?utf-8?b?"), F.base64(F.encode(subject, "UTF-8")), F.lit("?="))
    header = F.when(F.length(subject) > 0, F.concat(F.lit("Subject: "), encoded_word, F.lit("\n")))
    head = F.concat(F.lit("From: a@example.com\nMIME-Version: 1.0\n"), F.coalesce(header, F.lit("")))
    return F.encode(F.concat(head, body), "UTF-8")


def raw_mails(spark: SparkSession, folder: str) -> DataFrame:
    """``path, content``: the documents as raw mails."""
    rows = documents(spark, folder, "text").selectExpr(
        "doc_id", f"{MAIL_PATH} as path", f"{SUBJECT} as subject", f"{BODY} as body"
    )
    body = F.coalesce("body", F.lit(""))
    escaped = F.replace(F.replace(body, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    html = F.concat(
        F.lit("<html><head><style>p{}</style></head><body><p title='a>b'>"),
        escaped,
        F.lit('</p><script>var x = "</p>";</script></body></html>'),
    )
    content = raw_mail(F.col("doc_id") % MAIL_SHAPES, F.col("subject"), body, html)
    return rows.select("path", content.alias("content"))


def attachment_mails(spark: SparkSession, folder: str) -> DataFrame:
    """``path, content``: mails with none, one or two attachments that hold the document, or
    with one in a character set that does not exist."""
    rows = documents(spark, folder, "text").where("doc_id is not null")
    number = F.col("doc_id").cast("string")
    coded = F.base64(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    bound = f"{BOUNDARY}_parts"

    def attached(kind: str, name: Column | str, content: Column) -> Column:
        name = F.lit(name) if isinstance(name, str) else name
        head = f"--{bound}\nContent-Type: {kind}\nContent-Transfer-Encoding: base64\nContent-Disposition: attachment; "
        return F.concat(F.lit(head), name, F.lit("\n\n"), content, F.lit("\n"))

    hello = F.concat(F.lit(f"--{bound}\nContent-Type: text/plain\n\nsee "), number, F.lit("\n"))
    pdf = attached("application/pdf", F.concat(F.lit('filename="report'), number, F.lit('.pdf"')), coded)
    table_ = attached("text/csv; charset=utf-8", F.concat(F.lit("filename*=utf-8''na%C3%AFve%20"), number, F.lit(".csv")), coded)
    odd = attached("text/plain; charset=no-such-set", "filename=odd.txt", coded)
    empty = F.lit("")
    parts = F.when(F.col("doc_id") % 4 == 1, pdf).when(F.col("doc_id") % 4 == 2, F.concat(pdf, table_))
    parts = parts.when(F.col("doc_id") % 4 == 3, odd).otherwise(empty)
    head = f'From: a@example.com\nMIME-Version: 1.0\nContent-Type: multipart/mixed; boundary="{bound}"\n\n'
    mail = F.encode(F.concat(F.lit(head), hello, parts, F.lit(f"--{bound}--\n")), "UTF-8")
    return rows.select(number.alias("path"), mail.alias("content"))


def empty_mails(spark: SparkSession, folder: str) -> DataFrame:
    """``path, content``: some empty files."""
    some = documents(spark, folder).where(f"doc_id % {EMPTY_EVERY} = 0")
    return some.selectExpr(f"{EMPTY_PATH} as path", "cast('' as binary) as content")


def raw_pages(spark: SparkSession, folder: str) -> DataFrame:
    """``path, content``: the web pages as raw mails, with their address as plain text."""
    pages = table(spark, folder, "pages")
    no_subject = F.lit(None).cast("string")
    content = raw_mail(F.col("page_id") % MAIL_SHAPES, no_subject, F.col("url"), F.col("html"))
    return pages.select(F.col("page_id").cast("string").alias("path"), content.alias("content"))
