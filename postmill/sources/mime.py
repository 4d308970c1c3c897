"""RFC-822 parsing of mail bytes.

MIME decoding is the one cleaning step Spark has no functions for; it runs in Arrow
batches. Only header, body kind and body text come back: HTML conversion and all
cleaning are column expressions.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterable, Iterator
from email import policy
from email.message import EmailMessage
from email.parser import BytesParser
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.html import html_to_text
from postmill.functions.pytext import strip
from postmill.schemas import PARSED_MAIL
from postmill.session import ship_package

# Parsed text is handed back once this many characters are waiting, so that a run of
# large mails does not pile up in the worker.
FLUSH_CHARS = 16_000_000

_OUTPUT = pa.schema([(name, pa.string()) for name in PARSED_MAIL.names])


@lru_cache(maxsize=4096)
def _structure_header(name: str, value: str):
    return policy.default.header_fetch_parse(name, value)


class _CachedHeaders(policy.EmailPolicy):
    """The default policy, parsing equal structure headers once.

    The email package parses ``Content-Type`` anew on each of the dozen times it looks
    at it, which takes longer than all the rest, and most mails share a few values.
    """

    def header_fetch_parse(self, name, value):
        if name.lower().startswith("content-") and type(value) is str and len(value) < 1000:
            return _structure_header(name, value)
        return super().header_fetch_parse(name, value)


_POLICY = _CachedHeaders()


def _body_of(message: EmailMessage) -> tuple[str, str]:
    """Kind and text of the body to read: plain text wins over HTML.

    Parts that do not decode are passed over. The disposition of a part does not
    matter, and an empty plain part still wins.
    """
    if message.is_multipart():
        for wanted in ("text/plain", "text/html"):
            for part in message.walk():
                if part.get_content_type() == wanted:
                    try:
                        return wanted[5:], part.get_content()
                    except Exception:  # noqa: BLE001 - any broken part is passed over
                        continue
        return "plain", ""
    try:
        content = message.get_content()
        content.strip()
    except Exception:  # noqa: BLE001 - a mail that does not decode has an empty body
        return "plain", ""
    kind = "html" if message.get_content_type() == "text/html" else "plain"
    if isinstance(content, bytes):
        if content.strip():
            raise TypeError("the body is binary")
        content = ""
    return kind, content


def parse_mail(path: str, content: bytes) -> dict[str, str | None]:
    """One parsed record. A mail that fails has a null body and its reason in ``error``."""
    record: dict[str, str | None] = dict.fromkeys(PARSED_MAIL.names)
    record["path"] = path
    try:
        message = BytesParser(policy=_POLICY).parse(io.BytesIO(content))
        subject = str(message.get("subject", "") or "")
        kind, body = _body_of(message)
        (subject + body).encode("utf-8")
        record.update(subject=subject, body_kind=kind, body=body)
    except Exception as failure:  # noqa: BLE001 - a bad mail must not stop the job
        record["error"] = f"{type(failure).__name__}: {failure}".encode("utf-8", "replace").decode()
    return record


def parsing(
    contents: Callable[[pa.RecordBatch], Iterable[tuple[str, bytes | None, str | None]]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """An Arrow map that parses what ``contents`` yields: path, bytes and read error."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, waiting = [], 0
            for path, content, failure in contents(batch):
                if failure is None:
                    row = parse_mail(path, content)
                else:
                    row = {**dict.fromkeys(PARSED_MAIL.names), "path": path, "error": failure}
                rows.append(row)
                waiting += len(row["body"] or "")
                if waiting > FLUSH_CHARS:
                    yield pa.RecordBatch.from_pylist(rows, _OUTPUT)
                    rows, waiting = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _OUTPUT)

    return parse


def parse_mails(raw: DataFrame) -> DataFrame:
    """Parse a table of ``path`` and ``content``; other columns are not read."""

    def contents(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes | None, str | None]]:
        for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
            yield path.as_py(), content.as_py() or b"", None

    ship_package(raw.sparkSession)
    return raw.select("path", "content").mapInArrow(parsing(contents), PARSED_MAIL)


def body_text(kind: Column, body: Column) -> Column:
    """The body as text: HTML is converted, plain text is trimmed."""
    return F.when(kind == "html", html_to_text(body)).otherwise(strip(body))
