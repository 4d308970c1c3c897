"""The parts of mails as rows: a table function that is called for each mail.

``mail_parts`` can be used in SQL, after ``register_mail_parts``, as
``from mails, lateral mail_parts(content)``, or through ``with_parts``.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from email.parser import BytesParser

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.session import ship_package
from postmill.sources.mime import _POLICY

PART = "part_no int, content_type string, file_name string, is_attachment boolean, size bigint, error string"


class MailParts:
    """One row for each part that holds content, in the order of the mail."""

    def eval(self, content: bytes | None) -> Iterator[tuple]:
        try:
            message = BytesParser(policy=_POLICY).parse(io.BytesIO(bytes(content or b"")))
            leaves = [part for part in message.walk() if not part.is_multipart()]
        except Exception as failure:  # noqa: BLE001 - a bad mail must not stop the job
            yield 0, None, None, False, None, _reason(failure)
            return
        for number, part in enumerate(leaves):
            kind = name = size = error = None
            attached = False
            try:
                kind = part.get_content_type()
                name = _clean(part.get_filename())
                attached = part.is_attachment()
                size = len(part.get_payload(decode=True) or b"")
                part.get_content()
            except Exception as failure:  # noqa: BLE001 - told with the part
                error = _reason(failure)
            yield number, kind, name, attached, size, error


def _clean(name: str | None) -> str | None:
    return None if name is None else name.encode("utf-8", "replace").decode()


def _reason(failure: Exception) -> str:
    return f"{type(failure).__name__}: {failure}".encode("utf-8", "replace").decode()


def register_mail_parts(spark: SparkSession, name: str = "mail_parts") -> None:
    """Make the table function known to SQL."""
    ship_package(spark)
    spark.udtf.register(name, F.udtf(MailParts, returnType=PART, useArrow=True))


def with_parts(mails: DataFrame, content: str = "content") -> DataFrame:
    """``mails`` once for each part, with the part's columns; ``content`` itself is left out.

    Columns: ``part_no`` from 0, ``content_type``, ``file_name`` (null without), ``is_attachment``, ``size`` in
    bytes as decoded, and ``error``, why the part does not decode. A null content is an empty mail,
    which has one part of no bytes; one that cannot be parsed has one row with its reason.
    """
    ship_package(mails.sparkSession)
    function = F.udtf(MailParts, returnType=PART, useArrow=True)
    return mails.lateralJoin(function(F.col(f"`{content}`").outer())).drop(content)


def attachment_names(mails: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """``key, attachments``: the names of each mail's attached files, in their order.

    That is what the attachment task asks for; mails without any have an empty list. Keys must
    be unique.
    """
    parts = with_parts(mails.select(key, content), content)
    named = F.when(F.col("file_name").isNotNull(), F.struct("part_no", "file_name"))
    listed = F.sort_array(F.collect_list(named))
    return parts.groupBy(key).agg(F.transform(listed, lambda p: p["file_name"]).alias("attachments"))
