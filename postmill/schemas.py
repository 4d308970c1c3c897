"""Record schemas that the stages exchange."""

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _record(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_TEXT = StringType()
_TEXTS = ArrayType(StringType())

CHAT_MESSAGES = ArrayType(_record(role=_TEXT, content=_TEXT))

RAW_MAIL = _record(
    path=_TEXT, modificationTime=TimestampType(), length=LongType(), content=BinaryType()
)
PARSED_MAIL = _record(path=_TEXT, subject=_TEXT, body_kind=_TEXT, body=_TEXT, error=_TEXT)
CLEAN_EMAIL = _record(source=_TEXT, path=_TEXT, subject=_TEXT, clean_text=_TEXT, urls=_TEXTS)
CHAT_EXAMPLE = _record(messages=CHAT_MESSAGES)
REPLY = _record(reply=_TEXT, error=_TEXT)
TASK_REQUEST = _record(
    task=_TEXT,
    subject=_TEXT,
    body=_TEXT,
    tone=_TEXT,
    style=_TEXT,
    length=_TEXT,
    categories=_TEXTS,
    attachments=_TEXTS,
)
