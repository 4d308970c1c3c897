"""Reading folders of mail files, one mail per file."""

from __future__ import annotations

import os
from collections.abc import Iterator
from datetime import datetime, timezone
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.schemas import PARSED_MAIL, RAW_MAIL
from postmill.session import shared_dir, ship_package
from postmill.sources.mime import parsing

LISTING = "path string, is_folder boolean, error string"
LIST_CHUNK = 10_000
FLUSH_BYTES = 16 << 20  # of file contents in one batch, about
FILES_PER_TASK = 2_000


def is_mail_name(path: Column) -> Column:
    """Whether the file name, not a folder on the way to it, starts without a dot."""
    return ~F.startswith(F.substring_index(path, "/", -1), F.lit("."))


def _readable(text: str) -> str:
    """``text`` with the bytes that are not UTF-8 spelled out."""
    return os.fsencode(text).decode("utf-8", "backslashreplace")


def _reason(failure: Exception) -> str:
    return _readable(f"{type(failure).__name__}: {failure}")


def _entries(folder: str) -> Iterator[tuple[str, bool, str | None]]:
    """Files and folders in ``folder``; one that cannot be listed or named has its reason."""
    with os.scandir(folder) as entries:
        for entry in entries:
            try:
                entry.path.encode()
                is_folder = entry.is_dir(follow_symlinks=False)
                if is_folder or entry.is_file():
                    yield entry.path, is_folder, None
            except (UnicodeEncodeError, OSError) as failure:
                yield _readable(entry.path), False, _reason(failure)


def _list_folders(batches: Iterator[pa.RecordBatch], strict: bool) -> Iterator[pa.RecordBatch]:
    """Entries of each folder, streamed in chunks however many there are. A folder that
    cannot be opened ends the job if ``strict``, else it is a row with the reason."""

    def chunk(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c) for c in zip(*rows, strict=True)]
        columns[2] = columns[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(columns, ["path", "is_folder", "error"])

    for batch in batches:
        for folder in batch.column("path").to_pylist():
            rows: list[tuple] = []
            try:
                for entry in _entries(folder):
                    rows.append(entry)
                    if len(rows) >= LIST_CHUNK:
                        yield chunk(rows)
                        rows = []
            except OSError as failure:
                if strict:
                    raise
                rows.append((folder, False, _reason(failure)))
            if rows:
                yield chunk(rows)


def _local_root(root: str) -> str:
    scheme, mark, rest = root.partition("://")
    if not mark:
        return root.removeprefix("file:")
    if scheme != "file":
        raise ValueError(f"{scheme} folders are read with read_binary_mails")
    return rest


def list_mails(spark: SparkSession, root: str) -> DataFrame:
    """``path`` of all mail files under a folder that every executor has mounted.

    A folder below it that cannot be listed, or an entry whose name is not UTF-8, is a row
    with the reason in ``error``, which is null for the others.

    Spark's own file sources skip names that start with ``_`` or ``.``, which mail
    folders such as ``_sent_mail`` have, so folders are listed by tasks: one pass per
    depth, each writing its listing to the shared folder. The paths never pass through
    the driver, and a level survives the loss of the executors that listed it.
    """
    ship_package(spark)
    target = shared_dir(spark, "listing")
    level = spark.createDataFrame([(_local_root(root),)], "path string")
    depth = 0
    while True:
        written = f"{target}/depth={depth}"
        level.mapInArrow(partial(_list_folders, strict=depth == 0), LISTING).write.parquet(written)
        folders = spark.read.schema(LISTING).parquet(written).where("is_folder").select("path")
        if folders.isEmpty():
            break
        # Hash partitions: sibling folders, which lie side by side in the listing, differ in size.
        level = folders.repartition(spark.sparkContext.defaultParallelism * 4, "path")
        depth += 1
    listed = spark.read.schema(LISTING).parquet(*[f"{target}/depth={d}" for d in range(depth + 1)])
    wanted = F.col("error").isNotNull() | (~F.col("is_folder") & is_mail_name(F.col("path")))
    return listed.where(wanted).select("path", "error")


def _spread_paths(paths: DataFrame) -> DataFrame:
    """Even tasks whatever folder the paths are from, about the same files in each."""
    tasks = max(
        paths.sparkSession.sparkContext.defaultParallelism, -(-paths.count() // FILES_PER_TASK)
    )
    error = F.col("error") if "error" in paths.columns else F.lit(None).cast("string")
    return paths.select("path", error.alias("error")).repartition(tasks, "path")


def _open(path: str) -> tuple[bytes | None, float | None, str | None]:
    """Contents, time of the last change, and why there are none."""
    try:
        with open(path, "rb") as file:
            return file.read(), os.fstat(file.fileno()).st_mtime, None
    except OSError as failure:
        return None, None, _reason(failure)


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes | None, float | None, str | None]]:
    for path, failure in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        yield path, *(_open(path) if failure is None else (None, None, failure))


def read_raw_mails(paths: DataFrame) -> DataFrame:
    """File contents for a table of paths; a file that cannot be read has null content."""
    names = pa.schema(
        [
            ("path", pa.string()),
            ("modificationTime", pa.timestamp("us", "UTC")),
            ("length", pa.int64()),
            ("content", pa.binary()),
        ]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, waiting = [], 0
            for path, content, changed, failure in _opened(batch):
                row = {"path": path, "content": content}
                if failure is None:
                    row.update(modificationTime=datetime.fromtimestamp(changed, timezone.utc), length=len(content))
                    waiting += len(content)
                rows.append(row)
                if waiting > FLUSH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, names)
                    rows, waiting = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, names)

    ship_package(paths.sparkSession)
    return _spread_paths(paths).mapInArrow(read, RAW_MAIL)


def read_mails(spark: SparkSession, root: str) -> DataFrame:
    """Scan a mail folder: list, open and parse. What cannot be listed or opened is a row
    with its reason in ``error``.

    Files are opened by the task that parses them, so raw bytes never travel between
    the JVM and Python.
    """

    def contents(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes | None, str | None]]:
        for path, content, _, failure in _opened(batch):
            yield path, content, failure

    return _spread_paths(list_mails(spark, root)).mapInArrow(parsing(contents), PARSED_MAIL)


def read_binary_mails(spark: SparkSession, *folders: str) -> DataFrame:
    """Raw mails from any Hadoop file system, through Spark's binary file source.

    Unlike ``read_mails`` it cannot see empty files and names that start with ``_``, nor
    folders that start with ``_`` or ``.`` unless they are named in ``folders``.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(folders))
    return raw.where(is_mail_name(F.col("path")))
