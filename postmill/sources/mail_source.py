"""Mails as a Spark data source: ``spark.read.format("mails")`` and ``spark.readStream``.

Folders are listed by tasks, and the listing is written to the shared folder, dealt into
splits of about the same number of bytes. A split is one task of the reader, whatever
folders its mails lie in; the driver sees the names of splits, never those of mails.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)
from pyspark.sql.types import StructType

from postmill.schemas import PARSED_MAIL
from postmill.session import shared_dir, ship_package
from postmill.sources.filesystems import open_files, reason, shared_files
from postmill.sources.mime import FLUSH_CHARS, parse_mail

FORMAT = "mails"
SPLIT_BYTES = 64 << 20
FILE_BYTES = 16 << 10  # what opening a file costs, in bytes of reading
_BUCKET_SPLITS = 32  # splits of a bucket; the running sum of bytes is taken within a bucket
_CHUNK = 10_000
MAX_FILES = 100_000  # of a micro-batch
_MANIFEST = "path string, size bigint, changed bigint, error string"
_LISTING = f"{_MANIFEST}, is_folder boolean"
_COLUMNS = ("path", "size", "changed", "error")


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of folders; a folder that cannot be listed is a row with the reason."""

    def chunk(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        columns = zip(zip(*rows, strict=True), kinds, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], [*_COLUMNS, "is_folder"])

    for batch in batches:
        for folder in batch.column("path").to_pylist():
            rows: list[tuple] = []
            try:
                files, folder = open_files(folder)
                for entry in files.entries(folder):
                    rows.append((entry.path, entry.size, entry.changed, entry.error, entry.is_folder))
                    if len(rows) >= _CHUNK:
                        yield chunk(rows)
                        rows = []
            except Exception as failure:  # noqa: BLE001 - a lost folder must not end the job
                rows.append((folder, 0, 0, reason(failure), False))
            if rows:
                yield chunk(rows)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, size, changed, error`` of all mail files below ``root``, an address or a mounted folder.

    File names that start with a dot are left out; hidden folders are not. One pass per
    depth, each written to the shared folder. The root itself must be there.
    """
    ship_package(spark)
    files, root = open_files(root)
    next(iter(files.entries(root)), None)  # fails here, not in a task, where there is no root
    target = shared_dir(spark, "mail-listing")
    level = spark.createDataFrame([(root,)], "path string")
    depth = 0
    while True:
        written = f"{target}/depth={depth}"
        level.mapInArrow(_list, _LISTING).write.parquet(written)
        folders = spark.read.schema(_LISTING).parquet(written).where("is_folder").select("path")
        if folders.isEmpty():
            break
        level = folders.repartition(spark.sparkContext.defaultParallelism * 4, "path")
        depth += 1
    listed = spark.read.schema(_LISTING).parquet(*[f"{target}/depth={d}" for d in range(depth + 1)])
    visible = ~F.startswith(F.substring_index("path", "/", -1), F.lit("."))
    return listed.where(F.col("error").isNotNull() | (~F.col("is_folder") & visible)).select(*_COLUMNS)


def plan_splits(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> str:
    """Deal files into splits of about ``split_bytes`` and write them; returns the folder.

    Files go to hash buckets of some 32 splits, and within a bucket by the running sum of
    their bytes, so no task sees all files and a folder of any size is dealt over many
    splits. A file larger than a split is one by itself.
    """
    spark = files.sparkSession
    cost = F.col("size") + FILE_BYTES
    total = files.agg(F.sum(cost)).first()[0] or 0
    buckets = max(1, -(-total // (split_bytes * _BUCKET_SPLITS)))
    in_bucket = Window.partitionBy("bucket").orderBy("path")
    before = F.sum(cost).over(in_bucket.rowsBetween(Window.unboundedPreceding, -1))
    place = F.floor(F.coalesce(before, F.lit(0)) / split_bytes).cast("bigint")
    bucketed = files.withColumn("bucket", F.pmod(F.xxhash64("path"), F.lit(buckets)))
    dealt = bucketed.withColumn("split", F.concat_ws("-", "bucket", place)).drop("bucket")
    target = shared_dir(spark, "mail-splits")
    wanted = max(1, -(-total // split_bytes))
    dealt.repartition(min(wanted, 4096), "split").write.partitionBy("split").parquet(target)
    return target


def write_mail_files(mails: DataFrame, root: str) -> DataFrame:
    """Write ``content`` to ``path`` below ``root`` for every row: ``path, error``, null if written.

    The files are written when the result is read, each whole or not at all; a task that
    runs again writes the same files again. A null content is an empty file.
    """
    ship_package(mails.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_files(root)
        for batch in batches:
            errors = []
            for path, content in zip(*batch.columns, strict=True):
                try:
                    files.write(f"{base}/{path.as_py().lstrip('/')}", content.as_py() or b"")
                    errors.append(None)
                except Exception as failure:  # noqa: BLE001 - told with the path
                    errors.append(reason(failure))
            columns = [batch.column(0), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["path", "error"])

    return mails.select("path", "content").mapInArrow(write, "path string, error string")


class MailSplit(InputPartition):
    """The manifest files of one split."""

    def __init__(self, files: tuple[str, ...]) -> None:
        super().__init__(files)
        self.files = files


def _passes(path: str, filters: list[tuple[str, tuple]]) -> bool:
    checks = {
        "is": lambda x: path in x,
        "starts": lambda x: path.startswith(x),
        "ends": lambda x: path.endswith(x),
        "holds": lambda x: x in path,
    }
    return all(checks[kind](value) == wanted for kind, value, wanted in filters)


def _name_filter(condition: Filter) -> tuple[str, object, bool] | None:
    """A filter on ``path`` in a form that a task can be sent, or None if it is another one."""
    wanted = not isinstance(condition, Not)
    inner = condition if wanted else condition.child
    if getattr(inner, "attribute", None) != ("path",):
        return None
    match inner:
        case EqualTo():
            return "is", (inner.value,), wanted
        case In():
            return "is", tuple(inner.value), wanted
        case StringStartsWith():
            return "starts", inner.value, wanted
        case StringEndsWith():
            return "ends", inner.value, wanted
        case StringContains():
            return "holds", inner.value, wanted
    return None


def _read_split(files: Iterable[str], filters: list) -> Iterator[pa.RecordBatch]:
    """Open and parse the mails of manifest files; text is handed back in bounded portions."""
    output = pa.schema([(name, pa.string()) for name in PARSED_MAIL.names])
    rows, waiting = [], 0
    for manifest in files:
        store, manifest = shared_files(manifest)
        table = pq.read_table(pa.BufferReader(store.read(manifest)), columns=["path", "error"])
        for path, error in zip(*(c.to_pylist() for c in table.columns), strict=True):
            if not _passes(path, filters):
                continue
            row = {**dict.fromkeys(PARSED_MAIL.names), "path": path, "error": error}
            if error is None:
                try:
                    files_of, path = open_files(path)
                    row = parse_mail(path, files_of.read(path))
                except Exception as failure:  # noqa: BLE001 - a lost file must not end the job
                    row["error"] = reason(failure)
            rows.append(row)
            waiting += len(row["body"] or "") + 200
            if waiting > FLUSH_CHARS:
                yield pa.RecordBatch.from_pylist(rows, output)
                rows, waiting = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, output)


class MailReader(DataSourceReader):
    """Reads the splits that ``plan_splits`` has written. Conditions on ``path`` are
    checked before a mail is opened."""

    def __init__(self, manifest: str) -> None:
        self.manifest = manifest
        self.filters: list[tuple[str, object, bool]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for condition in filters:
            simple = _name_filter(condition)
            if simple is None:
                yield condition
            else:
                self.filters.append(simple)

    def partitions(self) -> list[MailSplit]:
        store, folder = shared_files(self.manifest)
        splits = []
        for split in store.entries(folder):
            if split.is_folder:
                found = [e.path for e in store.entries(split.path) if e.path.endswith(".parquet")]
                splits.append(MailSplit(tuple(sorted(found))))
        return splits or [MailSplit(())]

    def read(self, partition: MailSplit) -> Iterator[pa.RecordBatch]:
        yield from _read_split(partition.files, self.filters)


class MailStreamReader(DataSourceStreamReader):
    """Arriving mails. An offset is the (change time, path) of the last mail and the number of
    the listing that ends with it.

    Each micro-batch's listing is written to ``log`` before its offset is reported, so a batch
    that is run again reads the same mails, and a restart repeats none. Files that changed in
    the last ``settle`` seconds wait for the next batch, so that none of the same moment can
    slip in behind an offset. A file that changes is read again.
    """

    def __init__(self, root: str, log: str, max_files: int, settle: float, split_files: int) -> None:
        self.root, self.log = root, log.rstrip("/")
        self.max_files, self.settle, self.split_files = max_files, settle, split_files
        self.last: dict | None = None

    def initialOffset(self) -> dict:
        return {"listing": 0, "changed": -1, "path": ""}

    def _newest(self) -> dict:
        """The offset that the newest logged listing ends with."""
        store, log = shared_files(self.log)
        newest = self.initialOffset()
        try:
            for entry in store.entries(f"{log}/offsets"):
                if entry.path.endswith(".json"):
                    newest = max(newest, json.loads(store.read(entry.path)), key=lambda o: o["listing"])
        except FileNotFoundError:
            pass
        return newest

    def _arrived(self, after: dict) -> list[tuple]:
        """The first ``max_files`` mails after an offset; bad entries are told once, by their name."""
        files, root = open_files(self.root)
        limit = (time.time() - self.settle) * 1e6
        found, folders = [], [root]
        while folders:
            folder = folders.pop()
            try:
                for entry in files.entries(folder):
                    name = entry.path.rpartition("/")[2]
                    if entry.is_folder:
                        folders.append(entry.path)
                    elif entry.error is None and name.startswith("."):
                        continue
                    elif (after["changed"], after["path"]) < (entry.changed, entry.path) and entry.changed <= limit:
                        found.append((entry.changed, entry.path, entry.size, entry.error))
            except OSError:
                if folder == root:
                    raise
            if len(found) > 4 * self.max_files:
                found = sorted(found)[: self.max_files]
        return sorted(found)[: self.max_files]

    def latestOffset(self) -> dict:
        last = self.last or self._newest()
        rows = self._arrived(last)
        if not rows:
            self.last = last
            return last
        offset = {"listing": last["listing"] + 1, "changed": rows[-1][0], "path": rows[-1][1]}
        store, log = shared_files(self.log)
        names = []
        for start in range(0, len(rows), self.split_files):
            changed, path, size, error = zip(*rows[start : start + self.split_files], strict=True)
            table = pa.table(
                {"path": path, "size": size, "changed": changed, "error": pa.array(error, pa.string())}
            )
            buffer = pa.BufferOutputStream()
            pq.write_table(table, buffer)
            names.append(f"{log}/listing-{offset['listing']:09d}/{start:09d}-{uuid.uuid4().hex}.parquet")
            store.write(names[-1], buffer.getvalue().to_pybytes())
        # The list of files goes last: a listing without it was never reported.
        offset["files"] = len(names)
        store.write(f"{log}/listings/{offset['listing']:09d}.json", json.dumps(names).encode())
        store.write(f"{log}/offsets/{offset['listing']:09d}.json", json.dumps(offset).encode())
        self.last = offset
        return offset

    def partitions(self, start: dict, end: dict) -> list[MailSplit]:
        store, log = shared_files(self.log)
        splits = []
        for number in range(start["listing"] + 1, end["listing"] + 1):
            names = json.loads(store.read(f"{log}/listings/{number:09d}.json"))
            splits += [MailSplit((name,)) for name in names]
        return splits

    def read(self, partition: MailSplit) -> Iterator[pa.RecordBatch]:
        yield from _read_split(partition.files, [])


class MailSource(DataSource):
    """``mails``: records of path, subject, body kind, body and error.

    Options: ``path`` and, for a batch, ``manifest`` (from ``plan_splits``); for a stream ``log``, a
    folder in shared storage, ``maxFilesPerTrigger``, ``settleSeconds`` and ``filesPerTask``.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        return PARSED_MAIL

    def reader(self, schema: StructType) -> MailReader:
        if "manifest" not in self.options:
            raise ValueError("the option manifest is missing; read_mail_files sets it")
        return MailReader(self.options["manifest"])

    def streamReader(self, schema: StructType) -> MailStreamReader:
        return MailStreamReader(
            self.options["path"],
            self.options["log"],
            int(self.options.get("maxFilesPerTrigger", MAX_FILES)),
            float(self.options.get("settleSeconds", 2)),
            int(self.options.get("filesPerTask", 1000)),
        )


def _register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(MailSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_mail_files(spark: SparkSession, root: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Parsed mails of all files below ``root``, a mounted folder or an address that ``pyarrow`` knows.

    What cannot be listed, opened or parsed is a row with its reason in ``error``. Empty files,
    names that start with ``_`` and hidden folders are read; names that start with a dot are not.
    """
    _register(spark)
    manifest = plan_splits(list_files(spark, root), split_bytes)
    return spark.read.format(FORMAT).option("manifest", manifest).load()


def stream_mail_files(spark: SparkSession, root: str, log: str, **options: str) -> DataFrame:
    """Arriving mails below ``root`` as a stream of parsed mails; ``log`` is where listings are kept,
    in shared storage and of this stream alone."""
    _register(spark)
    reader = spark.readStream.format(FORMAT).option("path", root).option("log", log)
    return reader.options(**options).load()
