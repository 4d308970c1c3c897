"""A sink of text lines whose output changes in one step: ``committed_lines``.

Tasks write files under names of their own and report them. Only when all tasks are done
does a manifest name the new files, in one atomic step; until then, and for ever after a
failure, readers that go by the manifest see the old output, whole. What was written in vain
is deleted. The manifest's row count is the sum of what the tasks have reported.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from postmill.session import ship_package
from postmill.sources.filesystems import shared_files

FORMAT = "committed_lines"
MANIFEST = "_manifest.json"
FILE_BYTES = 256 << 20
_PORTION = 4 << 20  # of lines that are put together at a time


@dataclass
class Written(WriterCommitMessage):
    """What one task has written: name and rows of each file."""

    files: list[tuple[str, int]] = field(default_factory=list)


def read_manifest(path: str) -> dict | None:
    """``files`` and ``rows`` of a committed output; None where there is none."""
    store, root = shared_files(path)
    try:
        return json.loads(store.read(f"{root}/{MANIFEST}"))
    except FileNotFoundError:
        return None


class LineWriter(DataSourceArrowWriter):
    """Writes the one column of its rows as lines."""

    def __init__(self, path: str, overwrite: bool, suffix: str, file_bytes: int) -> None:
        self.path, self.overwrite, self.suffix, self.file_bytes = path, overwrite, suffix, file_bytes
        self.run = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = shared_files(self.path)
        context = TaskContext.get()
        task = f"part-{self.run}-{context.partitionId():05d}-{context.taskAttemptId()}"
        done = Written()
        file, rows, size = None, 0, 0
        try:
            for lines in self._portions(iterator):
                if file is None:
                    name = f"{task}-{len(done.files)}{self.suffix}"
                    file, rows, size = store.create(f"{root}/{name}"), 0, 0
                content = "\n".join([*lines, ""]).encode()
                file.write(content)
                rows, size = rows + len(lines), size + len(content)
                if size >= self.file_bytes:
                    file.close()
                    done.files.append((name, rows))
                    file = None
        finally:
            if file is not None:
                file.close()
        if file is not None:
            done.files.append((name, rows))
        return done

    def _portions(self, batches: Iterator[pa.RecordBatch]) -> Iterator[list[str]]:
        """The lines in lists of about ``_PORTION`` bytes, and of one line at least."""
        most = min(_PORTION, self.file_bytes)
        for batch in batches:
            column = batch.column(0)
            count = max(1, int(most / max(1, column.nbytes / max(1, len(column)))))
            for start in range(0, len(column), count):
                yield column.slice(start, count).to_pylist()

    def _others(self, keep: set[str], prefix: str) -> list[str]:
        store, root = shared_files(self.path)
        try:
            names = [e.path.rpartition("/")[2] for e in store.entries(root) if not e.is_folder]
        except FileNotFoundError:
            return []
        return [n for n in names if n.startswith(prefix) and n not in keep]

    def _delete(self, names: list[str]) -> None:
        store, root = shared_files(self.path)
        for name in names:
            store.delete(f"{root}/{name}")

    def commit(self, messages: list[Written | None]) -> None:
        store, root = shared_files(self.path)
        files = [f for m in messages if m is not None for f in m.files]
        if not self.overwrite:
            files = [*map(tuple, (read_manifest(self.path) or {"files": []})["files"]), *files]
        manifest = {"files": files, "rows": sum(n for _, n in files), "run": self.run}
        store.write(f"{root}/{MANIFEST}", json.dumps(manifest).encode())
        # From here on the new output is what is read; the rest is tidying up.
        self._delete(self._others({n for n, _ in files}, "part-"))

    def abort(self, messages: list[Written | None]) -> None:
        self._delete(self._others(set(), f"part-{self.run}-"))


class LineSink(DataSource):
    """``committed_lines``: options ``path``, ``suffix`` and ``fileBytes``; one string column."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def writer(self, schema: StructType, overwrite: bool) -> LineWriter:
        return LineWriter(
            self.options["path"],
            overwrite,
            self.options.get("suffix", ".json"),
            int(self.options.get("fileBytes", FILE_BYTES)),
        )


def write_json_lines(table: DataFrame, path: str, append: bool = False) -> int:
    """Write all columns as JSON lines, also the keys of null fields; returns how many rows.

    ``path`` is a mounted folder or an address that ``pyarrow`` knows, and this sink's alone:
    without ``append``, files that a former run has left there are deleted once the new output is
    complete. Two jobs must not write to it at a time.
    """
    spark = table.sparkSession
    ship_package(spark)
    spark.dataSource.register(LineSink)
    lines = table.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    writer = lines.write.format(FORMAT).mode("append" if append else "overwrite")
    before = read_manifest(path) if append else None
    writer.option("path", path).save()
    return read_manifest(path)["rows"] - (before["rows"] if before else 0)


def committed_paths(spark: SparkSession, path: str) -> list[str]:
    """What to read: the files that a manifest names, or ``path`` itself where there is none.

    A path that only Spark can open has no manifest.
    """
    try:
        manifest = read_manifest(path)
    except (ValueError, OSError):
        manifest = None
    if manifest is None:
        return [path]
    return [f"{path.rstrip('/')}/{name}" for name, _ in manifest["files"]]
