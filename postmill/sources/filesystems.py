"""File systems that Python workers can list and read: mounted folders, and those of ``pyarrow``.

The Python data sources open files in the worker, where Spark's own file systems are out of
reach. A plain path is a mounted folder; an address such as ``file:///mail`` or
``s3://bucket/mail`` is opened through ``pyarrow``.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache
from typing import BinaryIO, NamedTuple

from pyarrow import fs


class Entry(NamedTuple):
    """What is in a folder. ``error`` says why an entry could not be looked at."""

    path: str
    is_folder: bool
    size: int
    changed: int  # microseconds since 1970
    error: str | None


def spelled(text: str) -> str:
    """``text`` with the bytes that are not UTF-8 spelled out."""
    return os.fsencode(text).decode("utf-8", "backslashreplace")


def reason(failure: Exception) -> str:
    return spelled(f"{type(failure).__name__}: {failure}")


class MountedFiles:
    """Folders that every machine has mounted. Names need not be UTF-8 to be reported."""

    def entries(self, folder: str) -> Iterator[Entry]:
        with os.scandir(folder) as found:
            for entry in found:
                try:
                    entry.path.encode()
                    is_folder = entry.is_dir(follow_symlinks=False)
                    if is_folder or entry.is_file():
                        about = entry.stat()
                        # Moving a file into a folder changes its status, not its contents.
                        changed = max(about.st_mtime_ns, about.st_ctime_ns) // 1000
                        yield Entry(entry.path, is_folder, about.st_size, changed, None)
                except (UnicodeEncodeError, OSError) as failure:
                    yield Entry(spelled(entry.path), False, 0, 0, reason(failure))

    def read(self, path: str) -> bytes:
        with open(path, "rb") as file:
            return file.read()

    def write(self, path: str, content: bytes) -> None:
        """Write all of a file or nothing, in place of one of that name."""
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(f"{path}.part", "wb") as file:
            file.write(content)
        os.replace(f"{path}.part", path)

    def create(self, path: str) -> BinaryIO:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")

    def delete(self, path: str) -> None:
        try:
            os.remove(path)
        except FileNotFoundError:
            pass


class ArrowFiles:
    """Any file system that ``pyarrow`` has; ``prefix`` makes its paths addresses again."""

    def __init__(self, system: fs.FileSystem, prefix: str) -> None:
        self.system = system
        self.prefix = prefix

    def _inner(self, path: str) -> str:
        return path.removeprefix(self.prefix)

    def entries(self, folder: str) -> Iterator[Entry]:
        for info in self.system.get_file_info(fs.FileSelector(self._inner(folder))):
            path = self.prefix + info.path
            is_folder = info.type == fs.FileType.Directory
            if is_folder or info.type == fs.FileType.File:
                changed = info.mtime_ns // 1000 if info.mtime_ns else 0
                yield Entry(path, is_folder, info.size or 0, changed, None)

    def read(self, path: str) -> bytes:
        with self.system.open_input_stream(self._inner(path)) as file:
            return file.read()

    def write(self, path: str, content: bytes) -> None:
        inner = self._inner(path)
        self.system.create_dir(inner.rpartition("/")[0], recursive=True)
        with self.system.open_output_stream(f"{inner}.part") as file:
            file.write(content)
        self.system.move(f"{inner}.part", inner)

    def create(self, path: str) -> BinaryIO:
        inner = self._inner(path)
        self.system.create_dir(inner.rpartition("/")[0], recursive=True)
        return self.system.open_output_stream(inner)

    def delete(self, path: str) -> None:
        try:
            self.system.delete_file(self._inner(path))
        except FileNotFoundError:
            pass


@lru_cache(maxsize=16)
def _system(base: str) -> ArrowFiles:
    try:
        system, inner = fs.FileSystem.from_uri(base)
    except Exception as failure:
        raise ValueError(f"no file system for {base}: {failure}") from failure
    return ArrowFiles(system, base.removesuffix("/").removesuffix(inner.rstrip("/")))


def open_files(address: str) -> tuple[MountedFiles | ArrowFiles, str]:
    """The file system of an address, and the address without a slash at its end.

    An unknown scheme is a ``ValueError``.
    """
    address = address.rstrip("/") or "/"
    scheme, mark, rest = address.partition("://")
    if mark:
        return _system(f"{scheme}://{rest.partition('/')[0]}/"), address
    if address.startswith("file:"):
        return _system("file:///"), f"file://{address.removeprefix('file:')}"
    return MountedFiles(), address


def shared_files(folder: str) -> tuple[MountedFiles | ArrowFiles, str]:
    """As ``open_files``, for Spark's shared folder, which may be named by a ``file:`` address."""
    plain = folder.removeprefix("file://") if folder.startswith("file:///") else folder
    if plain.startswith("file:/"):
        plain = plain.removeprefix("file:")
    return open_files(plain)
