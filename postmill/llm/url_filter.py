"""URL filter: glob rules as one bit-parallel automaton over canonical URLs.

Every rule is a row of bits, one for each of its prefixes; all rules lie end to end in a few
64-bit words. One step of all rules over one character is a shift, an and with the
character's mask, and an or with the states that a ``*`` lets stay. A block of URLs takes
each step together, so the work per URL is (length x words) operations.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.staging import prepare

_SEPARATOR = 0x110000  # stands between host and path; no text can hold it
_BITS = 64
_ROWS = 4096


@dataclass(frozen=True)
class Rule:
    """``text`` is a host pattern, then a path pattern from its first ``/`` on.

    ``*`` is any run of characters and ``?`` any one; neither crosses from host to path. The
    host pattern fits the host and its subdomains, the path pattern any path that starts so, or
    with ``whole`` only one that ends there as well.
    """

    text: str
    verdict: str  # allow or block
    whole: bool = False


#: Words of hosts that are not wanted, and endings of files that are no pages.
HOST_WORDS = ("spam", "casino", "porn", "xxx", "viagra", "gambling", "torrent")
FILE_ENDINGS = (
    "exe", "msi", "dmg", "apk", "iso", "bin", "zip", "rar", "7z", "gz", "tar", "jpg", "jpeg", "png", "gif",
    "webp", "ico", "svg", "mp3", "wav", "mp4", "avi", "mov", "webm", "woff", "woff2", "css", "js",
)

#: What the filter judges by itself, where no given rule fits.
DEFAULT_GLOBS = (
    *(Rule(f"*{word}*/", "block") for word in HOST_WORDS),
    *(Rule(f"*/*.{ending}", "block", whole=True) for ending in FILE_ENDINGS),
)

_ESCAPE = re.compile("%([2-7][0-9A-Fa-f])")
_DEFAULT_PORT = re.compile(":(80|443)?$")


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case.
    Path: from there up to ``?``, ``#`` or the end. Both empty without ``://`` or for null."""
    at = url.find("://") if url else -1
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    if not host.isascii():
        return "".join(c.lower() if c.isascii() else c for c in host), slash + path
    return host.lower(), slash + path


def _lower(text: str) -> str:
    return text.lower() if text.isascii() else "".join(c.lower() if c.isascii() else c for c in text)


def _unescaped(text: str) -> str:
    """Escapes of visible ASCII signs read once, but for those that would end a part of a URL."""

    def sign(found: re.Match) -> str:
        code = int(found.group(1), 16)
        return found.group() if code in (0x20, 0x23, 0x2F, 0x3F, 0x7F) else chr(code)

    return _ESCAPE.sub(sign, text) if "%" in text else text


def canonical(host: str, path: str) -> tuple[str, str]:
    """Host and path as globs see them, the same for all spellings of an address.

    Both: escapes of visible ASCII signs are read (once, and not those of ``/ ? #``), then A-Z is in lower
    case. Host: without what stands before its last ``@``, without a port of 80, 443 or nothing, and
    without dots at its end. Path: ``.`` and ``..`` segments are followed, an empty one is ``/``. A URL without
    a host stays as it is.
    """
    if not host and not path:
        return host, path
    host = _lower(_unescaped(host)).rpartition("@")[2]
    host = _DEFAULT_PORT.sub("", host).rstrip(".")
    parts: list[str] = []
    segments = _lower(_unescaped(path)).split("/")[1:] or [""]
    for segment in segments:
        if segment == "..":
            del parts[-1:]
        elif segment != ".":
            parts.append(segment)
    if segments[-1] in (".", ".."):
        parts.append("")
    return host, "/" + "/".join(parts)


class Automaton:
    """All rules at once; where several fit a URL, the one that comes first wins."""

    def __init__(self, rules: Sequence[Rule]) -> None:
        tokens = [self._tokens(rule.text, rule.whole) for rule in rules]
        bits = sum(len(x) + 1 for x in tokens)
        self.words = max(1, -(-bits // _BITS))
        literals = sorted({t for x in tokens for t, _ in x if isinstance(t, int)})
        self.known = np.array([*literals, 0x110001], np.int64)
        other = len(self.known)
        shape = (other + 1, self.words)
        self.step, self.stay = np.zeros(shape, np.uint64), np.zeros(shape, np.uint64)
        self.begin, self.accept = (np.zeros(self.words, np.uint64) for _ in range(2))
        self.rule_at = np.full(self.words * _BITS, -1, np.int64)
        separator = literals.index(_SEPARATOR) if _SEPARATOR in literals else other
        at = 0
        for number, row in enumerate(tokens):
            self._set(self.begin, at)
            # Before the dot that begins the fitting host, anything may stand.
            for token, loop in [(None, True), *row]:
                if token is not None:
                    kinds = [int(np.searchsorted(self.known, token))] if token != "?" else None
                    for kind in range(other + 1) if kinds is None else kinds:
                        if kinds is not None or kind != separator:
                            self._set(self.step[kind], at)
                if loop:
                    for kind in range(other + 1):
                        if kind != separator:
                            self._set(self.stay[kind], at)
                at += 1
            self._set(self.accept, at - 1)
            self.rule_at[at - 1] = number

    @staticmethod
    def _tokens(text: str, whole: bool = False) -> list[tuple[int | str, bool]]:
        """(code point or ``?``, whether a ``*`` follows) of ``.host<separator>path``, and a ``*`` after
        it unless ``whole``."""
        host, slash, path = text.partition("/")
        found: list[tuple[int | str, bool]] = [(ord("."), False)]
        for mark in [*host, _SEPARATOR, *(slash + path), *("" if whole else "*")]:
            if mark == "*":
                found[-1] = (found[-1][0], True)
            else:
                found.append((mark if mark in (_SEPARATOR, "?") else ord(mark), False))
        return found

    @staticmethod
    def _set(row: np.ndarray, bit: int) -> None:
        row[bit // _BITS] |= np.uint64(1 << bit % _BITS)

    def first_fitting(self, keys: list[np.ndarray]) -> np.ndarray:
        """For each key (code points), the number of the first rule that fits it, or -1."""
        lengths = np.array([len(k) for k in keys], np.int64)
        order = np.argsort(-lengths, kind="stable")
        # Character classes: a place in `known`, or the last for all others.
        flat = np.concatenate([keys[i] for i in order]).astype(np.int64)
        place = np.searchsorted(self.known, flat)
        kinds = np.where(self.known[place] == flat, place, len(self.known))
        offsets = np.concatenate(([0], np.cumsum(lengths[order])))[:-1]
        active = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), "left")
        state = np.tile(self.begin, (len(keys), 1))
        for position, count in enumerate(active):
            kind = kinds[offsets[:count] + position]
            now = state[:count]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(_BITS - 1)
            state[:count] = (moved & self.step[kind]) | (now & self.stay[kind])
        state &= self.accept
        word = (state != 0).argmax(axis=1)
        value = state[np.arange(len(keys)), word]
        low = value & (~value + np.uint64(1))
        bit = np.zeros(len(keys), np.int64)
        bit[low > 0] = np.log2(low[low > 0].astype(np.float64)).astype(np.int64)
        found = np.where(value > 0, self.rule_at[word * _BITS + bit], -1)
        result = np.empty(len(keys), np.int64)
        result[order] = found
        return result


def _by_length(rules: Sequence[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda rule: -len(rule.text))


def _key(host: str, path: str) -> np.ndarray:
    codes = np.frombuffer(f".{host}\n{path}".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes.astype(np.int64)
    codes[len(host) + 1] = _SEPARATOR
    return codes


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    globs: Sequence[Rule] = DEFAULT_GLOBS,
    default: str = "allow",
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict, glob) for every row of ``pages``.

    Of the ``rules`` that fit host and path, the longest decides (of equal ones, the first given) and
    is named in ``rule``. Where none fits, ``rule`` is null and the longest of ``globs`` that fits the
    ``canonical`` host and path decides, named in ``glob``; where none does either, ``default``.

    A null URL, an empty one and one without ``://`` have an empty host and path, which only
    patterns of ``*`` can fit. Repeated rows and null ids are judged like any other row,
    an empty table gives an empty one, and only the two named columns are read. Row-local:
    no shuffle, and memory is bounded by a block of URLs.
    """
    prepare(pages.sparkSession)
    first, second = _by_length(rules), _by_length(globs)
    id_type = pages.schema[id_column].dataType.simpleString()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_rule, by_glob = Automaton(first), Automaton(second)
        for batch in batches:
            for begin in range(0, batch.num_rows, _ROWS):
                part = batch.slice(begin, _ROWS)
                split = [host_and_path(url) for url in part.column(1).to_pylist()]
                rule = by_rule.first_fitting([_key(*x) for x in split]).tolist()
                glob = by_glob.first_fitting([_key(*canonical(*x)) for x in split]).tolist()
                pairs = list(zip(rule, glob, strict=True))
                verdicts = [
                    first[r].verdict if r >= 0 else second[g].verdict if g >= 0 else default for r, g in pairs
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([host for host, _ in split], pa.string()),
                        pa.array([path for _, path in split], pa.string()),
                        pa.array([first[r].text if r >= 0 else None for r in rule], pa.string()),
                        pa.array(verdicts, pa.string()),
                        pa.array([second[g].text if r < 0 <= g else None for r, g in pairs], pa.string()),
                    ],
                    ["id", "host", "path", "rule", "verdict", "glob"],
                )

    two = pages.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{url_column}`").alias("url"))
    return two.mapInArrow(
        judge, f"id {id_type}, host string, path string, rule string, verdict string, glob string"
    ).withColumnRenamed("id", id_column)
