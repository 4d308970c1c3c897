"""Ids of a word-BPE tokenizer for blocks of texts, frequent words encoded once.

The tokenizer is a file of the ``tokenizers`` library, read by that library; nothing is
trained. It lowers the text, splits it into words, digits, contractions and runs of other
signs, and encodes each by itself. So its ids for a text are those of its words in order,
and a word's ids can be kept, in a store of bounded size. Texts with characters beyond U+024F, or with what may be a
special token, go to the library whole.
"""

from __future__ import annotations

import os
import unicodedata
from functools import cache, cached_property

import numpy as np
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from postmill.llm.words import Block

_LIMIT = 0x250  # below, no two characters combine, and each but U+0130 lowers to one
_LETTER, _NUMBER, _OTHER = 1, 2, 3
KEPT = 1 << 17  # words of the store, of some 30 bytes each
_JOINED = 64
# A task is one of many on its machine; threads of its own would cost memory and gain nothing.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@cache
def _classes() -> np.ndarray:
    kinds = np.zeros(_LIMIT, np.int8)
    for code in range(_LIMIT):
        sign = chr(code)
        major = unicodedata.category(sign)[0]
        blank = sign.isspace() and not 0x1C <= code <= 0x1F
        kinds[code] = 0 if blank else {"L": _LETTER, "N": _NUMBER}.get(major, _OTHER)
    return kinds


def _pieces(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces that are encoded by themselves."""
    codes = block.codes
    kinds = _classes()[codes]
    change = np.empty(len(kinds), bool)
    change[:1] = True
    change[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _NUMBER)
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(codes))
    inside = kinds[starts] > 0
    starts, ends = starts[inside], ends[inside]
    # A lone apostrophe takes s, t, m, d, re, ve or ll from the word after it.
    lone = np.flatnonzero((codes[starts] == 39) & (ends - starts == 1))
    lone = lone[lone + 1 < len(starts)]
    lone = lone[(starts[lone + 1] == ends[lone]) & (kinds[starts[lone + 1]] == _LETTER)]
    if len(lone):
        low = codes | np.uint32(32)
        after = ends[lone]
        one, two = low[after], low[np.minimum(after + 1, len(low) - 1)]
        room = ends[lone + 1] - after
        taken = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
        for pair in ("re", "ve", "ll"):
            taken[(one == ord(pair[0])) & (two == ord(pair[1])) & (room > 1)] = 2
        # Only letters that are those of the contraction, in either case, and no others.
        taken[(codes[after] >= 128) | ((taken == 2) & (codes[np.minimum(after + 1, len(low) - 1)] >= 128))] = 0
        ends[lone] += taken
        starts[lone + 1] += taken
        full = starts < ends
        starts, ends = starts[full], ends[full]
    return starts, ends


class WordStore:
    """Ids of words by the words' hashes, in sorted arrays.

    Beyond ``limit`` words, the half that was used most stays.
    """

    def __init__(self, limit: int = KEPT) -> None:
        self.limit = limit
        self.keys = np.empty(0, np.uint64)
        self.begin = np.empty(0, np.int64)
        self.length = np.empty(0, np.int32)
        self.uses = np.empty(0, np.uint32)
        self.ids = np.empty(0, np.uint32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each of some sorted hashes is or belongs, and whether it is there."""
        at = np.searchsorted(self.keys, hashes)
        known = np.zeros(len(hashes), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == hashes
        return at, known

    def add(self, hashes: np.ndarray, ids: np.ndarray, ends: np.ndarray) -> None:
        """Keep new words: sorted hashes, all their ids in a row, and where each one's end."""
        at, _ = self.find(hashes)
        starts = np.append(0, ends[:-1])
        self.keys = np.insert(self.keys, at, hashes)
        self.begin = np.insert(self.begin, at, starts + len(self.ids))
        self.length = np.insert(self.length, at, ends - starts)
        self.uses = np.insert(self.uses, at, 0)
        self.ids = np.concatenate([self.ids, ids])

    def make_room(self, count: int) -> None:
        if len(self.keys) + count <= self.limit:
            return
        keep = max(0, min(self.limit // 2, self.limit - count))
        stay = np.sort(np.argsort(self.uses, kind="stable")[len(self.keys) - min(keep, len(self.keys)) :])
        ids = gathered(self.ids, self.begin[stay], self.length[stay])
        self.keys, self.length, self.uses = self.keys[stay], self.length[stay], self.uses[stay] // 2
        self.begin = np.append(0, np.cumsum(self.length[:-1]))[: len(stay)].astype(np.int64)
        self.ids = ids


def gathered(values: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs of ``values`` from ``begin`` on, end to end."""
    done = np.append(0, np.cumsum(length, dtype=np.int64))
    return values[np.repeat(begin - done[:-1], length) + np.arange(done[-1])]


class WordTokenizer:
    """``encode`` gives one array of ids for each text."""

    def __init__(self, path: str, kept: int = KEPT) -> None:
        self.path = path
        self.single = Tokenizer.from_file(path)
        self.single.normalizer = normalizers.Sequence([])
        self.single.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.single.get_vocab(with_added_tokens=True)
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.closing[number] = token.endswith("</w>")
        self.store = WordStore(kept)

    @cached_property
    def whole(self) -> Tokenizer:
        return Tokenizer.from_file(self.path)

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and where each word's end."""
        lines = [" ".join(words[i : i + _JOINED]) for i in range(0, len(words), _JOINED)]
        encoded = self.single.encode_batch_fast(lines, add_special_tokens=False)
        found = np.fromiter((x for e in encoded for x in e.ids), np.uint32)
        ends = np.flatnonzero(self.closing[found]) + 1
        if len(ends) != len(words):  # a piece that the library splits further
            rows = [self.single.encode(w, add_special_tokens=False).ids for w in words]
            found = np.fromiter((x for row in rows for x in row), np.uint32)
            ends = np.cumsum([len(row) for row in rows])
        return found, ends

    def _encode_block(self, texts: list[str]) -> list[np.ndarray]:
        block = Block(texts)
        starts, ends = _pieces(block)
        unique, at, inverse, counts = np.unique(
            block.hashes(starts, ends), return_index=True, return_inverse=True, return_counts=True
        )
        store = self.store
        _, known = store.find(unique)
        if not known.all():
            store.make_room(len(unique))
            _, known = store.find(unique)
            new = np.flatnonzero(~known)
            joined = "\n".join([*texts, ""]).lower()
            spans = zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)
            store.add(unique[new], *self._ids_of([joined[a:b] for a, b in spans]))
        slots, _ = store.find(unique)
        store.uses[slots] += counts.astype(np.uint32)
        slots = slots[inverse]
        lengths = store.length[slots]
        ids = gathered(store.ids, store.begin[slots], lengths)
        done = np.append(0, np.cumsum(lengths, dtype=np.int64))
        return np.split(ids, done[block.first(starts)][1:-1])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = ["<|" not in x and (x.isascii() or self._is_plain(x)) for x in texts]
        result: list[np.ndarray] = [np.empty(0, np.uint32)] * len(texts)
        fast = [i for i, p in enumerate(plain) if p]
        if fast:
            rows = self._encode_block([texts[i] for i in fast])
            for i, row in zip(fast, rows, strict=True):
                result[i] = row
        slow = [i for i, p in enumerate(plain) if not p]
        for i in slow:
            found = self.whole.encode(texts[i], add_special_tokens=False)
            result[i] = np.array(found.ids, np.uint32)
        return result

    @staticmethod
    def _is_plain(text: str) -> bool:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return bool((codes < _LIMIT).all() and not (codes == 0x130).any())
