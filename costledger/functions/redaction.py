"""Replacement of dictionary keys in a text, for use inside Arrow batches."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts of a batch that a task holds as Python strings at a time, in bytes.
PIECE_BYTES = 1 << 20

# Splits a text into maximal runs: words at odd places, the runs between them at even ones, perhaps empty at both
# ends. Word boundaries are exactly where two runs meet, so a match always covers whole runs.
_WORDS = re.compile(r"(\w+)")


def pieces(texts: Sequence[pa.Array], *others: pa.Array, max_bytes: int = PIECE_BYTES) -> Iterator[tuple[pa.Array, ...]]:
    """The rows of a batch in order, some at a time with at most ``max_bytes`` of texts, or one row that has more."""
    sizes = sum(pc.fill_null(pc.binary_length(t), 0).to_numpy(zero_copy_only=False).astype(np.int64) for t in texts)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + max_bytes, side="right")))
        yield tuple(column.slice(start, stop - start) for column in (*texts, *others))
        start = stop


class KeyIndex(NamedTuple):
    """First run of the keys -> numbers of runs of such keys, longest first; and whether one starts with a symbol."""

    sizes: dict[str, list[int]]
    symbols: bool

    @property
    def words_only(self) -> bool:
        return not self.symbols and all(sizes == [1] for sizes in self.sizes.values())


def index_keys(keys: Iterable[str]) -> KeyIndex:
    """Index of keys in any case.

    Keys are split as the texts are, before the lower case is taken: that of some letters has more runs.
    """
    found: dict[str, set[int]] = {}
    for key in keys:
        runs = [run for run in _WORDS.split(key) if run]
        if runs:
            found.setdefault(runs[0].lower(), set()).add(len(runs))
    symbols = any(_WORDS.fullmatch(head) is None for head in found)
    return KeyIndex({head: sorted(sizes, reverse=True) for head, sizes in found.items()}, symbols)


def replace_words(text: str, aliases: Mapping[str, str]) -> str:
    """Replace single words, for dictionaries without other keys."""
    parts = _WORDS.split(text)
    parts[1::2] = [aliases.get(word.lower(), word) for word in parts[1::2]]
    return "".join(parts)


def replace_keys(text: str, aliases: Mapping[str, str], index: KeyIndex) -> str:
    """Replace the leftmost key, of several the longest, between word boundaries, in one pass.

    The runs at both ends of a text that are no words have a boundary on one side only and are never part of a match.
    """
    parts = _WORDS.split(text)
    last = len(parts) - 1
    places = range(1, last) if index.symbols else range(1, last, 2)
    out: list[str] = []
    done = 0
    for i in [i for i in places if parts[i].lower() in index.sizes]:
        if i < done:
            continue
        for size in index.sizes[parts[i].lower()]:
            if i + size > last:
                continue
            alias = aliases.get("".join(parts[i : i + size]).lower())
            if alias is not None:
                out += parts[done:i]
                out.append(alias)
                done = i + size
                break
    if not done:
        return text
    return "".join(out + parts[done:])


# Bits of a block of a key filter, as Spark's bitmap functions make them.
_BLOCK_BITS = 1 << 15
_HEAD = "\0"


def _places(item: str, bits: int) -> list[int]:
    """Four places of an item in a filter."""
    digest = hashlib.blake2b(item.encode("utf-8", "surrogatepass"), digest_size=32).digest()
    return [int.from_bytes(digest[i : i + 8], "little") % bits for i in range(0, 32, 8)]


def key_places(key: str, bits: int) -> list[int]:
    """The places of a key and of its first run."""
    runs = [run for run in _WORDS.split(key) if run]
    return _places(key.lower(), bits) + _places(_HEAD + runs[0].lower(), bits) if runs else []


class KeyFilter:
    """Which places of a text probably start a key, by a Bloom filter in blocks."""

    def __init__(self, bits: int, blocks: Mapping[int, bytes]) -> None:
        self.bits, self.blocks = bits, blocks
        # words repeat; the memory of their answers is bounded
        self.holds = lru_cache(maxsize=200_000)(self._holds)

    def _holds(self, item: str) -> bool:
        for place in _places(item, self.bits):
            block = self.blocks.get(place // _BLOCK_BITS + 1)
            at = place % _BLOCK_BITS
            if block is None or not block[at >> 3] >> (at & 7) & 1:
                return False
        return True

    def _of_text(self, text: str, sizes: Sequence[int]) -> Iterator[str]:
        runs = [run for run in _WORDS.split(text) if run]
        for i, run in enumerate(runs):
            if self.holds(_HEAD + run.lower()):
                for size in sizes:
                    if i + size <= len(runs):
                        key = "".join(runs[i : i + size]).lower()
                        if self.holds(key):
                            yield key

    def candidates(self, texts: Iterable[str | None], sizes: Sequence[int]) -> list[str]:
        """The distinct probable keys of some texts, in lower case."""
        return sorted({key for text in texts if text is not None for key in self._of_text(text, sizes)})
