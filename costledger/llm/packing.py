"""Packing documents into training windows: sum-of-squares online packing.

Each task packs the documents it reads, in one pass and without a shuffle. It keeps an array with the number of open windows at each
fill level. A document (its tail, if it is longer than a window) goes to the level at which the sum of the squared counts of partially
filled windows becomes smallest; full windows leave at once. Open windows are bounded: at ``most_open`` of them, and at the end of the
task, windows are closed by cutting the emptiest into the gaps of the fullest (half of them, and all at the end), so that at most one
window of a task is padded.

Defined cases: a NULL text is empty and gives the end id alone; a NULL id is kept; repeated rows are packed each on their own; of levels with
equal sums the fullest is taken; a very long text fills windows of its own and only its tail is placed; an empty table gives no
rows; other columns are ignored. Sequence ids are unique over all tasks, not dense.
"""

from __future__ import annotations

import re
import struct
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from costledger.llm.common import WORD_PATTERN, in_batches

WINDOW = 2048
END_ID = 1
MOST_OPEN = 4096
#: Pieces, and words of other than plain characters, whose ids a worker process keeps; beyond it the oldest half goes.
CACHED_WORDS = 400_000
#: Pieces in one batch of results.
PIECES_OUT = 4096

#: Letters beyond ASCII whose lower case is one letter of the same range, and marks; canonical composition leaves all of them alone.
_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
PLAIN = re.compile(f"[\x20-\x7e\x09-\x0d{_LETTERS}¡¿«»“”„‘’…–—]*")

#: The pre-tokenizer's pattern of the vocabulary file (fixed value) for plain characters in lower case.
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LETTERS}]+|[0-9]|[^a-z0-9\x20\x09-\x0d{_LETTERS}]+")
WORDS = re.compile(WORD_PATTERN)

#: Forms of bytes that are no printable characters of Latin-1, as byte-level vocabularies write them: U+0100 onwards, in order.
BYTE_FORMS = {b: 0x100 + n for n, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}

SCHEMA = "doc_id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Kept(dict):
    """A table of ``CACHED_WORDS`` entries, and those of one text: once it is larger, the oldest go."""

    def make_room(self) -> None:
        if len(self) > CACHED_WORDS:
            for key in list(islice(self, len(self) - CACHED_WORDS // 2)):
                del self[key]


class TextIds:
    """Ids of texts, as little-endian unsigned 32-bit numbers; those of their pieces are kept.

    The vocabulary drops white space and never joins across it or across the pieces of its pre-tokenizer, so a text's ids are those of its
    pieces. A text of ``PLAIN`` characters, which the normaliser only lower-cases, is cut into pieces here. Other texts are cut into words, and
    those with other characters go through the tokenizer. A text that holds one of the added tokens, in any case, goes through it whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces, self.words = Kept(), Kept()

    def _encoded(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _of_pieces(self, pieces: list[str]) -> bytes:
        found = list(map(self.pieces.get, pieces))
        if None in found:
            new = {piece for piece, ids in zip(pieces, found, strict=True) if ids is None}
            for piece in new:
                # as the pre-tokenizer does: a character for each byte
                form = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(BYTE_FORMS)
                ids = [t.id for t in self.model.tokenize(form)]
                self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
            found = list(map(self.pieces.__getitem__, pieces))
        return b"".join(found)

    def _of_word(self, word: str) -> bytes:
        if PLAIN.fullmatch(word):
            return self._of_pieces(PIECES.findall(word.lower()))
        if word not in self.words:
            self.words[word] = self._encoded(word)
        return self.words[word]

    def __call__(self, text: str | None) -> bytes:
        lower = (text or "").lower()
        if any(a in lower for a in self.added):
            return self._encoded(text)
        self.pieces.make_room()
        self.words.make_room()
        if PLAIN.fullmatch(text or ""):
            return self._of_pieces(PIECES.findall(lower))
        return b"".join(map(self._of_word, WORDS.findall(text or "")))


@lru_cache(maxsize=2)
def text_ids(path: str) -> TextIds:
    """One for each worker process, which runs many tasks one after the other."""
    return TextIds(path)


class SquaredLevels:
    """Open windows by fill level, and the choice of the level for the next piece."""

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, dtype=np.int64)  # number of open windows at each level; 0 and full stay 0
        self.open: list[list] = [[] for _ in range(window)]
        self.n_open = 0
        self._last = np.full(window + 1, 2, dtype=np.int64)
        self._last[window] = 1  # a window that becomes full leaves the sum

    def place(self, piece: tuple, size: int) -> list | None:
        """Adds a piece of less than a window; returns the window's pieces if it is full now."""
        counts, window = self.counts, self.window
        level, least = 0, 2 * counts[size] + 1
        if self.n_open:
            before = counts[1 : window - size + 1]
            # change of the sum of squares if a window moves from its level to the one above
            change = 2 * (counts[1 + size :] - before) + self._last[1 + size :]
            change[before == 0] = np.iinfo(np.int64).max
            best = len(change) - 1 - int(change[::-1].argmin())  # the fullest of equal ones
            if change[best] <= least:
                level = best + 1
        if level:
            pieces = self.open[level].pop()
            counts[level] -= 1
            self.n_open -= 1
        else:
            pieces = []
        pieces.append(piece)
        level += size
        if level == window:
            return pieces
        self.open[level].append(pieces)
        counts[level] += 1
        self.n_open += 1
        return None

    def drain(self, keep: int = 0) -> Iterator[list]:
        """Closes windows until ``keep`` are open: the emptiest are cut into the gaps of the fullest; only the very last one may stay partly filled."""
        left = deque([level, pieces] for level in range(self.window - 1, 0, -1) for pieces in self.open[level])
        self.counts[:] = 0
        self.open = [[] for _ in range(self.window)]
        self.n_open = 0
        while len(left) > keep:
            fill, pieces = left.popleft()
            while fill < self.window and left:
                donor = left[-1][1]
                doc, start, ids, total = donor.pop()
                fits = min(len(ids) // 4, self.window - fill)
                pieces.append((doc, start, ids[: 4 * fits], total))
                fill += fits
                left[-1][0] -= fits
                if 4 * fits < len(ids):
                    donor.append((doc, start + fits, ids[4 * fits :], total))
                if not donor:
                    left.pop()
            yield pieces
        for level, pieces in left:
            self.open[level].append(pieces)
            self.counts[level] += 1
            self.n_open += 1


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, most_open: int = MOST_OPEN) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids`` (little-endian unsigned 32 bit), ``doc_tokens``, ``sequence_id``, ``offset``."""
    kind = dict(docs.dtypes)["doc_id"]
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = text_ids(tokenizer_path)
        levels = SquaredLevels(window)
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        out: list[tuple] = []
        id_type = None

        def emit(pieces: list) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids, total in pieces:
                out.append((doc, start, len(ids) // 4, ids, total, sequence, offset))
                offset += len(ids) // 4
            sequence += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            out.clear()
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = ids_of(text) + end
                total = len(ids) // 4
                whole = total - total % window
                for start in range(0, whole, window):
                    emit([(doc, start, ids[4 * start : 4 * (start + window)], total)])
                if total > whole:
                    full = levels.place((doc, whole, ids[4 * whole :], total), total - whole)
                    if full:
                        emit(full)
                    if levels.n_open >= most_open:
                        for pieces in levels.drain(most_open // 2):
                            emit(pieces)
                if len(out) >= PIECES_OUT:
                    yield flush()
        for pieces in levels.drain():
            emit(pieces)
        if out:
            yield flush()

    return in_batches(docs.select("doc_id", "text"), run, SCHEMA.format(id=kind))
