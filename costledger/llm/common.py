"""Helpers of the training-data operators: Arrow batches of bounded size, shared tables, hashing of words."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costledger.session import materialise

#: Texts may be long, so batches that go to Python tasks hold few rows.
TEXT_BATCH = 256

#: White space as the contracts define it, as SQL ``trim`` characters and as a table over bytes.
SPACES = " \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES.encode())] = True

WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def in_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str, rows: int = TEXT_BATCH) -> DataFrame:
    """``mapInArrow`` with at most ``rows`` rows in a batch, which bounds a task's memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df.mapInArrow(function, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: cuts the lineage, survives lost executors."""
    return materialise(df, f"llm_{name}")


def crc_remainder(column: str, modulus: int):
    """crc32 of an id as text, modulo ``modulus``; a NULL id counts as an empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col(column).cast("string"), F.lit("")), "utf-8")), F.lit(modulus))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits (the finaliser of splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


#: Fixed random value of each byte, with A-Z as a-z.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BYTE_VALUES[65:91] = BYTE_VALUES[97:123]
ODD = np.uint64(0xD6E8FEB86659FD93)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of a column, one after the other, and where each starts (and the last ends); NULL is empty."""
    column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(column) else np.zeros(0, dtype=np.uint8)
    return raw, offsets - offsets[0]


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of the texts; a word ends with its text."""
    inside = ~IS_SPACE[raw]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(raw))]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word with A-Z lower-cased: a polynomial in its bytes, then mixed."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    longest = int((ends - starts).max())
    powers = np.cumprod(np.full(longest, ODD, dtype=np.uint64), dtype=np.uint64)
    lengths = ends - starts
    # position of each byte in its word
    at = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    terms = BYTE_VALUES[raw[at + np.repeat(starts, lengths)]] * powers[at]
    return mix(np.add.reduceat(terms, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes (signed) of its shingles of ``width`` words.

    With fewer words the whole sequence is the one shingle; without words the set is empty.
    """
    raw, offsets = utf8(column)
    starts, ends = word_bounds(raw, offsets)
    hashes = word_hashes(raw, starts, ends)
    firsts = np.searchsorted(starts, offsets[:-1])
    lasts = np.searchsorted(starts, offsets[1:])
    for first, last in zip(firsts, lasts, strict=True):
        words, n = hashes[first:last], min(width, last - first)
        if not n:
            yield np.zeros(0, dtype=np.int64)
            continue
        total = np.full(len(words) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            total = mix(total * ODD + words[k : len(words) - n + 1 + k])
        yield np.unique(total.view(np.int64))


def whole_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups out of a stream that is sorted by its first ``n_keys`` columns (whole numbers, not NULL).

    Also gives where each group starts, and the end. What is held is one batch and one group.
    """

    def starts_of(rows: pa.Table) -> np.ndarray:
        changes = np.zeros(rows.num_rows, dtype=bool)
        changes[0] = True
        for k in range(n_keys):
            values = rows.column(k).to_numpy()
            changes[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(changes)

    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = pa.Table.from_batches([batch])
        if held:
            last, first = held[-1].slice(held[-1].num_rows - 1), new.slice(0, 1)
            if all(last.column(k)[0] == first.column(k)[0] for k in range(n_keys)) and len(starts_of(new)) == 1:
                held.append(new)  # one group so far
                continue
        rows = pa.concat_tables([*held, new]).combine_chunks()
        starts = starts_of(rows)
        if starts[-1]:
            yield rows.slice(0, starts[-1]), starts
        held = [rows.slice(starts[-1])]
    if held:
        rows = pa.concat_tables(held).combine_chunks()
        yield rows, np.append(starts_of(rows), rows.num_rows)


def by_groups(df: DataFrame, keys: list[str], function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str, rows: int = 2000) -> DataFrame:
    """Runs ``function`` over partitions that hold whole groups of ``keys``, sorted by them."""
    return in_batches(df.repartition(*keys).sortWithinPartitions(*keys), function, schema, rows)


def block_pairs(block, n_blocks, inner: bool = True):
    """For a member of block ``block`` of ``n_blocks``: the pairs (i <= j) of blocks that hold it, as an array of structs.

    Comparing within each pair compares all members with each other, in groups of bounded size. Without ``inner`` a pair of equal blocks
    is left out unless there is one block only, for comparisons that take a pair of blocks as one group.
    """
    others = F.sequence(F.lit(0), n_blocks - 1)
    if not inner:
        others = F.filter(others, lambda o: (o != block) | (n_blocks == 1))
    return F.transform(others, lambda o: F.struct(F.least(o, block).cast("int").alias("i"), F.greatest(o, block).cast("int").alias("j")))
