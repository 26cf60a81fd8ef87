"""Delimited files whose quoted cells hold line breaks, read by many tasks a file.

Whether a line break ends a record depends on all quotes before it. So files are passed over twice, in blocks:

- the survey tells, for each block, whether its quotes are odd in number, and how many records begin in it if it begins outside a
  cell, and if inside;
- a running parity over the blocks of a file tells which case holds, running sums the number of the first record;
- then each block is cut, as its state is known. A block owns the records that begin in it; the last one is read on to its end.

The table between the passes has a row a block. Rows are numbered in the order of files and places without storing or sorting them.
The survey also finds files that are not UTF-8, which are taken as windows-1252, so that needs no pass of its own.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from costledger.session import materialise
from costledger.sources.blocks import STEP, blocks_of, listed, open_file, over_rows
from costledger.sources.delimited import WINDOWS, check_suffix, mark_missing

#: Bytes of a block; a task holds some four times as much.
BLOCK_BYTES = 32 * 1024**2

#: Bytes of a character; a block is no shorter.
LONGEST_CHARACTER = 4

QUOTE, BREAK, RETURN = b'"\n\r'
BOM = b"\xef\xbb\xbf"
TO_WINDOWS = str.maketrans(WINDOWS)

BLOCK = "path string, length long, offset long, size long"
SURVEY = f"{BLOCK}, odd long, starts_outside long, starts_inside long, utf8 boolean, lead long, wanted long"


def _breaks(data: np.ndarray, state: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of line breaks, the state at each (1: inside a cell), and the state behind the data; the first ``skip`` bytes count no quotes."""
    quotes = data == QUOTE
    quotes[:skip] = False
    inside = (np.cumsum(quotes, dtype=np.uint8) + np.uint8(state)) & 1  # wraps around at 256, which keeps the parity
    at = np.flatnonzero(data == BREAK)
    return at, inside[at], int(inside[-1]) if len(data) else state


def _partial(tail: bytes) -> tuple[int, int]:
    """Bytes of a character that a text ends in the middle of: how many are there, and how many it lacks."""
    for there in range(1, min(3, len(tail)) + 1):
        byte = tail[-there]
        if byte >= 0xC0:
            lacks = (2 if byte < 0xE0 else 3 if byte < 0xF0 else 4) - there
            return (there, lacks) if lacks > 0 else (0, 0)
        if byte < 0x80:
            break
    return 0, 0


def _read(row: dict, beyond: int = 0) -> tuple[bytes, int]:
    """The bytes of a block with the one before it, and how many of these there are (0 or 1)."""
    before = 1 if row["offset"] else 0
    with open_file(row["path"]) as file:
        file.seek(row["offset"] - before)
        return file.read(before + row["size"] + beyond), before


def _surveyed(row: dict) -> Iterator[pa.RecordBatch]:
    data, before = _read(row, 2)
    body = data[before : before + row["size"]]
    array = np.frombuffer(data[: before + row["size"]], dtype=np.uint8)
    at, inside, odd = _breaks(array, 0, before)
    starts = at + 1
    inner = starts < len(array)
    starts, inside = starts[inner], inside[inner]
    if not row["offset"]:
        starts, inside = np.append(0, starts), np.append(0, inside)
    # records without a character are none; two bytes more than the block has may be needed to see that
    ahead = np.frombuffer(data + b"\n\n", dtype=np.uint8)
    real = ~((ahead[starts] == BREAK) | ((ahead[starts] == RETURN) & (ahead[starts + 1] == BREAK)))
    lead = next((k for k, byte in enumerate(body[:3]) if not 0x80 <= byte < 0xC0), min(3, len(body))) if before else 0
    there, wanted = _partial(body)
    try:
        body[lead : len(body) - there].decode("utf-8")
        utf8 = True
    except UnicodeDecodeError:
        utf8 = False
    counts = {"starts_outside": int((real & (inside == 0)).sum()), "starts_inside": int((real & (inside == 1)).sum())}
    yield pa.RecordBatch.from_pylist([{**row, "odd": odd, **counts, "utf8": utf8, "lead": lead, "wanted": wanted}])


def _records(row: dict) -> list[bytes]:
    """The records that begin in a block."""
    data, before = _read(row)
    array = np.frombuffer(data, dtype=np.uint8)
    at, inside, state = _breaks(array, row["inside"], before)
    outside = at[inside == 0]
    starts = outside[outside + 1 < len(data)] + 1
    if not row["offset"]:
        starts, ends = np.append(0, starts), outside
    else:
        ends = outside[1:]
    found = [data[a:b] for a, b in zip(starts[: len(ends)].tolist(), ends.tolist(), strict=False)]
    if len(starts) > len(ends):  # the last one goes on behind the block
        parts, place = [data[starts[-1] :]], row["offset"] + row["size"]
        with open_file(row["path"]) as file:
            file.seek(place)
            while more := file.read(STEP):
                at, inside, state = _breaks(np.frombuffer(more, dtype=np.uint8), state)
                closing = at[inside == 0]
                parts.append(more[: closing[0]] if len(closing) else more)
                if len(closing):
                    break
        found.append(b"".join(parts))
    if not row["offset"] and found:
        found[0] = found[0].removeprefix(BOM)
    return [r for r in (r.removesuffix(b"\r") for r in found) if r]


def _decoded(records: list[bytes], utf8: bool) -> list[str]:
    return [r.decode("utf-8") for r in records] if utf8 else [r.decode("latin-1").translate(TO_WINDOWS) for r in records]


def _first(row: dict) -> Iterator[pa.RecordBatch]:
    """The header of a file, out of its first bytes: ``path`` and ``names``."""
    size = min(row["length"], STEP)
    header = _records({**row, "offset": 0, "size": size, "inside": 0})[:1]
    names = [column_names(text) for text in _decoded(header, row["utf8"])]
    yield pa.RecordBatch.from_arrays([pa.array([row["path"]] * len(names), pa.string()), pa.array(names, pa.list_(pa.string()))], ["path", "names"])


def _cut(row: dict) -> Iterator[pa.RecordBatch]:
    texts = _decoded(_records(row), row["utf8"])
    first = row["before"]
    if not row["place"]:  # the first record of the file is its header
        texts = texts[1:]
    numbers = pa.array(np.arange(first, first + len(texts)), pa.int64())
    for at in range(0, len(texts), 10_000):
        part = texts[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array([row["path"]] * len(part), pa.string()), numbers.slice(at, len(part)), pa.array(part, pa.string())], ["source_file", "number", "value"])


def survey(blocks: DataFrame) -> DataFrame:
    """A row a block: its state (``inside``), the number of its first record in the file (``place``) and of its first row among all (``before``), ``utf8``."""
    seen = materialise(over_rows(blocks, _surveyed, SURVEY), "survey")
    # a window holds the blocks of one file
    ordered = W.partitionBy("path").orderBy("offset")
    earlier = ordered.rowsBetween(W.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).cast("int")
    # of the first blocks of a file the last one may end within a character
    next_lead = F.coalesce(F.lead("lead").over(ordered), F.when(F.col("offset") + F.col("size") < F.col("length"), F.col("wanted")).otherwise(0))
    whole = F.col("utf8") & (next_lead == F.col("wanted"))
    known = seen.withColumns({"inside": inside, "utf8": whole}).withColumn("n", F.when(F.col("inside") == 1, F.col("starts_inside")).otherwise(F.col("starts_outside")))
    known = known.withColumns({"utf8": F.min("utf8").over(W.partitionBy("path")), "place": F.coalesce(F.sum("n").over(earlier), F.lit(0))})
    known = known.withColumn("rows", F.col("n") - F.when((F.col("place") == 0) & (F.col("n") > 0), 1).otherwise(0))
    # a row a file
    files = known.groupBy("path").agg(F.sum("rows").alias("rows"))
    first = F.coalesce(F.sum("rows").over(W.orderBy("path").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    within = known.withColumn("within", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    placed = within.join(files.select("path", first.alias("first")), "path").withColumn("before", F.col("first") + F.col("within"))
    return materialise(placed.select("path", "length", "offset", "size", "inside", "utf8", "place", "before", "n"), "blocks")


def headers(blocks: DataFrame) -> DataFrame:
    """``path`` and ``names`` (of its columns) of each file, by one job."""
    return over_rows(blocks.where("offset = 0").select("path", "length", "utf8"), _first, "path string, names array<string>")


def one_header(blocks: DataFrame) -> list[str]:
    """The columns that all files have."""
    found = headers(blocks).groupBy("names").agg(F.min("path").alias("path")).orderBy("path").limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"Files with different headers: {found[0]['path']} and {found[1]['path']}")
    if not found:
        raise ValueError("No file with a header")
    return found[0]["names"]


def column_names(header: str) -> list[str]:
    """Names of the columns; one that was there before, in any case, gets its position behind it."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([header], strict=False))):
        taken = {n.lower() for n in names}
        names.append(f"{name}{i}" if name.lower() in taken else name or f"_c{i}")
    return names


def _cells(width: int) -> Column:
    """The cells of ``value``, by position."""
    schema = ", ".join(f"_c{i} STRING" for i in range(width))
    return F.from_csv("value", schema, {"quote": '"', "escape": '"', "maxCharsPerColumn": "-1"})


def _cut_records(blocks: DataFrame) -> DataFrame:
    return over_rows(blocks.where("n > 0"), _cut, "source_file string, number long, value string")


def read_by_name(spark: SparkSession, path: str | list[str], number: str = "src_row", missing: bool = True, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """All text columns of files whose headers may differ, by name in any case; a column that a file lacks is NULL in its rows. And the files' headers.

    The number of jobs depends neither on the number of files nor on that of headers. Files with a column ``number`` keep its values.
    """
    blocks = survey(_listed_blocks(spark, path, block_bytes))
    known = materialise(headers(blocks), "headers")  # a row a file
    lower = F.transform("names", lambda n: F.lower(n))
    shape = known.select(F.explode("names").alias("name"), F.size("names").alias("width")).groupBy(F.lower("name").alias("key")).agg(F.min("name").alias("name"), F.max("width").alias("width"))
    columns = {r["key"]: (r["name"], r["width"]) for r in shape.orderBy("key").collect()}  # a row a column
    if not columns:
        raise ValueError("No file with a header")
    width = max(w for _, w in columns.values())
    cells = F.array(*[F.col(f"_cells._c{i}") for i in range(width)])
    rows = _cut_records(blocks).withColumn("_cells", _cells(width)).select("source_file", "number", cells.alias("_cells"))
    rows = rows.join(F.broadcast(known.select(F.col("path").alias("source_file"), lower.alias("_names"))), "source_file")
    # one column less than its place, which is 0 where there is none
    cell = lambda key: F.get("_cells", (F.array_position("_names", F.lit(key)) - 1).cast("int"))
    picked = [cell(key).alias(name) for key, (name, _) in columns.items() if key != number.lower()]
    own = F.when(F.array_contains("_names", number.lower()), cell(number.lower()).try_cast("bigint")).otherwise(F.col("number"))
    df = rows.select(*picked, "source_file", own.alias(number))
    return (mark_missing(df) if missing else df), known


def read_quoted(spark: SparkSession, path: str | list[str], missing: bool = True, number: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All text columns of delimited files with one header, whose quoted cells may hold line breaks.

    A file is read by as many tasks as it has blocks. ``number`` names a column for the rows' numbers from 0, in the order of files and places,
    and adds ``source_file``; files that have such a column keep its values. Records without a character are left out. A quote that is never closed makes the rest of its file one record.
    """
    return _rows(_listed_blocks(spark, path, block_bytes), missing, number)


class Prefixes:
    """The rows of the first blocks of a source, in the order of files and places: for readers that stop once they have enough.

    The last row is whole, as its block reads it to its end. A file's encoding is judged by the blocks that are read of it.
    """

    def __init__(self, spark: SparkSession, path: str | list[str], missing: bool = True, number: str = "src_row", block_bytes: int = BLOCK_BYTES):
        self.listing = materialise(_listed_blocks(spark, path, block_bytes), "listing")
        self.total = self.listing.count()
        self.missing, self.number = missing, number

    def rows(self, blocks: int) -> DataFrame:
        first = self.listing if blocks >= self.total else self.listing.orderBy("path", "offset").limit(blocks)
        return _rows(first, self.missing, self.number)


def _listed_blocks(spark: SparkSession, path: str | list[str], block_bytes: int) -> DataFrame:
    for one in [path] if isinstance(path, str) else path:
        check_suffix(one)
    return blocks_of(listed(spark, path), max(LONGEST_CHARACTER, block_bytes))


def _rows(listing: DataFrame, missing: bool, number: str | None) -> DataFrame:
    blocks = survey(listing)
    names = one_header(blocks)
    own = number is not None and number.lower() in [n.lower() for n in names]
    numbered = ["source_file", F.col("number").alias(number)] if number and not own else ["source_file"] if number else []
    rows = _cut_records(blocks).withColumn("_cells", _cells(len(names)))
    df = rows.select(*[F.col(f"_cells._c{i}").alias(n) for i, n in enumerate(names)], *numbered)
    df = mark_missing(df) if missing else df
    return df.withColumn(number, F.col(f"`{number}`").try_cast("bigint")) if own else df
