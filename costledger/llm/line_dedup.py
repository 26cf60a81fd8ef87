"""Line deduplication by sorted hashes, with DataFrame operations only.

Lines become rows of a 128-bit hash, document and position, without their text. The rows are range-partitioned by hash and document and
sorted by hash, document and position, so a hash of a third of all lines covers many partitions; in that order the first occurrence
of a hash in a document is a streaming step. Counts of documents per hash are summed in the tasks first. A document's result is a
run-length coded bitmap: the rows that are dropped never carry text.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lower-cased. Empty keys are never dropped.

Defined cases: a NULL or empty text is one empty line; documents are told apart by ``doc_id`` and text, so repeated rows count as one
document and get the same bitmap, and NULL ids are compared as values; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costledger.llm.common import SPACES, stored

LEAST_DOCUMENTS = 10
KEY = ["doc_id", "text_hash"]
#: Names of added columns, which documents do not have.
OWN = "lines__"
LINES, DROPPED, BITMAP = (f"{OWN}{name}" for name in ("n_lines", "n_dropped", "bitmap"))


def lines(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), string.ascii_uppercase, string.ascii_lowercase)


def text_hash(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def line_rows(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash``, ``pos``, ``h1``, ``h2`` of each line whose key is not empty."""
    keys = F.transform(lines(), line_key)
    rows = docs.select("doc_id", text_hash().alias("text_hash"), F.posexplode(keys).alias("pos", "key"))
    hashes = [F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2")]
    return rows.where(F.col("key") != "").select(*KEY, "pos", *hashes)


def first_occurrences(rows: DataFrame, partitions: int) -> DataFrame:
    """The rows with ``first``: whether no earlier line of the same document has the hash.

    The window's grouping and order are those of the range partitioning, so it adds no shuffle.
    """
    placed = rows.repartitionByRange(partitions, "h1", "h2", *KEY)
    order = Window.partitionBy("h1", "h2", *KEY).orderBy("pos")
    return placed.withColumn("first", F.row_number().over(order) == 1)


def keep_bitmap(dropped: Column, n_lines: Column) -> Column:
    """Run-length coded bitmap: for each run of kept lines its first position and its length, as pairs of big-endian 32-bit numbers.

    ``dropped``: sorted positions.
    """
    edges = F.concat(F.array(F.lit(-1)), dropped, F.array(n_lines))
    # a kept run lies between neighbours that are not adjacent
    runs = F.zip_with(F.slice(edges, 1, F.size(edges) - 1), F.slice(edges, 2, F.size(edges) - 1), lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length")))
    kept = F.filter(runs, lambda r: r["length"] > 0)
    number = lambda c: F.lpad(F.hex(c.cast("long")), 8, "0")
    return F.unhex(F.array_join(F.transform(kept, lambda r: F.concat(number(r["start"]), number(r["length"]))), ""))


def bitmap_runs(bitmap: Column) -> Column:
    """The runs of a bitmap as an array of ``start`` and ``length``."""
    digits = F.hex(bitmap)
    number = lambda at: F.conv(F.substr(digits, at, F.lit(8)), 16, 10).cast("int")
    starts = F.when(F.length(digits) > 0, F.sequence(F.lit(1), F.length(digits), F.lit(16))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda at: F.struct(number(at).alias("start"), number(at + 8).alias("length")))


def kept_text(text: str, bitmap: Column) -> Column:
    """The kept lines of a text, joined; the whole text without a bitmap."""
    parts = F.transform(bitmap_runs(bitmap), lambda r: F.slice(lines(text), r["start"] + 1, r["length"]))
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.when(bitmap.isNull(), whole).otherwise(F.array_join(F.flatten(parts), "\n"))


def dropped_lines(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """The documents that lose lines: ``doc_id``, ``text_hash`` and the sorted positions ``dropped``.

    All lines go whose key occurs in at least ``least_documents`` documents.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(first_occurrences(line_rows(docs), partitions), "line_rows")
    # one row per hash and task is shuffled
    found = rows.where("first").groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_documents)
    dropped = rows.join(found.select("h1", "h2"), ["h1", "h2"])  # a hot hash is split by adaptive execution
    return dropped.groupBy(*KEY).agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def _marked(docs: DataFrame, least_documents: int) -> DataFrame:
    """The documents with all their columns, the number of their lines, of those dropped, and the bitmap."""
    marks = dropped_lines(docs, least_documents)
    marks = marks.select(F.col("doc_id").alias(f"{OWN}id"), F.col("text_hash").alias(f"{OWN}mark"), F.col("dropped").alias(f"{OWN}dropped"))
    same = F.col("doc_id").eqNullSafe(F.col(f"{OWN}id")) & (F.col(f"{OWN}hash") == F.col(f"{OWN}mark"))
    joined = docs.withColumn(f"{OWN}hash", text_hash()).join(marks, same, "left")
    n_lines, dropped = F.size(lines()), F.col(f"{OWN}dropped")
    n_dropped = F.coalesce(F.size(dropped), F.lit(0)).cast("long")
    bitmap = F.when(dropped.isNotNull(), keep_bitmap(dropped, n_lines))
    return joined.select(*docs.columns, n_lines.cast("long").alias(LINES), n_dropped.alias(DROPPED), bitmap.alias(BITMAP))


def drop_repeated_lines(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """``doc_id``, ``text``, ``n_lines``, ``n_dropped`` and ``bitmap`` (NULL if every line stays) of all documents; ``kept_text`` applies the bitmap."""
    names = [F.col(LINES).alias("n_lines"), F.col(DROPPED).alias("n_dropped"), F.col(BITMAP).alias("bitmap")]
    return _marked(docs.select("doc_id", "text"), least_documents).select("doc_id", "text", *names)


def without_repeated_lines(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """All documents with all their columns; texts that lose lines, and their ``n_chars``, are replaced."""
    marked = _marked(docs, least_documents)
    lost = F.col(DROPPED) > 0
    replaced = marked.withColumn("text", F.when(lost, kept_text("text", F.col(BITMAP))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        length = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        replaced = replaced.withColumn("n_chars", F.when(lost, length).otherwise(F.col("n_chars")))
    return replaced.select(*docs.columns)
