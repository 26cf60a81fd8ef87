"""Redaction: a dictionary out of the reference, and its application to text columns."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costledger.functions import redaction
from costledger.functions import text as X
from costledger.functions.redaction import (
    KeyFilter,
    KeyIndex,
    index_keys,
    key_places,
    pieces,
    replace_keys,
    replace_words,
)
from costledger.operators.numbering import number_sorted
from costledger.schemas import REFERENCE, conform, rename_columns, underscore_headers
from costledger.session import materialise

# The tasks get the functions themselves, so the package need not be installed where they run.
cloudpickle.register_pickle_by_value(redaction)

# Largest dictionary that is sent to every task, in characters of keys and aliases: some 300,000 entries, or 100 MB
# in each Python worker.
MAX_BROADCAST_CHARS = 8_000_000

# The filter of a larger dictionary: one key in 400 that is none passes at this size. At most 16 MB, at any number of keys.
BITS_PER_KEY = 32
MIN_FILTER_BITS, MAX_FILTER_BITS = 1 << 15, 1 << 27
# A task gets about this share of the hits of a shuffle partition out of one key.
HOT_SHARE = 4

# The runs of a text, as in functions.redaction.
RUNS = r"([\p{L}\p{N}_]+|[^\p{L}\p{N}_]+)"


def pii_keys(reference: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Distinct names, parts of addresses and ids, one scan of the reference; blank keys are dropped."""
    people = conform(rename_columns(underscore_headers(reference), renames or {}), REFERENCE)
    names = F.concat(
        F.array(X.ustrip("first_name"), X.ustrip("family_name")),
        F.coalesce(X.email_tokens("email"), F.array().cast("array<string>")),
    )
    found = F.concat(
        F.transform(names, lambda name: F.struct(name.alias("key"), F.lit(False).alias("is_id"))),
        F.array(F.struct(X.ustrip("staff_id").alias("key"), F.lit(True).alias("is_id"))),
    )
    return people.select(F.inline(found)).where(F.col("key").isNotNull() & (F.col("key") != "")).distinct()


def pii_dictionary(reference: DataFrame, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Key, lower-case key, alias and whether the key is an id; a row per lower-case key.

    Names are numbered from the longest on, ids in text order; equal lengths go by the text, so the numbers do
    not depend on the run. An id wins over an equal name, else the last of several spellings.
    """
    keys = pii_keys(reference, renames)
    size = F.when(F.col("is_id"), 0).otherwise(-F.length("key"))
    numbered = number_sorted(keys.withColumn("_size", size), ["is_id", "_size", "key"], "_n", start=1)
    # the ids follow all the names, so their own count starts after the last name
    names = numbered.where(~F.col("is_id")).agg(F.max("_n")).scalar()
    index = F.when(F.col("is_id"), F.col("_n") - F.coalesce(names, F.lit(0))).otherwise(F.col("_n")).cast("string")
    alias = F.when(F.col("is_id"), F.concat(F.lit("9"), X.zero_pad(index, 6))).otherwise(
        F.concat(F.lit("RedactedName_"), index)
    )
    return (
        numbered.select("key", F.lower("key").alias("key_lower"), alias.alias("alias"), "is_id", "_n")
        .groupBy("key_lower")
        .agg(F.max_by(F.struct("key", "alias", "is_id"), F.struct("is_id", "_n")).alias("last"))
        .select("last.key", "key_lower", "last.alias", "last.is_id")
    )


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def redact(
    df: DataFrame,
    dictionary: DataFrame,
    columns: Sequence[str] | None = None,
    max_broadcast_chars: int = MAX_BROADCAST_CHARS,
) -> DataFrame:
    """Replace all dictionary keys in the text columns, in any case, between word boundaries, in one pass.

    The dictionary is measured first. Up to the limit it goes to every task and the text is not shuffled. Of a larger
    one, a filter of fixed size finds the places of a text that probably hold a key, and each row is joined with these.
    """
    columns = text_columns(df) if columns is None else list(columns)
    size = _chars(dictionary)
    if size == 0 or not columns:
        return df
    if size > max_broadcast_chars:
        return _redact_large(df, dictionary, columns)
    return _redact_small(df, dictionary, columns)


def _chars(dictionary: DataFrame) -> int:
    chars = F.length("key_lower") + F.length("alias")
    return dictionary.agg(F.coalesce(F.sum(chars), F.lit(0)).alias("chars")).first()["chars"]


def _key_sizes(dictionary: DataFrame) -> list[int]:
    """The numbers of runs that keys have; a handful."""
    both = dictionary.select(F.explode(F.array("key", "key_lower")).alias("key"))
    runs = F.size(F.regexp_extract_all("key", F.lit(RUNS), F.lit(1)))
    return sorted(r["n"] for r in both.select(runs.alias("n")).distinct().collect())


def _texts_of(columns: list[str]) -> list[Column]:
    """The text columns and an empty one, as of a single one the batches of a function are no tuples."""
    return [*[F.col(f"`{c}`") for c in columns], F.lit(None).cast("string")]


def _with_texts(df: DataFrame, columns: list[str], texts: Column) -> DataFrame:
    """``df`` with the text columns out of an array of them: one function for all, so that a task has one Python worker."""
    name, taken = "_texts", {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    replaced = df.withColumn(name, texts)
    return replaced.withColumns({c: F.col(name)[i] for i, c in enumerate(columns)}).drop(name)


def _redact_small(df: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    rows = dictionary.select("key", "key_lower", "alias").collect()
    aliases = {r["key_lower"]: r["alias"] for r in rows}
    index = index_keys([*aliases, *(r["key"] for r in rows)])
    # single words are found without the index
    shared = df.sparkSession.sparkContext.broadcast((aliases, None if index.words_only else tuple(index)))

    @F.arrow_udf("array<string>")
    def replaced(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        aliases, index = shared.value
        if index is not None:
            index = KeyIndex(*index)

        def shown(text: str | None) -> str | None:
            if text is None:
                return None
            return replace_words(text, aliases) if index is None else replace_keys(text, aliases, index)

        for batch in batches:
            for piece in pieces(batch[:-1]):
                rows = zip(*(texts.to_pylist() for texts in piece))
                yield pa.array([[shown(t) for t in row] for row in rows], pa.list_(pa.string()))

    return _with_texts(df, columns, replaced(*_texts_of(columns)))


def _key_filter(dictionary: DataFrame, n_keys: int) -> tuple[int, dict[int, bytes]]:
    """Bloom filter of the keys and of their first runs: its bits, and blocks of it by their number.

    The bits are set by tasks and gathered by block; what reaches the driver is bounded by ``MAX_FILTER_BITS``. A filter that
    is full lets more candidates through to the join, and loses none.
    """
    wanted = max(BITS_PER_KEY * n_keys, MIN_FILTER_BITS)
    bits = min(1 << (wanted - 1).bit_length(), MAX_FILTER_BITS)

    @F.pandas_udf("array<bigint>")
    def places(keys: pd.Series) -> pd.Series:
        return pd.Series([key_places(k, bits) for k in keys], dtype=object)

    spelled = dictionary.select(F.explode(F.array("key", "key_lower")).alias("key"))
    # the bitmap functions count places from 1
    place = spelled.select(F.explode(F.transform(places("key"), lambda p: p + 1)).alias("place"))
    blocks = place.groupBy(F.bitmap_bucket_number("place").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    return bits, {r["block"]: bytes(r["bits"]) for r in blocks.collect()}


def _key_hits(rows: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """``_row`` and ``key_lower``, once each, of the places that probably hold a key."""
    sizes = _key_sizes(dictionary)
    shared = rows.sparkSession.sparkContext.broadcast(_key_filter(dictionary, dictionary.count()))

    @F.arrow_udf("array<string>")
    def candidates(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        known = KeyFilter(*shared.value)
        for batch in batches:
            for piece in pieces(batch[:-1]):
                rows = zip(*(texts.to_pylist() for texts in piece))
                yield pa.array([known.candidates(row, sizes) for row in rows], pa.list_(pa.string()))

    found = candidates(*_texts_of(columns))
    return rows.select("_row", F.explode(found).alias("key_lower"))


def _join_keys(hits: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Hits with their dictionary entries. A key with more hits than a task should get is spread over several tasks.

    At most ``HOT_SHARE`` times as many keys as there are shuffle partitions can be that frequent, so the table of them is small.
    """
    counts = hits.groupBy("key_lower").agg(F.count("*").alias("n"))
    found = materialise(dictionary.select("key", "key_lower", "alias").join(counts, "key_lower"), "found_keys")
    total = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    share = max(1, total // (HOT_SHARE * int(hits.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    spread = found.withColumn("salts", F.ceil(F.col("n") / F.lit(share)).cast("int")).drop("n")
    hot = F.broadcast(spread.where("salts > 1").select("key_lower", "salts"))
    salted_hits = hits.join(hot, "key_lower", "left").withColumn(
        "salt", F.pmod(F.xxhash64("_row"), F.coalesce("salts", F.lit(1))).cast("int")
    )
    entries = spread.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    return salted_hits.join(entries, ["key_lower", "salt"]).select("_row", "key", "key_lower", "alias")


def _redact_large(df: DataFrame, dictionary: DataFrame, columns: list[str]) -> DataFrame:
    """Redaction with a dictionary that no task holds whole: the few hits of a row are gathered and joined back to it."""
    # stored, because the row numbers must be the same on both sides of the join
    rows = materialise(df.withColumn("_row", F.monotonically_increasing_id()), "texts")
    hits = (
        _join_keys(materialise(_key_hits(rows, dictionary, columns), "key_hits"), dictionary)
        .groupBy("_row")
        .agg(F.collect_list(F.struct("key", "key_lower", "alias")).alias("_hits"))
        .select("_row", "_hits.key", "_hits.key_lower", "_hits.alias")
        .toDF("_row", "_spellings", "_keys", "_aliases")
    )

    @F.arrow_udf("array<string>")
    def replaced(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for *texts, spellings, keys, aliases in batches:
            for piece in pieces(texts, spellings, keys, aliases):
                out = []
                for *row, s, k, a in zip(*(column.to_pylist() for column in piece)):
                    if k is not None:
                        own, index = dict(zip(k, a)), index_keys([*k, *s])
                        row = [None if t is None else replace_keys(t, own, index) for t in row]
                    out.append(row)
                yield pa.array(out, pa.list_(pa.string()))

    hit_columns = ["_spellings", "_keys", "_aliases"]
    joined = rows.join(hits, "_row", "left")
    redacted = _with_texts(joined, columns, replaced(*[F.col(f"`{c}`") for c in [*columns, *hit_columns]]))
    return redacted.select(*[f"`{c}`" for c in df.columns])
