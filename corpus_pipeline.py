"""Training corpus in five stages, each written as Parquet and read again as the next one's documents.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
``documents``:

1. toxicity: learned from the labelled rows; documents with a score of 0.5 or more go;
2. line deduplication: lines found in ten documents or more go, documents stay;
3. near-duplicates (five-word shingles, similarity 0.8): one document of each group stays;
4. mixing of sources to target weights: documents are left out, or repeated, by hash thresholds;
5. packing into windows of 2048 tokens; a row per piece.

``ORACLE_SQL`` is None, as SQL cannot express the first stage; the tests compare the pipeline with a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from costledger.llm import line_dedup, mixing, near_dedup, packing, toxicity
from costledger.llm.common import crc_remainder, stored, table
from costledger.llm.queries import packed_pieces


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(crc_remainder("doc_id", 5) != 0)
    return toxicity.accepted(docs, toxicity.learn(docs, labels))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_lines(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed_pieces(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", without_near_copies),
    ("mixing", mixed),
    ("packing", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
