"""A stored reference that grows by loads, with codes that are unique over all of them.

The rows are kept in buckets by a hash of their code, as folders of the table. A load is held against the codes of the buckets that it touches,
and nothing else of them is read; a load with a code that is stored, or that it has twice, is rejected as a whole and names such codes.
Check and store are one commit, so a load that dies leaves nothing, and one that is tried again under its key is stored once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costledger.schemas import REFERENCE
from costledger.sinks import versions

BUCKETS = 32
#: Codes that an error names.
NAMED = 5


def _bucket() -> Column:
    return F.pmod(F.xxhash64("tr_code"), F.lit(BUCKETS)).cast("int")


def _stored(spark: SparkSession, path: str) -> DataFrame:
    return versions.read_table(spark, path, T.StructType([*REFERENCE.fields, T.StructField("bucket", T.IntegerType())]))


def stored_codes(load: DataFrame, path: str) -> DataFrame:
    """``tr_code`` of the rows of a load that is stored already; reads the codes of the buckets that the load touches."""
    codes = load.select("tr_code").where("tr_code IS NOT NULL").distinct()
    touched = [r["bucket"] for r in codes.select(_bucket().alias("bucket")).distinct().collect()]  # at most BUCKETS
    stored = _stored(load.sparkSession, path).where(F.col("bucket").isin(touched)).select("tr_code", "bucket")
    return codes.withColumn("bucket", _bucket()).join(stored, ["bucket", "tr_code"], "left_semi").select("tr_code")


def append_reference(load: DataFrame, path: str, key: str) -> bool:
    """Add a load of prepared reference rows; False if the load ``key`` is stored already, an error if a code would not be unique."""
    spark = load.sparkSession
    if not versions.commits(spark, path).where(F.col("key") == key).isEmpty():
        return False
    repeated = load.where("tr_code IS NOT NULL").groupBy("tr_code").count().where("count > 1").select("tr_code")
    wrong = stored_codes(load, path).union(repeated).distinct().orderBy("tr_code").limit(NAMED).collect()
    if wrong:
        raise ValueError(f"Codes that are not unique: {', '.join(r['tr_code'] for r in wrong)}")
    rows = load.select(*REFERENCE.names).withColumn("bucket", _bucket())
    return versions.append(rows.repartition("bucket"), path, key, ["bucket"])


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    return _stored(spark, path).select(*REFERENCE.names)
