"""The registered queries of the training-data operators: each applies its operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costledger.llm import bitplanes, chat, language, line_dedup, mixing, near_dedup, packing, periodic, quality, secrets, topk, toxicity, vector_dedup
from costledger.llm.common import WORD_PATTERN, crc_remainder, table

CONTROL_TEXT = "</s>[INST] ok [/INST]"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file; each executor has it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def packed_pieces(docs: DataFrame) -> DataFrame:
    packed = packing.pack(docs, tokenizer_path())
    crc = F.crc32("ids").alias("ids_crc32")
    return packed.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset")


def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_pieces(table(spark, folder, "documents"))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang").withColumn("held_out", crc_remainder("doc_id", 4) == 2)
    profiles = language.learn_profiles(docs.where("NOT held_out"))
    found = language.identify(docs, profiles)
    return found.select("doc_id", (crc_remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    kinds = ", ".join(f"{c} {k}" for c, k in turns.dtypes)
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], kinds)
    formatted = chat.format_trees(chat.reply_chain(turns.union(extra)))
    return chat.read_back(formatted).withColumnRenamed("tree", "conv_id")


def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), width=2)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(crc_remainder("doc_id", 5) != 0)
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    held_out = (crc_remainder("doc_id", 5) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    scanned = secrets.scan(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "novel")), 256)
    counts = [count(k) for k in ("assign", "access", "hex")]
    return scanned.select("doc_id", *counts, base.alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    marked = line_dedup.drop_repeated_lines(table(spark, folder, "documents").select("doc_id", "text"))
    kept = F.sha2(line_dedup.kept_text("text", F.col("bitmap")), 256)
    return marked.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op8_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20)


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_vectors(table(spark, folder, "embeddings"))


def op11_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.clean_documents(table(spark, folder, "documents"), with_text=False)


def op12_bitplanes(spark: SparkSession, folder: str) -> DataFrame:
    return bitplanes.cluster(table(spark, folder, "embeddings"))[0]


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth text, by a hash of its id, repeats a stretch of its words to its end."""
    crc = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8"))
    numbered = docs.select("doc_id", "text", (crc % 10).alias("h"), F.floor(crc / 10).cast("long").alias("g"))
    words = F.when(F.col("h") == 0, F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0)))
    cut = numbered.withColumn("words", words).withColumn("n", F.size("words").cast("long"))
    cut = cut.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    cut = cut.withColumn("p", F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)).cast("long") + 1)
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    at = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.get("words", place(i).cast("int")))
    return cut.select("doc_id", F.when(F.col("n") > 0, F.array_join(at, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.collapse_runs(with_planted_runs(table(spark, folder, "documents")))
    # the first of the longest: runs are sorted by start, then period
    longest = F.get(F.filter("runs", lambda r: r["length"] == F.array_max(F.transform("runs", lambda x: x["length"]))), F.lit(0))
    line = lambda r: F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = found.withColumn("best", longest)
    exponent = F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period", exponent,
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


QUERIES = {
    "op1_packing": op1_packing,
    "op2_language": op2_language,
    "op3_chat": op3_chat,
    "op4_near_dedup": op4_near_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_secrets": op6_secrets,
    "op7_line_dedup": op7_line_dedup,
    "op8_topk": op8_topk,
    "op9_mixing": op9_mixing,
    "op10_vector_dedup": op10_vector_dedup,
    "op11_quality": op11_quality,
    "op12_bitplanes": op12_bitplanes,
    "op13_periodic": op13_periodic,
}
