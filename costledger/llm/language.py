"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent letter n-grams (one to three letters, words padded by a blank) in order of frequency. A
document's own list is compared with each profile: the out-of-place distance sums, over the document's n-grams, how far their ranks
differ, and ``PROFILE`` for an n-gram that the profile lacks. The nearest language wins.

Counts are summed in the tasks and by Spark; only the profiles (``PROFILE`` rows a language) pass the driver. Prediction is one scan.

Defined cases: a NULL text or one without letters is ``und`` with score 0, as is every text if nothing could be learned; ties go to the
language first by code point; repeated rows count each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from costledger.llm.common import in_batches

PROFILE = 300
UNDETERMINED = "und"
#: Distinct n-grams that a task holds for all languages before it hands on their counts.
HELD = 2_000_000
SALTS = 16
BLANK, SHIFT = 32, 21


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str | None) -> np.ndarray:
    """All n-grams of a text, each as a number of up to three code points."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    points = np.where(letters()[points], points, BLANK)
    points = np.concatenate(([BLANK], points, [BLANK]))
    blank = points == BLANK
    points = points[~(blank & np.concatenate(([False], blank[:-1])))]  # one blank between words
    if len(points) < 3:
        return np.zeros(0, dtype=np.int64)
    two = (points[:-1] << SHIFT) | points[1:]
    three = (two[:-1] << SHIFT) | points[2:]
    return np.concatenate((points[points != BLANK], two, three[points[1:-1] != BLANK]))


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values = np.sort(values)
    edges = np.flatnonzero(np.concatenate((np.ones(min(1, len(values)), dtype=bool), values[1:] != values[:-1])))
    return values[edges], np.diff(np.concatenate((edges, [len(values)])))


def ranked(values: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, the most frequent first, ties by their number."""
    codes, counts = counted(values)
    if len(codes) > most:
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.argsort(-counts, kind="stable")[:most]]


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``gram``, ``n`` over all documents with a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, (codes, counts) in merged():
                names = pa.array([lang]).take(pa.array(np.zeros(len(codes), dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([names, pa.array(codes), pa.array(counts)], ["lang", "gram", "n"])

        def merged() -> Iterator[tuple[str, tuple[np.ndarray, np.ndarray]]]:
            for lang, parts in held.items():
                codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                yield lang, (codes, np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64))

        for batch in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(grams(text))
            for lang, parts in by_lang.items():
                held.setdefault(lang, []).append(counted(np.concatenate(parts)))
            if sum(len(c) for parts in held.values() for c, _ in parts) > HELD:
                held = {lang: [part] for lang, part in merged()}
                if sum(len(c) for parts in held.values() for c, _ in parts) > HELD // 2:
                    yield from handed_on()
                    held.clear()
        yield from handed_on()

    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    return in_batches(known, run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(docs: DataFrame, most: int = PROFILE) -> dict[str, np.ndarray]:
    """The profile of each value of ``lang``."""
    counts = gram_counts(docs).withColumn("salt", F.pmod(F.xxhash64("gram"), F.lit(SALTS)))
    first = [F.desc("n"), F.asc("gram")]
    # the best of each salt, then of the language: no task sees all n-grams of a language
    part = counts.withColumn("r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*first))).where(F.col("r") <= most)
    best = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*first))).where(F.col("rank") <= most)
    profiles: dict[str, list[tuple[int, int]]] = {}
    for row in best.select("lang", "rank", "gram").collect():
        profiles.setdefault(row["lang"], []).append((row["rank"], row["gram"]))
    return {lang: np.array([g for _, g in sorted(rows)], dtype=np.int64) for lang, rows in sorted(profiles.items())}


class RankOrder:
    """Out-of-place distances of a document's list to all profiles at once."""

    def __init__(self, profiles: dict[str, np.ndarray], most: int = PROFILE):
        self.langs = sorted(profiles, key=lambda lang: lang.encode("utf-8", "surrogatepass"))
        self.most = most
        self.codes = np.unique(np.concatenate([np.zeros(0, dtype=np.int64), *profiles.values()]))
        self.ranks = np.full((len(self.codes) + 1, len(self.langs)), -1, dtype=np.int64)  # the last row: in no profile
        for i, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.codes, profiles[lang]), i] = np.arange(len(profiles[lang]))

    def distances(self, own: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = 0
        at = np.where(self.codes[at] == own, at, len(self.codes))
        ranks = self.ranks[at]
        return np.where(ranks >= 0, np.abs(ranks - np.arange(len(own))[:, None]), self.most).sum(axis=0)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: the runner-up's share of the two smallest distances, from 0.5 (equal) to 1."""
        found = grams(text)
        if not len(found) or not self.langs:
            return UNDETERMINED, 0.0
        distances = self.distances(ranked(found, self.most))
        best = int(distances.argmin())
        if len(distances) == 1:
            return self.langs[0], 1.0
        second = np.partition(distances, 1)[1]
        return self.langs[best], float(second / (distances[best] + second)) if second else 0.5


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], most: int = PROFILE) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` of every document; reads ``text`` only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = RankOrder(profiles, most)
        for batch in batches:
            found = [model.predict(text) for text in batch.column(1).to_pylist()]
            langs, scores = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), langs, scores], ["doc_id", "lang_pred", "score"])

    return in_batches(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double")
