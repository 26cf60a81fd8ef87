"""Toxicity by a weighted pattern grammar of finite-state transducers.

A lexicon transducer maps each word of a clause to a symbol: INSULT (with a weight; whole words and word stems), THREAT, TARGET, NEGATION, REPORT,
FUTURE or OTHER. Five small transducers read the symbols and are composed by running them in step:

- negation: for three symbols after NEGATION, a match counts ``NEGATED`` of its weight;
- reported speech: after REPORT, to the end of the clause, a match counts ``REPORTED`` of its weight;
- target: near a TARGET (three symbols before or after), a match counts ``TARGETED`` of its weight;
- insult: emits the weight of an INSULT;
- threat: emits ``THREAT_WEIGHT`` for THREAT after FUTURE and before or after TARGET in a clause.

What a document is scored by are its matched clauses: the sum of their weights, the greatest one, and the weight a hundred words.

The weights are learned: words and stems of four to seven letters from a bounded sample of labelled rows (``SAMPLE`` of each label, by hash of the id)
by their log odds, and a logistic regression over the clause features, which are computed with lexicons learned on the other half of the
sample. Rows with the same set of words (copies) count once.

Documents without any lexicon word, most of them, are found by one Aho-Corasick pass and not parsed. Nothing but the sample is shuffled.

Defined cases: a NULL or empty text is scored like one without matches; without labels the general lexicon and fixed weights are used; repeated
rows are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costledger.llm.common import in_batches, shingle_sets, stored

#: Labelled rows of each label to learn from; they and the terms in them are what the driver holds.
SAMPLE = 5000
FOLDS = 2
STEM = (4, 5, 6, 7)
#: A learned term occurs in this many toxic rows at least, and its odds are this many times those of other rows.
LEAST_ROWS, LEAST_ODDS = 3, 8.0
MOST_TERMS = 5000
NEGATED, REPORTED, TARGETED, THREAT_WEIGHT, GENERAL_WEIGHT = 0.25, 0.5, 1.25, 3.0, 1.0
REACH = 3
#: Intercept and weights that hold where nothing can be learned.
FALLBACK = (-3.0, 2.0, 0.5, 0.2)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, FUTURE = range(7)
WORDS = {
    INSULT: "idiot idiots moron morons imbecile stupid loser losers scum scumbag worthless pathetic disgusting trash garbage clown "
    "dumb jerk coward vermin filth bastard idiota imbécil estúpido basura idiote imbécile dégoûtant ordure idioten dummkopf abschaum",
    THREAT: "kill hurt destroy beat burn stab shoot attack crush murder matar töten tuer frapper golpear schlagen",
    TARGET: "you your yours yourself he she they him her them his their this that these those it people tu vous il elle ils ce cette du ihr er sie "
    "dich euch der die das él ella ellos ese esta este",
    NEGATION: "not no never isn't aren't wasn't don't doesn't didn't can't cannot without nicht kein keine nie ne pas jamais nunca sin",
    REPORT: "said says say wrote called calls quoted reported claims claimed according sagte sagt dit disait dijo dice",
    FUTURE: "will gonna shall going must wird werde werden vais va voy vamos i'll we'll",
}

CLAUSES = re.compile(r"[.!?;:\n]+")
TOKENS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


class Grammar:
    """The composed transducers over one lexicon."""

    def __init__(self, terms: dict[str, float]):
        """``terms``: weights of insults; a stem ends with ``*``."""
        import ahocorasick

        self.symbols: dict[str, tuple[int, float]] = {}
        for symbol, words in WORDS.items():
            for word in words.split():
                self.symbols.setdefault(word, (symbol, GENERAL_WEIGHT if symbol == INSULT else 0.0))
        for term, weight in terms.items():
            if not term.endswith("*"):
                self.symbols[term] = (INSULT, weight)
        self.stems = {t[:-1]: w for t, w in terms.items() if t.endswith("*")}
        self.stem_lengths = sorted({len(t) for t in self.stems})
        self.screen = ahocorasick.Automaton()
        for word, (symbol, _) in self.symbols.items():
            if symbol in (INSULT, THREAT):
                self.screen.add_word(word, (len(word), True))
        for stem in self.stems:
            if not (self.screen.exists(stem) and not self.screen.get(stem)[1]):
                self.screen.add_word(stem, (len(stem), False))
        self.screen.make_automaton()

    def symbol(self, word: str) -> tuple[int, float]:
        found = self.symbols.get(word)
        if found:
            return found
        for n in self.stem_lengths:
            weight = self.stems.get(word[:n]) if len(word) >= n else None
            if weight is not None:
                return INSULT, weight
        return OTHER, 0.0

    def matches(self, lower: str) -> bool:
        """Whether any insult or threat occurs as a word or at the start of one."""
        for end, (length, whole) in self.screen.iter(lower):
            start = end - length + 1
            if (start == 0 or not lower[start - 1].isalpha()) and (not whole or end + 1 == len(lower) or not lower[end + 1].isalpha()):
                return True
        return False

    def clause_weight(self, symbols: list[tuple[int, float]]) -> float:
        """Weight of a clause: the transducers run in step over its symbols."""
        total, negated, reported, since_target, future = 0.0, 0, False, REACH + 1, False
        target_at = [i for i, (s, _) in enumerate(symbols) if s == TARGET]
        for i, (symbol, weight) in enumerate(symbols):
            if symbol in (INSULT, THREAT):
                targeted = since_target <= REACH or any(0 < t - i <= REACH for t in target_at)
                if symbol == THREAT:
                    weight = THREAT_WEIGHT if future and target_at else 0.0
                weight *= (TARGETED if targeted else 1.0) * (NEGATED if negated else 1.0) * (REPORTED if reported else 1.0)
                total += weight
            negated = REACH if symbol == NEGATION else max(0, negated - 1)
            since_target = 0 if symbol == TARGET else since_target + 1
            reported = reported or symbol == REPORT
            future = future or symbol == FUTURE
        return total

    def features(self, text: str | None) -> tuple[float, ...]:
        """Of the matched clauses: the sum of their weights (its logarithm), their greatest weight, the weight a hundred words."""
        lower = (text or "").lower()
        if not lower or not self.matches(lower):
            return (0.0,) * 3
        weights, words = [], 0
        for clause in CLAUSES.split(lower):
            symbols = [self.symbol(w) for w in TOKENS.findall(clause)]
            words += len(symbols)
            if any(s in (INSULT, THREAT) for s, _ in symbols):
                weights.append(self.clause_weight(symbols))
        weights = [w for w in weights if w > 0]
        if not weights:
            return (0.0,) * 3
        total = sum(weights)
        return math.log1p(total), max(weights), min(10.0, 100 * total / words)


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """``text``, ``toxic``, ``fold`` of at most ``most`` labelled rows of each label, copies once."""
    one_each = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    parts = [one_each.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for label in (0, 1)]
    # at most 2 * most rows: bounded by the parameter
    rows = docs.select("doc_id", "text").join(F.broadcast(parts[0].union(parts[1])), "doc_id").where("text IS NOT NULL")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            digests = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in shingle_sets(batch.column(1), 1)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, digests], ["doc_id", "text", "toxic", "digest"])

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, text string, toxic int, digest binary"
    found = in_batches(rows.select("doc_id", "text", "toxic"), keyed, schema)
    # of rows with the same words the one with the smallest id, so that reruns learn from the same rows
    first = found.groupBy("digest", "toxic").agg(F.min(F.struct("doc_id", "text")).alias("first"))
    return first.select("first.text", "toxic", F.pmod(F.xxhash64("digest"), F.lit(FOLDS)).cast("int").alias("fold"))


def sample_terms(sample: DataFrame) -> DataFrame:
    """``toxic``, ``fold``, ``terms``: the distinct words and stems of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = []
            for text in batch.column(0).to_pylist():
                words = {w for w in TOKENS.findall(text.lower()) if len(w) > 2}
                terms.append(sorted(words) + sorted({f"{w[:n]}*" for w in words for n in STEM if len(w) >= n}))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(terms, pa.list_(pa.string()))], ["toxic", "fold", "terms"])

    return in_batches(sample.select("text", "toxic", "fold"), run, "toxic int, fold int, terms array<string>")


def cautious_odds(toxic: float, other: float, n_toxic: int, n_other: int) -> float:
    """How many times more frequent a term is in toxic rows, each count moved by its standard error against it."""
    return max(0.0, toxic - math.sqrt(toxic)) / n_toxic / ((other + math.sqrt(other) + 0.5) / n_other)


def choose_terms(counts: list[tuple[str, int, int]], n_toxic: int, n_other: int, most: int = MOST_TERMS) -> dict[str, float]:
    """Terms with their log odds, those that tell most first; of a word and its stems only the first."""
    scored = []
    for term, toxic, other in counts:
        odds = cautious_odds(toxic, other, n_toxic, n_other)
        if toxic >= LEAST_ROWS and odds >= LEAST_ODDS:
            scored.append((toxic * math.log(odds), term, min(6.0, math.log(odds))))
    chosen: dict[str, float] = {}
    beginnings: set[str] = set()  # of the chosen terms
    for _, term, weight in sorted(scored, key=lambda s: (-s[0], -len(s[1]), s[1])):
        word = term.rstrip("*")
        if any(f"{word[:n]}*" in chosen for n in STEM if n <= len(word)) or (term.endswith("*") and word in beginnings):
            continue
        chosen[term] = weight
        beginnings.update(word[:n] for n in range(1, len(word) + 1))
        if len(chosen) == most:
            break
    return chosen


def fit(features: np.ndarray, labels: np.ndarray, rounds: int = 50, ridge: float = 0.1) -> tuple[float, ...]:
    """Logistic regression by Newton's method with a ridge penalty; the first weight is the intercept."""
    x = np.column_stack([np.ones(len(features)), features])
    weights = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (labels - p) - penalty @ weights)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(w) for w in weights)


def learn(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> tuple[dict[str, float], tuple[float, ...]]:
    """Weights of the terms and of the clause features, from a bounded sample of labelled rows."""
    sample = stored(labelled_sample(docs, labels, most), "toxic_sample")
    terms = sample_terms(sample)
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in sample.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    n_of = lambda label, without=-1: sum(n for (fold, toxic), n in sizes.items() if toxic == label and fold != without)
    if not n_of(1) or not n_of(0):
        return {}, FALLBACK
    per_fold = [F.count(F.when((F.col("toxic") == t) & (F.col("fold") == f), 1)).alias(f"n{f}{t}") for f in range(FOLDS) for t in (0, 1)]
    counts = terms.select("fold", "toxic", F.explode("terms").alias("term")).groupBy("term").agg(*per_fold)
    in_toxic = sum(F.col(f"n{f}1") for f in range(FOLDS))
    in_other = sum(F.col(f"n{f}0") for f in range(FOLDS))
    # the terms of a bounded sample that are typical of its toxic rows
    typical = in_toxic / n_of(1) >= LEAST_ODDS * in_other / n_of(0)
    rows = counts.where((in_toxic >= LEAST_ROWS) & typical).orderBy(in_toxic.desc(), "term").limit(20 * MOST_TERMS).collect()

    def lexicon(without: int = -1) -> dict[str, float]:
        folds = [f for f in range(FOLDS) if f != without]
        kept = [(r["term"], sum(r[f"n{f}1"] for f in folds), sum(r[f"n{f}0"] for f in folds)) for r in rows]
        return choose_terms(kept, n_of(1, without), n_of(0, without))

    lexicons = [lexicon(without=f) for f in range(FOLDS)]
    measured = np.array(sample_features(sample, lexicons).collect(), dtype=np.float64)
    weights = fit(measured[:, 1:], measured[:, 0])
    # the sample has as many rows of either label at most; the intercept is set for the labels' own shares
    totals = {r["toxic"]: r["n"] for r in labels.where("doc_id IS NOT NULL").groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    shift = math.log(totals[1] / totals[0]) - math.log(n_of(1) / n_of(0))
    return lexicon(), (weights[0] + shift, *weights[1:])


def sample_features(sample: DataFrame, lexicons: list[dict[str, float]]) -> DataFrame:
    """Label and clause features of the sample's rows, each by the lexicon that was learned without its fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammars = [Grammar(terms) for terms in lexicons]
        for batch in batches:
            rows = [grammars[f].features(t) for t, f in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = [batch.column(1).cast(pa.float64()), *[pa.array([r[i] for r in rows], pa.float64()) for i in range(3)]]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "total", "most", "density"])

    schema = "toxic double, total double, most double, density double"
    return in_batches(sample.select("text", "toxic", "fold"), run, schema)


class Scorer:
    """Scores of texts by a learned model."""

    def __init__(self, model: tuple[dict[str, float], tuple[float, ...]]):
        self.grammar = Grammar(model[0])
        self.weights = np.array(model[1])

    def scores(self, texts: pa.Array) -> np.ndarray:
        found = np.array([self.grammar.features(t) for t in texts.to_pylist()], dtype=np.float64).reshape(-1, len(self.weights) - 1)
        return 1 / (1 + np.exp(-np.clip(self.weights[0] + found @ self.weights[1:], -30, 30)))


def score(docs: DataFrame, model: tuple[dict[str, float], tuple[float, ...]]) -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) of every document; reads ``text`` only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.scores(batch.column(1)), pa.float64())], ["doc_id", "score"])

    return in_batches(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")


def accepted(docs: DataFrame, model: tuple[dict[str, float], tuple[float, ...]], threshold: float = 0.5) -> DataFrame:
    """The documents, with all their columns, whose score is below ``threshold``; texts are not shuffled."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            yield batch.filter(pa.array(scorer.scores(batch.column(at)) < threshold))

    return in_batches(docs, run, docs.schema)
