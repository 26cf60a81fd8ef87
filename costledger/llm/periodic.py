"""Periodic runs of words, by longest common extensions over a difference cover.

A run is a maximal stretch of consecutive words with smallest period q (words q apart are equal) and a length of at least
``LEAST_LENGTH`` and ``LEAST_PERIODS`` times q.

``Extensions`` answers how far two positions agree. Positions whose remainder modulo ``MODULUS`` lies in the difference cover ``COVER``
are the samples, 4 of 13; any two positions reach samples after the same few words. Only the suffixes at samples are sorted, by
doubling ranks of 13, 26, 52 ... words; neighbours in that order get their common length from the same ranks, and a sparse table of
minima gives it for any two samples. So an answer is a comparison of at most 12 words and one look into the table.

Runs are found on harmonic grids: for a period q the places 0, q, 2q ... are looked at, n/q of them, n log n for all periods. A run
holds four grid places in a row that hold equal words; only at such places is the extension asked for. Its end is one answer,
its start a binary search over answers. A stretch found with several periods has the smallest one.

Texts are joined in blocks of some ``BLOCK_WORDS`` words with a different separator behind each, so short ones cost no more than long
ones; a text is never cut. No row is shuffled.

Defined cases: a NULL text and one without words have no run and an empty collapsed text; words are told apart by all their bytes;
repeated rows give a row each; rows without id stay; ties between runs (length) go to the smaller start, then the smaller period, as the
runs are sorted so; an empty table gives no rows; other columns are ignored. A very long text is one block: it takes some
100 bytes a word in its task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from costledger.llm.common import in_batches

LEAST_LENGTH, LEAST_PERIODS = 6, 4

#: Every difference modulo 13 is one of two members of the cover.
MODULUS, COVER = 13, (0, 1, 3, 9)

BLOCK_WORDS = 120_000
#: Candidates that are verified together.
CANDIDATES = 100_000

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]


def _distances_to_samples() -> np.ndarray:
    """For remainders r and s: the smallest d for which r + d and s + d both lie in the cover."""
    inside = np.isin(np.arange(MODULUS), COVER)
    shift = np.arange(MODULUS)
    both = inside[(shift[:, None] + shift) % MODULUS]  # remainder, d
    return (both[:, None, :] & both[None, :, :]).argmax(axis=2)


TO_SAMPLES = _distances_to_samples()
PLACE = np.full(MODULUS, -1)
PLACE[list(COVER)] = np.arange(len(COVER))


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, int]:
    distinct, ranks = np.unique(keys, return_inverse=True)
    return ranks.astype(np.int64), len(distinct)


class Extensions:
    """How many words two positions of ``words`` (whole numbers from 1) have in common from there on.

    The answer for a position beyond the end, or past a word that occurs once, is what lies before it.
    """

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.words = np.concatenate((words, np.zeros(2 * MODULUS, dtype=np.int64)))  # 0: behind the end
        blocks = -(-(n + 1) // MODULUS)
        samples = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)).ravel()
        self.samples = samples[samples <= n]
        levels = self._sorted_by_doubling()
        order = np.argsort(levels[-1], kind="stable")
        self.rank = np.empty(len(order), dtype=np.int64)
        self.rank[order] = np.arange(len(order))
        self.minima = self._sparse_table(self._neighbours(order, levels))

    def _sorted_by_doubling(self) -> list[np.ndarray]:
        """Ranks of the samples by their first 13, 26, 52 ... words, until all differ (one more entry for places behind the last sample)."""
        most = int(self.words.max()) + 1
        per_step = max(1, 62 // max(1, most.bit_length()) - 1)
        ranks, distinct = np.zeros(len(self.samples), dtype=np.int64), 1
        at = 0
        while at < MODULUS:
            keys = ranks
            step = min(per_step, MODULUS - at)
            if distinct.bit_length() + step * most.bit_length() > 62:
                step = 1
            for k in range(at, at + step):
                keys = keys * most + self.words[self.samples + k]
            ranks, distinct = _ranks(keys)
            at += step
        levels = [ranks]
        ahead = len(COVER)
        while distinct < len(self.samples):
            later = np.zeros_like(ranks)
            later[:-ahead or None] = ranks[ahead:] + 1  # 0: nothing there
            ranks, distinct = _ranks(ranks * (distinct + 1) + later)
            levels.append(ranks)
            ahead *= 2
        return levels

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common words of each sample and the next one in the order."""
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), dtype=np.int64)
        for level in range(len(levels) - 2, -1, -1):
            ranks = np.append(levels[level], -1)
            last = len(ranks) - 1
            both = (np.maximum(a, b) < last) & (ranks[np.minimum(a, last)] == ranks[np.minimum(b, last)])
            ahead = len(COVER) << level
            a[both] += ahead
            b[both] += ahead
            common[both] += MODULUS << level
        start = self.samples[order]
        return common + self._compare(start[:-1] + common, start[1:] + common, np.full(len(common), MODULUS))[0]

    def _compare(self, i: np.ndarray, j: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equal words in front of the first difference, at most ``words`` of them, and whether there is none."""
        last = len(self.words) - 1
        common = np.zeros(len(i), dtype=np.int64)
        going = np.arange(len(i))
        for k in range(MODULUS):
            going = going[words[going] > k]
            if not len(going):
                break
            one, other = self.words[np.minimum(i[going] + k, last)], self.words[np.minimum(j[going] + k, last)]
            going = going[(one == other) & (one > 0)]
            common[going] += 1
        return common, common == words

    @staticmethod
    def _sparse_table(values: np.ndarray) -> list[np.ndarray]:
        table = [values]
        while 2 << (len(table) - 1) <= len(values):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def _between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest value of neighbours from rank ``low`` up to rank ``high``."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1  # exact: the lengths are far below 2^53
        out = np.empty(len(low), dtype=np.int64)
        for k in np.unique(level):
            at = level == k
            row = self.minima[k]
            out[at] = np.minimum(row[low[at]], row[high[at] - (1 << int(k))])
        return out

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For pairs of different positions: the number of words in common."""
        steps = TO_SAMPLES[i % MODULUS, j % MODULUS]
        found, reached = self._compare(i, j, steps)
        at = np.flatnonzero(reached & (np.maximum(i, j) + steps <= self.samples[-1]))
        p, q = i[at] + steps[at], j[at] + steps[at]
        one = self.rank[p // MODULUS * len(COVER) + PLACE[p % MODULUS]]
        other = self.rank[q // MODULUS * len(COVER) + PLACE[q % MODULUS]]
        found[at] += self._between(np.minimum(one, other), np.maximum(one, other))
        return found


def _verified(extensions: Extensions, grid: np.ndarray, period: np.ndarray) -> Runs:
    """Start, end and period of the stretches around grid places; those of the same period must be in order of their place."""
    end = grid + period + extensions.common(grid, grid + period)
    first = np.ones(len(grid), dtype=bool)  # grid places of one stretch have the same end
    first[1:] = (end[1:] != end[:-1]) | (period[1:] != period[:-1])
    grid, period, end = grid[first], period[first], end[first]
    # the start lies less than a period before the first grid place: the earliest place from which the words agree up to it
    low, high = np.maximum(grid - period + 1, 0), grid.copy()
    while (open_ := low < high).any():
        middle = (low + high) // 2
        agrees = np.zeros(len(low), dtype=bool)
        at = np.flatnonzero(open_)
        agrees[at] = middle[at] + extensions.common(middle[at], middle[at] + period[at]) >= grid[at]
        high = np.where(open_ & agrees, middle, high)
        low = np.where(open_ & ~agrees, middle + 1, low)
    long = end - low >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * period)
    return low[long], end[long], period[long]


def find_runs(words: np.ndarray, longest: np.ndarray | None = None) -> Runs:
    """Start, end and smallest period of all runs, by start, then period; equal words are equal whole numbers from 1.

    ``longest`` bounds, for each place, the length of a run that may begin at it or behind it (a number that never grows).
    """
    n = len(words)
    found: list[Runs] = []
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    extensions: Extensions | None = None

    def verify() -> None:
        nonlocal waiting, extensions
        if waiting:
            extensions = extensions or Extensions(words)
            found.append(_verified(extensions, np.concatenate([g for g, _ in held]), np.concatenate([p for _, p in held])))
            held.clear()
            waiting = 0

    rising = -(np.full(n, n) if longest is None else longest)
    for period in range(1, (-int(rising[0]) if n else 0) // LEAST_PERIODS + 1):
        limit = int(np.searchsorted(rising, -LEAST_PERIODS * period, side="right"))  # behind it a run of this period has no room
        at_grid = words[:limit:period]
        if len(at_grid) < LEAST_PERIODS:
            continue
        equal = at_grid[:-1] == at_grid[1:]
        grid = np.flatnonzero(equal[:-2] & equal[1:-1] & equal[2:])
        if len(grid):
            held.append((grid * period, np.full(len(grid), period)))
            waiting += len(grid)
            if waiting > CANDIDATES:
                verify()
    verify()
    if not found:
        return (np.zeros(0, dtype=np.int64),) * 3
    start, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    # a stretch that has several periods counts with the smallest
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    first = np.ones(len(start), dtype=bool)
    first[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[first], end[first], period[first]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def runs_of_texts(texts: list[list[bytes]]) -> Iterator[tuple[list[tuple[int, int, int]], list[bytes]]]:
    """For each text, a list of words: its runs (start, length, period), and the words that stay.

    A word is dropped if a run holds it after the run's first period.
    """
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))  # longest first: long periods see few texts
    known: dict[bytes, int] = {}
    ids = [known.setdefault(w, len(known) + 1) for k in order for w in texts[k]]
    lengths = np.array([len(texts[k]) for k in order], dtype=np.int64)
    edges = np.concatenate(([0], np.cumsum(lengths + 1)))  # a separator behind each text
    words = np.empty(edges[-1], dtype=np.int64)
    separator = np.zeros(edges[-1], dtype=bool)
    separator[edges[1:] - 1] = True
    words[~separator] = ids
    words[separator] = len(known) + 1 + np.arange(len(texts))
    start, end, period = find_runs(words, np.repeat(lengths, lengths + 1))
    dropped = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, end, -1)
    stays = np.cumsum(dropped[:-1]) == 0
    firsts = np.searchsorted(start, edges)
    out: list = [None] * len(texts)
    for place, k in enumerate(order):
        at, a, b = edges[place], firsts[place], firsts[place + 1]
        if a == b:
            out[k] = ([], texts[k])
            continue
        runs = list(zip((start[a:b] - at).tolist(), (end[a:b] - start[a:b]).tolist(), period[a:b].tolist(), strict=True))
        out[k] = (runs, [w for w, kept in zip(texts[k], stays[at : at + lengths[place]].tolist(), strict=True) if kept])
    yield from out


def _blocks(rows: Iterable[list[bytes]]) -> Iterator[list[list[bytes]]]:
    """Texts in blocks of some ``BLOCK_WORDS`` words."""
    block: list[list[bytes]] = []
    size = 0
    for words in rows:
        if block and size + len(words) > BLOCK_WORDS:
            yield block
            block, size = [], 0
        block.append(words)
        size += len(words) + 1
    if block:
        yield block


def collapse_runs(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (array of start, length, period; by start, then period), ``collapsed`` (words that stay)."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            # bytes.split() parts at the white space of the contracts and at nothing else
            split = ((text or "").encode("utf-8", "surrogatepass").split() for text in batch.column(1).to_pylist())
            done = 0
            for texts in _blocks(split):
                found = list(runs_of_texts(texts))
                columns = [
                    batch.column(0).slice(done, len(texts)),
                    pa.array([len(words) for words in texts], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs, _ in found], pa.list_(item)),
                    pa.array([b" ".join(kept).decode("utf-8", "surrogatepass") for _, kept in found], pa.string()),
                ]
                done += len(texts)
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    schema = f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return in_batches(docs.select("doc_id", "text"), run, schema)
