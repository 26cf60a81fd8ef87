"""Secret scans: fixed patterns, and the novelty of strings in sensitive contexts as zstandard measures it.

A candidate is a maximal run of letters, digits and ``+/_=-`` with both letters and digits that has a sensitive word within ``CONTEXT`` characters on
either side, on any line, or in itself; a run that follows a sensitive one after nothing but space, quotes and the like goes on with it (a key over
several lines). Its novelty is the growth of the compressed size when it is put into its surroundings, with a compressor that is primed with a
dictionary of identifiers: names and prose cost few bytes, random keys nearly their full entropy. All runs are blanked out of the surroundings, so a
key costs the same at each place it is written. A run that is not novel as a whole is measured part by part, so a key behind a long name is
found. Candidates that cost at least ``LEAST_RATIO`` bytes a character (``HEX_RATIO`` for hex digits) are reported as ``novel``; what a
pattern's span covers is left out. Spans of the patterns always stay.

Each task reads its texts once; nothing is shuffled. Offsets are code points, ends exclusive.

Defined cases: a NULL or empty text has no spans; repeated rows are scanned each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import DataFrame

from costledger.llm.common import in_batches

KINDS = ("assign", "access", "hex", "novel")
#: The patterns of the contract (fixed values); ASCII letters in either case are written out, so no other letters match.
ASSIGN = re.compile(
    r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGNED, LEAST_ACCESS = 8, 16

SENSITIVE = (
    "password", "passwd", "secret", "token", "api_key", "apikey", "api-key", "credential", "bearer", "private_key", "privatekey", "private key",
    "access_key", "client_id", "authorization", "passphrase", "pwd",
)
#: Words that any code or configuration contains: the compressor knows them before it reads a text.
IDENTIFIERS = " ".join(SENSITIVE) + (
    " https://www.example.com/api/v1/ import export return function class const public static string boolean integer default config"
    " username localhost database connection environment production development version 00000000 11111111 12345678 abcdefgh"
    " ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789abcdef 0123456789ABCDEF"
)
SENSITIVE_WORD = re.compile("|".join(map(re.escape, SENSITIVE)), re.I)
LEAST = 16
RUN = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
#: Between a name and its value, in contrast to the end of a value.
ASSIGNED = re.compile("=+(?=[^=])")
#: What a run that is not novel as a whole is cut at, in this order.
CUTS = (SENSITIVE_WORD, re.compile("/"), re.compile("[+_=-]"))
#: What may lie between the parts of one key.
GOES_ON = re.compile(r"""(?:\\r|[\s"'`\\+,;#*>|]){0,64}""")
HEX_VALUE = re.compile(r"[0-9a-f+/_=-]+|[0-9A-F+/_=-]+")
CONTEXT = 256
#: Hex digits have an entropy of 0.5 bytes a character.
LEAST_RATIO, HEX_RATIO = 0.55, 0.4


class Novelty:
    """Compressed bytes that a string adds to its surroundings."""

    def __init__(self) -> None:
        import zstandard

        known = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=9, dict_data=known, write_content_size=False, write_dict_id=False)

    def size(self, text: str) -> int:
        return len(self.compressor.compress(text.encode("utf-8", "surrogatepass")))

    def marginal(self, text: str, start: int, end: int, around: str | None = None) -> int:
        """``around``: the text that the surroundings are taken from, of the same length."""
        around = text if around is None else around
        before, after = around[max(0, start - CONTEXT) : start], around[end : end + CONTEXT]
        return max(0, self.size(before + after + text[start:end]) - self.size(before + after))


def pattern_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind (its number), start and end of the spans of the fixed patterns, kind by kind."""
    found = []
    lower = text.lower()
    if any(w in lower for w in ("passw", "secret", "token", "api_key", "apikey")):
        found += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def is_candidate(value: str) -> bool:
    return len(value) >= LEAST and bool(re.search("[0-9]", value) and re.search("[A-Za-z]", value))


def gaps(start: int, end: int, taken: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """What the spans ``taken``, by their start, leave of ``start`` to ``end``."""
    left = []
    for s, e in taken:
        if s > start:
            left.append((start, min(s, end)))
        start = max(start, e)
    return [*left, (start, end)] if start < end else left


def sensitive_runs(text: str, words: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs near a sensitive word (``words``: their spans), or that go on with such a run."""
    found: list[tuple[int, int]] = []
    k = 0  # the first word that does not end too far before the run
    for m in RUN.finditer(text):
        start, end = m.span()
        while k < len(words) and words[k][1] < start - CONTEXT:
            k += 1
        near = k < len(words) and words[k][0] <= end + CONTEXT
        if near or (found and GOES_ON.fullmatch(text, found[-1][1], start)):
            found.append((start, end))
    return found


def novel_spans(text: str, novelty: Novelty, covered: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Spans of incompressible strings in a sensitive context that no pattern covers, with their marginal bytes."""
    lower = text.lower()
    if not any(w in lower for w in SENSITIVE):
        return []
    around = RUN.sub(lambda m: " " * len(m.group()) if is_candidate(m.group()) else m.group(), text)
    found: list[tuple[int, int, int, int]] = []

    def measure(start: int, end: int, cuts: tuple[re.Pattern[str], ...]) -> bool:
        value = text[start:end]
        if not is_candidate(value):
            return False
        marginal = novelty.marginal(text, start, end, around)
        if marginal >= (HEX_RATIO if HEX_VALUE.fullmatch(value) else LEAST_RATIO) * len(value):
            found.append((3, start, end, marginal))
            return True
        for k, cut in enumerate(cuts):
            parts = gaps(start, end, [m.span() for m in cut.finditer(text, start, end)])
            if parts != [(start, end)]:
                return any([measure(s, e, cuts[k + 1 :]) for s, e in parts])
        return False

    taken = sorted((s, e) for _, s, e in covered)
    first = 0
    for run_start, run_end in sensitive_runs(text, [m.span() for m in SENSITIVE_WORD.finditer(text)]):
        while first < len(taken) and taken[first][1] <= run_start:
            first += 1
        over = takewhile(lambda span: span[0] < run_end, taken[first:])  # noqa: B023
        for start, end in gaps(run_start, run_end, over):
            sides = gaps(start, end, [m.span() for m in ASSIGNED.finditer(text, start, end)])
            # name=value: the value alone, if it is novel
            if len(sides) == 1 or not any([measure(s, e, CUTS) for s, e in sides]):
                measure(start, end, CUTS)
    return found


def scan(docs: DataFrame) -> DataFrame:
    """Per document ``doc_id`` and ``spans``: kind, start, end and ``marginal`` compressed bytes, by start and kind."""
    kind = dict(docs.dtypes)["doc_id"]
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                base = pattern_spans(text)
                spans = [(k, s, e, novelty.marginal(text, s, e)) for k, s, e in base] + novel_spans(text, novelty, base)
                spans.sort(key=lambda x: (x[1], x[0]))
                rows.append([{"kind": KINDS[k], "start": s, "end": e, "marginal": m} for k, s, e, m in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(span))], ["doc_id", "spans"])

    schema = f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long,marginal:long>>"
    return in_batches(docs.select("doc_id", "text"), run, schema)
