"""Quality rules, line first: lines that fail a rule go, then documents that lost too much of their text go.

Each line with a word is held against three rules, in this order:

- punctuation: no word ends a sentence, or more symbols than half the words, or doubled marks (``!!``) on more than a quarter of them;
- navigation: entries between separators such as ``|`` (three words or fewer on average), or menu words and nothing else;
- boilerplate: a short line with a stock phrase (cookies, rights, sign up), or one that repeats an earlier line of its text.

A document is kept unless a rule on its whole text fails (``base_failed``: under ``LEAST_WORDS`` words, or more than ``MOST_REPEATED``
percent of them in repeated windows of ``WINDOW`` words) or its removed lines hold more than ``MOST_LOST`` percent of the characters in
words. One scan, one row in and out, no shuffle.

Repeated windows are found exactly: words are numbered in their text, pairs of neighbours are numbered, pairs of pairs, and so on.

Defined cases: a NULL text, an empty one and one without words have zero counts, fail the base and are not kept; lines without words are neither tested
nor removed; repeated rows give a row each; rows without id stay; equal lines: the first stays; very long texts are taken whole; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from costledger.llm.common import in_batches

LEAST_WORDS = 20
WINDOW = 8
MOST_REPEATED = 30
MOST_LOST = 50
#: Words of a line up to which a stock phrase makes it boilerplate; longer lines may well speak about the matter.
SHORT_LINE = 25

SYMBOLS = "#*$%&|<>"
SEPARATORS = frozenset(("|", "||", "»", "«", "›", "‹", "·", "•", ">", ">>", "/", "::", "~", "→", "←"))

# Words of menus, lower case.
MENU_WORDS = frozenset(
    "home menu login logout search sitemap contact about us faq help next previous prev back top share tweet print email rss feed more read "
    "categories tags archive archives startseite kontakt impressum suche anmelden weiter zurück accueil connexion recherche suivant précédent "
    "retour inicio contacto buscar siguiente anterior volver".split()
)

# Stock phrases, lower case.
STOCK_PHRASES = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies", "accept cookies",
    "enable javascript", "javascript is disabled", "sign up for our newsletter", "subscribe to our", "click here", "read more",
    "share this", "powered by", "lorem ipsum", "skip to content", "alle rechte vorbehalten", "datenschutzerklärung", "verwendet cookies",
    "tous droits réservés", "politique de confidentialité", "utilise des cookies", "todos los derechos reservados",
    "política de privacidad", "utiliza cookies",
)

SPACE = "\x20\x09-\x0d"
WORD = re.compile(f"[^{SPACE}]+")
#: A word that ends a sentence, with closing marks behind the stop.
SENTENCE_END = r"[.!?…。！？][\"'”’»)\]]*$"
ENDS = re.compile(SENTENCE_END)
DOUBLED = re.compile(r"[!?]{2}")
SYMBOL = re.compile(f"[{re.escape(SYMBOLS)}]")
STOCK = re.compile("|".join(map(re.escape, STOCK_PHRASES)))
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
RULES = ("punctuation", "navigation", "boilerplate")


def fails_punctuation(line: str, words: list[str]) -> bool:
    if not any(ENDS.search(w) for w in words):
        return True
    return 2 * len(SYMBOL.findall(line)) > len(words) or 4 * len(DOUBLED.findall(line)) > len(words)


def fails_navigation(line: str, words: list[str]) -> bool:
    if not SEPARATORS.isdisjoint(words):
        separators = sum(w in SEPARATORS for w in words)
        if separators >= 2 and len(words) - separators <= 3 * (separators + 1):
            return True
    return all(w.translate(ASCII_LOWER) in MENU_WORDS for w in words)


def fails_boilerplate(line: str, words: list[str]) -> bool:
    return len(words) <= SHORT_LINE and STOCK.search(line.translate(ASCII_LOWER)) is not None


def failed_rule(line: str, words: list[str]) -> str | None:
    """The first rule that a line with words fails by itself."""
    for name, fails in zip(RULES, (fails_punctuation, fails_navigation, fails_boilerplate), strict=True):
        if fails(line, words):
            return name
    return None


def repeated_words(words: list[str]) -> int:
    """Words in windows of ``WINDOW`` words that occur twice or more in the text."""
    if len(words) <= WINDOW:
        return 0
    known: dict[str, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    if len(known) == len(words):
        return 0
    width = 1
    while width < WINDOW:  # numbers of windows twice as wide
        ids = np.unique(ids[:-width] * len(words) + ids[width:], return_inverse=True)[1]
        width *= 2
    repeated = np.bincount(ids)[ids] > 1
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    edges[: len(repeated)] += repeated
    edges[WINDOW : WINDOW + len(repeated)] -= repeated
    return int((np.cumsum(edges) > 0).sum())


def clean(text: str | None) -> dict:
    """Counts, removed lines by rule, what remains, and the verdict for one text."""
    counts = dict.fromkeys(FIELDS, 0)
    all_words: list[str] = []
    seen: set[str] = set()
    kept_lines: list[str] = []
    for line in (text or "").split("\n"):
        words = WORD.findall(line)
        if not words:
            kept_lines.append(line)
            continue
        all_words += words
        chars = sum(map(len, words))
        counts["word_chars"] += chars
        counts["n_lines"] += 1
        rule = failed_rule(line, words)
        if line in seen:
            counts["n_dup_lines"] += 1
            rule = rule or "boilerplate"
        seen.add(line)
        if rule:
            counts[f"removed_{rule}"] += 1
            counts["removed_chars"] += chars
        else:
            kept_lines.append(line)
    counts["n_words"] = n = len(all_words)
    counts["n_symbols"] = len(SYMBOL.findall(text or ""))
    counts["n_repeat_words"] = repeated_words(all_words)
    failed = n < LEAST_WORDS or 100 * counts["n_repeat_words"] > MOST_REPEATED * n
    lost = 100 * counts["removed_chars"] > MOST_LOST * counts["word_chars"]
    return {**counts, "base_failed": failed, "kept": not (failed or lost), "text": "\n".join(kept_lines)}


FIELDS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "removed_punctuation", "removed_navigation", "removed_boilerplate", "removed_chars",
)


def clean_documents(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """``doc_id``, the counts (``FIELDS``), ``base_failed``, ``kept`` and, if wanted, ``text``: the lines that stay."""
    names = [*FIELDS, "base_failed", "kept", *(["text"] if with_text else [])]
    types = {"base_failed": pa.bool_(), "kept": pa.bool_(), "text": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [clean(text) for text in batch.column(1).to_pylist()]
            columns = [pa.array([r[name] for r in rows], types.get(name, pa.int64())) for name in names]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    kinds = {"base_failed": "boolean", "kept": "boolean", "text": "string"}
    schema = ", ".join(f"{name} {kinds.get(name, 'long')}" for name in names)
    return in_batches(docs.select("doc_id", "text"), run, f"doc_id {dict(docs.dtypes)['doc_id']}, {schema}")
