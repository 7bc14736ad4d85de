"""Quality rules on repetition inside a document, from a suffix array of its words.

Many documents are sorted at once: a word counts together with its document, so
suffixes of different documents never agree.  Ranks of the first 1, 2, 4, ... words
(prefix doubling, only where still tied) give the array, and the same ranks give
the common prefix of neighbours.  Every suffix lies in nested common-prefix
intervals; the deepest is the longer of the prefixes that it shares with its two
neighbours, and is the longest repeated substring that begins there.  The union
of these spans is the union of all maximal repeats.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velometry.llm.common import WHITE, slices, texts

SYMBOLS = "#*$%&|<>"
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class RepetitionRules:
    """A text fails if its repeats of ``least_words`` or more cover too much of it, or one is
    longer than ``longest_words``; and by the plain limits on size and 5-word windows.

    Words in repeats of 8 also are in repeats of 5, so only a limit below ``window_percent``
    rejects more than the plain one.  12 % is the limit for 8-word windows in the rules of
    Gopher (Rae et al. 2021), which count characters where these count words.
    """

    fewest_words: int = 10
    window_words: int = 5
    window_percent: int = 20
    least_words: int = 8
    covered_percent: int = 12
    longest_words: int = 60


def _ranks(key: np.ndarray, rest: np.ndarray) -> list[np.ndarray]:
    """Ranks by the first 1, 2, 4, ... items of each suffix, until no two are equal.

    ``rest`` counts the items from each position to the end of its document.
    """
    n = len(key)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    index = np.arange(n)
    fresh = np.ones(n, bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    first = np.maximum.accumulate(np.where(fresh, index, 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    levels = [rank.astype(np.int32 if n < 1 << 31 else np.int64)]
    tied = ~fresh
    tied[:-1] |= ~fresh[1:]
    active, step = order[tied], 1
    while len(active):
        beyond = rest[active] <= step
        second = np.where(beyond, -1, rank[np.where(beyond, 0, active + step)])
        own = rank[active]
        pair = own * (n + 1) + second + 1
        order = np.argsort(pair, kind="stable")
        active, pair, own = active[order], pair[order], own[order]
        index = np.arange(len(active))
        fresh_own = np.ones(len(active), bool)
        fresh_own[1:] = own[1:] != own[:-1]
        slot = own + index - np.maximum.accumulate(np.where(fresh_own, index, 0))
        fresh = np.ones(len(active), bool)
        fresh[1:] = pair[1:] != pair[:-1]
        rank[active] = slot[np.maximum.accumulate(np.where(fresh, index, 0))]
        levels.append(rank.astype(levels[0].dtype))
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        active, step = active[tied], step * 2
    return levels


def longest_repeats(key: np.ndarray, rest: np.ndarray, least: int) -> np.ndarray:
    """For each position the length of the longest repeat that begins there, 0 below ``least``."""
    n = len(key)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    levels = _ranks(key, rest)
    suffixes = np.empty(n, np.int64)
    suffixes[levels[-1]] = np.arange(n)
    a, b = suffixes[:-1], suffixes[1:]
    # Neighbours that agree in fewer words than a level below ``least`` need no more work.
    enough = min(len(levels) - 1, int(least).bit_length() - 1)
    near = levels[enough][a] == levels[enough][b]
    a, b = a[near], b[near]
    shared = np.zeros(len(a), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank, step = levels[level], 1 << level
        x, y = a + shared, b + shared
        inside = (rest[a] > shared) & (rest[b] > shared)
        x, y = np.where(inside, x, 0), np.where(inside, y, 0)
        shared += np.where(inside & (rank[x] == rank[y]), step, 0)
    shared[shared < least] = 0
    np.maximum.at(best, a, shared)
    np.maximum.at(best, b, shared)
    return best


def covered(best: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in a repeat of at least ``least``."""
    starts = np.flatnonzero(best >= least)
    change = np.zeros(len(best) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + best[starts], -1)
    return np.cumsum(change[:-1]) > 0


def measure(batch: list[str], rules: RepetitionRules) -> dict[str, np.ndarray]:
    """The figures of each text."""
    words = [t.encode("utf-8", "surrogatepass").split() for t in batch]
    counts = np.array([len(w) for w in words], np.int64)
    n = int(counts.sum())
    key = np.fromiter((xxhash.xxh64_intdigest(w) for ws in words for w in ws), np.uint64, n)
    del words
    doc = np.repeat(np.arange(len(batch)), counts)
    key += doc.astype(np.uint64) * _SPREAD
    rest = np.repeat(np.cumsum(counts), counts) - np.arange(n)
    best = longest_repeats(key, rest, min(rules.window_words, rules.least_words))

    def per_doc(mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc[mask], minlength=len(batch)).astype(np.int64)

    longest = np.zeros(len(batch), np.int64)
    np.maximum.at(longest, doc, best)
    repeat = per_doc(covered(best, rules.window_words))
    spans = per_doc(covered(best, rules.least_words))
    failed = (counts < rules.fewest_words) | (100 * repeat > rules.window_percent * counts)
    passed = (100 * spans <= rules.covered_percent * counts) & (longest <= rules.longest_words)
    return {
        "n_words": counts,
        "word_chars": np.array([len(t) - sum(map(t.count, WHITE)) for t in batch], np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in batch], np.int64),
        "n_dup_lines": np.array([_duplicate_lines(t) for t in batch], np.int64),
        "n_repeat_words": repeat,
        "n_covered_words": spans,
        "longest_repeat": longest,
        "base_failed": failed,
        "kept": ~failed & passed,
    }


def _duplicate_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return len(lines) - len(set(lines))


_FIGURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_covered_words bigint, longest_repeat bigint, "
    "base_failed boolean, kept boolean"
)


def judge_documents(
    documents: DataFrame, rules: RepetitionRules = RepetitionRules()
) -> DataFrame:
    """One row per document: ``doc_id``, its figures and whether it is kept.

    A null text has no words, so it fails.  Null and repeated doc_ids are judged
    row by row, other columns are not read, an empty table gives no rows.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                figures = measure(texts(part, "text"), rules)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, figures.values())],
                    ["doc_id", *figures],
                )

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(judge, f"doc_id bigint, {_FIGURES}")


def keep_good(documents: DataFrame, rules: RepetitionRules = RepetitionRules()) -> DataFrame:
    """The rows of ``documents`` that pass, unchanged, with all their columns."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                yield part.filter(pa.array(measure(texts(part, "text"), rules)["kept"]))

    return documents.mapInArrow(keep, documents.schema)
