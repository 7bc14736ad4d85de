"""Language identification with bit-sliced Bloom filters of character n-grams.

Each language has a Bloom filter of its n-grams.  The filters lie side by side, one bit
of a word per language (of several words above 64), so a lookup of an n-gram at its few
places gives a mask of all languages that (seem to) have it.  For each text the bits are counted per language, the
expected false positives are taken off, and the largest count decides.

Labelled documents quote other languages.  A language therefore only has the n-grams that
its documents use about as often as those of any other do, not all that occur in some.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velometry.llm.common import slices, texts

#: Letters in an n-gram; a word has a space on both sides.
GRAM = 3
#: Documents per language that the filters are learned from, about; all if there are fewer.
SAMPLE = 2_000
#: N-grams in a language's filter at most: those in the most documents of the sample.
TOP_GRAMS = 4_000
#: A language has an n-gram if its share of documents with it, times this, reaches the
#: largest share of any language.
RIVAL = 4
#: Documents without an n-gram that a share counts besides those of the sample, so that
#: the few of a rare language say little.
EXTRA_DOCUMENTS = 10
#: More languages than this are an error: the filters of 64 take a megabyte.
LANGUAGES = 1024
PLACES = 1 << 17
HASHES = 3
UNKNOWN = "und"

_SPACE = np.uint32(32)
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
#: One number for each place of an n-gram.
_ADDENDS = np.arange(1, HASHES + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class LanguageModel:
    """``table[i // 64, place]`` has bit ``i % 64`` set where the filter of ``languages[i]``
    has that place."""

    languages: tuple[str, ...]
    table: np.ndarray
    false_rates: np.ndarray


class _Letters:
    """Which code points are letters; built once in a process."""

    known: np.ndarray | None = None

    @classmethod
    def mask(cls) -> np.ndarray:
        if cls.known is None:
            points = (chr(i).isalpha() for i in range(0x110000))
            cls.known = np.fromiter(points, bool, 0x110000)
        return cls.known


def _grams(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams of a batch, the text of each, and which texts have letters."""
    joined = "".join(f" {t.lower()} " for t in batch)
    sizes = np.array([len(t.lower()) + 2 for t in batch], np.int64)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _Letters.mask()[points]
    owner = np.repeat(np.arange(len(batch)), sizes)
    lettered = np.bincount(owner[letter], minlength=len(batch)) > 0
    # What is no letter is a space, and of several in a row one is kept.
    points = np.where(letter, points, _SPACE)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[np.cumsum(sizes) - sizes] = True
    points, owner = points[keep], owner[keep]
    n = len(points) - GRAM + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), lettered
    hashes = np.zeros(n, np.uint64)
    for i in range(GRAM):
        hashes = (hashes ^ points[i : i + n]) * _A
        hashes ^= hashes >> np.uint64(29)
    whole = owner[:n] == owner[GRAM - 1 :]
    for i in range(1, GRAM - 1):  # a space only at an edge: inside one word
        whole &= points[i : i + n] != _SPACE
    return hashes[whole], owner[:n][whole], lettered


def _places(hashes: np.ndarray) -> Iterator[np.ndarray]:
    for addend in _ADDENDS:
        # Mixed twice: one product of a sum moves all places of an n-gram by constants,
        # and filters then err as if each n-gram had a single place.
        mixed = (hashes ^ addend) * _A
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _B
        yield ((mixed >> np.uint64(40)) % np.uint64(PLACES)).astype(np.int64)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; a null doc_id is not."""
    third = F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3
    return F.coalesce(third == 1, F.lit(False))


def _sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language, chosen by a hash of the row."""
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (
        labelled.join(F.broadcast(counts.withColumnRenamed("lang", "l")), F.col("lang") == F.col("l"))
        .filter(share * F.col("n") < per_language)
        .select("lang", "text")
    )


def learn(
    labelled: DataFrame,
    per_language: int = SAMPLE,
    top_grams: int = TOP_GRAMS,
    rival: float = RIVAL,
) -> LanguageModel:
    """Filters from the ``doc_id, text, lang`` rows that have a language and a text.

    At most ``LANGUAGES`` languages.  The counts are of documents, made by Spark; the
    driver gets ``top_grams`` hashes per language.  What is ``rival`` times as common in
    the documents of another language is not in a filter.  A repeated row counts as often
    as it is there, where all rows are taken; a sample has either all its copies or none.
    A null doc_id is a value like others.  An empty table gives a model of no language.
    """
    rows = labelled.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    ).filter("lang is not null and text is not null")
    distinct = rows.select("lang").distinct().orderBy("lang").limit(LANGUAGES + 1)
    names = [r.lang for r in distinct.collect()]
    if len(names) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                hashes, owner, _ = _grams(texts(part, "text"))
                langs = part.column("lang").to_pylist()
                for lang in sorted(set(langs)):
                    own = np.array([x == lang for x in langs])[owner]
                    # Once for each document that has it.
                    pairs = np.unique(np.stack([owner[own].astype(np.uint64), hashes[own]]), axis=1)
                    found, n = np.unique(pairs[1], return_counts=True)
                    # A null n-gram counts the documents.
                    columns = [
                        pa.array([lang] * (len(found) + 1), pa.string()),
                        pa.array([*found.view(np.int64).tolist(), None], pa.int64()),
                        pa.array([*n.tolist(), langs.count(lang)], pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    counted = (
        _sample(rows, per_language)
        .mapInArrow(count, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    in_lang, of_gram = Window.partitionBy("lang"), Window.partitionBy("gram")
    sampled = F.max(F.when(F.col("gram").isNull(), F.col("n"))).over(in_lang)
    own = (
        counted.withColumn("share", F.col("n") / (sampled + EXTRA_DOCUMENTS))
        .filter("gram is not null")
        .withColumn("largest", F.max("share").over(of_gram))
        .filter(F.col("share") * rival >= F.col("largest"))
    )
    order = in_lang.orderBy(F.desc("n"), "gram")
    best = own.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top_grams)
    table = np.zeros((-(-len(names) // 64), PLACES), np.uint64)
    number = {lang: i for i, lang in enumerate(names)}
    for lang, gram in best.select("lang", "gram").collect():
        word, bit = divmod(number[lang], 64)
        for place in _places(np.array([gram], np.int64).view(np.uint64)):
            table[word, place] |= np.uint64(1 << bit)
    rates = [(np.count_nonzero(_bit(table, i)) / PLACES) ** HASHES for i in range(len(names))]
    return LanguageModel(tuple(names), table, np.array(rates))


def _bit(words: np.ndarray, language: int) -> np.ndarray:
    """The bits of one language in rows of words."""
    word, bit = divmod(language, 64)
    return (words[word] >> np.uint64(bit) & np.uint64(1)).astype(bool)


def masks_of(hashes: np.ndarray, model: LanguageModel) -> np.ndarray:
    """For each n-gram the languages that (seem to) have it, one row per 64 languages."""
    masks = np.full((len(model.table), len(hashes)), np.uint64((1 << 64) - 1))
    for place in _places(hashes):
        for mask, filters in zip(masks, model.table):
            mask &= filters[place]
    return masks


def identify(batch: list[str], model: LanguageModel) -> tuple[list[str], np.ndarray]:
    """The language and score of each text.

    The score is the part of the text's n-grams that the language has, by the
    corrected count; ``und`` has 0.
    """
    hashes, owner, lettered = _grams(batch)
    masks = masks_of(hashes, model)
    total = np.bincount(owner, minlength=len(batch)).astype(float)
    true = np.zeros((len(model.languages), len(batch)))
    for i, rate in enumerate(model.false_rates):
        seen = np.bincount(owner[_bit(masks, i)], minlength=len(batch))
        true[i] = np.clip((seen - rate * total) / (1 - rate) if rate < 1 else 0, 0, total)
    if not len(model.languages):
        return [UNKNOWN] * len(batch), np.zeros(len(batch))
    best = true.argmax(axis=0)
    score = np.where(lettered, true.max(axis=0) / np.maximum(total, 1), 0.0)
    langs = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
    return langs, score


def predict(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row, from its text alone.

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text under a model of no language.  Ties go to the first language by name.
    Null and repeated doc_ids are predicted row by row, other columns are not read,
    an empty table gives no rows.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                langs, score = identify(texts(part, "text"), sent.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(langs, pa.string()), pa.array(score)],
                    ["doc_id", "lang_pred", "score"],
                )

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, "doc_id bigint, lang_pred string, score double")
