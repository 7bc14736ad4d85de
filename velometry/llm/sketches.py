"""Document fingerprints: bottom-k sketches of shingle hashes, in DataFrame functions only.

A sketch is the ascending array of the ``k`` least hashes of a text's shingles; a text
with fewer distinct shingles has all of them.  The sketch of a union is the bottom-k of
two sketches, so parts of a text, or documents of a source, merge without being read again.
All hashes up to the lesser of two sketches' ends are a uniform sample of both sets'
union, from which resemblance and containment are estimated; where both sketches hold
everything, they are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velometry.functions.numbering import numbered
from velometry.llm.common import WHITE, stored, text_or_empty

#: Words of a shingle, and hashes of a sketch (a standard error of 0.04 at one half).
WORDS, K = 5, 128
_SPACES = "[" + "".join(f"\\x{ord(c):02x}" for c in sorted(WHITE)) + "]+"


def word_hashes(text: Column) -> Column:
    """The hash of each word, in order; words lie between ASCII white space."""
    words = F.array_remove(F.split(text, _SPACES), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(hashes: Column, words: int = WORDS) -> Column:
    """A hash of each ``words`` consecutive words; fewer words are one shingle.

    ``hashes`` must be a column of its own: each shingle looks into it.
    """
    last = F.greatest(F.size(hashes) - (words - 1), F.lit(1))
    whole = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.xxhash64(*(F.get(hashes, i + (n - 1)) for n in range(words))),
    )
    return F.when(F.size(hashes) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def bottom(hashes: Column, k: int = K) -> Column:
    """The sketch of an array of hashes."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of what two sketches stand for."""
    return bottom(F.concat(a, b), k)


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """How many distinct shingles there are: exact below ``k``, else estimated."""
    share = (F.get(sketch, k - 1).cast("double") + 2.0**63 + 1.0) / 2.0**64
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def _common(a: Column, b: Column, k: int) -> tuple[Column, Column, Column]:
    """How many hashes of ``a``, of ``b`` and of both lie where both are complete."""
    end = F.least(F.get(a, k - 1), F.get(b, k - 1))  # nulls are skipped
    upto = lambda s: F.filter(s, lambda h: end.isNull() | (h <= end))
    own, other = upto(a), upto(b)
    return F.size(own), F.size(other), F.size(F.array_intersect(own, other))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Shared shingles as a share of all in either, 0 to 1; two empty texts are alike."""
    own, other, both = _common(a, b, k)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / (own + other - both))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The share of ``a``'s shingles that are in ``b``, 0 to 1; an empty text is in all.

    Null where none of ``a``'s hashes lies where ``b`` is complete, as when ``a`` is
    far smaller.
    """
    own, _, both = _common(a, b, k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.try_divide(both, own))


def as_text(sketch: Column) -> Column:
    """The sketch as 16 hex digits a hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def with_sketch(df: DataFrame, text: str, out: str, words: int = WORDS, k: int = K) -> DataFrame:
    """``df`` with the sketch of its column ``text`` in ``out``."""
    hashes = df.withColumn("__words", word_hashes(F.col(text)))
    hashes = hashes.withColumn(out, bottom(shingle_hashes(F.col("__words"), words), k))
    return hashes.drop("__words")


_KEY = ["id", "missing", "hash", "check"]


def _keyed(documents: DataFrame) -> DataFrame:
    """``text`` under a key without nulls: the doc_id and 96 bits of hashes of the text."""
    doc_id = F.col("doc_id").cast("long")
    text = text_or_empty().cast("string")
    return documents.select(
        F.coalesce(doc_id, F.lit(0)).alias("id"),
        doc_id.isNull().alias("missing"),
        F.xxhash64(text).alias("hash"),
        F.hash(text).alias("check"),
        text.alias("text"),
    )


def edit_documents(documents: DataFrame, words: int = WORDS, k: int = K) -> DataFrame:
    """Each document's sketch, beside those of its edited text and of the next document.

    ``doc_id, text, edited, copies, sketch, edited_sketch, next_sketch``; in the edited text
    the last half of the code points (rounded down) is replaced by as many first ones
    of the next document.  Documents ascend by doc_id (null first), those of one doc_id by
    a hash of their text; after the last comes the first.  A null text is empty.

    Rows equal in doc_id and text are one document with as many ``copies``.  Other columns
    are not read; an empty table gives no rows.  Texts are dealt out once by their key;
    to the document before goes only the part that it needs.
    """
    keyed = _keyed(documents)
    keys = stored(
        keyed.select(*_KEY, F.length("text").alias("chars"))
        .groupBy(*_KEY)
        .agg(F.max("chars").alias("chars"), F.count(F.lit(1)).alias("copies"))
    )
    order = ["missing_first", "id", "hash", "check"]
    placed = stored(
        numbered(
            keys.withColumn("missing_first", ~F.col("missing")), order, stored, total="total"
        ).drop("missing_first")
    )
    # The place of the next document, and what this one needs of it.
    wanting = placed.select(
        (F.col("position") % F.col("total") + 1).alias("position"),
        *(F.col(c).alias(f"to_{c}") for c in _KEY),
        F.floor(F.col("chars") / 2).cast("int").alias("want"),
        "copies",
    )
    nexts = placed.select(*_KEY, "position").join(wanting, "position").drop("position")
    # Used twice with the same columns, so that the texts are dealt out once.
    one = keyed.groupBy(*_KEY).agg(F.first("text").alias("text"))
    given = with_sketch(one.join(nexts, _KEY), "text", "next_sketch", words, k).select(
        *(F.col(f"to_{c}").alias(c) for c in _KEY),
        F.expr("substring(text, 1, want)").alias("first"),
        "next_sketch",
        "copies",
    )
    kept = F.length("text") - F.floor(F.length("text") / 2).cast("int")
    both = one.join(given, _KEY).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), kept), "first")
    )
    both = with_sketch(with_sketch(both, "text", "sketch", words, k), "edited", "edited_sketch", words, k)
    return both.select(
        F.when(~F.col("missing"), F.col("id")).alias("doc_id"),
        "text", "edited", "copies", "sketch", "edited_sketch", "next_sketch",
    )
