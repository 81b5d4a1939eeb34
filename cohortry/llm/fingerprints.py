"""Bottom-k sketches of word shingles, in DataFrame functions only.

A fingerprint is the ``k`` smallest distinct hashes of a document's shingles
(five words; a shorter text is one shingle of all its words). Sketches of parts
merge into the sketch of the whole, and two sketches give estimates of
resemblance, containment and the distinct shingle count. A sketch with fewer
than ``k`` hashes holds the full set, and its estimates are exact.

Defined cases: a NULL text counts as empty; an empty text has the empty
fingerprint; two empty fingerprints resemble each other fully, an empty one and
another not at all; repeated rows are fingerprinted alike; an empty table gives
no rows; only the named columns are read.

The next document is that of the next larger id (NULL first, and the first
after the last). Where rows repeat an id, the text with the smallest hash
stands for it as somebody's next document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.llm.common import table, whole, words_of
from cohortry.operators.ranking import number_rows
from cohortry.session import checkpointed

SKETCH_SIZE = 128
SHINGLE_WORDS = 5
IDS_PER_RANGE = 100_000
NO_ID = -(2**63)


def shingle_hashes(w: Column, words: int = SHINGLE_WORDS) -> Column:
    """Hashes of all shingles of an array of words, repeats included.

    ``w`` must be a plain column: the lambda reads it once per shingle.
    """
    # Past the last word, get() gives NULL, which the hash skips.
    return F.transform(
        F.slice(w, 1, F.when(F.size(w) == 0, 0).otherwise(F.greatest(F.size(w) - (words - 1), F.lit(1)))),
        lambda first, i: F.xxhash64(first, *(F.get(w, i + j) for j in range(1, words))),
    )


def with_sketch(
    rows: DataFrame, text: str, name: str, k: int = SKETCH_SIZE, words: int = SHINGLE_WORDS
) -> DataFrame:
    """Add the fingerprint of ``text`` as an ascending array of hashes."""
    return (
        rows.withColumn("_words", words_of(F.col(text)))
        .withColumn("_hashes", F.array_distinct(shingle_hashes(F.col("_words"), words)))
        .withColumn(name, F.slice(F.sort_array("_hashes"), 1, k))
        .drop("_words", "_hashes")
    )


def merged(left: Column, right: Column, k: int = SKETCH_SIZE) -> Column:
    """The sketch of the union of what two sketches stand for."""
    return F.slice(F.sort_array(F.array_union(left, right)), 1, k)


def compared(left: Column, right: Column, k: int = SKETCH_SIZE) -> Column:
    """The smallest hashes of the union on which two sketches can be compared; all if both are full sets."""
    known = F.when((F.size(left) < k) & (F.size(right) < k), 2 * k).otherwise(k)
    return F.slice(F.sort_array(F.array_union(left, right)), F.lit(1), known)


def merge_groups(sketches: DataFrame, keys: list[str], column: str, k: int = SKETCH_SIZE) -> DataFrame:
    """One merged sketch per key; a group of any size reaches a task as its ``k`` best rows only."""
    hashes = sketches.select(*keys, F.explode(column).alias("_h")).distinct()
    best = hashes.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy("_h")))
    return best.filter(F.col("_r") <= k).groupBy(*keys).agg(F.sort_array(F.collect_list("_h")).alias(column))


def resemblance(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated size of the intersection over that of the union, 0 to 1."""
    return _share(compared(a, b, k), a, b)


def _share(union: Column, a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.greatest(F.size(union), F.lit(1)))


def distinct_count(a: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated number of distinct shingles."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / share)


def containment(a: Column, b: Column, k: int = SKETCH_SIZE) -> Column:
    """Estimated share of the shingles of ``a`` that are in ``b``, 0 to 1."""
    inside = resemblance(a, b, k) * distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), inside / distinct_count(a, k)))


def as_text(hashes: Column) -> Column:
    """A sketch as hexadecimal text, 16 digits per hash."""
    return F.array_join(F.transform(hashes, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def neighbours(docs: DataFrame) -> DataFrame:
    """Rows (key, body) to distinct keys with their next and previous key.

    Only ids, lengths and hashes are moved here. ``stands`` is the hash of the
    text that stands for the id, ``before_chars`` the longest text before it.
    """
    ids = docs.groupBy("key").agg(
        F.max(F.char_length("body")).alias("chars"), F.min(F.xxhash64("body")).alias("stands"), F.count(F.lit(1)).alias("rows")
    )
    ids = checkpointed(ids)
    total = ids.count()
    numbered = number_rows(ids, ["key"], "rn", partitions=max(1, -(-total // IDS_PER_RANGE)))
    numbered = checkpointed(numbered)
    follows = numbered.select(
        F.col("key").alias("before_key"), F.col("chars").alias("before_chars"),
        (F.col("rn") % F.lit(max(1, total)) + 1).alias("rn"),
    )
    return numbered.join(follows, "rn").select("key", "stands", "before_key", "before_chars")


def fingerprint_documents(
    docs: DataFrame, k: int = SKETCH_SIZE, words: int = SHINGLE_WORDS, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text is the text with its last quarter replaced by as much of the
    beginning of the next document. The texts are shuffled once, by id; from
    there each document sends only the beginning that its predecessor needs.
    """
    body = whole(F.col(text))
    # Rows without an id take the place before all others. The two sides below read the same
    # columns, so that the texts are shuffled once for both.
    rows = docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)).alias("key"), body.alias("body"))
    links = neighbours(rows)
    # Documents as somebody's next: a beginning and the fingerprint, sent to the id before.
    standing = (
        rows.join(links, "key")
        # Not written as an equality, which would become a second join key and a second shuffle.
        .filter(F.array_contains(F.array("stands"), F.xxhash64("body")))
        .withColumn("next_start", F.expr("substring(body, 1, cast(before_chars div 4 as int))"))
    )
    beginnings = (
        with_sketch(standing, "body", "next_sketch", k, words)
        .select(F.col("before_key").alias("key"), "next_start", "next_sketch")
        .groupBy("key")
        .agg(F.first("next_start").alias("next_start"), F.first("next_sketch").alias("next_sketch"))
    )
    paired = rows.join(beginnings, "key").withColumn("n_chars", F.char_length("body"))
    quarter = F.expr("n_chars div 4").cast("int")
    edited = F.concat(
        F.substring("body", F.lit(1), F.col("n_chars") - quarter), F.substring("next_start", F.lit(1), quarter)
    )
    paired = with_sketch(with_sketch(paired.withColumn("edited", edited), "body", "own", k, words), "edited", "changed", k, words)
    near = paired.select(
        F.nullif(F.col("key"), F.lit(NO_ID)).alias("doc_id"), F.col("n_chars").cast("bigint").alias("n_chars"),
        "own", "changed", "next_sketch",
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        compared(F.col("own"), F.col("changed"), k).alias("union_edited"),
        compared(F.col("own"), F.col("next_sketch"), k).alias("union_next"),
    )
    return near.select(
        "doc_id", "n_chars", "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        _share(F.col("union_edited"), F.col("own"), F.col("changed")).alias("near_edited"),
        _share(F.col("union_next"), F.col("own"), F.col("next_sketch")).alias("near_next"),
        distinct_count(F.col("own"), k).alias("shingles_estimate"),
    )


def op4_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_documents(table(spark, folder, "documents"))
