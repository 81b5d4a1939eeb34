"""Importance resampling towards a target distribution, with bit-sliced weights.

A feature is a run of consecutive words, and falls into one of ``BUCKETS`` buckets
by its crc32. One pass over the documents and one over the target count the
features per bucket: each task adds up its own before the shuffle, so the counts
that meet are buckets times tasks, whatever the texts. A bucket's gain is the
logarithm of its share in the target over its share in the documents, a whole number.

The weight of a document is the mean gain of its features. Its bucket counts are
laid out as bit planes, one bit a bucket: plane p holds bit p of each count. The
gains are laid out alike, the positive and the negative ones apart. A count plane
AND a gain plane, its ones counted, gives how often both bits occur together;
these, times powers of two, add up to the exact sum of counts times gains.

The sample holds the highest sums of weight and Gumbel noise from a hash of the
id, which draws without replacement in proportion to exp(weight). Rows are numbered
in sorted ranges, so neither one score nor one id gathers in a task.

Defined cases: NULL and empty texts, and texts without a word, have no features and
weight 0; a NULL id counts as an empty one in the noise and sorts first; equal
scores go to the smaller id, then to the smaller row; repeated rows get a place
each; an empty target still has gains (of empty buckets); an empty table gives no
rows; the columns named to be kept come through unchanged.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.common import Computed, table, with_computed
from cohortry.operators.ranking import number_rows
from cohortry.session import checkpointed

BUCKETS = 10_000
RUN_WORDS = 1
GAIN_UNITS = 1000
LEAST_WORDS = 20
DRAWN_PERCENT = 10
SEED = "2024"
HASH_DIGITS = 8
MOST_WORDS = 1_000_000
# Documents laid out together; their planes stay in a core's cache.
BLOCK = 32
WORD_BITS = 64

# Letters and digits of ASCII, in lower case, and all bytes of other characters; the rest separates words.
FOLDED = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else ord(" ") for b in range(256))


class Buckets(dict):
    """Remembers the bucket of each feature; starts afresh when it holds ``MOST_WORDS``."""

    def __init__(self, count: int) -> None:
        super().__init__()
        self.count = count

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        value = self[feature] = zlib.crc32(feature) % self.count
        return value

    def of(self, text: str | None, longest: int) -> tuple[int, np.ndarray]:
        """The number of words of a text, and the bucket of every run of 1 to ``longest`` of them, repeats included."""
        words = (text or "").encode("utf-8", "surrogatepass").translate(FOLDED).split()
        parts = [np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))]
        for length in range(2, longest + 1):
            runs = [b" ".join(words[i : i + length]) for i in range(len(words) - length + 1)]
            parts.append(np.fromiter(map(self.__getitem__, runs), dtype=np.int64, count=len(runs)))
        return len(words), np.concatenate(parts)


def texts_of(batch: pa.RecordBatch, rows: int = BLOCK) -> Iterator[list[str | None]]:
    """The texts of a batch, few at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.column(0).slice(at, rows).to_pylist()


def bucket_counts(rows: DataFrame, text: str = "text", longest: int = RUN_WORDS, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all texts fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, total = Buckets(buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for texts in texts_of(batch):
                for t in texts:
                    total += np.bincount(place.of(t, longest)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    partial = rows.select(F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    return partial.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(given: dict[int, int], wanted: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket, floor(1000 ln((t+1)(S+buckets) / ((s+1)(T+buckets)))), in doubles."""
    have, want = sum(given.values()), sum(wanted.values())
    return np.array(
        [
            math.floor(
                GAIN_UNITS
                * math.log(
                    float(wanted.get(b, 0) + 1) * float(have + buckets)
                    / (float(given.get(b, 0) + 1) * float(want + buckets))
                )
            )
            for b in range(buckets)
        ],
        dtype=np.int64,
    )


def planes(sizes: np.ndarray) -> np.ndarray:
    """Bit planes of whole numbers: (bits, rows, words of 64 buckets) from (rows, buckets)."""
    rows, buckets = sizes.shape
    bits = max(int(sizes.max(initial=0)).bit_length(), 1)
    words = -(-buckets // WORD_BITS)
    out = np.zeros((bits, rows, words * WORD_BITS // 8), dtype=np.uint8)
    for p in range(bits):
        packed = np.packbits((sizes >> p) & 1 != 0, axis=1, bitorder="little")
        out[p, :, : packed.shape[1]] = packed
    return out.view(np.uint64)


def signed_planes(gain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(planes, factors): the bit planes of positive and of negative gains, each with its signed power of two."""
    found, factors = [], []
    for sign in (1, -1):
        sliced = planes(np.maximum(sign * gain, 0)[None, :])[:, 0]
        found.append(sliced)
        factors += [sign * 2**q for q in range(len(sliced))]
    return np.concatenate(found), np.array(factors, dtype=np.int64)


def weighed_sums(counts: np.ndarray, gain_planes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Sum of count times gain for each row of (rows, buckets), by planes, AND and the number of ones."""
    total = np.zeros(len(counts), dtype=np.int64)
    for p, plane in enumerate(planes(counts)):
        both = np.bitwise_count(plane[:, None, :] & gain_planes[None, :, :]).sum(axis=2, dtype=np.int64)
        total += (both @ factors) << p
    return total


def weighed(
    docs: DataFrame, gain: np.ndarray, keep: Sequence[str], text: str = "text", longest: int = RUN_WORDS
) -> DataFrame:
    """The columns ``keep`` of ``docs`` with n_words, n_features and weight (the mean gain, rounded down)."""
    shared = docs.sparkSession.sparkContext.broadcast(signed_planes(gain))
    buckets = len(gain)

    def make():
        place, (gain_planes, factors) = Buckets(buckets), shared.value

        def compute(batch: list[str | None]) -> Computed:
            out: Computed = {"n_words": [], "n_features": [], "weight": []}
            for at in range(0, len(batch), BLOCK):
                words, found = zip(*(place.of(t, longest) for t in batch[at : at + BLOCK]), strict=True)
                sizes = np.array([len(f) for f in found], dtype=np.int64)
                flat = np.concatenate(found) + np.repeat(np.arange(len(found)) * buckets, sizes)
                counts = np.bincount(flat, minlength=len(found) * buckets).reshape(-1, buckets)
                sums = weighed_sums(counts, gain_planes, factors)
                out["n_words"] += words
                out["n_features"] += sizes.tolist()
                out["weight"] += np.floor_divide(sums, np.maximum(sizes, 1)).tolist()
            return out

        return compute

    given = docs.withColumn(text, F.col(f"`{text}`").cast("string")) if dict(docs.dtypes)[text] != "string" else docs
    return with_computed(given, keep, text, "n_words long, n_features long, weight long", make)


def noisy(weight: Column, doc_id: Column, seed: str = SEED) -> Column:
    """The weight and Gumbel noise from a hash of the id, in the same whole units."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, HASH_DIGITS), 16, 10).cast("double")
    draw = (h + 0.5) / F.lit(float(16**HASH_DIGITS))
    return weight + F.floor(-F.lit(float(GAIN_UNITS)) * F.log(-F.log(draw)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = DRAWN_PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = RUN_WORDS,
    buckets: int = BUCKETS,
    seed: str = SEED,
    text: str = "text",
    target_text: str = "text",
    doc_id: str = "doc_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """doc_id, ``keep``, n_features, weight, score and rank (NULL: not drawn) for each row of ``docs``.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred are drawn.
    """
    given, wanted = (
        {r["bucket"]: r["n"] for r in bucket_counts(rows, column, longest, buckets).collect()}
        for rows, column in ((docs, text), (target, target_text))
    )
    columns = list(dict.fromkeys([doc_id, *keep]))
    scored = checkpointed(
        weighed(docs, gains(given, wanted, buckets), columns, text, longest).withColumn(
            "score", noisy(F.col("weight"), F.col(f"`{doc_id}`"), seed)
        )
    )
    able = F.col("n_words") >= least_words
    n = scored.filter(able).count() * percent // 100
    ordered = scored.withColumns({"_out": (~able).cast("int"), "_down": -F.col("score")})
    ranked = number_rows(ordered, ["_out", "_down", doc_id, "n_features", "weight"], "_place")
    return ranked.withColumn("rank", F.when(F.col("_place") <= n, F.col("_place"))).select(
        *(f"`{c}`" for c in columns), "n_features", "weight", "score", "rank"
    )


def drawn(docs: DataFrame, ranked: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id was drawn."""
    ids = ranked.filter(F.col("rank").isNotNull()).select(F.col(doc_id).alias("_drawn")).distinct()
    return docs.join(ids, F.col(f"`{doc_id}`").eqNullSafe(F.col("_drawn")), "left_semi")


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's weight and score towards the benchmark, and the places of the drawn ones."""
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return resample(documents, table(spark, folder, "benchmark").select("text"))
