"""Removal of repeated passages with sharded Aho-Corasick automata.

A window is 35 consecutive words. Words covered by a window whose word sequence
also starts elsewhere go. The steps:

1. One scan marks each window by the smallest hash among its eight-word phrases,
   so equal windows share their marked phrase. Equal texts are merged into
   classes with a count. Phrases marked once only cannot belong to a repeat.
2. The texts that hold a repeated phrase are written once. For each place of such
   a phrase the hashes of the windows it marks are counted over the corpus; those
   that occur twice or more are the confirmed passages.
3. The phrases of confirmed passages are dealt to shards, together with the
   phrases that first occur in the same text, and each shard becomes an automaton.
   Each text is streamed through the automata of the shards whose phrases it
   holds. Every hit is checked against the confirmed windows around it.
4. The covered words are dropped, in texts that have any.

A shard with many texts is split over tasks that build the same automaton; one
with many confirmed windows is split by window, and its texts go to each part.

A text of several rows is repeated as a whole and loses all its words (if it has
35 at least), so it needs no search, but its windows count for all other texts.

Defined cases: NULL, empty and short texts lose nothing; a text may repeat within
itself; repeated rows and rows that share an id are separate documents; rows
without an id are documents, too; an empty table gives no rows; extra columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.common import Computed, table, whole, with_computed
from cohortry.llm.shingles import WordHashes, run_hashes, word_list
from cohortry.session import checkpointed

WINDOW = 35
PHRASE = 8
PHRASES_PER_SHARD = 20_000
# A text's words are taken by its bytes, whatever parts them.
BYTES_PER_WORD = 6
WORDS_PER_TASK = 1_000_000
WINDOWS_PER_PART = 1_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
BLOCK = 65_536
PLACES_AT_ONCE = 100_000


def window_hashes(words: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """A hash for each window, from running sums of word hashes times powers of an odd base."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    ones = np.ones(len(words), dtype=np.uint64)
    ones[1:] = BASE
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(words * np.multiply.accumulate(ones))])
    back = np.ones(n, dtype=np.uint64)
    back[1:] = BASE_INVERSE
    values = (sums[size:] - sums[:-size]) * np.multiply.accumulate(back)
    return values ^ (values >> np.uint64(32))


def marks(phrases: np.ndarray, window: int = WINDOW, phrase: int = PHRASE) -> np.ndarray:
    """For each window the place of its smallest phrase hash; the last of equal ones."""
    width = window - phrase + 1
    n = len(phrases) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    out = np.empty(n, dtype=np.int64)
    for at in range(0, n, BLOCK):
        part = phrases[at : at + BLOCK + width - 1]
        views = np.lib.stride_tricks.sliding_window_view(part, width)[:, ::-1]
        out[at : at + len(views)] = np.arange(at, at + len(views)) + (width - 1) - views.argmin(axis=1)
    return out


def text_key(text: str) -> list[Column]:
    """Two hashes with different seeds name a text."""
    body = whole(F.col(text))
    return [F.xxhash64(body).alias("k1"), F.xxhash64(F.lit(9), body).alias("k2")]


def sha256_of(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def scanned(docs: DataFrame, text: str, doc_id: str, window: int) -> DataFrame:
    """doc_id, k1, k2, n_words, whole_sha256, phrases (hash of each marked place) per row."""

    def make():
        hashes = WordHashes()

        def compute(batch: list[str | None]) -> Computed:
            out: Computed = {"n_words": [], "whole_sha256": [], "phrases": []}
            for t in batch:
                words = word_list(t, lower=False)
                out["n_words"].append(len(words))
                out["whole_sha256"].append(sha256_of(words))
                if len(words) < window:
                    out["phrases"].append([])
                    continue
                phrases = run_hashes(hashes.of(words), PHRASE)
                out["phrases"].append(phrases[np.unique(marks(phrases, window))].view(np.int64))
            return out

        return compute

    named = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), *text_key(text))
    fields = "n_words long, whole_sha256 string, phrases array<long>"
    return with_computed(named, ["doc_id", "k1", "k2"], "text", fields, make)


def texts_of(docs: DataFrame, wanted: DataFrame, text: str, doc_id: str) -> DataFrame:
    """``wanted`` (rep, k1, k2, ...) with the text of its class."""
    key = text_key(text)[0].alias("_k1")
    texts = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.col(text).alias("text"), key)
    joined = texts.join(wanted, F.col("_id").eqNullSafe(F.col("rep")))
    # A repeated id may also name another text.
    same = joined.filter(F.col("_k1") == F.col("k1"))
    return same.drop("_id", "_k1", "rep", "k1", "k2").dropDuplicates(["cid"])


def places(held: DataFrame, window: int) -> DataFrame:
    """(phrase, words, windows, single, n): the places of repeated phrases, equal ones of a task counted together.

    ``held``: cid, n, text, phrases (the repeated ones the text holds). ``n`` counts
    rows; ``words`` is given once per phrase and task; ``single`` says whether a
    class of one row has the place.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        found: dict[tuple[int, bytes, bool], int] = {}
        spelled: dict[int, str] = {}

        def flushed() -> pd.DataFrame:
            keys = list(found)
            frame = pd.DataFrame(
                {
                    "phrase": [k[0] for k in keys], "words": [spelled.pop(k[0], None) for k in keys],
                    "windows": [np.frombuffer(k[1], dtype=np.int64) for k in keys],
                    "single": [k[2] for k in keys], "n": [found[k] for k in keys],
                }
            )
            found.clear()
            spelled.clear()
            return frame

        for batch in batches:
            for t, repeated, n in zip(batch["text"], batch["phrases"], batch["n"], strict=True):
                words = word_list(t, lower=False)
                h = hashes.of(words)
                phrases = run_hashes(h, PHRASE)
                marked = marks(phrases, window)
                windows = window_hashes(h, window).view(np.int64)
                at, first = np.unique(marked, return_index=True)
                last = np.append(first[1:], len(marked))
                hit = np.isin(phrases[at].view(np.int64), np.asarray(repeated, dtype=np.int64))
                for p, a, b in zip(at[hit].tolist(), first[hit].tolist(), last[hit].tolist(), strict=True):
                    phrase = int(phrases[p].view(np.int64))
                    key = (phrase, windows[a:b].tobytes(), n == 1)
                    found[key] = found.get(key, 0) + n
                    if phrase not in spelled:
                        spelled[phrase] = b" ".join(words[p : p + PHRASE]).decode("utf-8", "surrogatepass")
                if len(found) > PLACES_AT_ONCE:
                    yield flushed()
        if found:
            yield flushed()

    return held.select("text", "phrases", "n").mapInPandas(
        run, "phrase long, words string, windows array<long>, single boolean, n long"
    )


class Automaton:
    """The phrases of one shard, and the confirmed windows around them."""

    def __init__(self, words: list[str], windows: np.ndarray, window: int) -> None:
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for phrase in words:
            self.machine.add_word(f" {phrase} ")
        self.machine.make_automaton()
        self.windows, self.window, self.hashes = windows, window, WordHashes()

    def starts(self, text: str) -> np.ndarray:
        """Starts of the confirmed windows in a text."""
        words = word_list(text, lower=False)
        line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
        ends = np.fromiter((end for end, _ in self.machine.iter(line)), dtype=np.int64)
        if not len(ends):
            return ends
        # The blank that ends a hit follows its last word.
        sizes = np.fromiter((len(w) for w in line[1:-1].split(" ")), dtype=np.int64, count=len(words))
        last = np.searchsorted(np.cumsum(sizes + 1), ends)
        near = np.zeros(len(words) - self.window + 1, dtype=bool)
        for p in (last - (PHRASE - 1)).tolist():
            near[max(0, p - (self.window - PHRASE)) : p + 1] = True
        at = np.flatnonzero(near)
        found = window_hashes(self.hashes.of(words), self.window).view(np.int64)[at]
        slot = np.minimum(np.searchsorted(self.windows, found), len(self.windows) - 1)
        return at[self.windows[slot] == found]


# An empty frame whose list column Arrow can read.
NOTHING = pd.DataFrame({"cid": pd.Series(dtype="int64"), "starts": pd.Series(dtype=object)})


def located(routed: DataFrame, shards: DataFrame, window: int) -> DataFrame:
    """(cid, starts) from texts and patterns that share a task (shard, salt, part)."""

    def run(texts: pd.DataFrame, patterns: pd.DataFrame) -> pd.DataFrame:
        if not len(texts) or not len(patterns):
            return NOTHING
        machine = Automaton(
            patterns["words"].tolist(), np.unique(np.concatenate(patterns["windows"].to_list())).astype(np.int64), window
        )
        found = [machine.starts(t) for t in texts["text"]]
        kept = [i for i, f in enumerate(found) if len(f)]
        if not kept:
            return NOTHING
        return pd.DataFrame(
            {"cid": texts["cid"].to_numpy()[kept], "starts": [found[i].astype(np.int32) for i in kept]}
        )

    keys = ["shard", "salt", "part"]
    return routed.groupBy(*keys).cogroup(shards.groupBy(*keys)).applyInPandas(run, "cid long, starts array<int>")


def kept_words(covered: DataFrame, window: int) -> DataFrame:
    """(cid, n_removed, kept_sha256) from rows (cid, text, starts)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            removed, shas = [], []
            for t, starts in zip(batch["text"], batch["starts"], strict=True):
                words = word_list(t, lower=False)
                change = np.zeros(len(words) + 1, dtype=np.int64)
                at = np.unique(np.asarray(starts, dtype=np.int64))
                change[at] += 1
                change[at + window] -= 1
                gone = np.cumsum(change)[:-1] > 0
                removed.append(int(gone.sum()))
                shas.append(sha256_of([w for w, g in zip(words, gone.tolist(), strict=True) if not g]))
            yield pd.DataFrame({"cid": batch["cid"], "n_removed": removed, "kept_sha256": shas})

    return covered.select("cid", "text", "starts").mapInPandas(run, "cid long, n_removed long, kept_sha256 string")


def repeated_passages(docs: DataFrame, window: int, text: str, doc_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, covered): the scan, its classes of equal texts, (cid, text, starts) where words go."""
    rows = checkpointed(scanned(docs, text, doc_id, window))
    grouped = rows.filter(F.size("phrases") > 0).groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("phrases").alias("phrases")
    )
    classes = checkpointed(grouped.withColumn("cid", F.monotonically_increasing_id()))
    marked = classes.select("cid", "n", F.explode("phrases").alias("phrase"))
    single = (F.col("n") == 1).cast("int")
    repeated = checkpointed(
        marked.groupBy("phrase")
        .agg(F.sum("n").alias("places"), F.max(single).alias("single"), F.min("cid").alias("home"))
        .filter((F.col("places") > 1) & (F.col("single") == 1))
        .select("phrase", "home")
    )
    holds = checkpointed(marked.select("cid", "phrase").distinct().join(repeated, "phrase").select("cid", "phrase", "home"))
    per_class = holds.groupBy("cid").agg(F.collect_list("phrase").alias("phrases"))
    wanted = classes.select("cid", "n", "rep", "k1", "k2").join(per_class, "cid")
    held = checkpointed(texts_of(docs, wanted, text, doc_id))

    at = checkpointed(places(held, window))
    confirmed = (
        at.select("phrase", "n", F.col("single").cast("int").alias("single"), F.explode("windows").alias("window"))
        .groupBy("phrase", "window")
        .agg(F.sum("n").alias("places"), F.max("single").alias("single"))
        .filter((F.col("places") > 1) & (F.col("single") == 1))
        .select("phrase", "window")
    )
    words = at.filter(F.col("words").isNotNull()).groupBy("phrase").agg(F.max("words").alias("words"))
    patterns = checkpointed(confirmed.join(repeated, "phrase"))

    n_shards = max(1, -(-patterns.select("phrase").distinct().count() // PHRASES_PER_SHARD))
    shard = F.pmod(F.xxhash64("home"), F.lit(n_shards)).alias("shard")
    alive = patterns.select("phrase").distinct()
    sizes = held.filter(F.col("n") == 1).select(
        "cid", F.ceil(F.octet_length("text") / BYTES_PER_WORD).alias("size")
    )
    routes = holds.join(alive, "phrase", "left_semi").select("cid", shard).distinct().join(sizes, "cid")
    routes = checkpointed(routes)
    loads = routes.groupBy("shard").agg(F.ceil(F.sum("size") / WORDS_PER_TASK).cast("int").alias("salts"))
    parts = patterns.select(shard, "window").groupBy("shard").agg(
        F.ceil(F.count(F.lit(1)) / WINDOWS_PER_PART).cast("int").alias("parts")
    )
    layout = checkpointed(loads.join(parts, "shard"))
    routed = routes.join(layout, "shard").select(
        "cid", "shard", F.pmod(F.xxhash64("cid"), F.greatest("salts", F.lit(1))).cast("int").alias("salt"),
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    )
    # One row per phrase and part; a part has a bounded number of windows.
    part = F.pmod("window", F.col("parts")).cast("int").alias("part")
    listed = (
        patterns.select(shard, "phrase", "window").join(layout, "shard")
        .groupBy("phrase", "shard", part, "salts").agg(F.collect_list("window").alias("windows"))
        .join(words, "phrase")
    )
    shards = listed.select(
        "shard", "part", "words", "windows",
        F.explode(F.sequence(F.lit(0), F.greatest("salts", F.lit(1)) - 1)).alias("salt"),
    )
    streamed = routed.join(held.select("cid", "text"), "cid").select("cid", "text", "shard", "salt", "part")
    found = checkpointed(located(streamed, shards, window))
    starts = found.groupBy("cid").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    return rows, classes, starts.join(held.select("cid", "text"), "cid")


def drop_repeats(docs: DataFrame, window: int = WINDOW, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for each row of ``docs``."""
    rows, classes, covered = repeated_passages(docs, window, text, doc_id)
    changed = checkpointed(kept_words(covered, window))
    by_key = classes.select("k1", "k2", "n", "cid").join(changed, "cid", "left").drop("cid")
    empty = hashlib.sha256(b"").hexdigest()
    copied = F.coalesce(F.col("n") > 1, F.lit(False))
    return rows.drop("phrases").join(by_key, ["k1", "k2"], "left").select(
        "doc_id", "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(copied, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeats(table(spark, folder, "documents"))
