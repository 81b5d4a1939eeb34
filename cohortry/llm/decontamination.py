"""Benchmark decontamination with a BM25 index of test items and block-max WAND.

The test items (cut into pieces of at most 64 words) form an inverted index.
Weights use document frequencies over all training documents. The impacts of a
piece are divided by its sum, so a score is the share of the piece's BM25 mass
that a passage holds. Every passage of every document is a query: 128 words, a
new one each 64, so any piece lies in some passage as a whole.

Posting lists are cut into blocks of item ranges with their largest impact. For
all passages of a batch the sums of block maxima are bounds per passage and item
range; ranges below the threshold are skipped at once, in the others WAND moves
from pivot to pivot. Very frequent terms are not looked up for the bounds: the
most they can add to a piece lowers the bound's threshold instead.

What reaches the threshold is verified: enough of the question's word triples and
of the answer's words (the last sentence, or else the last quarter) must stand in
the passage and its surroundings. Each passage that reaches the threshold is verified,
as a better score may stand for scattered words; the best verified one is reported.

The index holds ``BLOCK_ITEMS`` items at most; more items are worked off in blocks
of that size, each with a pass over the documents, so what goes to the tasks stays
bounded. Documents are not shuffled.

Defined cases: NULL or empty documents and items match nothing; repeated items
are reported each, repeated documents too; ties between verified passages go to the first;
empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.common import packed, table, whole
from cohortry.session import checkpointed

K1, B = 1.2, 0.75
THRESHOLD = 0.6
QUESTION_SHARE = 0.5
ANSWER_SHARE = 0.5
HALF = 64
RANGE_ITEMS = 4
FREQUENT = 0.1
BLOCK_ITEMS = 20_000
BATCH_WORDS = 200_000
SENTENCE = re.compile(r"[.?!]+\s+")

# Everything in ASCII that is neither letter nor digit separates terms.
TERM_BYTES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Lower-case terms of a text."""
    return text.lower().encode("utf-8", "surrogatepass").translate(TERM_BYTES).split() if text else []


def question_and_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """An item's terms, parted before its last sentence or last quarter."""
    ends = [m.end() for m in SENTENCE.finditer(text.rstrip())]
    if ends:
        question, answer = terms_of(text[: ends[-1]]), terms_of(text[ends[-1] :])
        if question and answer:
            return question, answer
    words = terms_of(text)
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def triples(words: list[bytes]) -> set[tuple[bytes, ...]]:
    n = min(3, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


class Items:
    """Test items, their pieces and the vocabulary."""

    def __init__(self, rows: list[tuple[int, str]]) -> None:
        self.item_ids: list[int] = []
        self.questions, self.answers, self.sizes = [], [], []
        self.pieces: list[tuple[int, Counter]] = []
        for item_id, text in rows:
            words = terms_of(text)
            if not words:
                continue
            question, answer = question_and_answer(text)
            self.item_ids.append(item_id)
            self.questions.append(triples(question or answer))
            self.answers.append(set(answer))
            self.sizes.append(len(words))
            count = -(-len(words) // HALF)
            size = -(-len(words) // count)
            for at in range(0, len(words), size):
                self.pieces.append((len(self.item_ids) - 1, Counter(words[at : at + size])))
        self.vocabulary = {t: i for i, t in enumerate(sorted({t for _, c in self.pieces for t in c}))}


class Index:
    """Posting lists with block maxima; impacts are shares of the piece's own score."""

    def __init__(self, items: Items, frequency: np.ndarray, documents: int) -> None:
        self.items = items
        idf = np.log(1.0 + (documents - frequency + 0.5) / (frequency + 0.5))
        sizes = [sum(c.values()) for _, c in items.pieces]
        mean = sum(sizes) / max(1, len(sizes))
        postings: list[list[tuple[int, float]]] = [[] for _ in items.vocabulary]
        frequent = frequency > FREQUENT * documents
        slack = np.zeros(len(items.pieces))
        for piece, (_, counts) in enumerate(items.pieces):
            norm = K1 * (1 - B + B * sizes[piece] / mean)
            scores = {items.vocabulary[t]: idf[items.vocabulary[t]] * n * (K1 + 1) / (n + norm) for t, n in counts.items()}
            total = sum(scores.values()) or 1.0
            for t, s in scores.items():
                postings[t].append((piece, s / total))
                if frequent[t]:
                    slack[piece] += s / total
        self.postings = postings
        self.best = [max(s for _, s in p) if p else 0.0 for p in postings]
        self.maxima: list[dict[int, float]] = []
        for p in postings:
            blocks: dict[int, float] = {}
            for piece, s in p:
                blocks[piece // RANGE_ITEMS] = max(blocks.get(piece // RANGE_ITEMS, 0.0), s)
            self.maxima.append(blocks)
        # Block maxima of the rarer terms as flat arrays: term -> ranges and maxima.
        self.ranges = -(-len(items.pieces) // RANGE_ITEMS)
        flat = [(r, m) for t, b in enumerate(self.maxima) if not frequent[t] for r, m in sorted(b.items())]
        lengths = np.array([0 if frequent[t] else len(b) for t, b in enumerate(self.maxima)], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        self.flat_range = np.array([r for r, _ in flat], dtype=np.int64)
        self.flat_max = np.array([m for _, m in flat])
        most = np.zeros(self.ranges)
        np.maximum.at(most, np.arange(len(slack)) // RANGE_ITEMS, slack)
        self.slack = most

    def bounds(self, block: np.ndarray, term: np.ndarray, blocks: int) -> np.ndarray:
        """Bound per block of words and item range, from unique (block, term) pairs."""
        length = self.starts[term + 1] - self.starts[term]
        total = int(length.sum())
        if not total:
            return np.zeros((blocks, self.ranges))
        first = np.repeat(self.starts[term] - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
        at = first + np.arange(total)
        cell = np.repeat(block, length) * self.ranges + self.flat_range[at]
        return np.bincount(cell, self.flat_max[at], blocks * self.ranges).reshape(blocks, self.ranges)

    def retrieve(self, terms: list[int], low: int, high: int, threshold: float) -> list[tuple[int, float]]:
        """Pieces low..high-1 with a score of at least ``threshold``, by block-max WAND."""
        cursors = []
        for t in terms:
            p = self.postings[t]
            at = _seek(p, 0, low)
            if at < len(p) and p[at][0] < high:
                cursors.append([p[at][0], t, at])
        heapq.heapify(cursors)
        found = []
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for i, (_, t, _) in enumerate(cursors):
                bound += self.best[t]
                if bound >= threshold - 1e-9:
                    pivot = i
                    break
            if pivot < 0:
                break
            piece = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == piece:
                pivot += 1
            here = piece // RANGE_ITEMS
            limit = sum(self.maxima[t].get(here, 0.0) for _, t, _ in cursors[: pivot + 1])
            if limit < threshold - 1e-9:
                # No piece up to the end of this block, or to the next list, can reach it.
                target = (here + 1) * RANGE_ITEMS
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                target = max(target, piece + 1)
            elif cursors[0][0] == piece:
                score = sum(self.postings[t][at][1] for _, t, at in cursors[: pivot + 1])
                if score >= threshold:
                    found.append((piece, score))
                target = piece + 1
            else:
                target = piece
            moved = []
            for cursor in cursors[: pivot + 1]:
                p = self.postings[cursor[1]]
                at = _seek(p, cursor[2], target)
                if at < len(p) and p[at][0] < high:
                    moved.append([p[at][0], cursor[1], at])
            cursors = moved + cursors[pivot + 1 :]
        return found


def _seek(postings: list[tuple[int, float]], at: int, piece: int) -> int:
    """First place from ``at`` on with a piece not before ``piece``."""
    low, high = at, len(postings)
    while low < high:
        middle = (low + high) // 2
        if postings[middle][0] < piece:
            low = middle + 1
        else:
            high = middle
    return low


def known_terms(words: list[bytes], vocabulary: dict[bytes, int]) -> np.ndarray:
    """Term number per word, -1 for words that no item has."""
    return np.fromiter(map(vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))


def document_frequencies(docs: DataFrame, items: Items, text: str) -> tuple[np.ndarray, int]:
    """In how many documents each term of the items occurs, and the number of documents."""
    vocabulary = items.vocabulary

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, documents = np.zeros(len(vocabulary) + 1, dtype=np.int64), 0
        for batch in batches:
            documents += len(batch)
            for t in batch["text"]:
                # Each term once per document; the last place takes the unknown words.
                counts[np.fromiter({vocabulary.get(w, -1) for w in set(terms_of(t))}, dtype=np.int64)] += 1
        used = np.flatnonzero(counts[:-1])
        yield pd.DataFrame({"term": np.append(used, -1), "n": np.append(counts[used], documents)})

    rows = (
        docs.select(F.col(text).alias("text")).mapInPandas(run, "term long, n long")
        .groupBy("term").agg(F.sum("n").alias("n")).collect()
    )
    frequency, documents = np.zeros(len(vocabulary)), 0
    for row in rows:
        if row["term"] < 0:
            documents = row["n"]
        else:
            frequency[row["term"]] = row["n"]
    return frequency, documents


class Search:
    """Finds and verifies the items in a batch of documents."""

    def __init__(self, index: Index, threshold: float = THRESHOLD) -> None:
        self.index, self.threshold = index, threshold

    def __call__(self, texts: list[list[bytes]]) -> list[tuple[int, int, int, float, float, float]]:
        """(document, item, first word, score, question share, answer share) of verified items."""
        index, vocabulary = self.index, self.index.items.vocabulary
        # Blocks of half a passage, over all documents of the batch.
        per_text = [max(1, -(-len(w) // HALF)) for w in texts]
        first = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)
        terms = np.concatenate([known_terms(w, vocabulary) for w in texts]) if texts else np.zeros(0, np.int64)
        block = np.concatenate([np.arange(len(w)) // HALF + first[i] for i, w in enumerate(texts)]) if texts else terms
        known = terms >= 0
        pairs = np.unique(block[known] * len(vocabulary) + terms[known])
        pair_block, pair_term = pairs // max(1, len(vocabulary)), pairs % max(1, len(vocabulary))
        bound = index.bounds(pair_block, pair_term, int(first[-1]))
        passage = bound.copy()
        passage[:-1] += bound[1:]
        ends = first[1:] - 1
        # A document's last block has no second half, unless it is its only one.
        passage[ends] = bound[ends]
        rows, ranges = np.nonzero(passage + index.slack >= self.threshold - 1e-9)
        reached: dict[tuple[int, int], dict[int, float]] = {}
        owner = np.searchsorted(first, rows, side="right") - 1
        edges = np.searchsorted(pair_block, np.arange(int(first[-1]) + 1))
        last_row, last_terms = -1, []
        for row, wide, doc in zip(rows.tolist(), ranges.tolist(), owner.tolist(), strict=True):
            if row != last_row:
                until = min(row + 2, int(first[doc + 1]))
                last_row, last_terms = row, np.unique(pair_term[edges[row] : edges[until]]).tolist()
            low = wide * RANGE_ITEMS
            for piece, score in index.retrieve(last_terms, low, low + RANGE_ITEMS, self.threshold):
                scores = reached.setdefault((doc, index.items.pieces[piece][0]), {})
                at = (row - int(first[doc])) * HALF
                scores[at] = max(score, scores.get(at, 0.0))
        found = []
        for (doc, item), scores in sorted(reached.items()):
            # As much on both sides as the item is long, as its pieces may lie in several passages.
            more = max(HALF, index.items.sizes[item])
            question, answer = index.items.questions[item], index.items.answers[item]
            for at, score in sorted(scores.items(), key=lambda p: (-p[1], p[0])):
                around = texts[doc][max(0, at - more) : at + 2 * HALF + more]
                q = len(question & triples_in(around, question)) / max(1, len(question))
                a = len(answer & set(around)) / max(1, len(answer))
                if q >= QUESTION_SHARE and a >= ANSWER_SHARE:
                    found.append((doc, index.items.item_ids[item], at, score, q, a))
                    break
        return found


def triples_in(words: list[bytes], like: set[tuple[bytes, ...]]) -> set[tuple[bytes, ...]]:
    """Runs of a text as long as the question's."""
    n = min((len(t) for t in like), default=3)
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, text_hash, item_id, first_word, score, question_share, answer_share: the verified items of each document."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {id_type}, text_hash long, item_id long, first_word long, score double, question_share double, answer_share double"
    named = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").alias("text"))
    named = named.filter(F.length("text") > 0)
    blocks = max(1, -(-named.count() // BLOCK_ITEMS))
    found = docs.sparkSession.createDataFrame([], schema)
    for block in range(blocks):
        mine = named.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = Items([(r["item_id"], r["text"]) for r in mine.orderBy("item_id", "text").collect()])
        if not items.pieces:
            continue
        frequency, documents = document_frequencies(docs, items, text)
        found = found.union(_search(docs, Index(items, frequency, documents), text, doc_id, schema))
    return found


def _search(docs: DataFrame, index: Index, text: str, doc_id: str, schema: str) -> DataFrame:
    names = ["doc_id", "text_hash", "item_id", "first_word", "score", "question_share", "answer_share"]
    shared = docs.sparkSession.sparkContext.broadcast(index)  # bounded by BLOCK_ITEMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(shared.value)
        for batch in batches:
            texts = [terms_of(t) for t in batch.column(2).to_pylist()]
            at = 0
            while at < len(texts):
                until, words = at, 0
                while until < len(texts) and (words == 0 or words + len(texts[until]) <= BATCH_WORDS):
                    words += len(texts[until]) + 1
                    until += 1
                found = search(texts[at:until])
                if found:
                    place = pa.array([at + f[0] for f in found], pa.int64())
                    whose = [batch.column(i).take(place) for i in range(2)]
                    numbers = [pa.array([f[i] for f in found]) for i in range(1, 6)]
                    yield pa.RecordBatch.from_arrays([*whose, *numbers], names=names)
                at = until

    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(whole(F.col(text))).alias("text_hash"), F.col(text).alias("text")
    ).mapInArrow(run, schema)


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) that hold no item."""
    found = leaks(docs, benchmark).select(F.col("doc_id").alias("leak_id"), F.col("text_hash").alias("leak_hash"))
    rows = packed(docs, id=F.col("doc_id"), hash=F.xxhash64(whole(F.col("text"))))
    same = F.col("id").eqNullSafe(F.col("leak_id")) & (F.col("hash") == F.col("leak_hash"))
    return rows.join(checkpointed(found.distinct()), same, "left_anti").select("row.*")


def op2_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("text_hash")
