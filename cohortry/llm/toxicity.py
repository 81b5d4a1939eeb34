"""Toxicity by a weighted lexicon, matched with Aho-Corasick after folding.

Texts are lower-cased; look-alike letters and digits that stand for letters are
folded, invisible characters dropped. A 1 may stand for an i or an l: text with ones
is matched in both readings, letter by letter. Lexicon entries are words or beginnings of
words with a weight: the log odds of documents with the entry among toxic and
other training documents. A hit must start at the start of a word (and end with
it, if the entry is a word); a word counts once, with its best entry; hits within
an exception phrase do not count. The weights found, in total and per length of
the text, go into a logistic score.

The lexicon and the score are fitted on at most ``SAMPLE`` labelled rows, drawn
by a hash of the id. Only training rows are used, equal texts count once. Every
text is scored in full.

Defined cases: NULL and empty texts have no hits and get the score of a text
without hits; rows without a label are scored; repeated labels of an id count as
toxic if any is; with no toxic or no other training row every score is 0; repeated rows are
scored alike; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.common import Computed, held_out, packed, table, with_computed
from cohortry.session import checkpointed

SAMPLE = 20_000
LEAST_DOCS = 8
LEAST_PRECISION = 0.8
PREFIXES = (4, 5, 6)
FLUSH = 400_000

# Look-alikes of Latin letters, digits for letters, invisible characters.
LOOK_ALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ԁ": "d", "ո": "n", "ӏ": "l",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ϲ": "c",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ⅰ": "i", "ⅾ": "d", "ⅽ": "c",
}
DIGITS = {"0": "o", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"

FOLD = {ord(k): v for k, v in (LOOK_ALIKES | DIGITS).items()} | {ord(c): None for c in INVISIBLE}
FOLD |= {0xFF41 + i: chr(97 + i) for i in range(26)}
SIGN_IN_WORD = re.compile(r"(?<=\w)[@$](?=\w)|(?<!\w)[@$](?=\w\w)")
WORD = re.compile(r"[^\W_]+")

# Phrases in which an entry is harmless; callers may pass their own.
EXCEPTIONS: tuple[str, ...] = ("trash can", "trash bin", "idiot proof", "clown fish")


def one_reading(folded: str) -> str:
    """Ones as i, as words are learned."""
    return folded.replace("1", "i")


def any_reading(folded: str) -> str:
    """i, l and 1 as one symbol."""
    return folded.replace("1", "i").replace("l", "i")


def fold(text: str | None) -> str:
    """Lower case, look-alikes and digits but 1 as letters, invisible characters gone."""
    if not text:
        return ""
    if "$" in text or "@" in text:
        text = SIGN_IN_WORD.sub(lambda m: SIGNS[m[0]], text)
    return text.lower().translate(FOLD)


class Lexicon:
    """An automaton over entries and exception phrases, built once per task."""

    def __init__(self, entries: Sequence[tuple[str, bool, float]], exceptions: Sequence[str] = EXCEPTIONS) -> None:
        self.machine = self._machine(entries, exceptions, one_reading)
        # For places with a 1 only, so that i and l stay apart elsewhere.
        self.loose = self._machine(entries, exceptions, any_reading)

    @staticmethod
    def _machine(
        entries: Sequence[tuple[str, bool, float]], exceptions: Sequence[str], reading: Callable[[str], str]
    ) -> ahocorasick.Automaton | None:
        machine = ahocorasick.Automaton()
        known: dict[str, list] = {}
        for term, is_word, weight in entries:
            slot = known.setdefault(reading(term), [len(term), 0.0, 0.0, False])
            slot[1 + is_word] = max(slot[1 + is_word], weight)
        for phrase in exceptions:
            known.setdefault(reading(fold(phrase)), [len(fold(phrase)), 0.0, 0.0, False])[3] = True
        for term, slot in known.items():
            machine.add_word(term, tuple(slot))
        if not known:
            return None
        machine.make_automaton()
        return machine

    def hits(self, folded: str) -> float:
        """Sum of weights of the words hit in a folded text."""
        if self.machine is None:
            return 0.0
        best: dict[int, float] = {}
        shielded: list[tuple[int, int]] = []
        self._collect(self.machine, one_reading(folded), None, best, shielded)
        if "1" in folded:
            self._collect(self.loose, any_reading(folded), folded, best, shielded)
        if shielded:
            for start in list(best):
                if any(a <= start <= b for a, b in shielded):
                    del best[start]
        return sum(best.values())

    @staticmethod
    def _collect(
        machine: ahocorasick.Automaton, text: str, ones: str | None, best: dict[int, float], shielded: list[tuple[int, int]]
    ) -> None:
        """Hits of a reading; with ``ones``, only those that hold a 1 there."""
        size = len(text)
        for last, (length, prefix, word, exception) in machine.iter(text):
            start = last - length + 1
            if start and text[start - 1].isalnum():
                continue
            if ones is not None and "1" not in ones[start : last + 1]:
                continue
            ends = last + 1 == size or not text[last + 1].isalnum()
            if exception and ends:
                shielded.append((start, last))
            weight = max(prefix, word if ends else 0.0)
            if weight > best.get(start, 0.0):
                best[start] = weight


def features(text: str | None, lexicon: Lexicon) -> tuple[float, float]:
    """Total weight, and weight per square root of the length in hundreds of code points."""
    folded = fold(text)
    total = lexicon.hits(folded)
    return total, total / math.sqrt(1.0 + len(folded) / 100.0)


def entries_of(text: str) -> set[tuple[str, bool]]:
    """Candidate entries of a folded text: its words and their beginnings."""
    found = set()
    for word in set(WORD.findall(text)):
        if len(word) >= 3:
            found.add((word, True))
            found.update((word[:n], False) for n in PREFIXES if len(word) > n)
    return found


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic): labelled rows, at most ``sample``, equal texts once.

    The ids drawn are few and bounded, so they may be broadcast and the texts stay where they are.
    """
    drawn = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    rows = docs.join(F.broadcast(drawn), "doc_id").filter(F.col("text").isNotNull())
    return rows.groupBy(F.xxhash64("text").alias("h")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic")
    ).select("text", "toxic")


def learn_lexicon(rows: DataFrame) -> list[tuple[str, bool, float]]:
    """Entries whose documents are mostly toxic, with log odds; beginnings swallow what they cover."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def flushed() -> pd.DataFrame:
            keys = list(seen)
            frame = pd.DataFrame(
                {
                    "term": [k[0] for k in keys], "word": [k[1] for k in keys],
                    "toxic": [k[2] for k in keys], "n": [seen[k] for k in keys],
                }
            )
            seen.clear()
            return frame

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                seen.update((t, w, int(toxic)) for t, w in entries_of(one_reading(fold(text))))
                if len(seen) > FLUSH:
                    yield flushed()
        if seen:
            yield flushed()

    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic_docs, other_docs = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic_docs or not other_docs:
        return []
    counted = rows.mapInPandas(count, "term string, word boolean, toxic int, n long")
    per_entry = counted.groupBy("term", "word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"),
    )
    good = per_entry.filter((F.col("t") >= LEAST_DOCS) & (F.col("t") >= LEAST_PRECISION * (F.col("t") + F.col("c"))))
    # As many as the bounded sample holds; each is in several of its texts.
    top = good.orderBy(F.desc("t"), "c", "term", "word").collect()
    odds = {
        (r["term"], r["word"]): math.log((r["t"] + 0.5) / (toxic_docs + 1)) - math.log((r["c"] + 0.5) / (other_docs + 1))
        for r in top
    }
    kept = []
    for (term, is_word), weight in sorted(odds.items(), key=lambda e: (len(e[0][0]), e[0])):
        covered = max((odds.get((term[:n], False), 0.0) for n in PREFIXES if n < len(term) + is_word), default=0.0)
        if covered < weight - 1.0 or covered == 0.0:
            kept.append((term, is_word, weight))
    return kept


def fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 30, ridge: float = 1e-2) -> list[float]:
    """Newton steps of a ridge logistic regression; the first weight is the constant."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w -= np.linalg.solve(hessian, gradient)
    return [float(v) for v in w]


class Model:
    """Lexicon and score weights, small enough for every task."""

    def __init__(self, entries: list[tuple[str, bool, float]], weights: list[float] | None, exceptions: Sequence[str]):
        self.entries, self.weights, self.exceptions = entries, weights, tuple(exceptions)

    def score(self, found: tuple[float, float]) -> float:
        if self.weights is None:
            return 0.0
        z = self.weights[0] + sum(w * math.log1p(v) for w, v in zip(self.weights[1:], found, strict=True))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def learn(docs: DataFrame, labels: DataFrame, exceptions: Sequence[str] = EXCEPTIONS, sample: int = SAMPLE) -> Model:
    """Fit lexicon and score on labelled rows; ``docs`` and ``labels`` hold training rows only."""
    rows = checkpointed(training_rows(docs, labels, sample))
    entries = learn_lexicon(rows)
    if not entries:
        return Model([], None, exceptions)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(entries, exceptions)
        for batch in batches:
            found = [features(t, lexicon) for t in batch["text"]]
            yield pd.DataFrame({"a": [f[0] for f in found], "b": [f[1] for f in found], "y": batch["toxic"]})

    # At most ``sample`` rows of three numbers.
    points = rows.mapInPandas(measure, "a double, b double, y int").toPandas()
    weights = fit_logistic(np.log1p(points[["a", "b"]].to_numpy()), points["y"].to_numpy(dtype=float))
    return Model(entries, weights, exceptions)


def score_documents(docs: DataFrame, model: Model, text: str = "text", columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``docs`` with tox_score and tox_weight."""

    def make():
        lexicon = Lexicon(model.entries, model.exceptions)

        def compute(batch: list[str | None]) -> Computed:
            found = [features(t, lexicon) for t in batch]
            return {"tox_score": [model.score(f) for f in found], "tox_weight": [f[0] for f in found]}

        return compute

    return with_computed(docs, columns, text, "tox_score double, tox_weight double", make)


def model_for(spark: SparkSession, docs: DataFrame, folder: str) -> Model:
    """The model from the training rows of ``docs`` and the folder's labels."""
    train = ~held_out(F.col("doc_id"))
    labels = table(spark, folder, "labels").select("doc_id", "toxic").filter(train)
    return learn(docs.select("doc_id", "text").filter(train), labels)


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (text, ...) that the model does not reject."""
    scored = score_documents(packed(docs, text=F.col("text")), model, columns=["row"])
    return scored.filter(F.col("tox_score") < threshold).select("row.*")


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = score_documents(docs, model_for(spark, docs, folder))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("tox_score").alias("score"),
        (F.col("tox_score") >= 0.5).cast("int").alias("predicted"), "tox_weight",
    )
