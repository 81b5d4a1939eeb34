"""Language identification by compression.

For each language some training texts form a raw-content zstandard dictionary.
A text is compressed with each dictionary, in pieces, and the language with the
smallest total wins. The margin to the runner-up, relative to the size, tells
how sure that is; below ``MARGIN`` the answer is marked ``rejected``.

The dictionaries are the only model: at most ``DOCS_PER_LANG`` texts of
``CHARS_PER_DOC`` letters per language, drawn by a hash of the text from all
training rows, so their size does not grow with the table. Every text is judged
in full.

Defined cases: a text that is NULL or has no letter is ``und`` with score 0, as
is every text if there is no training row; rows with a NULL language or id are
judged, but not learned from (NULL language); ties go to the language that sorts
first; repeated rows are judged alike; an empty table gives no rows; only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.llm.common import Computed, held_out, table, with_computed

DOCS_PER_LANG = 100
CHARS_PER_DOC = 1000
LEAST_CHARS = 100
PIECE = 2000
LEVEL = 5
# Short matches count: a syllable already tells languages apart.
LEAST_MATCH = 3
MARGIN = 0.01
UNKNOWN = "und"

NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")


def plain(text: str | None) -> str:
    """Lower-case letters and their marks with single blanks for everything else; empty without a letter."""
    letters = NOT_LETTERS.sub(" ", text.lower()).strip() if text else ""
    return letters if any(c.isalpha() for c in letters) else ""


def learn(
    rows: DataFrame, text: str = "text", lang: str = "lang", docs_per_lang: int = DOCS_PER_LANG
) -> dict[str, bytes]:
    """Dictionary content per language from labelled rows; a bounded sample by text hash.

    Texts of fewer than ``LEAST_CHARS`` code points serve where a language has too few longer ones.
    """
    usable = rows.filter(F.col(lang).isNotNull() & (F.char_length(text) > 0)).select(
        F.col(lang).alias("lang"),
        (F.char_length(text) < LEAST_CHARS).alias("short"),
        F.substring(text, 1, 2 * CHARS_PER_DOC).alias("start"),
        F.xxhash64(text).alias("draw"),
    )
    best = Window.partitionBy("lang").orderBy("short", "draw", "start")
    drawn = usable.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= docs_per_lang)
    content: dict[str, list[str]] = {}
    for row in drawn.orderBy("lang", "rank").collect():
        content.setdefault(row["lang"], []).append(plain(row["start"])[:CHARS_PER_DOC])
    return {k: "\n".join(v).encode() for k, v in sorted(content.items())}


class Judge:
    """Compressors for all languages, built once per task."""

    def __init__(self, content: dict[str, bytes]) -> None:
        self.langs = list(content)
        self.compressors = []
        for data in content.values():
            words = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters.from_level(
                LEVEL, source_size=PIECE, dict_size=len(data), min_match=LEAST_MATCH,
                strategy=zstandard.STRATEGY_GREEDY, write_content_size=False, write_dict_id=False,
            )
            words.precompute_compress(compression_params=how)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=words, compression_params=how))

    def __call__(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, relative margin)."""
        letters = plain(text)
        if not letters or not self.langs:
            return UNKNOWN, 0.0, 0.0
        data = letters.encode()
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        sizes = [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = sizes[:best] + sizes[best + 1 :]
        margin = (min(others) - sizes[best]) / sizes[best] if others else 1.0
        # Shares of 2 to the saved bytes, as code lengths stand for likelihoods.
        score = 1.0 / sum(2.0 ** max(-60, sizes[best] - s) for s in sizes)
        return self.langs[best], score, margin


def identify(docs: DataFrame, content: dict[str, bytes], text: str = "text", columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``columns`` with lang_pred, score, margin and rejected for each row of ``docs``."""

    def make():
        judge = Judge(content)

        def compute(batch: list[str | None]) -> Computed:
            found = [judge(t) for t in batch]
            return {
                "lang_pred": [f[0] for f in found], "score": [f[1] for f in found],
                "margin": [f[2] for f in found], "rejected": [f[2] < MARGIN for f in found],
            }

        return compute

    return with_computed(docs, columns, text, "lang_pred string, score double, margin double, rejected boolean", make)


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    content = learn(docs.filter(~held_out(F.col("doc_id"))))
    judged = identify(docs, content)
    return judged.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "rejected"
    )
