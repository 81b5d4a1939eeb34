"""Text operators: fields out of prose, labels, summaries, group themes.

All of them read whole texts. Only ``complete`` leaves the JVM, because the
caller supplies the function that writes the completion.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.operators.grouping import stitch
from cohortry.operators.ranking import top_per_group

# Patterns shared by Java and RE2 (no look-around, no back-references).
SENTENCE = r"^[^.!?]*"
GAP = r"[ \t\r\n]+"
WORD = r"[\p{L}]+"
NOT_WORD = r"[^\p{L}\p{N}]+"


def extract(text: Column, fields: dict[str, tuple[str, ...]]) -> Column:
    """One struct of typed fields, each from the first match of its pattern.

    ``fields`` maps a name to (pattern with one group, type) and, optionally, a
    literal that every match contains: texts without it skip the pattern. A
    field that is absent, or does not fit its type, is NULL.
    """

    def field(pattern: str, dtype: str, literal: str | None = None) -> Column:
        found = F.regexp_extract(text, pattern, 1)
        if literal is not None:
            found = F.when(F.contains(text, F.lit(literal)), found)
        return F.nullif(found, F.lit("")).try_cast(dtype)

    return F.struct(*[field(*spec).alias(name) for name, spec in fields.items()])


def occurrences(text: Column, phrase: str) -> Column:
    """Non-overlapping occurrences of a literal phrase, upper and lower case alike."""
    quoted = r"\Q" + phrase.lower() + r"\E"
    return F.regexp_count(F.lower(text), F.lit(quoted)).cast("bigint")


def padded(text: Column) -> Column:
    """Words of a text in lower case with one blank on either side, marks left out.

    Phrases such as `` the `` are then found at the ends of a text and next to
    punctuation, too.
    """
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), NOT_WORD, " "), F.lit(" "))


def classify(
    text: Column, labels: dict[str, Sequence[str]], otherwise: str | None = None
) -> Column:
    """The label whose phrases occur most; the earlier label wins a tie.

    Without any match the result is ``otherwise``, or the first label if that
    is not given. A NULL text has no label.
    """
    # No counting happens inside a conditional branch: Spark then lowers the
    # text once for all phrases.
    scored = []
    for place, (label, phrases) in enumerate(labels.items()):
        hits = sum((occurrences(text, p) for p in phrases), F.lit(0).cast("bigint"))
        known = F.when(text.isNotNull(), F.lit(label))
        scored.append(F.struct(hits.alias("hits"), F.lit(-place).alias("place"), known.alias("label")))
    best = F.array_max(F.array(*scored))
    if otherwise is None:
        return best["label"]
    return F.when(best["hits"] > 0, best["label"]).when(text.isNotNull(), F.lit(otherwise))


def words(text: Column) -> Column:
    """The words of a text in lower case, marks left out."""
    return F.filter(F.split(F.lower(text), NOT_WORD), lambda w: w != "")


def classify_words(text: Column, labels: dict[str, Sequence[str]], otherwise: str | None = None) -> Column:
    """The label whose words occur most; the earlier label wins a tie, as in ``classify``.

    A text is split once, whatever the number of labels, and each label takes one
    look-up per word; a phrase of several words needs ``classify``.
    """
    found = words(text)

    def hits(split: Column, own: Sequence[str]) -> Column:
        return F.size(F.filter(split, lambda w: w.isin(*own)))

    def best(split: Column) -> Column:
        scored = [
            F.struct(hits(split, own).alias("hits"), F.lit(-place).alias("place"), F.lit(label).alias("label"))
            for place, (label, own) in enumerate(labels.items())
        ]
        top = F.array_max(F.array(*scored))
        return top["label"] if otherwise is None else F.when(top["hits"] > 0, top["label"]).otherwise(otherwise)

    # The lambda names the words once for all labels.
    return F.when(text.isNotNull(), F.element_at(F.transform(F.array(found), best), 1))


def first_words(text: Column, k: int) -> Column:
    """The first sentence, cut to at most ``k`` words."""
    sentence = F.regexp_extract(text, SENTENCE, 0)
    words = F.filter(F.split(sentence, GAP), lambda w: w != "")
    return F.concat_ws(" ", F.slice(words, 1, k))


def complete(
    df: DataFrame,
    text: str,
    prompt: str,
    make: Callable[[], Callable[[list[str]], list[str]]],
    name: str,
    max_words: int | None = None,
) -> DataFrame:
    """Add a completion of ``prompt + text`` written by the caller's function.

    ``make`` runs once per task, so an expensive set-up is paid once; what it
    returns takes the prompts of one Arrow batch and gives one text for each.
    Limit ``df`` before, never after, this call: Spark cannot move a limit
    across it.
    """
    schema = T.StructType(df.schema.fields + [T.StructField(name, T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        write = make()
        for batch in batches:
            known = batch[text].notna()
            answers = pd.Series([None] * len(batch), index=batch.index, dtype="object")
            if known.any():
                answers[known] = write([prompt + t for t in batch.loc[known, text]])
            if max_words is not None:
                answers = answers.map(
                    lambda a: " ".join(a.split()[:max_words]) if isinstance(a, str) else None
                )
            yield batch.assign(**{name: answers})

    return df.mapInPandas(run, schema)


def terms(df: DataFrame, text: str, keep: Sequence[str], min_length: int, name: str = "term") -> DataFrame:
    """One row per word of at least ``min_length`` letters, in lower case."""
    words = F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD), F.lit(0))
    return df.select(*keep, F.explode(words).alias(name)).filter(F.length(name) >= min_length)


def themes(
    df: DataFrame, group: str, text: str, k: int = 3, min_length: int = 4,
    reviewed: str = "reports_reviewed", name: str = "themes",
) -> DataFrame:
    """The ``k`` most frequent terms of each group, most frequent first.

    Terms are counted where the texts lie and only counts travel; no group is
    ever put together into one text.
    """
    counted = (
        terms(df, text, [group], min_length)
        .groupBy(group, "term")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    best = top_per_group(counted, [group], [F.desc("uses"), F.asc("term")], k)
    listed = F.array_sort(F.collect_list(F.struct("rank", "term")))
    leading = best.groupBy(group).agg(
        F.concat_ws(", ", F.transform(listed, lambda x: x["term"])).alias(name)
    )
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias(reviewed))
    return stitch([sizes, leading], [group]).select(group, reviewed, name)
