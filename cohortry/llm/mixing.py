"""Mixing to target weights by iterative proportional fitting, in DataFrame functions only.

Documents are counted once into cells (source, language, topic) with their
tokens; everything after that works on cells. Each round scales the cell weights
to the targets of one margin after the other. A cell's weight per token, times the
budget, is how often each of its rows is expected in the sample: a probability up to
one, and copies beyond for cells that hold fewer tokens than their targets ask for.
A row's ``copies`` are that number, rounded up or down by the hash of its id: a pure
function of the id, so lost work is redone alike. Rows taken as often as their copies
have the budget and the target shares in expectation, rare cells included.

A row is never taken more than ``max_copies`` times. What a cell then lacks of its
weight is in ``shortfall``; nothing else takes its place.

The targets of a margin are its token shares, tempered by a power below one
(small classes gain) or given as a table. Defined cases: NULL classes are one
more class; NULL or empty texts have no tokens, count as one row in their cell
and keep the probability of their cell; repeated rows share one decision; a
margin value without target keeps no weight; an empty table gives no rows; extra
columns are carried along unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortry.llm.common import packed, table, whole
from cohortry.session import checkpointed

MARGINS = ("source", "lang", "topic")
TEMPER = 0.5
ROUNDS = 8
KEEP_SHARE = 0.5
MAX_COPIES = 16
HASH_DIGITS = 13

# How a text's layout names its topic, first match wins.
LAYOUTS = (("table", " | "), ("shouting", "!! "), ("noise", "### "))


def layout_topic(text: Column) -> Column:
    """Topic by layout: table, shouting, noise, short (under 400 code points) or prose."""
    body = whole(text)
    topic = F.when(F.contains(body, F.lit(LAYOUTS[0][1])), LAYOUTS[0][0])
    for name, mark in LAYOUTS[1:]:
        topic = topic.when(F.contains(body, F.lit(mark)), name)
    return topic.when(F.char_length(body) < 400, "short").otherwise("prose")


def token_count(text: Column) -> Column:
    """Blank-separated pieces of the whole text, as the token measure."""
    body = whole(text)
    blanks = F.octet_length(body) - F.octet_length(F.replace(body, F.lit(" "), F.lit("")))
    return F.when(body == "", 0).otherwise(blanks + 1).cast("bigint")


def uniform(doc_id: Column) -> Column:
    """A number in [0, 1) from the id alone."""
    digits = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, HASH_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**HASH_DIGITS))


def tempered_targets(cells: DataFrame, margin: str, temper: float = TEMPER) -> DataFrame:
    """(margin, target): shares of the token sums to a power, adding up to one."""
    sums = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(temper)).alias("t"))
    total = sums.agg(F.sum("t").alias("all"))
    return sums.crossJoin(total).select(margin, (F.col("t") / F.col("all")).alias("target"))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Cells with ``weight``: token weights fitted to the targets of all margins.

    A margin's sums are an ordinary aggregate, combined before the shuffle, so a
    class that holds a third of the cells is no hot group. Each round is written
    once, which keeps the plan short and survives lost executors.
    """
    fitted = cells.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(rounds):
        for margin, target in targets.items():
            sums = fitted.groupBy(F.col(margin).alias("_m")).agg(F.sum("weight").alias("_s"))
            wanted = target.select(F.col(margin).alias("_t"), "target")
            factors = sums.join(wanted, F.col("_m").eqNullSafe(F.col("_t")), "left").select(
                "_m", F.when(F.col("_s") > 0, F.coalesce("target", F.lit(0.0)) / F.col("_s")).otherwise(0.0).alias("_f")
            )
            fitted = (
                fitted.join(factors, F.col(margin).eqNullSafe(F.col("_m")), "left")
                .withColumn("weight", F.col("weight") * F.col("_f"))
                .select(cells.columns + ["weight"])
            )
        fitted = checkpointed(fitted)
    return fitted


def expected_copies(cells: DataFrame, budget: float, max_copies: int = MAX_COPIES) -> DataFrame:
    """Cells with ``asked`` and ``expected``: how often a row must occur for its cell to have its weight's share of ``budget``, and does."""
    total = cells.agg(F.sum("weight").alias("n")).first()["n"] or 0.0
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    asked = cells.withColumn("asked", ratio * F.lit(budget / total if total else 0.0))
    return asked.withColumn("expected", F.least(F.col("asked"), F.lit(float(max_copies))))


def shortfall(cells: DataFrame) -> DataFrame:
    """The cells that ``max_copies`` keeps below their weight, with the tokens they lack."""
    lack = (F.col("asked") - F.col("expected")) * F.col("tokens")
    return cells.filter("asked > expected").select(*MARGINS, "tokens", "asked", "expected", lack.alias("lacking"))


def cells_of(
    drawn: DataFrame, keep_share: float, temper: float, rounds: int, targets: Mapping[str, DataFrame] | None, max_copies: int
) -> DataFrame:
    """The cells of ``drawn`` (source, lang, topic, tokens), fitted, with ``asked`` and ``expected`` copies of a row."""
    cells = checkpointed(
        drawn.groupBy(*MARGINS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"))
    )
    wanted = dict(targets) if targets else {m: checkpointed(tempered_targets(cells, m, temper)) for m in MARGINS}
    fitted = rake(cells, wanted, rounds)
    total = cells.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    return checkpointed(expected_copies(fitted, keep_share * float(total), max_copies))


def mix(
    docs: DataFrame,
    keep_share: float = KEEP_SHARE,
    temper: float = TEMPER,
    rounds: int = ROUNDS,
    text: str = "text",
    doc_id: str = "doc_id",
    source: str = "source",
    lang: str = "lang",
    topic: Column | None = None,
    targets: Mapping[str, DataFrame] | None = None,
    seed: str = "",
    max_copies: int = MAX_COPIES,
) -> DataFrame:
    """(row, topic, tokens, expected, copies) of the kept rows; ``row`` holds the columns of ``docs``.

    ``max_copies`` bounds how often a row is taken.

    The texts are read for the cell counts and again for the sample; they are not shuffled.
    """
    drawn = packed(
        docs,
        source=F.col(source).cast("string"),
        lang=F.col(lang).cast("string"),
        topic=topic if topic is not None else layout_topic(F.col(text)),
        tokens=token_count(F.col(text)),
        draw=uniform(F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))),
    )
    chances = cells_of(drawn, keep_share, temper, rounds, targets, max_copies)
    chances = chances.select(*(F.col(m).alias(f"c_{m}") for m in MARGINS), "expected")
    more = (F.col("draw") < F.col("expected") - F.floor("expected")).cast("int")
    match = (
        F.col("source").eqNullSafe(F.col("c_source"))
        & F.col("lang").eqNullSafe(F.col("c_lang"))
        & F.col("topic").eqNullSafe(F.col("c_topic"))
    )
    copies = F.floor("expected").cast("int") + more
    kept = drawn.join(chances, match).withColumn("copies", copies).filter(F.col("copies") > 0)
    return kept.select("row", "topic", "tokens", "expected", "copies")


def repeated(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix``, each as often as its copies."""
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copy")


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The sampled documents of the whole table, with the copies in which they meet the margins."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    return mix(documents).select(
        "row.doc_id", "row.source", "row.lang", "topic", "tokens", F.round("expected", 6).alias("expected"),
        F.col("copies").cast("bigint").alias("copies"),
    )
