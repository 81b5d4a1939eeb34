r"""Secret scan with corpus-wide ownership, in DataFrame functions only.

Each kind of candidate is found by its pattern in every whole text. A text is
split by the pattern into the gaps between matches; running sums of the lengths
of gaps and matches give the places in code points. The texts are scanned once
and never shuffled.

Ownership: the hash of each candidate value is counted over distinct owners and
repositories. Repeats within an owner are merged first, so a value that a third
of all rows hold reaches the last step as one row per owner. A value of several
owners is a copied ``example``; a random-looking value of a single owner is
``live``; the rest is ``unclear``. A value that is assigned as a secret anywhere
in the corpus is also found where it stands bare (kind ``copy``): a run of at least
six characters of a value, or a part of one between dots. Dots at the end of a
value do not count, if six characters are left. Only the hashes of the runs are
kept, and only documents that share one with an assigned value are looked through.

Kinds, in the order used for spans that start together: assign, access, hex
(the base), bearer, key block, copy. Defined cases: a NULL text counts as empty;
a text without spans gives zero counts and the hash of the empty string; repeated
rows are separate rows and each gets its result; NULL owner or repository is one
more value; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.llm.common import table, whole
from cohortry.session import checkpointed

# The base patterns.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A maximal run that is too short can hold no longer match, so the least length may stand in the pattern.
ACCESS = r"(AKIA[A-Z0-9]{16,})"
HEX = r"([0-9a-f]{24,})"
# Kinds of this method.
BEARER = r"(?i:bearer)\x20+([A-Za-z0-9+/_.=-]{16,})"
KEY_BLOCK = r"(-----BEGIN [A-Z ]*PRIVATE KEY-----)"
BARE = r"(?<![A-Za-z0-9+/_=-])([A-Za-z0-9+/_=-]{6,}+)"
# A run with dots inside or before it, without those at its end.
DOTTED = (
    r"(?<![A-Za-z0-9+/_.=-])(?=[A-Za-z0-9+/_=-]*+\.++[A-Za-z0-9+/_=-])"
    r"([A-Za-z0-9+/_.=-]{5,}[A-Za-z0-9+/_=-])(?![A-Za-z0-9+/_=-])"
)

KINDS = ("assign", "access", "hex", "bearer", "key_block", "copy")
PATTERNS = {  # kind -> pattern, group of the value
    "assign": (ASSIGN, 2),
    "access": (ACCESS, 1),
    "hex": (HEX, 1),
    "bearer": (BEARER, 1),
    "key_block": (KEY_BLOCK, 1),
    "copy": (BARE, 1),
    "dotted": (DOTTED, 1),  # reported as copy
}
BARE_KINDS = ("copy", "dotted")
BASE = KINDS[:3]
LEAST_VALUE = {"assign": 6}
EXAMPLE_OWNERS = 3
LIVE_BITS = 3.0


def found(text: Column, kind: str) -> Column:
    """Matches of a kind as array of (gap before, length, value), in text order."""
    pattern, group = PATTERNS[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    zipped = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("g"), matches.alias("m"), values.alias("v")),
        lambda x: F.struct(
            F.char_length(x["g"]).alias("gap"), F.char_length(x["m"]).alias("len"), x["v"].alias("value")
        ),
    )
    none = F.array().cast("array<struct<gap:int,len:int,value:string>>")
    return F.when(text.rlike(pattern), zipped).otherwise(none)


def value_key(value: Column) -> Column:
    """The hash that names a value, without the dots at its end."""
    plain = F.rtrim(value, F.lit("."))
    return F.xxhash64(F.when(F.char_length(plain) >= LEAST_VALUE["assign"], plain).otherwise(value))


def entropy_bits(value: Column) -> Column:
    """Bits per character of the characters' frequencies in a value."""
    size = F.char_length(value).cast("double")
    chars = F.array_distinct(F.split(value, ""))
    share = lambda c: (size - F.char_length(F.replace(value, c))) / size
    return F.aggregate(
        F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c))
    )


def candidate_spans(docs: DataFrame, text: str, doc_id: str, owner: str, repository: str) -> tuple[DataFrame, DataFrame]:
    """(one row per document, one row per candidate with its place)."""
    body = whole(F.col(text))
    scanned = checkpointed(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col(doc_id).alias("doc_id"),
            F.col(owner).cast("string").alias("owner"),
            F.col(repository).cast("string").alias("repository"),
            *(found(body, k).alias(k) for k in KINDS if k not in BARE_KINDS),
            *(
                F.transform(
                    found(body, k),
                    lambda x: F.struct(x["gap"].alias("gap"), x["len"].alias("len"), value_key(x["value"]).alias("key")),
                ).alias(k)
                for k in BARE_KINDS
            ),
        )
    )

    def numbered(n: int, kind: str) -> Column:
        return F.transform(
            F.col(kind),
            lambda x, i: F.struct(
                F.lit(n).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["len"].alias("len"),
                x["value"].alias("value"),
            ),
        )

    places = ["uid", "owner", "repository"]

    def placed(rows: DataFrame) -> DataFrame:
        upto = Window.partitionBy("uid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(upto)).withColumn(
            "start", F.col("end") - F.col("len")
        )

    plain = [k for k in KINDS if k not in BARE_KINDS]
    rows = (
        scanned.filter(F.greatest(*(F.size(k) for k in plain)) > 0)
        .select(*places, F.explode(F.concat(*(numbered(n, k) for n, k in enumerate(plain)))).alias("c"))
        .select(*places, "c.*")
        .repartition("uid")
    )
    least = F.when(F.col("kind") == KINDS.index("assign"), LEAST_VALUE["assign"]).otherwise(0)
    spans = checkpointed(
        placed(rows)
        .filter(F.char_length("value") >= least)
        .select(*places, "kind", "start", "end", "value", value_key(F.col("value")).alias("key"))
    )

    # Bare runs: hashes first, then places in the documents that hold an assigned value.
    assigned = spans.select("key").distinct()
    keys = F.array_distinct(F.concat(*(F.transform(k, lambda x: x["key"]) for k in BARE_KINDS)))
    hits = checkpointed(scanned.select("uid", F.explode(keys).alias("key")).join(assigned, "key", "left_semi"))
    held = scanned.join(hits.select("uid").distinct(), "uid", "left_semi")

    def run(n: int, kind: str) -> Column:
        return F.transform(
            F.col(kind),
            lambda x, i: F.struct(
                F.lit(n).alias("kind"), i.alias("i"), x["gap"].alias("gap"), x["len"].alias("len"), x["key"].alias("key")
            ),
        )

    first = KINDS.index("copy")
    runs = held.select(*places, F.explode(F.concat(*(run(first + n, k) for n, k in enumerate(BARE_KINDS)))).alias("c"))
    copies = placed(runs.select(*places, "c.*")).join(hits, ["uid", "key"], "left_semi")
    copies = copies.select(*places, "kind", "start", "end", F.lit(None).cast("string").alias("value"), "key")
    return scanned.select("uid", "doc_id"), spans.union(one_of_each_place(copies))


def one_of_each_place(copies: DataFrame) -> DataFrame:
    """Copies of both sorts as kind ``copy``; a part of a run with dots that is a copy itself is left out."""
    copy = KINDS.index("copy")
    dotted = F.col("kind") > copy
    before = Window.partitionBy("uid").orderBy("start", F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    inside = F.max(F.when(dotted, F.col("end"))).over(before)
    marked = copies.withColumn("inside", inside)
    left = marked.filter(dotted | F.col("inside").isNull() | (F.col("inside") < F.col("end")))
    return left.withColumn("kind", F.lit(copy)).drop("inside")


def ownership(spans: DataFrame) -> DataFrame:
    """Per value hash: distinct owners and repositories, whether it is assigned, and its class."""
    assigned = F.max((F.col("kind") != KINDS.index("copy")).cast("int"))
    # Copies carry no value of their own; an assigned one of the key stands for it.
    per_place = spans.groupBy("key", "owner", "repository").agg(
        assigned.alias("assigned"), F.count(F.lit(1)).alias("n"), F.max("value").alias("value")
    )
    per_owner = per_place.groupBy("key", "owner").agg(
        F.max("assigned").alias("assigned"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("repositories"),
        F.max("value").alias("value"),
    )
    stats = per_owner.groupBy("key").agg(
        F.max("assigned").alias("assigned"), F.sum("n").alias("n_spans"), F.count(F.lit(1)).alias("n_owners"),
        F.sum("repositories").alias("n_repositories"), F.max("value").alias("value"),
    )
    live = (F.col("n_owners") == 1) & (F.char_length("value") >= 12) & (entropy_bits(F.col("value")) >= LIVE_BITS)
    return stats.filter(F.col("assigned") == 1).select(
        "key", "n_spans", "n_owners", "n_repositories",
        F.when(F.col("n_owners") >= EXAMPLE_OWNERS, "example").when(live, "live").otherwise("unclear").alias("class"),
    )


def joined_spans(found: Column) -> Column:
    """Spans as text ``kind:start:end``, by start, then by kind."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(
        ",", F.transform(found, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    )


def scan_secrets(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", owner: str = "source", repository: str = "doc_id"
) -> DataFrame:
    """One row per row of ``docs``: counts, hash of the base spans, all spans, values by class."""
    documents, spans = candidate_spans(docs, text, doc_id, owner, repository)
    spans = checkpointed(spans)
    known = spans.join(ownership(spans), "key")
    # A bare value that lies in a span of another kind is that span once more.
    before = Window.partitionBy("uid").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    bare = F.col("kind") == KINDS.index("copy")
    covered = F.max(F.when(~bare, F.col("end"))).over(before)
    rows = known.withColumn("covered", covered).filter(~bare | F.col("covered").isNull() | (F.col("covered") < F.col("end")))
    of_base = F.col("kind") < len(BASE)
    span = F.struct("start", "kind", "end")
    per_doc = rows.groupBy("uid").agg(
        *(F.sum((F.col("kind") == n).cast("bigint")).alias(f"n_{k}") for n, k in enumerate(KINDS)),
        F.sort_array(F.collect_list(F.when(of_base, span))).alias("base"),
        F.sort_array(F.collect_list(span)).alias("every"),
        *(F.sum((F.col("class") == c).cast("bigint")).alias(f"n_{c}") for c in ("example", "live", "unclear")),
        F.max("n_owners").alias("most_owners"),
    )
    zero = F.lit(0).cast("bigint")
    counts = [f"n_{k}" for k in (*KINDS, "example", "live", "unclear")]
    return documents.join(per_doc, "uid", "left").select(
        "doc_id",
        *(F.coalesce(F.col(c), zero).alias(c) for c in counts),
        F.sha2(F.coalesce(joined_spans(F.col("base")), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(joined_spans(F.col("every")), F.lit("")).alias("spans"),
        F.coalesce("most_owners", zero).alias("most_owners"),
    )


def op5_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(table(spark, folder, "documents"))
