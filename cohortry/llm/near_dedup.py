"""Near-duplicate documents by a chosen-path set similarity join.

Each document's set of word shingles gets a minwise token for each of many hash
functions. A tree starts with all documents at its root. At each level a node
selects two of the level's own hash functions, and a document goes to one child
per selected function: that of its minwise token. Similar documents share
children, others part. A node that has become small is compared exhaustively; a
node that no longer shrinks is dense. The trees bring the recall to its target: as
nodes select for themselves, a pair of similarity 0.8 that shares several nodes
has several chances further down. Six trees miss it with a chance below 0.0001
at four levels and at all eight (more similar pairs far more rarely).

Equal sets are merged first, so a group of copies is one row whatever its size.
Candidates of the trees whose minwise tokens agree too rarely are set aside (a pair
at the threshold with a chance of 0.0001); the others are confirmed on full sets.
In a dense node every member is first compared to a few of them, and members outside
the node's largest component to some inside it. Members that are
still in another component than the node's largest are then joined exactly with
all members of other components: similar sets share one of their rarest tokens,
so that no pair of a dense node stays undecided and few are compared. Two sets differ
in at least as many shingles as their parity bits do, so the join itself drops pairs
whose bits differ too much; copies that are near many others without reaching the
threshold do not become pairs. (Sets of far more shingles than bits gain little.)

Defined cases: NULL and empty texts, and texts without words, have no shingle and
stand alone; rows that repeat an id keep their rows and share the id; a component
without any id has a NULL id and nothing kept; ties do not occur, as ids decide;
an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.llm.common import Computed, packed, table, whole, with_computed
from cohortry.llm.shingles import WordHashes, multipliers, shingle_set, word_list
from cohortry.session import checkpointed

SHINGLE_WORDS = 5
PERCENT = 80
TREES = 6
LEVELS = 8
TOKENS = 96
LEAST_AGREE = 62
CENTERS = 2
SMALL_NODE = 16
# A child with at least this share of its parent's rows makes the rows of the next level grow.
DENSE_SHARE = 0.5
# A node of whose probes at least this share is close to a centre holds a group of near copies.
ALIKE_SHARE, PROBES = 0.25, 32
# Turns in which members outside the largest component of a dense node meet so many inside it, if it has this share.
SETTLING_TURNS, SETTLERS, SETTLED_SHARE = 1, 64, 0.1
# Bits of a set in the joins of dense nodes, a power of two: 16 numbers next to each row.
PARITY_BITS = 1024
BLOCK = 4096


def minwise(shingles: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Per hash function the smallest value over the set, 32 bits."""
    best = np.full(len(seeds), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), BLOCK):
        values = shingles[at : at + BLOCK][None, :] * seeds[:, None]
        np.minimum(best, values.min(axis=1), out=best)
    return (best >> np.uint64(32)).astype(np.uint32).view(np.int32)


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit numbers that name a set."""
    digest = xxhash.xxh3_128_digest(shingles.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def parity(shingles: np.ndarray) -> np.ndarray:
    """``PARITY_BITS`` bits as 64-bit numbers: whether an odd number of shingles falls on the bit.

    What two sets share cancels out, and a shingle that only one has turns one bit.
    So two sets differ in at least as many shingles as in bits.
    """
    places = shingles >> np.uint64(64 - PARITY_BITS.bit_length() + 1)
    odd = np.bincount(places.astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def described(docs: DataFrame, text: str, doc_id: str, words: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, k1, k2, tokens for each row."""

    def make():
        hashes, seeds = WordHashes(), multipliers(TOKENS, 29)

        def compute(batch: list[str | None]) -> Computed:
            out: Computed = {"n_shingles": [], "k1": [], "k2": [], "tokens": []}
            for t in batch:
                found = shingle_set(hashes.of(word_list(t, lower=True)), words)
                key = set_key(found)
                out["n_shingles"].append(len(found))
                out["k1"].append(key[0])
                out["k2"].append(key[1])
                out["tokens"].append(minwise(found, seeds) if len(found) else [])
            return out

        return compute

    named = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
        F.xxhash64(whole(F.col(text))).alias("text_hash"),
    )
    return with_computed(named, ["doc_id", "text_hash"], "text", "n_shingles long, k1 long, k2 long, tokens array<int>", make)


def shingle_sets(docs: DataFrame, wanted: DataFrame, text: str, doc_id: str, words: int) -> DataFrame:
    """(cid, n, bits, shingles), one row for each class in ``wanted`` (cid, rep, k1, k2, again), from the texts that stand for them.

    Rows that repeat an id and its text, and rows without id, give a set more than
    once; only classes of several rows (``again``) are looked through for that.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = WordHashes()
        for batch in batches:
            cids, again, sets, bits = [], [], [], []
            for cid, k1, more, t in zip(batch["cid"], batch["k1"], batch["again"], batch["text"], strict=True):
                found = shingle_set(hashes.of(word_list(t, lower=True)), words)
                # A repeated id may also name another text.
                if set_key(found)[0] == k1:
                    cids.append(cid)
                    again.append(more)
                    sets.append(found.view(np.int64))
                    bits.append(parity(found))
            if cids:
                yield pd.DataFrame({"cid": cids, "again": again, "n": [len(s) for s in sets], "bits": bits, "shingles": sets})

    texts = docs.select(F.col(doc_id).cast("bigint").alias("rep"), F.col(text).alias("text"))
    # NULL ids may stand for a class, too.
    joined = texts.join(wanted.withColumnRenamed("rep", "_rep"), F.col("rep").eqNullSafe(F.col("_rep")))
    fields = "cid long, again boolean, n int, bits array<long>, shingles array<long>"
    sets = checkpointed(joined.select("cid", "k1", "again", "text").mapInPandas(run, fields))
    once = checkpointed(sets.filter("again").dropDuplicates(["cid"]))
    return sets.filter("NOT again").union(once).select("cid", "n", "bits", "shingles")


def _children(key: F.Column, level: int) -> F.Column:
    """The children of a document at a node: the node with its minwise token of each function the node selects.

    Each level has functions of its own, so no path meets one twice.
    """
    own = TOKENS // LEVELS
    first = F.pmod(F.xxhash64(key, F.lit(level)), F.lit(own)).cast("int")
    step = F.pmod(F.xxhash64(key, F.lit(level), F.lit(1)), F.lit(own - 1)).cast("int") + 1
    places = [F.lit(level * own) + first, F.lit(level * own) + (first + step) % F.lit(own)]
    return F.array(*(F.xxhash64(key, at, F.get("tokens", at)) for at in places))


def final_nodes(classes: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(small, dense): rows (node, cid) of the nodes at which the trees end.

    A large node ends as dense when it keeps half of its parent, since two children
    of a row would then make its rows grow, or when a quarter of its probes look like
    its centres. So a group of near copies, however large, is settled where
    it first shows instead of being split level by level.
    """
    spark = classes.sparkSession
    total = classes.count()
    nothing = spark.createDataFrame([], "node long, cid long")
    small, dense = nothing, nothing
    level_rows = classes.select("cid", "tokens").select(
        "cid",
        F.explode(
            F.concat(*(_children(F.lit(t).cast("bigint"), 0) for t in range(TREES)))
        ).alias("node"),
    ).select("cid", "node", F.lit(total).cast("bigint").alias("parent_size"))
    for level in range(LEVELS):
        rows = checkpointed(level_rows)
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
        sized = checkpointed(rows.join(sizes, "node"))
        is_small = F.col("size") <= SMALL_NODE
        stays = (F.col("size") >= DENSE_SHARE * F.col("parent_size")) if level else F.lit(False)
        last = F.lit(level == LEVELS - 1)
        small = small.union(sized.filter(is_small).select("node", "cid"))
        dense = dense.union(sized.filter(~is_small & (stays | last)).select("node", "cid"))
        open_rows = sized.filter(~is_small & ~(stays | last))
        if open_rows.isEmpty():
            break
        alike = checkpointed(alike_nodes(open_rows, classes, percent))
        dense = dense.union(open_rows.join(alike, "node", "left_semi").select("node", "cid"))
        open_rows = open_rows.join(alike, "node", "left_anti")
        level_rows = (
            open_rows.join(classes.select("cid", "tokens"), "cid")
            .select(
                "cid", F.col("size").alias("parent_size"),
                F.explode(_children(F.col("node"), level + 1)).alias("node"),
            )
            .select("cid", "node", "parent_size")
        )
    return small, dense


def alike_nodes(rows: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The nodes of ``rows`` (node, cid) in which at least ``ALIKE_SHARE`` of a few probes look like a centre.

    Which way a node goes is all that probes decide; either way loses no pair.
    """
    probes = checkpointed(first_of_nodes(rows, PROBES))
    met = checkpointed(with_centers(probes.filter(F.col("at") > CENTERS), probes))
    close = likely(met.select("a", "b"), classes, percent).toDF("c", "d")
    links = met.join(close, (F.col("a") == F.col("c")) & (F.col("b") == F.col("d")), "left")
    shares = links.groupBy("node").agg(F.count("c").alias("n"), F.count(F.lit(1)).alias("of"))
    return shares.filter(F.col("n") >= ALIKE_SHARE * F.col("of")).select("node")


def small_pairs(small: DataFrame) -> DataFrame:
    """All pairs (a, b), a < b, within small nodes; a node has ``SMALL_NODE`` rows at most."""
    members = small.groupBy("node").agg(F.sort_array(F.collect_set("cid")).alias("m"))
    return members.select(F.explode("m").alias("a"), "m").select(
        "a", F.explode(F.filter("m", lambda x: x > F.col("a"))).alias("b")
    )


def first_of_nodes(rows: DataFrame, k: int) -> DataFrame:
    """(node, cid, at): the ``k`` most central members of each node, numbered from 1.

    The copy that others were made from has the minwise tokens that most of them have,
    so it lies in more and larger nodes than they do, and most of them are close to it.
    The order is the same for all nodes, so nodes with the same group of copies choose
    the same members, and pairs of them recur.
    """
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"))
    weights = rows.select("node", "cid").join(sizes, "node").groupBy("cid").agg(F.sum("size").alias("weight"))
    drawn = Window.partitionBy("node").orderBy(F.desc("weight"), F.xxhash64("cid"), "cid")
    weighed = rows.select("node", "cid").join(weights, "cid")
    return weighed.select("node", "cid", F.row_number().over(drawn).alias("at")).filter(F.col("at") <= k)


def with_centers(rows: DataFrame, first: DataFrame) -> DataFrame:
    """``rows`` (node, cid) each with the centres of its node, the first members, as pairs (a, b), a < b."""
    centers = first.filter(F.col("at") <= CENTERS).select(F.col("node").alias("of"), F.col("cid").alias("center"))
    met = rows.join(centers, F.col("node") == F.col("of")).filter(F.col("cid") != F.col("center"))
    return met.select("node", F.least("cid", "center").alias("a"), F.greatest("cid", "center").alias("b"))


def star_pairs(dense: DataFrame) -> DataFrame:
    """Each member of a dense node with its centres."""
    return with_centers(dense, first_of_nodes(dense, CENTERS)).select("a", "b")


def by_component(dense: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, cid, comp, top, share): the node's largest component and its share of the node's rows."""
    named = dense.join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    per_comp = named.groupBy("node", "comp").agg(F.count(F.lit(1)).alias("n"))
    largest = per_comp.groupBy("node").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("size"))
    largest = largest.select("node", F.col("top.comp").alias("top"), (F.col("top.n") / F.col("size")).alias("share"))
    return named.join(largest, "node").select("node", "cid", "comp", "top", "share")


def few_apart(x: str, y: str, percent: int) -> F.Column:
    """Whether parity bits allow two sets, with ``_n`` and ``_bits`` after their names, to be similar; no similar pair fails."""
    apart = F.lit(0)
    for i in range(PARITY_BITS // 64):
        apart = apart + F.bit_count(F.get(f"{x}_bits", F.lit(i)).bitwiseXOR(F.get(f"{y}_bits", F.lit(i))))
    return apart * (100 + percent) <= (F.col(f"{x}_n") + F.col(f"{y}_n")) * (100 - percent)


def settling_pairs(dense: DataFrame, labels: DataFrame, sets: DataFrame, percent: int, turn: int) -> DataFrame:
    """Members outside a node's largest component with some members inside it, others each turn, if their bits allow it.

    Near copies of one text need not be near their centres, but each is near many of
    the others, so few of them are left for the exact join. Nodes without a component
    of some size have nothing to settle into.
    """
    named = by_component(dense, labels).filter(F.col("share") >= SETTLED_SHARE)
    named = checkpointed(named.join(sets.select("cid", "n", "bits"), "cid"))

    def side(where: F.Column, name: str) -> DataFrame:
        own = [F.col(c).alias(new) for c, new in (("cid", name), ("n", f"{name}_n"), ("bits", f"{name}_bits"))]
        return named.filter(where).select(F.col("node").alias(f"{name}_node"), *own)

    drawn = Window.partitionBy("y_node").orderBy(F.xxhash64(F.lit(turn), "y"), "y")
    some = side(F.col("comp") == F.col("top"), "y").withColumn("at", F.row_number().over(drawn)).filter(F.col("at") <= SETTLERS)
    same_node = F.col("x_node") == F.col("y_node")
    met = side(F.col("comp") != F.col("top"), "x").join(some, same_node).filter(few_apart("x", "y", percent))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def unsettled(dense: DataFrame, labels: DataFrame) -> DataFrame:
    """(cid, comp) of members that some dense node holds outside its largest component."""
    return by_component(dense, labels).filter(F.col("comp") != F.col("top")).select("cid", "comp").distinct()


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(cid, token, at, n): the rarest tokens of each set of ``n``; similar sets share at least one.

    A set that reaches the threshold with another has at most ``100 - percent``
    per cent of its tokens outside it, so among one more than that, taken in an
    order that is the same for all sets, one is shared.
    """
    tokens = sets.select("cid", F.explode("shingles").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    ordered = tokens.join(counts, "token").groupBy("cid").agg(
        F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t")
    )
    least = F.ceil(F.size("t") * F.lit(percent) / 100).cast("int")
    rarest = F.slice("t", F.lit(1), F.size("t") - least + 1)
    return ordered.select("cid", F.size("t").alias("n"), F.posexplode(rarest).alias("at", "x")).select(
        "cid", "x.token", "at", "n"
    )


def open_pairs(dense: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs that may be similar of an unsettled member and a member of another component.

    A pair comes once for each of the rarest tokens it shares. Nothing is left to chance.
    """
    rest = checkpointed(unsettled(dense, labels))
    named = dense.select("cid").distinct().join(labels, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    members = checkpointed(named.join(sets.select("cid", "bits"), "cid"))
    chosen = checkpointed(prefixes(sets.join(members, "cid", "left_semi"), percent))

    def side(of: DataFrame, name: str) -> DataFrame:
        own = {"cid": name, "comp": f"{name}_comp", "at": f"{name}_at", "n": f"{name}_n", "bits": f"{name}_bits"}
        return chosen.join(of, "cid").select("token", *(F.col(c).alias(new) for c, new in own.items()))

    one, two = side(members.join(rest.select("cid"), "cid", "left_semi"), "x"), side(members, "y")
    # No token before the first shared one is shared, so from it on enough tokens must be left.
    left, total = F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at")), F.col("x_n") + F.col("y_n")
    enough = left * (100 + percent) >= total * percent
    differ = F.col("x_comp") != F.col("y_comp")
    met = one.join(two, "token").filter(differ & enough & few_apart("x", "y", percent))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs that sizes and minwise tokens allow to be similar."""

    def side(name: str) -> DataFrame:
        return classes.select(
            F.col("cid").alias(name), F.col("tokens").alias(f"t_{name}"), F.col("n_shingles").alias(f"n_{name}")
        )

    both = pairs.distinct().join(side("a"), "a").join(side("b"), "b")
    agree = F.size(F.filter(F.zip_with("t_a", "t_b", lambda x, y: x == y), lambda s: s))
    fits = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    return both.filter(fits).filter(agree >= LEAST_AGREE).select("a", "b")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    one = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("s_a"))
    two = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("s_b"))
    both = pairs.join(one, "a").join(two, "b")
    shared = both.select(
        "a", "b", F.size(F.array_intersect("s_a", "s_b")).alias("i"), (F.size("s_a") + F.size("s_b")).alias("s")
    )
    return shared.filter(F.col("i") * 100 >= (F.col("s") - F.col("i")) * percent).select("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(cid, comp) for all ends of edges; comp is the smallest cid reachable.

    Each round a label takes the smallest label next to it, and that one's in
    turn; then the edges are drawn between the new labels. Edges within a label
    vanish, so what a round joins shrinks fast, however dense a group was.
    """
    now = checkpointed(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    ends = now.select(F.col("u").alias("cid")).union(now.select("v")).distinct()
    labels = checkpointed(ends.withColumn("comp", F.col("cid")))
    while not now.isEmpty():
        both = now.union(now.select("v", "u"))
        near = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("to"))
        far = near.select(F.col("u").alias("to"), F.col("to").alias("far"))
        step = checkpointed(near.join(far, "to").select("u", F.least("to", "far").alias("to")))
        moved = step.select(F.col("u").alias("comp"), "to")
        labels = checkpointed(
            labels.join(moved, "comp", "left").select("cid", F.coalesce("to", "comp").alias("comp"))
        )
        one = now.join(step, "u").select(F.col("to").alias("x"), "v")
        two = one.join(step.withColumnRenamed("u", "v"), "v").select("x", F.col("to").alias("y"))
        now = checkpointed(
            two.filter(F.col("x") != F.col("y"))
            .select(F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))
            .distinct()
        )
    return labels


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash for each row of ``docs``."""
    rows = checkpointed(described(docs, text, doc_id, words))
    grouped = rows.filter(F.col("n_shingles") > 0).groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("tokens").alias("tokens"),
        (F.count(F.lit(1)) > 1).alias("again"),
    )
    classes = checkpointed(grouped.withColumn("cid", F.monotonically_increasing_id()))
    small, dense = final_nodes(classes, percent)
    dense = checkpointed(dense)
    pairs = checkpointed(likely(small_pairs(small).union(star_pairs(dense)), classes, percent))

    ends = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).union(dense.select("cid")).distinct()
    wanted = classes.join(ends, "cid", "left_semi").select("cid", "rep", "k1", "k2", "again")
    sets = shingle_sets(docs, wanted, text, doc_id, words)
    edges = checkpointed(confirmed(pairs, sets, percent))
    labels = components(edges)
    if not dense.isEmpty():
        for turn in range(SETTLING_TURNS):
            found = checkpointed(confirmed(settling_pairs(dense, labels, sets, percent, turn), sets, percent))
            if found.isEmpty():
                break
            edges = checkpointed(edges.union(found))
            labels = components(edges)
        more = checkpointed(open_pairs(dense, labels, sets, percent).distinct())
        edges = edges.union(confirmed(more, sets, percent))
        labels = components(edges)
    named = classes.select("k1", "k2", "cid", "rep").join(labels, "cid", "left").withColumn(
        "comp", F.coalesce("comp", "cid")
    )
    firsts = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    by_key = named.join(firsts, "comp").select("k1", "k2", "component_id")
    alone = rows.filter(F.col("n_shingles") == 0).withColumn("component_id", F.col("doc_id"))
    linked = rows.filter(F.col("n_shingles") > 0).join(by_key, ["k1", "k2"])
    columns = ["doc_id", "n_shingles", "component_id", "text_hash"]
    judged = linked.select(columns).union(alone.select(columns))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return judged.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "text_hash")


def one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) of which no near duplicate has a smaller id.

    Rows that repeat id and text stay once. A group without any id keeps its rows.
    """
    judged = checkpointed(near_duplicates(docs, words, percent))
    gone = judged.filter(~F.col("kept") & F.col("component_id").isNotNull()).select("doc_id", "text_hash").distinct()
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
    rows = packed(docs, id=F.col("doc_id").cast("bigint"), hash=F.xxhash64(whole(F.col("text"))))
    left = rows.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("hash") == F.col("gone_hash")), "left_anti")
    repeated = judged.filter("kept").groupBy(F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash")).count()
    repeated = checkpointed(repeated.filter("count > 1").drop("count"))
    if repeated.isEmpty():
        return left.select("row.*")
    same = (F.col("id") == F.col("r_id")) & (F.col("hash") == F.col("r_hash"))
    once = left.join(repeated, same, "left_semi").dropDuplicates(["id", "hash"])
    return left.join(repeated, same, "left_anti").union(once).select("row.*")


def op7_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), words=4).drop("text_hash")
