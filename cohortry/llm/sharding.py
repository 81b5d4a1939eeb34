"""Shards of near equal bytes by Karmarkar-Karp differencing.

Rows that must stay together (equal texts) form an indivisible group. The
groups are spread over buckets by hash; in each bucket the two partial
partitions with the largest spread are combined in opposite order, again and
again, until one partition into ``shards`` parts is left. Its part sums are one
vector per bucket. Those vectors are differenced in the same way, many buckets
per task, level by level, until one partition is left. No task and no driver
ever holds more than ``fan_in`` partitions, whatever the size of the table.

A group that is large next to a bucket cannot be offset in it, nor by the other
buckets, as their parts are even. So large groups are kept out of the buckets
and differenced first. Each bucket then starts from its share of what they
put into each shard, and fills up what they left. Places stay as they are then:
the part sums of such buckets are added as they stand.

Defined cases: a NULL text counts as the empty text; a NULL id is an ordinary
value; repeated rows are separate rows of one group; an empty table gives no
rows; a group larger than an ideal shard fills a shard alone. Only the named
columns are read, so other columns may have any name.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.llm.common import packed, table, whole
from cohortry.session import checkpointed

SHARDS = 16
FAN_IN = 4096
ROWS_PER_RUN = 20_000
# How often the bound for large groups is taken anew from what is left.
LARGE_ROUNDS = 4


def difference(vectors: list[list[int]], parts: int) -> list[list[int]]:
    """Karmarkar-Karp over partial partitions given by their part sums.

    Returns for each input, for each of its parts, the part of the final
    partition into which it goes. Ties are broken by input order.
    """
    heap: list[tuple[int, int, list[int]]] = []
    for i, sums in enumerate(vectors):
        heap.append((min(sums) - max(sums), i, sums))
    heapq.heapify(heap)
    merges: list[tuple[int, list[int], int, list[int]]] = []
    n = len(vectors)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        # The largest part of one meets the smallest part of the other.
        down = sorted(range(parts), key=left.__getitem__, reverse=True)
        up = sorted(range(parts), key=right.__getitem__)
        sums = [left[x] + right[y] for x, y in zip(down, up, strict=True)]
        heapq.heappush(heap, (min(sums) - max(sums), n + len(merges), sums))
        merges.append((a, down, b, up))
    placed: dict[int, list[int]] = {heap[0][1]: list(range(parts))} if heap else {}
    for k in range(len(merges) - 1, -1, -1):
        a, down, b, up = merges[k]
        final = placed.pop(n + k)
        for child, order in ((a, down), (b, up)):
            to = [0] * parts
            for position, part in enumerate(order):
                to[part] = final[position]
            placed[child] = to
    return [placed[i] for i in range(n)]


def _difference_bucket(parts: int):
    """One task's work: the rows of a bucket to the final part of each of their parts."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["child"], kind="stable").reset_index(drop=True)
        vectors = [[int(x) for x in v] for v in rows["sums"]]
        places = difference(vectors, parts)
        totals = [0] * parts
        for vector, place in zip(vectors, places, strict=True):
            for part, to in enumerate(place):
                totals[to] += vector[part]
        return pd.DataFrame(
            {"node": rows["node"], "child": rows["child"], "place": places, "totals": [totals] * len(rows)}
        )

    return run


def _fill_bucket(parts: int, taken: list[int], rest: int):
    """One task's work: the groups of a bucket to parts, so that they fill up what ``taken`` leaves."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["g1", "g2"], kind="stable").reset_index(drop=True)
        mine = [int(b) for b in rows["bytes"]]
        share = sum(mine)
        places = difference([[t * share // rest for t in taken]] + [[b] + [0] * (parts - 1) for b in mine], parts)
        part_of = {to: part for part, to in enumerate(places[0])}
        return pd.DataFrame({"g1": rows["g1"], "g2": rows["g2"], "shard": [part_of[p[0]] for p in places[1:]]})

    return run


def large_bound(groups: DataFrame, count: int, shards: int, fan_in: int) -> tuple[float, int]:
    """(bound, bytes below it): groups above the bound are no even filling of a bucket's parts.

    The bound is a bucket's ideal part of what is not above it. Each round adds
    fewer than ``most`` groups, so all of them are fewer than the groups.
    """
    most = min(shards, fan_in // 16) * -(-count // fan_in)
    total = groups.agg(F.sum("bytes").alias("n")).first()["n"] or 0
    bound, rest = float("inf"), total
    for _ in range(LARGE_ROUNDS if most else 0):
        if not rest or rest / most >= bound:
            break
        bound = rest / most
        below = groups.filter(F.col("bytes") <= bound).agg(F.sum("bytes").alias("n")).first()["n"] or 0
        if below == rest:
            break
        rest = below
    return bound, rest


def water_level(sums: list[int], rest: int) -> float:
    """The height to which ``rest`` fills parts of the given sums."""
    filled = 0
    for n, s in enumerate(sorted(sums)):
        if n and s * n - filled >= rest:
            return (filled + rest) / n
        filled += s
    return (filled + rest) / len(sums)


def group_parts(groups: DataFrame, shards: int = SHARDS, fan_in: int = FAN_IN) -> DataFrame:
    """Rows (g1, g2, bytes), one per group, to (g1, g2, shard), large groups first."""
    count = groups.count()
    if count > fan_in:
        groups = checkpointed(groups)
        bound, rest = large_bound(groups, count, shards, fan_in)
        large = groups.filter(F.col("bytes") > bound)
        if rest and not large.isEmpty():
            placed = checkpointed(group_parts(large, shards, fan_in).select("g1", "g2", "shard"))
            sums = placed.join(large, ["g1", "g2"]).groupBy("shard").agg(F.sum("bytes").alias("n")).collect()
            filled = [0] * shards
            for row in sums:
                filled[row["shard"]] = row["n"]
            level = water_level(filled, rest)
            taken = [int(min(f, level)) for f in filled]
            small = groups.filter(F.col("bytes") <= bound)
            nodes = -(-small.count() // fan_in)
            fill = _fill_bucket(shards, taken, rest)
            dealt = small.withColumn("node", F.pmod(F.col("g1"), F.lit(nodes))).groupBy("node")
            return placed.union(dealt.applyInPandas(fill, "g1 long, g2 long, shard int"))
    return parts_by_levels(groups, count, shards, fan_in)


def parts_by_levels(groups: DataFrame, count: int, shards: int, fan_in: int) -> DataFrame:
    """(g1, g2, shard) by levels of differencing."""
    result = "node long, child string, place array<int>, totals array<long>"
    zeros = F.array_repeat(F.lit(0).cast("bigint"), shards - 1)
    nodes = max(1, -(-count // fan_in))
    level = groups.select(
        F.pmod(F.col("g1"), F.lit(nodes)).alias("node"),
        F.concat_ws(":", "g1", "g2").alias("child"),
        F.concat(F.array("bytes"), zeros).alias("sums"),
    )
    done = checkpointed(level.groupBy("node").applyInPandas(_difference_bucket(shards), result))
    leaves = done.select("child", F.col("place")[0].alias("part"), "node")
    while nodes > 1:
        above = max(1, -(-nodes // fan_in))
        level = (
            done.groupBy("node").agg(F.first("totals").alias("sums"))
            .select(
                F.pmod(F.xxhash64("node"), F.lit(above)).alias("node"),
                F.col("node").cast("string").alias("child"), "sums",
            )
        )
        done = checkpointed(level.groupBy("node").applyInPandas(_difference_bucket(shards), result))
        up = done.select(
            F.col("child").cast("bigint").alias("node"), "place", F.col("node").alias("parent")
        )
        leaves = leaves.join(up, "node").select(
            "child", F.col("place")[F.col("part")].alias("part"), F.col("parent").alias("node")
        )
        nodes = above
    ends = F.split("child", ":")
    return leaves.select(
        ends[0].cast("bigint").alias("g1"), ends[1].cast("bigint").alias("g2"), F.col("part").cast("int").alias("shard")
    )


def number_within(rows: DataFrame, shard: str, order: list[str], per_run: int = ROWS_PER_RUN) -> DataFrame:
    """Add ``slot``, gapless from 0 in each shard.

    A shard is cut into runs by a hash of the row, so that no task sorts a
    whole shard; the sizes of earlier runs are added to the number in the run.
    """
    runs = max(1, -(-rows.count() // per_run))
    rows = rows.withColumn("_run", F.pmod(F.xxhash64(*order), F.lit(runs)))
    sizes = rows.groupBy(shard, "_run").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(shard).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(shard, "_run", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(shard, "_run").orderBy(*order)
    return (
        rows.withColumn("_at", F.row_number().over(inside) - 1)
        .join(starts, [shard, "_run"])
        .withColumn("slot", F.col("_start") + F.col("_at"))
        .drop("_run", "_at", "_start")
    )


def sized_rows(docs: DataFrame, text: str) -> DataFrame:
    """Rows as structs with the size of their text and the two hashes, of different seeds, that name it."""
    body = whole(F.col(f"`{text}`"))
    return packed(
        docs, size=(F.octet_length(body) + F.lit(1)).cast("bigint"), g1=F.xxhash64(body), g2=F.xxhash64(F.lit(9), body)
    )


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, fan_in: int = FAN_IN, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per row of ``docs``."""
    body = whole(F.col(text))
    sized = checkpointed(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            (F.octet_length(body) + F.lit(1)).cast("bigint").alias("size"),
            F.crc32(body.cast("binary")).alias("text_crc32"),
            # Two hashes with different seeds name a text.
            F.xxhash64(body).alias("g1"),
            F.xxhash64(F.lit(9), body).alias("g2"),
        )
    )
    groups = sized.groupBy("g1", "g2").agg(F.sum("size").alias("bytes"))
    placed = checkpointed(
        sized.join(group_parts(groups, shards, fan_in), ["g1", "g2"]).select(
            "doc_id", "size", "text_crc32", "shard"
        )
    )
    return number_within(placed, "shard", ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, fan_in: int = FAN_IN, text: str = "text") -> None:
    """Write the rows of ``docs``, texts and all, below ``path``, one folder per shard.

    A row finds its shard by its text, the group that shards keep together, so rows
    that repeat an id stay as many as they are. A column named shard is replaced.
    """
    named = sized_rows(docs.drop("shard"), text)
    groups = checkpointed(named.groupBy("g1", "g2").agg(F.sum("size").alias("bytes")))
    parts = checkpointed(group_parts(groups, shards, fan_in).select("g1", "g2", F.col("shard").cast("int").alias("_shard")))
    placed = named.join(parts, ["g1", "g2"]).select("row.*", "_shard")
    placed.withColumnRenamed("_shard", "shard").write.partitionBy("shard").parquet(path)


def op9_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents"))
