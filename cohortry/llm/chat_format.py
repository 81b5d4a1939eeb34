"""Chat formatting as prefix trees: initial turns that conversations share are emitted once.

Every turn is written by a template that depends on that turn alone: control
strings mark where it begins and ends, and control strings inside a text are
escaped so that they can be told apart and brought back. A turn's node in the tree
is named by all turns up to it: hashes of role and text, salted with their place,
are summed along the conversation, in sorted ranges that carry their sums along, so
that a conversation of any length is shared by many tasks. Nodes through which the
same conversations pass form a segment; conversations end where segments end, so a
conversation is its last segment, and copies are one row from there on.

Sorting the paths of segments puts the tree in depth-first order. A running sum of
tokens in that order places each node in the one sequence of its tree: siblings
follow each other, a child comes after its parent, and what is shared stands once.
A node's position id goes on from its parent's, whatever lies between them in the
sequence, and it attends to the intervals of its ancestors and to itself.

A path has no more than about the square root of twice the rows as segments, since
each further branching needs a conversation at least as long as the path so far.

Reading back takes what was emitted, in depth-first order, in blocks of leaves: a
stack of running digests follows the path, so shared nodes are decoded once a
block. Nodes above a block's first leaf are handed to it, one path per block.

Defined cases: NULL roles and texts are empty ones; a NULL conversation id is one
more conversation; rows of one turn are ordered by their hashes, a NULL turn is
first, and repeated rows are turns of their own; an empty table gives no rows; long
texts are encoded in pieces of ``PIECE`` code points; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortry.llm.common import table, whole
from cohortry.operators.ranking import null_safe_join, number_rows, ranges_for, running_total
from cohortry.session import checkpointed

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MOST_VOCABULARY_BYTES = 64 * 2**20
PIECE = 4096
BLOCK_LEAVES = 1000
PROBE = "</s>[INST] ok [/INST]"

# The pattern that parts a text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# The control strings that open and close a turn of each role; the last are for any other role.
MARKS = {
    "user": ("[INST]", "[/INST]"),
    "system": ("<<SYS>>", "<</SYS>>"),
    "assistant": ("<s>", "</s>"),
}
OPEN_OTHER, NAME_ENDS, CLOSE_OTHER = "[ROLE]", "[SAYS]", "[/ROLE]"
CONTROLS = [m for pair in MARKS.values() for m in pair] + [OPEN_OTHER, NAME_ENDS, CLOSE_OTHER]
LEARNED = "assistant"

# One more of this sign after the first sign of a control string escapes it, whatever number is there already.
ESCAPE = "\u2060"
_FORMS = "|".join(f"(?<={re.escape(c[0])}){{}}(?={re.escape(c[1:])})" for c in CONTROLS)
_PLAIN = re.compile(_FORMS.replace("{}", f"{ESCAPE}*"))
_ESCAPED = re.compile(_FORMS.replace("{}", f"{ESCAPE}+"))


def escaped(text: str) -> str:
    """The text without control strings; ``unescaped`` brings it back."""
    return _PLAIN.sub(lambda m: m[0] + ESCAPE, text)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][:-1], text)


def parts_of(role: str, text: str) -> tuple[list[str], str, str]:
    """(opening strings, text, closing string) of a turn; openings alternate control string and escaped name."""
    if role in MARKS:
        return [MARKS[role][0]], escaped(text), MARKS[role][1]
    return [OPEN_OTHER, escaped(role), NAME_ENDS], escaped(text), CLOSE_OTHER


def parsed(turn: str) -> tuple[str, str]:
    """(role, text) of a formatted turn."""
    for role, (start, end) in MARKS.items():
        if turn.startswith(start) and turn.endswith(end):
            return role, unescaped(turn[len(start) : -len(end)])
    if not (turn.startswith(OPEN_OTHER) and turn.endswith(CLOSE_OTHER) and NAME_ENDS in turn):
        raise ValueError(f"not a turn: {turn[:40]!r}")
    role, _, text = turn[len(OPEN_OTHER) : -len(CLOSE_OTHER)].partition(NAME_ENDS)
    return unescaped(role), unescaped(text)


class Codec:
    """Tokens of texts by a public byte-level vocabulary, and one more token for each control string."""

    def __init__(self, ranks_file: bytes) -> None:
        lines = (line.split() for line in ranks_file.splitlines() if line)
        ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        first = max(ranks.values(), default=-1) + 1
        self.encoding = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.controls = {c: first + i for i, c in enumerate(CONTROLS)}
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.bytes_of |= {rank: c.encode() for c, rank in self.controls.items()}

    def encode(self, text: str) -> list[int]:
        if len(text) <= PIECE:
            return self.encoding.encode_ordinary(text)
        return [t for at in range(0, len(text), PIECE) for t in self.encoding.encode_ordinary(text[at : at + PIECE])]

    def decode(self, tokens: Sequence[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, tokens)).decode("utf-8", "surrogatepass")

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """(tokens, first, end): a formatted turn and which of its tokens the loss is taken on, none if first is end."""
        opening, body, closing = parts_of(role, text)
        tokens = [self.controls[opening[0]]]
        if len(opening) > 1:
            tokens += self.encode(opening[1]) + [self.controls[opening[2]]]
        first = len(tokens)
        tokens += self.encode(body)
        end = len(tokens) if role == LEARNED else first
        return tokens + [self.controls[closing]], first, end


@lru_cache(maxsize=2)
def codec_of(ranks_file: bytes) -> Codec:
    """One codec per Python worker and vocabulary."""
    return Codec(ranks_file)


def ranks_of(path: str) -> bytes:
    """The vocabulary file, read on the driver; it is broadcast, so its size is checked."""
    with open(path, "rb") as file:
        found = file.read(MOST_VOCABULARY_BYTES + 1)
    if len(found) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path} has more than {MOST_VOCABULARY_BYTES} bytes")
    return found


def prepared(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, text, h1, h2): h1 and h2 together name role and text."""
    named = rows.select(
        F.col("conv_id").alias("conv"), "turn", whole(F.col("role")).alias("role"), whole(F.col("text")).alias("text")
    )
    return named.withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64(F.lit(1), "text", "role")})


def turn_tokens(turns: DataFrame, vocabulary: str) -> DataFrame:
    """(h1, h2, tokens, n_tokens, loss_from, loss_to): each different turn encoded once."""
    shared = turns.sparkSession.sparkContext.broadcast(ranks_of(vocabulary))
    names = ["h1", "h2", "tokens", "n_tokens", "loss_from", "loss_to"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                made = [codec.turn(r, t) for r, t in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)]
                tokens, first, end = zip(*made, strict=True)
                columns = [
                    part.column(0), part.column(1), pa.array(tokens, pa.list_(pa.int32())),
                    pa.array(map(len, tokens), pa.int64()), pa.array(first, pa.int32()), pa.array(end, pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    once = turns.select("h1", "h2", "role", "text").dropDuplicates(["h1", "h2"])
    return once.mapInArrow(run, "h1 long, h2 long, tokens array<int>, n_tokens long, loss_from int, loss_to int")


def carried(cut: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Add running sums along each conversation to rows that lie in sorted ranges (chunk, place)."""
    inside = Window.partitionBy("chunk", "conv").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    weighed = cut.withColumns({f"_{n}": c for n, c in sums.items()})
    per_range = weighed.groupBy("chunk", "conv").agg(*(F.sum(f"_{n}").alias(f"_{n}") for n in sums))
    before = per_range.select(
        "chunk", "conv", *(F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums)
    )
    here = weighed.withColumns({n: F.sum(f"_{n}").over(inside) for n in sums})
    joined = null_safe_join(here, before, ["chunk", "conv"])
    return joined.select(*cut.columns, *((F.col(n) + F.col(f"_before_{n}")).alias(n) for n in sums))


def placed(turns: DataFrame) -> DataFrame:
    """(chunk, place, conv, h1, h2, at, n1, n2, m1, m2): place of each turn, keys of its node and of that node's parent."""
    order = ["conv", "turn", "h1", "h2"]
    slim = turns.select(*order)
    ranged = slim.repartitionByRange(ranges_for(slim), *order).sortWithinPartitions(*order)
    # The lower 33 bits of this id count the rows of a partition.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    cut = checkpointed(ranged.withColumns({"chunk": F.spark_partition_id(), "place": place}))
    numbered = carried(cut.drop("turn"), {"upto": F.lit(1).cast("long")}).withColumn("at", F.col("upto") - 1).drop("upto")
    # Sums of 32-bit halves stay in range for 2^31 turns.
    low, high = F.lit(2**32 - 1), 32
    salted = {s: F.xxhash64(F.lit(s), "at", "h1", "h2") for s in (1, 2)}
    halves = {f"a{s}": h.bitwiseAND(low) for s, h in salted.items()} | {f"b{s}": F.shiftrightunsigned(h, high) for s, h in salted.items()}
    summed = carried(checkpointed(numbered), halves)
    own = {n: F.col(n) - c for n, c in halves.items()}
    names = sorted(halves)
    return summed.select(
        *cut.drop("turn").columns, "at",
        F.xxhash64("at", *names).alias("n1"), F.xxhash64(*names, F.lit(7), "at").alias("n2"),
        F.xxhash64(F.col("at") - 1, *(own[n] for n in names)).alias("m1"),
        F.xxhash64(*(own[n] for n in names), F.lit(7), F.col("at") - 1).alias("m2"),
    )


@dataclass(frozen=True)
class Trees:
    """``nodes``: (tree, start, position, n_tokens, attends, ...) and tokens; ``conversations``: (conv_id, leaf, n_turns).

    ``leaf`` numbers different conversations in depth-first order. Node columns: tree, start (place of the first
    token in the tree's sequence), position (id of the first token), tokens, loss_from and loss_to (tokens of the
    node under the loss mask), attends (intervals of earlier tokens it sees), at (turn), segment (depth of its
    segment), opens (first of its segment), leaf (the first it belongs to), last_leaf.
    """

    nodes: DataFrame
    conversations: DataFrame


def joined_up(intervals: Column) -> Column:
    """Sorted intervals with those that touch made one; empty ones go."""

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        grown = F.struct(last["from"].alias("from"), x["to"].alias("to"))
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["to"] == x["from"])
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(touches, F.concat(shorter, F.array(grown))).otherwise(F.concat(done, F.array(x)))

    some = F.filter(intervals, lambda x: x["to"] > x["from"])
    return F.aggregate(some, F.array().cast("array<struct<from:bigint,to:bigint>>"), add)


def prefix_trees(rows: DataFrame, vocabulary: str = VOCABULARY) -> Trees:
    """The trees of all conversations in ``rows`` (conv_id, turn, role, text)."""
    turns = prepared(rows)
    tokens = checkpointed(turn_tokens(turns, vocabulary))
    placed_rows = checkpointed(placed(turns))

    # How many conversations pass through a node; a segment opens where that number changes.
    through = placed_rows.groupBy("n1", "n2").agg(F.count(F.lit(1)).alias("through"), F.min("m1").alias("m1"), F.min("m2").alias("m2"))
    through = checkpointed(through)
    above = through.select(F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("through").alias("above"))
    opened = through.join(above, (F.col("m1") == F.col("p1")) & (F.col("m2") == F.col("p2")), "left").select(
        F.col("n1").alias("o1"), F.col("n2").alias("o2"), (~F.col("through").eqNullSafe(F.col("above"))).alias("opens")
    )
    with_flag = placed_rows.join(opened, (F.col("n1") == F.col("o1")) & (F.col("n2") == F.col("o2"))).drop("o1", "o2")
    flagged = checkpointed(carried(with_flag, {"depth": F.col("opens").cast("long")}))

    # A conversation is the path of its segments, named by their first nodes; its last one names it.
    steps = flagged.filter("opens").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("depth", "n1", "n2"))).alias("path"))
    lengths = flagged.groupBy("conv").agg(F.count(F.lit(1)).alias("n_turns"))
    ends = F.element_at("path", -1)
    paths = checkpointed(
        null_safe_join(steps, lengths, ["conv"]).select(
            "conv", "n_turns", ends["n1"].alias("l1"), ends["n2"].alias("l2"),
            F.transform("path", lambda s: F.struct(s["n1"].alias("n1"), s["n2"].alias("n2"))).alias("path"),
        )
    )
    leaves = number_rows(paths.select("l1", "l2", "path").dropDuplicates(["l1", "l2"]), ["path"], "leaf")
    leaves = checkpointed(leaves)
    conversations = paths.drop("path").join(leaves.drop("path"), ["l1", "l2"]).select(
        F.col("conv").alias("conv_id"), "leaf", "n_turns"
    )

    root = F.col("path")[0]
    each = leaves.select("leaf", root["n1"].alias("t1"), root["n2"].alias("t2"), F.posexplode("path").alias("depth", "s"))
    on_path = checkpointed(each.select("leaf", "depth", "t1", "t2", F.col("s.n1").alias("s1"), F.col("s.n2").alias("s2")))
    segments = on_path.groupBy("s1", "s2").agg(
        F.min("leaf").alias("leaf"), F.max("leaf").alias("last_leaf"), F.min("t1").alias("t1"), F.min("t2").alias("t2"),
        F.min("depth").alias("depth"),
    )

    # A node's segment is the one that any of its conversations has at that depth.
    opening = flagged.filter("opens").select("conv", "depth", F.col("n1").alias("s1"), F.col("n2").alias("s2"))
    nodes = null_safe_join(flagged, opening, ["conv", "depth"]).groupBy("n1", "n2").agg(
        *(F.min(c).alias(c) for c in ("at", "h1", "h2", "s1", "s2")), F.max("opens").alias("opens")
    )
    sizes = tokens.select("h1", "h2", "n_tokens")
    ordered = running_total(
        nodes.join(segments, ["s1", "s2"]).join(sizes, ["h1", "h2"]), ["t1", "t2"], ["leaf", "at"], "n_tokens"
    ).withColumn("start", F.col("running") - F.col("n_tokens"))
    ordered = checkpointed(ordered.drop("running", "total", "n1", "n2"))

    # Segments lie in one piece: what a node sees is its ancestors' segments, and its own up to the node.
    lying = checkpointed(ordered.groupBy("s1", "s2").agg(F.min("start").alias("from"), F.sum("n_tokens").alias("n"), F.min("leaf").alias("first")))
    walk = Window.partitionBy("leaf").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    ancestry = on_path.select("leaf", "depth", "s1", "s2").join(lying, ["s1", "s2"]).withColumns(
        {
            "begins": F.coalesce(F.sum("n").over(walk), F.lit(0)),
            "ancestors": F.collect_list(F.struct("from", (F.col("from") + F.col("n")).alias("to"))).over(walk),
        }
    )
    ancestry = ancestry.filter(F.col("leaf") == F.col("first")).select("s1", "s2", "from", "begins", "ancestors")
    own = F.struct("from", F.col("start").alias("to"))
    described = ordered.join(ancestry, ["s1", "s2"]).select(
        F.concat_ws("-", F.hex("t1"), F.hex("t2")).alias("tree"), "start",
        (F.col("begins") + F.col("start") - F.col("from")).alias("position"), "n_tokens",
        joined_up(F.concat("ancestors", F.array(own))).alias("attends"),
        "at", F.col("depth").alias("segment"), "opens", "leaf", "last_leaf", "h1", "h2",
    )
    return Trees(described.join(tokens.drop("n_tokens"), ["h1", "h2"]).drop("h1", "h2"), conversations)


class Reading:
    """Digests of a conversation as far as it has been read."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = self.n_tokens = 0

    def branch(self) -> Reading:
        other = Reading.__new__(Reading)
        other.__dict__ |= self.__dict__
        other.turns, other.loss = self.turns.copy(), self.loss.copy()
        return other

    def read(self, codec: Codec, tokens: list[int], first: int, end: int) -> None:
        formatted = codec.decode(tokens)
        role, text = parsed(formatted)
        learned = unescaped(codec.decode(tokens[first:end]))
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.loss.update(learned.encode("utf-8", "surrogatepass"))
        self.n_turns += 1
        self.loss_chars += len(learned)
        self.formatted_chars += len(formatted)
        self.n_tokens += len(tokens)

    def digest(self) -> tuple:
        return (
            self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars, self.n_tokens
        )


READ = (
    "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long"
)


def read_back(trees: Trees, vocabulary: str = VOCABULARY, block_leaves: int = BLOCK_LEAVES) -> DataFrame:
    """Per conversation what its tokens say: its id, then n_turns to formatted_chars and n_tokens."""
    spark = trees.nodes.sparkSession
    shared = spark.sparkContext.broadcast(ranks_of(vocabulary))
    block = lambda leaf: F.floor(F.col(leaf) / block_leaves).cast("long")
    nothing = {"tokens": F.lit(None).cast("array<int>"), "loss_from": F.lit(0), "loss_to": F.lit(0)}
    shape = ["block", "leaf", "kind", "at", "segment", "opens", "tokens", "loss_from", "loss_to"]
    # A node goes to each block that has leaves below it.
    emitted = trees.nodes.withColumns({"block": F.explode(F.sequence(block("leaf"), block("last_leaf"))), "kind": F.lit(0)})
    ends = trees.conversations.select("leaf").distinct().withColumns(
        {"block": block("leaf"), "kind": F.lit(1), "at": F.lit(0).cast("long"), "segment": F.lit(0), "opens": F.lit(False), **nothing}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, block_now = codec_of(shared.value), None
        stack: list[Reading] = []
        for batch in batches:
            found = []
            for start in range(0, batch.num_rows, 256):
                for number, leaf, kind, _, depth, opens, tokens, first, end in zip(
                    *(c.to_pylist() for c in batch.slice(start, 256).columns), strict=True
                ):
                    if number != block_now:
                        block_now, stack = number, []
                    if kind:
                        found.append((leaf, *stack[-1].digest()))
                        continue
                    if opens:
                        del stack[depth:]
                        stack.append(stack[-1].branch() if stack else Reading())
                    stack[depth].read(codec, tokens, first, end)
            if found:
                yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in found], schema=arrow)

    names = ["leaf", *(part.split()[0] for part in READ.split(", "))]
    arrow = pa.schema([(n, pa.string() if "sha256" in n else pa.int64()) for n in names])
    every = emitted.select(shape).unionByName(ends.select(shape))
    sort = ["block", "leaf", "kind", "at"]
    read = every.repartition("block").sortWithinPartitions(*sort).mapInArrow(run, f"leaf long, {READ}")
    return trees.conversations.select("conv_id", "leaf").join(read, "leaf").drop("leaf")


def op13_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one that tries the escapes, as read back from their trees."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], rows.schema)
    return read_back(prefix_trees(rows.unionByName(probe))).drop("n_tokens")
