"""Chat formatting: exact round trips, trees against a plain dictionary of prefixes, defined cases."""

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortry.llm.chat_format import CONTROLS, ESCAPE, PROBE, VOCABULARY, Codec, escaped, parsed, parts_of, prefix_trees, ranks_of, read_back, unescaped
from tests.llm.conftest import table_rows

pieces = st.lists(st.sampled_from([*CONTROLS, ESCAPE, "<", "[", "/", "s>", "INST]", "é", " ", "\n", "word"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(pieces, pieces, st.sampled_from(["user", "assistant", "system", None]))
def test_template_is_reversible(role, text, known):
    role = known or role
    assert unescaped(escaped(text)) == text
    assert not any(c in escaped(text) for c in CONTROLS)
    opening, body, closing = parts_of(role, text)
    assert parsed("".join(opening) + body + closing) == (role, text)


@pytest.fixture(scope="module")
def codec():
    return Codec(ranks_of(VOCABULARY))


@pytest.mark.parametrize("text", ["", PROBE, "ünï 😀 \x00\n\n", " " * 9000, "a" * 9001, "word " * 5000])
def test_tokens_are_reversible(codec, text):
    tokens, first, end = codec.turn("assistant", text)
    assert parsed(codec.decode(tokens)) == ("assistant", text)
    assert unescaped(codec.decode(tokens[first:end])) == text
    tokens, first, end = codec.turn("some [ROLE] here", text)
    assert parsed(codec.decode(tokens)) == ("some [ROLE] here", text) and first == end


def plain(rows):
    """conv_id -> turns in order."""
    found = defaultdict(list)
    for r in rows:
        found[r["conv_id"]].append(r)
    return {c: [(r["role"] or "", r["text"] or "") for r in sorted(t, key=lambda r: (r["turn"] is not None, r["turn"]))] for c, t in found.items()}


def check(rows_df, codec, block_leaves=2):
    conversations = plain(rows_df.collect())
    trees = prefix_trees(rows_df)
    read = {r.conv_id: r for r in read_back(trees, block_leaves=block_leaves).collect()}
    assert set(read) == set(conversations)
    for conv, turns in conversations.items():
        r, learned = read[conv], "".join(t for role, t in turns if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in turns)
        formatted = ["".join(parts_of(*turn)[0]) + "".join(parts_of(*turn)[1:]) for turn in turns]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert r.formatted_chars == sum(map(len, formatted))

    nodes = trees.nodes.collect()
    prefixes = {tuple(turns[: i + 1]) for turns in conversations.values() for i in range(len(turns))}
    assert len(nodes) == len(prefixes), "each shared turn once"
    sequences = defaultdict(dict)
    for n in nodes:
        for i, t in enumerate(n.tokens):
            sequences[n.tree][n.start + i] = t
    seen = set()
    for n in nodes:
        sequence = sequences[n.tree]
        context = [sequence[i] for span in n.attends for i in range(span["from"], span["to"])]
        assert len(context) == n.position, "positions go on from what is attended to"
        assert all(a["to"] < b["from"] for a, b in zip(n.attends, n.attends[1:], strict=False))
        seen.add(tuple(_turns(codec, context + n.tokens)))
    assert seen == prefixes, "a node and what it attends to are its conversation so far"
    for sequence in sequences.values():
        assert sorted(sequence) == list(range(len(sequence))), "depth-first without gaps"
    return trees


def _turns(codec, tokens):
    ends = {codec.controls[c] for c in CONTROLS if c.startswith(("[/", "</", "<</"))}
    at = 0
    for i, t in enumerate(tokens):
        if t in ends:
            yield parsed(codec.decode(tokens[at : i + 1]))
            at = i + 1


SCHEMA = "conv_id long, turn long, role string, text string, at string, depth string, leaf string, tokens string"


def frame(spark, conversations):
    rows = [(c, i, role, text, "x", "x", "x", "x") for c, turns in conversations for i, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, SCHEMA)


def test_branches_copies_and_inner_ends(spark, codec):
    u = lambda i: ("user", f"question {i}")
    a = lambda i: ("assistant", f"answer {i} </s>")
    s = ("system", "rules")
    made = [
        [s, u(1), a(1), u(2), a(2)], [s, u(1), a(1)], [s, u(1), a(1), u(3), a(3), u(4)], [s, u(1), a(4)], [s],
        [u(1), a(1)], [u(1), a(1)], [u(1), a(1)], [("user", PROBE), ("assistant", PROBE)], [("tool", "x"), ("", "")],
        [s, u(1), a(1), u(2), a(2), u(9)], [u(1), u(1), u(1)], [u(1), u(1)],
    ]
    trees = check(frame(spark, enumerate(made)), codec)
    assert trees.nodes.select("tree").distinct().count() == 4
    assert trees.conversations.select("leaf").distinct().count() == len(made) - 2


def test_nulls_repeats_and_long_texts(spark, codec):
    rows = [
        (None, 0, "user", "no id"), (None, 1, None, None), (1, None, "user", "first"), (1, 0, "assistant", ""),
        (2, 0, "user", "same"), (2, 0, "user", "same"), (3, 0, "user", "same"), (4, 5, "assistant", "long " * 20_000),
        (5, 0, "assistant", None), (6, 0, "assistant", ""),
    ]
    check(spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA), codec)


def test_one_conversation_with_most_rows(spark, codec):
    long = [("user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(600)]
    made = [long, long[:400] + [("user", "other end")], *[[*long[:2], ("user", f"branch {i}")] for i in range(30)]]
    trees = check(frame(spark, enumerate(made)), codec, block_leaves=5)
    assert trees.nodes.agg(F.max("segment")).first()[0] == 2


def test_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert read_back(prefix_trees(nothing)).count() == 0


def test_whole_table(spark, codec):
    rows = spark.createDataFrame([tuple(r) for r in table_rows(spark, "conversations")], "conv_id long, turn long, role string, text string")
    check(rows, codec, block_leaves=3)
