"""Near-duplicates and repeated passages against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortry.llm import near_dedup
from cohortry.llm.near_dedup import components, near_duplicates, one_of_each, op7_minhash_near_dedup
from cohortry.llm.substring_dedup import drop_repeats, op10_substring_dedup
from cohortry.session import checkpointed
from tests.llm.conftest import CLASHING, SMALL, prose, table_rows


def words_of(text, lower):
    text = text or ""
    if lower:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]


def shingles(text, size):
    w = words_of(text, True)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute_components(rows, size):
    """Position of each row to the smallest id reachable."""
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    ids = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[find(i)] = min(ids.get(find(i), doc_id), doc_id)
    return [(d, len(s), ids.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def sortable(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_of_odd_rows(documents, plain_rows, size):
    got = near_duplicates(documents, words=size).collect()
    assert sortable((r.doc_id, r.n_shingles, r.component_id) for r in got) == sortable(brute_components(plain_rows, size))
    for r in got:
        assert r.kept == (r.doc_id is not None and r.doc_id == r.component_id)


def test_near_duplicates_of_the_test_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table_rows(spark, "documents")]
    got = op7_minhash_near_dedup(spark, SMALL).collect()
    assert sortable((r.doc_id, r.n_shingles, r.component_id) for r in got) == sortable(brute_components(rows, 4))


def test_a_large_group_of_near_copies(spark):
    """A dense node: 120 texts that differ in a few words, and strangers that share a passage."""
    base = prose(11, 150).split()
    rows = []
    for i in range(120):
        w = list(base)
        w[(i * 7) % 150] = f"edit{i}"
        rows.append((i, " ".join(w)))
    shared = " ".join(base[:30])
    rows += [(1000 + i, shared + " " + prose(100 + i, 120)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs, words=4).collect()
    assert sortable((r.doc_id, r.n_shingles, r.component_id) for r in got) == sortable(brute_components(rows, 4))


def test_sets_of_repeated_rows_and_null_ids(spark):
    """Each class has its set once."""
    from cohortry.llm import near_dedup as nd

    docs = spark.createDataFrame(
        [(1, prose(13, 50))] * 3 + [(None, prose(14, 50))] * 2 + [(2, prose(15, 50))], "doc_id long, text string"
    )
    classes = nd.described(docs, "text", "doc_id", 4).groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), (F.count(F.lit(1)) > 1).alias("again")
    ).withColumn("cid", F.coalesce("rep", F.lit(99)))
    sets = nd.shingle_sets(docs, classes, "text", "doc_id", 4)
    assert sorted(r.cid for r in sets.collect()) == [1, 2, 99]


def test_recall_of_the_trees_at_full_depth(spark, monkeypatch):
    """Pairs at the threshold, in trees that go down all levels."""
    import numpy as np

    from cohortry.llm import near_dedup as nd

    monkeypatch.setattr(nd, "SMALL_NODE", 1)
    monkeypatch.setattr(nd, "DENSE_SHARE", 2.0)
    monkeypatch.setattr(nd, "ALIKE_SHARE", 3.0)
    draw = np.random.default_rng(4)
    one = draw.integers(0, 2**31 - 1, (600, nd.TOKENS))
    two = np.where(draw.random(one.shape) < 0.8, one, draw.integers(0, 2**31 - 1, one.shape))
    rows = [(2 * i + k, t.tolist(), 300) for i in range(600) for k, t in enumerate((one[i], two[i]))]
    _, dense = nd.final_nodes(spark.createDataFrame(rows, "cid long, tokens array<int>, n_shingles long"))
    met = dense.selectExpr("cid div 2 as pair", "node", "cid").groupBy("node", "pair").agg({"cid": "count"})
    assert met.filter("`count(cid)` > 1").select("pair").distinct().count() == 600


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.cid: r.comp for r in components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_one_of_each_keeps_columns_and_rows(documents):
    got = one_of_each(documents)
    assert got.columns == documents.columns
    rows = got.collect()
    # 6 and 8 (other case) copy 5, 7 is a near copy; the repeated row 13 stays once; rows without id stay.
    assert sortable(r.doc_id for r in rows) == sortable([1, 2, 3, 4, 5, 9, 10, 11, 12, 12, 13, 2**62 + 1, None, None])
    assert all(r[c] == "extra" for r in rows for c in CLASHING)


def brute_repeats(rows, window):
    texts = [words_of(t, False) for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        left = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((doc_id, len(w), sum(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sortable(out)


def test_repeats_of_odd_rows(documents, plain_rows):
    got = sortable(tuple(r) for r in drop_repeats(documents).collect())
    assert got == brute_repeats(plain_rows, 35)


def test_repeats_of_the_test_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in table_rows(spark, "documents")]
    assert sortable(tuple(r) for r in op10_substring_dedup(spark, SMALL).collect()) == brute_repeats(rows, 35)


def test_a_passage_shared_in_parts(spark, monkeypatch):
    """Parts of one passage in many texts, with shards and tasks made small so that all get split."""
    from cohortry.llm import substring_dedup as sd

    monkeypatch.setattr(sd, "PHRASES_PER_SHARD", 3)
    monkeypatch.setattr(sd, "WORDS_PER_TASK", 300)
    monkeypatch.setattr(sd, "WINDOWS_PER_PART", 10)
    passage = prose(21, 120).split()
    rows = [(i, prose(200 + i, 40) + " " + " ".join(passage[i : i + 34 + i])) for i in range(30)]
    rows += [(50, " ".join(passage) + "  " + " ".join(passage)), (51, prose(30, 100))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sortable(tuple(r) for r in drop_repeats(docs).collect()) == brute_repeats(rows, 35)


def test_empty_tables(documents):
    nothing = documents.limit(0)
    assert near_duplicates(nothing).collect() == []
    assert one_of_each(nothing).collect() == []
    assert drop_repeats(nothing).collect() == []


@pytest.mark.parametrize("share", [0.6, 0.7, 0.9])
def test_rows_of_a_level_do_not_grow_on_a_large_group(spark, share):
    """1,000 sets that agree with a base in a share of their tokens: copies are settled, others end as dense nodes."""
    draw = np.random.default_rng(3)
    base = draw.integers(0, 2**31, near_dedup.TOKENS)
    rows = []
    for i in range(1000):
        own = draw.integers(0, 2**31, near_dedup.TOKENS)
        rows.append((i, [int(x) for x in np.where(draw.random(near_dedup.TOKENS) < share, base, own)], 300))
    classes = checkpointed(spark.createDataFrame(rows, "cid long, tokens array<int>, n_shingles long"))
    small, dense = near_dedup.final_nodes(classes)
    first = 2 * near_dedup.TREES * len(rows)
    assert dense.count() + small.count() <= 2 * first
    assert near_dedup.star_pairs(dense).distinct().count() <= 40 * len(rows)


def test_copies_that_miss_the_threshold_are_no_pairs(spark, monkeypatch):
    """400 copies of an absent text: any two of 300 with two edits are similar, none to one of 100 with three edits elsewhere."""
    base, draw, rows = prose(41, 150).split(), np.random.default_rng(6), []
    for i in range(400):
        w = list(base)
        for at in draw.permutation(18)[:2] if i < 300 else 18 + draw.permutation(18)[:3]:
            w[4 * at + 3] = f"edit{i}x{at}"
        rows.append((i, " ".join(w)))
    made, join = [], near_dedup.open_pairs

    def counted(*given):
        found = checkpointed(join(*given))
        made.append(found.count())
        return found

    monkeypatch.setattr(near_dedup, "open_pairs", counted)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()
    assert sortable((r.doc_id, r.n_shingles, r.component_id) for r in got) == sortable(brute_components(rows, 4))
    # The similar ones among the 100 may come once for each rare token they share.
    assert made[0] <= 10 * len(rows)


def test_parity_bits_never_differ_more_than_sets():
    draw = np.random.default_rng(8)
    for size in (1, 30, 150, 5000):
        for own in (0, 1, size // 5, size):
            both, one, two = (draw.integers(0, 2**64, n, dtype=np.uint64) for n in (size, own, own))
            x, y = (near_dedup.parity(np.union1d(both, s)) for s in (one, two))
            assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= len(np.setxor1d(one, two))
            assert len(x) * 64 == near_dedup.PARITY_BITS
