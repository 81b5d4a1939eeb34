"""HTML extraction, language, toxicity and decontamination."""

import random

import pytest
from pyspark.sql import functions as F

from cohortry.llm import decontamination as dc
from cohortry.llm import html_text, language, toxicity
from cohortry.llm.common import held_out
from tests.llm.conftest import CLASHING, SMALL, prose, table_rows

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><a href=/>Home</a> Site</header><nav><ul><li><a href=x>One</a></li><li><a>Two</a></li></ul></nav>
<div id="cookie-notice">We use cookies.</div><article><h1>My &lt;title&gt;</h1><p><b>First para, with words.<br>
<p>Second&nbsp;para &amp; more,   with text<script>var x = "</p>";</script>.</p><!-- hidden --><aside class="ad">Buy now</aside>
<ul><li>item one of the text<li>item two</ul><form>Subscribe <button>Go</button></form>
<section class="comments"><p>Reader says hello, I read it all.</p></section></article>
<div class="sidebar"><p>Related stories, with lots of words here.</p></div><footer>&copy; x</footer></body></html>"""
TEXT = "My <title> First para, with words. Second para & more, with text. item one of the text item two"


@pytest.fixture(scope="module")
def trees(spark):
    return html_text.learn(spark.read.parquet(f"{SMALL}/pages.parquet"))


def test_extraction_of_a_page(trees):
    for html in (PAGE, PAGE.replace("<article>", '<div class="post">').replace("</article>", "</div>")):
        page = html_text.Page(html)
        assert page.text(page.decode(trees.chance(page.features()))) == TEXT


def test_unclosed_controls_in_an_article():
    def text(body):
        page = html_text.Page(f"<html><body><article>{body}</article></body></html>")
        return page.text([True] * len(page.tag))

    assert text("<p>One <button>Go<p>Two</p><p>Three</p>") == "One Go Two Three"
    assert text("<p>One <button>Go<p>Two</p><button>Stop</button><p>Three</p>") == "One Two Three"
    assert text("<p>One <button>Go</button> two</p><template><p>no</p></template><p>Three</p>") == "One two Three"
    assert text("<p>A <math>x</math> b <object>film</object> <select><option>no</select>c</p><svg><text>no</text></svg>d") == (
        "A x b film c d"
    )
    assert text("<object><p>One</p><p>Two</p>") == "One Two"


def test_quotes_count_only_after_an_equals_sign():
    """An apostrophe inside an unquoted value, or a quote that is never closed, takes no text with it."""

    def text(body):
        page = html_text.Page(f"<html><body><article>{body}</article></body></html>")
        return page.text([True] * len(page.tag))

    assert text("<p data-x=it's>Hello there</p><p>We don't stop</p><p>End</p>") == "Hello there We don't stop End"
    assert text('<p title="a > b" id=\'c > d\' hidden = "x>y">One</p><p class="open>Two</p><p>Three</p>') == "One Two Three"
    assert text("<p ' x>One</p><p>Two's</p>") == "One Two's"


def test_no_element_is_kept_below_a_dropped_one():
    draw = random.Random(3)
    import numpy as np

    page = html_text.Page(PAGE)
    for _ in range(20):
        kept = page.decode(np.array([draw.random() for _ in page.tag]))
        assert all(kept[page.parent[i]] for i in range(1, len(kept)) if kept[i])


def test_decoding_is_the_most_likely_labeling():
    import itertools

    import numpy as np

    page = html_text.Page("<div><p>a</p><p>b</p></div><div><p>c</p></div>")
    chance = np.array([0.9, 0.3, 0.8, 0.9, 0.6, 0.2])
    best = max(
        (
            labels
            for labels in itertools.product([True, False], repeat=5)
            if all(page.parent[i] == 0 or labels[page.parent[i] - 1] for i in range(1, 6) if labels[i - 1])
        ),
        key=lambda labels: sum(np.log(c if k else 1 - c) for c, k in zip(chance[1:], labels, strict=True)),
    )
    assert tuple(page.decode(chance)[1:]) == best


def test_extraction_of_odd_pages(spark, trees):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "plain"), (4, "u", PAGE[:500]), (4, "u", PAGE[:500]), (5, "u", "<p>cut </"),
            (6, "u", "<article><p>x &amp</p><p" ), (None, "u", "<b>" * 3000 + "deep")]
    pages = spark.createDataFrame([r + ("extra",) for r in rows], "page_id long, url string, html string, text string")
    got = html_text.extract(pages, trees).collect()
    assert len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got)
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == texts[2] == "" and texts[6] == "x &"
    assert html_text.extract(pages.limit(0), trees).collect() == []
    assert html_text.learn(pages.limit(0)) is html_text.BY_NAME


def test_language_on_held_out_rows(spark):
    known = {r["doc_id"]: r["lang"] for r in table_rows(spark, "documents")}
    judged = [r for r in language.op8_language_id(spark, "/root/testdata/sf0.01").collect()]
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    out = [r for r in judged if r.held_out]
    assert sum(r.lang_pred == known[r.doc_id] for r in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 for r in judged)


def test_language_of_odd_rows(spark, documents):
    content = language.learn(documents)
    got = {r.doc_id: r for r in language.identify(documents.filter("doc_id is not null"), content).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3
    assert all(got[i].lang_pred in content for i in (4, 5, 9, 11))
    assert got[2**62 + 1].doc_id == 2**62 + 1
    assert language.identify(documents.limit(0), content).collect() == []
    untaught = language.identify(documents, language.learn(documents.limit(0))).collect()
    assert {r.lang_pred for r in untaught} == {"und"}


def test_letters_marks_and_short_training_texts(spark):
    assert language.plain("½ ² 3 _ !") == "" == language.plain("\u0301 1")
    assert language.plain("हिन्दी, ١٢") == "हिन्दी" and language.plain("É—x") == "é x"
    words = ["qaxo", "zuqi", "vexa", "kawu", "zozo", "wyka", "xuvi", "qiqa"]
    strange = lambda seed, n: " ".join(random.Random(seed).choices(words, k=n))
    rows = [(i, "en", prose(i, 60)) for i in range(30)] + [(100 + i, "zz", strange(i, 8)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    content = language.learn(docs)
    assert set(content) == {"en", "zz"}
    judged = language.identify(spark.createDataFrame([(1, strange(99, 60)), (2, "½ ²")], "doc_id long, text string"), content)
    assert [r.lang_pred for r in judged.orderBy("doc_id").collect()] == ["zz", "und"]


def test_batches_are_cut_by_bytes():
    import pyarrow as pa

    from cohortry.llm.common import slices

    texts = ["a" * 10, None, "b" * 3, "c" * 50, "", "d" * 5, None]
    batch = pa.record_batch({"id": list(range(7)), "t": pa.array(texts, pa.string())})
    parts = list(slices(batch, 1, most=13))
    assert [p.num_rows for p in parts] == [3, 1, 3]
    assert [x for p in parts for x in p.column(1).to_pylist()] == texts
    assert [p.num_rows for p in slices(batch, 1)] == [7] and list(slices(batch.slice(0, 0), 1)) == []
    assert [p.num_rows for p in slices(batch.slice(2, 3), 1, most=1)] == [1, 1, 1]


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon([("idiot", True, 3.0), ("scum", False, 2.0)], exceptions=("idiot proof",))
    hits = lambda text: lexicon.hits(toxicity.fold(text))
    assert hits("you IDIOT!") == hits("1d10t") == hits("іdiоt") == hits("id​iot") == 3.0
    assert hits("idiotic") == hits("villidiot") == 0.0
    assert hits("scummy scum") == 4.0
    assert hits("an idiot proof plan") == 0.0
    assert hits("an idiot proof plan, idiot") == 3.0
    assert toxicity.Lexicon([], ()).hits("idiot") == 0.0


def test_ones_stand_for_i_and_l():
    lexicon = toxicity.Lexicon([("loser", True, 3.0), ("clown", True, 2.0), ("villain", True, 1.0), ("zig", True, 4.0)],
                               exceptions=("clown fish",))
    hits = lambda text: lexicon.hits(toxicity.fold(text))
    assert hits("1oser") == hits("L0SER") == 3.0 and hits("c1own") == 2.0
    assert hits("v1lla1n") == hits("vi11a1n") == 1.0
    assert hits("ioser ciown") == 0.0
    assert hits("a c1own fish") == 0.0
    assert hits("216") == 4.0


def test_toxicity_finds_planted_words(spark, documents):
    rows = [(i, prose(i, 80) + (" you scumbag clown" if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    train = frame.filter(~held_out(F.col("doc_id")))
    model = toxicity.learn(train.drop("toxic"), train.select("doc_id", "toxic"))
    scored = {r.doc_id: r for r in toxicity.score_documents(frame, model).collect()}
    assert all((scored[i].tox_score >= 0.5) == bool(y) for i, _, y in rows)
    clean = toxicity.without_toxic(documents, model)
    assert clean.columns == documents.columns
    assert clean.count() == documents.count()
    assert all(r[c] == "extra" for r in clean.collect() for c in CLASHING)
    nothing = toxicity.learn(train.drop("toxic").limit(0), train.select("doc_id", "toxic"))
    assert {r.tox_score for r in toxicity.score_documents(frame, nothing).collect()} == {0.0}
    assert toxicity.score_documents(frame.limit(0), model).collect() == []


def brute_scores(index, terms):
    found = {}
    for t in terms:
        for piece, s in index.postings[t]:
            found[piece] = found.get(piece, 0.0) + s
    return found


def test_block_max_wand_equals_full_scoring():
    import numpy as np

    draw = random.Random(5)
    items = dc.Items([(i, prose(i, draw.randint(5, 90))) for i in range(60)] + [(60, None), (61, "...")])
    frequency = np.array([draw.randint(1, 900) for _ in items.vocabulary], dtype=float)
    index = dc.Index(items, frequency, 1000)
    for _ in range(60):
        terms = sorted(draw.sample(range(len(items.vocabulary)), 60))
        full = brute_scores(index, terms)
        for threshold in (0.1, 0.3):
            want = {p: s for p, s in full.items() if s >= threshold}
            got = dict(index.retrieve(terms, 0, len(items.pieces), threshold))
            assert set(got) == set(want)
            assert all(got[p] == pytest.approx(want[p]) for p in got)


def test_batched_search_equals_full_scoring(spark):
    """Every passage against every piece, without bounds."""
    texts = [dc.terms_of(prose(700 + i, 40 + 50 * i)) for i in range(8)]
    items = dc.Items([(i, " ".join(w.decode() for w in t[5:45])) for i, t in enumerate(texts)] + [(99, prose(1, 300))])
    texts[3] += dc.terms_of(prose(1, 300))
    import numpy as np

    index = dc.Index(items, np.ones(len(items.vocabulary)), 50)
    want = set()
    for d, words in enumerate(texts):
        for at in range(0, max(1, len(words) - dc.HALF), dc.HALF):
            terms = {items.vocabulary[w] for w in words[at : at + 2 * dc.HALF] if w in items.vocabulary}
            for piece, s in brute_scores(index, terms).items():
                if s >= dc.THRESHOLD - 1e-9:
                    want.add((d, items.item_ids[items.pieces[piece][0]]))
    got = {(f[0], f[1]) for f in dc.Search(index)(texts)}
    assert got == want and (3, 99) in got


def test_an_item_after_its_scrambled_words():
    import numpy as np

    item = dc.terms_of(prose(301, 40))
    scrambled = random.Random(2).sample(item, len(item))
    edited = [w if i != 7 else b"changed" for i, w in enumerate(item)]
    gap = dc.terms_of(prose(302, 400))
    items = dc.Items([(1, b" ".join(item).decode())])
    index = dc.Index(items, np.ones(len(items.vocabulary)), 50)
    found = dc.Search(index)([scrambled + gap + edited + gap, scrambled + gap])
    assert [(f[0], f[1]) for f in found] == [(0, 1)] and found[0][2] + 2 * dc.HALF > len(scrambled + gap)


def test_leaks_are_found_and_clean_rows_stay(spark, documents):
    item = "What is the capital of the far green land? It is the old town of Veldera."
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, ""), (3, prose(77, 200))], "item_id long, text string")
    rows = [(1, prose(50, 300) + " " + item.upper() + " " + prose(51, 90)), (2, prose(52, 300)), (3, prose(77, 200)),
            (None, item), (4, None), (5, "the capital of the land")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dc.leaks(docs, benchmark).collect()}
    assert got == {(1, 1), (3, 3), (None, 1)}
    assert sorted(r.doc_id for r in dc.without_leaks(docs, benchmark).collect()) == [2, 4, 5]
    assert dc.without_leaks(documents, benchmark).count() == documents.count()
    assert dc.leaks(docs, benchmark.limit(0)).collect() == []
    assert dc.leaks(docs.limit(0), benchmark).collect() == []


def test_all_verbatim_items_of_the_test_table(spark):
    items = [(r["item_id"], dc.terms_of(r["text"])) for r in table_rows(spark, "benchmark")]
    want = set()
    for r in table_rows(spark, "documents"):
        line = b" " + b" ".join(dc.terms_of(r["text"])) + b" "
        want |= {(r["doc_id"], i) for i, w in items if b" " + b" ".join(w) + b" " in line}
    got = {(r.doc_id, r.item_id) for r in dc.op2_benchmark_decontamination(spark, SMALL).collect()}
    assert want <= got
