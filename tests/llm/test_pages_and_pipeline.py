from __future__ import annotations

import html
import re

import pytest

import corpus_pipeline
from helpers import awkward, documents
from tabkit.llm import jaccard, language, main_text, packing, quality
from tabkit.llm.dom import Page


@pytest.fixture(scope="module")
def trees(spark, folder):
    return main_text.train(spark.read.parquet(f"{folder}/pages.parquet"))


def article(source):
    """The article of the given kind of page, by pattern."""
    body = source[source.find("<article>") + len("<article>") :]
    end = body.find("</article>")
    body = re.sub(r"<[^>]*\Z", "", body[:end] if end >= 0 else body)
    blocks = [
        " ".join(html.unescape(re.sub(r"<[^>]+>", lambda m: " " if m[0].startswith("<br") else "", x)).split())
        for x in re.split(r"</?(?:p|h1|h2|h3|div|ul|li)\b[^>]*>", body)
    ]
    return "\n".join(b for b in blocks if b)


def test_articles_of_the_pages(spark, folder, trees):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    got = {r["page_id"]: r for r in main_text.extract(pages, trees).collect()}
    rows = pages.collect()
    same = sum(got[r["page_id"]]["text"] == article(r["html"]) for r in rows)
    assert same >= 0.95 * len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header class="top"><p>Site name here with words</p></header><nav><a href="/">Home</a></nav>
<div id="cookie-notice"><p>We use cookies to do things, accept please.</p><button>OK</button></div>
<article><h1>Head line</h1><p>First para with <a href="x">a link</a> in it, and some more text to read.</p>
<div class="ad">Buy now, cheap things.</div><script>var x = "<p>no</p>";</script>
<p>Second &eacute; para   is
here.<br>Next line<p>Third one<ul><li>one item<li>two item</ul></article>
<div class="comments"><h3>Comments</h3><div class="comment"><p>I liked this very much, thanks.</p></div></div>
<aside><p>Related stuff to read</p></aside><footer>&copy; me</footer></body></html>"""


def test_clutter_of_other_kinds_goes(spark, trees):
    frame = spark.createDataFrame([(1, "u", PAGE, "x"), (2, "u", None, "x"), (3, "u", "", "x"), (4, None, "<p", "x"), (None, "u", "a < b", "x")], "page_id long, url string, html string, text string")
    got = {r["page_id"]: r["text"] for r in main_text.extract(frame, trees).collect()}
    assert got[1].split("\n") == [
        "Head line", "First para with a link in it, and some more text to read.", "Second é para is here. Next line",
        "Third one", "one item", "two item",
    ]
    assert got[2] == got[3] == got[4] == ""
    assert main_text.train(frame.filter("page_id > 1")) is None
    plain = {r["page_id"]: r["text"] for r in main_text.extract(frame, None).collect()}
    assert "First para" in plain[1] and "cookies" not in plain[1]
    assert main_text.extract(frame.limit(0), trees).count() == 0


def test_decoding_allows_no_contradiction(trees):
    page = Page(PAGE)
    chance = main_text.probabilities(trees, main_text.features(page))
    state = main_text.decode(page, chance[::-1].copy(), main_text.decided(page))  # any chances
    for i in range(1, len(page.tags)):
        up = state[page.parents[i]]
        assert not (up == main_text.CLUTTER and state[i] != main_text.CLUTTER)
        assert not (up == main_text.MAIN and state[i] == main_text.CONTAINER)


def test_careless_markup():
    page = Page("<div><p>a<b>b<p>c</b>d</div>e<li>f<li>g<td>h</td>&am")
    holders = [(page.tags[n], t) for n, t in page.runs if t]
    assert holders[:4] == [("p", "a"), ("b", "b"), ("p", "c"), ("p", "d")]
    assert ("li", "f") in holders and ("li", "g") in holders and holders[-1][1] == "&am"


def test_pages_without_body_and_words_after_it(spark, folder):
    """Text is found as browsers find it: in a body left out, behind its end, behind odd quotes."""
    trees = main_text.train(spark.read.parquet(f"{folder}/pages.parquet"))
    wanted = {
        "plain text of a page": "plain text of a page",
        "<b>Title</b> some text": "Title some text",
        "a < b": "a < b",
        "<html><body><p>One two three.</p></body></html>words after the end": "One two three.\nwords after the end",
        "<p data-x=don't>Some text here.</p><p>More text, isn't it?</p>": "Some text here.\nMore text, isn't it?",
        '<p title="a > b">Quoted.</p>': "Quoted.",
        "<html><head><title>T</title></head>Bare words of a page.": "Bare words of a page.",
    }
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate(wanted)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in main_text.extract(pages, trees).collect()}
    assert [got[i] for i in range(len(wanted))] == list(wanted.values())


def brute_force(spark, folder):
    """The stages one after the other with plain code on collected rows."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = language.train(language.learnable(docs))
    rows = [r for r in docs.collect()]
    scorer = language.Scorer(model)
    said = {r["doc_id"]: scorer.predict(r["text"]) for r in rows}
    kept = [r for r in rows if said[r["doc_id"]][0] != "und" and said[r["doc_id"]][1] >= corpus_pipeline.LEAST_LIKELY]
    frame = spark.createDataFrame(kept, docs.schema)
    model = quality.train(frame, quality.learnable(spark.read.parquet(f"{folder}/labels.parquet")))
    good = {r["doc_id"] for r in quality.score(frame, model).collect() if r["predicted"] == 1}
    kept = [r for r in kept if r["doc_id"] in good]
    sets = {}
    for r in kept:
        words = r["text"].encode().lower().split()
        sets[r["doc_id"]] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i for i in sets if root(i) == i}


def test_pipeline_equals_brute_force(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in rows} == brute_force(spark, folder)
    assert len(rows) == len({(r["doc_id"], r["piece"]) for r in rows})
    assert all(r["offset"] + r["length"] <= packing.CAPACITY for r in rows)


def test_stages_keep_columns_and_survive_odd_rows(spark, folder):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), folder).count() == 0
    kept = corpus_pipeline.STAGES[2][1](spark, docs, folder)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, *range(1, 12)]  # one row of 11, 11 and 12
    assert jaccard.SIMILARITY == 80 and jaccard.WORDS == 5


def test_one_row_of_each_group_stays_whatever_its_id(spark, folder):
    a, b, c = (f"{x} words of a text that is long enough to be compared with others {x}" for x in ("some", "other", "third"))
    rows = [(7, a, "en")] * 5 + [(9, a, "en"), (None, a, "en"), (None, b, "en"), (None, b, "en"), (5, c, "en"), (5, "not like it", "en")]
    rows += [(None, None, "en"), (None, "", "en"), (3, "", "en"), (3, "", "en")]
    docs = documents(spark, rows)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, folder)
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()))
    assert got == sorted([(7, a), (0, b), (5, c), (5, "not like it"), (0, ""), (0, ""), (3, ""), (3, "")])
