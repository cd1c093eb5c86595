import time
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest

from siltmill.llm import html_blocks as h
from siltmill.llm import language_id as g
from siltmill.llm import queries

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body class="with-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy &amp; save</div>
<article><h1>Head &eacute;&#33;</h1><p>First <b>bo</b>ld<br>line\n  two &lt;x&gt; &nbsp; end.<p>One.</p><ul><li>item <a href=x>link</a></li></ul>
<aside>no</aside><form>no <input value=no></form><div class="share-buttons">no</div><blockquote>Quote</blockquote></article>
<section id="comments"><article class="comment"><p>I liked all of this very much indeed, thank you for it.</p></article></section><footer>&copy; no</footer></body></html>"""


def test_article_is_taken_whole(spark):
    rows = [(1, "u", PAGE, "x"), (2, "u", None, "x"), (3, "u", "", "x"), (None, None, "<p>" + "word " * 30_000, "x"), (1, "u", PAGE, "x"), (5, "u", "plain words and no markup at all", "x"), (6, "u", "<script>never closed <p>x", "x")]
    got = {r["page_id"]: r for r in h.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), keep=("url",)).collect()}
    assert got[1]["text"] == "Head é! First bold line two <x> end. One. item link Quote"
    assert got[1]["n_chars"] == len(got[1]["text"]) and got[2]["text"] == got[3]["text"] == got[6]["text"] == ""
    assert got[None]["n_chars"] == 30_000 * 5 - 1 and got[5]["text"].startswith("plain")
    assert h.extract(spark.createDataFrame([], "page_id long, html string")).count() == 0


WRAPPED = """<body><div class="layout sidebar-right"><div class="promo">Buy this thing now because it is the best thing that you could buy today</div>
<div role="main"><h2>T</h2><p>Short.</p><p hidden>no</p><p style="display: none">no</p></div><p>A long paragraph beside the article that no frame and no class tells from the article itself, but its place does.</p></div>
<div id="comments"><article class="comment"><p>I have a lot to say about this and will say all of it right here.</p></article></div></body>"""
BARE = """<body><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul><p>A paragraph of a page that marks no article, long enough to be told from links by its words alone.</p>
<p>And one more of these, with some more words in it so that the tree has no doubt at all about it.</p><ul><li><a href=3>Three</a></li></ul></body>"""


def test_pages_without_plain_articles(spark):
    got = {r["page_id"]: r["text"] for r in h.extract(spark.createDataFrame([(1, WRAPPED), (2, BARE)], "page_id long, html string")).collect()}
    assert got[1] == "T Short."
    assert got[2].startswith("A paragraph") and got[2].endswith("about it.") and "One" not in got[2] and "Three" not in got[2]


def test_tree_knows_its_table(spark):
    tree = h.train(spark)
    rows = spark.createDataFrame([tuple(map(float, r)) for r in h.LABELLED], ", ".join(f"{x} double" for x in (*h.FEATURES, "label")))
    right = rows.selectExpr(f"struct({', '.join(h.FEATURES)}) f", "label").selectExpr(f"CAST({tree} AS INT) = label AS ok").where("ok").count()
    assert right >= 0.95 * len(h.LABELLED)


@pytest.mark.parametrize("page", ["<", "<a", "<p", "</", "<!--", "<p class='", "&#xffffffff;", "<div>" * 3000 + "x", "</p>" * 3000, "<a><a><a>x</a>", "<![CDATA[x", "<table><tr><td>a<td>b</table>"])
def test_broken_markup_does_not_crash(page):
    h.blocks_of(page)


@pytest.mark.parametrize("tag", sorted(h._DROPPED - {"head"}))
@pytest.mark.parametrize("inner", ["<div><div><p><b>no", "<div><ul><li><a>no</a>", "<article><div><div><div><p>no</p>", "<div><div><div><p>no</p><p>no</p>"])
def test_dropped_elements_lose_text_at_any_depth(tag, inner):
    page = f"<body><p><a href=x>One <{tag}>{inner}</{tag}>two</a></p><p>Three</p></body>"
    got = h.blocks_of(page)
    assert " ".join(b["text"] for b in got) == "One two Three" and not any(b["beside"] or b["article"] for b in got)


@pytest.mark.parametrize("start", ["<body>", "<body class=x><div>", "", "<div>", "<!-- c --><main>"])
def test_open_head_ends_where_the_page_begins(start):
    head = "<html><head><meta charset=x><title>no</title><link href=x><style>no</style><noscript><img><p>no</p></noscript><template><div>no</div></template>\n"
    for body in ("<article><p>text <b>more", "text more", "<p>text more", "<div><div><div><div><div>text more"):
        assert " ".join(b["text"] for b in h.blocks_of(head + start + body)) == "text more"
    assert h.blocks_of(head + "</head><body>x") == h.blocks_of(head + "<body>x")


RUNNING = "Some words of an article stand here and go on for a while. " * 8
UNMARKED = {
    # a class of which one part is in the list, on the page's whole text; a title in a header of the article
    '<div class="share-holder-report"><h1>Yearly report</h1><p>' + RUNNING + "</p><p>We sold more.</p></div>": "Yearly report " + RUNNING + "We sold more.",
    '<div class=content><div class="article-header"><h1>Title</h1></div><p>' + RUNNING + "</p></div>": "Title " + RUNNING,
    '<div class="share-box"><p>' + RUNNING[:60] + "</p></div><p>" + RUNNING + "</p>": RUNNING,
    '<div class="comment-list"><article class="x"><p>' + RUNNING + "</p></article></div><p>" + RUNNING + "</p>": RUNNING,
    # a slash in a value closes nothing, nor does one in an element of HTML
    "<div><a href=/en/>Home</a> <a href=/de/>Heim</a> <a href=/fr/>Maison</a></div><p>" + RUNNING + "</p>": RUNNING,
    "<div><nav/>Menu Home</div><p>" + RUNNING + "</p>": RUNNING,
    "<p>" + RUNNING + '<svg><path d="x"/><text>no</text></svg>end</p>': RUNNING + "end",
    # a quote counts at the start of a value only
    "<p>" + RUNNING + "<img alt=it's src=x> middle text that's kept</p><p>" + RUNNING + "it's</p>": RUNNING + "middle text that's kept " + RUNNING + "it's",
    "<p>" + RUNNING + '<img alt="a > b" \' title=\'<p>no\'>end</p>': RUNNING + "end",
    # comments, end tags beyond a cell, end tags of inline elements around blocks, scripts that name their own end
    "<!--><p>" + RUNNING + "</p><!--->end of it, which is some more text<!-- no --!> and the rest": RUNNING + "end of it, which is some more text and the rest",
    "<aside><table><tr><td>no</aside>no</td></tr></table>no</aside><p>" + RUNNING + "</p>": RUNNING,
    "<b><nav>no</b>no</nav><p>" + RUNNING + "</p>": RUNNING,
    "<script>x = '</scripts><p>no'</script><p>" + RUNNING + "</p>": RUNNING,
    '<ul><li class="ad">no no<li><p>' + RUNNING + "</ul>": RUNNING,
}


def test_unmarked_pages_give_their_text(spark):
    rows = [(i, "<body>" + page) for i, page in enumerate(UNMARKED)]
    got = {r["page_id"]: r["text"] for r in h.extract(spark.createDataFrame(rows, "page_id long, html string")).collect()}
    assert got == {i: " ".join(text.split()) for i, text in enumerate(UNMARKED.values())}


LONG = "It was a long and quiet day and nobody said a word about what had come to pass in the old town by the river before noon. " * 3
OWN_WORDS = {
    # a form around a whole page, with and without a marked article, and forms that are none of that
    "<body><form action=x><input type=hidden name=v><div><h1>Title</h1><p>" + RUNNING + "</p><p>" + LONG + "</p></div><input name=q></form>": "Title " + RUNNING + " " + LONG,
    "<body><form><nav><a href=/>Home</a></nav><article><h1>T</h1><p>" + RUNNING + "</p></article><footer>no</footer></form>": "T " + RUNNING,
    "<form><p>Tell us your name and where you live, please.</p><input name=a><input name=b></form><p>" + RUNNING + "</p><p>" + LONG + "</p>": RUNNING + " " + LONG,
    "<article><p>" + RUNNING + "</p><form><p>" + LONG + "</p><textarea>x</textarea></form></article>": RUNNING,
    # an opinion piece, and comments behind an article or in numbers
    '<body><article class="comment"><h1>Opinion</h1><p>' + RUNNING + "</p></article>": "Opinion " + RUNNING,
    "<body><article><p>" + RUNNING + '</p></article><article class="comment"><p>' + LONG + "</p></article>": RUNNING,
    "<body><div><p>" + RUNNING + "</p><p>" + LONG + '</p></div><article class="comment"><p>' + LONG + '</p></article><article class="comment"><p>' + LONG + "</p></article>": RUNNING + " " + LONG,
    # running text in an article whose class hints, a box of such a class, hidden text, comments in other languages
    "<article><p>" + RUNNING + '</p><p class="social">' + LONG + "</p><p>" + RUNNING + "</p></article>": RUNNING + " " + LONG + " " + RUNNING,
    "<article><p>" + RUNNING + '</p><div class="social">Share this with all of your friends</div><p>' + RUNNING + "</p></article>": RUNNING + " " + RUNNING,
    '<article><p style="visibility: hidden">no</p><p>' + RUNNING + "</p></article>": RUNNING,
    "<div><p>" + RUNNING + '</p></div><div class="kommentare"><p>' + LONG + "</p></div>": RUNNING,
    "<div><p>" + RUNNING + '</p></div><div class="responses"><p>' + LONG + "</p></div>": RUNNING,
}


def test_forms_and_names_empty_no_page(spark):
    pages = list(OWN_WORDS)
    got = h.extract(spark.createDataFrame(list(enumerate(pages)), "page_id int, html string")).collect()
    for r in got:
        assert " ".join(r.text.split()) == " ".join(OWN_WORDS[pages[r.page_id]].split()), pages[r.page_id]


def test_tree_reads_the_neighbours_on_both_sides(spark):
    assert all(f"f.{x} " in h.train(spark) for x in ("density_before", "words_after", "density_after", "hint", "other"))


@pytest.mark.parametrize("page", ["<div>{}</span>", "<b>{}<p>a", "<div>{}<div class=ad><article>", "<div class=ad>{}<hr>x", "<b><div>{}</b>", "<table>{}</table>", "<li>{}</i>", "<textarea>{}<", "<svg>{}<g a==/>"])
def test_reading_is_linear(page):
    """Ten times the tags take about ten times the time."""

    def seconds(n):
        began = time.process_time()
        h.blocks_of("".join(part * n for part in page.split("{}")))
        return time.process_time() - began

    seconds(1000)
    assert seconds(30_000) < 40 * max(seconds(3000), 0.02)


class Article(HTMLParser):
    """The text of the article element by the standard library's parser, a block at a time."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in h._BREAKS:
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag in h._BREAKS:
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_query_against_another_parser(spark):
    """Every page of the smallest tables marks its article and has nothing else in it."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    got = {r["page_id"]: r["text"] for r in queries.op2_html_text(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(pages)
    for page in pages:
        reader = Article()
        reader.feed(page["html"] or "")
        reader.close()
        assert got[page["page_id"]] == " ".join(" ".join(b.split()) for b in reader.blocks if b.strip())


def texts(n, seed=0):
    rng = np.random.default_rng(seed)
    parts = {"aa": ["ka", "lo", "mi", "tu", "re"], "bb": ["sch", "ung", "ein", "pf", "ze"], "cc": ["ção", "ñe", "ié", "eau", "ó"]}
    out = []
    for i in range(n):
        lang = list(parts)[i % 3]
        out.append((i, " ".join("".join(rng.choice(parts[lang], 3)) for _ in range(rng.integers(3, 40))), lang))
    return out


SCHEMA = "doc_id long, text string, lang string, score string, held_out string"


def test_languages_are_learned(spark):
    rows = [(*r, "x", "y") for r in texts(400)] + [(900, None, "aa", "", ""), (901, "", "bb", "", ""), (902, "123 !?", "cc", "", ""), (None, "kalomi tu", None, "", ""), (903, "schung einpf " * 20_000, None, "", ""), (1, texts(2)[1][1], "bb", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = g.identify(df).collect()
    truth = {i: lang for i, _, lang in texts(400)}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(got) == len(rows) and len(held) > 40
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.98
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (900, 901, 902))
    assert by[903]["lang_pred"] == "bb" and by[None]["held_out"] is False and all(0 <= r["score"] <= 1 for r in got)
    assert {r["doc_id"] for r in g.understood(df).collect()} >= {i for i, *_ in texts(400)}
    assert g.understood(df).filter("doc_id in (900, 901, 902)").count() == 0


def test_labels_of_held_out_rows_teach_nothing(spark):
    import zlib

    rows = texts(200)
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 5 == 0 else lang) for i, t, lang in rows]
    predict = lambda data: sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in g.identify(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect())
    assert predict(rows) == predict(wrong)


def test_without_labels(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"]) for r in g.identify(df).collect()] == [("und", 0.0)] * 2
    assert [r["doc_id"] for r in g.understood(df).collect()] == [1]
    assert g.identify(df.limit(0)).count() == 0


def test_penalty_makes_weights_sparse():
    rows = [g.weighed(g.ngrams(t), np.ones(g.DIMENSIONS)) for _, t, _ in texts(150)]
    labels = np.array([i % 3 for i in range(150)])
    few, _ = g.fit_weights(rows, labels, 3, l1=0.3)
    more, _ = g.fit_weights(rows, labels, 3, l1=0.0)
    assert 0 < np.count_nonzero(few) < np.count_nonzero(more)


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 3, 500)
    logits = 8 * rng.standard_normal((500, 3))
    logits[np.arange(500), labels] += 4
    t = g.fit_temperature(logits, labels)
    loss = lambda t: -np.log(g.softmax(logits / t)[np.arange(500), labels]).mean()
    assert t > 1 and loss(t) < loss(1.0)


def test_language_query_on_held_out_documents(spark):
    """Rows that nothing is learned from, over the whole table."""
    got = queries.op7_language_id(spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in got) == sorted(truth)
    tested = [r for r in got if r["held_out"] and truth[r["doc_id"]]["lang"] is not None and any(map(str.isalpha, truth[r["doc_id"]]["text"] or ""))]
    assert len(tested) > 100 and sum(r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in tested) >= 0.97 * len(tested)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in got} <= {r["lang"] for r in truth.values()} | {"und"}
