"""Main text by wrappers, language identification, and the pipeline's decisions."""

from __future__ import annotations

import functools
import random

import pytest

from pyspark.sql import functions as F

from clipward.llm import html_wrappers as wrappers
from clipward.llm import language

PAGE = """<!DOCTYPE html><html><head><title>x</title><style>p{{}}</style></head><body>
<nav><ul><li><a href="/">Menu</a><li>More</ul></nav><div class="cookie-notice">ok?</div>
<header>Site</header><article><header><h1>Title &amp; more</h1></header>
<p>One <span class="ad">buy <span>in</span> out</span> two<br>three {n}&nbsp;&lt;b&gt;
<p>Four <b>five</b><script>var t="</p>";</script><ul>{items}</ul>
<form>no<input></form><footer>by</footer><section id="comments"><p>no</p></section></article>
<aside>side</aside><footer>foot</footer>"""


def page(n, items=2):
    return PAGE.format(n=n, items="".join(f"<li>x{i}</li>" for i in range(items)))


def test_main_text(spark):
    rows = [
        (1, "https://WWW.a.example:80/x", page(1)),
        (2, "https://a.example/y", page(2, 0)),
        (3, "https://a.example/y", page(2, 0)),
        (4, None, page(4, 1)),
        (5, "https://b.example/", None),
        (6, "https://b.example/", ""),
        (7, "https://b.example/", "<p>plain <b>text"),
        (8, "https://c.example/", "<main><div>m1</div></main><div>no</div>"),
        (9, "https://c.example/", "<div>only body &copy; &am</div> < 3"),
        (10, "https://d.example/", "<div>" * 3000 + "deep" + "</div>" * 3000),
        (11, "https://d.example/", "<p>" + "long " * 200000),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = {r.page_id: r.text for r in wrappers.extract(df).collect()}
    say = lambda n, items: f"Title & more\nOne two three {n} <b>\nFour five" + "".join(f"\nx{i}" for i in range(items))
    assert got == {
        1: say(1, 2),
        2: say(2, 0),
        3: say(2, 0),
        4: say(4, 1),
        5: "",
        6: "",
        7: "plain text",
        8: "m1",
        9: "only body © &am\n< 3",
        10: "deep",
        11: "long " * 199999 + "long",
    }
    assert wrappers.extract(df.where("false")).count() == 0


def said(html, wrapper=None):
    return wrappers.main_text(html, wrapper or wrappers.own_wrapper(wrappers.parse(html)))


def test_text_after_inline_notices_deep_elements_and_inside_forms():
    assert said('<article><p>text <small class="notice">x</small> more text</p><p>next</p></article>') == "text more text\nnext"
    assert said('<p>one <em class="share">x <em>y</em> z</em> two three</p>') == "one two three"
    assert said('<p>one <b class="ad">x</p><p>two</b> three</p>') == "one\ntwo three"
    deep = "<div>" * 200 + "deep" + "</div>" * 200
    assert said(f"<div id=wrap><article>{deep}<p>rest</p></article></div><p>out</p>") == "deep\nrest"
    nav = "<div>" * 400 + "<nav>menu</nav><p>in</p>" + "</div>" * 400
    assert said(f"<article>{nav}<p>rest</p></article>") == "in\nrest"
    assert said("<body><form><p>all</p><input><button>go</button></form></body>") == "all"
    assert said("<body><form><nav>n</nav><article>all</article></form><p>foot</p></body>") == "all"
    assert said('<body><p>text</p><form><div class="content">name</div></form></body>') == "text"
    assert said("<div>" * 100000 + "deep" + "</b></p>" * 100000) == "deep"


def test_wrapper_leaves_out_what_all_pages_of_a_host_repeat_inside_the_article(spark):
    box = '<div class="box">Read <b>also</b> this</div>'
    body = lambda i, b: f"<article><h1>Title {i}</h1><p>text {i} of some length</p><p>more {i}</p>{b}</article>"
    pages = [body(i, box) for i in range(5)]
    merged = wrappers.own_wrapper(wrappers.parse(pages[0]))
    for p in pages[1:]:
        merged = wrappers.merge(merged, wrappers.own_wrapper(wrappers.parse(p)))
    assert said(pages[2]) == "Title 2\ntext 2 of some length\nmore 2\nRead also this"
    assert said(pages[2], merged) == "Title 2\ntext 2 of some length\nmore 2"
    # Two pages are too few, also when they come many times; copies of one article are one page.
    few = [body(i % 2, box) for i in range(6)]
    copies = [f"<article><h1>n {i}</h1><div>one long text that all have</div></article>" for i in range(6)]
    # An optional box is content.
    some = [body(i, box if i % 2 else "") for i in range(8)]
    rows = [(h, i, f"https://{h}.example/{i}", p) for h, ps in (("a", pages), ("b", few), ("c", copies), ("d", some)) for i, p in enumerate(ps)]
    rows += [("e", 0, "https://e.example", None), ("a", 9, "https://a.example/9", "")]
    df = spark.createDataFrame(rows, "h string, i int, url string, html string")
    got = {(r.h, r.i): r.text for r in wrappers.extract(df).collect()}
    assert all("also" not in got["a", i] for i in range(5)) and got["a", 9] == "" == got["e", 0]
    assert all("also" in got["b", i] for i in range(6)) and all("also" in got["d", i] for i in range(1, 8, 2))
    assert all(got["c", i] == f"n {i}\none long text that all have" for i in range(6))
    wide = wrappers.BROADCAST_BYTES, wrappers.SHARE_BYTES
    wrappers.BROADCAST_BYTES, wrappers.SHARE_BYTES = 0, 100
    try:
        assert {(r.h, r.i): r.text for r in wrappers.extract(df).collect()} == got
    finally:
        wrappers.BROADCAST_BYTES, wrappers.SHARE_BYTES = wide


def test_merging_does_not_depend_on_the_order_of_pages():
    page_of = lambda i: f"<body><h1>t{i % 3}</h1><div class=x>same</div><p>long text {i}</p></body>"
    own = [wrappers.own_wrapper(wrappers.parse(page_of(i))) for i in range(6)]
    fold = lambda ws: functools.reduce(wrappers.merge, ws)
    assert fold(own) == fold(own[::-1]) == wrappers.merge(fold(own[:2]), fold(own[2:]))


def test_alignment_makes_optional_and_repeated_members():
    own = lambda t: wrappers.own_wrapper(wrappers.parse(t))
    merged = wrappers.merge(
        own("<body><h1>A</h1><p>1</p><p>2</p><hr></body>"), own("<body><h1>A</h1><h2>s</h2><p>3</p></body>")
    )
    (_, (body,)), = merged[2]
    shape = [(q, [m[0] for m in ms]) for q, ms in body[2]]
    assert shape == [(0, ["h1"]), (1, ["h2"]), (2, ["p"]), (1, ["hr"])]
    assert body[2][0][1][0][2][0][1][0][1] is not None  # fixed text
    assert body[2][2][1][0][2][0][1][0][1] is None  # open slot
    mixed = own("<body><p>a</p><ul><li>x</ul><p>b</p><ul><li>y</ul></body>")[2][0][1][0]
    assert [(q, sorted(m[0] for m in ms)) for q, ms in mixed[2]] == [(2, ["p", "ul"])]


def test_merging_keeps_every_member():
    draw = random.Random(4)
    tags = ["p", "h2", "ul", "table", "pre", "div"]

    def some():
        return "<body>" + "".join(f"<{t}>{i}</{t}>" for i, t in enumerate(draw.choices(tags, k=6))) + "</body>"

    def labels(w):
        return {w[0]} | {x for _, ms in w[2] for m in ms for x in labels(m)}

    for _ in range(100):
        a, b = (wrappers.own_wrapper(wrappers.parse(some())) for _ in range(2))
        body = wrappers.merge(a, b)[2][0][1][0]
        found = [m[0] for _, ms in body[2] for m in ms]
        assert len(found) == len(set(found)) and labels(a) | labels(b) <= labels(wrappers.merge(a, b))


# ---------------------------------------------------------------- languages

SAID = {"en": ["the", "of", "and", "with", "thing"], "de": ["der", "und", "nicht", "schule"], "fr": ["le", "était", "que", "eaux"]}


def texts(n=60):
    draw = random.Random(6)
    rows = []
    for i in range(n):
        name = sorted(SAID)[i % 3]
        rows.append((i, " ".join(draw.choices(SAID[name], k=30)), name, f"h{i % 3}.x.{name}"))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, language string, confidence string"


def test_language_on_held_out_rows(spark):
    rows = texts()
    hidden = [(i, t, None if i % 4 == 0 else n, s, "a", "b") for i, t, n, s in rows]
    extra = [
        (100, None, "en", "h0.x.en", "a", "b"),
        (101, "", None, None, "a", "b"),
        (102, "12 34 !!", "de", None, "a", "b"),
        (103, "der und nicht schule und der", None, None, "a", "b"),
        (104, "the of and with " * 50000, None, "nodots", "a", "b"),
    ]
    df = spark.createDataFrame(hidden + extra, SCHEMA)
    got = {r.doc_id: r for r in language.identify(df).collect()}
    assert len(got) == 65
    assert all(got[i].language == n for i, _, n, _ in rows)
    assert [got[i].language for i in (100, 101, 102, 103, 104)] == ["und", "und", "und", "de", "en"]
    assert got[100].confidence == 0 and got[103].confidence > 0.9


def test_evidence_decides_where_texts_do_not(spark):
    rows = [(i, t, n, s, "a", "b") for i, t, n, s in texts()]
    same = "zzz qqq zzz qqq"
    rows += [(200, same, None, "h1.x.de", "a", "b"), (201, same, "fr", "h2.x.fr", "a", "b")]
    df = spark.createDataFrame(rows, SCHEMA)
    model = language.fit_text(df, "text", "lang")
    flat = language.score_text(df, model).withColumn(
        "text_scores", F.when(F.col("text") == same, F.array_repeat(F.lit(-1.0), 4)).otherwise(F.col("text_scores"))
    )
    evidence = language.fit_evidence(flat.where(F.col("text") != same), model.languages, "lang", "source")
    got = {r.doc_id: r.language for r in language.decide(flat, evidence, "lang", "source").collect()}
    assert got[200] == "de" and got[201] == "fr"


def test_language_of_empty_and_unlabelled_tables(spark):
    df = spark.createDataFrame([(1, "some text", None, None, "a", "b")], SCHEMA)
    assert [r.language for r in language.identify(df).collect()] == ["und"]
    assert language.identify(df.where("false")).count() == 0


def test_hosts_and_suffixes(spark):
    df = spark.createDataFrame(
        [("https://u@www.A.example.co:8/x",), ("//b.de?x",), ("none",), (None,)], "url string"
    )
    host = language.host_of(F.col("url"))
    got = df.select(host, language.suffix_of(host), language.domain_of(host)).collect()
    assert [tuple(r) for r in got] == [
        ("a.example.co", "co", "example.co"),
        ("b.de", "de", "b.de"),
        (None, None, None),
        (None, None, None),
    ]


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages_take_effect(spark, sf_dir):
    import corpus_pipeline

    draw = random.Random(7)
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first().text
    vocabulary = ["".join(draw.choice("abcdefg") for _ in range(6)) for _ in range(3000)]
    say = lambda n: " ".join(draw.choices(vocabulary, k=n))
    first, passage = say(120), say(60)
    edited = first.split()
    edited[60] = "changed"
    rows = [
        (0, first),
        (1, " ".join(edited)),
        (2, say(90)),
        (3, say(30) + " " + item),
        (4, "12 34"),
        (5, None),
        (6, say(50) + " " + passage + " " + say(50)),
        (7, say(50) + "\n" + passage + "\n" + say(50)),
    ]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "encoding":
            assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert seen == [{0, 1, 2, 3, 6, 7}, {0, 2, 3, 6, 7}, {0, 2, 3, 6, 7}, {0, 2, 6, 7}, {0, 2, 6, 7}]
    decoded = {r.doc_id: r.decoded for r in docs.collect()}
    assert decoded[0] == first and decoded[2] == rows[2][1] and decoded[6] == rows[6][1]
    assert passage.split()[5] not in decoded[7].split() or passage not in decoded[7]
    assert len(decoded[7].split()) == 100


@pytest.mark.parametrize(
    "page",
    [
        "<body class='has-sidebar'><article><p>kept</p></article></body>",
        "<body><main class='no-sidebar'><p>kept</p></main></body>",
        "<body><article class='post comments-open'><p>kept</p></article></body>",
        "<body><div class='content ad-free'><p>kept</p></div></body>",
        "<body><div class='layout-sidebar'><article><p>kept</p></article></div></body>",
        "<body><article><p>kept</p><div class='ad'>x</div></article><div class='related'><article>y</article></div></body>",
        "<body><article><p>kept</p></article><div class='comments content'>x</div></body>",
    ],
)
def test_names_do_not_drop_regions(page):
    assert wrappers.main_text(page, wrappers.own_wrapper(wrappers.parse(page))) == "kept"
