"""Main text of pages: repeats beside brute force, layouts, odd markup."""

import random
from collections import defaultdict

import numpy as np
import pytest

from chatloom.llm import pages

SCHEMA = "page_id long, url string, html string, h string, s long, k long, text string, n_chars int"


def table_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "h", 1, 2, "t", 3) for i, u, h in rows], SCHEMA)


def texts(spark, rows, **options):
    return {r.page_id: r.text for r in pages.extract_pages(table_of(spark, rows), **options).collect()}


@pytest.mark.parametrize("window", [1, 2, 5, 8])
def test_repeats_are_those_of_brute_force(window):
    draw = random.Random(window)
    shared = [[draw.randrange(50) for _ in range(draw.randint(1, 14))] for _ in range(6)]
    streams = []
    for _ in range(30):
        one = []
        while len(one) < draw.randint(0, 60):
            one += draw.choice(shared) if draw.random() < 0.4 else [draw.randrange(50)]
        streams.append(one)
    keys = [draw.randrange(12) for _ in streams]
    tokens = np.array([t for s in streams for t in s])
    page, key = np.repeat(np.arange(30), list(map(len, streams))), np.repeat(keys, list(map(len, streams)))
    where = defaultdict(set)
    for s, k in zip(streams, keys, strict=True):
        for i in range(len(s) - window + 1):
            where[tuple(s[i : i + window])].add(k)
    want = []
    for s in streams:
        hit = [False] * len(s)
        for i in range(len(s) - window + 1):
            if len(where[tuple(s[i : i + window])]) >= 3:
                hit[i : i + window] = [True] * window
        want += hit
    assert pages.repeated(tokens, page, key, window, 3).tolist() == want
    assert pages.repeated(tokens[:0], page[:0], key[:0], window, 3).tolist() == []


BODY = "<h1>A head &amp; more</h1><p>First &lt;para&gt; of\n the <b>te</b>xt.<br>Second line.<p>Third <a href='/x'>link</a> here"
WANT = "A head & more First <para> of the text. Second line. Third link here"
JUNK = '<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>'


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p><article>';</script></head><body>{JUNK}<div class='ad'>Buy this</div><article>{BODY}</article><footer>&copy; x</footer></body></html>",
        f"<body class='has-sidebar'><header><div>Site name</div></header><main>{BODY}<aside>Also read</aside><form><label>Mail</label><input></form></main><div id='sidebar'><p>Side</p></div>",
        f"<div class='site-header'>Site</div><div class='post-content'>{BODY}<div class='share-buttons'>Share this</div></div><section id='comments'><article class='comment'><p>Nice one</p></article></section>",
        f"<div class='page-with-sidebar'>{JUNK}<div>{BODY}</div><div class='sidebar'><p>Side</p></div><div class='cookie-notice'>We use cookies</div></div>",
        f"<article><header>{BODY}</header><!-- a > b --><script>1<2</script><noscript>no</noscript><section class='comments'><p>Reader says</p></section></article>",
        f"<div hidden>not shown</div><div style='display: none'>nor this</div><div role='main'>{BODY}</div><div role='contentinfo'>foot</div>",
        f"<main><div class='breadcrumbs'>a / b</div><article>{BODY}</article><div>Previous and next</div></main>",
        f"<div class='modal'><article>{BODY}</article></div>",
    ],
)
def test_layouts(page):
    blocks, met = pages.blocks_of(page)
    assert " ".join(blocks[i].text for i in pages.chosen(blocks, met, [0.0] * len(blocks))) == WANT


def test_odd_markup():
    def text(page):
        blocks, met = pages.blocks_of(page)
        return " ".join(blocks[i].text for i in pages.chosen(blocks, met, [0.0] * len(blocks)))

    assert text("<") == "<"
    assert text("") == text("<article></article><nav>menu</nav>") == text("<!-- never closed <p>x</p>") == text("<script>never closed <p>x</p>") == ""
    assert text("a < b and c <d e") == "a < b and c"
    assert text("<p title=\"a>b\" data-x='<p>'>one</p></div></article>two") == "one two"
    assert text('<p title="never closed>one</p><p>two</p>').endswith("two")
    assert text("<P>Un&eacute;&nbsp;&#8217; &bogus; &#x1F600;</P>") == "Uné ’ &bogus; 😀"
    assert text("plain text only") == "plain text only"
    assert text("<ul><li>one<li>two</ul><table><tr><td>a<td>b</table>") == "one two a b"
    assert text("<p>" * 3000 + "deep" + "<div>" * 3000) == "deep"
    long = "word " * 400_000
    assert text(f"<article><p>{long}</p></article>") == long.strip()


def test_template_of_a_host_goes_and_articles_that_copy_each_other_stay(spark):
    draw = random.Random(4)

    def sentence(n):
        return " ".join("".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(n)) + "."

    top, foot, passage = sentence(14), sentence(20), sentence(60)
    rows, want = [], {}

    def page(i, host, parts):
        rows.append((i, f"https://{host}/p{i}", f"<div><div>{top}</div><div><p>" + "</p><p>".join(parts) + f"</p></div><div>{foot}</div></div>"))
        want[i] = " ".join(parts)

    for i in range(12):
        page(i, "one.example.com", [sentence(90), sentence(20)])
    for i in range(12, 18):  # a passage that articles share lies inside them
        page(i, "one.example.com:8080", [sentence(80), passage, sentence(30)])
    copied = [sentence(100), sentence(12)]
    for i in range(18, 24):  # copies on one host: none of it is a template
        page(i, "one.example.com", copied)
    got = texts(spark, rows)
    assert got == want
    # two pages don't show a template
    assert texts(spark, [(1, "http://a.b/1", rows[0][2]), (2, "http://a.b/2", rows[1][2])])[1] == f"{top} {want[0]} {foot}"
    # in shards of a few pages the template is found as well
    many = [(i, "http://big.example.com/x", f"<div>{top}</div><div><p>{(t := sentence(60))}</p></div>") for i in range(60)]
    assert all(top not in t for t in texts(spark, many, shard=6000).values())


def test_size_of_shards_changes_nothing(spark):
    draw = random.Random(5)
    sentence = lambda n: " ".join(f"w{draw.randrange(3000)}" for _ in range(n))
    # notes that three, four or two pages of a host share, so that no shard has them all
    notes = [sentence(draw.randint(8, 20)) for _ in range(60)]
    rows = []
    for i in range(150):
        own = "".join(f"<p>{sentence(30)}</p><div>{notes[n]}</div>" for n in range(60) if (i * 7 + n * 11) % 47 == 0)
        rows.append((i, f"http://{'one' if i % 3 else 'two'}.example.com/{i}", f"<div>{own}<p>{sentence(40)}</p></div>"))
    rows += [(200, "http://one.example.com/c", rows[1][2]), (201, None, None), (202, "http://one.example.com/e", ""), (203, "http://two.example.com/s", "<p>few words</p>")]
    want = sorted(pages.extract_pages(table_of(spark, rows)).collect(), key=lambda r: r.page_id)
    assert sum(r.n_repeated for r in want) > 20
    for shard in (3000, 20_000):
        assert sorted(pages.extract_pages(table_of(spark, rows), shard=shard).collect(), key=lambda r: r.page_id) == want


def test_rows_of_all_kinds(spark):
    rows = [(None, None, None), (1, None, ""), (1, "http://x.y/", "<p>same</p>"), (1, "http://x.y/", "<p>same</p>"), (2, "no url", "<p>a</p>"), (3, "//Host.Example/a", "<p>b</p>")]
    out = pages.extract_pages(table_of(spark, rows))
    assert out.columns == ["page_id", "url", "text", "n_chars", "n_blocks", "n_repeated"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in out.collect()) == [(0, "", 0), (1, "", 0), (1, "same", 4), (1, "same", 4), (2, "a", 1), (3, "b", 1)]
    assert pages.extract_pages(table_of(spark, rows).filter("page_id > 9")).count() == 0


def test_op11_on_the_given_pages(spark):
    import html
    import re

    from chatloom.llm import queries

    folder = "/root/testdata/sf0.001"
    given = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in queries.op11_main_text(spark, folder).collect()}
    for i, page in given.items():
        article = re.sub("</?b>", "", re.sub("</?(p|h1|br)>", " ", re.search("<article>(.*)</article>", page, re.S)[1]))
        want = " ".join(html.unescape(article).split())
        assert got[i] == (want, len(want))
