"""Wrappers: what is inferred, and the text of all pages against a plain reading of the article."""

import html
import json
import re

from brute import rows_of, with_clashes
from pyspark.sql import functions as F

from tallyward.llm import wrappers


def plain_article(page):
    inside = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?p>|</?h1>", inside))
    return "\n".join(b for b in blocks if b)


def test_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = wrappers.extract(with_clashes(pages))
    source = dict(rows_of(pages, "page_id", "html"))
    got = rows_of(found, "page_id", "text", "n_chars")
    assert len(got) == len(source)
    for key, text, n in got:
        assert text == plain_article(source[key]) and n == len(text)


def wrapper_of(*pages):
    whole = wrappers.page_wrapper(pages[0])
    for page in pages[1:]:
        whole = wrappers.align(whole, wrappers.page_wrapper(page))
    return whole


def test_slots_options_and_repeats():
    a = "<body><div class=top>Site</div><article>one</article><ul><li>x</ul></body>"
    b = "<body><div class=top>Site</div><section>extra</section><article>two<p>three</article><div class=box>1</div><div class=box>2</div></body>"
    whole = wrapper_of(a, b)
    found = wrappers.expression(whole)
    assert found.startswith("<body><div.top>=</>(<section>=</>)?<article>#</>") and "(<ul>=</>)?" in found and "(<div.box>#</>)+?" in found
    assert wrappers.read_parts(whole)[0] == ["body/article"]


def test_order_of_pages_does_not_matter_for_what_is_read():
    pages = [f"<body><div class=head>Site</div>{'<div class=x>' + str(i) + ' text</div>' if i % 2 else ''}<div class=main>body {i}</div></body>" for i in range(6)]
    assert wrappers.read_parts(wrapper_of(*pages)) == wrappers.read_parts(wrapper_of(*reversed(pages)))


CASES = [
    (1, None, None, ""), (2, "", "", ""),
    (3, "http://a.b/", "<div>Menu</div><div class='x'>One &amp; two<br>three <b>x</b>y<p>para\n two</div><div class=comments>c</div><form>f</form>", "One & two three xy\npara two"),
    (4, "http://a.b/", "<div>Menu</div><div class='x'>Other <p>text</div>", "Other\ntext"),
    (5, "http://c.d/", "<article><header><h1>T</h1></header>a &lt;b&gt; <aside>no</aside>z<script>if(a<b){}</script><div class='comments'>no</div></article> <footer>f", "T\na <b>\nz"),
    (6, "http://e/", "<p>" + "w " * 100_000, ("w " * 100_000).strip()), (7, "http://f/", "x < y <a href=\"foo>bar <", "x < y bar <"),
    (8, "http://g/", "<html><head><title>t<body><article>x</article>", "x"),
    (10, "http://i/", "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after", "deep\nafter"),
    (9, "http://h/", "<nav>n</nav><main>m<p>&copy; k&nbsp;l<style>p{}</style></main><div id=cookie-notice>c</div>", "m\n© k l"),
    (9, "http://h/", "<nav>n</nav><main>m<p>&copy; k&nbsp;l<style>p{}</style></main><div id=cookie-notice>c</div>", "m\n© k l"),
]


def test_odd_pages(spark):
    pages = spark.createDataFrame([c[:3] for c in CASES], "page_id long, url string, html string")
    got = sorted(rows_of(wrappers.extract(with_clashes(pages)), "page_id", "text"))
    assert got == sorted((c[0], c[3]) for c in CASES)
    assert wrappers.extract(pages.limit(0)).count() == 0


def test_broken_markup_is_read_in_linear_time():
    for part in ("<a ", '<a "', "<a '", "<![CDATA[", "<!", "<b>", "<div>", "</p"):
        assert isinstance(wrappers.main_text(part * 20_000 + "x", {""}, set()), str)


def test_one_wrapper_for_each_host(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").withColumn("host", wrappers.host_of(F.col("url")))
    found = wrappers.infer_wrappers(pages.repartition(9))
    assert found.count() == pages.select("host").distinct().count()
    for (wrapper,) in rows_of(found, "wrapper"):
        assert wrappers.read_parts(json.loads(wrapper))[0] == ["html/body/article"]


def texts_of(*pages):
    main, other = wrappers.read_parts(wrapper_of(*pages))
    return [wrappers.main_text(p, {*main}, {*other}) for p in pages]


def test_parts_that_few_pages_show_are_read():
    page = lambda i, more: f"<body><div class=top>Site</div><div class=date>May {i}</div>{more}</body>"
    stories = [page(i, f"<div class=story>story {i}</div>") for i in range(8)]
    odd = [page(8, "<section>whole main text</section>"), page(9, "<div class=story>story 9</div><table><tr><td>cell</table>")]
    want = [f"May {i}\nstory {i}" for i in range(8)] + ["May 8\nwhole main text", "May 9\nstory 9\ncell"]
    assert texts_of(*stories, *odd) == want and texts_of(*odd, *stories) == want[8:] + want[:8]
    # Two pages of many that show one text do not make it the template's.
    twice = [page(i, "<section>shown twice</section>") for i in (8, 9)]
    assert texts_of(*stories, *twice)[8:] == ["May 8\nshown twice", "May 9\nshown twice"]


def test_copies_but_for_a_date_keep_their_body():
    pages = [f"<body><div class=date>May {i}</div><div class=story>{'the same body ' * 9}</div></body>" for i in range(6)]
    assert texts_of(*pages) == [f"May {i}\n{('the same body ' * 9).strip()}" for i in range(6)]
