"""Main text of pages: parsing, wrapper inference, and pages whose main text is known."""

from __future__ import annotations

import html as references
import json
import re

import pytest

from touchline.llm import wrappers as w
from touchline.llm.common import prepare, table


@pytest.fixture(scope="module")
def pages_of(spark):
    prepare(spark)
    return lambda rows: spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")


def texts(frame):
    return {r["page_id"]: r["text"] for r in w.extract(frame).collect()}


def read(html, wrapper=()):
    page = w.Page(html)
    return page.main_text(w.kept(page.members, list(wrapper)))


def test_streams_are_folded():
    shape = lambda html: w.shape(w.Page(html).members)
    assert shape("<ul><li>a<li>b</li><li><img><i>c</i></ul>") == "<ul>(<li>#</li>)+</ul>"
    assert shape("<div><h2>a</h2><p>b<p>c<h2>d</h2><p>e</div>") == "<div>(<h2>#</h2>(<p>#</p>)+)+</div>"
    assert shape("<ul><li>a<li><h3>x</h3>b</ul>") == "<ul>(<li>(<h3>#</h3>)?#</li>)+</ul>"
    many = "".join(f"<x{i % 60}>t</x{i % 60}>" for i in range(100))
    assert shape(many).startswith("((<x0>#</x0>)?(<x1>#</x1>)?") and shape(many).endswith(")*")
    assert len(w.Page("<div>" * 5000 + "deep" + "</div>" * 4000).texts) == 1


def test_alignment_makes_optional_and_repeated_groups():
    one, two = (w.Page(h).members for h in ("<b class=ad>x</b><h1>a</h1><p>1<p>2", "<h1>b</h1><p>1<table><tr><td>z</table>"))
    both = w.aligned(one, two)
    assert w.shape(both) == "(<b!>#</b!>)?<h1>#</h1>(<p>#</p>)+(<table><tr><td>#</td></tr></table>)?"
    assert w.shape(w.aligned(both, both)) == w.shape(both)
    sections = w.aligned(w.Page("<h2>a</h2><p>b<h2>c</h2><p>d").members, w.Page("<p>only").members)
    assert w.shape(sections) == "((<h2>#</h2>)?(<p>#</p>)?)*" or w.shape(sections) == "((<h2>#</h2>)?(<p>#</p>)?)+"
    assert json.loads(json.dumps(w._bare(both))) == w._bare(both)


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("", ""),
        ("plain &lt;text&gt; &amp; more", "plain <text> & more"),
        ("<article>a<b>b</b> <i>c</i>\n\t d<br>e</article>", "ab c d e"),
        ("<nav>m</nav><article><h1>T</h1><p>x &copy; &#x41;&am", "T x © A&am"),
        ("<article><p>one<p>two</article><footer>f</footer></body>", "one two"),
        ("<script>if (a<b) '</p>'</script><style>p{}</style><article>x</article>", "x"),
        ("<article>x<!-- hidden <p>y</p> -->z</article>", "xz"),
        ("<header>Site</header><article><header><h1>T</h1></header>x<footer>by</footer></article>", "T x"),
        ("<div class='page has-sidebar'><div class=sidebar>s</div><article>x</article></div>", "x"),
        ("<article>x<div id=comments><article class=comment>c</article></div></article>", "x"),
        ("<div class='related'><article>teaser</article></div><main><p>x</p></main>", "x"),
        ("<main>lead<article>x</article></main>", "x"),
        ("<div class=entry-content><p>x</p><form>f<p>g</p></form></div><div>other</div>", "x"),
        ("<p>see <span class='ad'>buy</span> this</p>", "see this"),
        ("<div><a href=x>one</a> <a href=y>two</a></div><div>real text here</div>", "real text here"),
        ("<article><p>5 < 6 and <3</p><div></p></span>y</article>", "5 < 6 and <3 y"),
        ('<article><p title="a > b">x</p><p title="open>y</p></article>', "x y"),
        ("<article>cut <a href='", "cut"),
        ("<template>t</template><noscript>n</noscript><svg><text>s</text></svg><p>x</p>", "x"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl></article>", "a b c d e"),
    ],
)
def test_pages_alone(html, want):
    assert read(html) == want


def page(k, body):
    return f"<body><div>Welcome to our site</div><div><h2>Story {k}</h2><p>Text {k} and more</p></div><div>{body}</div></body>"


def test_wrappers_tell_template_from_data(pages_of):
    rows = [(k, "http://Site.example/x", page(k, "Call us any time")) for k in range(w.PAGES + 5)]
    rows += [(100 + k, "http://small.example/", page(k, "Call us any time")) for k in range(3)]
    rows += [(200 + k, "http://kept.example/", f"<article><h1>T{k}</h1><p>same</p><p>x{k}</p><p>Share this</p></article>") for k in range(40)]
    rows += [(300 + k, "http://copies.example/", "<article><h1>One</h1><p>text</p></article>") for k in range(40)]
    got = texts(pages_of(rows))
    assert got[3] == "Story 3 Text 3 and more"
    assert got[101] == "Welcome to our site Story 1 Text 1 and more Call us any time"
    assert got[205] == "T5 same x5 Share this"  # paragraphs repeat, so none of them is a place of its own
    assert got[300] == "One text"
    shown = {r["host"]: r["wrapper"] for r in w.expressions(pages_of(rows)).collect()}
    assert shown["kept.example"] == "<article@1><h1>#</h1>(<p>#</p>)+</article@1>"


def test_results_do_not_depend_on_partitions(pages_of):
    rows = [(k, f"http://h{k % 3}/", page(k, "x" if k % 2 else "<ul><li>a" + "<li>b" * (k % 5)) + "<p>" * (k % 7)) for k in range(150)]
    frame = pages_of(rows)
    assert texts(frame) == texts(frame.repartition(40)) == texts(frame.coalesce(1))


def test_every_row_is_kept(pages_of):
    long = "<article>" + "".join(f"<p>para {i}</p><h{i % 3}>s</h{i % 3}>" for i in range(20_000)) + "</article>"
    rows = [(1, None, None), (None, "no host", "<p>x"), (2, "http://a/", ""), (2, "http://a/", ""), (3, "http://a/", long)]
    rows += [(4, "http://user@A:80/p", "<a " * 3000), (5, "", "<" * 3000), (6, "u", "<div>" * 3000 + "t")]
    found = w.extract(pages_of(rows))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = found.collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r for r in got}
    assert by[None]["text"] == "x" and by[1]["text"] == "" and by[1]["url"] is None and by[4]["text"] == ""
    assert by[3]["text"].startswith("para 0 s para 1 s") and by[3]["text"].endswith("para 19999 s") and by[6]["text"] == "t"
    assert w.extract(pages_of([])).count() == 0


def test_given_pages_equal_a_plain_reading(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    got = texts(pages)
    for r in pages.collect():
        inner = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = re.split("</?(?:h1|p)>", re.sub("</?b>", "", inner.replace("<br>", " ")))
        blocks = [" ".join(references.unescape(b).split()) for b in blocks]
        assert got[r["page_id"]] == " ".join(b for b in blocks if b)
