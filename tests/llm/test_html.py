import pytest

from covisit.llm import html_extraction as h
from covisit.llm.queries import QUERIES

from .tools import SMALL, frame, rows_of

SCHEMA = "page_id long, url string, html string, text string"


def read(page, template=None):
    return h.extract(page, template or {}, {})


@pytest.mark.parametrize("page, text", [
    ("<nav>Menu</nav><article><h1>T &amp; x</h1><p>a  b\n c<p>d</article><footer>f</footer>", "T & x\na b c\nd"),
    ("<body><header>top</header><div class='sidebar'>s</div><div id=content><p>one</p>two<br>three</div>", "one\ntwo\nthree"),
    ("<main><p>a<b>b</b> c</p><aside>no</aside><form>no<p>no</p></form><ul><li>x<li>y</ul></main>tail", "ab c\nx\ny"),
    ("<article><header><h1>Head</h1></header><p>a</p><section class='comments'><article><p>reader</p></article></section></article>", "Head\na"),
    ("<article><p>a</p><div class='ad-banner'>no</div><div class='shadow'>yes</div><script>if (a<b) '</p>'</script><style>p{}</style><p hidden>no</p></article>", "a\nyes"),
    ("<article><p>1 &lt; 2 &#233; &am <i>it</i>s</p><!-- <p>no</p> --></article", "1 < 2 é &am its"),
    ("<div class='cookie-notice'>no</div><div role='navigation'>no</div><p>a</p><div style='display: none'>no</div>", "a"),
    ("", ""), ("plain  text", "plain text"), ("<article><p>", ""), ("a < b", "a < b"), ("<p a='>'>x</p>", "x"),
])
def test_pages(page, text):
    assert read(page) == text


def test_folding_and_alignment():
    row = ["<li>", "#", "</li>"]
    assert h.fold(["<ul>", *row * 3, "</ul>"]) == ["<ul>", ("+", tuple(row)), "</ul>"]
    assert h.align(["<a>", "#", "</a>"], ["<a>", "</a>"]) == ["<a>", ("?", ("#",)), "</a>"]
    pages = ["<ul><li>a</li><li>b</li></ul><p>x</p>", "<ul><li>a</li></ul><p>y</p>", "<ul><li>a</li><li>b</li><li>c</li></ul><h2>z</h2><p>y</p>"]
    wrapper = h.infer(pages)
    assert ("p",) not in h.repeated_paths(wrapper) and ("ul", "li") in h.repeated_paths(wrapper)
    assert h.infer([pages[0]] * 4) == h.infer([pages[0]])


def test_a_hosts_own_template_text_goes():
    pages = [f"<div><h6>Our site</h6><h1>Title {k}</h1><p>Text {k}</p><p>More {k}</p></div>" for k in range(10)]
    template = h.template_texts(pages, h.infer(pages))
    assert read(pages[3], template) == "Title 3\nText 3\nMore 3"
    assert h.template_texts(pages[:1] * 20, h.infer(pages[:1])) == {}


def test_constant_text_of_articles_stays():
    pages = [f"<article><h2>Abstract</h2><h1>One title</h1><p>Text {k}</p></article>" for k in range(10)]
    assert read(pages[3], h.template_texts(pages, h.infer(pages))) == "Abstract\nOne title\nText 3"


def test_a_long_page_is_several_streams_with_whole_paths(monkeypatch):
    page = "<div><section>" + "<h4>a</h4>" * 20 + "<ul>" + "<li>x</li>" * 20 + "</ul></section></div>"
    whole = [x for x in next(h.token_streams(page))]
    monkeypatch.setattr(h, "STREAM_TOKENS", 10)
    streams = list(h.token_streams(page))
    assert len(streams) > 5 and all(s[:2] == ["<div>", "<section>"] for s in streams)
    assert sum(len(s) for s in streams) >= len(whole)
    assert {("div", "section", "h4"), ("div", "section", "ul", "li")} <= h.repeated_paths(h.infer([page]))


def test_templates_come_from_all_pages_of_a_host(spark, monkeypatch):
    """On no 12 of these pages can one tell what 90 % of all share, and only a few show a repetition."""
    monkeypatch.setattr(h, "ALIGNED", 3)
    pages = [f"<div><h6>{'Our site' if k % 100 < 91 else k}</h6><h5>{'Often' if k % 100 < 89 else k}</h5><ul>{'<li>Item</li>' * (1 + (k == 77))}</ul>"
             + "<p>Text</p><h3>x</h3>" * (k % 7) + f"<p>Text {k}</p></div>" for k in range(200)]
    rows = [{"page_id": k if k % 2 else None, "url": f"http://h/{k}", "html": p} for k, p in enumerate(pages)]
    found = {r["host"]: r["template"] for r in h.wrappers(frame(spark, rows + rows[:60], SCHEMA).repartition(5)).collect()}
    expected = h.template_texts(pages, h.infer(pages))
    assert {k: h.json.loads(v) for k, v in found.items()} == {"h": expected} and "Our site" in expected.values()
    assert not {"Often", "Item"} & set(expected.values())
    texts = [r["text"] for r in h.main_texts(frame(spark, rows, SCHEMA)).collect()]
    assert len(texts) == 200 and not any("Our site" in t for t in texts) and sum("Often" in t for t in texts) == 178


def main_text(page):
    """The supplied pages' article, by their own simple form."""
    import html
    import re

    inside = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    blocks = re.split(r"</?(?:p|h1|br)>", inside)
    lines = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_query(spark):
    rows = rows_of("pages")
    expected = {r["page_id"]: (r["url"], main_text(r["html"])) for r in rows}
    found = QUERIES["op2_html_extraction"](spark, SMALL).collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in found} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in found)


def test_odd_tables(spark):
    assert h.main_texts(frame(spark, [], SCHEMA)).count() == 0
    rows = [{"page_id": 1, "url": None, "html": None}, {"page_id": None, "url": "x", "html": "<p>a"}, {"page_id": 2, "url": "http://H/", "html": ""},
            {"page_id": 2, "url": "http://h/", "html": "<p>b"}, {"page_id": 3, "url": "http://h/1", "html": "<p>" + "long " * 100_000}]
    found = h.main_texts(frame(spark, rows, SCHEMA)).collect()
    assert sorted(r["text"][:4] for r in found) == ["", "", "a", "b", "long"] and max(r["n_chars"] for r in found) == 499_999
