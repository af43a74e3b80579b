from __future__ import annotations

import html
import itertools
import random
import re
import time

from terrace.llm.html_extraction import extract, host_of, wrappers
from terrace.llm.html_wrappers import Model, article, common, expression, fold, infer, model_of, nodes_of, read

from ..conftest import SF001


def test_whole_pages_against_the_template(spark):
    """The test pages have one template, so their article can be cut out by hand."""
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    source = {r["page_id"]: r["html"] for r in pages.collect()}
    got = extract(pages).collect()
    assert len(got) == len(source)
    for r in got:
        body = re.search(r"<article>(.*?)</article>", source[r["page_id"]], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body))
        assert r["text"] == "\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def page(title, paragraphs, menu, ad=""):
    items = "".join(f"<li><a href=/{m}>{m}</a>" for m in menu)
    body = "".join(f"<p>{p}" for p in paragraphs)
    return (
        f"<html><body><div id=top><ul>{items}</ul></div>{ad}<div class='wrap'><h2>{title}</h2>{body}"
        "<div class='share'><p>Share this</p></div></div><div class=bottom><p>About this site and its long list of terms</p></div>"
    )


SITE = [
    page("First &lt;1&gt;", ["Some <i>it</i>alic words here&nbsp;ok<br>next.", "Second one of them"], ["Home", "News"]),
    page("Other", ["A third text that is different", "More", "And more of it"], ["Home", "Sport", "Arts"], "<aside>Buy now</aside>"),
    page("Last", ["Only one paragraph, but a long one so that it counts"], ["Home"]),
]


def test_wrapper_of_an_unmarked_site():
    pages = [read(s) for s in SITE]
    text = expression(infer(pages))
    assert ")+" in text and ")?" in text and "#TEXT" in text and "'About this site" in text and "|" not in text
    model, _ = model_of(pages)
    assert model.holder.endswith("div.wrap")
    assert article(pages[0], model) == "First <1>\nSome italic words here ok next.\nSecond one of them"
    assert article(pages[1], model) == "Other\nA third text that is different\nMore\nAnd more of it"


def test_folding_finds_nested_repeats():
    tokens = read("<ul>" + "<li><b>x</b><b>y</b></li>" * 3 + "</ul>")
    assert expression(nodes_of(tokens)) == "<ul> (<li> (<b> #TEXT </b>)+ </li>)+ </ul>"
    assert fold([]) == []


def test_everything_that_is_not_the_article():
    source = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header>Site</header><nav>Menu</nav>
    <div class="cookie-notice">Accept</div><main><article><header><h1>Head &amp; line</h1></header><p>One<script>var x = "<p>no</p>";</script>
    two &#233; &unknown; &copy</p><!-- <p>hidden</p> --><form><p>Search</p><button>Go</button></form>
    <div class="adBox ad">Buy</div><ul><li>item 1<li>item 2</ul><section id="comments"><p>nice</p></section></article></main>
    <aside>Side</aside><footer>Foot</footer>"""
    model, _ = model_of([read(source)])
    assert article(read(source), model) == "Head & line\nOne two é &unknown; ©\nitem 1\nitem 2"


def test_odd_inputs(spark):
    rows = [
        (1, None, None), (2, "http://a.b/x", ""), (3, "not a url", "<p>un&am closed <b>text"), (4, "http://A.b:80/", "plain &lt;text"),
        (4, "http://A.b:80/", "plain &lt;text"), (None, "https://u@h.c?q", "<article><p>x</article><!-- open"), (6, "http://long", "<p>" + "word " * 50_000),
        (7, "http://cut", "<article><p>end of it</p><div class='a"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as host", "'y' as model", "1 as n_chars")
    got = {(r["page_id"], r["text"][:40]): r["n_chars"] for r in extract(df).collect()}
    assert got[1, ""] == got[2, ""] == 0 and got[3, "un&am closed text"] == 17 and (4, "plain <text") in got
    assert (None, "x") in got and got[6, ("word " * 8)] == 249_999 and (7, "end of it") in got
    assert extract(df).count() == len(rows)
    assert {r["h"] for r in df.select(host_of(df["url"]).alias("h")).collect()} == {"", "a.b", "h.c", "long", "cut"}
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract(empty).count() == 0 and wrappers(empty).count() == 0


def test_class_words_around_the_article():
    """Words of an aside on a wrapper do not exclude the article; beside and inside it they count."""
    inner = "<article><h1>Head</h1><p>The text itself</p><div class=share>Share</div></article><div id=comments><article class=comment>First!</article></div>"
    for around in (
        "<html class=cookie-set><body class='single has-sidebar'>{}", "<body><div id='layout-menu-open'>{}</div><div class=sidebar>Side</div>",
        "<div class='single comments-on'><div class=has-sidebar>{}</div></div><footer>Foot</footer>", "<main class=has-sidebar>{}</main>",
        "<main><div class='content has-sidebar'>{}</div></main>", "<div class=has-sidebar>{}</div><article>Teaser</article>",
    ):
        source = read(around.format(inner))
        model, _ = model_of([source])
        expected = "Head\nThe text itself" + ("\nTeaser" if "Teaser" in around else "")
        assert article(source, model) == expected, around
    source = read("<div class=wrap><p>All that this page has to say</p></div><div id=comments><article class=comment>First!</article></div>")
    assert article(source, model_of([source])[0]) == "All that this page has to say"
    # A main element inside the navigation or another hard mark stays out.
    source = read("<nav><article>Menu</article></nav><article class='post has-sidebar'>Text</article>")
    assert article(source, model_of([source])[0]) == "Text"


def test_hosts_of_copies_and_of_two_layouts(spark):
    """Unmarked hosts: one text under many urls, a few others beside them, and a rare second layout."""
    n = iter(range(10**6))
    words = lambda k: " ".join(f"word{next(n)}" for _ in range(k))
    menu = ["Home", "News"]
    rows, truth = [], {}

    def put(host, html_text, text):
        rows.append((len(rows), f"http://{host}/{len(rows)}", html_text))
        truth[len(rows) - 1] = text

    def one(host, title, body):
        put(host, page(title, body, menu), "\n".join([title, *body]))

    def two(host, title, body):
        html_text = "<body><table><tr><td class=left><a href=/>Home</a></td><td class=text><h1>{}</h1>{}</td></tr></table><p class=end>About it</p>"
        put(host, html_text.format(title, "".join(f"<p>{b}</p>" for b in body)), "\n".join([title, *body]))

    copy = (words(4), [words(30), words(20)])
    for _ in range(40):
        one("copies", *copy)
        one("most", *copy)
    for _ in range(5):
        one("most", words(4), [words(25), words(15)])
    for i in range(60):
        (two if i % 3 == 0 else one)("mixed", words(4), [words(25), words(15)])
    for i in range(200):
        (two if i == 77 else one)("rare", words(4), [words(25), words(15)])
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in extract(df).collect()}
    assert got == truth


def _host(n, build):
    return [read(build(i, " ".join(f"w{i}x{k}" for k in range(40)))) for i in range(n)]


def test_the_wrapper_decides_on_marked_pages():
    """A notice without any mark inside the article: constant on the host's pages, so template."""
    def build(i, body):
        return f"<article><h2>Summary</h2><p>{body}</p><section><p>Read on with a paid plan</p></section></article>"

    pages = _host(5, build)
    model, wrapper = model_of(pages)
    assert model.marked and "'Read on with a paid plan'" in expression(wrapper)
    own = article(pages[0], Model({}, "", {}))
    assert own.endswith("Read on with a paid plan")
    assert article(pages[0], model) == own.removesuffix("\nRead on with a paid plan")
    # Two pages, or copies of one text, are no evidence for a template.
    assert article(pages[0], model_of(pages[:2])[0]) == own
    assert article(pages[0], model_of([pages[0]] * 5)[0]) == own


def test_slots_overrule_tags_around_something_else():
    """An article element around a teaser, the text in a plain element: the slots outside outweigh it."""
    def build(i, body):
        return f"<div class=x1><article><p>Teaser {i}</p></article></div><div class=x2><p>{body}</p><p>{body[::-1]}</p></div>"

    pages = _host(4, build)
    model, _ = model_of(pages)
    assert model.holder.endswith("div.x2")
    assert article(pages[1], Model({}, "", {})) == "Teaser 1"
    assert article(pages[1], model).startswith("w1x0 w1x1") and "Teaser" not in article(pages[1], model)
    # A layout of marked pages says nothing about pages without marks.
    other = read("<table><tr><td>Some words of another layout</table>")
    assert article(other, model) == "Some words of another layout"


def test_a_slot_is_labelled_by_most_of_its_characters():
    """A role on most pages marks a place; on a page that lacks the role, the slot's label holds."""
    def build(i, body):
        role = "" if i == 3 else " role=main"
        return f"<main><p>Note {i}</p></main><div class=t{role}><p>{body}</p></div>"

    pages = _host(6, build)
    model, _ = model_of(pages)
    assert article(pages[3], Model({}, "", {})) == "Note 3"
    assert article(pages[3], model) == "Note 3\n" + " ".join(f"w3x{k}" for k in range(40))


def test_alignment_is_a_common_subsequence_and_near_linear():
    rng = random.Random(3)
    for n in (0, 5, 40, 300):
        a = [rng.choice("abcdef") for _ in range(n)]
        b = [x for x in a if rng.random() < 0.8] + [rng.choice("abcxyz") for _ in range(n // 3)]
        pairs = common(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < x and j < y for (i, j), (x, y) in itertools.pairwise(pairs))
        assert len(pairs) >= len(b) // 4 and common(a, a) == [(i, i) for i in range(n)]
    # Inserted runs among unique tokens: everything shared is found.
    a = list(range(5000))
    b = [x for k in a for x in ([k] if k % 7 else [k, "in", "in"])]
    assert len(common(a, b)) == 5000

    def varied(n):
        return read("<article>" + "".join(f"<div class={rng.choice('abcdefgh') * rng.randint(1, 3)}><p>t{rng.random()}</p></div>" for _ in range(n)))

    start = time.process_time()
    wrapper = infer([varied(10_000), varied(10_000)])
    assert wrapper and time.process_time() - start < 30


def test_deep_pages_are_read_in_linear_time():
    for source in ("<div class=x>" * 50_000 + "text", "<x-y class=ad>" * 50_000 + "text</i>" * 5_000, "<article>" * 20_000 + "text<p>" * 5_000,
                   "<b>" * 50_000 + "<p>text</b></i>" * 2_000):
        start = time.process_time()
        got = read(source)
        assert got.texts and max(len(t.path) for t in got.texts) < 40
        article(got, model_of([got])[0])
        assert time.process_time() - start < 10
