from __future__ import annotations

import html
import math
import random

from tidemark.llm.tag_paths import content_scores, extract, main_text

from .conftest import prose


def sentence(rng, n):
    return " ".join(prose(rng, n)).capitalize() + rng.choice([".", ", yes.", "!"])


NOISE = [
    "<nav><ul><li><a href='/a'>Start</a></li><li><a href='/b'>News, today</a></li></ul></nav>",
    "<header><div class='logo'>The Site</div></header>",
    "<div id='main-menu'><a>One</a> <a>Two</a></div>",
    "<aside><p>Read this as well, it is about something else, really.</p></aside>",
    "<div class='sidebar widget'><p>Archive of many, many things, sorted by month.</p></div>",
    "<div class='cookie-banner'><p>We use cookies, as everyone does, to count you.</p></div>",
    "<div class='ad'>Buy this now, it is cheap, and good.</div>",
    "<form action='/s'><label>Mail</label><input name='m'><button>Send</button></form>",
    "<script>var a = '<p>not text, at all.</p>';</script><style>p { margin: 0 }</style>",
    "<section id='comments'><div class='comment'><p>I think, dear author, that this is wrong, and long.</p></div></section>",
    "<footer><p>&copy; 2020 The Site, all rights reserved.</p></footer>",
    "<noscript>Switch scripts on, please.</noscript><!-- <p>hidden, text.</p> -->",
    "<div style='display:none'>invisible, text.</div><div hidden>gone, too.</div>",
]


def test_articles_come_out_whole_and_alone():
    rng = random.Random(9)
    shells = ["<article>{}</article>", "<main>{}</main>", "<div class='post-content'>{}</div>", "<div><div id='x1'>{}</div></div>",
              "<main><article class='has-sidebar'>{}</article></main>"]
    for k in range(60):
        paras = [sentence(rng, rng.choice([1, 3, 25, 60])) for _ in range(rng.randint(2, 6))] + [sentence(rng, 50)]
        title = "A headline & more"
        body = f"<h1>{html.escape(title)}</h1>" + "".join(
            f"<p>{html.escape(p).replace(' ', rng.choice([' ', chr(10), '  ', ' <b>', ' <br> ']), 1)}" + rng.choice(["</p>", ""]) for p in paras)
        before, after = rng.sample(NOISE, 3), rng.sample(NOISE, 3)
        page = ("<!DOCTYPE html><html><head><title>T, t.</title></head><body>" + "".join(before) + shells[k % len(shells)].format(body)
                + "".join(after) + "</body></html>")
        assert main_text(page)[0] == "\n\n".join([title, *paras]), page


def test_references_space_and_blocks():
    text = "<article><p>caf&eacute; &#x1F600;&nbsp;&lt;b&gt; &amp;amp;</p>\n<ul><li>one<li>two\n\t words</ul><table><tr><td>a</td><td>b</td></tr></table><pre>x\n y</pre></article>"
    assert main_text(text)[0] == "café \U0001F600 <b> &amp;\n\none\n\ntwo words\n\na b\n\nx y"
    assert main_text("no markup &lt; here")[0] == "no markup < here"
    assert main_text("<p>one<p>two <i>x</i>y</p>three")[0] == "one\n\ntwo xy\n\nthree"


def test_pages_without_an_article_are_empty():
    for page in (None, "", "<html></html>", "<nav><a>Home</a></nav>", "<script>x</script>", "<", "<p", "<!--", "&", "<div><a>only</a></div>"):
        assert main_text(page)[0] in ("", "<", "&"), page


def test_names_of_layout_do_not_hide_the_article():
    for name in ("overflow-hidden", "print-area", "has-sidebar", "no-comments", "with-banner"):
        assert main_text(f"<div class='{name}'><p>One text, and more.</p><p>Two texts, and more.</p></div>")[1] == 2, name
    page = "<article><p>Kept, <span class='ad'><span>x</span> y</span>and kept.</p><div class='hidden'>z</div></article>"
    assert main_text(page)[0] == "Kept, and kept."


def test_broken_and_very_long_pages():
    deep = "<div>" * 3000 + "<p>deep text, here.</p>"
    assert main_text(deep)[0] == "deep text, here."
    long = "<article>" + "".join(f"<p>paragraph {i}, text.</p>" for i in range(20_000)) + "</article>"
    assert main_text(long)[1] == 20_000


BODY = "".join(f"<p>Paragraph {i} of the article, with words, and more of them.</p>" for i in range(6))


def test_misleading_names_and_forms():
    """The article is there whatever the element around it is called."""
    want = main_text(f"<div>{BODY}</div>")
    assert want[1] == 6
    for shell in ("<div class='elementor-widget'>{}</div>", "<div class='content-with-sidebar'>{}</div>", "<div class='legal-text'>{}</div>",
                  "<div class='follow-us-post'>{}</div>", "<form id='form1'><div>{}</div></form>", "<a name='top'><div>{}</div>",
                  "<div class='widget'><form><div class='ad'>Buy, now.</div>{}</form></div>"):
        page = "<html><body><nav><a href='/'>Home</a></nav>" + shell.format(BODY) + "<div class='sidebar'><p>Other, things.</p></div></body></html>"
        assert main_text(page) == want, shell
    # beside an article, and for a short notice, the names hold
    aside = f"<div class='sidebar'>{BODY}{BODY}</div><article><p>Short, but the article.</p></article>"
    assert main_text(aside)[0] == "Short, but the article."
    assert main_text("<div class='cookie-banner'><p>We use cookies, as all do.</p></div>")[0] == ""
    assert main_text(f"<div id='comments'>{BODY}</div>")[0] == ""


def test_links():
    linked = "<p><a href='x'>A paragraph that is mostly a link to elsewhere</a>, see.</p>"
    assert main_text(f"<article>{BODY}{linked}</article>")[1] == 7
    items = "".join(f"<li><a href='/{i}'>Related story number {i}</a></li>" for i in range(5))
    assert main_text(f"<article>{BODY}<ul>{items}</ul></article>")[1] == 6
    some = "<ul><li>Plain item, one.</li><li><a href='x'>linked item</a></li><li>Plain item, two.</li></ul>"
    assert main_text(f"<article>{BODY}{some}</article>")[1] == 9
    cards = "".join(f"<a href='/{i}'><div>Card, number {i}, to elsewhere.</div></a>" for i in range(4))
    assert main_text(f"<div>{BODY}<div>{cards}</div></div>")[1] == 6


def test_marked_sections_are_comments():
    for piece in ("<![x]>", "<![ foo>", "<![%x;[y]]>", "<![CDATA[x]]>", "<![if IE]>", "<!x>", "<?x>"):
        assert main_text(f"<p>one, two.</p>{piece}<p>three, four.</p>")[0].replace("]]>", "") == "one, two.\n\nthree, four.", piece
    assert main_text("<p>text, here.</p><![")[0] == "text, here."


def test_no_page_raises():
    rng = random.Random(3)
    bits = ["<", ">", "<!", "<![", "]]>", "<!--", "-->", "<p>", "</p>", "<div class='ad'>", "</div>", "<a href=x>", "</a>", "<li>", "<table>", "<td>",
            "&amp", "&#x110000;", "&#0;", "word, ", "'", '"', "=", "<h1>", "</h1>", "<article>", "</article>", "<form>", "<br/>", "<svg/>", "<script>",
            "</script>", "<?", "%x;", "[", "\x00", "\u2028", "<hr>", "<textarea>", "<title>", "</title>", "<A HREF=", "<p hidden>", "<header>"]
    for _ in range(4000):
        text, n = main_text("".join(rng.choice(bits) for _ in range(rng.randint(1, 40))))
        assert isinstance(text, str) and n >= 0


def test_depth_costs_nothing():
    """Time of open elements grows with their number, not with its square."""
    import time

    def seconds(n, piece):
        best = 9e9
        for _ in range(2):
            began = time.perf_counter()
            main_text(piece * n)
            best = min(best, time.perf_counter() - began)
        return best

    for piece in ("<div>x", "<div><p>", "<ul><li>x</b></i>"):
        assert seconds(16_000, piece) < 10 * seconds(4_000, piece)


def test_path_ratios_against_plain_python():
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["a", "word", "of,", "text."]) for _ in range(rng.randint(1, 30))) for _ in range(40)]
    paths, linked = [rng.randrange(5) for _ in texts], [rng.choice([0, 0, 3, 900]) for _ in texts]
    fused = []
    for p in paths:
        mine = [i for i, q in enumerate(paths) if q == p]
        chars = sum(len(texts[i]) for i in mine)
        punct = sum(c in ".,;:!?" for i in mine for c in texts[i])
        link = sum(min(linked[i], len(texts[i])) for i in mine)
        fused.append(chars / len(mine) * (1 + punct / len(mine)) * (1 - link / chars))
    weight = [math.exp(-d * d / 2) for d in (-2, -1, 0, 1, 2)]
    for i, got in enumerate(content_scores(texts, paths, linked)):
        near = [(w, fused[i + d]) for w, d in zip(weight, (-2, -1, 0, 1, 2)) if 0 <= i + d < len(fused)]
        assert abs(got - sum(w * f for w, f in near) / sum(w for w, _ in near)) < 1e-9 * (1 + got)


def test_rows(spark):
    rows = [(1, "u", "<p>a, b.</p>", 1), (1, "u", "<p>a, b.</p>", 1), (None, None, None, 2), (2, "v", "", 3)]
    d = spark.createDataFrame(rows, "page_id bigint, url string, html string, n_chars int")
    got = sorted(((r.page_id, r.url, r.text, r.n_chars) for r in extract(d).collect()), key=str)
    assert got == sorted([(1, "u", "a, b.", 5), (1, "u", "a, b.", 5), (None, None, "", 0), (2, "v", "", 0)], key=str)
    assert extract(d.limit(0)).count() == 0
