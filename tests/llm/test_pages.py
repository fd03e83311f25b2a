"""HTML extraction and url rules."""

import random

import numpy as np
import pytest

from steadycare.llm import html_template, url_digest


def text_of(html):
    return "\n".join(t for t, _ in html_template.Page(html).main_blocks())


@pytest.mark.parametrize("html, want", [
    ("", ""),
    ("plain  text", "plain text"),
    ("<p>a<p>b<br>c", "a\nb\nc"),
    ("<article><h1>T</h1><p><b>x &amp; y<br><p>z&nbsp;&lt;w&gt;</article><footer>f</footer>", "T\nx & y\nz <w>"),
    ("<body><nav>n</nav><header>h</header><main><p>m</p></main><aside>s</aside>", "m"),
    ("<script>var t='</p>';</script><style>p{}</style><p>a<!-- <p>no</p> --></p><form>f<input></form>", "a"),
    ("<div class='cookie-notice'>c</div><div id=sidebar>s</div><section class='comments'><p>r</p></section><div class=text>t</div>", "t"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a\nb\nc\nd"),
    ("<p>a <i>b</b> c</i> d</p></div><p>e", "a b c d\ne"),
    ("<article><p>one</p><div class='ad'>x</div><p>two", "one\ntwo"),
    ("<p>open <a href=\"x>y\">link</a", "open link"),
    ("<!DOCTYPE html><html><head><title>t</title></head><body><p>a", "a"),
    ("<article>&#233;&#x1F600;&unknown; <span>b</span></article>", "é😀&unknown; b"),
])
def test_pages(html, want):
    assert text_of(html) == want


@pytest.mark.parametrize("html, want", [
    ("<article style='overflow:hidden'><p style=\"overflow:hidden\">a</p><p aria-hidden=false>b<p data-hidden>c</article>", "a\nb\nc"),
    ("<article><p>see <a href='/hidden-gems'>gems</a> <a href=/x/class=ad title=\"a class='ad' hidden\">x</a><p hidden>h<p HIDDEN=''>i</article>", "see gems x"),
    ("<div class='page has-sidebar'><p>a</p><div class='sidebar'>s</div></div><p>b", "a\nb"),
    ("<div class='no-sidebar elementor-widget-container'><div class=sidebar>s</div><article><p>a</p><div class=ad>x</div></article></div><p>z", "a"),
    ("<form id=aspnetForm><nav>n</nav><main><p>m</p><form>f</form></main></form>", "m"),
    ("<form id=aspnetForm><nav>n</nav><p>m</p></form><footer>f</footer>", "m"),
    ("<article><p>a</p></article><div class=comments><article><p>c</p></article></div>", "a"),
    ("<div class=widget-container><nav><article>n</article></nav><p>a <span class=share>s</span> b", "a s b"),
    ("<p>a <span class=share>s</span> b", "a b"),
])
def test_marks_delete_no_more_than_they_name(html, want):
    assert text_of(html) == want


def test_templates_go_and_passages_stay(spark):
    pages = [
        (i, f"http://site.example/{i}", f"<div><div>Our motto<br>Buy</div><p>own {i}</p><p>same passage</p></div><div>legal text</div>")
        for i in range(20)
    ]
    pages += [(100 + i, f"http://site.example/a{i}", f"<article><p>same passage</p><p>mine {i}</p></article><div>legal text</div>") for i in range(20)]
    pages += [(200, "http://other.example/", "<div>legal text</div><p>x</p>"), (201, None, None), (201, None, ""), (202, "bad", "<p>y" + "<i>" * 5000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r for r in html_template.extract_text(df.selectExpr("*", "1 as host", "2 as template")).collect()}
    assert got[3].text == "own 3\nsame passage"  # the motto and the legal text recur, the passage stands in a p
    assert got[103].text == "same passage\nmine 3"
    assert got[200].text == "legal text\nx" and got[201].text == "" and got[201].n_chars == 0 and got[202].text == "y"
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_template.extract_text(df.limit(0)).count() == 0


def test_copies_of_a_page_keep_their_text(spark):
    """Twenty rows of one page, some under other urls, are one page of their host; what the other pages repeat is still template."""
    page = "<nav>{}</nav><article><div class=text><section>in<br>between</section><p>the copy</p></div><div>join us</div></article>"
    pages = [(i, f"http://a.example/{i % 7}", page.format(i)) for i in range(20)]
    pages += [(100 + i, f"http://a.example/o{i}", f"<article><p>own {i}</p><div>join us</div></article>") for i in range(30)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_template.extract_text(df).collect()}
    assert got == {i: "in\nbetween\nthe copy" for i in range(20)} | {100 + i: f"own {i}" for i in range(30)}


def test_counts_decide_in_and_outside_the_article(spark):
    """Lists, tables and marked paragraphs that recur inside an article are template; a list of its own and plain passages stay."""
    page = (
        "<nav>home</nav><article><p>own {0}</p><ul><li>mine {0}</ul><p>passage</p><ul><li>links<li>more</ul><p class=subscribe>join</p>"
        "<table><thead><tr><th>head</thead><tr><td>{0}</table><table><tr><td>notice</table><a><div>card</div></a></article><footer>page {0}</footer>"
    )
    df = spark.createDataFrame([(i, "http://a.example/", page.format(i)) for i in range(20)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_template.extract_text(df).collect()}
    assert got == {i: f"own {i}\nmine {i}\npassage\nhead\n{i}" for i in range(20)}
    # of 12 blocks a page, counts delete nav, two of the list, join, notice and card, and names the footer
    assert html_template.deleted_blocks(df).first() == (6 * 20, 5 * 20, 20, 5 * 20)


def brute_rule(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), v == "block", h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], "block" if best and best[1] else "allow"


def test_url_rules_against_brute_force(spark):
    rng = random.Random(8)
    hosts = ["a.org", "Example.ORG", "x.example.org", "notexample.org", "com", "b.com", "net", "", "a.net.com", "org"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12", "/fr/x", "/de/", "/de", "/fr/de/", "/es/" + "y" * 5000]
    urls = [f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?a=/es/', '#top', '?x://y'])}" for _ in range(400)]
    urls += [None, "", "no scheme", "a://b://c/de/", "://org/", "http://com\n/fr/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    for r in url_digest.filter_urls(pages, url_digest.default_rules(spark)).collect():
        assert (r.host, r.path, r.rule, r.verdict) == brute_rule(urls[r.page_id], url_digest.RULES)
    none = spark.createDataFrame([(None, "org", "/")], "verdict string, host string, path string")
    assert {r.verdict for r in url_digest.filter_urls(pages, none).collect()} == {"allow"}
    assert url_digest.filter_urls(pages.limit(0), none).count() == 0


def test_a_digest_collision_does_not_decide(tmp_path, monkeypatch):
    monkeypatch.setattr(url_digest, "digest", lambda texts: np.full(len(texts), 7, np.uint64))
    with open(tmp_path / "d", "wb") as sink:
        url_digest.write_digests(sink, {b"a/": True, b"b/": False, b"c/": True})
    found = url_digest.Digests(str(tmp_path / "d")).find(np.full(4, 7, np.uint64), [b"c/", b"b/", b"z/", b"a/"])
    assert found.tolist() == [2, 1, 0, 2]
