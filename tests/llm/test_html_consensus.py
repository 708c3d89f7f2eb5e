import html
import re

from helpers import rows

from loadsmith.llm.html_consensus import Page, extract_main_text, host_paths

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()


def pages(spark, data):
    return spark.createDataFrame(data, "page_id long, url string, html string")


def article(i):
    return [" ".join(WORDS[(i + j * 3 + k) % 10] for k in range(12)) + f" {i}." for j in range(4)]


def template_a(i):
    p = article(i)
    return " ".join([f"Title {i} & more", *p]), (
        f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
        f"<nav><ul><li><a href='/x'>{p[0]}</a></ul></nav><!-- {p[1]} --><div class=\"ad\">{p[2]}</div>"
        f"<article><h1>Title {i} &amp; more</h1><p><b>{p[0]}<br><p>{p[1]}</p><p>{p[2]}</p>\n<p>{p[3]}</article>"
        f"<footer>&copy; {p[1]}</footer></body></html>")


def template_b(i):
    p = article(i)
    return " ".join([f"Head {i}", *p]), (
        f"<body><header><h2>Site</h2></header><div id=cookie-notice>We use cookies a lot, {p[0]} {p[1]} {p[2]}</div>"
        f"<div class='wrap w{i}'><DIV CLASS='post-{i} body'><h2>Head {i}</h2><div><p>{p[0]}</p></div><p>{p[1]}<p>{p[2]}</p>"
        f"<form><label>Mail</label><input><button>Go</button></form><p>{p[3]}</p></DIV>"
        f"<aside>{p[0]}</aside><div class=comments><p>{' '.join(p * 4)}</p></div></div><noscript>{p[0]}</noscript></body>")


def test_templates_by_host(spark):
    data, want = [], {}
    for i in range(60):
        text, source = (template_a if i % 2 else template_b)(i)
        data.append((i, f"http://{'a' if i % 2 else 'b'}.org/{i}", source))
        want[i] = text
    got = {r["page_id"]: r for r in extract_main_text(pages(spark, data).selectExpr("*", "1 as paths", "'h' as host")).collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    agreed = {r["host"]: r["paths"][0] for r in host_paths(pages(spark, data)).collect()}
    assert agreed == {"a.org": ">body>article", "b.org": ">body>div.w#.wrap>div.body.post-#"}


def test_consensus_outvotes_a_long_odd_block(spark):
    """On one page another block is longer than the article; the host's path still wins."""
    data = [(i, f"http://h.org/{i}", f"<div class=text><p>{' '.join(article(i))}</div><div class=more><p>short</p></div>") for i in range(8)]
    data.append((9, "http://h.org/9", f"<div class=text><p>brief</div><div class=more><p>{'noise ' * 400}</p></div>"))
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages(spark, data)).collect()}
    assert got[9] == "brief"


def test_edge_rows(spark):
    data = [(0, None, None), (1, "http://h/", ""), (2, "nohost", "plain &lt;text&gt;  only"), (None, "http://h/", "<p>x</p>"),
            (4, None, "<script>x"), (5, "http://h/", "<p>a&#x41;&eacute;&nbsp;b<br/>c</p >d"), (5, "http://h/", "<p>a&#x41;&eacute;&nbsp;b<br/>c</p >d"),
            (6, "http://h/", "<div" * 50), (7, "http://long/", "<p>" + "w " * 200_000), (8, "http://h/", "<p>1 < 2 <b>3</b>4<p>5")]
    got = rows(extract_main_text(pages(spark, data)), "page_id", "text")
    texts = {(i, t) for i, t in got}
    assert len(got) == len(data)
    assert {(0, ""), (1, ""), (2, "plain <text> only"), (None, "x"), (4, ""), (5, "aAé b c d"), (8, "1 < 2 34 5")} <= texts
    assert dict((i, len(t)) for i, t in got if i == 7)[7] == 399_999
    assert extract_main_text(pages(spark, [])).collect() == []


def test_deep_nesting_and_unclosed_tags_are_linear():
    text = "<div>" * 3000 + "<p>x" + "<b>" * 3000
    assert Page(text).text([]) == "x"


def test_generated_pages(spark):
    """Against the tables' own layout: title and paragraphs stand between the article tags."""
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in extract_main_text(df).collect()}
    for r in df.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        assert got[r["page_id"]] == " ".join(html.unescape(re.sub(r"<(/?(?:p|h1|br))[^>]*>", " ", inner).replace("<b>", "").replace("</b>", "")).split())


def test_junk_words_on_wrappers_keep_the_article():
    for wrapper in ["layout has-sidebar", "no-sidebar", "content-sidebar-wrap", "share-enabled", "with-comments", "ad-free",
                    "widget-area", "sidebar", "page-widget"]:
        for inner in ["article", "main", "div"]:
            source = f"<body><div class='{wrapper}'><{inner}><h1>Title</h1><p>long text</p></{inner}>" \
                     f"<div class='sidebar'>away</div></div></body>"
            assert Page(source).text([]) == "Title long text", (wrapper, inner)
    page = "<form id=f><div class=c><h1>Title</h1><p>long text</p><form><p>mail</p></form></div></form>"
    assert Page(page).text([]).startswith("Title long text")
    assert Page("<main><header><h1>Title</h1></header><p>long text</p></main>").text([]) == "Title long text"
    assert Page("<div class=comments><p>only this</p></div>").text([]) == "only this"


def test_boilerplate_inside_the_article():
    said = "a reader wrote this in haste"
    for name in ["post-comments", "user-comments", "related-posts", "ad-slot", "share-buttons", "social-links", "cookie-policy",
                 "page-header", "top-menu-wrapper"]:
        for tag in ["article", "div"]:
            source = f"<{tag} class=text><h1>Title</h1><p>{'the text ' * 9}</p><div class='{name}'><p>{said}</p></div></{tag}>"
            assert Page(source).text([]) == f"Title {'the text ' * 9}".strip(), (name, tag)
    for away in ["<p hidden>%s</p>", "<div aria-hidden=\"true\">%s</div>", "<div style='color:red; display: none'>%s</div>",
                 "<span style=\"visibility:hidden\">%s</span>",
                 "<ul><li><a href=1>some story</a><li><a href=2>more</a><li><a href=3>yet more</a></ul>"]:
        source = f"<article><p>{'the text ' * 9}</p>{away % said if '%s' in away else away}<p>end</p></article>"
        assert Page(source).text([]) == f"{'the text ' * 9}end", away


def test_weak_suspects_that_are_the_text_stay():
    words = "the text " * 9
    for source in [f"<article><div class='page-header'><h1>Title</h1></div><div class=c><p>{words}</p></div></article>",
                   f"<article><div class='post-header'><h2>Title</h2></div><p>{words}</p></article>",
                   f"<article><div class='hero-banner'><h1>Title</h1></div><p>{words}</p></article>",
                   f"<article><div class='elementor-widget-text'>Title</div><p>{words}</p></article>",
                   f"<article><p>Title</p><div class='social-story'><p>{words}</p></div></article>",
                   f"<body hidden><h1>Title</h1><p>{words}</p></body>",
                   f"<div hidden><h1>Title</h1><p>{words}</p></div>",
                   f"<article data-hidden=1 title='hidden'><p>Title</p><p>{words}</p></article>"]:
        assert Page(source).text([]) == f"Title {words}".strip(), source
    links = "<ul><li><a>one story</a><li><a>another story</a><li><a>a third one</a></ul>"
    assert Page(f"<article><h1>Index</h1>{links}</article>").text([]) == "Index one story another story a third one"


def test_blocks_of_most_pages_of_a_host_go(spark):
    """An advert without any class stands in each article; copies and half as frequent passages stay whole."""
    data, want = [], {}
    advert = "<p>Buy <b>all</b> you need now</p>"
    for i in range(40):
        p = article(1000 + i * 7)
        shared = "<p>A passage that a third of the pages hold.</p>" if i % 3 == 0 else ""
        want[i] = f"Head line of all " + " ".join(p[:2]) + (" A passage that a third of the pages hold." if shared else "") + f" {p[2]}"
        data.append((i, "http://x.org/", f"<article><h2>Head line of all</h2><p>{p[0]}</p>{advert}<p>{p[1]}</p>{shared}<p>{p[2]}</p></article>"))
    for i in range(40, 60):  # copies of one page, on a host of their own
        want[i] = " ".join(article(1))
        data.append((i, "http://y.org/", "<article>" + "".join(f"<p>{x}</p>" for x in article(1)) + "</article>"))
    for i in range(60, 80):  # near copies
        want[i] = " ".join([*article(1), f"Copy number {i} is here."])
        data.append((i, "http://z.org/", "<article>" + "".join(f"<p>{x}</p>" for x in article(1)) + f"<p>Copy number {i} is here.</p></article>"))
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages(spark, data)).collect()}
    assert got == want


def test_plain_vote_and_reextraction(spark):
    """Votes, their sums, boilerplate counts and the second reading in plain Python over the given pages."""
    table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    data = [(r["page_id"], r["url"], r["html"]) for r in table.select("page_id", "url", "html").collect()]
    data += [(10_000 + i, "http://m.org/", (template_a if i % 3 else template_b)(i % 25)[1].replace("</article>", "<p>Said on each of these pages</article>")) for i in range(30)]
    votes, stands, whole = {}, {}, {}
    for _, url, source in data:
        host, page = re.search(r"://([^/?#]*)", url)[1].lower(), Page(source)
        found = page.scored()[:5]
        for i, (score, path) in enumerate(found):
            v = votes.setdefault(host, {}).setdefault(path, [0, 0, 0])
            v[0] += score / sum(s for s, _ in found)
            v[1] += 1
            v[2] += i == 0
        whole.setdefault(host, set()).add(source)
        for *_, block in page.blocks():
            stands.setdefault(host, {}).setdefault(block, set()).add(source)
    want = {}
    for page_id, url, source in data:
        host = re.search(r"://([^/?#]*)", url)[1].lower()
        paths = sorted(votes[host], key=lambda p: (-round(votes[host][p][0], 6), p))[:64]
        weak = [p for p in paths if votes[host][p][2] * 2 < votes[host][p][1]]
        often = {b for b, on in stands.get(host, {}).items() if len(on) >= 10 and len(on) * 2 >= len(whole[host])}
        want[page_id] = Page(source).text(paths, weak, frozenset(often))
    assert {r["page_id"]: r["text"] for r in extract_main_text(pages(spark, data)).collect()} == want


def test_junk_elements_beside_the_article_stay_out():
    said = "<p>" + "a reader wrote this " * 60 + "</p>"
    for junk in ["<div class='comments'>%s</div>", "<div id=comments-area>%s</div>", "<div class=replies><article class=comment-body>%s</article></div>",
                 "<form>%s</form>", "<div class='site-banner'>%s</div>"]:
        for tag in ["article", "div"]:
            words = "the text " * 30
            source = f"<body><{tag} class=text><h1>Title</h1><p>{words}</p></{tag}>{junk % said}</body>"
            assert Page(source).text([]) == f"Title {words}".strip(), (junk, tag)


def test_title_and_intro_stay_with_sections():
    a, b = "first part " * 60, "second part " * 60
    want = " ".join(f"Title intro here {a}{b}".split())
    for source in [f"<div class=content><h1>Title</h1><p>intro here</p><section>{a}</section><section>{b}</section></div>",
                   f"<div class=content><h1>Title</h1><div class=body><p>intro here</p><p>{a}</p>{b}</div></div>",
                   f"<div class=content><h1>Title</h1><p>intro here</p><div class=x>{a}</div><div class=y>{b}</div></div>",
                   f"<h1>Title</h1><p>intro here</p><section>{a}</section><section>{b}</section>"]:
        page = f"<body><div id=page><span>Skip</span>{source}<div class=teasers><b>more</b></div></div></body>"
        if source.startswith("<div"):
            assert Page(page).text([]) == want, source
        assert Page(f"<body>{source}</body>").text([]) == want, source
    for tail in [f"<article>{a}</article><p>copy right</p>", f"<div class=c><p>{a}</p></div><p>copy right</p>"]:
        assert Page(f"<body>{tail}</body>").text([]) == a.strip()


def test_sections_template_on_a_host(spark):
    data, want = [], {}
    for i in range(12):
        p = article(i)
        want[i] = " ".join([f"Title {i} intro", *p])
        data.append((i, f"http://s.org/{i}", f"<body><div class=content><h1>Title {i}</h1><p>intro</p>" +
                     "".join(f"<section><p>{x}</p></section>" for x in p) + "</div></body>"))
    assert {r["page_id"]: r["text"] for r in extract_main_text(pages(spark, data)).collect()} == want


def test_rare_templates_keep_their_articles(spark):
    """The common template's path is a teaser on one rare template and missing on many others."""
    data, want = [], {}
    for i in range(40):
        want[i] = " ".join(article(i))
        data.append((i, "http://r.org/", f"<body><div class=text><p>{want[i]}</p></div><p>Imprint</p></body>"))
    for i in range(40, 43):
        want[i] = " ".join(article(i) * 3)
        data.append((i, "http://r.org/", f"<body><div class=text><p>teaser</p></div><div class=story><p>{want[i]}</p></div></body>"))
    kinds = [chr(97 + k) * 3 for k in range(12)]
    for i, kind in enumerate(kinds, 43):
        want[i] = " ".join(article(i))
        data.append((i, "http://r.org/", f"<body><div class={kind}><p>{want[i]}</p></div><p>Imprint</p></body>"))
    got = {r["page_id"]: r["text"] for r in extract_main_text(pages(spark, data)).collect()}
    assert got == want
