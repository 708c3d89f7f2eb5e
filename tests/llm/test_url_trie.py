import random

from helpers import ascii_lower

from loadsmith.llm.queries import URL_RULES
from loadsmith.llm.url_trie import UrlTrie, judge_urls, split_url


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = ascii_lower(rest[:cut]), rest[cut:]
        cut = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
        path = rest[:cut]
    fits = [(len(h.split(".")), len(p), h + p, v) for v, h, p in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else None
    return host, path, best[2] if best else None, best[3] if best else default


def test_against_plain_rules(spark):
    rng = random.Random(3)
    hosts = ["example.org", "a.example.org", "Example.ORG", "notexample.org", "org", "x.com", "com", "x.net", "", "org."]
    paths = ["", "/", "/es", "/es/", "/es/1", "/en/1", "/en/12/3", "/en/2", "/fr/x", "/de/", "//", "/de", "?q=/fr/", "#/de/"]
    urls = [None, "", "no-scheme.org/es/", "://", "http:/org/", "http://u:p@example.org:80/es/"]
    urls += [f"{rng.choice(['http', 'HTTPS', ''])}://{h}{p}{rng.choice(['', '?a=b://c', '#x'])}" for h in hosts for p in paths]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls + urls[:3])], "page_id long, url string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(df, URL_RULES).collect()}
    for i, u in enumerate(urls + urls[:3]):
        assert got[i] == plain(u, URL_RULES), u


def test_longest_match_and_ties():
    trie = UrlTrie([("allow", "a.b", "/x/"), ("block", "b", "/x/y/z"), ("block", "a.b", "/x/"), ("allow", "a.b", "/x/y/")])
    assert trie.match("c.a.b", "/x/1") == ("a.b/x/", "block")  # listed as both: block
    assert trie.match("a.b", "/x/y/z") == ("a.b/x/y/", "allow")  # the longer host before the longer path
    assert trie.match("q.b", "/x/y/z1") == ("b/x/y/z", "block")
    assert trie.match("b", "/x/y/") is None and trie.match("", "/x/") is None


def test_empty_table_and_default(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(empty, URL_RULES).collect() == []
    one = spark.createDataFrame([(1, "http://x.net/")], "page_id long, url string")
    assert judge_urls(one, [], default="block").first()["verdict"] == "block"
    assert split_url("http://Ä.ORG/É?x") == ("Ä.org", "/É")
