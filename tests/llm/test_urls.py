"""Verdicts against plain rules and an exact set."""

import random

import pytest

from shelfwise.llm import urls

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for end in "#?":
        rest = rest.split(end)[0] if end == "#" else rest
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, path = rest[:cut], rest[cut:].split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [(len(h + p), h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else None


URLS = ["http://EXAMPLE.org/es/1", "https://a.example.org/en/12?x=1", "http://example.org", "http://notexample.org/es/", "x", None, "",
        "http://a.com/fr/1", "http://a.com/de/#f", "http://com/de/", "https://www.x.net/p/?utm_source=a&b=2&a=1#t", "http://x.net/p?a=1&b=2",
        "http://m.x.net/p", "http://x.net/p/?ref=1", "ftp://://a", "http://É.net/ö", "http://x.net?q", "://", "http:///p", "a://b://c/d"]


def test_verdicts(spark):
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS + URLS[:3])] + [(None, "http://x.net/p", 1)],
                                  "page_id long, url string, block int")
    listed = spark.createDataFrame([("x.net/p?a=1&b=2",), ("x.net/p",), (None,), ("x.net/p",), ("absent.net/",)], "url string")
    got = urls.filter_table(pages, listed, RULES).collect()
    assert len(got) == len(URLS) + 4
    for x in got:
        url = "http://x.net/p" if x.page_id is None else (URLS + URLS[:3])[x.page_id]
        host, path = split(url)
        assert (x.host, x.path) == (host, path), url
        want = rule(host, path)
        if want:
            assert (x.rule, x.verdict) == want
        else:
            assert x.rule is None and x.verdict == ("block" if host.endswith("x.net") and path.startswith("/p") else "allow"), url


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_filter_never_misses(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "MAX_BROADCAST_BLOCKS", most)
    monkeypatch.setattr(urls, "MAX_BROADCAST_BYTES", most)
    r = random.Random(1)
    names = [f"h{r.randrange(400)}.net/p{r.randrange(400)}" for _ in range(3000)]
    listed = set(names[:900])
    pages = spark.createDataFrame([(i, f"https://{n}") for i, n in enumerate(names)], "page_id long, url string")
    got = urls.filter_table(pages, spark.createDataFrame([(n,) for n in listed], "url string"), []).collect()
    assert {x.page_id for x in got if x.verdict == "block"} == {i for i, n in enumerate(names) if n in listed}
    assert all(x.possible for x in got if x.listed)
    assert sum(x.possible and not x.listed for x in got) < 0.05 * len(names)


def test_empty(spark):
    pages = spark.createDataFrame([(1, "http://x.net/p")], "page_id long, url string")
    none = spark.createDataFrame([], "url string")
    assert [x.verdict for x in urls.filter_table(pages, none, RULES).collect()] == ["allow"]
    assert urls.filter_table(pages.limit(0), none, RULES).collect() == []
