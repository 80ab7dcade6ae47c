import json

import pytest

from tidemark.sources import crawl as c

SITE = {"l1": "a?x=1 b a", "l2": "b c", "l3": "", "l4": "z", "/a": "A", "/b": "B", "/c": "C"}


def fetch(url):
    key = url.removeprefix("http://s/")
    key = key if key.startswith("l") else "/" + key
    if key not in SITE:
        raise c.FetchError(404)
    return SITE[key]


LISTED = dict(listing=lambda n: f"http://s/l{n}", links=str.split)


def test_listings():
    got = list(c.detail_pages(fetch, pages=9, canonical=c.bare, **LISTED))
    assert got == [("http://s/a", "A"), ("http://s/b", "B"), ("http://s/c", "C")]  # the empty listing ends it
    again = {**SITE, "l2": "a b", "l3": "c"}
    assert len(list(c.detail_pages(lambda u: again.get(u[9:] if "/l" in u else "/" + u[9:], "?"), pages=3, canonical=c.bare, until_seen=True, **LISTED))) == 2
    assert [u for u, _ in c.detail_pages(fetch, pages=2, canonical=c.bare, wanted="/[bc]$", **LISTED)] == ["http://s/b", "http://s/c"]
    assert [u for u, _ in c.detail_pages(fetch, start=0, pages=2, canonical=c.bare, **LISTED)] == ["http://s/a", "http://s/b"]  # l0 fails and is skipped


def test_retries():
    waits, calls = [], []

    def flaky(url):
        calls.append(url)
        raise c.FetchError(429, 7.0 if len(calls) == 1 else None) if len(calls) < 3 else c.FetchError(404)

    with pytest.raises(c.FetchError):
        c.retrying(flaky, delay=2, jitter=lambda: 0.5, sleep=waits.append)("u")
    assert waits == [7.5, 4.5] and len(calls) == 3


def test_search_and_paging():
    pages = {"q/a": "ok", "q/b": "Please verify you are human"}
    assert list(c.search_pages(pages.__getitem__, "ab", "q/{}".format)) == [("q/a", "ok")]
    with pytest.raises(c.RobotsError):
        list(c.search_pages(pages.__getitem__, "ab", "q/{}".format, lambda u: u != "q/b"))
    chain = {"1": "2", "2": "3", "3": ""}
    assert [u for u, _ in c.paged(chain.__getitem__, "1", lambda p: p or None)] == ["1", "2", "3"]
    assert len(list(c.paged(lambda u: u, "x", lambda p: p, ceiling=4))) == 4


def test_as_a_data_source(spark):
    def dead():
        raise c.FetchError(500)

    df = c.crawl(spark, c.Crawl({"one": lambda: [("u", "p"), ("v", "q")], "dead": dead}))
    assert sorted(tuple(r) for r in df.collect()) == [("one", "u", "p"), ("one", "v", "q")]
    assert json.loads(c.envelopes(df).orderBy("page").first().page) == {"source": "one", "page": "p"}


def test_sites():
    from tidemark.sources import sites

    at = sites.SITES["careerviet"].listing
    assert at(1) == sites.CAREERVIET_LISTING and at(3).endswith("-c1-trang-3-vi.html")
    assert sites._numbered("https://x/list")(2) == "https://x/list?page=2" and sites._numbered("https://x/l?a=1")(2) == "https://x/l?a=1&page=2"
    card = '<div class="job-item"><div class="title"><b>no link</b></div><a class="job_link" href="/vi/tim-viec-lam/a.html">x</a></div><div class="job-item"></div>'
    assert sites.SITES["careerviet"].links(card) == ["/vi/tim-viec-lam/a.html"]
    assert sites.allowed(f"{sites.INDEED}/jobs?q=a&l=&start=0")
    assert not any(map(sites.allowed, (f"{sites.INDEED}/viewjob?jk=1", f"{sites.INDEED}/jobs?q=a&rss", f"{sites.INDEED}/api/x")))
    with pytest.raises(c.RobotsError):
        list(sites.searched(str, ["a"], search=f"{sites.INDEED}/viewjob"))
    assert list(sites.searched(lambda u: '"jobkey"', [" ", "a"], pages=2)) == [(f"{sites.INDEED}/jobs?q=a&l=&start={n}", '"jobkey"') for n in (0, 10)]
    assert (sites.retry_after("3"), sites.retry_after(" 1.5 "), sites.retry_after("Mon, 1 Jan"), sites.retry_after(None)) == (3.0, 1.5, None, None)
