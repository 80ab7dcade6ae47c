"""What the crawled sites look like, as data for the crawl functions.

A site names where its listings are and how a listing's cards give links; the
crawl itself is the same for all. How to fetch is always given by the caller.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlencode, urlsplit

from tidemark.sources import crawl
from tidemark.sources import html as doc
from tidemark.sources.crawl import Crawl, Fetch


@dataclass(frozen=True)
class Site:
    """``card`` is the class of a listing's cards; ``link`` reads a card's link."""

    listing: Callable[[int], str]
    card: str
    link: Callable[[doc.Node], str | None]
    wanted: str | None = None
    until_seen: bool = False
    bare: bool = False
    home: str | None = None

    def links(self, page: str) -> list[str]:
        cards = doc.parse(page).all(doc.has_class(self.card, tag="div"))
        return [x for c in cards if (x := self.link(c))]

    def pages(self, fetch: Fetch, start: int = 1, pages: int = 1) -> Iterator[tuple[str, str]]:
        if self.home:  # some listings are thin before the home page was seen
            try:
                fetch(self.home)
            except crawl.FetchError:
                pass
        keep = crawl.bare if self.bare else str
        return crawl.detail_pages(fetch, self.listing, self.links, start, pages, self.until_seen, keep, self.wanted)


def _href(outer: Callable[[doc.Node], bool] | str, inner: bool = True) -> Callable[[doc.Node], str | None]:
    """The link of the first element ``outer`` in a card, or of the first anchor inside it."""

    def read(card: doc.Node) -> str | None:
        for node in card.all(outer):
            anchor = node.first("a") if inner else node
            if anchor is not None and anchor.attrs.get("href"):
                return anchor.attrs["href"]
        return None

    return read


def _numbered(listing: str) -> Callable[[int], str]:
    """Listings whose later pages carry their number before the locale."""

    def at(n: int) -> str:
        if n <= 1:
            return listing
        head, dot, locale = listing.removesuffix(".html").rpartition("-")
        if listing.endswith(".html") and dot and locale in LOCALES:
            return f"{head}-trang-{n}-{locale}.html"
        return f"{listing}{'&' if '?' in listing else '?'}page={n}"

    return at


# Addresses of the sites, the classes and attributes of their
# cards, the paths and parameters that robots may not touch, and markers of
# pages that are no results.
LOCALES = ("vi", "en")
ITVIEC, TOPCV, CAREERVIET, INDEED = "https://itviec.com", "https://www.topcv.vn", "https://careerviet.vn", "https://vn.indeed.com"
ITVIEC_LINK = "data-search--job-selection-job-url-value"
TOPCV_LISTING, CAREERVIET_LISTING = f"{TOPCV}/tim-viec-lam-cong-nghe-thong-tin-cr257", f"{CAREERVIET}/viec-lam/cntt-phan-mem-c1-vi.html"
INDEED_STEP, INDEED_CARDS, INDEED_SIGN_IN = 10, '"jobkey"', ("Tài khoản Indeed", "/account/login")
FORBIDDEN_PATHS = ("/viewjob", "/m/viewjob", "/advanced_search", "/alert", "/applystart", "/vaclk", "/cmp/", "/api/")
FORBIDDEN_PARAMETERS = ("rt=nc", "alid=", "calert=", "iafilter=", "mna=", "rss", "serpstart=")

_TITLE = lambda n: n.tag == "h3" and "title" in n.classes()
SITES = {
    "itviec": Site(lambda n: f"{ITVIEC}/it-jobs?page={n}", "job-card", lambda card: (card.attrs.get(ITVIEC_LINK) or "").partition("/content")[0] or None),
    "topcv": Site(lambda n: f"{TOPCV_LISTING}?page={n}", "job-item-search-result", _href(_TITLE), bare=True),
    "careerviet": Site(
        _numbered(CAREERVIET_LISTING),
        "job-item",
        lambda card: _href(doc.has_class("title", tag="div"))(card) or _href(doc.has_class("job_link", tag="a"), inner=False)(card),
        wanted=r"/(vi|en)/tim-viec-lam/.+\.html$",
        until_seen=True,
        home=f"{CAREERVIET}/",
    ),
}


def allowed(url: str) -> bool:
    """Whether the search site's robots allow ``url``."""
    parts = urlsplit(url)
    return not (parts.path or "/").startswith(FORBIDDEN_PATHS) and not any(p in parts.query for p in FORBIDDEN_PARAMETERS)


def searched(fetch: Fetch, queries: list[str], place: str = "", pages: int = 1, search: str = f"{INDEED}/jobs") -> Iterator[tuple[str, str]]:
    """Result pages query by query; a query ends where a page cannot be fetched,
    is a sign-in page or holds no cards."""
    asked = [q for q in map(str.strip, queries) if q]
    urls = {q: [f"{search}?{urlencode({'q': q, 'l': place, 'start': n * INDEED_STEP})}" for n in range(pages)] for q in asked}
    if not allowed(search):
        raise crawl.RobotsError(search)
    for of_query in urls.values():
        for url in of_query:
            found = list(crawl.search_pages(fetch, [url], str, allowed))
            if not found or INDEED_CARDS not in found[0][1] or any(m in found[0][1][:4000] for m in INDEED_SIGN_IN):
                break
            yield found[0]


def _next_of(page: str) -> str | None:
    return json.loads(page).get("next")


def catalogue(fetch: Fetch, addresses: dict[str, str], ceiling: int = 100) -> Crawl:
    """A crawl of course catalogues: ``addresses`` by dialect; the dialect that
    names its next page is followed to ``ceiling``. Unknown dialects are left out."""
    follow = {"mitlearn": _next_of}
    known = {name: url for name, url in addresses.items() if name in ("mslearn", "mitlearn", "freecodecamp", "csvideo")}
    return Crawl({name: (lambda name=name, url=url: crawl.paged(fetch, url, follow.get(name, lambda page: None), ceiling)) for name, url in known.items()})


def retry_after(header: str | None) -> float | None:
    """Seconds that a server asks to wait, where it says so in seconds."""
    return float(header) if header and re.fullmatch(r"\s*\d+(\.\d+)?\s*", header) else None
