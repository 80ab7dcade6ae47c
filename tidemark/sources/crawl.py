"""Crawls as partitioned sources.

A site is described by callables (how to fetch, which links a listing holds), so
tests run on saved pages and nothing here opens a connection by itself. Each
source or query is one input partition of a Python data source; pages stream
out of it as rows (source, url, page).
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urljoin, urlsplit, urlunsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RETRY_STATUS = {403, 429, *range(500, 600)}
_CHALLENGE = re.compile(r"(?i)sign in to continue|verify you are human|captcha|just a moment")


class FetchError(Exception):
    def __init__(self, status: int, retry_after: float | None = None):
        super().__init__(f"status {status}")
        self.status, self.retry_after = status, retry_after


class RobotsError(Exception):
    """The site does not allow the path."""


Fetch = Callable[[str], str]


def bare(url: str) -> str:
    """Without query and fragment."""
    parts = urlsplit(url)
    return urlunsplit((parts.scheme, parts.netloc, parts.path, "", ""))


def retrying(fetch: Fetch, tries: int = 4, delay: float = 2.0, jitter: Callable[[], float] = lambda: 0.0, linear: bool = False, sleep=time.sleep) -> Fetch:
    """Retries throttled and failed requests: after what the server asks, else
    after a delay that doubles (or, ``linear``, grows by itself)."""

    def run(url: str) -> str:
        for attempt in range(tries):
            try:
                return fetch(url)
            except FetchError as e:
                if e.status not in RETRY_STATUS or attempt == tries - 1:
                    raise
                wait = e.retry_after if e.retry_after is not None else delay * ((attempt + 1) if linear else 2**attempt)
                sleep(wait + jitter())
        raise AssertionError

    return run


def detail_pages(
    fetch: Fetch,
    listing: Callable[[int], str],
    links: Callable[[str], Iterable[str]],
    start: int = 1,
    pages: int = 1,
    until_seen: bool = False,
    canonical: Callable[[str], str] = lambda u: u,
    wanted: str | None = None,
) -> Iterator[tuple[str, str]]:
    """(url, page) of each detail page that listings name, once, in order.

    A listing without links ends the crawl; with ``until_seen`` so does one
    without a new link. A listing or page that cannot be fetched is skipped."""
    seen: set[str] = set()
    for n in range(start, start + pages):
        at = listing(n)
        try:
            found = [canonical(urljoin(at, x)) for x in links(fetch(at))]
        except FetchError:
            continue
        found = [u for u in found if wanted is None or re.search(wanted, urlsplit(u).path)]
        fresh = [u for u in dict.fromkeys(found) if u not in seen]
        if not (fresh if until_seen else found):
            return
        seen.update(fresh)
        for url in fresh:
            try:
                yield url, fetch(url)
            except FetchError:
                continue


def search_pages(fetch: Fetch, queries: Iterable[str], url_of: Callable[[str], str], allowed: Callable[[str], bool] = lambda u: True) -> Iterator[tuple[str, str]]:
    """One page a query. A path that robots forbid raises before any request;
    a sign-in or challenge page is not a result."""
    urls = [url_of(q) for q in queries]
    if bad := [u for u in urls if not allowed(u)]:
        raise RobotsError(bad[0])
    for url in urls:
        try:
            page = fetch(url)
        except FetchError:
            continue
        if not _CHALLENGE.search(page[:20_000]):
            yield url, page


def paged(fetch: Fetch, first: str, following: Callable[[str], str | None], ceiling: int = 100) -> Iterator[tuple[str, str]]:
    """A catalogue page by page, as each names the next; at most ``ceiling``."""
    url: str | None = first
    for _ in range(ceiling):
        if not url:
            return
        page = fetch(url)
        yield url, page
        url = following(page)


@dataclass
class Crawl:
    """Named sources, each a function that gives (url, page) pairs. A source
    that fails is left out, not fatal."""

    sources: dict[str, Callable[[], Iterable[tuple[str, str]]]] = field(default_factory=dict)

    def rows(self, name: str) -> Iterator[tuple[str, str, str]]:
        try:
            for url, page in self.sources[name]():
                yield name, url, page
        except FetchError:
            return


def crawl(spark: SparkSession, plan: Crawl) -> DataFrame:
    """(source, url, page), a task a source."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Reader(DataSourceReader):
        def partitions(self):
            return [InputPartition(n) for n in plan.sources]

        def read(self, partition):
            yield from plan.rows(partition.value)

    class Source(DataSource):
        @classmethod
        def name(cls):
            return "tidemark_crawl"

        def schema(self):
            return "source string, url string, page string"

        def reader(self, schema):
            return Reader()

    spark.dataSource.register(Source)
    return spark.read.format("tidemark_crawl").load()


def envelopes(pages: DataFrame) -> DataFrame:
    """Pages as ``{"source", "page"}`` strings: the dialect travels along."""
    return pages.select(F.to_json(F.struct("source", "page")).alias("page"))
