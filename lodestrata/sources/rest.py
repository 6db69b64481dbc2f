"""Paged HTTP sources as Python data sources; how a page is fetched is injected, so tests need no network.

``spark.dataSource.register(make_paged_source("papers", fetch))``, then
``spark.read.format("papers").option("query", ...).load()``.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from lodestrata.functions.numeric import year_of
from lodestrata.functions.text import blank_to_null


def http_get(url: str, headers: dict[str, str] | None = None, tries: int = 4, wait: float = 1.0, open_: Callable | None = None, sleep: Callable[[float], None] = time.sleep) -> str:
    """GET with doubling waits. Any failure is tried again, one of too many requests after the time that the server names."""
    for k in range(tries):
        try:
            with (open_ or urllib.request.urlopen)(urllib.request.Request(url, headers=headers or {}), timeout=60) as r:
                return r.read().decode("utf-8")
        except Exception as e:
            if k + 1 == tries:
                raise
            after = e.headers.get("Retry-After") if isinstance(e, urllib.error.HTTPError) and e.headers else None
            sleep(float(after) if after and after.isdigit() else wait * 2**k)
    raise RuntimeError("no try was made")


class _Pages(InputPartition):
    def __init__(self, first: int, step: int):
        super().__init__((first, step))
        self.first, self.step = first, step


def make_paged_source(name: str, fetch: Callable[[dict, int, int], str], entries: Callable[[dict], list]) -> type[DataSource]:
    """A source of (page, ord, entry JSON). ``fetch(options, start, count)`` gives a page's text, ``entries`` its list.

    Options: count (25), maxPages (20), readers (1), pauseSeconds (0.2). A reader takes every
    ``readers``-th page and stops at its first empty one.

    As a stream its offset is a page number. A batch goes up to the first empty page, at most
    ``pagesPerBatch`` (5) further than the last, a task for each page; where it ends is found by asking for one
    entry of each. The checkpoint holds the offset, so after a failure the pages that were done are not
    read again, and pages that come later are read by later batches.
    """

    def setting(options: dict, key: str, default: str) -> str:
        return options.get(key, options.get(key.lower(), default))

    def page_rows(options: dict, page: int) -> list[tuple]:
        count = int(setting(options, "count", "25"))
        return [(page, k, json.dumps(e)) for k, e in enumerate(entries(json.loads(fetch(dict(options), page * count, count))))]

    class StreamReader(DataSourceStreamReader):
        def __init__(self, options: dict):
            self.options, self.known = options, 0

        def initialOffset(self) -> dict:
            return {"page": 0}

        def latestOffset(self) -> dict:
            # A restarted stream does not say where it was; pages up to there are only asked whether they are there.
            most, count = int(setting(self.options, "maxPages", "20")), int(setting(self.options, "count", "25"))
            ahead = self.known + int(setting(self.options, "pagesPerBatch", "5"))
            while self.known < min(ahead, most) and entries(json.loads(fetch(dict(self.options), self.known * count, 1))):
                self.known += 1
            return {"page": self.known}

        def partitions(self, start: dict, end: dict):
            self.known = max(self.known, end["page"])
            return [_Pages(k, 1) for k in range(start["page"], end["page"])]

        def read(self, part: _Pages) -> Iterator[tuple]:
            yield from page_rows(self.options, part.first)
            time.sleep(float(setting(self.options, "pauseSeconds", "0.2")))

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.options = options

        def partitions(self):
            n = int(self.options.get("readers", 1))
            return [_Pages(k, n) for k in range(n)]

        def read(self, part: _Pages) -> Iterator[tuple]:
            for page in range(part.first, int(setting(self.options, "maxPages", "20")), part.step):
                got = page_rows(self.options, page)
                if not got:
                    return
                yield from got
                time.sleep(float(setting(self.options, "pauseSeconds", "0.2")))

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "page int, ord int, entry string"

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

        def streamReader(self, schema) -> DataSourceStreamReader:
            return StreamReader(self.options)

    return Source


def search_entries(pages: DataFrame) -> DataFrame:
    """Flat columns of a bibliographic search's entries (page, ord, entry)."""
    e = lambda k: F.get_json_object("entry", f"$['{k}']")
    return pages.select(
        "page", "ord", e("prism:doi").alias("doi"), e("eid").alias("eid"), e("dc:title").alias("title"), e("dc:description").alias("description"), e("prism:publicationName").alias("journal"),
        year_of(e("prism:coverDate")).alias("year"), e("subtype").alias("doctype"),
    )


def works_entries(pages: DataFrame) -> DataFrame:
    """title, doi, year and journal of an open catalogue's works (page, ord, entry)."""
    g = lambda p: F.get_json_object("entry", p)
    doi = F.regexp_replace(g("$.doi"), "^https?://doi.org/", "")
    return pages.select("page", "ord", g("$.title").alias("title"), doi.alias("doi"), g("$.publication_year").try_cast("int").alias("year"), g("$.primary_location.source.display_name").alias("journal"))


def link(links: Column, kind: str) -> Column:
    """The address of the first link of a kind, from an array of structs (ref, href)."""
    return F.get(F.filter(links, lambda x: x["ref"] == kind), F.lit(0))["href"]


def first_content(*candidates: Column) -> Column:
    """The first filled of a document's forms, in order of preference: text, XML, JSON."""
    return F.coalesce(*[blank_to_null(c) for c in candidates])


def markdown_content(payload: Column) -> Column:
    """A conversion answer's markdown, else its content, else the whole payload."""
    return F.coalesce(blank_to_null(F.get_json_object(payload, "$.markdown")), blank_to_null(F.get_json_object(payload, "$.content")), payload)


def full_text(dois: DataFrame, fetch: Callable[[str], str | None], doi: str = "doi") -> DataFrame:
    """(doi, xml) by an injected fetcher that gets the percent-encoded DOI; a failed fetch is null."""

    @F.pandas_udf("string")
    def get(s):
        def one(x):
            try:
                return fetch(urllib.parse.quote(x, safe="")) if x else None
            except Exception:
                return None

        return s.map(one)

    return dois.select(doi, get(doi).alias("xml"))
