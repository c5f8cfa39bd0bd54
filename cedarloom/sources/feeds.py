"""Feeds named by web pages."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cedarloom.functions.rules import FEED_EXTENSIONS, PAGE_EXTENSIONS

# What in a URL speaks for a feed.
FEED_WORDS = ["rss", "atom", "feed", "xml", "/news/", "/feeds/", "/syndication/"]


def is_feed(url: str) -> str:
    """Whether a URL (SQL) looks like a feed: no page ending; a host with feeds.; no fragment; an
    ending or a word of feeds."""
    u = f"lower({url})"
    page = " or ".join(f"endswith({u}, '{e}')" for e in PAGE_EXTENSIONS)
    words = " or ".join(f"contains({u}, '{w}')" for w in [*FEED_EXTENSIONS, *FEED_WORDS])
    host = rf"regexp_extract({u}, r'^(?:[^:/?#]+:)?//([^/?#]*)', 1)"
    return f"case when {url} is null or {page} then false when contains({host}, 'feeds.') then true when {u} rlike '#.' then false else {words} end"


class _Links(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[list] = []
        self.open: list | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "link" and a.get("href") and any(w in (a.get("type") or "").lower() for w in ("rss", "atom", "xml")):
            self.found.append([a["href"], a.get("title") or "", a["type"].lower(), "link_tag"])
        elif tag == "a" and a.get("href") is not None:
            self.open = [a["href"], "", "unknown", "a_tag"]
            self.found.append(self.open)

    def handle_data(self, data):
        if self.open is not None:
            self.open[1] += data

    def handle_endtag(self, tag):
        if tag == "a":
            self.open = None


def feeds(pages: DataFrame) -> DataFrame:
    """(page_id, position, url, title, type, source) of pages (page_id, url, html): links with a feed
    type, and anchors whose address looks like a feed. Addresses are resolved against the page's."""

    def parse(batches):
        for b in batches:
            rows = []
            for i, base, html in zip(b["page_id"], b["url"], b["html"], strict=True):
                p = _Links()
                p.feed(html if isinstance(html, str) else "")
                for k, (href, title, kind, source) in enumerate(p.found):
                    rows.append((i, k, href, urljoin(base or "", href), " ".join(title.split()), kind, source))
            if rows:
                yield pd.DataFrame(rows, columns=["page_id", "position", "href", "url", "title", "type", "source"])

    at = pages.select("page_id", "url", "html").mapInPandas(parse, "page_id bigint, position int, href string, url string, title string, type string, source string")
    return at.where(f"source = 'link_tag' or {is_feed('href')}").drop("href")


def distinct_feeds(found: DataFrame, order: list[str]) -> DataFrame:
    """The first feed of each address; those without one are left out."""
    w = Window.partitionBy("url").orderBy(*order)
    return found.where("coalesce(url, '') != ''").withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
