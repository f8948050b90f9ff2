"""Title, text and selected parts of HTML pages. Titles are JVM expressions; bodies need a parser and run as an Arrow UDF."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def title(html: Column) -> Column:
    """og:title, else meta title, else <title>, unescaped for the commonest entities."""
    meta = lambda name: F.coalesce(*[F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in (rf"(?is)<meta[^>]+(?:property|name)=[\"']{name}[\"'][^>]*content=[\"']([^\"']*)[\"']", rf"(?is)<meta[^>]+content=[\"']([^\"']*)[\"'][^>]*(?:property|name)=[\"']{name}[\"']")])
    t = F.coalesce(meta("og:title"), meta("title"), F.nullif(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1), F.lit("")))
    for a, b in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def strip_tags(html: Column) -> Column:
    """Text without tags, scripts and styles, blanks squeezed."""
    t = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"(?s)<[^>]+>", " "), r"\s+", " "))


def body_text(html: Column, marker: str) -> Column:
    """The text of the first element whose id or class holds ``marker``, images by their alternative text; null where there is none."""

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        from html.parser import HTMLParser

        void = {"br", "img", "hr", "input", "meta", "link"}

        class Reader(HTMLParser):
            def __init__(self):
                super().__init__()
                self.depth, self.out = 0, []

            def handle_starttag(self, tag, attrs):
                a = dict(attrs)
                if self.depth:
                    if tag == "img" and a.get("alt"):
                        self.out.append(a["alt"])
                    if tag not in void:
                        self.depth += 1
                elif self.depth == 0 and marker in f"{a.get('id') or ''} {a.get('class') or ''}".split() and tag not in void:
                    self.depth = 1

            def handle_endtag(self, tag):
                if self.depth > 0 and tag not in void:
                    self.depth -= 1
                    if self.depth == 0:
                        self.depth = -1  # only the first

            def handle_data(self, data):
                if self.depth > 0 and data.strip():
                    self.out.append(data.strip())

        res = []
        for p in pages:
            r = Reader()
            if p:
                r.feed(p)
            res.append(" ".join(r.out) or None)
        return pd.Series(res)

    return run(html)
