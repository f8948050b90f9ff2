"""Interfaces of live sources. Requests are planned as rows and fetched in partitions by injected callables, as there is no network here."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import filled

FETCHED = "url string, status int, html string, fetched_from string"


def fetch(urls: DataFrame, get: Callable[[str], tuple[int, str]], pauses: dict[str, float] | None = None, hosts: int = 64) -> DataFrame:
    """Pages of (url, host): all URLs of a host are in one partition, so that its pause holds without locks."""
    waits = dict(pauses or {})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for u, h in zip(b["url"], b["host"]):
                try:
                    status, html = get(u)
                except Exception:  # noqa: BLE001 - a page that can't be had is a row with status 0
                    status, html = 0, None
                rows.append((u, status, html, h))
                if waits.get(h):
                    time.sleep(waits[h])
            yield from filled(pd.DataFrame(rows, columns=["url", "status", "html", "fetched_from"]))

    return urls.select("url", "host").repartition(hosts, F.col("host")).mapInPandas(run, FETCHED)


def search(plan: DataFrame, call: Callable[[dict], list[dict]], schema: str, tries: int = 3, pause: float = 1.0) -> DataFrame:
    """Results of a search API for each row of a request plan (keyword and window), with retries inside the task."""
    names = [c.strip().split(" ")[0] for c in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[dict] = []
            for request in b.to_dict("records"):
                for k in range(tries):
                    try:
                        out += call(request)
                        break
                    except Exception:  # noqa: BLE001 - the service may refuse for a while
                        if k + 1 < tries:
                            time.sleep(pause * 2**k)
            yield from filled(pd.DataFrame(out, columns=names))

    return plan.mapInPandas(run, schema)
