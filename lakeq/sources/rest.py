"""A paged REST scan as a Python data source.

The fetch function is injected, so that tests need no network: (url, headers) -> (status, headers, body).
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lakeq.sources.scans import extract_records

RETRIED = (408, 425, 429, 500, 502, 503, 504)


def fetch_http(url: str, headers: dict[str, str]) -> tuple[int, dict[str, str], str]:
    with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=60) as response:  # noqa: S310
        return response.status, dict(response.headers), response.read().decode("utf-8")


def auth_headers(kind: str, secret: str) -> dict[str, str]:
    """none, bearer, token, basic (already encoded), api_key or header (``name=value``)."""
    if kind == "header":
        name, _, value = secret.partition("=")
        return {name: value}
    return {"none": {}, "bearer": {"Authorization": f"Bearer {secret}"}, "token": {"Authorization": f"Token {secret}"}, "basic": {"Authorization": f"Basic {secret}"}, "api_key": {"X-API-Key": secret}}[kind]


def with_retries(fetch: Callable, url: str, headers: dict, attempts: int = 3, base: float = 1.0, most: float = 60.0, sleep: Callable = time.sleep) -> str:
    """The body; failures worth it are tried again after a doubling delay, or what Retry-After says."""
    for attempt in range(1, attempts + 1):
        status, said, body = fetch(url, headers)
        if status < 400:
            return body
        if status not in RETRIED or attempt == attempts:
            raise OSError(f"{url.split('?')[0]} gave {status}")
        wait = said.get("Retry-After", "")
        sleep(float(wait) if wait.isdigit() else min(most, base * 2 ** (attempt - 1)))
    raise AssertionError


def pages(url: str, headers: dict, fetch: Callable = fetch_http, max_pages: int | None = None) -> Iterator[list]:
    """Records page by page, following ``links.next`` or ``next_page_url``."""
    seen = 0
    while url and (max_pages is None or seen < max_pages):
        document = json.loads(with_retries(fetch, url, headers))
        yield extract_records(document)
        seen += 1
        links = document.get("links") if isinstance(document, dict) else None
        url = (links.get("next") if isinstance(links, dict) else None) or (document.get("next_page_url") if isinstance(document, dict) else None)


class RestSource(DataSource):
    """``spark.read.format("rest").option("urls", "a,b")``: a partition per URL, a row (url, record) per record."""

    @classmethod
    def name(cls) -> str:
        return "rest"

    def schema(self) -> str:
        return "url string, record string"

    def reader(self, schema) -> DataSourceReader:
        return RestReader(self.options)


class RestReader(DataSourceReader):
    def __init__(self, options):
        self.urls = [u for u in options.get("urls", "").split(",") if u]
        self.headers = auth_headers(options.get("auth", "none"), options.get("secret", ""))
        self.max_pages = int(options["max_pages"]) if "max_pages" in options else None

    def partitions(self):
        return [InputPartition(u) for u in self.urls]

    def read(self, partition):
        for records in pages(partition.value, self.headers, max_pages=self.max_pages):
            for record in records:
                yield partition.value, json.dumps(record, sort_keys=True)
