"""A network source as a Spark data source: one partition per request, retried with back-off."""

from __future__ import annotations

import json
import time
from urllib import error, request

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

WAITS = (2, 4, 8)


def fetch(url: str, body: str | None = None, headers: dict | None = None, timeout: float = 20.0, waits: tuple = WAITS, opener=None) -> tuple[int, str, str]:
    """(status, final url, text); server and connection errors are tried again, 4xx returned. Status 0 if nothing came."""
    opener = opener or request.urlopen
    last = (0, url, "")
    for wait in (*waits, None):
        try:
            with opener(request.Request(url, data=body.encode() if body else None, headers=headers or {}), timeout=timeout) as r:
                return r.status, r.geturl(), r.read().decode("utf-8", "replace")
        except error.HTTPError as e:
            last = (e.code, url, "")
            if e.code < 500:
                return last
        except OSError:
            last = (0, url, "")
        if wait is not None:
            time.sleep(wait)
    return last


class Request(InputPartition):
    def __init__(self, spec: dict):
        self.spec = spec


class HttpSource(DataSource):
    """Options: ``requests``, a JSON list of {url, body?, headers?}."""

    @classmethod
    def name(cls) -> str:
        return "http_pages"

    def schema(self) -> str:
        return "url string, status int, final_url string, html string"

    def reader(self, schema) -> DataSourceReader:
        return HttpReader(json.loads(self.options["requests"]))


class HttpReader(DataSourceReader):
    def __init__(self, specs: list[dict]):
        self.specs = specs

    def partitions(self):
        return [Request(s) for s in self.specs]

    def read(self, partition: Request):
        """One row, whatever happens: what a request dies of is its text, with status 0."""
        s = partition.spec
        try:
            status, final, text = fetch(s["url"], s.get("body"), s.get("headers"))
        except Exception as error:  # a bad address or header is a failed request, not a failed source
            status, final, text = 0, s.get("url"), f"{type(error).__name__}: {error}"[:500]
        yield s.get("url"), status, final, text


def pages(spark: SparkSession, specs: list[dict]):
    """DataFrame of fetched pages."""
    spark.dataSource.register(HttpSource)
    return spark.read.format("http_pages").option("requests", json.dumps(specs)).load()
