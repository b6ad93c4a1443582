"""Landing: remote replies and files are fetched once into a folder; plans read what has landed and never the network."""

from __future__ import annotations

import gzip
import json
import os
import shutil
import time
import urllib.request
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PDF = "application/pdf"


class Fetcher:
    """Opens addresses with a least interval between requests, a timeout, and some further tries; the last error is raised."""

    def __init__(self, interval: float = 0.3, timeout: float = 30, tries: int = 3, headers: dict[str, str] | None = None, opener: Callable = urllib.request.urlopen, sleep: Callable = time.sleep, clock: Callable = time.monotonic):
        self.interval, self.timeout, self.tries, self.headers = interval, timeout, tries, headers or {}
        self.opener, self.sleep, self.clock, self.last = opener, sleep, clock, None

    def open(self, url: str, body: dict | None = None):
        data = None if body is None else json.dumps(body).encode()
        headers = self.headers | ({"Content-Type": "application/json"} if data is not None else {})
        for k in range(self.tries):
            if self.last is not None and (wait := self.last + self.interval - self.clock()) > 0:
                self.sleep(wait)
            self.last = self.clock()
            try:
                return self.opener(urllib.request.Request(url, data=data, headers=headers), timeout=self.timeout)
            except OSError:  # URLError and timeouts are of this kind
                if k == self.tries - 1:
                    raise
        raise ValueError("tries must be 1 or more")


def land(fetcher: Fetcher, url: str, path: str, content_type: str | None = None) -> int:
    """Fetch a file, in blocks, and move it to ``path`` only when it is whole; returns its size.

    A reply of another content type than the one asked for, or a gzip file that does not end properly, raises and leaves nothing.
    """
    tmp = f"{path}.{uuid.uuid4().hex}.part"
    try:
        with fetcher.open(url) as reply, open(tmp, "wb") as out:
            got = reply.headers.get("Content-Type", "")
            if content_type and content_type not in got:
                raise ValueError(f"{url}: {got or 'no content type'} instead of {content_type}")
            shutil.copyfileobj(reply, out, 1 << 20)
        if path.endswith(".gz"):
            with gzip.open(tmp) as check:
                while check.read(1 << 20):
                    pass
        os.replace(tmp, path)
    finally:
        if os.path.exists(tmp):
            os.remove(tmp)
    return os.path.getsize(path)


class _Requests(InputPartition):
    def __init__(self, requests: list[dict]):
        self.requests = requests


class ReplyReader(DataSourceReader):
    def __init__(self, requests: list[dict], options: dict):
        self.requests, self.options = requests, options

    def partitions(self) -> list[_Requests]:
        n = max(1, int(self.options.get("parts", "1")))
        return [_Requests(self.requests[i::n]) for i in range(n) if self.requests[i::n]]

    def read(self, partition: _Requests) -> Iterator[tuple]:
        fetcher = Fetcher(float(self.options.get("interval", "0.3")), float(self.options.get("timeout", "30")), int(self.options.get("tries", "3")))
        for r in partition.requests:
            try:
                with fetcher.open(r["url"], r.get("body")) as reply:
                    text = reply.read().decode("utf-8")
                json.loads(text)
                yield r.get("key", r["url"]), text, None
            except (OSError, ValueError) as e:  # a failed request is a row, not an error of the job
                yield r.get("key", r["url"]), None, f"{type(e).__name__}: {e}"


class ReplySource(DataSource):
    """``spark.read.format("rest_json").option("requests", json list of {url, body, key})``: GET, or POST where there is a body."""

    @classmethod
    def name(cls) -> str:
        return "rest_json"

    def schema(self) -> str:
        return "key string, reply string, error string"

    def reader(self, schema) -> ReplyReader:
        return ReplyReader(json.loads(self.options["requests"]), dict(self.options))


def replies(spark: SparkSession, requests: list[dict], parts: int = 1, **options) -> DataFrame:
    """(key, reply, error) of each request; ``parts`` tasks ask at once, each with its own interval."""
    spark.dataSource.register(ReplySource)
    r = spark.read.format("rest_json").option("requests", json.dumps(requests)).option("parts", str(parts))
    for k, v in options.items():
        r = r.option(k, str(v))
    return r.load()
