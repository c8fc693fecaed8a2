"""A law service as a Spark data source, and the rules of talking to one.

``spark.dataSource.register(LawService)`` makes ``format("law_service")``
available.  Requests are made on executors; each partition has its own rate
limiter, so the overall rate is the option ``rps``, shared among
``partitions``.  Without a network, ``captured`` names a folder of recorded
responses, one file a request.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Tries of a request, and the first pause between them in seconds.
TRIES, PAUSE = 3, 1.0
#: Answers of a server after which a request is tried again.
AGAIN = frozenset({429, 500, 502, 503, 504})


class RateLimiter:
    """Token bucket: ``rps`` requests a second, as many at once."""

    def __init__(self, rps: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.clock, self.sleep = max(rps, 1e-6), clock, sleep
        self.capacity = max(1.0, rps)
        self.tokens, self.at = self.capacity, clock()

    def acquire(self) -> None:
        """Wait for a token and take it."""
        while True:
            now = self.clock()
            self.tokens = min(self.capacity, self.tokens + (now - self.at) * self.rate)
            self.at = now
            if self.tokens >= 1:
                self.tokens -= 1
                return
            self.sleep((1 - self.tokens) / self.rate)


class BadResponse(RuntimeError):
    """A response that is no JSON document."""


class Refused(RuntimeError):
    """An answer that asking again can't change (such as 401 or 404)."""


def checked_json(content_type: str | None, body: str | None) -> object:
    """The document of a response; raises ``BadResponse`` for anything else."""
    kind = classify(content_type, body)
    if kind != "json":
        raise BadResponse(kind)
    return json.loads(body)


def classify(content_type: str | None, body: str | None) -> str:
    """``json``, ``bad_json``, ``empty``, ``markup`` or ``unexpected``."""
    text = body or ""
    if "application/json" in (content_type or "").lower():
        try:
            json.loads(text)
        except ValueError:
            return "bad_json"
        return "json"
    if not text.strip():
        return "empty"
    return "markup" if text.lstrip().startswith("<") else "unexpected"


def classified(content_type: Column, body: Column) -> Column:
    """``classify`` as a column, inside the JVM."""
    text = F.coalesce(body, F.lit(""))
    is_json = F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("application/json"))
    parsed = F.try_parse_json(text).isNotNull() & (F.trim(text) != "")
    return (
        F.when(is_json & parsed, "json")
        .when(is_json, "bad_json")
        .when(~text.rlike(r"\S"), "empty")
        .when(text.rlike(r"^\s*<"), "markup")
        .otherwise("unexpected")
    )


def with_retries(request: Callable[[], tuple[int, str, str]], sleep: Callable[[float], None] = time.sleep) -> object:
    """The document of ``request`` (status, content type, body), tried ``TRIES`` times."""
    for attempt in range(TRIES):
        try:
            status, kind, body = request()
            if status in AGAIN or status >= 500:
                raise BadResponse(f"status {status}")
            if status >= 400:
                raise Refused(f"status {status}")
            return checked_json(kind, body)
        except (BadResponse, OSError, ValueError):
            if attempt == TRIES - 1:
                raise
            sleep(PAUSE * 2**attempt)
    raise AssertionError


class _Part(InputPartition):
    def __init__(self, keys: list[str]):
        self.keys = keys


class LawServiceReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[_Part]:
        keys = [k.strip() for k in self.options.get("keys", "").split(",") if k.strip()]
        if not keys and "captured" in self.options:
            keys = sorted(f.removesuffix(".json") for f in os.listdir(self.options["captured"]) if f.endswith(".json"))
        n = max(1, min(len(keys), int(self.options.get("partitions", "1"))))
        return [_Part(keys[i::n]) for i in range(n)]

    def read(self, partition: _Part) -> Iterator[tuple]:
        n = int(self.options.get("partitions", "1"))
        limiter = RateLimiter(float(self.options.get("rps", "5")) / n)
        for key in partition.keys:
            limiter.acquire()
            try:
                yield key, json.dumps(with_retries(lambda key=key: self._get(key)), ensure_ascii=False), None
            except Exception as problem:  # a failed key is a row, not a failed job
                yield key, None, str(problem)[:500]

    def _get(self, key: str) -> tuple[int, str, str]:
        if "captured" in self.options:
            with open(os.path.join(self.options["captured"], f"{key}.json"), encoding="utf-8") as file:
                return 200, "application/json", file.read()
        from urllib.parse import urlencode
        from urllib.request import Request, urlopen

        params = {"target": self.options.get("target", "law"), "type": "JSON", "MST": key}
        if "jo" in self.options:
            params["JO"] = self.options["jo"].zfill(6)
        request = Request(f"{self.options['base']}?{urlencode(params)}", headers={"Accept": "application/json"})
        with urlopen(request, timeout=float(self.options.get("timeout", "15"))) as answer:
            return answer.status, answer.headers.get("Content-Type", ""), answer.read().decode("utf-8")


class LawService(DataSource):
    """Rows (key, payload, error) of a law service or of recorded responses."""

    @classmethod
    def name(cls) -> str:
        return "law_service"

    def schema(self) -> str:
        return "key string, payload string, error string"

    def reader(self, schema) -> LawServiceReader:  # noqa: ANN001
        return LawServiceReader(dict(self.options))
