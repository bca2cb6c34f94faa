"""Files and paged answers over HTTP, fetched by the driver: with retries, and written whole or not at all."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession

from . import storage

AGENT = "lexloom/1.0"
#: Attempts, and the longest wait between two in seconds, unless the server asks for another.
ATTEMPTS, LONGEST_WAIT, PACE = 7, 30.0, 0.25


def fetch(url: str, attempts: int = ATTEMPTS, sleep: Callable[[float], None] = time.sleep):
    """The open answer to a request.  Too many requests and errors of the server are tried again
    after the time that it asks for, or twice as long each time; other errors raise at once."""
    request = urllib.request.Request(url, headers={"user-agent": AGENT})
    status = 0
    for attempt in range(attempts):
        try:
            return urllib.request.urlopen(request, timeout=60)
        except urllib.error.HTTPError as e:
            status = e.code
            if status != 429 and status < 500:
                raise
            asked = e.headers.get("retry-after", "")
            sleep(float(asked) if asked.isdigit() else min(LONGEST_WAIT, 2.0**attempt))
    raise OSError(f"HTTP {status} after {attempts} attempts: {url}")


def download(spark: SparkSession, url: str, path: str, **options) -> int:
    """A file from ``url`` at ``path``; nothing is there until all of it is.  Returns its bytes."""
    with fetch(url, **options) as answer:
        return storage.put(spark, path, iter(lambda: answer.read(storage.PIECE), b""))


def pages(url: str, query: dict[str, str], token: str = "continue", pace: float = PACE, sleep: Callable[[float], None] = time.sleep, **options) -> Iterator[dict]:
    """The answers of an API that gives a token for the next page as long as there is one."""
    more: dict[str, str] = {}
    while True:
        with fetch(f"{url}?{urllib.parse.urlencode(query | more)}", sleep=sleep, **options) as answer:
            got = json.load(answer)
        yield got
        if not got.get(token):
            return
        more = {token: str(got[token])}
        sleep(pace)


def snapshot(spark: SparkSession, url: str, query: dict[str, str], path: str, items: str = "pages", **options) -> int:
    """All items of a paged answer as JSON lines at ``path``; returns how many."""
    n = 0

    def lines() -> Iterator[bytes]:
        nonlocal n
        for got in pages(url, query, **options):
            for item in got.get(items, []):
                n += 1
                yield json.dumps(item, ensure_ascii=False).encode() + b"\n"

    storage.put(spark, path, lines())
    return n
