"""Landing tables of fetched pages and files, with bounds on size and time.

The client is given by import path ("package.module:function"), takes a URL and returns an iterable of
chunks of bytes; jobs and tests choose their own transport. A row is fetched by the task that holds it.
"""

from __future__ import annotations

import importlib
import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes and seconds for a page and for a file, tries for a file, and the first pause, which doubles.
PAGE_BYTES, PAGE_SECONDS = 10 * 1024 * 1024, 120
FILE_BYTES, FILE_SECONDS, FILE_TRIES, FILE_PAUSE = 200 * 1024 * 1024, 180, 4, 15


class TooLarge(Exception):
    """A file over its bound: no further try would help."""


def html_url(url: Column) -> Column:
    """The address of a paper's page in HTML."""
    return F.replace(url, F.lit("/abs/"), F.lit("/html/"))


def read_page(chunks: Iterable[bytes], most: int = PAGE_BYTES, seconds: float = PAGE_SECONDS, clock: Callable[[], float] = time.monotonic) -> tuple[bytes, bool]:
    """(body, complete). A page cut at ``most`` bytes counts as complete; one cut by time or by an error on the way doesn't."""
    parts: list[bytes] = []
    size, began = 0, clock()
    source = iter(chunks)
    while True:
        try:
            chunk = next(source)
        except StopIteration:
            return b"".join(parts), True
        except OSError:
            return b"".join(parts), False
        parts.append(chunk[: most - size])
        size += len(parts[-1])
        if size >= most:
            return b"".join(parts), True
        if clock() - began > seconds:
            return b"".join(parts), False


def read_file(chunks: Iterable[bytes], most: int = FILE_BYTES, seconds: float = FILE_SECONDS, clock: Callable[[], float] = time.monotonic) -> bytes:
    """A whole file; TooLarge over ``most`` bytes, TimeoutError after so many seconds."""
    parts: list[bytes] = []
    size, began = 0, clock()
    for chunk in chunks:
        parts.append(chunk)
        size += len(chunk)
        if size > most:
            raise TooLarge(f"more than {most} bytes")
        if clock() - began > seconds:
            raise TimeoutError(f"more than {seconds} s")
    return b"".join(parts)


def with_tries(fetch: Callable[[], bytes], tries: int = FILE_TRIES, pause: float = FILE_PAUSE, sleep: Callable[[float], None] = time.sleep) -> tuple[bytes | None, str | None]:
    """(data, None), or (None, what went wrong last); pauses double between tries."""
    for k in range(tries):
        try:
            return fetch(), None
        except TooLarge as e:
            return None, str(e)
        except OSError as e:
            error = f"{type(e).__name__}: {e}"
            if k < tries - 1:
                sleep(pause * 2**k)
    return None, error


def _client(path: str) -> Callable[[str], Iterable[bytes]]:
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def _page(client: Callable[[str], Iterable[bytes]], url: str) -> tuple[bytes | None, bool, str | None]:
    try:
        body, complete = read_page(client(url))
    except OSError as e:
        return None, False, f"{type(e).__name__}: {e}"
    return body, complete, None


LANDED = "safe_id string, url string, body binary, complete boolean, error string"


def _land(path: str, fetch: Callable):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = _client(path)
        for batch in batches:
            for safe_id, url in zip(batch["safe_id"].to_pylist(), batch["url"].to_pylist(), strict=True):
                body, complete, error = fetch(client, url)  # a row at a time, as bodies are large
                kinds = (pa.string(), pa.string(), pa.binary(), pa.bool_(), pa.string())
                yield pa.record_batch([pa.array([v], t) for v, t in zip((safe_id, url, body, complete, error), kinds, strict=True)], names=[x.split()[0] for x in LANDED.split(", ")])

    return run


def fetch_pages(papers: DataFrame, client: str) -> DataFrame:
    """(safe_id, url, body, complete, error) of papers (safe_id, url): a page's bytes, null where nothing came."""
    return papers.select("safe_id", html_url(F.col("url")).alias("url")).mapInArrow(_land(client, _page), LANDED)


def fetch_files(papers: DataFrame, client: str, tries: int = FILE_TRIES, pause: float = FILE_PAUSE) -> DataFrame:
    """The same for files (safe_id, url), tried again with growing pauses; papers whose file is landed already are left out before."""

    def fetch(get: Callable[[str], Iterable[bytes]], url: str) -> tuple[bytes | None, bool, str | None]:
        data, error = with_tries(lambda: read_file(get(url)), tries, pause)
        return data, data is not None, error

    return papers.select("safe_id", "url").mapInArrow(_land(client, fetch), LANDED)


def not_landed(papers: DataFrame, landed: DataFrame) -> DataFrame:
    """Papers that the landing table has no body of."""
    return papers.join(landed.where("body IS NOT NULL").select("safe_id").distinct(), "safe_id", "left_anti")
