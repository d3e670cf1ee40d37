"""Data sources for paged paper metadata.

``paged_papers`` harvests: one partition for each set, pages behind resumption tokens, between the dates
``from`` and ``until``. ``searched_papers`` asks a search: pages of ``pageSize`` rows, newest first, up to
``maxResults``. The client is given by import path ("package.module:function"); the harvest's takes (set,
token, from, until), the search's (query, first row, rows), both return (XML text, status, seconds to wait;
None where the answer names none), so that jobs and tests choose their own transport. A page that fails
for good is an error, so a table is whole or isn't there.

``harvested_records`` gives the harvest's records instead of its pages. A filter on ``created`` that is
pushed to it becomes the dates of its requests; as records are dated by their last change, the request
asks for some days more, and Spark applies the filter itself afterwards. It can be read as a stream too:
offsets are the pages' tokens, a batch has a page of each set that has any left, and a stream that starts
again from its checkpoint goes on behind the last page that was committed.

``folder_client`` answers from stored pages, as Spark writes them by set and page.
"""

from __future__ import annotations

import importlib
import json
import re
import time
from collections.abc import Callable, Iterable, Iterator
from datetime import date, timedelta
from functools import partial
from xml.etree import ElementTree

from pyarrow import fs
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    SimpleDataSourceStreamReader,
)

from lexiscope.sources.files import resumption_token

#: Statuses that are tried again, how often, seconds after the first try (those after the k-th are k times as many),
#: seconds after a network error, and rows of a page of the search.
TRANSIENT, ATTEMPTS, PAUSE, NETWORK_PAUSE, PAGE = (429, 502, 503, 504), 5, 300, 60, 1000
ENTRY = re.compile(r"<(?:\w+:)?entry[\s>]")


class FetchError(RuntimeError):
    """A page that couldn't be had."""


def with_attempts(fetch: Callable[[], tuple[str, int, float | None]], longest: float, sleep: Callable[[float], None] = time.sleep) -> str:
    """A page, tried again after transient statuses and network errors with growing waits; FetchError at the end."""
    for attempt in range(1, ATTEMPTS + 1):
        try:
            xml, status, wait = fetch()
        except OSError as e:
            error, pause = str(e), NETWORK_PAUSE
        else:
            if status == 200:
                return xml
            error, pause = f"status {status}", PAUSE * attempt if wait is None else wait
            if status not in TRANSIENT:
                break
        if attempt < ATTEMPTS:
            sleep(min(pause, longest))
    raise FetchError(f"no page after {attempt} tries: {error}")


def _client(path: str, folder: str | None = None) -> Callable:
    module, _, name = path.partition(":")
    found = getattr(importlib.import_module(module), name)
    return partial(found, folder) if folder else found


#: Days that a harvest asks for before and after its window, as records are dated by their last change.
DAYS_BEFORE, DAYS_AFTER = 2, 1


def folder_client(folder: str, name: str, token: str | None, first: str | None = None, last: str | None = None) -> tuple[str, int, float | None]:
    """A stored page of a set: what the files of ``set=.../page=...`` hold; tokens are pages' names, the first one's is 0. Dates aren't looked at."""
    files, path = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
    there = files.get_file_info(fs.FileSelector(f"{path}/set={name}/page={token or 0}", allow_not_found=True))
    parts = []
    for info in sorted(there, key=lambda x: x.path):
        if info.type == fs.FileType.File and not info.base_name.startswith(("_", ".")):
            with files.open_input_stream(info.path) as f:
                parts.append(f.read().decode())
    return ("".join(parts), 200, None) if parts else ("", 404, None)


RECORD = "set string, page int, place int, id string, title string, abstract string, authors array<string>, categories array<string>, created date"


def records_of(xml: str) -> Iterator[tuple]:
    """(place, id, title, abstract, authors, categories, created) of a page's records; those without metadata go."""
    root = ElementTree.fromstring(xml)
    for e in root.iter():
        e.tag = e.tag.rpartition("}")[2]
    squeeze = lambda x: " ".join((x or "").split()) or None
    for place, record in enumerate(root.iter("record")):
        m = record.find("metadata/*")
        if m is None:
            continue
        own = squeeze(m.findtext("id")) or (record.findtext("header/identifier") or "").rpartition(":")[2]
        authors = [" ".join(filter(None, (squeeze(a.findtext("forenames")), squeeze(a.findtext("keyname"))))) for a in m.iter("author")]
        day = (m.findtext("created") or "").strip()
        created = date.fromisoformat(day) if re.fullmatch(r"\d{4}-\d\d-\d\d", day) else None
        yield place, f"https://arxiv.org/abs/{own}", squeeze(m.findtext("title")), squeeze(m.findtext("abstract")), authors, (m.findtext("categories") or "").split(), created


class _Set(InputPartition):
    def __init__(self, name: str):
        self.name = name


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.sets = [s for s in options.get("sets", "").split(",") if s]
        self.client = options["client"]
        self.longest = float(options.get("maxWait", PAUSE * ATTEMPTS))
        self.bounds = options.get("from"), options.get("until")

    def partitions(self) -> list[_Set]:
        return [_Set(s) for s in self.sets]

    def read(self, partition: _Set) -> Iterator[tuple[str, int, str]]:
        fetch, token, page = _client(self.client), None, 0
        while True:
            xml = with_attempts(lambda t=token: fetch(partition.name, t, *self.bounds), self.longest)
            yield partition.name, page, xml
            token, page = resumption_token(xml), page + 1
            if not token:
                return


class _RecordReader(_Reader):
    def __init__(self, options: dict):
        super().__init__(options)
        self.folder = options.get("folder")

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802  Spark's name
        """Bounds of ``created`` become the request's; every filter is Spark's to apply, as a request's dates are others."""
        first, last = (date.fromisoformat(x) if x else None for x in self.bounds)
        for f in filters:
            if getattr(f, "attribute", None) == ("created",) and isinstance(getattr(f, "value", None), date):
                if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                    own = f.value - timedelta(DAYS_BEFORE)
                    first = max(first or own, own)
                if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                    own = f.value + timedelta(DAYS_AFTER)
                    last = min(last or own, own)
            yield f
        self.bounds = tuple(x.isoformat() if x else None for x in (first, last))

    def read(self, partition: _Set) -> Iterator[tuple]:
        fetch, token, page = _client(self.client, self.folder), None, 0
        while True:
            xml = with_attempts(lambda t=token: fetch(partition.name, t, *self.bounds), self.longest)
            for record in records_of(xml):
                yield partition.name, page, *record
            token, page = resumption_token(xml), page + 1
            if not token:
                return


class _RecordStream(SimpleDataSourceStreamReader):
    """A page of each set a batch. An offset holds the next page's number and token by set, and null for a set that is done."""

    def __init__(self, options: dict):
        self.reader = _RecordReader(options)

    def initialOffset(self) -> dict:  # noqa: N802  Spark's name
        return {"sets": json.dumps({s: [0, None] for s in self.reader.sets}, sort_keys=True)}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        fetch, rows, ahead = _client(self.reader.client, self.reader.folder), [], {}
        for name, at in json.loads(start["sets"]).items():
            ahead[name] = at
            if at is not None:
                xml = with_attempts(lambda n=name, t=at[1]: fetch(n, t, *self.reader.bounds), self.reader.longest)
                rows += [(name, at[0], *record) for record in records_of(xml)]
                token = resumption_token(xml)
                ahead[name] = [at[0] + 1, token] if token else None
        return iter(rows), {"sets": json.dumps(ahead, sort_keys=True)}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:  # noqa: N802  Spark's name
        while start != end:
            rows, start = self.read(start)
            yield from rows

    def commit(self, end: dict) -> None:
        pass


class HarvestedRecords(DataSource):
    @classmethod
    def name(cls) -> str:
        return "harvested_records"

    def schema(self) -> str:
        return RECORD

    def reader(self, schema) -> DataSourceReader:
        return _RecordReader(self.options)

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:  # noqa: N802  Spark's name
        return _RecordStream(self.options)


class _SearchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.query, self.client = options["query"], options["client"]
        self.size, self.most = int(options.get("pageSize", PAGE)), int(options.get("maxResults", PAGE))
        self.longest = float(options.get("maxWait", PAUSE * ATTEMPTS))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple[int, str]]:
        """Pages one after the other, as only an answer tells whether there is another."""
        fetch = _client(self.client)
        for first in range(0, self.most, self.size):
            n = min(self.size, self.most - first)
            xml = with_attempts(lambda a=first, k=n: fetch(self.query, a, k), self.longest)
            yield first // self.size, xml
            if len(ENTRY.findall(xml)) < n:
                return


class SearchedPapers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "searched_papers"

    def schema(self) -> str:
        return "page int, xml string"

    def reader(self, schema) -> DataSourceReader:
        return _SearchReader(self.options)


class PagedPapers(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_papers"

    def schema(self) -> str:
        return "set string, page int, xml string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
