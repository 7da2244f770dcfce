"""A paged API as a Spark source: pages by offset, read in parallel, in batch or as a stream that resumes at its offset.

    spark.dataSource.register(paged_source("vulns", HttpPages(url)))
    spark.read.format("vulns").option("page_size", 2000).load()
    spark.readStream.format("vulns").load()

Rows are (index, record): the record's place and its JSON text, to be parsed by from_json with the schema one wants.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "index long, record string"
PAGE_SIZE = 2000
#: Partitions of a scan: more pages than that are read several a partition, one after another.
MOST_PARTITIONS = 400


class Pages(Protocol):
    """What a source asks of an API; it is sent to the tasks, so it holds no open connection."""

    def total(self) -> int | None:
        """Records there are now, or None if only a short page tells."""

    def page(self, start: int, size: int) -> list[str]:
        """Up to `size` records from `start` on; fewer at the end alone."""


@dataclass
class HttpPages:
    """An API that takes an offset and a page size as parameters and answers JSON with the total and a list of records. A request
    that fails is repeated after a delay that doubles up to `longest`; after `retries` of them the task fails, and with it
    nothing is lost: its partition, or the stream's batch, is read again."""

    url: str
    params: dict[str, str] = field(default_factory=dict)
    records: str = "vulnerabilities"
    total_field: str = "totalResults"
    start_param: str = "startIndex"
    size_param: str = "resultsPerPage"
    retries: int = 5
    delay: float = 0.5
    longest: float = 30.0
    timeout: float = 60.0

    def _get(self, start: int, size: int) -> dict:
        url = f"{self.url}?{urllib.parse.urlencode(self.params | {self.start_param: start, self.size_param: size})}"
        for attempt in range(self.retries + 1):
            try:
                with urllib.request.urlopen(url, timeout=self.timeout) as answer:
                    return json.load(answer)
            except (OSError, ValueError) as e:
                if attempt == self.retries or isinstance(e, urllib.error.HTTPError) and e.code in (400, 401, 404):
                    raise
                time.sleep(min(self.delay * 2**attempt, self.longest))
        raise AssertionError

    def total(self) -> int | None:
        found = self._get(0, 1).get(self.total_field)
        return None if found is None else int(found)

    def page(self, start: int, size: int) -> list[str]:
        return [json.dumps(r, ensure_ascii=False) for r in self._get(start, size).get(self.records, [])]


@dataclass
class LandedPages:
    """Pages that were landed as folders start=<index of the first record> of JSON lines, of any size each, below a folder that the
    driver and all executors reach through Arrow's file systems. Where a page is shorter than the next one's start says, the
    scan ends."""

    folder: str
    #: Folders by the index of their first record, as listed before for a range of records; None: list them.
    listed: list[tuple[int, str]] | None = None

    def _starts(self):
        from pyarrow import fs

        if self.listed is not None:
            return fs.FileSystem.from_uri(self.folder)[0], self.listed

        system, path = fs.FileSystem.from_uri(self.folder)
        found = [f for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.base_name.startswith("start=")]
        return system, sorted((int(f.base_name[6:]), f.path) for f in found)

    @staticmethod
    def _lines(system, path: str) -> list[str]:
        from pyarrow import fs

        out: list[str] = []
        for f in sorted(system.get_file_info(fs.FileSelector(path)), key=lambda f: f.base_name):
            if f.base_name.startswith("part-"):
                with system.open_input_stream(f.path) as stream:
                    out += stream.read().decode().splitlines()
        return out

    def within(self, ranges: list[tuple[int, int]]) -> list[LandedPages]:
        """The same pages for each range of records alone, of one listing: their folders go with each, and no task lists the others."""
        _, starts = self._starts()
        at = [s for s, _ in starts]
        # from the last folder that starts at a range's begin or before, to the first that starts at its end or after, which tells where a page ends
        return [LandedPages(self.folder, starts[max(bisect_right(at, low) - 1, 0) : bisect_left(at, high) + 1]) for low, high in ranges]

    def total(self) -> int:
        system, starts = self._starts()
        end = 0
        for (start, _), (after, _) in zip(starts, starts[1:], strict=False):
            if start != end:
                return end
            end = after
        return starts[-1][0] + len(self._lines(system, starts[-1][1])) if starts and starts[-1][0] == end else end

    def page(self, start: int, size: int) -> list[str]:
        system, starts = self._starts()
        out: list[str] = []
        for i, (at, path) in enumerate(starts):
            after = starts[i + 1][0] if i + 1 < len(starts) else start + size
            if after > start and at < start + size and at <= start + len(out):
                out += self._lines(system, path)[max(start + len(out) - at, 0) : start + size - at]
        return out


@dataclass
class PageRange(InputPartition):
    start: int
    size: int | None  # None: page by page until a short one
    pages: Pages | None = None  # if the source can tell what a range of it needs


def _read(pages: Pages, part: PageRange, size: int) -> Iterator[pa.RecordBatch]:
    at, end = part.start, None if part.size is None else part.start + part.size
    while end is None or at < end:
        want = size if end is None else min(size, end - at)
        found = pages.page(at, want)
        yield pa.RecordBatch.from_arrays([pa.array(range(at, at + len(found)), pa.int64()), pa.array(found, pa.string())], names=["index", "record"])
        at += len(found)
        if len(found) < want:
            if end is not None:
                raise ValueError(f"the page at {at - len(found)} has {len(found)} records instead of {want}: the source has shrunk")
            return


def _ranges(pages: Pages, start: int, end: int, size: int) -> list[PageRange]:
    """A page a partition, or beyond MOST_PARTITIONS as many pages each as that takes."""
    step = size * max(1, -(-(end - start) // (size * MOST_PARTITIONS)))
    ranges = [(at, min(at + step, end)) for at in range(start, end, step)]
    own = pages.within(ranges) if hasattr(pages, "within") and ranges else [None] * len(ranges)
    return [PageRange(low, high - low, p) for (low, high), p in zip(ranges, own, strict=True)]


class _Batch(DataSourceReader):
    def __init__(self, pages: Pages, size: int, start: int):
        self.pages, self.size, self.start = pages, size, start

    def partitions(self):
        total = self.pages.total()
        return [PageRange(self.start, None)] if total is None else _ranges(self.pages, self.start, total, self.size) or [PageRange(self.start, 0)]

    def read(self, partition):
        return _read(partition.pages or self.pages, partition, self.size)


class _Stream(DataSourceStreamReader):
    """Offsets are numbers of records. Spark writes them to the checkpoint before a batch is read, so a stopped stream goes on
    with the first record that no finished batch has."""

    def __init__(self, pages: Pages, size: int, start: int):
        self.pages, self.size, self.start = pages, size, start

    def initialOffset(self) -> dict:
        return {"index": self.start}

    def latestOffset(self) -> dict:
        total = self.pages.total()
        if total is None:
            raise ValueError("a stream needs a source that knows its total")
        return {"index": max(total, self.start)}

    def partitions(self, start: dict, end: dict):
        return _ranges(self.pages, start["index"], end["index"], self.size)

    def read(self, partition):
        return _read(partition.pages or self.pages, partition, self.size)

    def commit(self, end: dict) -> None:
        pass  # the checkpoint has it


def paged_source(name: str, pages: Pages) -> type[DataSource]:
    """A data source of this name for spark.dataSource.register. Options: page_size, start_index. Each page is a partition, while there are at most MOST_PARTITIONS."""

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def _how(self):
            return pages, int(self.options.get("page_size", PAGE_SIZE)), int(self.options.get("start_index", 0))

        def reader(self, schema):
            return _Batch(*self._how())

        def streamReader(self, schema):
            return _Stream(*self._how())

    return Paged
