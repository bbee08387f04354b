"""The `paged` data source: numbered pages of JSON items, from a web address or a folder, in batch and as a stream.

    paged.register(spark)
    spark.read.format("paged").option("url", "https://host/list?page={page}").option("items", "data.rows").load()
    spark.readStream.format("paged").load(folder)          # offsets are page numbers
    rows.select(F.to_json(F.struct("*")).alias("item")).write.format("paged").mode("append").save(folder)

Rows are (page, place, item): item is the JSON of one item, which from_json or parse_json turns into columns in the JVM.
The driver plans ranges of `pages_per_task` pages; tasks request their own.  Comparisons of `page` with literals
reach the plan, so pages outside them are never requested.

A folder holds data files, one a page, and manifests that name them.  Writing has two phases: tasks write pages under new names,
and the driver's commit adds one manifest in one step.  Until then, after an abort, and after a lost task, nobody reads
them.  A stream's manifests bear the batch's number, and a batch that is run again adds nothing.  A manifest's name is its first
page alone, so of writers that want the same numbers one gets them; planning lists names and reads the last manifest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession, datasource
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceStreamWriter, DataSourceWriter, InputPartition, WriterCommitMessage

from . import store, web

SCHEMA = "page long, place int, item string"
PAGES_PER_TASK, PAGE_SIZE = 16, 100
#: Spark's own bound on an Arrow batch, and the one set here: a task that writes has a whole batch as Python values.
BATCH, SMALL_BATCH = "67108864b", "8m"


class PagedError(OSError):
    pass


def register(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", SMALL_BATCH)
    spark.dataSource.register(Paged)
    return spark


@dataclass
class Range(InputPartition):
    """Pages from `first` up to, but without, `end`."""

    first: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


def ranges(first: int, end: int, most: int) -> list[Range]:
    return [Range(a, min(a + most, end)) for a in range(first, end, most)]


# -- where pages come from -------------------------------------------------------------------------------------------


def at_path(value, path: str):
    for key in filter(None, path.split(".")):
        value = value[int(key)] if isinstance(value, list) else value[key]
    return value


class WebPages:
    """Pages of a web address: `{page}` counts from `first_page`, `{offset}` in items of `size`.

    The number of pages is the option `pages`, or follows from the item count that `total` points to in the first answer, or
    is found by requests: doubling until a page is empty, then halving.
    """

    def __init__(self, options):
        self.url, self.size, self.base = options["url"], int(options.get("size", PAGE_SIZE)), int(options.get("first_page", 0))
        self.items, self.total, self.pages = options.get("items", ""), options.get("total"), options.get("pages")
        self.private = str(options.get("allow_private", "")).lower() == "true"
        self.retries, self.pause_s, self.timeout_s = int(options.get("retries", web.RETRIES)), float(options.get("pause_s", web.PAUSE_S)), float(options.get("timeout_s", web.TIMEOUT_S))

    def answer(self, page: int):
        url = self.url.replace("{page}", str(page + self.base)).replace("{offset}", str(page * self.size)).replace("{size}", str(self.size))
        got = web.attempt(url, lambda u, profile: web.request(u, profile, self.timeout_s, self.private), lambda _: False, self.retries, self.pause_s)
        if got["error"]:
            raise PagedError(f"page {page}: {got['error']}")
        return json.loads(got["body"])

    def rows(self, page: int) -> list[str]:
        return [json.dumps(x, ensure_ascii=False) for x in at_path(self.answer(page), self.items) or []]

    def count(self) -> int:
        if self.pages is not None:
            return int(self.pages)
        if self.total:
            return -(-int(at_path(self.answer(0), self.total)) // self.size)
        low, high = 0, 1  # pages below `low` have items, page `high` - 1 is unknown
        while self.rows(high - 1):
            low, high = high, high * 2
        while low < high - 1:
            mid = (low + high) // 2
            low, high = (mid, high) if self.rows(mid - 1) else (low, mid)
        return low


class FolderPages:
    """Pages that the writer below has committed."""

    def __init__(self, options):
        self.path = options["path"].rstrip("/")

    def firsts(self) -> list[int]:
        """First pages of the manifests, in order."""
        return [int(n.removesuffix(".json")) for n in store.names(f"{self.path}/_manifest")]

    def manifest(self, first: int) -> dict:
        """The tag and the files of the manifest that begins with a page."""
        return json.loads(store.get(f"{self.path}/_manifest/{first:012d}.json"))

    def count(self) -> int:
        firsts = self.firsts()
        return firsts[-1] + len(self.manifest(firsts[-1])["files"]) if firsts else 0

    def rows(self, page: int) -> list[str]:
        if not hasattr(self, "known") or not self.known[0] <= page < self.known[0] + len(self.known[1]):
            first = max(f for f in self.firsts() if f <= page)
            self.known = first, self.manifest(first)["files"]
        data = store.get(f"{self.path}/{self.known[1][page - self.known[0]]}").decode()
        return data.split("\n") if data else []


def source_of(options) -> WebPages | FolderPages:
    if ("url" in options) == ("path" in options):
        raise ValueError("give either the option url or a folder")
    return WebPages(options) if "url" in options else FolderPages(options)


def batches(pages: WebPages | FolderPages, part: Range | None) -> Iterator:
    """A batch for each page; Spark reads an empty plan as one part that is None."""
    import pyarrow as pa

    for page in range(part.first, part.end) if part else ():
        items = pages.rows(page)
        yield pa.RecordBatch.from_arrays([pa.array([page] * len(items), pa.int64()), pa.array(range(len(items)), pa.int32()), pa.array(items, pa.string())], names=["page", "place", "item"])


# -- reading -----------------------------------------------------------------------------------------------------------


#: Bounds [first, end) of whole page numbers that a comparison leaves.
BOUNDS: dict[type, Callable[[int], tuple[float, float]]] = {
    datasource.EqualTo: lambda v: (v, v + 1),
    datasource.GreaterThan: lambda v: (v + 1, float("inf")),
    datasource.GreaterThanOrEqual: lambda v: (v, float("inf")),
    datasource.LessThan: lambda v: (0, v),
    datasource.LessThanOrEqual: lambda v: (0, v + 1),
}


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.options, self.first, self.end, self.only = options, 0, float("inf"), None

    def pushFilters(self, filters):
        for f in filters:
            if getattr(f, "attribute", None) == ("page",) and type(f) in BOUNDS:
                low, high = BOUNDS[type(f)](f.value)
                self.first, self.end = max(self.first, low), min(self.end, high)
            elif getattr(f, "attribute", None) == ("page",) and isinstance(f, datasource.In):
                self.only = set(f.value) if self.only is None else self.only & set(f.value)
            elif not (isinstance(f, datasource.IsNotNull) and f.attribute == ("page",)):
                yield f

    def partitions(self):
        # bounds that are closed need no count of a web source; a folder's pages are counted by its names
        first, end = int(self.first), self.end
        pages = source_of(self.options)
        end = int(min(end, pages.count()))
        most = int(self.options.get("pages_per_task", PAGES_PER_TASK))
        if self.only is not None:
            return [Range(p, p + 1) for p in sorted(self.only) if first <= p < end]
        return ranges(first, end, most)

    def read(self, partition):
        yield from batches(source_of(self.options), partition)


class PagedStream(DataSourceStreamReader):
    """Offsets are numbers of pages; a source only grows, and a page that is there doesn't change."""

    def __init__(self, options):
        self.options = options

    def initialOffset(self):
        return {"page": int(self.options.get("from_page", 0))}

    def latestOffset(self):
        return {"page": max(source_of(self.options).count(), self.initialOffset()["page"])}

    def partitions(self, start, end):
        return ranges(start["page"], end["page"], int(self.options.get("pages_per_task", PAGES_PER_TASK)))

    def read(self, partition):
        yield from batches(source_of(self.options), partition)


# -- writing -----------------------------------------------------------------------------------------------------------


class _Writing:
    def __init__(self, options):
        self.options = options

    def write(self, iterator):
        """Phase one, in a task: pages of `size` items under names that no other attempt has."""
        folder, size = self.options["path"].rstrip("/"), int(self.options.get("size", PAGE_SIZE))
        held, files = [], []

        def page() -> None:
            name = f"data/{uuid.uuid4().hex}.jsonl"
            store.put(f"{folder}/{name}", "\n".join(held).encode())
            files.append(name)
            held.clear()

        for row in iterator:
            held.append(row[0].replace("\n", " "))  # a line break of JSON is white space
            if len(held) == size:
                page()
        if held:
            page()
        return Written(files)

    def add(self, messages, tag: str) -> None:
        """Phase two, on the driver: one manifest, in the order of partitions."""
        files = [f for m in messages if m is not None for f in m.files]
        pages = FolderPages(self.options)
        while files:
            try:
                return store.put(f"{pages.path}/_manifest/{pages.count():012d}.json", json.dumps({"tag": tag, "files": files}).encode(), new=True)
            except FileExistsError:  # another writer took these numbers
                continue

    def drop(self, messages) -> None:
        for m in messages:
            for f in m.files if m is not None else ():
                store.remove(f"{self.options['path'].rstrip('/')}/{f}")


class PagedWriter(_Writing, DataSourceWriter):
    def commit(self, messages):
        self.add(messages, uuid.uuid4().hex)

    def abort(self, messages):
        self.drop(messages)


class PagedStreamWriter(_Writing, DataSourceStreamWriter):
    """`writer` tells apart queries that write into one folder."""

    def committed(self, writer: str, batch: int) -> bool:
        """A writer's batches come in order, so manifests are read from the last one back to one of no later batch."""
        pages = FolderPages(self.options)
        for first in reversed(pages.firsts()):
            name, _, number = pages.manifest(first)["tag"].rpartition(".")
            if name == writer and int(number) <= batch:
                return int(number) == batch
        return False

    def commit(self, messages, batchId):
        writer = self.options.get("writer", "stream")
        tag = f"{writer}.{batchId}"
        if self.committed(writer, batchId):
            self.drop(messages)  # the batch was committed before its query stopped
        else:
            self.add(messages, tag)

    def abort(self, messages, batchId):
        self.drop(messages)


class Paged(DataSource):
    @classmethod
    def name(cls):
        return "paged"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return PagedReader(self.options)

    def streamReader(self, schema):
        return PagedStream(self.options)

    def _folder(self, schema, overwrite: bool):
        if overwrite:
            raise ValueError("pages are only ever added: write in mode append")
        if "path" not in self.options or [f.dataType.simpleString() for f in schema] != ["string"]:
            raise ValueError("give a folder, and one column of JSON items")
        return self.options

    def writer(self, schema, overwrite):
        return PagedWriter(self._folder(schema, overwrite))

    def streamWriter(self, schema, overwrite):
        return PagedStreamWriter(self._folder(schema, overwrite))
