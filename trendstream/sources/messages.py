"""Message sources: JSON message files, in-memory rows and post searches.

``reader(kind)`` selects a source by name:

* ``"search"``: search a posts DataFrame (query text, language, page size);
* ``"fixed"``:  a predefined message file; the query is ignored and every
  message is returned (the test switch of the ingest job).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstream.operators import messages as M
from trendstream.operators import paging as PG
from trendstream.schemas import MESSAGE


@dataclass(frozen=True)
class SearchRequest:
    """A post search: text, language, page size and keyset cursor (-1 = none)."""
    query: str
    lang: str | None = None
    count: int = PG.PAGE_SIZE
    max_id: int = -1


class SearchPage:
    """One result page: the messages, the request that produced them and the
    keyset cursor of the next request (None when the page was empty).

    Unpacks as ``(messages, next_max_id)``.
    """

    def __init__(self, messages: DataFrame, request: SearchRequest | None, next_max_id: int | None):
        self.messages, self.request, self.next_max_id = messages, request, next_max_id

    def __iter__(self):
        return iter((self.messages, self.next_max_id))

    def has_next(self) -> bool:
        return self.next_max_id is not None

    def next_request(self) -> SearchRequest | None:
        if not self.has_next() or self.request is None:
            return None
        return replace(self.request, max_id=self.next_max_id)


def holds_json_array(spark: SparkSession, path: str) -> bool:
    """Whether the first non-blank line of the file(s) opens an array over several lines."""
    line = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> ''").limit(1).collect()
    return bool(line) and line[0]["v"].startswith("[")


def read_messages_json(spark: SparkSession, path: str, json_array: bool | None = None,
                       default_now: bool = False) -> DataFrame:
    """Message file(s): a JSON array per file or JSON lines; told apart by the
    first line unless ``json_array`` says which.  A line that is not JSON is an
    error, so a file read in the wrong form never loses messages silently."""
    if json_array is None:
        json_array = holds_json_array(spark, path)
    df = (spark.read.schema(MESSAGE).option("multiLine", str(json_array).lower())
          .option("mode", "FAILFAST").json(path))
    return M.apply_defaults(df, default_now)


def write_messages(messages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write messages as JSON lines (one part file per partition)."""
    messages.write.mode(mode).json(path)


# Bytes of one array file, about: a task parses an array as a whole.
ARRAY_BYTES = 16 << 20


def write_message_arrays(messages: DataFrame, path: str, mode: str = "overwrite", most: int = ARRAY_BYTES) -> None:
    """Write messages as files that hold one JSON array over several lines.

    A partition fills one file of about ``most`` bytes after the other, without
    a shuffle, so the number of files follows the bytes of the messages and no
    value.  A message over ``most`` bytes has a file of its own.
    """
    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def array() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"value": pa.array([b"[\n" + b",\n".join(rows) + b"\n]"], pa.binary())})

        rows, held = [], 0
        for row in (r.as_py() for batch in batches for r in batch.column(0)):
            if rows and held + len(row) > most:
                yield array()
                rows, held = [], 0
            rows.append(row)
            held += len(row)
        if rows:
            yield array()

    (messages.select(F.to_json(F.struct("*")).cast("binary").alias("row")).mapInArrow(arrays, "value binary")
     .select(F.col("value").cast("string")).write.mode(mode).option("maxRecordsPerFile", "1").text(path))


def fixed_messages(spark: SparkSession, rows: list) -> DataFrame:
    """Small in-memory message list (tests, fixtures)."""
    df = spark.createDataFrame(rows, MESSAGE) if rows else spark.createDataFrame([], MESSAGE)
    return M.apply_defaults(df)


class FixedSource:
    """Returns every message of its file or DataFrame, whatever the request."""

    def __init__(self, spark: SparkSession, path: str | None = None, messages: DataFrame | None = None,
                 json_array: bool | None = None):
        self._df = messages if messages is not None else read_messages_json(spark, path, json_array)

    def search(self, request: SearchRequest) -> SearchPage:
        return SearchPage(self._df, request, None)


class SearchSource:
    """Searches a posts DataFrame (columns id, text, lang, ...)."""

    def __init__(self, posts: DataFrame):
        self._posts = posts

    def search(self, request: SearchRequest) -> SearchPage:
        page, cursor = PG.search_page(self._posts, request.query, request.lang, request.count,
                                      request.max_id if request.max_id >= 0 else None)
        return SearchPage(page, request, cursor)


class IndexedSource:
    """Searches a trigram index of posts (``operators.search_index``)."""

    def __init__(self, index):
        self._index = index

    def search(self, request: SearchRequest) -> SearchPage:
        page = self._index.search(request.query, request.lang, request.count,
                                  request.max_id if request.max_id >= 0 else None)
        return SearchPage(page, request, PG.next_cursor(page))


# Session setting naming the built-in message file of the fixed source.
DEFAULT_MESSAGES_CONF = "trendstream.messages.path"


def reader(kind: str, spark: SparkSession, **kw):
    """Source by name: 'search', 'index' or 'fixed'; anything else is an error.

    ``fixed`` without a path or DataFrame reads the file named by the
    session setting ``trendstream.messages.path``.
    """
    k = kind.lower()
    if k == "search":
        return SearchSource(kw["posts"])
    if k == "index":
        return IndexedSource(kw["index"])
    if k == "fixed":
        path = kw.get("path")
        if path is None and kw.get("messages") is None:
            path = spark.conf.get(DEFAULT_MESSAGES_CONF, None)
            if not path:
                raise ValueError(f"no message file: set {DEFAULT_MESSAGES_CONF}")
        return FixedSource(spark, path, kw.get("messages"), kw.get("json_array"))
    raise ValueError(f"unknown message source {kind!r}")
