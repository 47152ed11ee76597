"""Substring search by a trigram index.

Building writes two tables.  ``texts`` holds the posts, newest first, each with its
``place`` in that order.  ``postings`` holds, for each trigram of the lower-cased
texts and each block of neighbouring places, the places whose text has it, sorted
by trigram, so that a lookup opens only the row groups of its trigrams.  A list
never holds more than a block's places, however frequent its trigram is.

A search intersects the lists of its query's trigrams block by block, takes the
newest candidates, reads their texts alone (a range of places) and keeps those
that do contain the query; it goes on to older ones, twice as many each time,
until the page is full.  Texts are padded at their end, so that queries of one
or two characters are prefixes of trigrams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstream.operators import paging as PG
from trendstream.session import fresh_path, materialize

BLOCK = 8192            # places of a posting list, at most
CHUNK = 1 << 20         # characters of a text that are cut into trigrams at once
SLICE = 4 << 20         # characters of texts whose lists are made at once
PAD = "\u0000\u0000"
_U = np.uint64
_LISTS = pa.schema([("trigram", pa.string()), ("block", pa.int64()), ("places", pa.list_(pa.int64()))])


def posting_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(trigram, block, places) of the texts ``low`` (not null) at ``place``, a list for each slice of a block's texts.

    A text is cut into pieces of CHUNK characters, each with the two that follow it.
    """
    texts, places, size = [], [], 0
    for batch in batches:
        for place, text in zip(batch.column("place").to_pylist(), batch.column("low").to_pylist()):
            for at in range(0, len(text), CHUNK):
                if texts and (size >= SLICE or place // BLOCK != places[0] // BLOCK):
                    yield _slice_lists(texts, places)
                    texts, places, size = [], [], 0
                texts.append(text[at:at + CHUNK + 2])
                places.append(place)
                size += len(texts[-1])
    if texts:
        yield _slice_lists(texts, places)


def _slice_lists(texts: list[str], places: list[int]) -> pa.RecordBatch:
    """Lists of one slice: its runs of three characters sorted by their code points, texts in order."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    owner = np.repeat(np.array(places, dtype=np.int64), [len(t) for t in texts])
    piece = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    inside = piece[:-2] == piece[2:]
    code = ((chars[:-2] << _U(42)) | (chars[1:-1] << _U(21)) | chars[2:])[inside]
    order = np.argsort(code, kind="stable")
    code, place = code[order], owner[:-2][inside][order]
    other = np.ones(len(code), dtype=bool)
    other[1:] = code[1:] != code[:-1]
    kept = other.copy()
    kept[1:] |= place[1:] != place[:-1]
    starts = np.flatnonzero(other[kept])
    found, place = code[kept][starts], place[kept]
    last = _U((1 << 21) - 1)
    runs = np.stack([found >> _U(42), (found >> _U(21)) & last, found & last], axis=1).astype("<u4").tobytes().decode("utf-32-le")
    return pa.RecordBatch.from_arrays(
        [pa.array([runs[i:i + 3] for i in range(0, len(runs), 3)], pa.string()),
         pa.array(np.full(len(starts), places[0] // BLOCK), pa.int64()),
         pa.ListArray.from_arrays(pa.array(np.append(starts, len(place)), pa.int32()), pa.array(place, pa.int64()))],
        schema=_LISTS)


@dataclass
class TextIndex:
    spark: SparkSession
    path: str
    text: str = "text"
    id_col: str = "id"

    @classmethod
    def build(cls, posts: DataFrame, path: str | None = None, text: str = "text", id_col: str = "id") -> TextIndex:
        """Write the index of ``posts`` (a new folder of the shared one, unless a path is given).

        Posts without a text are in no list; posts without an id come last, as in
        a scan.
        """
        spark = posts.sparkSession
        index = cls(spark, path or fresh_path(spark, "text-index"), text, id_col)
        newest = F.col(id_col).desc()
        (posts.repartitionByRange(newest, F.xxhash64(*posts.columns)).sortWithinPartitions(newest)
         .withColumn("place", F.monotonically_increasing_id()).write.parquet(f"{index.path}/texts"))
        low = F.make_valid_utf8(F.concat(F.lower(F.col(text)), F.lit(PAD)))
        # a task cuts neighbouring texts, so what is written and sorted is lists, not a row for each trigram of a text
        lists = materialize(index.texts().where(F.col(text).isNotNull()).select("place", low.alias("low"))
                            .mapInArrow(posting_lists, "trigram string, block long, places array<long>"), "index-lists")
        (lists.repartitionByRange("trigram", "block").groupBy("trigram", "block")
         .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"))
         .sortWithinPartitions("trigram", "block").write.parquet(f"{index.path}/postings"))
        return index

    def texts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/texts")

    def postings(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/postings")

    def candidates(self, query: str) -> DataFrame:
        """(place) of the texts that have every trigram of the query: all that contain it, and few others."""
        low = self.spark.range(1).select(F.lower(F.lit(query)).alias("q")).first()["q"]
        if len(low) < 3:
            return self.postings().where(F.col("trigram").startswith(low)).select(
                F.explode("places").alias("place")).distinct()
        wanted = sorted({low[i:i + 3] for i in range(len(low) - 2)})
        lists = self.postings().where(F.col("trigram").isin(wanted)).groupBy("block").agg(F.collect_list("places").alias("lists"))
        both = F.aggregate(F.slice("lists", 2, len(wanted)), F.get("lists", F.lit(0)), lambda a, b: F.array_intersect(a, b))
        return lists.where(F.size("lists") == len(wanted)).select(F.explode(both).alias("place"))

    def search(self, query: str | None = None, lang: str | None = None, count: int = PG.PAGE_SIZE,
               max_id: int | None = None) -> DataFrame:
        """One page, as ``paging.search`` gives it: the ``count`` newest matches."""
        posts = self.texts()
        columns = [c for c in posts.columns if c != "place"]
        if not query:
            return PG.search(posts, None, lang, count, max_id, self.id_col).select(*columns)
        found = self.candidates(query)
        if max_id is not None and max_id >= 0:
            first = posts.where(F.col(self.id_col) <= max_id).agg(F.min("place")).first()[0]
            found = found.where(F.col("place") >= first) if first is not None else found.limit(0)
        found = materialize(found, "index-candidates")
        page, got, after, take = None, 0, -1, 2 * count
        while got < count:
            some = found.where(F.col("place") > after).orderBy("place").limit(take)
            reach = some.agg(F.max("place").alias("to"), F.count(F.lit(1)).alias("n")).first()
            if not reach["n"]:
                break
            part = (posts.where((F.col("place") > after) & (F.col("place") <= reach["to"]))
                    .join(some.hint("merge"), "place", "left_semi"))
            part = materialize(PG.matches(part, query, lang, max_id, self.text, self.id_col), "index-page")
            got += part.count()
            page = part if page is None else page.unionByName(part)
            after, take = reach["to"], 2 * take
        if page is None:
            return posts.limit(0).select(*columns)
        return page.orderBy("place").limit(count).select(*columns)


def search_all(index: TextIndex, query: str, lang: str | None = None) -> DataFrame:
    """Every match: the candidates' texts, verified."""
    posts = index.texts()
    some = posts.join(index.candidates(query).hint("merge"), "place", "left_semi")
    return PG.matches(some, query, lang, None, index.text, index.id_col).drop("place")
