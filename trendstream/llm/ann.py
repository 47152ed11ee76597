"""Nearest neighbours by multi-index hashing.

Vectors become binary codes by a learned rotation (iterative quantisation on a
bounded sample).  A code is split into substrings and the index holds one row
per substring, sorted by (substring number, value).  Codes within Hamming
distance r of a query agree with it up to a known number of bits in at least
one substring (pigeonhole), so a query probes, in each substring's index, the
values within that number, keeps the codes within r and ranks them by their
exact distance on the original floats.  The radius is learned too: it is the
``coverage`` quantile of the code distances between sample vectors and their
exact neighbours.  A query that finds fewer than k neighbours is searched again
over all rows, so no query is cut short.

Only distinct vectors are indexed.  A vector with many ids keeps its smallest
ones, the only ones that can be among k nearest with ties to the smaller id, so
a vector that a third of all rows share costs one entry.  Queries are taken in
blocks of bounded size, each broadcast to the index's partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendstream.llm.common import hash_below, quoted
from trendstream.session import materialize

SAMPLE = 8192          # vectors to learn the rotation from, at most
PROBES = 512           # of those, vectors to learn the radius from
ROUNDS = 40
SUBSTRINGS = 4
BITS = 16              # of each substring
COVERAGE = 0.98
QUERY_BLOCK = 4096     # queries broadcast at once
_FOUND = pa.schema([("qid", pa.int64()), ("vid", pa.int64()), ("score", pa.float64())])


@dataclass
class Coder:
    mean: np.ndarray
    rotation: np.ndarray   # (dimensions, SUBSTRINGS * BITS)
    radius: int

    def substrings(self, vectors: np.ndarray) -> np.ndarray:
        """(n, SUBSTRINGS) substrings of BITS bits."""
        on = (vectors - self.mean) @ self.rotation > 0
        return np.packbits(on, axis=1).view(">u2").astype(np.uint16).reshape(len(vectors), SUBSTRINGS)

    def allowed(self) -> list[int]:
        """Bits that may differ in each substring: thresholds t with sum(t + 1) = radius + 1 cover the radius."""
        whole, rest = divmod(self.radius + 1, SUBSTRINGS)
        return [whole - 1 + (s < rest) for s in range(SUBSTRINGS)]


def learn(sample: np.ndarray, k: int, coverage: float = COVERAGE, seed: int = 3) -> Coder:
    """Rotation by iterative quantisation, radius by exact search inside the sample."""
    n_bits = SUBSTRINGS * BITS
    rng = np.random.default_rng(seed)
    mean = sample.mean(axis=0)
    x = sample - mean
    dims = x.shape[1]
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]                             # principal axes, widest first
    spread = np.tile(axes, -(-n_bits // dims))[:, :n_bits]
    z = x @ spread
    turn = np.linalg.qr(rng.normal(size=(n_bits, n_bits)))[0]
    for _ in range(ROUNDS):
        left, _, right = np.linalg.svd(z.T @ np.where(z @ turn > 0, 1.0, -1.0))
        turn = left @ right
    coder = Coder(mean, spread @ turn, n_bits)
    probes = np.arange(min(PROBES, len(sample)))
    codes = coder.substrings(sample)
    if len(sample) > 1:
        distance = ((sample[probes] ** 2).sum(1)[:, None] + (sample ** 2).sum(1)[None]
                    - 2 * sample[probes] @ sample.T)
        distance[probes, probes] = np.inf
        near = np.argsort(distance, axis=1)[:, :min(k, len(sample) - 1)]
        bits = np.bitwise_count(codes[probes][:, None] ^ codes[near]).sum(axis=2)
        coder.radius = int(np.quantile(bits, coverage))
    return coder


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dims)


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
                       vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row.

    score is the Euclidean distance in double precision on the original
    vectors; a query's own row is no candidate; ties go to the smaller id; with
    fewer candidates all are returned.  Vectors that are null, zero, hold a null
    or non-finite component, have no id, or whose length is not the most common
    one (the smaller of equally common ones) take no part.  Rows repeated with the same id and vector
    count once.  No valid query or candidate: an empty result.  Other columns
    are not read.
    """
    spark = vectors.sparkSession
    rows = (vectors.filter(_valid(F.col(quoted(vector_col))) & F.col(quoted(id_col)).isNotNull())
            .select(F.col(quoted(id_col)).cast("long").alias("id"),
                    F.col(quoted(vector_col)).cast("array<double>").alias("v"), is_query.alias("asks")))
    usual = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = usual["n"]
    rows = rows.filter(F.size("v") == dims)

    # k + 1 smallest ids of a vector: a query's own id may be one of them
    order = Window.partitionBy("v").orderBy("id")
    few = (rows.withColumn("nth", F.dense_rank().over(order)).filter(F.col("nth") <= k + 1)
           .groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids")))
    points = materialize(few.select(F.monotonically_increasing_id().alias("vid"), "v", "ids"), "ann-points")
    asked = materialize(rows.filter("asks").select("id", "v").distinct()
                        .join(points.select("vid", "v").hint("merge"), "v").select("id", "vid", "v"), "ann-queries")
    places = materialize(asked.select("vid", "v").distinct()
                         .withColumn("block", F.pmod(F.xxhash64("vid"), F.lit(_blocks(asked)))), "ann-places")

    sample = points.select("v", F.xxhash64("vid").alias("h"))
    sample = sample.filter(hash_below(F.col("h"), SAMPLE, points.count())).orderBy("h").limit(SAMPLE)
    coder = learn(_matrix(sample.select("v").toArrow()["v"].combine_chunks(), dims), k)
    index = _write_index(points, coder, dims)
    found = None
    for block in range(_blocks(asked)):
        queries = _block(places.filter(F.col("block") == block), dims)
        if queries is not None:
            part = _search(index, queries, coder, dims, k + 1)
            found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best = materialize(_answers(asked, found, points, k), "ann-found")

    # queries with fewer than k answers: all rows, in blocks
    total = points.select(F.explode("ids")).limit(k + 1).count() - 1
    short = materialize(
        asked.select("id", "vid", "v").join(
            best.groupBy(F.col("query_id").alias("id")).agg(F.count(F.lit(1)).alias("n")).hint("merge"), "id", "left")
        .filter(F.coalesce("n", F.lit(0)) < min(k, total)).drop("n"), "ann-short")
    if short.isEmpty():
        return best
    n_blocks, rest = _blocks(short), None
    places = short.select("vid", "v").distinct().withColumn("block", F.pmod(F.xxhash64("vid"), F.lit(n_blocks)))
    for block in range(n_blocks):
        queries = _block(places.filter(F.col("block") == block), dims)
        if queries is not None:
            part = _scan(points, queries, dims, k + 1)
            rest = part if rest is None else rest.unionByName(part)
    again = _answers(short.select("id", "vid", "v"), rest, points, k)
    return best.join(short.select(F.col("id").alias("query_id")).distinct().hint("merge"), "query_id", "left_anti").unionByName(again)


def _blocks(queries: DataFrame) -> int:
    return max(1, -(-queries.count() // (QUERY_BLOCK // 2)))


def _block(queries: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids and vectors of one block: about QUERY_BLOCK / 2 rows, as the hash deals them."""
    got = queries.select("vid", "v").toArrow()
    if not got.num_rows:
        return None
    return got["vid"].to_numpy(), _matrix(got["v"].combine_chunks(), dims)


def _write_index(points: DataFrame, coder: Coder, dims: int) -> DataFrame:
    """(part, value, code, vid, v), one row per point and substring, sorted by (part, value)."""
    fields = [("part", pa.int32()), ("value", pa.int32()), ("code", pa.int64()), ("vid", pa.int64()), ("least", pa.int64()),
              ("v", pa.list_(pa.float64()))]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            subs = coder.substrings(_matrix(b.column("v"), dims))
            code = np.ascontiguousarray(subs).view(np.int64)[:, 0]
            for s in range(SUBSTRINGS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(code), s, np.int32)), pa.array(subs[:, s].astype(np.int32)),
                     pa.array(code), b.column("vid"), b.column("least"), b.column("v")], schema=pa.schema(fields))

    entries = _named(points).mapInArrow(encode, "part int, value int, code long, vid long, least long, v array<double>")
    return materialize(entries.repartitionByRange("part", "value", "vid")
                       .sortWithinPartitions("part", "value"), "ann-index")


def _named(points: DataFrame) -> DataFrame:
    """Vectors with their smallest id, which orders vectors at equal distances."""
    return points.select("vid", "v", F.get("ids", F.lit(0)).alias("least"))


class _Best:
    """The ``most`` nearest vectors of each query, ties to the smaller least id, kept while a partition is read."""

    def __init__(self, queries: np.ndarray, most: int):
        self.most = most
        self.score = np.full((len(queries), most), np.inf)
        self.vid = np.full((len(queries), most), -1, dtype=np.int64)
        self.least = np.full((len(queries), most), np.iinfo(np.int64).max)

    def add(self, q: int, vid: np.ndarray, least: np.ndarray, score: np.ndarray) -> None:
        near = score <= self.score[q, -1]
        s = np.concatenate([self.score[q], score[near]])
        low, v = np.concatenate([self.least[q], least[near]]), np.concatenate([self.vid[q], vid[near]])
        keep = np.lexsort((low, s))[:self.most]
        self.score[q], self.least[q], self.vid[q] = s[keep], low[keep], v[keep]

    def rows(self, ids: np.ndarray) -> pa.RecordBatch:
        q, at = np.nonzero(self.vid >= 0)
        return pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(self.vid[q, at]), pa.array(self.score[q, at])],
                                          schema=_FOUND)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - b) ** 2).sum(axis=1))


def _search(index: DataFrame, queries: tuple[np.ndarray, np.ndarray], coder: Coder, dims: int, most: int) -> DataFrame:
    ids, vectors = queries
    subs = coder.substrings(vectors)
    codes = np.ascontiguousarray(subs).view(np.uint64)[:, 0]
    allowed = coder.allowed()

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(ids, most)
        for b in batches:
            part, value = b.column("part").to_numpy(), b.column("value").to_numpy().astype(np.uint16)
            code, vid, v = b.column("code").to_numpy().view(np.uint64), b.column("vid").to_numpy(), _matrix(b.column("v"), dims)
            least = b.column("least").to_numpy()
            starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (value[1:] != value[:-1])])
            sizes = np.diff(np.r_[starts, len(part)])
            for s in np.unique(part):
                of = part[starts] == s
                first, size = starts[of], sizes[of]
                near = np.bitwise_count(subs[:, s][:, None] ^ value[first][None]) <= allowed[s]
                for q in np.flatnonzero(near.any(axis=1)):                  # buckets to read -> rows
                    f, n = first[near[q]], size[near[q]]
                    rows = np.repeat(f - (np.cumsum(n) - n), n) + np.arange(n.sum())
                    rows = rows[np.bitwise_count(code[rows] ^ codes[q]) <= coder.radius]
                    rows = rows[_first_here(code[rows] ^ codes[q], s, allowed)]
                    best.add(q, vid[rows], least[rows], _distances(v[rows], vectors[q]))
        yield best.rows(ids)

    return index.mapInArrow(probe, "qid long, vid long, score double")


def _first_here(differ: np.ndarray, s: int, allowed: list[int]) -> np.ndarray:
    """No earlier substring's index retrieves the code, so it is ranked once."""
    parts = np.ascontiguousarray(differ).view(np.uint16).reshape(-1, SUBSTRINGS)
    before = [np.bitwise_count(parts[:, t]) <= allowed[t] for t in range(s)]
    return ~np.any(before, axis=0) if before else np.ones(len(differ), dtype=bool)


def _scan(points: DataFrame, queries: tuple[np.ndarray, np.ndarray], dims: int, most: int) -> DataFrame:
    """The stated queries against all points."""
    ids, vectors = queries

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(ids, most)
        for b in batches:
            vid, least, v = b.column("vid").to_numpy(), b.column("least").to_numpy(), _matrix(b.column("v"), dims)
            for q in range(len(ids)):
                best.add(q, vid, least, _distances(v, vectors[q]))
        yield best.rows(ids)

    return _named(points).mapInArrow(scan, "qid long, vid long, score double")


def _answers(asked: DataFrame, found: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """The k best ids of each query from the best vectors its place found."""
    top = (found.withColumn("nth", F.dense_rank().over(Window.partitionBy("qid").orderBy("score")))
           .filter(F.col("nth") <= k + 1).drop("nth"))
    named = (top.join(points.select("vid", "ids").hint("merge"), "vid")
             .select("qid", "score", F.explode("ids").alias("vec_id")))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (asked.select(F.col("id").alias("query_id"), F.col("vid").alias("qid")).distinct()
            .join(named.hint("merge"), "qid").filter("vec_id <> query_id")
            .groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
            .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
