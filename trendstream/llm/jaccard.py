"""Jaccard join of word n-gram sets by prefixes under several global orders.

If two sets link, their prefixes (the first n - ceil(share * n) + 1 tokens) have
a token in common under *every* total order of the tokens.  Three orders are
used: rare tokens first with ties by hash, rare tokens first with ties the other
way round, and a second hash alone.  How rare a token is comes from a table of
fixed size that counts the tokens of all documents (``cells``); any order that is
the same for all documents is right, the counts only make it selective.  A pair
is a candidate when it shares a prefix token under the first order at places
that leave room for the overlap it needs; the other two orders are intersected
with that before the sets themselves are compared.

Nothing is emitted for all pairs of a bucket.  Documents with equal sets are one
class.  In each bucket (a token and the classes with it in their prefix) the
member where the token comes earliest, the one with the fewest rare tokens of its
own, is the centre; each class is compared with the centre it shares most
buckets with, so a group of copies of any size costs one comparison a class.
Components follow from these links.  What is left are pairs of different
components, and they come from a join on (token, component, set size) where room
is left for the overlap: no link between different texts is lost.

Documents are read three or four times, so ``docs`` has to give the same rows each time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstream.llm.cells import cell_of, count_cells
from trendstream.llm.common import quoted
from trendstream.llm.components import connected_components
from trendstream.session import discard, materialize

SLICE_BYTES = 4 << 20       # texts that a worker cuts at once, unless one is longer
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (SplitMix64's finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text.

    A-Z are lower-cased; words are runs without ASCII white space; a text with
    fewer than ``words`` words has its whole sequence as one shingle, a null text
    or one without words none.
    """
    from xxhash import xxh64_intdigest
    cut = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    flat = cut.flatten()
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    offsets = cut.offsets.to_numpy().astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(real)])[offsets - offsets[0]]
    coded = flat.dictionary_encode()
    of_word = np.fromiter((xxh64_intdigest(w, 0) for w in coded.dictionary.cast(pa.binary()).to_pylist()),
                          dtype=np.uint64, count=len(coded.dictionary))
    h = of_word[coded.indices.to_numpy(zero_copy_only=False)[real]] if len(of_word) else np.zeros(0, np.uint64)
    factors = [_U(xxh64_intdigest(bytes([j]), 1) | 1) for j in range(words)]
    runs = max(0, len(h) - words + 1)
    shingles = np.zeros(runs, dtype=np.uint64)
    for j, f in enumerate(factors):
        shingles += h[j:j + runs] * f
    shingles = _mix(shingles + _U(words))
    out = []
    for a, b in zip(ends[:-1], ends[1:]):
        if b - a >= words:
            out.append(np.unique(shingles[a:b - words + 1]))
        elif b > a:
            whole = _U(b - a)
            for j in range(b - a):
                whole = whole + h[a + j:a + j + 1] * factors[j]
            out.append(_mix(whole))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about SLICE_BYTES of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, before + SLICE_BYTES, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set: equal sets, and for all that is known only they, agree in both."""
    sizes = np.array([len(s) for s in sets])
    tokens = np.concatenate([*sets, np.zeros(0, np.uint64)])
    starts = np.cumsum(sizes) - sizes
    out = []
    for salt in (_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)):
        total = np.zeros(len(sets), dtype=np.uint64)
        if len(tokens):
            total[sizes > 0] = np.add.reduceat(_mix(tokens ^ salt), starts[sizes > 0])
        out.append(total.view(np.int64))
    return out[0], out[1]


def rarity(counts: np.ndarray) -> np.ndarray:
    """One byte a cell that grows with its count."""
    return np.minimum(255, 8 * np.log2(1.0 + counts)).astype(np.uint8)


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def prefixes(tokens: np.ndarray, rare: np.ndarray, percent: int) -> list[np.ndarray]:
    """Prefixes of a set (sorted by hash) under the three orders."""
    p = prefix_length(len(tokens), percent)
    code = rare[cell_of(tokens)]
    back = tokens[::-1]
    return [tokens[np.argsort(code, kind="stable")[:p]], back[np.argsort(code[::-1], kind="stable")[:p]],
            tokens[np.argsort(_mix(tokens), kind="stable")[:p]]]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate([*arrays, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def need(a: Column, b: Column, percent: int) -> Column:
    """The least overlap of linked sets of sizes a and b."""
    return F.ceil((a + b) * percent / (100 + percent) - F.lit(1e-9))


def _fits(a: Column, b: Column, percent: int) -> Column:
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def _wanted_key(s1: np.ndarray, ids: pa.Array) -> np.ndarray:
    own = pc.fill_null(ids, -2 ** 63).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return _mix(s1.view(np.uint64) ^ _mix(own))


def _verified(texts: DataFrame, classes: DataFrame, pairs: DataFrame, rare, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets link, written.

    The sets of the classes named, and of few others, are made from the texts
    again: a table of fixed size of the classes wanted is broadcast for that.
    """
    spark = texts.sparkSession
    pairs = materialize(pairs, "jaccard-pairs")
    named = pairs.select(F.col("a").alias("uid")).unionByName(pairs.select(F.col("b").alias("uid"))).distinct()
    wanted = materialize(classes.join(named.hint("merge"), "uid", "left_semi"), "jaccard-wanted")

    def keys(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield _wanted_key(b.column("s1").to_numpy(), b.column("id"))

    table = spark.sparkContext.broadcast(count_cells(wanted.select("s1", "id"), keys) > 0)
    out = pa.schema([("id", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("tokens", pa.list_(pa.int64())),
                     ("p1", pa.list_(pa.int64())), ("p2", pa.list_(pa.int64()))])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _slices(batch, "text"):
                own = shingle_sets(b.column("text"), words)
                s1, s2 = _signatures(own)
                pick = np.flatnonzero(table.value[cell_of(_wanted_key(s1, b.column("id")))]
                                      & np.array([len(s) > 0 for s in own]))
                chosen = [own[i] for i in pick]
                order = [prefixes(s, rare.value, percent) for s in chosen]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(pick)), pa.array(s1[pick]), pa.array(s2[pick]), _lists(chosen),
                     _lists([o[1] for o in order]), _lists([o[2] for o in order])], schema=out)

    made = texts.mapInArrow(sets, "id long, s1 long, s2 long, tokens array<long>, p1 array<long>, p2 array<long>")
    known = wanted.select("uid", "s1", "s2", F.col("id").alias("least"))
    # no key of the join, whose partitioning by (s1, s2) then serves the duplicates too
    own_id = F.when(F.col("least").isNull(), F.col("id").isNull()).otherwise(F.col("id") == F.col("least"))
    full = materialize(
        made.join(known.hint("merge"), ["s1", "s2"]).filter(own_id)
        .dropDuplicates(["s1", "s2"]).select("uid", "tokens", "p1", "p2"), "jaccard-sets")
    # the filters of the other orders, intersected
    few = full.select("uid", "p1", "p2")
    left, right = (few.select(*[F.col(c).alias(f"{side}{c}") for c in few.columns]) for side in "ab")
    both = (pairs.join(left.hint("merge"), F.col("a") == F.col("auid")).drop("auid")
            .join(right.hint("merge"), F.col("b") == F.col("buid"))
            .filter(F.arrays_overlap("ap1", "bp1") & F.arrays_overlap("ap2", "bp2")).select("a", "b"))
    both = materialize(both, "jaccard-candidates")
    # the sets themselves
    whole = full.select("uid", "tokens")
    left, right = (whole.select(*[F.col(c).alias(f"{side}{c}") for c in whole.columns]) for side in "ab")
    shared = F.size(F.array_intersect("atokens", "btokens")).cast("long")
    union = F.size("atokens") + F.size("btokens") - shared
    links = materialize(
        both.join(left.hint("merge"), F.col("a") == F.col("auid")).drop("auid")
        .join(right.hint("merge"), F.col("b") == F.col("buid"))
        .filter(100 * shared >= percent * union).select("a", "b"), "jaccard-links")
    discard(full)
    return links


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                     percent: int = 85) -> DataFrame:
    """(id, n_shingles, component_id, uid), one row per row of ``docs``.

    Two rows link when 100 * |intersection| >= percent * |union| of their sets of
    distinct ``words``-word shingles (64-bit hashes of them).  component_id is
    the smallest id reachable over links, the row's own id included.  Rows
    without words (null, empty or white text) have an empty set, link with
    nothing and keep their own id.  Null ids count as larger than all others: a
    component of null ids only has a null component_id.  Repeated rows are rows
    of one class.  Other columns of ``docs`` are not read, whatever their names.
    An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).cast("string").alias("text"))

    def tokens(b: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in _slices(b, "text"):
            yield np.concatenate([*shingle_sets(part.column("text"), words), np.zeros(0, np.uint64)])

    rare = spark.sparkContext.broadcast(rarity(count_cells(texts, tokens)))
    schema = pa.schema([("id", pa.int64()), ("n", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()),
                        ("prefix", pa.list_(pa.int64()))])

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _slices(batch, "text"):
                own = shingle_sets(b.column("text"), words)
                s1, s2 = _signatures(own)
                first = [prefixes(s, rare.value, percent)[0] if len(s) else s for s in own]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array([len(s) for s in own], pa.int32()), pa.array(s1), pa.array(s2),
                     _lists(first)], schema=schema)

    rows = materialize(texts.mapInArrow(summary, "id long, n int, s1 long, s2 long, prefix array<long>")
                       .withColumn("uid", F.monotonically_increasing_id()), "jaccard-rows")
    classes = materialize(rows.filter("n > 0").groupBy("s1", "s2").agg(F.min("uid").alias("uid"), F.min("id").alias("id")),
                          "jaccard-classes")
    posts = (rows.join(classes.select("uid").hint("merge"), "uid", "left_semi")
             .select("uid", "n", F.posexplode("prefix").alias("pos", "token")))
    several = materialize(posts.groupBy("token").count().filter("count > 1").select("token"), "jaccard-tokens")
    posts = materialize(posts.join(several.hint("merge"), "token", "left_semi"), "jaccard-postings")

    # each class with the centre it shares most buckets with
    centre = posts.groupBy("token").agg(F.min(F.struct("pos", "uid", "n")).alias("c"))
    stars = (posts.join(centre.hint("merge"), "token").filter("uid <> c.uid")
             .filter(_fits(F.col("n"), F.col("c.n"), percent)
                     & (F.least(F.col("n") - F.col("pos"), F.col("c.n") - F.col("c.pos"))
                        >= need(F.col("n"), F.col("c.n"), percent)))
             .groupBy("uid", F.col("c.uid").alias("to")).agg(F.count(F.lit(1)).alias("votes"))
             .groupBy("uid").agg(F.max(F.struct("votes", (-F.col("to")).alias("to"))).alias("best"))
             .select(F.col("uid").alias("a"), (-F.col("best.to")).alias("b")))
    links = _verified(texts, classes, stars, rare, words, percent)

    # pairs of different components
    found = connected_components(links)
    placed = materialize(
        posts.join(found.select(F.col("node").alias("uid"), "root").hint("merge"), "uid", "left")
        .withColumn("root", F.coalesce("root", "uid")), "jaccard-placed")
    other = _crossing(placed, percent)
    links = links.unionByName(_verified(texts, classes, other, rare, words, percent))

    found = connected_components(links)
    named = (classes.join(found.select(F.col("node").alias("uid"), "root").hint("merge"), "uid", "left")
             .withColumn("root", F.coalesce("root", "uid")))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    answer = materialize(named.join(least.hint("merge"), "root").select("s1", "s2", "component_id"), "jaccard-components")
    return (rows.select("id", "n", "uid", F.when(F.col("n") > 0, F.col("s1")).alias("s1"), "s2")
            .join(answer.hint("merge"), ["s1", "s2"], "left")
            .select("id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), "uid"))


def _crossing(placed: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) of different components: b is not larger than a and has room for the overlap.

    The smaller set of a pair has its first shared token early enough for a
    partner of its own size.  A class meets groups (component, size) of a bucket
    first, then the members of those that have room.
    """
    small = placed.filter((F.col("n") - F.col("pos")) >= need(F.col("n"), F.col("n"), percent))
    members = small.select("token", "root", F.col("n").alias("m"), F.col("uid").alias("b"),
                           (F.col("n") - F.col("pos")).alias("room"))
    groups = members.groupBy("token", "root", "m").agg(F.max("room").alias("most"))
    left = placed.select("token", F.col("root").alias("own"), F.col("n").alias("size"), F.col("uid").alias("a"),
                         (F.col("n") - F.col("pos")).alias("left"))
    least = need(F.col("size"), F.col("m"), percent)
    met = (left.join(groups.hint("merge"), "token")
           .filter((F.col("own") != F.col("root")) & (F.col("m") <= F.col("size"))
                   & _fits(F.col("m"), F.col("size"), percent)
                   & (F.col("left") >= least) & (F.col("most") >= least)))
    return (met.join(members.hint("merge"), ["token", "root", "m"])
            .filter(F.col("room") >= least).filter((F.col("m") < F.col("size")) | (F.col("b") < F.col("a")))
            .select("a", "b").distinct())
