"""Interaction audit of filters by failing-id relations.

One table of failing ids is stored for each filter (a folder of one written
relation).  What a filter does behind a set of others follows from joins of
these tables alone, and never from the texts: for each filter and each set of
other filters,

* its failing ids left-anti the ids that the set removes are what it removes;
* its failing ids left-semi the ids that the set removes are redundant there.

A prefix of an order matters only as a set, so five filters need 80 (set,
filter) steps for all 120 orders.  All sets are joined at once, on (set, id);
survivors are what a part has less what each step removes.  Labels are joined
to the failing ids once, so that each step also counts what it loses.  Only sums
per (part, set, filter) go on to the orders.

Ids are row numbers, so repeated or null document ids are rows of their own.
"""

from __future__ import annotations

import json
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendstream.llm.common import quoted, text_or_empty
from trendstream.session import fresh_path, materialize

# Limits of the filters (fixed values).
LEAST_WORDS = 100
DISTINCT_PERCENT = 80
CAPITALS_PERCENT = 10
MARKS = "#$%&*|"
WHITE = " \t\n\u000b\f\r"


def _words(text: Column) -> Column:
    """Maximal runs without ASCII white space; none for an empty or white text."""
    bare = F.btrim(text, F.lit(WHITE))
    return F.when(bare != "", F.split(bare, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))


def text_failures(text: Column) -> dict[str, Column]:
    """Filters that look at one text: letter -> condition of failing."""
    words = _words(text)
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": n < LEAST_WORDS,
            "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * n,
            "C": 100 * capitals > CAPITALS_PERCENT * F.length(text),
            "D": F.length(text) != F.length(F.translate(text, MARKS, ""))}


def failing_ids(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                part_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(rows of each part: part, total; failing ids: filter, uid, part, good, toxic), both written.

    The failing ids of a filter are a folder of their own.  ``E`` fails for a
    text that a smaller id has too (equal SHA-256 of the whole text): rows of the
    smallest id stay even if repeated, and a null id counts as larger than
    every other.  Null text counts as empty, a null part as the empty string.  A
row is good or toxic if any label of its id says so; a null id has no labels.
    """
    text = text_or_empty(F.col(quoted(text_col)))
    own = docs.select(F.col(quoted(id_col)).cast("long").alias("id"),
                      F.coalesce(F.col(quoted(part_col)).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    seen = materialize(own.select(
        F.monotonically_increasing_id().alias("uid"), "id", "part", F.sha2(F.col("text").cast("binary"), 256).alias("sha"),
        *[c.alias(f) for f, c in text_failures(F.col("text")).items()]), "audit-rows")
    marked = (labels.groupBy(F.col("doc_id").cast("long").alias("id"))
              .agg(F.max((F.coalesce(F.col("quality"), F.lit(0)) == 1).cast("int")).alias("good"),
                   F.max((F.coalesce(F.col("toxic"), F.lit(0)) == 1).cast("int")).alias("toxic")))
    firsts = (seen.groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
              .filter("n > 1").select("sha", "first"))
    copies = (seen.select("uid", "id", "part", "sha").join(firsts.hint("merge"), "sha")
              .filter("first < id OR (id IS NULL AND first IS NOT NULL)"))
    letters = F.filter(F.array(*[F.when(F.col(f), F.lit(f)) for f in "ABCD"]), lambda f: f.isNotNull())
    failing = (seen.select("uid", "id", "part", F.explode(letters).alias("filter"))
               .unionByName(copies.select("uid", "id", "part", F.lit("E").alias("filter"))))
    path = materialize_by(
        failing.join(marked.hint("merge"), "id", "left")
        .select("filter", "uid", "part", F.coalesce("good", F.lit(0)).alias("good"),
                F.coalesce("toxic", F.lit(0)).alias("toxic")), "filter", "audit-failing")
    return seen.groupBy("part").agg(F.count(F.lit(1)).alias("total")), path


def materialize_by(df: DataFrame, key: str, kind: str) -> DataFrame:
    """``df`` written to the shared folder with one folder a value of ``key``."""
    path = fresh_path(df.sparkSession, kind)
    df.write.partitionBy(key).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _mask(filters: str, names) -> int:
    return sum(1 << filters.index(f) for f in names)


def set_steps(failing: DataFrame, filters: str) -> DataFrame:
    """(part, done, filter, removed, redundant, good_lost, toxic_lost) for each set ``done`` of other filters (a bit mask)."""
    everything = range(1 << len(filters))
    bit = F.lit(0)
    for f in filters:
        bit = F.when(F.col("filter") == f, F.lit(_mask(filters, f))).otherwise(bit)
    sets = F.array(*[F.lit(s) for s in everything])
    fails = failing.withColumn("bit", bit)
    # ids that each set removes
    gone = (fails.select("uid", F.explode(F.filter(sets, lambda s: s.bitwiseAND(F.col("bit")) != 0)).alias("done"))
            .distinct())
    steps = fails.select("uid", "part", "filter", "good", "toxic",
                         F.explode(F.filter(sets, lambda s: s.bitwiseAND(F.col("bit")) == 0)).alias("done"))
    keys = ["part", "done", "filter"]
    removed = (steps.join(gone.hint("merge"), ["uid", "done"], "left_anti").groupBy(*keys)
               .agg(F.count(F.lit(1)).alias("removed"), F.lit(0).cast("long").alias("redundant"),
                    F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost")))
    redundant = (steps.join(gone.hint("merge"), ["uid", "done"], "left_semi").groupBy(*keys)
                 .agg(F.lit(0).cast("long").alias("removed"), F.count(F.lit(1)).alias("redundant"),
                      F.lit(0).cast("long").alias("good_lost"), F.lit(0).cast("long").alias("toxic_lost")))
    sums = ["removed", "redundant", "good_lost", "toxic_lost"]
    return removed.unionByName(redundant).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step of it: part, filter_order, step, filter, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    Counts are of the rows of a part (see ``failing_ids`` for nulls and repeats),
    zeros included.  shapley is what the step's filter removes, summed over all
    orders.  An empty table gives an empty result; without labels nothing is lost.
    """
    filters = "ABCDE"
    totals, failing = failing_ids(docs, labels, id_col, text_col, part_col)
    counts = materialize(set_steps(failing, filters), "audit-steps")
    places = [("".join(order), i + 1, order[i], _mask(filters, order[:i]), _mask(filters, set(filters) - {order[i]}))
              for order in permutations(filters) for i in range(len(filters))]
    schema = T.ArrayType(T.StructType([T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType()),
                                       T.StructField("filter", T.StringType()), T.StructField("done", T.IntegerType()),
                                       T.StructField("others", T.IntegerType())]))
    every = totals.select("part", "total", F.explode(F.from_json(F.lit(_text(places)), schema)).alias("p")).select(
        "part", "total", "p.*")
    alone = counts.select("part", "filter", F.col("done").alias("others"), F.col("removed").alias("unique_fails"))
    found = (every.join(counts, ["part", "done", "filter"], "left").join(alone, ["part", "others", "filter"], "left")
             .fillna(0, ["removed", "redundant", "good_lost", "toxic_lost", "unique_fails"]))
    so_far = Window.partitionBy("part", "filter_order").orderBy("step")
    all_orders = Window.partitionBy("part", "filter")
    return found.select("part", "filter_order", "step", "filter",
                        (F.col("total") - F.sum("removed").over(so_far)).alias("kept"), "removed", "redundant",
                        "unique_fails", "good_lost", "toxic_lost", F.sum("removed").over(all_orders).alias("shapley"))


def _text(places: list[tuple]) -> str:
    return json.dumps([dict(zip(("filter_order", "step", "filter", "done", "others"), p)) for p in places])
