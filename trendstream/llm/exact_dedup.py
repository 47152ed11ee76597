"""Exact de-duplication by distributed MSD radix partitioning.

A document's sort key is its length (most significant digit) followed by the
bytes of its normalised text.  Each round groups the documents that are still
together by the next run of bytes; runs grow eightfold, so a text of any length
is through after a few rounds.  A group leaves when it holds one document or
when its texts have ended: what is left together then is equal byte for byte,
and no digest is compared anywhere.

At scale: only counts per (group, bytes) are aggregated, combined on the map
side, so a group with a third of all rows sends one row per task.  Labels come
back by a join whose two sides are plain exchanges, which AQE can split when
one group is hot.  The corpus is shuffled once; later rounds move just the bytes
not yet compared of documents that still have company.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstream.llm.common import one_space, quoted, unpack
from trendstream.session import materialize

FIRST_BYTES = 64
GROWTH = 8


def _rank(id_value: Column, uid: Column) -> Column:
    """Order of staying: smallest id, nulls last; repeated rows by their row number."""
    return F.struct(id_value.isNull().alias("none"), id_value.alias("id"), uid.alias("uid"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     first: int = FIRST_BYTES, growth: int = GROWTH) -> DataFrame:
    """All rows and columns of ``docs`` plus keep_id, group_size and kept.

    Texts are equal when they are identical after each run of ASCII white space
    became one space.  keep_id is the smallest id of the row's group, group_size
    counts its rows and kept marks the one row that stays.

    Null text counts as empty, so all null and empty texts are one group.  A null
    id ranks after every other id (keep_id is null only if all ids of the group
    are).  Of rows repeated with the same id and text exactly one is kept.  An
    empty table gives an empty result.  Columns of ``docs`` that are named like
    an added column are replaced by it.
    """
    return unpack(_marked(docs, id_col, text_col, first, growth), "row",
                  ["keep_id", "group_size", "kept"])


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          first: int = FIRST_BYTES, growth: int = GROWTH) -> DataFrame:
    """``docs`` with the row that stays of each group of equal texts; same columns."""
    return _marked(docs, id_col, text_col, first, growth).filter("kept").select("row.*")


def _marked(docs: DataFrame, id_col: str, text_col: str, first: int, growth: int) -> DataFrame:
    """(row, keep_id, group_size, kept) for each row."""
    text = one_space(F.col(quoted(text_col)))
    keyed = docs.select(
        F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"),
        F.octet_length(text).cast("long").alias("n"),
        F.substring(text.cast("binary"), 1, first).alias("part"))

    shared = materialize(
        keyed.groupBy("n", "part").count().filter("count > 1")
        .select("n", "part", F.monotonically_increasing_id().alias("gid")), "radix-keys")
    body = one_space(F.col("row")[text_col]).cast("binary")
    rows = materialize(
        keyed.join(shared.hint("shuffle_hash"), ["n", "part"], "left")
        .select("row", "gid", F.monotonically_increasing_id().alias("uid"),
                F.when(F.col("gid").isNotNull(),
                       F.substring(body, first + 1, 2 ** 31 - 1)).alias("rest")), "radix-rows")

    own_id = F.col("row")[id_col].cast("long")
    alone = rows.filter("gid IS NULL").select(
        "row", own_id.alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"))
    labels = _split(rows.filter("gid IS NOT NULL")
                    .select("uid", own_id.alias("id"), "gid", "rest"), first * growth, growth)
    together = (rows.filter("gid IS NOT NULL").select("row", "uid")
                .join(labels.hint("merge"), "uid").select("row", "keep_id", "group_size", "kept"))
    return alone.unionByName(together)


def _split(active: DataFrame, size: int, growth: int) -> DataFrame:
    """(uid, keep_id, group_size, kept) of rows (uid, id, gid, rest).

    Rows of one gid agree in length and in all bytes before ``rest``, so the
    texts of a group end together.
    """
    done = None
    while True:
        parts = active.withColumn("part", F.substring("rest", 1, size))
        groups = materialize(
            parts.groupBy("gid", "part")
            .agg(F.count(F.lit(1)).alias("group_size"),
                 F.min(_rank(F.col("id"), F.col("uid"))).alias("stays"),
                 F.max(F.octet_length("rest")).alias("left"))
            .select(F.col("gid").alias("old"), "part", "group_size", "stays",
                    ((F.col("group_size") == 1) | (F.col("left") <= size)).alias("over"),
                    F.monotonically_increasing_id().alias("gid")), "radix-groups")
        step = materialize(
            parts.withColumnRenamed("gid", "old").join(groups.hint("merge"), ["old", "part"])
            .select("uid", "id", "gid", "over", F.col("stays.id").alias("keep_id"), "group_size",
                    (F.col("stays.uid") == F.col("uid")).alias("kept"),
                    F.when(~F.col("over"), F.substring("rest", size + 1, 2 ** 31 - 1)).alias("rest")),
            "radix-step")
        over = step.filter("over").select("uid", "keep_id", "group_size", "kept")
        done = over if done is None else done.unionByName(over)
        active = step.filter("NOT over").select("uid", "id", "gid", "rest")
        if active.isEmpty():
            return done
        size *= growth
