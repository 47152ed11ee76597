"""Search, newest-first pages and keyset cursors over a posts DataFrame.

The page protocol of a post search walks back by id: a page holds the
``count`` newest matches with ``id <= max_id`` and the next request uses
``min(id) - 1`` of the page.  ``rank_pages`` produces every page at once
without funnelling rows through one task: the matches are range-partitioned
and sorted by id, each row gets its position inside its partition, and a
per-partition count table (one row per partition) gives the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Identity of the running minimum over an empty page (fixed value).
EMPTY_PAGE_MIN_ID = 9223372036854775807
# Page sizes of the original ingest loop and data-set capture (fixed values).
PAGE_SIZE = 100
CAPTURE_SIZE = 2000

# Groups of splits in the first level of a top-k.
TOP_GROUPS = 64

_LOW33 = (1 << 33) - 1


def matches(posts: DataFrame, query: str | None = None, lang: str | None = None,
            max_id: int | None = None, text: str = "text", id_col: str = "id") -> DataFrame:
    """Posts whose text contains ``query`` (case-insensitive), in ``lang``, with id <= max_id."""
    cond = F.lit(True)
    if query:
        cond = cond & F.contains(F.lower(F.col(text)), F.lower(F.lit(query)))
    if lang:
        cond = cond & (F.col("lang") == F.lit(lang))
    if max_id is not None and max_id >= 0:
        cond = cond & (F.col(id_col) <= F.lit(max_id))
    return posts.where(cond)


def search(posts: DataFrame, query: str | None = None, lang: str | None = None,
           count: int = PAGE_SIZE, max_id: int | None = None, id_col: str = "id") -> DataFrame:
    """One page: the ``count`` newest matches.

    The top-k runs on ids alone, in two levels (a bounded number of groups of
    splits first, so the last task reads ``TOP_GROUPS * count`` ids however many
    splits there are); texts are fetched by the page's lowest id afterwards and
    only the page's rows are ordered.
    """
    found = matches(posts, query, lang, max_id, id_col=id_col)
    group = Window.partitionBy("_g").orderBy(F.col(id_col).desc())
    ids = (found.select(id_col, (F.spark_partition_id() % TOP_GROUPS).alias("_g"))
           .withColumn("_n", F.row_number().over(group)).where(F.col("_n") <= count)
           .select(id_col).orderBy(F.col(id_col).desc()).limit(count))
    lowest = ids.agg(F.min(id_col)).scalar()
    # ids first: older rows are skipped by the scan or at the first comparison, so a text is matched again
    # only where it may be on the page
    newest = posts.where(F.col(id_col) >= lowest)
    return matches(newest, query, lang, max_id, id_col=id_col).orderBy(F.col(id_col).desc()).limit(count)


def page_min_id(page: DataFrame, id_col: str = "id") -> Column:
    """Aggregate: lowest id of a page, Long.MaxValue for an empty page."""
    return F.coalesce(F.min(id_col), F.lit(EMPTY_PAGE_MIN_ID).cast("bigint"))


def next_cursor(page: DataFrame, id_col: str = "id") -> int | None:
    """``min(id) - 1`` of a page, or None when the page is empty (no more pages)."""
    v = page.agg(F.min(id_col).alias("m")).first()["m"]
    return None if v is None else v - 1


def search_page(posts: DataFrame, query: str | None = None, lang: str | None = None,
                count: int = PAGE_SIZE, max_id: int | None = None):
    """Interactive form: (page DataFrame, next max_id or None)."""
    page = search(posts, query, lang, count, max_id)
    return page, next_cursor(page)


def rank_desc(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Adds ``rank`` (1 = highest id) with a distributed sort.

    The sorted rows with their positions are written once to the shared
    folder, so the offsets and the rows come from the same partitioning; the
    offset table has one row per partition.
    """
    from trendstream.session import materialize
    # the tiebreaker lets the range partitioner split many rows with one id
    df = materialize(df, "matches")      # the range sort reads its input twice
    ordered = (df.withColumn("_tie", F.monotonically_increasing_id())
               .orderBy(F.col(id_col).desc(), F.col("_tie")))
    pos = materialize(ordered.withColumns({"_part": F.spark_partition_id(),
                                           "_mono": F.monotonically_increasing_id()}), "ranked")
    offsets = (pos.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(
                   Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_off")))
    return (pos.join(F.broadcast(offsets), "_part")
            .withColumn("rank", F.col("_off") + F.col("_mono").bitwiseAND(F.lit(_LOW33)) + 1)
            .drop("_part", "_mono", "_off", "_tie"))


def rank_pages(posts: DataFrame, query: str | None = None, lang: str | None = None,
               count: int = PAGE_SIZE, id_col: str = "id", columns: list[str] | None = None) -> DataFrame:
    """Every page of a search at once: adds rank and page (1-based).

    ``columns`` limits what is carried (and written once) with the ranked rows.
    """
    found = matches(posts, query, lang, id_col=id_col)
    if columns is not None:
        found = found.select(*dict.fromkeys([id_col, *columns]))
    ranked = rank_desc(found, id_col)
    return ranked.withColumn("page", F.ceil(F.col("rank") / F.lit(count)).cast("bigint"))


def page_cursors(paged: DataFrame, id_col: str = "id") -> DataFrame:
    """Per page: rows, lowest id and the cursor of the next request."""
    return (paged.groupBy("page")
            .agg(F.count(F.lit(1)).alias("n"), page_min_id(paged, id_col).alias("min_id"))
            .withColumn("next_max_id", F.col("min_id") - 1))
