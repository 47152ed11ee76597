"""Message projections: statuses of a post service -> messages, defaults, shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, MapType, StringType

from trendstream.schemas import MESSAGE, MESSAGE_PRIMITIVE_DEFAULTS

# Source name stamped on projected statuses (fixed value).
STATUS_SOURCE_NAME = "Twitter"


def project_statuses(statuses: DataFrame, source_name: str = STATUS_SOURCE_NAME) -> DataFrame:
    """Status rows -> MESSAGE rows.

    favourites -> numOfLikes, retweets -> numOfShares, created_at -> epoch millis;
    sentiment is carried as 0.0, reactions and topics as NULL.
    """
    return statuses.select(
        F.col("text"),
        F.unix_millis(F.col("created_at").cast("timestamp")).alias("timestamp"),
        F.lit(source_name).alias("source"),
        F.col("retweet_count").try_cast("int").alias("numOfShares"),
        F.col("favorite_count").try_cast("int").alias("numOfLikes"),
        F.col("is_retweet").alias("isShareOrRetweet"),
        F.col("lang"),
        F.col("id").cast("bigint").alias("id"),
        F.lit(None).cast(MapType(StringType(), IntegerType())).alias("reactions"),
        F.lit(None).cast(ArrayType(StringType())).alias("topics"),
        F.lit(0.0).alias("sentiment"))


def apply_defaults(messages: DataFrame, default_now: bool = False) -> DataFrame:
    """Absent primitives become 0 / false; strings, maps and lists stay NULL.

    ``default_now`` stamps the current time on messages without a timestamp.
    """
    cols = []
    for f in MESSAGE.fields:
        c = F.col(f.name) if f.name in messages.columns else F.lit(None).cast(f.dataType)
        if f.name == "timestamp" and default_now:
            c = F.coalesce(c, F.unix_millis(F.current_timestamp()))
        elif f.name in MESSAGE_PRIMITIVE_DEFAULTS:
            c = F.coalesce(c.cast(f.dataType), F.lit(MESSAGE_PRIMITIVE_DEFAULTS[f.name]).cast(f.dataType))
        cols.append(c.cast(f.dataType).alias(f.name))
    return messages.select(*cols)


def drop_shares(paged: DataFrame, id_col: str = "id") -> DataFrame:
    """Keep original posts only; the page cursor is computed over all rows first.

    ``paged`` carries a ``page`` column (see ``paging.rank_pages``); a page holds
    at most page-size rows, so the per-page window is bounded.
    """
    w = Window.partitionBy("page")
    return (paged.withColumn("next_max_id", F.min(id_col).over(w) - 1)
            .where(~F.coalesce(F.col("isShareOrRetweet"), F.lit(False))))
