"""Trends beyond the alert job: recent top topics, weekly / monthly leaders,
anomalies against a topic's own history, sentiment and new-alert rows."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Defaults (fixed values): "recent" means the last 15 minutes of data.
RECENT_MINUTES = 15
TOP_K = 10
ANOMALY_HISTORY = 10
# Sub-groups per period for the first ranking pass of top-k.
RANK_SALTS = 32


def recent_trends(rows: DataFrame, minutes: int = RECENT_MINUTES, k: int = TOP_K,
                  ts: str = "ts", topic: str = "topic", times: DataFrame | None = None) -> DataFrame:
    """Top-k topics of the last ``minutes`` before the newest row (ties by topic).

    ``times`` has the same times in ``ts`` where they are cheaper to read than ``rows``.
    """
    since = (rows if times is None else times).agg(F.max(ts)).scalar() - F.lit(_dt.timedelta(minutes=minutes))
    return (rows.where(F.col(ts) > since).groupBy(F.col(topic).alias("topic"))
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("topic")).limit(k))


def top_k_per_group(df: DataFrame, group: str, order: list[Column], k: int,
                    tie_key: str, salts: int = RANK_SALTS) -> DataFrame:
    """Exact top-k per group without putting a whole group into one task.

    Pass 1 ranks inside (group, hash(tie_key) % salts) sub-groups and keeps k
    rows of each; pass 2 ranks the at most salts*k survivors of each group.
    """
    sub = F.pmod(F.xxhash64(F.col(tie_key)), F.lit(salts))
    w1 = Window.partitionBy(F.col(group), sub).orderBy(*order)
    w2 = Window.partitionBy(group).orderBy(*order)
    return (df.withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k)
            .withColumn("rank", F.row_number().over(w2).cast("bigint")).where(F.col("rank") <= k)
            .drop("_r"))


def period_top_topics(rows: DataFrame, unit: str = "week", k: int = TOP_K,
                      ts: str = "ts", topic: str = "topic", ignore_case: bool = False) -> DataFrame:
    """Leading topics per calendar week (Monday) or month: period, topic, count, rank.

    ``ignore_case`` groups topics by their lower-case text, as a
    case-insensitive SQL collation of the history table would.
    """
    period = F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz")
    t = F.lower(F.col(topic)) if ignore_case else F.col(topic)
    counts = rows.groupBy(period.alias("period"), t.alias("topic")) \
        .agg(F.count(F.lit(1)).alias("count"))
    return top_k_per_group(counts, "period", [F.col("count").desc(), F.col("topic")], k, "topic")


# Time chunk of the per-topic ordered windows (anomaly, new alerts).
CHUNK = "day"
# Rows that a task sorts for them (fixed value): more rows are more tasks, not larger ones.
ROWS_A_TASK = 500_000


def with_halo(df: DataFrame, key: str, order: str, history: int, chunk_unit: str = CHUNK) -> DataFrame:
    """Rows of ``df`` split into (key, time chunk) groups, each preceded by a
    halo: the ``history`` rows of the same key that come right before the chunk.

    A window over ``partitionBy(key, "_chunk")`` with at most ``history``
    preceding rows then gives exactly the result of ``partitionBy(key)``,
    while no group is larger than one chunk plus its halo; a key that holds
    a large share of all rows is spread over its chunks.  The halo comes from
    the last ``history`` rows of each earlier chunk: since every chunk present
    has at least one row, the previous ``history`` chunks of the key contain
    them all (a window over chunk summaries, one row per key and chunk).

    Every sort here is dealt to as many tasks as the rows ask for: left to
    themselves adaptive shuffles join partitions up to the parallelism of the
    cluster, and a task's sort would grow with the input.
    """
    from trendstream.session import default_parallelism, materialize
    cols = df.columns
    # the input (already aggregated) feeds both the rows and the tails: write it
    # once to the shared folder instead of recomputing it from the source
    rows = materialize(df.withColumn("_chunk", F.date_trunc(chunk_unit, F.col(order))), "halo-input")
    tasks = max(default_parallelism(df.sparkSession), -(-rows.count() // ROWS_A_TASK))
    # last `history` rows of each (key, chunk): one hash aggregate over a chunk-bounded group
    rest = [c for c in cols if c not in (key, order)]
    chunk_rows = F.sort_array(F.collect_list(F.struct(order, *rest)), asc=False)
    tails = (rows.repartition(tasks, key, "_chunk").groupBy(key, "_chunk")
             .agg(F.reverse(F.slice(chunk_rows, 1, history)).alias("_tail"))
             .repartition(tasks, key))
    prev = Window.partitionBy(key).orderBy("_chunk").rowsBetween(-history, -1)
    before = F.flatten(F.collect_list("_tail").over(prev))
    halos = (tails.select(key, "_chunk", before.alias("_prev"))
             .select(key, "_chunk", F.explode(F.slice("_prev", F.greatest(F.size("_prev") - history + 1,
                                                                          F.lit(1)), history)).alias("_h"))
             .select(key, "_chunk", "_h.*", F.lit(True).alias("_halo")))
    return rows.withColumn("_halo", F.lit(False)).unionByName(halos).repartition(tasks, key, "_chunk")


def topic_anomaly(counts: DataFrame, history: int = ANOMALY_HISTORY, chunk_unit: str = CHUNK) -> DataFrame:
    """z-score of each window count against the topic's previous ``history`` windows."""
    framed = with_halo(counts.select("windowStart", "topic", "count"), "topic", "windowStart", history,
                       chunk_unit)
    w = Window.partitionBy("topic", "_chunk").orderBy("windowStart").rowsBetween(-history, -1)
    avg, sd = F.avg("count").over(w), F.stddev_samp("count").over(w)
    return (framed.select(
        "windowStart", "topic", "count", "_halo",
        F.round(avg, 6).alias("baseline_avg"), F.round(sd, 6).alias("baseline_std"),
        F.round(F.when(sd > 0, (F.col("count") - avg) / sd), 6).alias("z"))
        .where(~F.col("_halo")).drop("_halo"))


def new_alerts(alerts: DataFrame, quiet: str | None = None, chunk_unit: str = CHUNK) -> DataFrame:
    """Alerts that start a new episode: the topic's previous alert window ends
    at or before this window's start (plus an optional quiet gap)."""
    framed = with_halo(alerts.select("windowStart", "windowEnd", "topic", "count"),
                       "topic", "windowStart", 1, chunk_unit)
    w = Window.partitionBy("topic", "_chunk").orderBy("windowStart")
    gap = F.lit(_dt.timedelta(0)) if quiet is None else F.expr(f"INTERVAL {quiet}")
    return (framed.withColumn("_prev_end", F.lag("windowEnd").over(w))
            .where(~F.col("_halo"))
            .where(F.col("_prev_end").isNull() | (F.col("windowStart") >= F.col("_prev_end") + gap))
            .select("windowStart", "windowEnd", "topic", "count"))


# Sentiment lexicon (fixed values).
POSITIVE_WORDS = ["good", "great", "love", "excellent", "happy", "wonderful", "best", "nice",
                  "enjoy", "amazing"]
NEGATIVE_WORDS = ["bad", "terrible", "hate", "awful", "sad", "worst", "poor", "horrible",
                  "angry", "ugly"]


def _hits(text: Column, words: list[str]) -> Column:
    return F.regexp_count(F.lower(text), F.lit("(?<!\\p{L})(?:" + "|".join(words) + ")(?!\\p{L})"))


def sentiment(text="text") -> Column:
    """(positive - negative) / (positive + negative) over lexicon hits, 0 without hits."""
    c = F.col(text) if isinstance(text, str) else text
    p, n = _hits(c, POSITIVE_WORDS), _hits(c, NEGATIVE_WORDS)
    return F.round(F.when(p + n > 0, (p - n) / (p + n)).otherwise(F.lit(0.0)), 6)


def sentiment_sql(text: str = "text") -> str:
    tok = f"regexp_split_to_array(lower({text}), '[^\\p{{L}}]+')"
    p = f"len(list_filter({tok}, lambda x: list_contains({POSITIVE_WORDS!r}, x)))"
    n = f"len(list_filter({tok}, lambda x: list_contains({NEGATIVE_WORDS!r}, x)))"
    return f"round(CASE WHEN coalesce({p} + {n}, 0) > 0 THEN ({p} - {n}) / ({p} + {n}) ELSE 0.0 END, 6)"
