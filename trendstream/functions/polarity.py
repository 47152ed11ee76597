"""Sentiment by learned polarity: seed words spread over the words they occur with.

A few words that surely praise or blame are given.  Learning counts, for each
bucket of words (CRC-32 modulo ``BUCKETS``), the texts that hold it, those with a
praising seed among them and those with a blaming one: one aggregate, bounded
whatever the corpus.  A bucket's weight is the difference of its pointwise mutual
information with praise and with blame, in thousandths; buckets of few texts, or
near to what chance would give, weigh nothing.  A text's sentiment is the sum of
its distinct words' weights over the sum of their sizes, from -1 to 1, by look-ups
in a constant array: a column expression for batch and streams.

Seeds are words of one language: learn from texts of that language, or the words
of the language in which the seeds are most frequent take their polarity.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstream.functions.langmodel import crc_sql, crc_table_sql
from trendstream.operators.longterm import NEGATIVE_WORDS, POSITIVE_WORDS

BUCKETS = 1 << 16
SCALE = 1000
PRIOR = 1.0              # texts added to each count as chance would deal them
MIN_TEXTS = 10           # a bucket weighs something from so many texts
Z = 5.0                  # and from so many standard deviations off chance (few of all buckets by chance), with praise or with blame


def words(text: Column) -> Column:
    """Distinct words of the whole text: runs of letters, lower-cased."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+)"), 1))


def buckets(found: Column) -> Column:
    """The buckets of a text's words, one for each word."""
    return F.transform(found, lambda w: (F.crc32(w.cast("binary")) % BUCKETS).cast("int"))


@dataclass
class PolarityModel:
    """weights: one integer a bucket, positive for praise."""

    weights: list[int]

    @classmethod
    def learn(cls, texts: DataFrame, text: str = "text", praise: list[str] = POSITIVE_WORDS,
              blame: list[str] = NEGATIVE_WORDS) -> PolarityModel:
        """From rows with a text; rows without one are not counted.

        A side of which no seed occurs says nothing; with neither, all weights are 0.
        """
        found = texts.where(F.col(text).isNotNull()).select(words(F.col(text)).alias("w"))
        marked = found.select(F.array_distinct(buckets(F.col("w"))).alias("b"),
                              *[F.arrays_overlap("w", F.array(*[F.lit(x) for x in seeds])).cast("long").alias(name)
                                for name, seeds in (("p", praise), ("n", blame))])
        # the totals go with the buckets, under a bucket of their own
        counts = (marked.select(F.explode(F.concat(F.array(F.lit(-1)), "b")).alias("bucket"), "p", "n")
                  .groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.sum("p").alias("p"), F.sum("n").alias("n")))
        return cls.of(counts)

    @classmethod
    def of(cls, counts: DataFrame) -> PolarityModel:
        """The model of (bucket, c, p, n) rows, at most BUCKETS and one of bucket -1 with the totals."""
        total = counts.where("bucket = -1").first()
        weights = [0] * BUCKETS
        if total is not None:
            known = counts.where(f"bucket >= 0 AND c >= {MIN_TEXTS}")
            c = F.col("c")
            logs, clear = [], F.lit(False)
            for side in ("p", "n"):
                if 0 < total[side] < total["c"]:
                    share = F.lit(total[side]) / F.lit(total["c"])
                    expected = c * share
                    logs.append(F.log((F.col(side) + PRIOR * share) / ((c + PRIOR) * share)))
                    clear = clear | (F.abs(F.col(side) - expected) >= Z * F.sqrt(expected * (1 - share)))
                else:
                    logs.append(F.lit(0.0))
            weight = F.round(SCALE * (logs[0] - logs[1])).cast("bigint")
            for r in known.where(clear).select("bucket", weight.alias("w")).collect():      # at most BUCKETS rows
                weights[r["bucket"]] = r["w"]
        return cls(weights)

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.weights,)], "weights array<bigint>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> PolarityModel:
        return cls(list(spark.read.parquet(path).first()["weights"]))


def with_sentiment(df: DataFrame, model: PolarityModel, text: str = "text", out: str = "sentiment") -> DataFrame:
    """``df`` plus its sentiment, rounded to six digits; 0 for a text of no word that weighs (null and empty too)."""
    table = F.from_json(F.lit(str(model.weights)), "array<int>")          # one constant, folded by the optimiser
    weighed = df.withColumn("_weights", F.transform(buckets(words(F.col(text))), lambda b: F.get(table, b)))
    sums = [F.aggregate("_weights", F.lit(0).cast("bigint"), step) for step in
            (lambda a, w: a + w, lambda a, w: a + F.abs(w))]
    return (weighed.withColumns({"_sum": sums[0], "_size": sums[1]})
            .withColumn(out, F.round(F.when(F.col("_size") > 0, F.col("_sum") / F.col("_size")).otherwise(F.lit(0.0)), 6))
            .drop("_weights", "_sum", "_size"))


def sentiment_sql(praise: list[str], blame: list[str], learn: str = "true") -> str:
    """The same in DuckDB SQL: (doc_id, sentiment) of the rows of ``documents``, learned from those that ``learn`` holds for."""
    def side(name: str) -> tuple[str, str]:
        share = f"(t{name} / t)"
        told = f"(t{name} > 0 AND t{name} < t)"
        return (f"CASE WHEN {told} THEN ln(({name} + {PRIOR} * {share}) / ((c + {PRIOR}) * {share})) ELSE 0 END",
                f"({told} AND abs({name} - c * {share}) >= {Z} * sqrt(c * {share} * (1 - {share})))")
    (praised, clear_p), (blamed, clear_n) = side("p"), side("n")
    return f"""
    WITH tabs AS (SELECT {crc_table_sql()}),
         d AS (SELECT row_number() OVER () AS r, doc_id, text, text IS NOT NULL AND coalesce({learn}, false) AS learn FROM documents),
         w AS (SELECT r, unnest(list_distinct(regexp_extract_all(lower(text), '\\p{{L}}+'))) AS word FROM d WHERE text IS NOT NULL),
         h AS (SELECT word, CAST({crc_sql('word')} % {BUCKETS} AS INT) AS bucket FROM (SELECT DISTINCT word FROM w), tabs),
         s AS (SELECT r, max(CASE WHEN word IN ({', '.join(map(repr, praise))}) THEN 1 ELSE 0 END) AS p,
                      max(CASE WHEN word IN ({', '.join(map(repr, blame))}) THEN 1 ELSE 0 END) AS n FROM w JOIN d USING (r) WHERE learn GROUP BY r),
         t AS (SELECT CAST((SELECT count(*) FROM d WHERE learn) AS DOUBLE) AS t, sum(p) AS tp, sum(n) AS tn FROM s),
         c AS (SELECT bucket, count(*) AS c, sum(p) AS p, sum(n) AS n
               FROM (SELECT DISTINCT r, bucket FROM w JOIN h USING (word)) JOIN s USING (r) GROUP BY bucket),
         m AS (SELECT bucket, CAST(round({SCALE} * ({praised} - {blamed})) AS BIGINT) AS weight
               FROM c, t WHERE c >= {MIN_TEXTS} AND ({clear_p} OR {clear_n})),
         x AS (SELECT r, CAST(sum(weight) AS DOUBLE) AS a, CAST(sum(abs(weight)) AS DOUBLE) AS b
               FROM w JOIN h USING (word) JOIN m USING (bucket) GROUP BY r)
    SELECT doc_id, round(CASE WHEN b > 0 THEN a / b ELSE 0.0 END, 6) AS sentiment FROM d LEFT JOIN x USING (r)"""
