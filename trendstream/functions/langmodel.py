"""Language of a text by character trigrams: log-odds learned from labelled texts.

Learning counts, for each language, the texts' distinct trigrams by bucket (CRC-32
of the trigram modulo ``BUCKETS``): one aggregate whose result, a number for each
language and bucket, is bounded whatever the corpus.  A text's score in a
language is the sum of the integer log-probabilities of its distinct trigrams,
looked up in a constant array, so scoring is a column expression that works in
batch and in streams.  The model is a small table that can be saved and shared.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstream.functions.lang import DEFAULT_LANGUAGE

BUCKETS = 4096
SCALE = 1000             # log-probabilities are kept as thousandths, so that sums are exact


def buckets(text: Column) -> Column:
    """Buckets (from 0) of the distinct trigrams of the lower-cased whole text, one for each trigram."""
    found = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("(?s)(?=(.{3}))"), 1))
    return F.transform(found, lambda t: (F.crc32(t.cast("binary")) % BUCKETS).cast("int"))


@dataclass
class LanguageModel:
    """weights: language -> one integer a bucket; languages in the order in which ties are broken."""

    weights: dict[str, list[int]]

    @classmethod
    def learn(cls, labelled: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
        """From rows with a text and a language; every language that occurs is learned."""
        rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull())
        counts = (rows.select(F.col(lang).alias("lang"), F.explode(buckets(F.col(text))).alias("bucket"))
                  .groupBy("lang", "bucket").agg(F.count(F.lit(1)).alias("n")))
        return cls.of(counts)

    @classmethod
    def of(cls, counts: DataFrame) -> LanguageModel:
        """The model of (lang, bucket, n) rows, at most BUCKETS for each language."""
        total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
        log = lambda n: F.round(SCALE * F.log(n / (F.col("total") + BUCKETS))).cast("bigint")
        found = (counts.join(total, "lang").groupBy("lang")
                 .agg(F.map_from_entries(F.collect_list(F.struct("bucket", log(F.col("n") + 1)))).alias("seen"),
                      F.first(log(F.lit(1))).alias("unseen")))
        return cls({r["lang"]: [r["seen"].get(b, r["unseen"]) for b in range(BUCKETS)] for r in found.orderBy("lang").collect()})

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(k, w) for k, w in self.weights.items()], "lang string, weights array<bigint>") \
            .coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LanguageModel:
        return cls({r["lang"]: list(r["weights"]) for r in spark.read.parquet(path).orderBy("lang").collect()})

    def scores(self, found: Column) -> dict[str, Column]:
        """language -> sum of its weights over buckets ``found``."""
        def one(weights: list[int]) -> Column:
            table = F.from_json(F.lit(str(weights)), "array<int>")       # one constant, folded by the optimiser
            return F.aggregate(found, F.lit(0).cast("bigint"), lambda a, b: a + F.get(table, b))
        return {lang: one(w) for lang, w in self.weights.items()}


def with_language(df: DataFrame, model: LanguageModel, text: str = "text", out: str = "language") -> DataFrame:
    """``df`` plus the most likely language; ties go to the first language by name.

    A text without a trigram (null, or of fewer than three characters) has the
    default language.
    """
    counted = df.withColumn("_buckets", buckets(F.col(text)))
    names = {lang: f"_score_{i}" for i, lang in enumerate(model.weights)}
    scored = counted.withColumns({names[lang]: c for lang, c in model.scores(F.col("_buckets")).items()})
    answer = F.when(F.coalesce(F.size("_buckets"), F.lit(0)) <= 0, F.lit(DEFAULT_LANGUAGE))
    if len(names) > 1:
        best = F.greatest(*[F.col(c) for c in names.values()])
        for lang, c in names.items():
            answer = answer.when(F.col(c) == best, F.lit(lang))
    else:
        answer = answer.otherwise(F.lit(next(iter(names), DEFAULT_LANGUAGE)))
    return scored.withColumn(out, answer).drop("_buckets", *names.values())


def crc_table_sql() -> str:
    """SQL of the 256 numbers that ``crc_sql`` looks up, as a list ``tab``."""
    step = "list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384))"
    return f"list_transform(range(256), lambda i: {step}) AS tab"


def crc_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes in DuckDB SQL, beside the list ``tab``."""
    b = f"encode({text})"
    octets = f"list_transform(range(CAST(octet_length({b}) AS BIGINT)), lambda i: CAST(('0x' || hex({b})[2 * i + 1:2 * i + 2]) AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)))"


def detect_sql(learn: str, ask: str) -> str:
    """The same in DuckDB SQL: (doc_id, lang, language) of the rows of ``documents`` that ``ask`` holds for,
    learned from those that ``learn`` holds for ({crc} in either stands for the id's CRC-32)."""
    ids = crc_sql("CAST(doc_id AS VARCHAR)")
    return f"""
    WITH tabs AS (SELECT {crc_table_sql()}),
         d AS (SELECT doc_id, lang, lower(text) AS low, {ids} AS id_crc FROM documents, tabs),
         g AS (SELECT DISTINCT doc_id, lang, id_crc, unnest(list_transform(range(1, length(low) - 1), lambda i: substr(low, i, 3))) AS t FROM d),
         h AS (SELECT t, CAST({crc_sql('t')} % {BUCKETS} AS INT) AS bucket FROM (SELECT DISTINCT t FROM g), tabs),
         c AS (SELECT lang, bucket, count(*) AS n FROM g JOIN h USING (t) WHERE lang IS NOT NULL AND {learn.format(crc='id_crc')} GROUP BY ALL),
         s AS (SELECT lang, sum(n) AS total FROM c GROUP BY lang),
         w AS (SELECT lang, bucket, CAST(round({SCALE} * ln((coalesce(n, 0) + 1) / (total + {BUCKETS}))) AS BIGINT) AS weight
               FROM s CROSS JOIN (SELECT unnest(range({BUCKETS})) AS bucket) LEFT JOIN c USING (lang, bucket)),
         p AS (SELECT doc_id, w.lang AS language, sum(weight) AS score
               FROM g JOIN h USING (t) JOIN w USING (bucket) WHERE {ask.format(crc='id_crc')} GROUP BY ALL),
         b AS (SELECT doc_id, arg_min(language, language) FILTER (WHERE top) AS language
               FROM (SELECT *, score = max(score) OVER (PARTITION BY doc_id) AS top FROM p) GROUP BY doc_id)
    SELECT d.doc_id, d.lang, coalesce(b.language, '{DEFAULT_LANGUAGE}') AS language
    FROM d LEFT JOIN b USING (doc_id) WHERE {ask.format(crc='d.id_crc')}"""
