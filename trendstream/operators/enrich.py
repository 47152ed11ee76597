"""Enrichment: raw posts -> (content, timestamp, language, entities).

The language is computed once and reused; no network call sits in the hot
path.  Entities come from capitalised runs, from a small literal gazetteer
(streams) or from a dictionary joined on the candidates (batch), where the
dictionary is broadcast only below a checked row count and otherwise joined
by a salted shuffle so one frequent entity cannot load a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from trendstream.functions import codec
from trendstream.functions import entities as EN
from trendstream.functions import lang as LG
from trendstream.functions import langmodel as LM
from trendstream.functions.langmodel import LanguageModel

# Largest dictionary (estimated bytes) that is broadcast to every task.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Per-row overhead added to the text bytes in that estimate.
ROW_OVERHEAD_BYTES = 48
# Salt values of a heavy entity in the shuffle join of a large dictionary.
JOIN_SALTS = 32
# An entity is salted if it holds this many candidate rows and one part in MOST_HEAVY of all.
HEAVY_ROWS = 50_000
MOST_HEAVY = 1000


def enrich(raw: DataFrame, body: str = "body", time_col: str | None = "enqueuedTime",
           gazetteer: list[str] | None = None, model: LanguageModel | None = None) -> DataFrame:
    """Raw posts (binary or text body + arrival time) -> enriched columns; the language
    is a learned ``model``'s or, without one, the stop words'."""
    content = F.col(body)
    if isinstance(raw.schema[body].dataType, BinaryType):
        content = codec.decode_body(content)
    ts = F.col(time_col).cast("string") if time_col else F.lit(None).cast("string")
    key = [F.col("key").alias("id")] if "key" in raw.columns else []
    base = raw.select(content.alias("content"), ts.alias("timestamp"), *key)
    ents = (EN.gazetteer_entities("content", gazetteer) if gazetteer is not None
            else EN.capitalised_entities("content"))
    told = LM.with_language(base, model, "content") if model else LG.with_language(base, "content")
    return told.select("content", "timestamp", "language",
                                                   ents.alias("entities"), *[c for c in base.columns if c == "id"])


def entity_candidates(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                      kind: str = "capitalised", extra: list[str] | None = None,
                      longest: int = 2) -> DataFrame:
    """(id, entity) per distinct candidate of each document; documents without
    any keep one row with a NULL entity.

    kind: "capitalised" runs of capitalised words, or "ngrams" (runs of up to
    ``longest`` words, for a gazetteer of arbitrary surface forms).
    """
    if kind == "capitalised":
        found = F.regexp_extract_all(F.col(text), F.lit(EN.CAPITALISED_RUN), 0)
    elif kind == "ngrams":
        found = EN.ngrams(EN.word_tokens(text), longest)
    else:
        raise ValueError(f"unknown candidate kind {kind!r}")
    return docs.select(id_col, *(extra or []), F.explode_outer(F.array_distinct(found)).alias("entity"))


def entity_dictionary(docs: DataFrame, min_docs: int, id_col: str = "doc_id",
                      text: str = "text", candidates: DataFrame | None = None) -> DataFrame:
    """Capitalised runs found in at least ``min_docs`` documents.

    Runs are de-duplicated inside each row first, so the count is a plain
    partial + final aggregation: frequent runs are reduced before the shuffle.
    ``candidates`` (from ``entity_candidates``) avoids extracting them again.
    """
    cand = candidates if candidates is not None else entity_candidates(docs, id_col, text)
    return (cand.where(F.col("entity").isNotNull()).groupBy("entity")
            .agg(F.count(F.lit(1)).alias("docs"))
            .where(F.col("docs") >= F.lit(min_docs)).select("entity"))


def longest_entry(dictionary: DataFrame) -> int:
    """Words of the longest dictionary entry."""
    return dictionary.agg(F.max(F.size(F.split("entity", " ")))).first()[0] or 1


def estimated_bytes(dictionary: DataFrame) -> int:
    """Size of the dictionary as it would be broadcast: bytes of every string
    column plus a per-row overhead (one small aggregate job)."""
    texts = [f.name for f in dictionary.schema.fields if f.dataType.simpleString() == "string"]
    text_bytes = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(0))
    r = dictionary.agg(F.count(F.lit(1)).alias("n"),
                       F.coalesce(F.sum(text_bytes), F.lit(0)).alias("b")).first()
    return int(r["b"]) + ROW_OVERHEAD_BYTES * int(r["n"])


def heavy_entities(candidates: DataFrame) -> DataFrame:
    """(entity, _heavy) of the entities that hold so many candidate rows that their join has to be
    split; at most MOST_HEAVY, as each holds at least that share of all rows."""
    least = max(HEAVY_ROWS, -(-candidates.count() // MOST_HEAVY))
    return (candidates.where(F.col("entity").isNotNull()).groupBy("entity").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= least).select("entity", F.lit(True).alias("_heavy")))


def replicas(dictionary: DataFrame, heavy: DataFrame, salts: int = JOIN_SALTS) -> DataFrame:
    """Dictionary rows with ``_salt``: every salt for the heavy entities, salt 0 for all others."""
    last = F.when(F.col("_heavy"), F.lit(salts - 1)).otherwise(0)
    return (dictionary.join(F.broadcast(heavy), "entity", "left")
            .select(*[F.col(c) for c in dictionary.columns], F.explode(F.sequence(F.lit(0), last)).alias("_salt")))


def tag_entities(docs: DataFrame, dictionary: DataFrame, id_col: str = "doc_id",
                 text: str = "text", broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
                 salts: int = JOIN_SALTS, candidates: str = "capitalised",
                 doc_language: str | None = None, candidate_rows: DataFrame | None = None) -> DataFrame:
    """(id, entities): the dictionary entries each document mentions, sorted; ["None"] if none.

    ``dictionary`` has a column ``entity`` (the surface form) and optionally
    ``name`` (reported instead of the surface) and ``language`` (the entry
    only applies to documents of that language, given by ``doc_language``).
    ``candidate_rows`` are precomputed (id, entity) rows to use instead of
    extracting candidates from ``docs`` again.
    """
    from trendstream.session import materialize
    has_name, has_lang = "name" in dictionary.columns, "language" in dictionary.columns
    entry = dictionary.select("entity", (F.col("name") if has_name else F.col("entity")).alias("_name"),
                              *([F.col("language").alias("_lang")] if has_lang else []))
    # computed once, kept in the shared folder for the size check and the join
    entry = materialize(entry, "dictionary")
    extra = [F.col(doc_language).alias("_doc_lang")] if (has_lang and doc_language) else []
    cand = candidate_rows if candidate_rows is not None else \
        entity_candidates(docs, id_col, text, candidates, extra,
                          longest_entry(entry) if candidates == "ngrams" else 1)
    keys = ["entity"]
    if extra:
        entry, keys = entry.withColumnRenamed("_lang", "_doc_lang"), ["entity", "_doc_lang"]
    elif has_lang:
        entry = entry.drop("_lang")
    if estimated_bytes(entry) <= broadcast_max_bytes:
        joined = cand.join(F.broadcast(entry), keys)
    else:
        rows = cand if candidate_rows is not None else materialize(cand, "candidates")
        heavy = materialize(heavy_entities(rows), "heavy-entities")
        # per-row salt: rows are regrouped by id afterwards, so even many copies
        # of one (id, entity) pair spread over all salts
        spread = F.when(F.col("_heavy"), F.pmod(F.monotonically_increasing_id(), F.lit(salts))).otherwise(0).cast("int")
        salted = rows.join(F.broadcast(heavy), "entity", "left").withColumn("_salt", spread).drop("_heavy")
        joined = salted.join(replicas(entry, heavy, salts), keys + ["_salt"])
    # only candidates that are entries travel; a row without a name stands for each document
    asked = (candidate_rows if candidate_rows is not None else docs).select(id_col, F.lit(None).cast("string").alias("_name"))
    per_doc = joined.select(id_col, "_name").unionByName(asked).groupBy(id_col).agg(F.array_sort(F.array_distinct(F.collect_list("_name")))
                                         .alias("entities"))
    return per_doc.select(id_col, EN.or_none(F.col("entities")).alias("entities"))
