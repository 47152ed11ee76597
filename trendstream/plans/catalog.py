"""Registered queries and their SQL oracles.

Each query reads the given tables (or data Spark derives from them) and
returns a DataFrame; the oracle is the same question in plain SQL over the
same tables, used to check the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendstream.functions import entities as EN
from trendstream.functions import lang as LG
from trendstream.functions import langmodel as LM
from trendstream.functions import polarity as PO
from trendstream.operators import longterm as LT
from trendstream.operators import topics as T
from trendstream.operators import trends as TR
from trendstream.plans import fixtures as FX

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


# ---------------------------------------------------------------- SQL pieces
_TOPIC_ROWS = ("SELECT ts, unnest([event_type, 'user_' || CAST(user_id AS VARCHAR)]) AS topic "
               "FROM events")


def _window_counts_sql(length_min: int = 10, slide_min: int = 1, rows: str = _TOPIC_ROWS) -> str:
    k = length_min // slide_min
    return f"""
    SELECT b.bucket - (r.i * {slide_min}) * INTERVAL 1 MINUTE AS windowStart,
           b.bucket - (r.i * {slide_min}) * INTERVAL 1 MINUTE + INTERVAL {length_min} MINUTE AS windowEnd,
           b.topic, CAST(sum(b.n) AS BIGINT) AS count
    FROM (SELECT time_bucket(INTERVAL {slide_min} MINUTE, ts, TIMESTAMP '1970-01-01') AS bucket,
                 topic, count(*) AS n
          FROM ({rows}) GROUP BY ALL) b, range({k}) r(i)
    GROUP BY ALL"""


def _alert_json_sql(src: str) -> str:
    return f"""
    SELECT '{{"windowStart":"' || strftime(windowStart, '%Y-%m-%d %H:%M:%S')
        || '","windowEnd":"' || strftime(windowEnd, '%Y-%m-%d %H:%M:%S')
        || '","topic":' || to_json(topic) || ',"count":' || CAST(count AS VARCHAR) || '}}' AS body
    FROM ({src})"""


# ------------------------------------------------------------ trend queries
def _topic_rows(spark, sf_dir):
    return T.explode_topics(FX.enriched_events(spark, sf_dir))


@register("topic_window_counts", _window_counts_sql())
def topic_window_counts(spark, sf_dir):
    return TR.topic_counts(_topic_rows(spark, sf_dir))


@register("threshold_alerts",
          f"SELECT * FROM ({_window_counts_sql()}) WHERE count >= {TR.ALERT_THRESHOLD}")
def threshold_alerts(spark, sf_dir, threshold: int = TR.ALERT_THRESHOLD):
    return TR.threshold(TR.topic_counts(_topic_rows(spark, sf_dir)), threshold)


@register("alert_json", _alert_json_sql(
    f"SELECT * FROM ({_window_counts_sql()}) WHERE count >= {TR.ALERT_THRESHOLD}"))
def alert_json(spark, sf_dir):
    return TR.alert_bodies(threshold_alerts(spark, sf_dir))


@register("closed_window_counts", f"""
    SELECT * FROM ({_window_counts_sql()})
    WHERE windowEnd <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def closed_window_counts(spark, sf_dir):
    return TR.closed_windows(TR.topic_counts(_topic_rows(spark, sf_dir)), _topic_times(spark, sf_dir))


def _topic_times(spark, sf_dir):
    """Times of the messages that have a topic: two columns of the scan, nothing exploded or dealt out."""
    ev = FX.enriched_from_events(FX.read_table(spark, sf_dir, "events", balanced=False))
    return ev.where(F.size("entities") > 0).select(F.col("timestamp").alias("ts"))


@register("distinct_per_message_counts", _window_counts_sql(
    rows="SELECT ts, unnest(list_distinct([event_type, 'user_' || CAST(user_id AS VARCHAR), event_type])) "
         "AS topic FROM events"))
def distinct_per_message_counts(spark, sf_dir):
    """Every message names its type twice; it counts once."""
    twice = FX.enriched_events(spark, sf_dir).withColumn(
        "entities", F.concat("entities", F.slice("entities", 1, 1)))
    return TR.topic_counts(TR.distinct_per_message(twice))


# ------------------------------------------------------------ codec queries
@register("explode_topics", _TOPIC_ROWS)
def explode_topics(spark, sf_dir):
    return _topic_rows(spark, sf_dir)


_ENRICHED_JSON_SQL = """
    SELECT '{"content":' || to_json(props) || ',"timestamp":' || to_json(CAST(ts AS VARCHAR))
        || ',"language":"en","entities":' || to_json([event_type, 'user_' || CAST(user_id AS VARCHAR)])
        || '}' AS body
    FROM events"""


@register("enriched_json", _ENRICHED_JSON_SQL)
def enriched_json(spark, sf_dir):
    from trendstream.functions import codec
    return FX.enriched_events(spark, sf_dir).select(codec.enriched_json().alias("body"))


# --------------------------------------------------------- stream queries
# Fewest micro-batches of a replayed history, fewest files of each, and most splits and events of the input in one
# (fixture rules, fixed values).
SLICES, FILES_A_SLICE, SPLITS_A_SLICE, EVENTS_A_SLICE = 4, 4, 256, 1_000_000


def _replay(spark, sf_dir) -> tuple[int, int]:
    """Micro-batches of a replayed history and files of each, by the input's splits and events: a file is about as
    large as a split (smaller where there are few), and a micro-batch takes at most SPLITS_A_SLICE of them and about
    EVENTS_A_SLICE events, so that its state stays the same size however long the history is."""
    events = FX.read_table(spark, sf_dir, "events", balanced=False)
    splits = events.rdd.getNumPartitions()
    slices = max(SLICES, -(-splits // SPLITS_A_SLICE), -(-events.count() // EVENTS_A_SLICE))
    return slices, max(FILES_A_SLICE, -(-splits // slices))


def _enriched_topic(spark, sf_dir) -> str:
    """The history of enriched payloads, replayed into a topic in event-time slices."""
    from trendstream.session import fresh_path
    from trendstream.sources.topics import stored_slices, write_topic
    from trendstream.streaming import pipelines as P
    topic = fresh_path(spark, "topic-enriched")
    slices, files = _replay(spark, sf_dir)
    for part in stored_slices(FX.enriched_events(spark, sf_dir), "timestamp", slices):
        write_topic(P.enriched_bodies(part).repartition(files), topic, "text")
    return topic


# Partitions of the state for each core (fixture rule, fixed value): a micro-batch is bounded, so is each of them.
STATE_A_CORE = 2


def _run_alert_stream(spark, topic: str, out: str, threshold: int, files: int = FILES_A_SLICE):
    """One slice in each micro-batch, so no row is late and state holds a slice's windows."""
    from trendstream.session import default_parallelism
    from trendstream.sources.topics import read_topic
    from trendstream.streaming import pipelines as P
    from trendstream.streaming.runner import run_once
    return run_once(P.alerts(read_topic(spark, topic, "text", max_files_per_trigger=files), threshold),
                    sink="parquet", path=out, checkpoint=out + ".chk",
                    state_partitions=STATE_A_CORE * default_parallelism(spark))


def _read_alert_sink(spark, out: str) -> DataFrame:
    return spark.read.parquet(out).select(
        F.col("windowStart").cast("timestamp_ntz").alias("windowStart"),
        F.col("windowEnd").cast("timestamp_ntz").alias("windowEnd"), "topic", "count")


_CLOSED_SQL = f"""
    SELECT * FROM ({_window_counts_sql()})
    WHERE windowEnd <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""


@register("stream_threshold_alerts", f"SELECT * FROM ({_CLOSED_SQL}) WHERE count >= {TR.ALERT_THRESHOLD}")
def stream_threshold_alerts(spark, sf_dir, threshold: int = TR.ALERT_THRESHOLD):
    """The alert job as a Structured Streaming run over a file topic."""
    from trendstream.session import fresh_path
    topic = _enriched_topic(spark, sf_dir)
    out = fresh_path(spark, "alerts")
    _run_alert_stream(spark, topic, out, threshold, _replay(spark, sf_dir)[1])
    return _read_alert_sink(spark, out)


# Fixture rule (fixed value): how many of the earliest posts are re-delivered late.
LATE_REDELIVERED = 20


@register("late_data_dropped", _CLOSED_SQL)
def late_data_dropped(spark, sf_dir):
    """All closed window counts; re-delivering the earliest posts afterwards changes nothing."""
    from trendstream.session import fresh_path
    from trendstream.sources.topics import write_topic
    from trendstream.streaming import pipelines as P
    topic = _enriched_topic(spark, sf_dir)
    out = fresh_path(spark, "counts")
    _run_alert_stream(spark, topic, out, 1, _replay(spark, sf_dir)[1])
    late = FX.enriched_events(spark, sf_dir).orderBy("timestamp").limit(LATE_REDELIVERED)
    write_topic(P.enriched_bodies(late), topic, "text")
    _run_alert_stream(spark, topic, out, 1, _replay(spark, sf_dir)[1])
    return _read_alert_sink(spark, out)


# ------------------------------------------------- messages, search, paging
# Search fixture (fixed values): a text fragment frequent in English documents.
SEARCH_QUERY = "ndre"
SEARCH_LANG = "en"


@register("messages_projection", """
    SELECT props AS text, epoch_us(ts) // 1000 AS timestamp, 'Twitter' AS source,
           CAST(trunc(value) AS INTEGER) AS numOfShares, CAST(user_id AS INTEGER) AS numOfLikes,
           event_type = 'view' AS isShareOrRetweet, 'en' AS lang, event_id AS id,
           CAST(NULL AS MAP(VARCHAR, INTEGER)) AS reactions, CAST(NULL AS VARCHAR[]) AS topics,
           0.0::DOUBLE AS sentiment
    FROM events""")
def messages_projection(spark, sf_dir):
    from trendstream.operators import messages as M
    return M.project_statuses(FX.statuses(spark, sf_dir))


@register("message_defaults", """
    SELECT text, CAST(0 AS BIGINT) AS timestamp, source, 0 AS numOfShares, 0 AS numOfLikes,
           false AS isShareOrRetweet, lang, doc_id AS id,
           CAST(NULL AS MAP(VARCHAR, INTEGER)) AS reactions, CAST(NULL AS VARCHAR[]) AS topics,
           0.0::DOUBLE AS sentiment
    FROM documents""")
def message_defaults(spark, sf_dir):
    """Documents written as a message file with only text/id/lang/source, read back."""
    from trendstream.session import fresh_path
    from trendstream.sources import messages as SM
    path = fresh_path(spark, "messages")
    SM.write_messages(FX.document_messages(spark, sf_dir), path)
    return SM.read_messages_json(spark, path)


_SEARCH_SQL = f"""
    SELECT doc_id AS id, text, lang, source FROM documents
    WHERE contains(lower(text), '{SEARCH_QUERY}') AND lang = '{SEARCH_LANG}'
    ORDER BY doc_id DESC LIMIT 100"""


@register("search_topic_lang", _SEARCH_SQL)
def search_topic_lang(spark, sf_dir):
    """One page by the trigram index: texts are read for the newest candidates only."""
    from trendstream.operators import paging as PG
    from trendstream.operators.search_index import TextIndex
    index = TextIndex.build(FX.document_messages(spark, sf_dir))
    return index.search(SEARCH_QUERY, SEARCH_LANG, PG.PAGE_SIZE)


@register("search_topic_lang_scan", _SEARCH_SQL)
def search_topic_lang_scan(spark, sf_dir):
    from trendstream.operators import paging as PG
    return PG.search(FX.document_messages(spark, sf_dir), SEARCH_QUERY, SEARCH_LANG, PG.PAGE_SIZE)


@register("search_index_candidates", """
    SELECT doc_id AS id, contains(lower(text), 'andre') AS matches FROM documents
    WHERE contains(lower(text), 'and') AND contains(lower(text), 'ndr') AND contains(lower(text), 'dre')""")
def search_index_candidates(spark, sf_dir):
    """What the index proposes for a query, and which of it are matches."""
    from trendstream.operators.search_index import TextIndex
    index = TextIndex.build(FX.document_messages(spark, sf_dir))
    found = index.texts().join(index.candidates("andre").hint("merge"), "place", "left_semi")
    return found.select("id", F.contains(F.lower("text"), F.lit("andre")).alias("matches"))


_PAGES_SQL = f"""
    SELECT doc_id AS id, text, lang, source, row_number() OVER (ORDER BY doc_id DESC) AS rank,
           CAST(ceil(row_number() OVER (ORDER BY doc_id DESC) / 100) AS BIGINT) AS page
    FROM documents WHERE contains(lower(text), '{SEARCH_QUERY}') AND lang = '{SEARCH_LANG}'"""


@register("search_pages", f"SELECT id, rank, page FROM ({_PAGES_SQL})")
def search_pages(spark, sf_dir):
    from trendstream.operators import paging as PG
    return PG.rank_pages(FX.document_messages(spark, sf_dir), SEARCH_QUERY, SEARCH_LANG,
                         PG.PAGE_SIZE, columns=["id"]).select("id", "rank", "page")


@register("search_page_cursors", f"""
    SELECT page, count(*) AS n, min(id) AS min_id, min(id) - 1 AS next_max_id
    FROM ({_PAGES_SQL}) GROUP BY page""")
def search_page_cursors(spark, sf_dir):
    from trendstream.operators import paging as PG
    return PG.page_cursors(PG.rank_pages(FX.document_messages(spark, sf_dir), SEARCH_QUERY,
                                         SEARCH_LANG, PG.PAGE_SIZE, columns=["id"]))


@register("drop_shares", """
    SELECT id, text, page, next_max_id FROM (
      SELECT event_id AS id, props AS text, event_type = 'view' AS share, p.page,
             min(event_id) OVER (PARTITION BY p.page) - 1 AS next_max_id
      FROM (SELECT *, CAST(ceil(row_number() OVER (ORDER BY event_id DESC) / 100) AS BIGINT) AS page
            FROM events) p)
    WHERE NOT share""")
def drop_shares(spark, sf_dir):
    """Ingest loop over all pages of the statuses: shares are skipped, cursors still move."""
    from trendstream.operators import messages as M
    from trendstream.operators import paging as PG
    msgs = M.project_statuses(FX.statuses(spark, sf_dir))
    paged = PG.rank_pages(msgs, count=PG.PAGE_SIZE, columns=["id", "text", "isShareOrRetweet"])
    return M.drop_shares(paged).select("id", "text", "page", "next_max_id")


# -------------------------------------------------------------- enrichment

# Dictionary fixture (fixed value): a capitalised run is an entity when this
# many documents mention it.
ENTITY_MIN_DOCS = 10


def _docs(spark, sf_dir):
    from trendstream.sources.tables import read_table
    return read_table(spark, sf_dir, "documents")


@register("language_detected",
          f"SELECT doc_id, lang, {LG.detect_language_sql('text')} AS language FROM documents")
def language_detected(spark, sf_dir):
    return LG.with_language(_docs(spark, sf_dir).select("doc_id", "lang", "text")).select(
        "doc_id", "lang", "language")


@register("language_accuracy", f"""
    SELECT lang, language, count(*) AS n FROM (
      SELECT lang, {LG.detect_language_sql('text')} AS language FROM documents)
    GROUP BY ALL""")
def language_accuracy(spark, sf_dir):
    return (language_detected(spark, sf_dir).groupBy("lang", "language")
            .agg(F.count(F.lit(1)).alias("n")))


# Folds of the learned model (fixed values): rows whose id's CRC-32 leaves 0 are asked, the others are learned from.
_LEARNED, _ASKED = "{crc} % 5 <> 0", "{crc} % 5 = 0"
_MODEL_SQL = LM.detect_sql(_LEARNED, _ASKED)


def _fold(asked: bool):
    own = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return own if asked else ~own


@register("language_learned", _MODEL_SQL)
def language_learned(spark, sf_dir):
    """Language by trigram log-odds learned from the other folds' labels."""
    docs = _docs(spark, sf_dir).select("doc_id", "lang", "text")
    model = LM.LanguageModel.learn(docs.where(_fold(False)))
    return LM.with_language(docs.where(_fold(True)), model).select("doc_id", "lang", "language")


@register("stream_language_learned", _MODEL_SQL)
def stream_language_learned(spark, sf_dir):
    """The enrichment job with a saved model: asked documents posted, enriched as a stream, read from the topic."""
    from trendstream.session import fresh_path
    from trendstream.streaming import jobs as J
    root = fresh_path(spark, "learned")
    cfg = J.PipelineConfig(root=root, language_model=f"{root}/language-model")
    docs = _docs(spark, sf_dir).select("doc_id", "lang", "text")
    LM.LanguageModel.learn(docs.where(_fold(False))).save(spark, cfg.language_model)
    asked = docs.where(_fold(True))
    J.ingest_job(asked.select(F.col("doc_id").alias("id"), "text"), cfg)
    J.enrichment_job(spark, cfg).awaitTermination()
    told = T.decode_enriched(cfg.read(spark, cfg.enriched_topic, stream=False))
    return told.select(F.col("id").cast("bigint").alias("doc_id"), "language").join(
        asked.select("doc_id", "lang"), "doc_id").select("doc_id", "lang", "language")


@register("language_learned_accuracy", f"""
    SELECT count(*) AS n, count(*) FILTER (WHERE lang = language) AS agreed,
           count(*) FILTER (WHERE lang = language) >= 0.99 * count(*) AS good FROM ({_MODEL_SQL})""")
def language_learned_accuracy(spark, sf_dir):
    """Agreement of the learned model with the labels it was not learned from."""
    found = language_learned(spark, sf_dir)
    agreed = F.count_if(F.col("lang") == F.col("language"))
    return found.agg(F.count(F.lit(1)).alias("n"), agreed.alias("agreed"),
                     (agreed >= 0.99 * F.count(F.lit(1))).alias("good"))


@register("entities_capitalised",
          f"SELECT doc_id, {EN.capitalised_entities_sql('text')} AS entities FROM documents")
def entities_capitalised(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", EN.capitalised_entities("text").alias("entities"))


@register("entities_gazetteer", f"""
    WITH c AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '{EN.CAPITALISED_RUN}'))) AS entity
               FROM documents),
         d AS (SELECT entity FROM c GROUP BY entity HAVING count(*) >= {ENTITY_MIN_DOCS}),
         t AS (SELECT c.doc_id, list_sort(list(c.entity)) AS ents FROM c JOIN d USING (entity)
               GROUP BY c.doc_id)
    SELECT documents.doc_id, CASE WHEN t.ents IS NULL THEN ['None'] ELSE t.ents END AS entities
    FROM documents LEFT JOIN t USING (doc_id)""")
def entities_gazetteer(spark, sf_dir):
    from trendstream.operators import enrich as ER
    from trendstream.session import materialize
    docs = _docs(spark, sf_dir)
    # one regex pass over the texts: (doc, candidate) rows feed both steps
    cand = materialize(ER.entity_candidates(docs), "candidates")
    return ER.tag_entities(docs, ER.entity_dictionary(docs, ENTITY_MIN_DOCS, candidates=cand),
                           candidate_rows=cand)


# Gazetteer fixture (fixed values): runs of one to four words of the documents' opening sentences.
LONG_NAMES = ["the", "of the", "The and attion to", "and attion to", "la de", "der ist die das"]


def _long_names_sql() -> str:
    tokens = "list_filter(regexp_split_to_array(text, '[^\\p{L}]+'), lambda t: t <> '')"
    joined = f"' ' || array_to_string({tokens}, ' ') || ' '"
    names = "list_filter([" + ", ".join(f"'{n}'" for n in LONG_NAMES) + "], lambda n: contains(joined, ' ' || n || ' '))"
    return f"""
    SELECT doc_id, CASE WHEN len(found) > 0 THEN list_sort(found) ELSE ['None'] END AS entities
    FROM (SELECT doc_id, {names} AS found FROM (SELECT doc_id, {joined} AS joined FROM documents))"""


@register("entities_gazetteer_shuffled", f"""
    WITH c AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(text, '{EN.CAPITALISED_RUN}'))) AS entity
               FROM documents),
         t AS (SELECT c.doc_id, list_sort(list(c.entity)) AS ents FROM c
               WHERE entity IN (SELECT entity FROM c GROUP BY entity HAVING count(*) >= {ENTITY_MIN_DOCS}) GROUP BY c.doc_id)
    SELECT documents.doc_id, CASE WHEN t.ents IS NULL THEN ['None'] ELSE t.ents END AS entities
    FROM documents LEFT JOIN t USING (doc_id)""")
def entities_gazetteer_shuffled(spark, sf_dir):
    """The dictionary join for dictionaries beyond the broadcast bound: only heavy entities are salted."""
    from trendstream.operators import enrich as ER
    from trendstream.session import materialize
    docs = _docs(spark, sf_dir)
    cand = materialize(ER.entity_candidates(docs), "candidates")
    return ER.tag_entities(docs, ER.entity_dictionary(docs, ENTITY_MIN_DOCS, candidates=cand), candidate_rows=cand,
                           broadcast_max_bytes=0)


@register("entities_long_names", _long_names_sql())
def entities_long_names(spark, sf_dir):
    """Entries of up to four words, by the dictionary join."""
    from trendstream.operators import enrich as ER
    names = FX.read_table(spark, sf_dir, "region").limit(1).select(F.explode(F.array(*map(F.lit, LONG_NAMES))).alias("entity"))
    return ER.tag_entities(_docs(spark, sf_dir), names, candidates="ngrams")


@register("entities_long_names_literal", _long_names_sql())
def entities_long_names_literal(spark, sf_dir):
    """The same by the literal gazetteer of the stream form."""
    found = EN.gazetteer_entities("text", LONG_NAMES)
    return _docs(spark, sf_dir).select("doc_id", F.array_sort(found).alias("entities"))


@register("enriched_documents", f"""
    SELECT '{{"content":' || to_json(text) || ',"timestamp":null,"language":' ||
           to_json({LG.detect_language_sql('text')}) || ',"entities":' ||
           to_json({EN.capitalised_entities_sql('text')}) || '}}' AS body
    FROM documents""")
def enriched_documents(spark, sf_dir):
    """Whole enrichment stage over documents posted to the raw topic (no arrival time)."""
    from trendstream.operators import enrich as ER
    from trendstream.sources.topics import produce_raw
    from trendstream.streaming import pipelines as P
    raw = produce_raw(_docs(spark, sf_dir)).withColumn("enqueuedTime", F.lit(None).cast("timestamp"))
    return P.enriched_bodies(ER.enrich(raw))


# --------------------------------------------------- codec round trips
_BASE_SQL = ("SELECT props AS content, ts AS timestamp, 'en' AS language, "
             "[event_type, 'user_' || CAST(user_id AS VARCHAR)] AS entities FROM events")


@register("enriched_roundtrip", _BASE_SQL)
def enriched_roundtrip(spark, sf_dir):
    """Enriched JSON -> UTF-8 payload -> text -> struct -> columns."""
    from trendstream.functions import codec
    raw = enriched_json(spark, sf_dir).select(codec.encode_text("body").alias("body"))
    dec = T.decode_enriched(raw)
    return dec.select("content", T.event_time(dec, "timestamp").alias("timestamp"),
                      "language", "entities")


@register("malformed_json_dropped", _TOPIC_ROWS)
def malformed_json_dropped(spark, sf_dir):
    """A topic holding enriched payloads and non-JSON text: the latter yields no topic row."""
    junk = _docs(spark, sf_dir).select(F.col("text").alias("body"))
    return T.explode_topics(T.decode_enriched(enriched_json(spark, sf_dir).unionByName(junk)))


# ---------------------------------------------------------------- history
_HISTORY_SQL = """
    SELECT substr(sha256(props || chr(1) || CAST(ts AS VARCHAR)), 1, 36) AS uniqueId,
           props AS content, CAST(ts AS VARCHAR) AS timestamp, 'en' AS language,
           unnest([event_type, 'user_' || CAST(user_id AS VARCHAR)]) AS topic
    FROM events"""


@register("history_rows", _HISTORY_SQL)
def history_rows(spark, sf_dir):
    return T.history_rows(FX.enriched_events(spark, sf_dir))


@register("history_table_roundtrip", f"""
    SELECT uniqueId AS UniqueId, CAST(timestamp AS TIMESTAMP) AS TweetTime, content AS Content,
           language AS Language, topic AS Topic
    FROM ({_HISTORY_SQL})""")
def history_table_roundtrip(spark, sf_dir):
    """History stream (enriched topic -> table folder, exactly once) read back."""
    from trendstream.operators import history as H
    from trendstream.session import fresh_path
    from trendstream.sources.topics import read_topic
    from trendstream.streaming import pipelines as P
    topic = _enriched_topic(spark, sf_dir)
    loc = fresh_path(spark, "history")
    H.start_stream(P.history(read_topic(spark, topic, "text", max_files_per_trigger=_replay(spark, sf_dir)[1])), loc,
                   loc + ".chk").awaitTermination()
    return H.read_history(spark, loc).select(
        "UniqueId", F.col("TweetTime").cast("timestamp_ntz").alias("TweetTime"),
        "Content", "Language", "Topic")


@register("history_compacted", f"""
    SELECT uniqueId AS UniqueId, CAST(timestamp AS TIMESTAMP) AS TweetTime, content AS Content,
           language AS Language, topic AS Topic
    FROM ({_HISTORY_SQL}) UNION ALL
    SELECT substr(sha256('key' || chr(1) || CAST(o_orderkey AS VARCHAR)), 1, 36), CAST(date_trunc('month', o_orderdate) AS TIMESTAMP),
           o_orderstatus, 'en', o_orderpriority FROM orders""")
def history_compacted(spark, sf_dir):
    """A stream's partitions compacted, then a batch append compacted too, replaced files removed, read back."""
    from trendstream.operators import compaction as CP
    from trendstream.operators import history as H
    from trendstream.session import fresh_path
    from trendstream.sources.topics import read_topic
    from trendstream.streaming import pipelines as P
    loc = fresh_path(spark, "history")
    H.start_stream(P.history(read_topic(spark, _enriched_topic(spark, sf_dir), "text",
                                        max_files_per_trigger=_replay(spark, sf_dir)[1])), loc, loc + ".chk").awaitTermination()
    CP.compact(spark, loc)
    orders = FX.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("content"), F.date_trunc("month", "o_orderdate").alias("timestamp"),
        F.lit("en").alias("language"), F.array("o_orderpriority").alias("entities"),
        F.col("o_orderkey").cast("string").alias("id"))
    H.append_batch(T.history_rows(orders), loc)
    CP.compact(spark, loc)
    CP.expire(spark, loc)
    return H.read_history(spark, loc).select(
        "UniqueId", F.col("TweetTime").cast("timestamp_ntz").alias("TweetTime"), "Content", "Language", "Topic")


@register("history_two_writers", f"""
    SELECT uniqueId AS UniqueId, CAST(timestamp AS TIMESTAMP) AS TweetTime, content AS Content,
           language AS Language, topic AS Topic
    FROM ({_HISTORY_SQL}) UNION ALL
    SELECT substr(sha256('key' || chr(1) || CAST(o_orderkey AS VARCHAR)), 1, 36), CAST(date_trunc('year', o_orderdate) AS TIMESTAMP),
           o_orderstatus, 'en', o_orderpriority FROM orders""")
def history_two_writers(spark, sf_dir):
    """A stream and a batch append into one catalog table, read back from its folder."""
    import uuid
    from trendstream.operators import history as H
    from trendstream.session import fresh_path
    from trendstream.sources.topics import read_topic
    from trendstream.streaming import pipelines as P
    loc, table = fresh_path(spark, "history"), f"history_{uuid.uuid4().hex[:12]}"
    H.ensure_table(spark, loc, table)
    H.start_stream(P.history(read_topic(spark, _enriched_topic(spark, sf_dir), "text",
                                        max_files_per_trigger=_replay(spark, sf_dir)[1])), loc, loc + ".chk").awaitTermination()
    orders = FX.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("content"), F.date_trunc("year", "o_orderdate").alias("timestamp"),
        F.lit("en").alias("language"), F.array("o_orderpriority").alias("entities"),
        F.col("o_orderkey").cast("string").alias("id"))
    H.append_batch(T.history_rows(orders), table=table)
    H.refresh_partitions(spark, table)
    out = spark.table(table).select("UniqueId", F.col("TweetTime").cast("timestamp_ntz").alias("TweetTime"),
                                    "Content", "Language", "Topic")
    spark.sql(f"DROP TABLE {table}")          # the folder stays and is what is read
    back = H.read_history(spark, loc)
    return back.select("UniqueId", F.col("TweetTime").cast("timestamp_ntz").alias("TweetTime"),
                       *[c for c in out.columns if c not in ("UniqueId", "TweetTime")])


@register("history_dedupe", """
    SELECT substr(sha256('key' || chr(1) || CAST(doc_id AS VARCHAR)), 1, 36) AS UniqueId, text AS Content,
           lang AS Language, source AS Topic
    FROM documents""")
def history_dedupe(spark, sf_dir):
    """Documents delivered twice by an at-least-once writer: repeats go, equal texts stay."""
    from trendstream.operators import history as H
    from trendstream.session import fresh_path
    loc = fresh_path(spark, "history")
    rows = T.history_rows(_docs(spark, sf_dir).select(
        F.col("text").alias("content"), F.lit("2024-01-01 00:00:00").alias("timestamp"),
        F.col("lang").alias("language"), F.array("source").alias("entities"), F.col("doc_id").cast("string").alias("id")))
    for _ in range(2):
        H.append_batch(rows, loc)
    return H.read_history(spark, loc, dedupe=True).select("UniqueId", "Content", "Language", "Topic")


@register("topic_after_aborted_write", _ENRICHED_JSON_SQL)
def topic_after_aborted_write(spark, sf_dir):
    """Enrichment as a stream into a topic whose folder also holds files that no commit names."""
    from trendstream.session import fresh_path
    from trendstream.sources.tables import stream_table
    from trendstream.sources.topics import producer_path, read_topic
    from trendstream.streaming import pipelines as P
    from trendstream.streaming.ingest import ENRICH
    from trendstream.streaming.runner import run_once
    topic = fresh_path(spark, "topic-enriched")
    bodies = P.enriched_bodies(FX.enriched_from_events(stream_table(spark, sf_dir, "events")))
    run_once(bodies.select(F.col("body").alias("value")), sink="text", path=producer_path(topic, ENRICH),
             checkpoint=topic + ".chk")
    enriched_json(spark, sf_dir).select(F.col("body").alias("value")).write.mode("append").text(
        producer_path(topic, ENRICH))
    return read_topic(spark, topic, "text", stream=False, producers=(ENRICH,))


@register("message_array_file", """
    SELECT text, CAST(0 AS BIGINT) AS timestamp, source, 0 AS numOfShares, 0 AS numOfLikes,
           false AS isShareOrRetweet, lang, doc_id AS id,
           CAST(NULL AS MAP(VARCHAR, INTEGER)) AS reactions, CAST(NULL AS VARCHAR[]) AS topics,
           0.0::DOUBLE AS sentiment
    FROM documents""")
def message_array_file(spark, sf_dir):
    """Documents as message files that hold one JSON array over several lines, read by the default reader."""
    from trendstream.session import fresh_path
    from trendstream.sources import messages as SM
    path = fresh_path(spark, "messages-array")
    SM.write_message_arrays(FX.document_messages(spark, sf_dir), path)
    return SM.reader("fixed", spark, path=path).search(SM.SearchRequest("any")).messages


@register("payloads_with_bad_bytes", """
    SELECT event_id, ts AS timestamp, props || chr(65533) AS content FROM events""")
def payloads_with_bad_bytes(spark, sf_dir):
    """Raw payloads that end in a byte that is not UTF-8: enrichment goes on with the replacement character."""
    from trendstream.operators import enrich as ER
    ev = FX.read_table(spark, sf_dir, "events")
    raw = ev.select(F.concat(F.encode("props", "UTF-8"), F.unhex(F.lit("FF"))).alias("body"),
                    F.col("ts").cast("timestamp").alias("enqueuedTime"), F.col("event_id").cast("string").alias("key"))
    out = ER.enrich(raw)
    return out.select(F.col("id").cast("bigint").alias("event_id"),
                      T.event_time(out, "timestamp").alias("timestamp"), "content")


_OFFSET_SQL = """
    SELECT ts - INTERVAL 2 HOUR AS ts, unnest([event_type, 'user_' || CAST(user_id AS VARCHAR)]) AS topic
    FROM events"""


def _with_offset(events: DataFrame) -> DataFrame:
    """Enriched payloads whose timestamps state an offset of two hours."""
    from trendstream.streaming import pipelines as P
    e = FX.enriched_from_events(events)
    return P.enriched_bodies(e.withColumn("timestamp", F.concat(F.col("timestamp").cast("string"), F.lit("+02:00"))))


@register("offset_timestamps", _OFFSET_SQL)
def offset_timestamps(spark, sf_dir):
    return T.explode_topics(T.decode_enriched(_with_offset(FX.read_table(spark, sf_dir, "events"))))


@register("stream_offset_timestamps", _OFFSET_SQL)
def stream_offset_timestamps(spark, sf_dir):
    """The same as a stream: one rule for time in both."""
    from trendstream.session import fresh_path
    from trendstream.sources.tables import stream_table
    from trendstream.streaming.runner import run_once
    out = fresh_path(spark, "topic-rows")
    rows = T.explode_topics(T.decode_enriched(_with_offset(stream_table(spark, sf_dir, "events")), narrow=True),
                            tz_aware=True)
    run_once(rows, sink="parquet", path=out, checkpoint=out + ".chk")
    return spark.read.parquet(out).select(F.col("ts").cast("timestamp_ntz").alias("ts"), "topic")


@register("stream_ingest", f"""
    SELECT doc_id AS id, text, {LG.detect_language_sql('text')} AS language
    FROM documents WHERE contains(lower(text), '{SEARCH_QUERY}')""")
def stream_ingest(spark, sf_dir):
    """Continuous ingest of a posts table (search by text), then enrichment; ids travel as keys."""
    from trendstream.operators import paging as PG
    from trendstream.session import fresh_path
    from trendstream.sources.tables import stream_table
    from trendstream.streaming import jobs as J
    cfg = J.PipelineConfig(root=fresh_path(spark, "ingest"), max_files_per_trigger=2)
    posts = stream_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "lang", "source")
    J.continuous_ingest_job(PG.matches(posts, SEARCH_QUERY), cfg).awaitTermination()
    J.enrichment_job(spark, cfg).awaitTermination()
    dec = T.decode_enriched(cfg.read(spark, cfg.enriched_topic, stream=False))
    return dec.select(F.col("id").cast("bigint").alias("id"), F.col("content").alias("text"), "language")


# ---------------------------------------------------------------- watcher
# Watch fixture (fixed value): alerts must start strictly after this time.
WATCH_START = "2024-01-15 00:00:00"
_ALERTS_SQL = f"SELECT * FROM ({_window_counts_sql()}) WHERE count >= {TR.ALERT_THRESHOLD}"


def _alert_topic(spark, sf_dir):
    """A written topic of alert payloads and of payloads to be skipped: conversation
    turns, alerts cut short, alerts with trailing text.  NULL bodies, which no text
    file holds, come beside it (one for each region)."""
    from trendstream.session import fresh_path
    from trendstream.sources.topics import read_topic, write_topic
    topic = fresh_path(spark, "topic-alerts")
    alerts = alert_json(spark, sf_dir)
    turns = FX.read_table(spark, sf_dir, "conversations").select(
        F.regexp_replace("text", "[\\r\\n]", " ").alias("body"))
    cut = alerts.select(F.expr("substring(body, 1, length(body) - 12)").alias("body"))
    trailing = alerts.select(F.concat("body", F.lit(" and more")).alias("body"))
    write_topic(alerts, topic, "text")
    write_topic(turns.unionByName(cut).unionByName(trailing), topic, "text")
    nulls = FX.read_table(spark, sf_dir, "region").select(F.lit(None).cast("string").alias("body"))
    return read_topic(spark, topic, "text", stream=False).unionByName(nulls)


_REJECTED_SQL = (f"(SELECT count(*) FROM conversations) + 2 * (SELECT count(*) FROM ({_ALERTS_SQL})) "
                 "+ (SELECT count(*) FROM region)")


@register("fresh_alerts",
          f"SELECT * FROM ({_ALERTS_SQL}) WHERE windowStart > TIMESTAMP '{WATCH_START}'")
def fresh_alerts(spark, sf_dir):
    from trendstream.operators import watch as W
    return W.fresh_alerts(_alert_topic(spark, sf_dir), WATCH_START).select(
        F.col("windowStart").cast("timestamp_ntz").alias("windowStart"),
        F.col("windowEnd").cast("timestamp_ntz").alias("windowEnd"), "topic", "count")


@register("has_fresh_alert", f"""
    SELECT (SELECT count(*) FROM ({_ALERTS_SQL})) + {_REJECTED_SQL} AS received,
           count(*) AS valid,
           count(*) FILTER (WHERE windowStart > TIMESTAMP '{WATCH_START}') AS fresh,
           max(windowStart) AS last_window_start,
           count(*) FILTER (WHERE windowStart > TIMESTAMP '{WATCH_START}') > 0 AS has_fresh
    FROM ({_ALERTS_SQL})""")
def has_fresh_alert(spark, sf_dir):
    from trendstream.operators import watch as W
    return W.alert_summary(_alert_topic(spark, sf_dir), WATCH_START).withColumn(
        "last_window_start", F.col("last_window_start").cast("timestamp_ntz"))


@register("rejected_payloads", f"""
    SELECT (SELECT count(*) FROM ({_ALERTS_SQL})) + {_REJECTED_SQL} AS received,
           (SELECT count(*) FROM ({_ALERTS_SQL})) AS valid, {_REJECTED_SQL} AS rejected""")
def rejected_payloads(spark, sf_dir):
    from trendstream.operators import watch as W
    return W.rejected_payloads(_alert_topic(spark, sf_dir))


_REJECTED_ROWS_SQL = f"""
    SELECT regexp_replace(text, '[\\r\\n]', ' ', 'g') AS body, 'not one JSON object' AS reason FROM conversations
    UNION ALL SELECT body[:length(body) - 12], 'not one JSON object' FROM ({_alert_json_sql(_ALERTS_SQL)})
    UNION ALL SELECT body || ' and more', 'not one JSON object' FROM ({_alert_json_sql(_ALERTS_SQL)})
    UNION ALL SELECT NULL, 'no payload' FROM region"""


@register("rejected_payload_rows", _REJECTED_ROWS_SQL)
def rejected_payload_rows(spark, sf_dir):
    """What the watcher skips, as rows with the reason."""
    from trendstream.operators import watch as W
    return W.rejected_rows(_alert_topic(spark, sf_dir))


@register("stream_dead_letters", "SELECT regexp_replace(text, '[\\r\\n]', ' ', 'g') AS body FROM documents WHERE text <> ''")
def stream_dead_letters(spark, sf_dir):
    """An enriched topic that also holds plain texts: a job keeps them in a table of their own."""
    from trendstream.session import fresh_path
    from trendstream.sources.topics import write_topic
    from trendstream.streaming import jobs as J
    cfg = J.PipelineConfig(root=fresh_path(spark, "dead-letters"))
    texts = _docs(spark, sf_dir).where("text <> ''").select(F.regexp_replace("text", "[\r\n]", " ").alias("body"))
    write_topic(enriched_json(spark, sf_dir), cfg.enriched_topic, "text")
    write_topic(texts, cfg.enriched_topic, "text")
    J.rejected_job(spark, cfg).awaitTermination()
    return spark.read.parquet(cfg.rejected_location)


@register("watch_finds_fresh_alert", f"""
    SELECT count(*) FILTER (WHERE windowStart > TIMESTAMP '{WATCH_START}') > 0 AS found,
           count(*) FILTER (WHERE windowStart > TIMESTAMP '2100-01-01') > 0 AS found_later
    FROM ({_ALERTS_SQL})""")
def watch_finds_fresh_alert(spark, sf_dir):
    """The deadline watch over the alerts topic of a configured pipeline."""
    from trendstream.session import fresh_path
    from trendstream.sources.topics import write_topic
    from trendstream.streaming import jobs as J
    cfg = J.PipelineConfig(root=fresh_path(spark, "watched"), max_files_per_trigger=_replay(spark, sf_dir)[1])
    write_topic(alert_json(spark, sf_dir), cfg.alerts_topic, "text")
    found = [J.watch_job(spark, cfg, at, deadline_minutes=0) for at in (WATCH_START, "2100-01-01 00:00:00")]
    return FX.read_table(spark, sf_dir, "region").limit(1).select(
        F.lit(found[0]).alias("found"), F.lit(found[1]).alias("found_later"))


# ------------------------------------------------- jobs under a limit
# Fixture (fixed values): payloads of a topic's file, and the alert threshold of its sparse topics.
LIMITED_ROWS_PER_FILE, LIMITED_THRESHOLD = 1500, 2
# Most files of a limited topic (fixed value): a longer history has larger files, not more micro-batches.
LIMITED_FILES = 24

_POST_TOPICS = ("SELECT ts, unnest([upper(event_type[1]) || event_type[2:], chr(CAST(65 + user_id % 20 AS INT)) || 'roup']) "
                "AS topic FROM events")
_POST_CLOSED_SQL = f"""
    SELECT * FROM ({_window_counts_sql(rows=_POST_TOPICS)})
    WHERE windowEnd <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE AND count >= {LIMITED_THRESHOLD}"""


def _limited_pipeline(spark, sf_dir, rows_per_file: int | None = None, parts: int = 2):
    """Posts of the events through the configured jobs, one file a micro-batch; the
    later half of the history is ingested first."""
    from trendstream.session import fresh_path
    from trendstream.streaming import jobs as J
    posts = FX.event_posts(spark, sf_dir)
    if rows_per_file is None:
        rows_per_file = max(LIMITED_ROWS_PER_FILE, -(-posts.count() // LIMITED_FILES))
    cfg = J.PipelineConfig(root=fresh_path(spark, "limited"), max_files_per_trigger=1, threshold=LIMITED_THRESHOLD,
                           rows_per_file=rows_per_file)
    from trendstream.sources.topics import time_slices
    for part in reversed(time_slices(posts, "created_at", parts)):
        J.ingest_job(part, cfg, time_col="created_at")
    J.enrichment_job(spark, cfg).awaitTermination()
    return cfg


@register("limited_alerts_job", _POST_CLOSED_SQL)
def limited_alerts_job(spark, sf_dir):
    """Ingest, enrichment and alert job with one file in each micro-batch: no window is lost."""
    from trendstream.operators import watch as W
    from trendstream.streaming import jobs as J
    from trendstream.streaming.runner import ProgressCounts
    cfg, counts = _limited_pipeline(spark, sf_dir), ProgressCounts()
    spark.streams.addListener(counts)
    try:
        counts.complete(J.alerts_job(spark, cfg))
    finally:
        spark.streams.removeListener(counts)
    alerts = W.parsed_alerts(cfg.read(spark, cfg.alerts_topic, stream=False))
    return alerts.select(F.col("windowStart").cast("timestamp_ntz").alias("windowStart"),
                         F.col("windowEnd").cast("timestamp_ntz").alias("windowEnd"), "topic", "count")


# Start time of the read that opens only later files (fixed value).
READ_SINCE = "2024-01-20 12:00:00"


@register("topic_read_since", f"""
    SELECT event_id, ts AS timestamp FROM events WHERE ts >= TIMESTAMP '{READ_SINCE}'""")
def topic_read_since(spark, sf_dir):
    """A bounded read of the enriched topic from a time on: the manifest tells which files to open."""
    from trendstream.sources.timeline import read_since
    from trendstream.streaming.ingest import enriched_time
    cfg = _limited_pipeline(spark, sf_dir)
    dec = T.decode_enriched(read_since(spark, cfg.enriched_topic, "text", READ_SINCE, enriched_time()))
    return dec.select(F.col("id").cast("bigint").alias("event_id"), T.event_time(dec, "timestamp").alias("timestamp"))


@register("topic_manifest", """
    SELECT count(*) AS payloads, min(ts) AS lowest, max(ts) AS highest, true AS in_order FROM events""")
def topic_manifest(spark, sf_dir):
    """The enriched topic's manifest: all payloads, and files of a write that don't overlap in time."""
    from pyspark.sql import Window
    from trendstream.sources.timeline import manifest
    cfg = _limited_pipeline(spark, sf_dir)
    files = manifest(spark, cfg.enriched_topic)                       # one row a file
    before = F.max("highest").over(Window.partitionBy("write").orderBy("lowest", "file").rowsBetween(
        Window.unboundedPreceding, -1))
    return files.withColumn("after", F.coalesce(F.col("lowest") >= before, F.lit(True))).agg(
        F.sum("rows").alias("payloads"), F.min("lowest").cast("timestamp_ntz").alias("lowest"),
        F.max("highest").cast("timestamp_ntz").alias("highest"), F.bool_and("after").alias("in_order"))


# ------------------------------------------- run kinds, consumers, hooks
@register("stream_memory_view", f"SELECT * FROM ({_CLOSED_SQL}) WHERE count >= {TR.ALERT_THRESHOLD}")
def stream_memory_view(spark, sf_dir):
    """The alert job in continuous mode towards an interactive in-memory table."""
    import uuid
    from trendstream.session import fresh_path
    from trendstream.sources.topics import read_topic
    from trendstream.streaming import pipelines as P
    from trendstream.streaming.runner import start
    view = f"alerts_{uuid.uuid4().hex[:12]}"
    topic = read_topic(spark, _enriched_topic(spark, sf_dir), "text", max_files_per_trigger=_replay(spark, sf_dir)[1])
    q = start(P.alerts(topic), sink="memory", checkpoint=fresh_path(spark, "memory") + ".chk",
              mode="continuous", interval="1 second", query_name=view)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.table(view).select(F.col("windowStart").cast("timestamp_ntz").alias("windowStart"),
                                    F.col("windowEnd").cast("timestamp_ntz").alias("windowEnd"), "topic", "count")


@register("two_consumers", f"""
    SELECT (SELECT 2 * count(*) FROM events) AS history_rows,
           (SELECT count(*) FROM ({_CLOSED_SQL}) WHERE count >= {TR.ALERT_THRESHOLD}) AS alert_rows""")
def two_consumers(spark, sf_dir):
    """History and alerts run at the same time over one topic, each from its own checkpoint."""
    from trendstream.operators import history as H
    from trendstream.session import fresh_path
    from trendstream.sources.topics import read_topic
    from trendstream.streaming import pipelines as P
    from trendstream.streaming.runner import start
    topic, loc, out = _enriched_topic(spark, sf_dir), fresh_path(spark, "history"), fresh_path(spark, "alerts")
    read = lambda: read_topic(spark, topic, "text", max_files_per_trigger=_replay(spark, sf_dir)[1])
    running = [H.start_stream(P.history(read()), loc, loc + ".chk"),
               start(P.alerts(read()), sink="parquet", path=out, checkpoint=out + ".chk")]
    for q in running:
        q.awaitTermination()
    alerts = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n"))
    return H.read_history(spark, loc).agg(F.count(F.lit(1)).alias("history_rows")).withColumn(
        "alert_rows", alerts.scalar())


@register("random_message_ids", """
    SELECT count(*) AS messages, 2 * count(*) AS history_rows, count(*) AS ids, 36 AS id_length FROM events""")
def random_message_ids(spark, sf_dir):
    """uuid() ids: one a message, shared by its topics (written once, as uuid() is not repeatable)."""
    from trendstream.session import materialize
    rows = materialize(T.history_rows(FX.enriched_events(spark, sf_dir), deterministic_ids=False), "random-ids")
    per_id = rows.groupBy("uniqueId").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(F.count_if(F.col("n") == 2).alias("messages"), F.sum("n").alias("history_rows"),
                      F.count(F.lit(1)).alias("ids"), F.max(F.length("uniqueId")).alias("id_length"))


@register("history_null_content", """
    SELECT substr(sha256(coalesce(content || chr(1), '') || CAST(ts AS VARCHAR)), 1, 36) AS uniqueId, content,
           CAST(ts AS VARCHAR) AS timestamp, 'en' AS language,
           unnest([event_type, 'user_' || CAST(user_id AS VARCHAR)]) AS topic
    FROM (SELECT *, CASE WHEN event_id % 5 <> 0 THEN props END AS content FROM events)""")
def history_null_content(spark, sf_dir):
    """Messages without a text keep a NULL content."""
    ev = FX.read_table(spark, sf_dir, "events").withColumn(
        "props", F.when(F.col("event_id") % 5 != 0, F.col("props")))
    return T.history_rows(FX.enriched_from_events(ev))


@register("search_second_page", f"""
    SELECT doc_id AS id FROM documents
    WHERE contains(lower(text), '{SEARCH_QUERY}') AND lang = '{SEARCH_LANG}'
    ORDER BY doc_id DESC LIMIT 20 OFFSET 20""")
def search_second_page(spark, sf_dir):
    """The page protocol: the first page's next request gives the second page."""
    from trendstream.sources import messages as SM
    source = SM.reader("search", spark, posts=FX.document_messages(spark, sf_dir))
    first = source.search(SM.SearchRequest(SEARCH_QUERY, lang=SEARCH_LANG, count=20))
    return source.search(first.next_request()).messages.select("id")


@register("language_and_entity_hooks", """
    SELECT doc_id, CASE WHEN contains(text, 'der') THEN 'de' ELSE 'en' END AS language,
           CASE WHEN contains(text, 'of') THEN ['of'] ELSE ['None'] END AS entities
    FROM documents""")
def language_and_entity_hooks(spark, sf_dir):
    """User functions in place of the built-in language scorer and entity extractor."""
    from trendstream.operators import service as SV
    language = SV.language_udf(lambda t: "de" if "der" in t else "")
    entities = SV.entities_udf(lambda t: ["of"] if "of" in t else [])
    return _docs(spark, sf_dir).select("doc_id", language("text").alias("language"), entities("text").alias("entities"))


# ------------------------------------------------------ declared operators


def _recent_sql(minutes: int) -> str:
    return f"""
    SELECT topic, count(*) AS count FROM ({_TOPIC_ROWS})
    WHERE ts > (SELECT max(ts) FROM events) - INTERVAL {minutes} MINUTE
    GROUP BY topic ORDER BY count DESC, topic LIMIT {LT.TOP_K}"""


@register("recent_trends", _recent_sql(LT.RECENT_MINUTES))
def recent_trends(spark, sf_dir):
    return LT.recent_trends(_topic_rows(spark, sf_dir), times=_topic_times(spark, sf_dir))


# Minutes of the leaders that a stream keeps up over the history (fixed value): a day.
LEADERS_MINUTES = 1440


@register("stream_recent_trends", f"""
    SELECT topic, count, CAST(row_number() OVER (ORDER BY count DESC, topic) AS INT) AS rank
    FROM ({_recent_sql(LEADERS_MINUTES)})""")
def stream_recent_trends(spark, sf_dir):
    """Leaders of the last day, kept up by a stream that takes the posts in any order, in several micro-batches."""
    from trendstream.session import fresh_path
    from trendstream.sources.topics import read_topic, write_topic
    from trendstream.streaming import leaders as LD
    from trendstream.streaming import pipelines as P
    topic, out = fresh_path(spark, "topic-shuffled"), fresh_path(spark, "leaders")
    slices, files = _replay(spark, sf_dir)
    posts = FX.enriched_events(spark, sf_dir)
    write_topic(P.enriched_bodies(posts).repartition(slices * files, F.xxhash64("body")), topic, "text")
    bodies = read_topic(spark, topic, "text", max_files_per_trigger=files)
    rows = T.explode_topics(T.decode_enriched(bodies, narrow=True), tz_aware=True)
    LD.start_leaders(rows, out, out + ".chk", minutes=LEADERS_MINUTES).awaitTermination()
    return LD.current(spark, out)


def _period_sql(unit: str) -> str:
    return f"""
    SELECT * FROM (
      SELECT period, topic, count, row_number() OVER (PARTITION BY period ORDER BY count DESC, topic) AS rank
      FROM (SELECT date_trunc('{unit}', ts) AS period, topic, count(*) AS count
            FROM ({_TOPIC_ROWS}) GROUP BY ALL))
    WHERE rank <= {LT.TOP_K}"""


@register("weekly_trends", _period_sql("week"))
def weekly_trends(spark, sf_dir):
    return LT.period_top_topics(_topic_rows(spark, sf_dir), "week")


@register("monthly_trends", _period_sql("month"))
def monthly_trends(spark, sf_dir):
    return LT.period_top_topics(_topic_rows(spark, sf_dir), "month")


def _rollup(spark, sf_dir) -> str:
    """The roll-up of the enriched topic, one slice a micro-batch, with the second micro-batch delivered again."""
    from trendstream.operators import rollup as RU
    from trendstream.session import fresh_path
    from trendstream.sources.topics import read_topic
    path = fresh_path(spark, "rollup")
    topic = read_topic(spark, _enriched_topic(spark, sf_dir), "text", max_files_per_trigger=_replay(spark, sf_dir)[1])
    rows = T.explode_topics(T.decode_enriched(topic, narrow=True), tz_aware=True)
    write = RU.batch_writer(path)

    def again(batch, batch_id):
        write(batch, batch_id)
        if batch_id == 1:
            write(batch, batch_id)
    from trendstream.streaming.runner import run_once
    run_once(rows, sink="foreachBatch", checkpoint=path + ".chk", foreach_batch=again)
    return path


@register("weekly_rollup", _period_sql("week"))
def weekly_rollup(spark, sf_dir):
    """Weekly leaders from counts kept up by a stream; the history is not read."""
    from trendstream.operators import rollup as RU
    return RU.top_topics(spark, _rollup(spark, sf_dir), "week")


@register("monthly_rollup", _period_sql("month"))
def monthly_rollup(spark, sf_dir):
    from trendstream.operators import rollup as RU
    return RU.top_topics(spark, _rollup(spark, sf_dir), "month")


@register("topic_anomaly", f"""
    SELECT windowStart, topic, count, round(a, 6) AS baseline_avg, round(s, 6) AS baseline_std,
           round(CASE WHEN s > 0 THEN (count - a) / s END, 6) AS z
    FROM (SELECT *, avg(count) OVER w AS a, stddev_samp(count) OVER w AS s
          FROM ({_window_counts_sql()})
          WINDOW w AS (PARTITION BY topic ORDER BY windowStart
                       ROWS BETWEEN {LT.ANOMALY_HISTORY} PRECEDING AND 1 PRECEDING))""")
def topic_anomaly(spark, sf_dir):
    return LT.topic_anomaly(TR.topic_counts(_topic_rows(spark, sf_dir)))


@register("sentiment_score", f"SELECT doc_id, {LT.sentiment_sql('text')} AS sentiment FROM documents")
def sentiment_score(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", LT.sentiment("text").alias("sentiment"))


# Seeds of the learned sentiment (fixed values): the lexicon and blaming words that the documents use.
PRAISE, BLAME = LT.POSITIVE_WORDS, [*LT.NEGATIVE_WORDS, "idiot", "stupid", "trash", "pathetic"]
SEED_LANG = "en"
_POLARITY_SQL = PO.sentiment_sql(PRAISE, BLAME, f"lang = '{SEED_LANG}'")


def _learned_sentiment(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", "lang", "text")
    model = PO.PolarityModel.learn(docs.where(F.col("lang") == SEED_LANG), praise=PRAISE, blame=BLAME)
    return PO.with_sentiment(docs, model)


@register("sentiment_learned", _POLARITY_SQL)
def sentiment_learned(spark, sf_dir):
    """Sentiment of every document by polarity learned from the seeds' company in texts of their language."""
    return _learned_sentiment(spark, sf_dir).select("doc_id", "sentiment")


@register("sentiment_learned_spread", f"""
    SELECT toxic, count(*) AS n, count(*) FILTER (WHERE sentiment < 0) AS blaming,
           count(*) FILTER (WHERE sentiment < 0 AND len(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}]+'),
               lambda x: list_contains({BLAME!r}, x))) = 0) AS without_seed
    FROM ({_POLARITY_SQL}) JOIN documents USING (doc_id) JOIN labels USING (doc_id) GROUP BY toxic""")
def sentiment_learned_spread(spark, sf_dir):
    """How far the seeds reach: documents that read as blaming, and those of them without a seed, by label."""
    told = _learned_sentiment(spark, sf_dir)
    labels = FX.read_table(spark, sf_dir, "labels", balanced=False).select("doc_id", "toxic")
    seeded = F.arrays_overlap(PO.words(F.coalesce("text", F.lit(""))), F.array(*[F.lit(w) for w in BLAME]))
    blaming = F.col("sentiment") < 0
    return (told.select("doc_id", blaming.alias("b"), (blaming & ~seeded).alias("s")).join(labels, "doc_id")
            .groupBy("toxic").agg(F.count(F.lit(1)).alias("n"), F.count_if("b").alias("blaming"), F.count_if("s").alias("without_seed")))


@register("new_alerts", f"""
    SELECT windowStart, windowEnd, topic, count FROM (
      SELECT *, lag(windowEnd) OVER (PARTITION BY topic ORDER BY windowStart) AS prev_end
      FROM ({_ALERTS_SQL}))
    WHERE prev_end IS NULL OR windowStart >= prev_end""")
def new_alerts(spark, sf_dir):
    return LT.new_alerts(threshold_alerts(spark, sf_dir))


# ------------------------------------------------------------ small scalars
@register("port_default", """
    SELECT o_orderkey,
           CASE WHEN regexp_full_match(o_orderpriority, '[0-9]+')
                THEN coalesce(TRY_CAST(o_orderpriority AS INTEGER), 1433) ELSE 1433 END AS port_from_priority,
           CASE WHEN regexp_full_match(CAST(o_orderkey AS VARCHAR), '[0-9]+')
                THEN coalesce(TRY_CAST(CAST(o_orderkey AS VARCHAR) AS INTEGER), 1433) ELSE 1433 END AS port_from_key
    FROM orders""")
def port_default(spark, sf_dir):
    from trendstream.operators import history as H
    o = FX.read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", H.jdbc_port("o_orderpriority").alias("port_from_priority"),
                    H.jdbc_port(F.col("o_orderkey").cast("string")).alias("port_from_key"))


@register("escape_quotes",
          "SELECT conv_id, turn, replace(text, '''', '''''') AS escaped FROM conversations")
def escape_quotes(spark, sf_dir):
    c = FX.read_table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", F.replace("text", F.lit("'"), F.lit("''")).alias("escaped"))


# ---------------------------------------------------------------- service
@register("service_request_json", """
    SELECT doc_id, '{"documents":[{"id":"' || CAST(doc_id AS VARCHAR) || '","text":' || to_json(text)
           || '}]}' AS request FROM documents""")
def service_request_json(spark, sf_dir):
    from trendstream.operators import service as SV
    return _docs(spark, sf_dir).select("doc_id", SV.language_request("doc_id", "text").alias("request"))


@register("service_reply_parsed", """
    SELECT doc_id, CASE WHEN doc_id % 7 IN (0, 1, 2) THEN 'en' ELSE lang END AS language FROM documents""")
def service_reply_parsed(spark, sf_dir):
    """Replies of a language service made from the documents' languages, in the forms
    that have to be read: padded with blanks, an empty code, no language, no document."""
    from trendstream.operators import service as SV
    code = lambda c: F.array(F.struct(c.alias("name"), c.alias("iso6391Name"), F.lit(1.0).alias("score")))
    found = F.when(F.col("doc_id") % 7 == 0, F.filter(code(F.lit("")), lambda _: F.lit(False))) \
        .when(F.col("doc_id") % 7 == 1, code(F.lit(""))).otherwise(code(F.col("lang")))
    doc = F.struct(F.col("doc_id").cast("string").alias("id"), found.alias("detectedLanguages"))
    docs = F.when(F.col("doc_id") % 7 != 2, F.array(doc))
    reply = F.concat(F.lit("  "), F.to_json(F.struct(docs.alias("documents"))), F.lit("\n"))
    return _docs(spark, sf_dir).select("doc_id", SV.reply_language(reply).alias("language"))


_NEW_CLOSED_SQL = f"""
    SELECT windowStart, windowEnd, topic, count FROM (
      SELECT *, lag(windowEnd) OVER (PARTITION BY topic ORDER BY windowStart) AS prev_end
      FROM ({_CLOSED_SQL}) WHERE count >= {TR.ALERT_THRESHOLD})
    WHERE prev_end IS NULL OR windowStart >= prev_end"""

# Files of the shuffled alerts topic, at least (fixed value): one is read a micro-batch.
SHUFFLED_FILES = 10


@register("stream_new_alerts", _NEW_CLOSED_SQL)
def stream_new_alerts(spark, sf_dir):
    """events -> enriched topic -> alerts topic (JSON, shuffled) -> episodes, one file of the topic a micro-batch."""
    topic, span, last = _shuffled_alerts_topic(spark, sf_dir)
    return _read_alert_sink(spark, _run_episodes(spark, topic, span, last))


def _shuffled_alerts_topic(spark, sf_dir, threshold: int = TR.ALERT_THRESHOLD):
    """Alert payloads in no order of time over several files; the span of their event times and its end."""
    from trendstream.session import fresh_path
    from trendstream.sources.topics import write_topic
    from trendstream.streaming import pipelines as P
    alerts = _raised_alerts(spark, sf_dir, threshold)
    at = F.unix_micros("windowStart")
    found = alerts.agg(F.count(F.lit(1)).alias("n"), (F.max(at) - F.min(at)).alias("span"), F.max("windowStart").alias("last")).first()
    shuffled = fresh_path(spark, "topic-alerts")
    mixed = P.alert_bodies(alerts.repartition(max(SHUFFLED_FILES, found["n"] // 100_000), F.xxhash64("topic", "windowStart")))
    write_topic(mixed, shuffled, "text")
    return shuffled, f"{(found['span'] or 0) // 1_000_000 + 1} seconds", found["last"]


def _run_episodes(spark, topic: str, delay: str, last, limit: int = 1, form=None) -> str:
    """The episode stream (or another form over alerts) over a topic, brought to its end by a heartbeat."""
    import datetime as dt
    from trendstream.operators import watch as W
    from trendstream.session import fresh_path
    from trendstream.sources.topics import read_topic, write_topic
    from trendstream.streaming.episodes import alert_episodes, heartbeat, rocksdb_state
    from trendstream.streaming.runner import ProgressCounts, start
    out, counts = fresh_path(spark, "new-alerts"), ProgressCounts()
    end = (last or dt.datetime(2000, 1, 1)) + dt.timedelta(seconds=2 * TR.interval_seconds(delay))
    write_topic(heartbeat(spark, end), topic, "text")
    alerts = W.parsed_alerts(read_topic(spark, topic, "text", max_files_per_trigger=limit))
    spark.streams.addListener(counts)
    try:
        with rocksdb_state(spark):
            q = start((form or alert_episodes)(alerts, delay=delay), sink="parquet", path=out, checkpoint=out + ".chk")
        counts.complete(q)
    finally:
        spark.streams.removeListener(counts)
    return out


@register("stream_alert_baseline", f"""
    WITH RECURSIVE a AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY windowStart) AS rn
                         FROM ({_CLOSED_SQL}) WHERE count >= {TR.ALERT_THRESHOLD}),
    r AS (SELECT windowStart, windowEnd, topic, count, rn, CAST(NULL AS DOUBLE) AS m0, CAST(NULL AS DOUBLE) AS v0,
                 CAST(count AS DOUBLE) AS m, CAST(0 AS DOUBLE) AS v FROM a WHERE rn = 1
          UNION ALL
          SELECT a.windowStart, a.windowEnd, a.topic, a.count, a.rn, CASE WHEN old THEN NULL ELSE m END,
                 CASE WHEN old THEN NULL ELSE v END, CASE WHEN old THEN a.count ELSE m + 0.2 * (a.count - m) END,
                 CASE WHEN old THEN 0 ELSE 0.8 * (v + 0.2 * (a.count - m) * (a.count - m)) END
          FROM (SELECT r.*, a.windowStart >= r.windowEnd + INTERVAL 1 DAY AS old
                FROM r JOIN a ON a.topic = r.topic AND a.rn = r.rn + 1) p JOIN a ON a.topic = p.topic AND a.rn = p.rn + 1)
    SELECT windowStart, windowEnd, topic, count, round(m0, 6) AS baseline_avg, round(sqrt(v0), 6) AS baseline_std,
           round(CASE WHEN v0 > 0 THEN (count - m0) / sqrt(v0) END, 6) AS z FROM r""")
def stream_alert_baseline(spark, sf_dir):
    """Alert counts against their topic's running baseline, over the shuffled alerts topic."""
    from trendstream.streaming.baseline import running_baseline
    topic, span, last = _shuffled_alerts_topic(spark, sf_dir)
    found = spark.read.parquet(_run_episodes(spark, topic, span, last, limit=4, form=running_baseline))
    return found.select(F.col("windowStart").cast("timestamp_ntz").alias("windowStart"),
                        F.col("windowEnd").cast("timestamp_ntz").alias("windowEnd"), "topic", "count",
                        *[F.round(c, 6).alias(c) for c in ("baseline_avg", "baseline_std", "z")])


def _raised_alerts(spark, sf_dir, threshold: int) -> DataFrame:
    """The alert job's rows, read back from its topic."""
    from trendstream.operators import watch as W
    from trendstream.session import fresh_path, materialize
    from trendstream.sources.topics import producer_path, read_topic
    from trendstream.streaming import pipelines as P
    from trendstream.streaming.runner import run_once
    topic, raised = _enriched_topic(spark, sf_dir), fresh_path(spark, "topic-raised")
    run_once(P.alert_bodies(P.alerts(read_topic(spark, topic, "text", max_files_per_trigger=_replay(spark, sf_dir)[1]), threshold))
             .select(F.col("body").alias("value")),
             sink="text", path=producer_path(raised, "alerts"), checkpoint=raised + ".chk")
    return materialize(W.parsed_alerts(read_topic(spark, raised, "text", stream=False, producers=("alerts",))), "alerts")


@register("stream_new_alerts_at_once", _NEW_CLOSED_SQL)
def stream_new_alerts_at_once(spark, sf_dir):
    """The form that answers at once, over a topic in event-time slices."""
    from trendstream.session import fresh_path
    topic, delay = _alerts_topic(spark, sf_dir)
    out = fresh_path(spark, "new-alerts")
    _run_new_alert_stream(spark, topic, out, delay, _replay(spark, sf_dir)[1])
    return _read_alert_sink(spark, out)


def _alerts_topic(spark, sf_dir, threshold: int = TR.ALERT_THRESHOLD) -> tuple[str, str]:
    """The alert job's payloads, put in event-time slices, and the delay that covers a slice."""
    from trendstream.session import fresh_path
    from trendstream.sources.topics import time_slices, write_topic
    from trendstream.streaming import pipelines as P
    from trendstream.streaming.newalerts import slice_delay
    alerts_topic = fresh_path(spark, "topic-alerts")
    n_slices, files = _replay(spark, sf_dir)
    slices = time_slices(_raised_alerts(spark, sf_dir, threshold), "windowStart", n_slices)
    for part in slices:
        write_topic(P.alert_bodies(part), alerts_topic, "text", files=files)
    return alerts_topic, slice_delay(slices)


def _run_new_alert_stream(spark, topic: str, out: str, delay: str, files: int = FILES_A_SLICE):
    """One slice in each micro-batch; alerts dropped as late are an error, as episodes would be missing."""
    from trendstream.operators import watch as W
    from trendstream.sources.topics import read_topic
    from trendstream.streaming.newalerts import new_alerts_stream
    from trendstream.streaming.runner import rows_dropped_by_watermark, run_once
    alerts = W.parsed_alerts(read_topic(spark, topic, "text", max_files_per_trigger=files))
    q = run_once(new_alerts_stream(alerts, delay=delay), sink="parquet", path=out, checkpoint=out + ".chk")
    dropped = rows_dropped_by_watermark(q)
    if dropped:
        raise RuntimeError(f"{dropped} alerts came more than {delay} late and were dropped")
    return q


@register("stream_enriched_documents", f"""
    SELECT text AS content, {LG.detect_language_sql('text')} AS language,
           {EN.capitalised_entities_sql('text')} AS entities
    FROM documents""")
def stream_enriched_documents(spark, sf_dir):
    """Ingest documents to the raw topic, enrich them as a stream, read the enriched topic."""
    from trendstream.session import fresh_path
    from trendstream.sources.topics import read_topic
    from trendstream.sources.timeline import ORDERED
    from trendstream.streaming.ingest import ingest, start_enrichment
    raw, enriched = fresh_path(spark, "topic-raw"), fresh_path(spark, "topic-enriched")
    ingest(FX.document_messages(spark, sf_dir), raw)
    start_enrichment(spark, raw, enriched, enriched + ".chk").awaitTermination()
    dec = T.decode_enriched(read_topic(spark, enriched, "text", stream=False, producers=(ORDERED,)))
    return dec.select("content", "language", "entities")


@register("capture_dataset", f"""
    SELECT text, CAST(0 AS BIGINT) AS timestamp, source, 0 AS numOfShares, 0 AS numOfLikes,
           false AS isShareOrRetweet, lang, doc_id AS id,
           CAST(NULL AS MAP(VARCHAR, INTEGER)) AS reactions, CAST(NULL AS VARCHAR[]) AS topics,
           0.0::DOUBLE AS sentiment
    FROM documents WHERE contains(lower(text), '{SEARCH_QUERY}') AND lang = '{SEARCH_LANG}'
    ORDER BY doc_id DESC LIMIT 2000""")
def capture_dataset(spark, sf_dir):
    """Search a topic, keep the newest 2000 posts, save them as a message file, read it back."""
    from trendstream.operators import paging as PG
    from trendstream.session import fresh_path
    from trendstream.sources import messages as SM
    path = fresh_path(spark, "dataset")
    page = PG.search(FX.document_messages(spark, sf_dir), SEARCH_QUERY, SEARCH_LANG, PG.CAPTURE_SIZE)
    SM.write_messages(page, path)
    return SM.read_messages_json(spark, path)


@register("service_calls_once_a_text", """
    SELECT doc_id, CASE WHEN length(text) % 2 = 0 THEN 'de' ELSE 'en' END AS language, false AS failed FROM documents""")
def service_calls_once_a_text(spark, sf_dir):
    """A service that answers by a text's length parity, called under limits: each different text is sent once."""
    import json
    from trendstream.operators import service as SV

    def call(request):
        return json.dumps({"documents": [{"id": d["id"], "detectedLanguages": [{"iso6391Name": "en" if len(d["text"]) % 2 else "de"}]}
                                         for d in json.loads(request)["documents"]]})
    told = SV.call_once_a_text(_docs(spark, sf_dir).select("doc_id", "text"), call,
                               lambda key, text: F.to_json(F.struct(key.alias("id"), text.alias("text"))))
    return told.select("doc_id", SV.reply_language("reply").alias("language"), F.col("error").isNotNull().alias("failed"))


@register("service_entities_parsed",
          f"SELECT doc_id, {EN.capitalised_entities_sql('text')} AS entities FROM documents")
def service_entities_parsed(spark, sf_dir):
    """Replies of an entity service made from the documents' capitalised runs: a list,
    one run as a single object, none as a document without entities."""
    from trendstream.operators import service as SV
    runs = F.regexp_extract_all("text", F.lit(EN.CAPITALISED_RUN), 0)
    docs = _docs(spark, sf_dir).select("doc_id", F.transform(runs, lambda r: F.struct(r.alias("name"))).alias("runs"))
    id_ = F.col("doc_id").cast("string").alias("id")
    reply = (F.when(F.size("runs") == 0, F.to_json(F.struct(F.array(F.struct(id_)).alias("documents"))))
             .when(F.size("runs") == 1, F.to_json(F.struct(F.array(
                 F.struct(id_, F.get("runs", F.lit(0)).alias("entities"))).alias("documents"))))
             .otherwise(F.to_json(F.struct(F.array(F.struct(id_, F.col("runs").alias("entities"))).alias("documents")))))
    return docs.select("doc_id", SV.reply_entities(reply).alias("entities"))
