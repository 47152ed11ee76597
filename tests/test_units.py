"""Unit behaviour: message projection, sources, search arguments, codecs and edges."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from trendstream.functions import codec
from trendstream.functions import entities as EN
from trendstream.functions import lang as LG
from trendstream.operators import history as H
from trendstream.operators import messages as M
from trendstream.operators import paging as PG
from trendstream.operators import service as SV
from trendstream.operators import topics as T
from trendstream.operators import trends as TR
from trendstream.operators import watch as W
from trendstream.schemas import ENRICHED
from trendstream.session import fresh_path
from trendstream.sources import messages as SM

STATUS_DATE = dt.datetime(2024, 3, 1, 12, 30, 15, 250000)


def _status(spark, is_retweet):
    # One status, with more shares than likes.
    return spark.createDataFrame(
        [Row(id=41, text="first light", created_at=STATUS_DATE, retweet_count=17, favorite_count=3,
             is_retweet=is_retweet, lang="de")],
        "id long, text string, created_at timestamp_ntz, retweet_count int, favorite_count int, "
        "is_retweet boolean, lang string")


@pytest.mark.parametrize("is_retweet", [False, True])
def test_status_projection(spark, is_retweet):
    m = M.project_statuses(_status(spark, is_retweet)).first()
    assert m.id == 41 and m.text == "first light" and m.source == "Twitter"
    assert m.isShareOrRetweet is is_retweet and m.numOfShares == 17


def test_status_projection_timestamp_and_sentiment(spark):
    m = M.project_statuses(_status(spark, False)).first()
    epoch = dt.datetime(1970, 1, 1)
    assert m.timestamp == (STATUS_DATE - epoch) // dt.timedelta(milliseconds=1)
    assert abs(m.sentiment - 0.0) < 0.001


def test_search_request_text_only():
    r = SM.SearchRequest("harbour")
    assert r.query == "harbour" and r.lang is None and r.count == PG.PAGE_SIZE and r.max_id == -1


def test_search_request_lang_and_count(spark):
    r = SM.SearchRequest("harbour", lang="nl", count=640)
    posts = spark.createDataFrame([(i, f"ships in the harbour {i}", "nl" if i % 2 else "en")
                                   for i in range(2000)], "id long, text string, lang string")
    page, cursor = SM.reader("search", spark, posts=posts).search(r)
    ids = [x.id for x in page.collect()]
    assert len(ids) == 640 and ids == sorted(ids, reverse=True) and ids[0] == 1999
    assert cursor == min(ids) - 1


def _message_file(tmp_dir, rows):
    path = f"{tmp_dir}/two_posts.json"
    with open(path, "w") as f:
        json.dump(rows, f, indent=2)
    return path


def test_file_source_keeps_order_and_defaults(spark, tmp_path):
    path = _message_file(tmp_path, [{"text": "low tide"}, {"text": "high tide"}])
    df, cursor = SM.reader("fixed", spark, path=path).search(SM.SearchRequest("ignored"))
    rows = df.collect()
    assert [r.text for r in rows] == ["low tide", "high tide"] and cursor is None
    r = rows[0]
    assert (r.numOfShares, r.numOfLikes, r.isShareOrRetweet, r.id, r.timestamp) == (0, 0, False, 0, 0)
    assert r.source is None and r.reactions is None and r.topics is None


def test_fixed_source_in_memory_not_empty(spark):
    df = SM.fixed_messages(spark, [Row(text="ebb", timestamp=None, source=None, numOfShares=None,
                                       numOfLikes=None, isShareOrRetweet=None, lang=None, id=None,
                                       reactions={"like": 2}, topics=["a"], sentiment=None)])
    r = df.first()
    assert df.count() == 1 and r.numOfShares == 0 and r.reactions == {"like": 2} and r.topics == ["a"]


def test_unknown_source_kind(spark):
    with pytest.raises(ValueError):
        SM.reader("other", spark)


def test_message_file_round_trip(spark):
    path = fresh_path(spark, "msgs")
    src = SM.fixed_messages(spark, [Row(text=t, timestamp=1, source="s", numOfShares=1, numOfLikes=2,
                                        isShareOrRetweet=True, lang="en", id=i, reactions=None,
                                        topics=["x", "y"], sentiment=0.5)
                                    for i, t in enumerate(["a", "b", "c"])])
    SM.write_messages(src, path)
    back = SM.read_messages_json(spark, path, json_array=False)
    assert sorted(back.collect()) == sorted(src.collect())


# ------------------------------------------------------------- enriched edges
ENRICHED_EDGE = [
    '{"content":"a","timestamp":"2024-01-01 00:00:00","language":"en","entities":["Brunnfeld","Alte Warte"]}',
    '{"content":"b","timestamp":"2024-01-01 00:00:00","language":"en","entities":[]}',
    '{"content":"c","timestamp":"2024-01-01 00:00:00","language":"en","entities":null}',
    '{"content":"d","timestamp":"2024-01-01 00:00:00","language":"en","entities":[null]}',
    '{"content":"e","timestamp": not json',
    '{"content":null,"timestamp":"2024-01-01 00:00:00","language":"en","entities":["x"]}',
    '{"content":"g","timestamp":"2024-01-01 00:00:00","language":"en","entities":["y"],"extra":1}',
]


def test_enriched_edges(spark):
    bodies = spark.createDataFrame([(b,) for b in ENRICHED_EDGE], "body string")
    rows = T.explode_topics(T.decode_enriched(bodies)).collect()
    assert sorted((r.topic or "<null>") for r in rows) == ["<null>", "Alte Warte", "Brunnfeld", "x", "y"]
    hist = T.history_rows(T.decode_enriched(bodies)).collect()
    ids = {r.topic: r.uniqueId for r in hist if r.topic in ("Brunnfeld", "Alte Warte")}
    assert ids["Brunnfeld"] == ids["Alte Warte"] and len(ids["Brunnfeld"]) == 36
    assert [r.content for r in hist if r.topic == "x"] == [None]


def test_enriched_json_keeps_key_order_and_nulls(spark):
    df = spark.createDataFrame([("hi", None, "en", ["a"], None)], ENRICHED)
    body = df.select(codec.enriched_json().alias("b")).first().b
    assert body == '{"content":"hi","timestamp":null,"language":"en","entities":["a"]}'


def test_random_ids_identify_the_message(spark):
    bodies = spark.createDataFrame([(ENRICHED_EDGE[0],)], "body string")
    hist = T.history_rows(T.decode_enriched(bodies), deterministic_ids=False).collect()
    assert len({r.uniqueId for r in hist}) == 1 and len(hist) == 2


# ------------------------------------------------------------ threshold edge
def _rows(spark, spec):
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    data = [(base + dt.timedelta(seconds=s), topic) for topic, secs in spec for s in secs]
    return spark.createDataFrame(data, "ts timestamp_ntz, topic string")


def test_threshold_edge_4_5_6(spark):
    rows = _rows(spark, [("four", [1, 2, 3, 4]), ("five", [1, 2, 3, 4, 5]),
                         ("six", [1, 2, 3, 4, 5, 6])])
    alerts = TR.threshold(TR.topic_counts(rows), 5).collect()
    topics = {r.topic for r in alerts}
    assert topics == {"five", "six"}
    # all rows sit in minute 0, which belongs to the 10 windows starting -9..0 min
    assert len(alerts) == 20 and {r["count"] for r in alerts if r.topic == "six"} == {6}


def test_alert_json_format(spark):
    rows = _rows(spark, [("t", [1, 2, 3, 4, 5])])
    bodies = TR.alert_bodies(TR.threshold(TR.topic_counts(rows), 5)).collect()
    assert '{"windowStart":"2024-01-01 00:00:00","windowEnd":"2024-01-01 00:10:00","topic":"t","count":5}' \
        in [b.body for b in bodies]


def test_window_counts_match_direct_window(spark):
    rows = _rows(spark, [("a", list(range(0, 3600, 37))), ("b", list(range(5, 3600, 301)))])
    fast = TR.topic_counts(rows).collect()
    direct = TR._topic_counts_direct(rows, "10 minutes", "1 minute", "ts", "topic").collect()
    assert sorted(fast) == sorted(direct)


# ---------------------------------------------------------------- watch edge
def test_watch_strictly_after_start(spark):
    start = "2024-01-01 10:00:00"

    def alert(ws):
        return json.dumps({"windowStart": ws, "windowEnd": ws, "topic": "t", "count": 5})
    bodies = spark.createDataFrame(
        [(alert("2024-01-01 09:59:59"),), (alert("2024-01-01 10:00:00"),),
         (alert("2024-01-01 10:00:01"),), ("garbage",), (None,),
         (json.dumps({"windowStart": "not a date"}),)], "body string")
    fresh = W.fresh_alerts(bodies, start).collect()
    assert [r.windowStart for r in fresh] == [dt.datetime(2024, 1, 1, 10, 0, 1)]
    s = W.alert_summary(bodies, start).first()
    assert (s.received, s.valid, s.fresh, s.has_fresh) == (6, 3, 1, True)
    assert W.has_fresh(bodies, start) and not W.has_fresh(bodies, "2024-01-01 10:00:01")
    assert W.wait_for(lambda: bodies, start, deadline_minutes=0)
    assert not W.wait_for(lambda: bodies, "2030-01-01 00:00:00", deadline_minutes=0)


# -------------------------------------------------------------------- paging
def test_paging_250_ids(spark):
    posts = spark.createDataFrame([(i, "post", "en") for i in range(1, 251)], "id long, text string, lang string")
    paged = PG.rank_pages(posts, count=100)
    cur = {r.page: (r.n, r.min_id, r.next_max_id) for r in PG.page_cursors(paged).collect()}
    assert cur == {1: (100, 151, 150), 2: (100, 51, 50), 3: (50, 1, 0)}
    # interactive walk: 100, 100, 50, then an empty page
    sizes, cursor = [], None
    while True:
        page, nxt = PG.search_page(posts, count=100, max_id=cursor)
        sizes.append(page.count())
        if nxt is None:
            break
        cursor = nxt
    assert sizes == [100, 100, 50, 0]
    empty = posts.where(F.lit(False))
    assert empty.agg(PG.page_min_id(empty).alias("m")).first().m == 9223372036854775807


def test_drop_shares_moves_cursor(spark):
    rows = [(i, "t", i % 3 == 0) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "id long, text string, isShareOrRetweet boolean")
    out = M.drop_shares(PG.rank_pages(df, count=5)).collect()
    assert sorted(r.id for r in out) == [1, 2, 4, 5, 7, 8, 10]
    # page 2 holds ids 5..1; its cursor is min(id)-1 = 0 even though id 3 is a share
    assert {r.next_max_id for r in out if r.page == 2} == {0}


# ---------------------------------------------------------- language, entities
def test_language_detection(spark):
    df = spark.createDataFrame([("The cat and the dog",), ("Der Hund und die Katze",),
                                ("Le chat et la souris",), ("El perro y los gatos",),
                                ("zzz qqq",), (None,), ("",)], "text string")
    got = [r.l for r in df.select(LG.detect_language("text").alias("l")).collect()]
    assert got == ["en", "de", "fr", "es", "en", "en", "en"]


def test_language_tie_goes_to_first_language(spark):
    df = spark.createDataFrame([("the der",)], "text string")
    assert df.select(LG.detect_language("text").alias("l")).first().l == "en"


def test_capitalised_entities(spark):
    df = spark.createDataFrame([("we walked from Brunnfeld up to the Alte Warte before noon.",),
                                ("nothing here",), (None,)], "text string")
    got = [r.e for r in df.select(EN.capitalised_entities("text").alias("e")).collect()]
    # "I" is no run: a capitalised word needs at least one lower-case letter
    assert got == [["Brunnfeld", "Alte Warte"], ["None"], ["None"]]


def test_gazetteer_entities_literal_form(spark):
    df = spark.createDataFrame([("from Brunnfeld you can see the Alte Warte",), ("no hit",), (None,)],
                               "text string")
    got = [r.e for r in df.select(EN.gazetteer_entities("text", ["Brunnfeld", "Alte Warte"]).alias("e"))
           .collect()]
    assert got == [["Brunnfeld", "Alte Warte"], ["None"], ["None"]]


def test_dictionary_join_salted_path_equals_broadcast(spark):
    from trendstream.operators import enrich as ER
    docs = spark.createDataFrame([(i, f"Alpha went to Beta with Gamma {i}") for i in range(50)]
                                 + [(100, "nothing"), (101, None)], "doc_id long, text string")
    d = ER.entity_dictionary(docs, 10)
    a = sorted(ER.tag_entities(docs, d).collect())
    b = sorted(ER.tag_entities(docs, d, broadcast_max_bytes=0, salts=4).collect())
    assert a == b
    assert dict((r.doc_id, r.entities) for r in a)[0] == ["Alpha", "Beta", "Gamma"]
    assert dict((r.doc_id, r.entities) for r in a)[100] == ["None"]


# ---------------------------------------------------------- service replies
LANGUAGE_REPLIES = [
    ('{"documents":[{"id":"1","detectedLanguages":[{"iso6391Name":"fr"}]}]}', "fr"),
    ('{"documents":[]}', "en"),
    ('{"documents":[{"id":"1","detectedLanguages":[]}]}', "en"),
    ('{"documents":[{"id":"1","detectedLanguages":[{"iso6391Name":""}]}]}', "en"),
    ('  {"documents":[{"id":"1","detectedLanguages":[{"iso6391Name":"de"}]}]}  ', "de"),
    ("not json", "en"),
]

ENTITY_REPLIES = [
    ('{"documents":[{"id":"1","entities":[{"name":"Brunnfeld"},{"name":"Alte Warte"}]}]}',
     ["Brunnfeld", "Alte Warte"]),
    ('{"documents":[]}', ["None"]),
    ('{"documents":[{"id":"1"}]}', ["None"]),
    ('{"documents":[{"id":"1","entities":{"name":"Brunnfeld"}}]}', ["Brunnfeld"]),
    ('{"documents":[{"id":"1","entities":[]}]}', ["None"]),
]


def test_language_reply_edges(spark):
    df = spark.createDataFrame([(r,) for r, _ in LANGUAGE_REPLIES], "reply string")
    got = [r.l for r in df.select(SV.reply_language("reply").alias("l")).collect()]
    assert got == [e for _, e in LANGUAGE_REPLIES]


def test_entity_reply_edges(spark):
    df = spark.createDataFrame([(r,) for r, _ in ENTITY_REPLIES], "reply string")
    got = [r.e for r in df.select(SV.reply_entities("reply").alias("e")).collect()]
    assert got == [e for _, e in ENTITY_REPLIES]


def test_service_call_batches_and_retries(spark, tmp_path):
    """Requests of up to 100 documents; each fails twice before it is answered, in whatever order, without one document."""
    log = str(tmp_path)

    def flaky(request):
        import hashlib
        import os
        docs = json.loads(request)["documents"]
        name = os.path.join(log, hashlib.sha1(request.encode()).hexdigest())
        with open(name, "a") as f:
            f.write(f"{len(docs)}\n")
        if len(open(name).readlines()) < 3:
            raise OSError("try again")
        return json.dumps({"documents": [{"id": d["id"], "detectedLanguages": [{"iso6391Name": "es"}]}
                                         for d in reversed(docs) if d["id"] != "7"]})
    df = spark.createDataFrame([(i, f"t{i}") for i in range(250)], "id long, text string").coalesce(1)
    req = df.select("id", SV.language_document("id", "text").alias("document"))
    rows = SV.call_service(req, flaky, docs_per_call=100).withColumn("l", SV.reply_language("reply")).collect()
    assert len(rows) == 250 and {r.l for r in rows if r.id != 7} == {"es"}
    assert [r.reply for r in rows if r.id == 7] == [None]
    assert all(json.loads(r.reply)["documents"][0]["id"] == str(r.id) for r in rows if r.id != 7)
    calls = [open(f"{log}/{f}").read().split() for f in os.listdir(log)]
    assert sorted(calls) == [["100"] * 3, ["100"] * 3, ["50"] * 3]


def test_service_call_gives_up_after_the_last_attempt(spark):
    def down(request):
        raise OSError("down")
    df = spark.createDataFrame([(1, "{}")], "id long, document string")
    with pytest.raises(Exception, match="down"):
        SV.call_service(df, down, max_attempts=1).collect()


def test_request_json_shape(spark):
    df = spark.createDataFrame([(1, "en", 'say "hi"')], "id long, language string, text string")
    r = df.select(SV.entities_request("id", "language", "text").alias("r")).first().r
    assert json.loads(r) == {"documents": [{"id": "1", "language": "en", "text": 'say "hi"'}]}


# ------------------------------------------------------------------- history
def test_port_default(spark):
    df = spark.createDataFrame([("1433",), ("5432",), ("",), (None,), ("12a",), ("99999999999",)], "p string")
    got = [r.port for r in df.select(H.jdbc_port("p").alias("port")).collect()]
    assert got == [1433, 5432, 1433, 1433, 1433, 1433]


def test_history_table_create_append_read(spark):
    loc = fresh_path(spark, "hist")
    bodies = spark.createDataFrame([(b,) for b in ENRICHED_EDGE], "body string")
    rows = T.history_rows(T.decode_enriched(bodies))
    name = "hist_" + loc.rsplit("-", 1)[-1]
    H.ensure_table(spark, loc, name)
    H.append_batch(rows, table=name)
    assert spark.table(name).count() == 5
    H.append_batch(rows, loc)  # a second writer appends to the folder directly
    H.refresh_partitions(spark, name)
    assert spark.table(name).count() == 10
    assert H.read_history(spark, loc).count() == 10
    assert H.read_history(spark, loc, since="2024-01-02").count() == 0


def test_history_topic_length_is_enforced(spark):
    loc = fresh_path(spark, "hist")
    name = "histlen_" + loc.rsplit("-", 1)[-1]
    H.ensure_table(spark, loc, name)
    long_topic = "x" * 300
    bodies = spark.createDataFrame(
        [('{"content":"a","timestamp":"2024-01-01 00:00:00","language":"en","entities":["%s"]}' % long_topic,)],
        "body string")
    with pytest.raises(Exception):
        H.append_batch(T.history_rows(T.decode_enriched(bodies)), table=name)


def test_default_message_file_from_session_setting(spark, tmp_path):
    path = _message_file(tmp_path, [{"text": "low tide"}, {"text": "high tide"}])
    spark.conf.set(SM.DEFAULT_MESSAGES_CONF, path)
    try:
        df, _ = SM.reader("fixed", spark).search(SM.SearchRequest("x"))
        assert df.count() > 0
    finally:
        spark.conf.unset(SM.DEFAULT_MESSAGES_CONF)


def test_pandas_udf_hooks(spark):
    df = spark.createDataFrame([("Salut Vernay",), (None,), ("",)], "text string")
    lang = SV.language_udf(lambda t: "fr" if "Salut" in t else "")
    ents = SV.entities_udf(lambda t: [w for w in t.split() if w[:1].isupper()])
    got = df.select(lang("text").alias("l"), ents("text").alias("e")).collect()
    assert [(r.l, list(r.e)) for r in got] == [("fr", ["Salut", "Vernay"]), ("en", ["None"]), ("en", ["None"])]


def test_weekly_trends_ignore_case(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 2), "Rust"), (dt.datetime(2024, 1, 3), "rust"),
                                  (dt.datetime(2024, 1, 3), "Go")], "ts timestamp_ntz, topic string")
    from trendstream.operators import longterm as LT
    got = {(r.topic, r["count"]) for r in LT.period_top_topics(rows, "week", ignore_case=True).collect()}
    assert got == {("rust", 2), ("go", 1)}


def test_observed_received_rows(spark):
    bodies = spark.createDataFrame(
        [(json.dumps({"windowStart": "2024-01-01 10:00:01", "windowEnd": "x", "topic": "t", "count": 5}),),
         ("garbage",), (None,)], "body string")
    df, obs = W.observed(bodies)
    fresh = W.fresh_alerts(df, "2024-01-01 10:00:00").count()
    assert fresh == 1 and obs.get == {"rows": 3, "valid": 1}


def test_dictionary_join_with_names_languages_and_ngrams(spark):
    from trendstream.operators import enrich as ER
    docs = spark.createDataFrame([(1, "from Brunnfeld you can see the alte warte", "en"),
                                  (2, "hacia Brunnfeld", "es"), (3, "nothing", "en")],
                                 "doc_id long, text string, lang string")
    gaz = spark.createDataFrame([("Brunnfeld", "Brunnfeld, AT", "en"), ("alte warte", "Alte Warte", "en"),
                                 ("Brunnfeld", "Brunnfeld (es)", "es")], "entity string, name string, language string")
    got = {r.doc_id: r.entities for r in ER.tag_entities(docs, gaz, candidates="ngrams",
                                                         doc_language="lang").collect()}
    assert got == {1: ["Alte Warte", "Brunnfeld, AT"], 2: ["Brunnfeld (es)"], 3: ["None"]}
    salted = {r.doc_id: r.entities for r in ER.tag_entities(docs, gaz, candidates="ngrams", doc_language="lang",
                                                            broadcast_max_bytes=0, salts=3).collect()}
    assert salted == got


def test_ngram_join_agrees_with_literal_gazetteer(spark):
    from trendstream.operators import enrich as ER
    from tests.conftest import SF_SMALL
    from trendstream.sources.tables import read_table
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    words = ["Le", "Der", "The", "El", "Die Das"]
    lit_form = {r.doc_id: sorted(r.e) for r in docs.select(
        "doc_id", EN.gazetteer_entities("text", words).alias("e")).collect()}
    join_form = {r.doc_id: sorted(r.entities) for r in ER.tag_entities(
        docs, spark.createDataFrame([(w,) for w in words], "entity string"), candidates="ngrams").collect()}
    assert join_form == lit_form


def test_page_protocol_walks_all_pages(spark):
    posts = spark.createDataFrame([(i, f"storm {i}", "en") for i in range(1, 251)], "id long, text string, lang string")
    src = SM.reader("search", spark, posts=posts)
    req, sizes = SM.SearchRequest("storm", lang="en", count=100), []
    while req is not None:
        page = src.search(req)
        assert page.request == req
        sizes.append(page.messages.count())
        req = page.next_request()
    assert sizes == [100, 100, 50, 0]


def test_dictionary_size_estimate_counts_every_text_column(spark):
    from trendstream.operators import enrich as ER
    d = spark.createDataFrame([("ab", "abcd"), ("c", None)], "entity string, name string")
    assert ER.estimated_bytes(d) == (2 + 4 + 1) + 2 * ER.ROW_OVERHEAD_BYTES


def test_history_replay_is_removed_on_read(spark):
    loc = fresh_path(spark, "hist-replay")
    bodies = spark.createDataFrame([(b,) for b in ENRICHED_EDGE], "body string")
    rows = T.history_rows(T.decode_enriched(bodies))
    H.append_batch(rows, loc)
    H.append_batch(rows, loc)  # the same batch delivered again
    assert H.read_history(spark, loc).count() == 10
    assert H.read_history(spark, loc, dedupe=True).count() == 5
