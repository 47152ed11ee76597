"""The service call under limits, and rejected payloads as rows."""

import json
import time
import uuid

from pyspark.sql import functions as F

from trendstream.operators import service as SV
from trendstream.operators import topics as T
from trendstream.operators import watch as W


def document(key, text):
    return F.to_json(F.struct(key.alias("id"), text.alias("text")))


def client(folder, throttle=0, fail=(), log=True):
    """Answers with the text itself; the first ``throttle`` requests are told to wait; texts in ``fail`` never work."""
    def call(request):
        from trendstream.operators.service import Throttled
        docs = json.loads(request)["documents"]
        seen = len(list(folder.iterdir()))
        (folder / f"{time.time_ns()}-{uuid.uuid4().hex}").write_text(json.dumps([time.time(), [d["text"] for d in docs]]))
        if seen < throttle:
            raise Throttled(0.05)
        if any(d["text"] in fail for d in docs):
            raise OSError("no answer")
        return json.dumps({"documents": [{"id": d["id"], "echo": d["text"]} for d in docs]})
    return call


def requests(folder):
    return [json.loads(f.read_text()) for f in sorted(folder.iterdir())]


def test_equal_texts_are_sent_once_and_all_rows_answered(spark, tmp_path):
    rows = [(i, f"text {i % 7}") for i in range(200)] + [(500, None), (501, ""), (502, "")]
    out = SV.call_once_a_text(spark.createDataFrame(rows, "id long, text string").repartition(5), client(tmp_path), document,
                              docs_per_call=3, tasks=2).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.error is None and (r.reply is None) == (r.text is None)
        assert r.text is None or json.loads(r.reply)["documents"][0]["echo"] == r.text
    sent = [t for _, ts in requests(tmp_path) for t in ts]
    assert sorted(sent) == sorted({t for _, t in rows if t is not None})


def test_throttling_costs_no_attempt_and_failures_are_rows(spark, tmp_path):
    rows = [(i, f"t{i}") for i in range(12)]
    df = spark.createDataFrame(rows, "id long, text string")
    out = SV.call_once_a_text(df, client(tmp_path, throttle=6, fail=("t3",)), document, docs_per_call=1, tasks=1,
                              max_attempts=1).collect()
    assert {r.id for r in out if r.error} == {3} and [r.error for r in out if r.error] == ["OSError: no answer"]
    assert all(r.reply is None if r.error else r.reply for r in out) and len(out) == 12
    assert len(requests(tmp_path)) == 12 + 6


def test_waiting_has_a_bound(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id long, text string")
    out = SV.call_once_a_text(df, client(tmp_path, throttle=10 ** 6), document, max_wait=0.2).collect()
    assert out[0].reply is None and out[0].error.startswith("Throttled")


def test_request_rate(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(12)], "id long, text string")
    SV.call_once_a_text(df, client(tmp_path), document, docs_per_call=1, requests_per_second=20, tasks=2).collect()
    at = [t for t, _ in requests(tmp_path)]
    assert len(at) == 12 and max(at) - min(at) >= 0.35          # twelve requests at twenty a second, in two tasks


def test_rejected_rows_and_accepted_rows_are_all_rows(spark):
    good = '{"windowStart":"2024-01-15 00:00:00","windowEnd":"2024-01-15 00:10:00","topic":"t","count":7}'
    bodies = [good, good + "x", None, "{}", '{"windowStart":"no time"}', "plain"]
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    got = {r.body: r.reason for r in W.rejected_rows(df).collect()}
    assert got == {good + "x": "not one JSON object", None: "no payload", "{}": "no window start",
                   '{"windowStart":"no time"}': "no window start", "plain": "not one JSON object"}
    assert W.parsed_alerts(df).count() + len(got) == len(bodies)
    assert {r.body for r in T.rejected_payloads(df).collect()} == {good + "x", None, "plain"}
