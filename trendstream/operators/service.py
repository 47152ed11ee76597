"""Hook for a JSON text-analytics service (language, entities).

Requests and replies are built and parsed with built-in JSON functions; the
call itself runs in ``mapInPandas``, many documents per request, with
bounded retries.  The network client is supplied by the caller as a plain
function ``call(request_json) -> reply_json``.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendstream.functions.entities import NO_ENTITIES, or_none
from trendstream.functions.lang import DEFAULT_LANGUAGE
from trendstream.schemas import ENTITIES_REPLY, LANGUAGE_REPLY

# Documents per service request, attempts per request (fixed values).
DOCS_PER_CALL = 100
MAX_ATTEMPTS = 4


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def language_request(id_col="id", text="text") -> Column:
    """{"documents":[{"id":..., "text":...}]}"""
    return F.concat(F.lit('{"documents":['), language_document(id_col, text), F.lit("]}"))


def entities_request(id_col="id", language="language", text="text") -> Column:
    """{"documents":[{"id":..., "language":..., "text":...}]}"""
    return F.concat(F.lit('{"documents":['), entities_document(id_col, language, text), F.lit("]}"))


def reply_language(reply="reply") -> Column:
    """documents[0].detectedLanguages[0].iso6391Name; 'en' when any part is missing or empty."""
    doc = F.get(F.from_json(F.trim(_c(reply)), LANGUAGE_REPLY)["documents"], 0)
    code = F.get(doc["detectedLanguages"], 0)["iso6391Name"]
    return F.coalesce(F.nullif(code, F.lit("")), F.lit(DEFAULT_LANGUAGE))


def reply_entities(reply="reply") -> Column:
    """Names of documents[0].entities (a list or a single object); ["None"] when absent."""
    doc = F.get(F.from_json(F.trim(_c(reply)), ENTITIES_REPLY)["documents"], 0)
    names = F.transform(F.from_json(doc["entities"], "array<struct<name:string>>"), lambda e: e["name"])
    return or_none(F.filter(names, lambda n: n.isNotNull()))


def language_document(id_col="id", text="text") -> Column:
    """One document of a language request: {"id":..., "text":...}"""
    return F.to_json(F.struct(_c(id_col).cast("string").alias("id"), _c(text).alias("text")))


def entities_document(id_col="id", language="language", text="text") -> Column:
    """One document of an entity request: {"id":..., "language":..., "text":...}"""
    return F.to_json(F.struct(_c(id_col).cast("string").alias("id"), _c(language).alias("language"),
                              _c(text).alias("text")))


def split_reply(reply: str) -> dict[str, str]:
    """Reply of many documents -> id -> reply of that document alone."""
    return {str(d.get("id")): json.dumps({"documents": [d]}, ensure_ascii=False)
            for d in (json.loads(reply).get("documents") or [])}


def call_service(df: DataFrame, call: Callable[[str], str], document: str = "document",
                 key: str = "id", docs_per_call: int = DOCS_PER_CALL,
                 max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """(key, document) rows -> (key, reply) rows.

    One request holds up to ``docs_per_call`` documents; its reply is taken
    apart by document id, and a document without an answer has a NULL reply.
    A failing request is repeated up to ``max_attempts`` times.
    """
    from trendstream.session import ship_package
    ship_package(df.sparkSession)
    key_type = df.schema[key].dataType.simpleString()

    def run(batches):
        import pandas as pd
        for pdf in batches:
            for lo in range(0, len(pdf), docs_per_call):
                part = pdf.iloc[lo:lo + docs_per_call]
                request = '{"documents":[' + ",".join(part[document]) + "]}"
                for attempt in range(max_attempts):
                    try:
                        replies = split_reply(call(request))
                        break
                    except Exception:
                        if attempt == max_attempts - 1:
                            raise
                        time.sleep(min(2 ** attempt, 30))
                yield pd.DataFrame({key: part[key].values,
                                    "reply": [replies.get(str(k)) for k in part[key]]})

    return df.select(key, document).mapInPandas(run, f"{key} {key_type}, reply string")


class Throttled(Exception):
    """A client raises this when the service asks to wait; ``seconds`` is for how long."""

    def __init__(self, seconds: float = 1.0):
        super().__init__(f"throttled for {seconds} s")
        self.seconds = seconds


def _answer(call: Callable[[str], str], request: str, max_attempts: int, max_wait: float) -> tuple[dict, str | None]:
    """Replies by id and no error, or none and the last error.

    Being throttled costs no attempt, but no more than ``max_wait`` seconds are
    spent waiting for one request.
    """
    failed, waited = 0, 0.0
    while True:
        try:
            return split_reply(call(request)), None
        except Throttled as e:
            pause, error = e.seconds, e
        except Exception as e:
            failed += 1
            pause, error = min(2 ** (failed - 1), 30), e
        if failed >= max_attempts or waited + pause > max_wait:
            return {}, f"{type(error).__name__}: {error}"
        time.sleep(pause)
        waited += pause


def call_once_a_text(df: DataFrame, call: Callable[[str], str], document: Callable[[Column, Column], Column],
                     text: str = "text", docs_per_call: int = DOCS_PER_CALL, requests_per_second: float | None = None,
                     tasks: int = 4, max_attempts: int = MAX_ATTEMPTS, max_wait: float = 120.0) -> DataFrame:
    """``df`` plus ``reply`` and ``error``: a service call under limits.

    Equal texts are sent once, however many rows hold them, and their reply goes
    to all of them.  ``document`` makes a document of an id and a text column.
    ``tasks`` tasks share ``requests_per_second``, so the service sees no more
    than that whatever the cluster's size.  A request that fails
    for good (attempts or waiting used up) is no end of the job: its rows have a
    NULL reply and the error.  Rows with a NULL text are not sent.  The replies
    are written once, so that nothing is asked again.
    """
    from trendstream.session import materialize, ship_package
    ship_package(df.sparkSession)
    keyed = df.withColumn("_sha", F.sha2(F.col(text).cast("binary"), 256))
    once = (keyed.where(F.col("_sha").isNotNull()).groupBy("_sha").agg(F.first(text).alias("_text"))
            .select("_sha", document(F.col("_sha"), F.col("_text")).alias("_document")))
    pause = tasks / requests_per_second if requests_per_second else 0.0

    def run(batches):
        import pandas as pd
        ready = 0.0
        for pdf in batches:
            for lo in range(0, len(pdf), docs_per_call):
                part = pdf.iloc[lo:lo + docs_per_call]
                time.sleep(max(0.0, ready - time.monotonic()))
                ready = time.monotonic() + pause
                replies, error = _answer(call, '{"documents":[' + ",".join(part["_document"]) + "]}", max_attempts, max_wait)
                yield pd.DataFrame({"_sha": part["_sha"].values, "reply": [replies.get(k) for k in part["_sha"]], "error": error})

    asked = materialize(once.repartition(tasks, "_sha").mapInPandas(run, "_sha string, reply string, error string"), "service-replies")
    return keyed.join(asked.hint("merge"), "_sha", "left").drop("_sha")


def language_udf(detect: Callable[[str], str]):
    """Wrap a per-text language function as an Arrow-batched pandas UDF
    (alternative body of the language column; the built-in scorer is the default)."""
    from pyspark.sql import SparkSession
    from pyspark.sql.functions import pandas_udf

    from trendstream.session import ship_package
    if SparkSession.getActiveSession() is not None:
        ship_package(SparkSession.getActiveSession())

    @pandas_udf("string")
    def run(texts):
        return texts.map(lambda t: DEFAULT_LANGUAGE if t is None else (detect(t) or DEFAULT_LANGUAGE))
    return run


def entities_udf(extract: Callable[[str], list]):
    """Wrap a per-text entity function as a pandas UDF; empty results become ["None"]."""
    from pyspark.sql import SparkSession
    from pyspark.sql.functions import pandas_udf

    from trendstream.session import ship_package
    if SparkSession.getActiveSession() is not None:
        ship_package(SparkSession.getActiveSession())

    @pandas_udf("array<string>")
    def run(texts):
        return texts.map(lambda t: (extract(t) if t is not None else None) or list(NO_ENTITIES))
    return run
