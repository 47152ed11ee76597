"""The learned language model against a plain version."""

import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from trendstream.functions import langmodel as LM
from trendstream.session import fresh_path

ROWS = [("the cat and the dog", "en"), ("Der Hund und die Katze", "de"), ("le chat et l'été", "fr"), ("the house is here", "en"),
        (None, "en"), ("no label", None), ("", "de"), ("ab", "fr"), ("ß" * 5000 + " und", "de"), ("the cat and the dog", "en")]


def trigram_buckets(text):
    low = text.lower()
    return [zlib.crc32(t.encode()) % LM.BUCKETS for t in {low[i:i + 3] for i in range(len(low) - 2)}]


def plain(rows):
    counts = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(trigram_buckets(text))
    out = {}
    for lang in sorted(k for k, c in counts.items() if c):
        total = sum(counts[lang].values())
        out[lang] = [math.floor(LM.SCALE * math.log((counts[lang][b] + 1) / (total + LM.BUCKETS)) + 0.5) for b in range(LM.BUCKETS)]
    return out


def test_weights_and_languages(spark):
    model = LM.LanguageModel.learn(spark.createDataFrame(ROWS, "text string, lang string"))
    want = plain(ROWS)
    assert list(model.weights) == ["de", "en", "fr"]
    # a value half-way between two integers may go either way
    assert all(abs(a - b) <= 1 for k in want for a, b in zip(model.weights[k], want[k]))
    asked = ["the dog", "die Katze", "l'été", "", None, "ab", "ß" * 4000, "zzz qqq", "THE CAT"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(asked)], "id int, text string, _score_0 string")
    for i, _, _, language in sorted(LM.with_language(df.drop("_score_0").withColumn("other", F.lit(1)), model).collect()):
        found = trigram_buckets(asked[i]) if asked[i] else []
        score = {k: sum(w[b] for b in found) for k, w in model.weights.items()}
        assert language == (min(score, key=lambda k: (-score[k], k)) if found else "en")


def test_saved_model_is_the_same(spark):
    model = LM.LanguageModel.learn(spark.createDataFrame(ROWS, "text string, lang string"))
    path = fresh_path(spark, "model")
    model.save(spark, path)
    assert LM.LanguageModel.load(spark, path) == model


def test_without_labels_every_text_has_the_default(spark):
    model = LM.LanguageModel.learn(spark.createDataFrame([], "text string, lang string"))
    assert model.weights == {}
    df = spark.createDataFrame([("any text",), (None,)], "text string")
    assert [r.language for r in LM.with_language(df, model).collect()] == ["en", "en"]
