"""The learned polarity against a plain version."""

import math
import random
import zlib

import pytest
import regex
from pyspark.sql import functions as F

from trendstream.functions import polarity as PO
from trendstream.session import fresh_path

PRAISE, BLAME = ["good", "great"], ["bad", "awful"]


def bucket(word):
    return zlib.crc32(word.encode()) % PO.BUCKETS


def words(text):
    return set(regex.findall(r"\p{L}+", text.lower()))


def plain(texts, praise=PRAISE, blame=BLAME):
    """bucket -> weight before rounding."""
    texts = [words(t) for t in texts if t is not None]
    total = len(texts)
    sides = [sum(bool(w & set(s)) for w in texts) for s in (praise, blame)]
    seen = {}
    for w in texts:
        for b in {bucket(x) for x in w}:
            c = seen.setdefault(b, [0, 0, 0])
            c[0] += 1
            c[1] += bool(w & set(praise))
            c[2] += bool(w & set(blame))
    out = {}
    for b, (c, *with_seed) in seen.items():
        logs, clear = [], False
        for n, of in zip(with_seed, sides):
            if not 0 < of < total:
                logs.append(0.0)
                continue
            share = of / total
            logs.append(math.log((n + PO.PRIOR * share) / ((c + PO.PRIOR) * share)))
            clear |= abs(n - c * share) >= PO.Z * math.sqrt(c * share * (1 - share))
        if c >= PO.MIN_TEXTS and clear:
            out[b] = PO.SCALE * (logs[0] - logs[1])
    return out


def corpus(seed=1, n=1500):
    rng = random.Random(seed)
    usual = [f"word{chr(97 + i)}" for i in range(26)]
    out = []
    for _ in range(n):
        w = rng.choices(usual, k=8)
        mood = rng.random()
        if mood < 0.15:
            w += [rng.choice(PRAISE), rng.choice(["sunny", "kind"])]
        elif mood < 0.3:
            w += [rng.choice(BLAME).upper(), rng.choice(["gloomy", "größlich"])]
        elif mood < 0.35:
            w += [rng.choice(["sunny", "gloomy"])]
        rng.shuffle(w)
        out.append(rng.choice([" ", ", ", "\n"]).join(w))
    return out + [None, "", "!!", out[0], out[0], "wordа " * 20000]


def learned(spark, texts, **kw):
    return PO.PolarityModel.learn(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5),
                                  praise=PRAISE, blame=BLAME, **kw)


def test_weights_and_scores(spark):
    texts = corpus()
    model, want = learned(spark, texts), plain(texts)
    got = {b: w for b, w in enumerate(model.weights) if w}
    assert set(got) == {b for b, w in want.items() if abs(w) > 0.5}
    assert all(abs(got[b] - want[b]) <= 0.51 for b in got)
    # words in the seeds' company take their side, others take none
    assert model.weights[bucket("sunny")] > 0 > model.weights[bucket("größlich")]
    assert model.weights[bucket("wordc")] == 0
    asked = [*texts[:50], None, "", "nothing here", "a SUNNY day", "gloomy gloomy gloomy sunny", "größlich " * 50000, "bad good"]
    df = spark.createDataFrame(list(enumerate(asked)), "id int, text string").withColumn("sentiment_", F.lit(1))
    for r in PO.with_sentiment(df, model).collect():
        w = [model.weights[bucket(x)] for x in words(asked[r.id] or "")]
        size = sum(map(abs, w))
        assert r.sentiment == pytest.approx(sum(w) / size if size else 0.0, abs=1e-6) and -1 <= r.sentiment <= 1
    told = {r.text: r.sentiment for r in PO.with_sentiment(df, model).collect()}
    assert told["a SUNNY day"] == 1.0 and told["größlich " * 50000] == -1.0 and told[None] == told[""] == told["nothing here"] == 0.0


def test_a_side_without_seeds_says_nothing(spark):
    texts = [t for t in corpus() if t is None or not words(t) & set(PRAISE)]
    model = learned(spark, texts)
    want = plain(texts)
    assert {b for b, w in enumerate(model.weights) if w} == {b for b, w in want.items() if abs(w) > 0.5} != set()
    assert set(learned(spark, ["no seed at all"] * 30).weights) == {0}
    assert set(learned(spark, ["all good"] * 30).weights) == {0}


def test_an_empty_table_and_a_saved_model(spark):
    none = PO.PolarityModel.learn(spark.createDataFrame([], "text string"))
    assert len(none.weights) == PO.BUCKETS and not any(none.weights)
    df = spark.createDataFrame([("any text",), (None,)], "text string")
    assert [r.sentiment for r in PO.with_sentiment(df, none).collect()] == [0.0, 0.0]
    model, path = learned(spark, corpus(2, 500)), fresh_path(spark, "polarity")
    model.save(spark, path)
    assert PO.PolarityModel.load(spark, path) == model and any(model.weights)


def test_the_same_column_in_a_stream(spark):
    model = learned(spark, corpus())
    path, out = fresh_path(spark, "posts"), fresh_path(spark, "scored")
    df = spark.createDataFrame([(t,) for t in corpus(3, 60)], "text string")
    df.write.parquet(path)
    from trendstream.streaming.runner import run_once
    run_once(PO.with_sentiment(spark.readStream.schema("text string").parquet(path), model), sink="parquet", path=out,
             checkpoint=out + ".chk")
    got = spark.read.parquet(out)
    assert got.exceptAll(PO.with_sentiment(df, model)).isEmpty() and got.count() == df.count()
