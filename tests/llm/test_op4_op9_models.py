"""Held-out accuracy and edge rows of the learned operators."""

import math
from zlib import crc32

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trendstream.llm import langid, quality
from trendstream.llm import queries as Q
from trendstream.session import ship_package
from tests.conftest import SF_MID

DDL = "doc_id long, text string, lang string, score string, lang_pred int"


def held(i):
    return crc32(("" if i is None else str(i)).encode()) % 5 == 0


@pytest.fixture(scope="module")
def mid(spark):
    ship_package(spark)
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").toPandas()
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").toPandas()
    return docs, labels


def test_op4_held_out_accuracy(spark, mid):
    got = Q.op4_quality(spark, SF_MID).toPandas()
    assert len(got) == len(mid[0]) and (got.held_out == got.doc_id.map(held)).all()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    g = got.merge(mid[1], on="doc_id").query("held_out")
    assert len(g) > 30 and (g.predicted == g.quality).mean() >= 0.95


def test_op9_held_out_accuracy(spark, mid):
    got = Q.op9_language(spark, SF_MID).toPandas()
    g = got.merge(mid[0], on="doc_id").query("held_out")
    assert len(got) == len(mid[0]) and got.score.between(0, 1).all()
    assert len(g) > 100 and (g.lang_pred == g.lang).mean() >= 0.95


def brute_features(text):
    words = text.split()
    out = [quality.END] + [quality.REPEAT] * sum(a == b for a, b in zip(words, words[1:]))
    for w in words:
        out += quality.word_features(w)
    return out


TEXTS = [None, "", " ", "a", "a a a", "The the THE!! %%% é漢", "x" * 5000, "long text " * 20000, "plain words here", "plain words here"]


def test_cached_scores_equal_the_average_of_all_features(spark):
    ship_package(spark)
    logits = np.random.default_rng(1).normal(size=quality.BUCKETS)
    rows = [(i if i != 4 else None, t, None, "clash", 0) for i, t in enumerate(TEXTS)]
    got = quality.with_scores(spark.createDataFrame(rows, DDL).repartition(2), logits).collect()
    want = {}
    for r in rows:
        f = brute_features(r[1] or "")
        want[r[0]] = 1 / (1 + math.exp(-np.mean(logits[f])))
    assert len(got) == len(rows) and all(abs(want[r.doc_id] - r.score) < 1e-9 for r in got)
    ids, counts = quality.document_features("a a b !! a")
    assert sorted(np.repeat(ids, counts)) == sorted(brute_features("a a b !! a"))


def test_quality_without_labels_or_rows(spark):
    ship_package(spark)
    labels = spark.createDataFrame([(None, 1), (5, None), (6, 7)], "doc_id long, quality int")
    docs = spark.createDataFrame([(1, "text", "en", "", 0)], DDL)
    assert not quality.fit(docs, labels).any()
    assert [r.score for r in quality.with_scores(docs, quality.fit(docs, labels)).collect()] == [0.5]
    assert quality.with_scores(spark.createDataFrame([], DDL), np.zeros(quality.BUCKETS)).collect() == []


def test_held_out_labels_are_never_learned_from(spark):
    ship_package(spark)
    ids = [i for i in range(200) if held(i)]
    docs = spark.createDataFrame([(i, "some text", "en", "", 0) for i in ids], DDL)
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    assert not quality.fit(docs, labels).any()
    assert langid.fit(docs) is None


def test_repeated_ids_take_one_place_in_a_sample(spark, monkeypatch):
    ids = [i for i in range(1, 200) if not held(i)][:60]
    first = ids[0]
    docs = spark.createDataFrame([(i, f"text number {i} {n}", "en", "s", 1) for i in ids for n in range(200 if i == first else 1)]
                                 + [(first, t, "en", "s", 1) for t in (None, "")], DDL)
    learned = []
    monkeypatch.setattr(langid, "train", lambda windows, labels, names: learned.append(len(labels)))
    monkeypatch.setattr(quality, "train", lambda ids, counts, label, weight, buckets: learned.append((len(ids), min(map(len, ids)))))
    langid.fit(docs, sample=100)
    langid.fit(docs.filter(F.col("doc_id") == first), sample=100)
    langid.fit(docs.withColumn("doc_id", F.col("doc_id") % 2 * 0 + first), sample=100)
    quality.fit(docs, spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int"))
    assert learned[:3] == [2 * len(ids), 2, 2]                          # each window whole and cut short
    assert learned[3][0] == len(ids) and learned[3][1] > 1


def test_a_much_repeated_id_leaves_the_sample_to_others(spark, monkeypatch):
    ids = [i for i in range(1, 200) if not held(i)][:60]
    learned = []
    monkeypatch.setattr(langid, "train", lambda windows, labels, names: learned.append(len(labels)))
    order = spark.createDataFrame([(i,) for i in ids], "i long").select("i", F.xxhash64("i", F.lit("en")).alias("h"))
    top = order.orderBy("h").first().i                                  # sorts first, so its copies took the sample
    docs = spark.createDataFrame([(i, f"text {i} {n}", "en", "s", 1) for i in ids for n in range(20 if i == top else 1)], DDL)
    langid.fit(docs, sample=20)
    assert learned == [2 * 20]


def test_language_edge_rows(spark, mid):
    ship_package(spark)
    net = langid.fit(spark.read.parquet(f"{SF_MID}/documents.parquet"))
    texts = [None, "", " \n", "123 !!", "½²", "the and that with of the", "der und die das nicht", "der und die das nicht",
             "é", "漢字", "the and of " * 30000]
    rows = [(i if i else None, t, None, "clash", 1) for i, t in enumerate(texts)]
    got = langid.with_language(spark.createDataFrame(rows, DDL).repartition(3), net).toPandas()
    assert len(got) == len(rows) and set(got.columns) == {"doc_id", "text", "lang", "lang_pred", "score"}
    by = {t: (x, s) for t, x, s in zip(got.text, got.lang_pred, got.score)}
    for t in ("", " \n", "123 !!", "½²"):
        assert by[t] == ("und", 0.0)
    assert got[got.text.isna()].lang_pred.tolist() == ["und"]
    assert by["der und die das nicht"][0] == "de" and by["the and of " * 30000][0] == "en"
    assert by["漢字"][0] in net.languages


def test_no_rows_to_learn_a_language_from(spark):
    ship_package(spark)
    docs = spark.createDataFrame([(1, "text", None, "", 0), (2, None, "en", "", 0)], DDL)
    assert langid.fit(docs) is None
    assert {(r.lang_pred, r.score) for r in langid.with_language(docs, None).collect()} == {("und", 0.0)}
    assert langid.with_language(spark.createDataFrame([], DDL), None).collect() == []


def test_windows_hold_every_byte_once():
    texts = [b"", b"abc", bytes(range(256)) * 3, b"x" * 256]
    windows, of = langid.windows_of(texts)
    for i, t in enumerate(texts):
        flat = windows[of == i].reshape(-1)
        assert bytes(flat[flat < 256].astype(np.uint8)) == t


def test_network_equals_a_plain_convolution():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 2, 40)
    windows = rng.integers(97, 110, (40, 32)).astype(np.int16) + 10 * labels[:, None].astype(np.int16)
    net = langid.train(windows, labels, ["a", "b"], epochs=15, rate=0.02)
    assert (net.log_probabilities(windows).argmax(axis=1) == labels).mean() > 0.9
    w = windows[0]
    padded = np.append(w, [langid.PAD] * 3)
    hidden = []
    for f in range(net.filters.shape[1]):
        k = net.filters[:, f].reshape(-1, langid.EMBED)
        best = max(sum(float(k[j] @ net.embed[padded[i + j]]) for j in range(len(k))) for i in range(len(w)))
        hidden.append(max(0.0, best + net.bias[f]))
    logits = np.array(hidden) @ net.out + net.out_bias
    want = logits - np.log(np.exp(logits).sum())
    assert np.allclose(net.log_probabilities(windows[:1])[0], want, atol=1e-4)


def test_scores_do_not_depend_on_partitioning(spark, mid):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").limit(60)
    logits = np.random.default_rng(2).normal(size=quality.BUCKETS)
    a, b = (quality.with_scores(docs.repartition(n), logits).select("doc_id", "score").toPandas().sort_values("doc_id") for n in (1, 7))
    pd.testing.assert_frame_equal(a.reset_index(drop=True), b.reset_index(drop=True))


def test_every_language_is_learned_however_many(spark):
    """Rows of each language shrink with their number; none is left out."""
    from trendstream.llm.langid import fit
    rows = [(1000 * k + i, f"{chr(0x400 + k)}" * (20 + i), f"l{k:02}") for k in range(40) for i in range(8)]
    net = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), total=60)
    assert net.languages == sorted({r[2] for r in rows})
