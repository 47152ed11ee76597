"""Mixing against a numpy fit and its targets; the pipeline stage by stage."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trendstream.llm import mixing
from trendstream.llm import queries as Q
from trendstream.llm.common import table
from trendstream.llm.exact_dedup import exact_duplicates
from trendstream.llm.mixing import fit_rates, mix, mixed_documents, with_rates
from trendstream.llm.quality import fit
from trendstream.session import ship_package
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.test_op3_op6_dedup import brute_components, norm
from tests.llm.test_op4_op9_models import brute_features

DDL = "doc_id long, text string, source string, rate string"
LABELS = "doc_id long, quality int, toxic int"


def projected_gradient(p, t, want):
    """Many plain steps of projected gradient on the whitened residual."""
    total = t.sum()
    inverse = np.linalg.pinv((p * t[:, None]).T @ p / total, rcond=1e-9, hermitian=True)
    r = np.ones(len(t))
    for _ in range(5000):
        r = np.maximum(0, r - p @ (inverse @ ((r * t) @ p - want)) / total)
    off = (r * t) @ p - want
    return off @ inverse @ off, inverse


@pytest.mark.parametrize("targets", [[0.9, 0.05, 0.05], [0.2, 0.4, 0.4], [0.0, 1.0, 0.0]])
def test_rates_reach_the_least_residual(spark, targets):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.2, 0.1], 400)
    t = rng.integers(0, 500, 400).astype(float)
    df = spark.createDataFrame([(i, float(t[i]), *map(float, p[i])) for i in range(400)],
                               "i int, t double, a double, b double, c double").repartition(4)
    rate, expected, want = fit_rates(df, "t", ["a", "b", "c"], targets)
    got = np.array([r.rate for r in df.withColumn("rate", rate).orderBy("i").collect()])
    assert (got >= 0).all() and np.allclose((got * t) @ p, expected, rtol=1e-6, atol=1e-6)
    best, inverse = projected_gradient(p, t, np.array(want))
    off = np.array(expected) - want
    assert off @ inverse @ off <= best + 2e-3 * t.sum() ** 2
    if min(targets) > 0:
        assert np.abs(off).max() <= 1e-3 * t.sum()


def test_op7_query_comes_as_near_its_targets_as_can_be(spark):
    got = Q.op7_mixing(spark, SF_MID).toPandas()
    docs = table(spark, SF_MID, "documents").toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id) and (got.rate >= 0).all()
    words = got.merge(docs, on="doc_id").text.map(lambda x: len(re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", x)))
    assert (got.tokens.to_numpy() == words.to_numpy()).all()
    members = [f"p_{d}" for d in Q.MIX]
    assert np.allclose(got[members].sum(axis=1), 1)
    p, t, weight = got[members].to_numpy(), got.tokens.to_numpy(dtype=float), np.array(list(Q.MIX.values()))
    want = weight * (t @ p)[weight.argmax()] / weight.max()
    best, inverse = projected_gradient(p, t, want)
    off = (got.rate.to_numpy() * t) @ p - want
    assert off @ inverse @ off <= best + 2e-3 * t.sum() ** 2
    # each domain against its own target, and the totals as the query tells them
    assert (np.abs(off) <= 0.02 * want).all()
    for kind, tokens in (("reached", want + off), ("wanted", want)):
        told = got[[f"{kind}_{d}" for d in Q.MIX]].drop_duplicates().to_numpy()
        assert told.shape == (1, len(Q.MIX)) and np.allclose(told[0], tokens, rtol=1e-6)
    assert abs((got.copies - got.rate).abs()).max() < 1
    labels = table(spark, SF_MID, "labels").toPandas().merge(got, on="doc_id")
    clean = labels[(labels.quality == 1) & (labels.toxic == 0)]
    assert (clean.copies > 0).mean() >= 0.8


def test_op7_plan_is_native(spark):
    plan = Q.op7_mixing(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def edge():
    texts = [None, "", " ", "good words here", "good words here", "awful nasty words", "THE!! WORST!!", "long " * 20000]
    return [(i if i != 2 else None, t, "hot", "clash") for i, t in enumerate(texts)]


def test_mixing_edge_rows(spark):
    docs = spark.createDataFrame(edge(), DDL).repartition(3)
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (5, 1, 1), (6, 0, 0), (None, 1, 0), (7, None, None), (99, 1, 1)], LABELS)
    got = with_rates(docs, labels, Q.MIX).collect()
    assert len(got) == len(edge())
    assert all(r.rate >= 0 and r.copies >= 0 and abs(r.p_clean + r.p_toxic + r.p_junk - 1) < 1e-9 for r in got)
    assert {r.tokens for r in got if not (r.text or "").strip()} == {0}
    same = [r for r in got if r.text == "good words here"]
    assert same[0].rate == same[1].rate
    out = mixed_documents(docs, labels, Q.MIX)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in got)


def words_of(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.words for r in mixing.with_words(docs, "text").orderBy("i").collect()]


def test_words_are_cut_at_marks_and_spaces_of_any_script(spark):
    texts = ["\u201cawful\u201d", "\u00abawful\u00bb", "\u00a1awful!", "awful\u2014awful", "awful\u00a0awful\u3000awful",
             "\u00c9T\u00c9 caf\u00e9", "cafe\u0301 don\u2019t", "\u0423\u0416\u0410\u0421 x2", "\u0939\u093f\u0928\u094d\u0926\u0940"]
    assert words_of(spark, texts) == [["awful"]] * 3 + [["awful"] * 2, ["awful"] * 3, ["\u00e9t\u00e9", "caf\u00e9"],
                                                        ["cafe\u0301", "don", "t"], ["\u0443\u0436\u0430\u0441", "x2"], [texts[-1]]]


def test_words_of_unspaced_scripts_count_by_length(spark):
    chinese, japanese, thai = "\u6211\u4eec\u53bb\u5317\u4eac" * 40, "\u306d\u3053\u304c\u3044\u308b", "\u0e01\u0e34\u0e19\u0e02\u0e49\u0e32\u0e27"
    got = words_of(spark, [chinese, japanese, thai, "see \u5317\u4eac2024\u3002\U00020000", "\ud55c\uad6d \ub9d0"])
    assert got == [list(chinese), list(japanese), ["\u0e01\u0e34", "\u0e19", "\u0e02\u0e49", "\u0e32", "\u0e27"],
                   ["see", "\u5317", "\u4eac", "2024", "\U00020000"], ["\ud55c\uad6d", "\ub9d0"]]
    docs = spark.createDataFrame([(1, chinese, None, None), (2, "good words", None, None)], DDL)
    assert {r.doc_id: r.tokens for r in with_rates(docs, spark.createDataFrame([], LABELS), Q.MIX).collect()} == {1: 200, 2: 2}


def test_capitals_and_marks_of_any_script(spark):
    pairs = [("\u0423\u0416\u0410\u0421", "AWFU"), ("\u00c9\u00e9", "Ee"), ("\u00bfa\u2026", "?a!"), ("a\u00a0b", "a b")]
    docs = spark.createDataFrame([(i, j, t) for i, two in enumerate(pairs) for j, t in enumerate(two)], "i int, j int, text string")
    got = (mixing.with_words(docs, "text").orderBy("i", "j")
           .select(mixing._buckets(F.col("text"), F.col("words")).alias("b"), F.size("words").alias("n")).collect())
    shares = [r.b[r.n:] for r in got]
    assert shares[::2] == shares[1::2] and shares[0][0] > shares[2][0] > shares[4][0]


def test_mixing_without_labels_or_rows(spark):
    docs = spark.createDataFrame(edge(), DDL)
    none = spark.createDataFrame([], LABELS)
    got = with_rates(docs, none, {"clean": 0.5, "toxic": 0.5}).collect()
    assert len(got) == len(edge()) and all(abs(r.rate - 1) < 1e-6 and r.copies == 1 for r in got)
    assert mix(spark.createDataFrame([], DDL), none, Q.MIX).collect() == []
    only = spark.createDataFrame([(3, 1, 0)], LABELS)
    assert all(r.p_clean == 1.0 for r in with_rates(docs, only, Q.MIX).collect())


def run_stages(spark, sf_dir):
    """The rows of each stage, each made from its predecessor's as run() does."""
    docs, out = table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.materialize(stage(spark, docs, sf_dir), "test-stage")
        out.append((name, before, docs))
    return out


@pytest.fixture(scope="module")
def stages(spark):
    ship_package(spark)
    return {name: (before, after) for name, before, after in run_stages(spark, SF_SMALL)}


def test_stage_names_and_columns(spark, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    columns = table(spark, SF_SMALL, "documents").dtypes
    for name in ("quality", "exact_dedup", "near_dedup", "mixing"):
        assert stages[name][1].dtypes == columns


def test_quality_stage_drops_what_it_rejects(spark, stages):
    before, after = stages["quality"]
    logits = fit(before, table(spark, SF_SMALL, "labels"))
    want = [r.doc_id for r in before.collect() if 1 / (1 + np.exp(-np.mean(logits[brute_features(r.text or "")]))) >= 0.3]
    assert sorted(r.doc_id for r in after.collect()) == sorted(want) and 0 < len(want) < before.count()


def test_dedup_stages_keep_one_of_each_group(spark, stages):
    before, after = stages["exact_dedup"]
    best = {}
    for r in before.collect():
        best[norm(r.text)] = min(best.get(norm(r.text), r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(best.values())
    before, after = stages["near_dedup"]
    want = {c for _, _, c in brute_components([(r.doc_id, r.text) for r in before.collect()])}
    assert sorted(r.doc_id for r in after.collect()) == sorted(want)
    assert exact_duplicates(after).filter("NOT kept").isEmpty()


def test_mixing_stage_repeats_rows_as_rated(spark, stages):
    before, after = stages["mixing"]
    copies = {r.doc_id: r.copies for r in with_rates(before, table(spark, SF_SMALL, "labels"), corpus_pipeline.MIX).collect()}
    got = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert got == {d: c for d, c in copies.items() if c}


def test_packing_stage_and_run(spark, stages):
    before, after = stages["packing"]
    docs = before.groupBy("doc_id").count().withColumnRenamed("count", "n")
    pieces = after.groupBy("doc_id").agg(F.sum("length").alias("length"), F.max("doc_tokens").alias("tokens"))
    joined = docs.join(pieces, "doc_id", "full").collect()
    assert joined and all(r.length == r.n * r.tokens for r in joined)
    assert corpus_pipeline.run(spark, SF_SMALL).select("doc_id", "start", "length", "ids").exceptAll(
        after.select("doc_id", "start", "length", "ids")).isEmpty()


def test_quality_stage_keeps_a_column_of_its_own_name(spark):
    ship_package(spark)
    docs = table(spark, SF_SMALL, "documents").withColumns({"__quality": F.col("doc_id") * 2, "__Quality_": F.lit("clash")})
    out = corpus_pipeline.accept(spark, docs, SF_SMALL)
    assert out.dtypes == docs.dtypes
    got = out.collect()
    assert got and all(r["__quality"] == 2 * r.doc_id and r["__Quality_"] == "clash" for r in got)


def test_an_early_end_of_the_fit_is_told(spark, monkeypatch):
    """Targets that no rates meet: the reached totals say so."""
    docs = spark.createDataFrame([(i, "good words", None, None) for i in range(20)], DDL)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5)] + [(99, 1, 1)], LABELS)
    got = with_rates(docs, labels, {"clean": 1.0}, total=100.0).collect()[0]
    assert got.wanted_clean == 100.0 and abs(got.reached_clean - 100.0) < 1e-3
    monkeypatch.setattr(mixing, "STALL", 1.0)
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.2, 0.2], 50)
    df = spark.createDataFrame([(10.0, *map(float, x)) for x in p], "t double, a double, b double")
    rate, reached, want = fit_rates(df, "t", ["a", "b"], [0.02, 0.98])
    sums = df.withColumn("rate", rate).agg(F.sum(F.expr("t * rate * a")), F.sum(F.expr("t * rate * b"))).first()
    assert np.allclose(list(sums), reached, rtol=1e-6) and want[0] < want[1]


def test_pipeline_with_awkward_rows(spark):
    ship_package(spark)
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "", "en", "s", 0), (2, "a", "en", "s", 1), (2, "a", "en", "s", 1),
                                  (3, "word " * 20000, "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        at = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES:
            at = corpus_pipeline.materialize(stage(spark, at, SF_SMALL), "awkward")
            if name != "packing":
                assert at.dtypes == docs.dtypes
        assert at.isEmpty() == empty
