"""The trigram index against a scan."""

import random

import pytest

from trendstream.operators import paging as PG
from trendstream.operators import search_index as SI
from trendstream.sources import messages as SM


def posts(spark):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("abcdÉé ß\n") for _ in range(rng.randrange(40))), rng.choice(["en", "de"])) for i in range(400)]
    rows += [(500, None, "en"), (501, "", "en"), (502, "ab", "en"), (None, "abc no id", "en"), (503, "x" * 9998 + "needle" + "y" * 30000, "en"),
             (503, "needle again", "en"), (504, "NÊEDLE İ", "de"), (505, "caféxyz", None)]
    rows += [(600 + i, "hot text abc", "en") for i in range(150)]
    return spark.createDataFrame(rows, "id long, text string, lang string").repartition(4)


@pytest.fixture(scope="module")
def index(spark):
    return SI.TextIndex.build(posts(spark))


def key(df):
    return [(r.id, r.text, r.lang) for r in df.collect()]


@pytest.mark.parametrize("query", ["a", "ab", "abc", "É", "needle", "ab c", "\n", "ß", "nothing at all", "caf", "xyz", "bcd", "Hot Text"])
@pytest.mark.parametrize("lang", [None, "en"])
def test_every_match_is_found(spark, index, query, lang):
    want = sorted(key(PG.matches(posts(spark), query, lang)), key=repr)
    assert sorted(key(SI.search_all(index, query, lang)), key=repr) == want


@pytest.mark.parametrize("query,lang,count,max_id", [("abc", "en", 20, None), ("a", None, 7, 300), ("needle", "en", 100, None),
                                                     ("hot", "de", 5, None), ("a", "de", 1000, None), (None, "de", 9, 250), ("a", None, 3, 0)])
def test_pages_are_those_of_a_scan(spark, index, query, lang, count, max_id):
    got = index.search(query, lang, count, max_id).collect()
    want = PG.search(posts(spark), query, lang, count, max_id).collect()
    assert [r.id for r in got] == [r.id for r in want]


def test_only_candidates_texts_are_read(spark, index):
    assert index.candidates("hot text").count() == 150
    plan = index.postings().where("trigram IN ('hot')")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(trigram), EqualTo(trigram,hot)]" in plan or "In(trigram" in plan


def test_index_source_pages(spark, index):
    source = SM.reader("index", spark, index=index)
    first = source.search(SM.SearchRequest("hot", count=60))
    second = source.search(first.next_request())
    ids = [r.id for r in first.messages.collect()] + [r.id for r in second.messages.collect()]
    assert ids == sorted(ids, reverse=True) and len(set(ids)) == 120


def test_empty_index(spark):
    empty = SI.TextIndex.build(spark.createDataFrame([], "id long, text string, lang string"))
    assert empty.search("abc").collect() == [] and empty.candidates("a").collect() == []
