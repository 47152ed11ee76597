"""Every registered query against its SQL oracle (DuckDB) on the given tables."""

import pytest

import __spark_entry__ as E
from trendstream.plans import catalog
from tests.conftest import SF_MID, SF_SMALL
from trendstream.plans.verify import compare

QUERIES = E.queries()
ORACLES = E.oracle_sql()


_BUILT: dict = {}


def small(spark, name):
    """The query over the small tables, built once for all its tests."""
    if name not in _BUILT:
        _BUILT[name] = QUERIES[name](spark, SF_SMALL)
    return _BUILT[name]


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_oracle_sf0001(spark, duck_small, name):
    ok, msg = compare(small(spark, name), duck_small, ORACLES[name])
    assert ok, msg


# alerts need the larger tables: in the small ones no window reaches the threshold
@pytest.mark.parametrize("name", ["threshold_alerts", "stream_threshold_alerts", "search_pages",
                                  "entities_gazetteer", "language_detected", "alert_json", "fresh_alerts", "has_fresh_alert",
                                  "rejected_payloads", "watch_finds_fresh_alert", "new_alerts", "stream_new_alerts",
                                  "stream_memory_view", "limited_alerts_job", "stream_alert_baseline"])
def test_query_matches_oracle_sf001(spark, duck_mid, name):
    ok, msg = compare(QUERIES[name](spark, SF_MID), duck_mid, ORACLES[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["windowStart", "windowEnd", "topic", "count"]
    assert len(rows) > 0
    assert all(r["count"] >= E.SMOKE_THRESHOLD for r in rows)


_DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
               "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]",
               "map<string,int>": "MAP(VARCHAR, INTEGER)"}


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_result_types_match_oracle(spark, duck_small, name):
    df = small(spark, name)
    ours = {f.name: _DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema.fields}
    theirs = {r[0]: r[1] for r in duck_small.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    assert ours == theirs
