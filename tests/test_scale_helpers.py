"""Scale helpers: rebalancing only under-split scans, materialising into the shared folder."""

from pyspark.sql import functions as F

from trendstream.session import default_parallelism, materialize, shared_dir
from trendstream.sources.tables import balance


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_balance_leaves_well_split_input_alone(spark):
    n = default_parallelism(spark)
    df = spark.range(0, 1000, 1, n * 2)
    out = balance(df)
    assert out.rdd.getNumPartitions() == n * 2
    assert "Exchange" not in _plan(out)


def test_balance_spreads_a_single_split(spark):
    df = spark.range(0, 1000, 1, 1).withColumn("x", F.col("id") * 2)
    out = balance(df)
    assert out.rdd.getNumPartitions() == default_parallelism(spark)
    assert sorted(r.id for r in out.collect()) == list(range(1000))


def test_materialize_cuts_lineage_into_the_shared_folder(spark):
    df = spark.range(0, 100).withColumn("r", F.rand(3))
    m = materialize(df, "probe")
    plan = _plan(m)
    assert "FileScan parquet" in plan and shared_dir(spark).split("/")[-1] in plan
    # values are fixed once written: two reads agree even for a random column
    assert sorted(m.collect()) == sorted(m.collect())


def test_hot_topic_is_spread_and_exact(spark):
    """One topic holds a third of all topic rows (events' five types plus users,
    with every third row re-labelled 'hot'); its window counts stay exact and
    land in many reduce partitions."""
    import collections

    from tests.conftest import SF_SMALL
    from trendstream.operators import longterm as LT
    from trendstream.operators import trends as TR
    from trendstream.plans import catalog as C
    rows = C._topic_rows(spark, SF_SMALL)
    rows = rows.withColumn("topic", F.when(F.xxhash64("ts", "topic") % 3 == 0, F.lit("hot"))
                           .otherwise(F.col("topic")))
    counts = TR.topic_counts(rows)
    hot = counts.where(F.col("topic") == "hot")
    # tiny inputs are coalesced into one partition by AQE; look at the hash layout itself
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        parts = {r.p for r in hot.select(F.spark_partition_id().alias("p")).collect()}
    finally:
        spark.conf.set(key, "true")
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    # exact: brute force over the collected hot rows
    import datetime as dt
    bf = collections.Counter()
    for r in rows.where(F.col("topic") == "hot").collect():
        m = r.ts.replace(second=0, microsecond=0)
        for i in range(10):
            bf[m - dt.timedelta(minutes=i)] += 1
    assert {r.windowStart: r["count"] for r in hot.collect()} == dict(bf)
    # the chunked anomaly spreads the hot topic over its days
    framed = LT.with_halo(counts.select("windowStart", "topic", "count"), "topic", "windowStart", 10)
    assert framed.where(F.col("topic") == "hot").select("_chunk").distinct().count() > 20


def test_ranking_splits_many_rows_with_one_id(spark):
    """A third of the rows share one id: ranks stay a permutation of 1..n and
    the sorted rows are spread over several ranges."""
    from trendstream.operators import paging as PG
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 == 0, F.lit(10**6)).otherwise(F.col("id"))
                                     .alias("id"))
    ranked = PG.rank_desc(df)
    rows = ranked.collect()
    assert sorted(r["rank"] for r in rows) == list(range(1, 3001))
    top = [r.id for r in sorted(rows, key=lambda r: r["rank"])][:1000]
    assert set(top) == {10**6}


def test_package_is_shipped_once_to_python_workers(spark):
    import zipfile

    from trendstream import session as S
    S.ship_package(spark)
    S.ship_package(spark)
    assert spark.sparkContext.applicationId in S._SHIPPED
    shipped = [f for f in spark.sparkContext.listFiles if f.endswith("trendstream.zip")]
    assert len(shipped) == 1
    path = shipped[0].replace("file:", "", 1)
    names = zipfile.ZipFile(path).namelist()
    assert "trendstream/__init__.py" in names and "trendstream/operators/service.py" in names
