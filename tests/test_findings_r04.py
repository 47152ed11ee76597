"""Cases of the fourth round's findings: what a step holds, how often it runs, and the results it must keep."""

import glob
import json

from pyspark.sql import functions as F

from trendstream.plans import catalog
from trendstream.sources import messages as SM

_ROWS = [(1, 'say "so"\n,\n]', "en", "a-1"), (1, 'say "so"\n,\n]', "en", "a-1"), (2, None, "en", None), (None, "[", None, "1"),
         (3, "é \\", "de", ""), (2**60, "", "", "a"), (None, None, None, None), (-101, "x" * 5000, "fr", "a/b")]
_DDL = "id long, text string, lang string, source string"


def _key(row):
    return tuple((v is not None, str(v)) for v in row)


def test_array_files_follow_the_bytes_of_messages_and_no_value(spark, tmp_path):
    docs = (spark.range(600).select((F.col("id") * 100).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"),
                                    F.lit("en").alias("lang"), (F.col("id") % 30).cast("string").alias("source"))
            .unionByName(spark.createDataFrame(_ROWS, "doc_id long, text string, lang string, source string")))
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    out = catalog.message_array_file(spark, str(tmp_path))
    assert len(out.inputFiles()) <= spark.sparkContext.defaultParallelism
    want = [tuple(r) for r in docs.select(F.coalesce("doc_id", F.lit(0)), "text", "lang", "source").collect()]
    got = [tuple(r) for r in out.select("id", "text", "lang", "source").collect()]
    assert sorted(got, key=_key) == sorted(want, key=_key)


def test_a_partition_fills_one_array_file_after_the_other(spark, tmp_path):
    path, df = f"{tmp_path}/arrays", spark.createDataFrame(_ROWS * 20, _DDL).coalesce(1)
    SM.write_message_arrays(df, path, most=1000)
    arrays = []
    for name in glob.glob(f"{path}/part-*"):
        with open(name, encoding="utf-8", newline="\n") as f:
            lines = f.read().rstrip("\n").split("\n")
        assert lines[0] == "[" and lines[-1] == "]"
        arrays.append([json.loads(line.removesuffix(",")) for line in lines[1:-1]])
        assert len(arrays[-1]) == 1 or sum(len(line.encode()) for line in lines[1:-1]) <= 1000 + len(lines)
    assert sum(map(len, arrays)) == len(_ROWS) * 20 and 20 < len(arrays) < len(_ROWS) * 20
    want = sorted(((r[0] or 0, *r[1:]) for r in _ROWS * 20), key=_key)
    for how in (None, True):
        back = SM.read_messages_json(spark, path, how).select("id", "text", "lang", "source")
        assert sorted(map(tuple, back.collect()), key=_key) == want
    SM.write_message_arrays(df.limit(0), path)
    assert SM.read_messages_json(spark, path).count() == 0
