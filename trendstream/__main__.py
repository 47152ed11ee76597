"""Run one job of the dataflow.

  python -m trendstream <job> --root <shared folder> [options]

jobs: initialize, ingest, enrich, history, alerts, leaders, watch
``--mode once`` processes what is available and stops; ``continuous`` keeps
running.  The session is the one the platform provides (spark-submit);
``--master`` starts a local one.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from trendstream.session import apply_core_conf
from trendstream.streaming import jobs as J


def _lines(spark: SparkSession, path: str) -> list[str]:
    return [r["value"] for r in spark.read.text(path).where("trim(value) <> ''").collect()]


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="trendstream")
    p.add_argument("job", choices=["initialize", "ingest", "enrich", "history", "alerts", "leaders", "watch"])
    p.add_argument("--root", required=True, help="shared folder of topics, tables and checkpoints")
    p.add_argument("--mode", default="once", choices=["once", "continuous"])
    p.add_argument("--interval", default="10 seconds", help="trigger interval in continuous mode")
    p.add_argument("--table", default="ItemHistory")
    p.add_argument("--threshold", type=int, default=5)
    p.add_argument("--source", default="fixed", choices=["fixed", "search"],
                   help="ingest: message file (fixed) or a posts table to search")
    p.add_argument("--path", help="ingest: message file(s), or the posts parquet for --source search")
    p.add_argument("--query", help="ingest --source search: text to look for")
    p.add_argument("--lang", help="ingest --source search: language")
    p.add_argument("--json-lines", action="store_true", default=None,
                   help="message files are JSON lines (default: told by their first line)")
    p.add_argument("--topic-kind", default="files", choices=["files", "kafka"])
    p.add_argument("--topic-option", action="append", default=[], metavar="NAME=VALUE",
                   help="broker topics: a connector option")
    p.add_argument("--max-files-per-trigger", type=int, help="file topics: most files in a micro-batch")
    p.add_argument("--max-offsets-per-trigger", type=int, help="broker topics: most offsets in a micro-batch")
    p.add_argument("--window", default="10 minutes")
    p.add_argument("--slide", default="1 minute")
    p.add_argument("--delay", default="10 minutes", help="watermark delay")
    p.add_argument("--gazetteer", help="enrich: file with one entity name a line")
    p.add_argument("--time-col", help="ingest: event time column of the posts (default: arrival time)")
    p.add_argument("--start", help="watch: alerts must start after this time")
    p.add_argument("--deadline-minutes", type=float, default=15)
    p.add_argument("--master", help="start a local session, e.g. local[8]")
    a = p.parse_args(argv)
    if a.job == "watch" and not a.start:
        p.error("watch needs --start")

    b = SparkSession.builder.appName(f"trendstream-{a.job}")
    if a.master:
        b = b.master(a.master)
    spark = apply_core_conf(b.getOrCreate())
    cfg = J.PipelineConfig(root=a.root.rstrip("/"), table=a.table, threshold=a.threshold, mode=a.mode,
                           interval=a.interval, length=a.window, slide=a.slide, delay=a.delay,
                           topic_kind=a.topic_kind, topic_options=dict(x.split("=", 1) for x in a.topic_option),
                           max_files_per_trigger=a.max_files_per_trigger,
                           max_offsets_per_trigger=a.max_offsets_per_trigger,
                           gazetteer=_lines(spark, a.gazetteer) if a.gazetteer else None)

    if a.job == "initialize":
        J.initialize(spark, cfg)
    elif a.job == "ingest":
        from trendstream.operators import paging as PG
        from trendstream.sources import messages as SM
        if a.mode == "continuous":
            # new files of a posts table, as they arrive
            posts = PG.matches(spark.readStream.schema(spark.read.parquet(a.path).schema).parquet(a.path),
                               a.query, a.lang)
            J.continuous_ingest_job(posts, cfg, time_col=a.time_col).awaitTermination()
            return 0
        if a.source == "fixed":
            posts, _ = SM.reader("fixed", spark, path=a.path, json_array=False if a.json_lines else None) \
                .search(SM.SearchRequest(a.query or ""))
        else:
            posts = PG.matches(spark.read.parquet(a.path), a.query, a.lang)
        J.ingest_job(posts, cfg, time_col=a.time_col)
    elif a.job == "watch":
        return 0 if J.watch_job(spark, cfg, a.start, a.deadline_minutes) else 1
    else:
        q = {"enrich": J.enrichment_job, "history": J.history_job, "alerts": J.alerts_job, "leaders": J.leaders_job}[a.job](spark, cfg)
        q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
