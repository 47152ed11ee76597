"""Incremental alert watcher.

Each poll is an availableNow run over the alerts topic from the watcher's own
checkpoint, so it reads only the alert files that arrived since the last
poll; fresh alerts (window start strictly after the start time) are appended
to a small result folder, and the watch succeeds as soon as it holds a row.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from trendstream.operators import watch as W
from trendstream.streaming.runner import run_once


def wait_for_fresh(read_alerts: Callable[[], DataFrame], start, work_dir: str,
                   deadline_minutes: float = W.DEADLINE_MINUTES, poll_seconds: float = 10.0) -> bool:
    """True once an alert newer than ``start`` has been seen, False at the deadline.

    ``read_alerts`` opens the alerts topic, of whatever kind, as a stream.
    """
    found, chk = f"{work_dir}/fresh", f"{work_dir}/checkpoint"
    end = time.monotonic() + deadline_minutes * 60
    while True:
        fresh = W.fresh_alerts(read_alerts(), start)
        run_once(fresh, sink="parquet", path=found, checkpoint=chk)
        if not fresh.sparkSession.read.parquet(found).limit(1).isEmpty():
            return True
        if time.monotonic() >= end:
            return False
        time.sleep(poll_seconds)
