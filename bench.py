"""Time the headline jobs and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores.  The
messages are landed before the clock starts, as they would be on a cluster; each
job runs twice and the better time counts, so that no job pays for JVM warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.operators import metrics, planning, progress, reconcile
from cdclake.operators.decode import decode
from cdclake.operators.filters import filter_changes, not_commit
from cdclake.plans import synth
from cdclake.plans.queries import KEY_FIELDS
from cdclake.session import local_session
from cdclake.sources import lake
from cdclake.sources.messages import read_messages, stream_messages
from cdclake.streaming.stream import drain

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2
LANDED_FILES = 24


def consume(df: DataFrame) -> None:
    """Compute every column of every row and keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, "16g", **{"spark.sql.shuffle.partitions": str(2 * int(CPUS))})
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="cdclake-bench-")

    def land(name: str, messages: DataFrame) -> DataFrame:
        # Files in arrival order, as a landing process leaves them.
        path = f"{work}/{name}"
        messages.repartitionByRange(LANDED_FILES, "seq").sortWithinPartitions("seq").write.parquet(path)
        return read_messages(spark, path)

    bulk = land("bulk", synth.lineitem_messages(spark, SF_DIR, F.monotonically_increasing_id()))
    events = land("events", synth.event_messages(spark, SF_DIR))
    n_bulk, n_events = bulk.count(), events.count()

    def rows(messages: DataFrame) -> DataFrame:
        return filter_changes(decode(messages), not_commit())

    lake.write_changes(rows(events), f"{work}/lake", "ns", load=1)
    stored = lake.read_changes(spark, f"{work}/lake", "ns")
    attempt = iter(range(1000))

    def stream() -> None:
        target = f"{work}/stream-{next(attempt)}"
        drain(stream_messages(spark, f"{work}/events"), f"{target}/lake", f"{target}/checkpoint", "ns")

    jobs: dict[str, Callable[[], None]] = {
        "decode_bulk": lambda: consume(decode(bulk)),
        "decode_events": lambda: consume(decode(events)),
        "lake_write_bulk": lambda: lake.write_changes(rows(bulk), f"{work}/bulk-lake", "ns", load=1, replace=True),
        "day_pruned_read": lambda: consume(
            lake.read_changes(spark, f"{work}/lake", "ns", "2024-01-05", "2024-01-09").filter("operation = 'insert'")
        ),
        "event_counts": lambda: consume(metrics.event_counts(rows(events))),
        "file_manifest": lambda: consume(planning.file_manifest(decode(events), "ns", 1000, not_commit())),
        "segments_by_count": lambda: consume(planning.segments_by_count(decode(events))),
        "day_runs": lambda: consume(planning.day_runs(decode(events)).select("seq", "segment", "run", "commit_date")),
        "acked_history": lambda: consume(progress.acked_history(synth.segment_ledger(spark, SF_DIR), "last_lsn")),
        "expand_image": lambda: consume(
            stored.select(*[c.alias(n) for n, c in reconcile.expand_image(F.col("after"), KEY_FIELDS | {"score": reconcile.EXACT}).items()])
        ),
        "image_widths": lambda: consume(metrics.image_widths(stored)),
        "file_stats": lambda: consume(metrics.file_stats(stored)),
        "contiguous_prefix": lambda: consume(progress.contiguous_prefix(synth.segment_ledger(spark, SF_DIR))),
        "safe_restart": lambda: consume(progress.safe_restart(events, 16777216 + 60 * 600)),
        "missing_changes": lambda: consume(
            reconcile.missing_changes(synth.committed_changes(spark, SF_DIR), stored, KEY_FIELDS)
        ),
        "conservation": lambda: consume(reconcile.conservation(rows(events), stored)),
        "dedup_replays": lambda: consume(reconcile.dedup_replays(stored)),
        "stream_drain_events": stream,
    }
    times = {}
    for name, job in jobs.items():
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            job()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
            print(f"{name}: {took:.2f} s", file=sys.stderr)
        times[name] = round(best, 3)

    print(
        json.dumps(
            {
                "metric": "total_job_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "messages": {"bulk": n_bulk, "events": n_events},
                "messages_per_sec": {
                    "decode_bulk": round(n_bulk / times["decode_bulk"]),
                    "lake_write_bulk": round(n_bulk / times["lake_write_bulk"]),
                    "stream_drain_events": round(n_events / times["stream_drain_events"]),
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
