"""Rate-breach detection with first-hit-anchored fixed windows.

Per identity a window opens at the first hit and lasts ``window_s`` seconds;
the next hit at or after its end opens the next window. A hit whose number
inside its window exceeds ``limit`` is a breach. Windows depend on each other
sequentially, so this is a stateful stream: ``applyInPandasWithState`` keyed
by one of ``BUCKETS`` hashes of the identity (a call for each identity would cost far more than
its hits), with O(1) state ``(window_start, count, seen)`` per identity; each micro-batch brings
only that batch's hits of a bucket to its task. A counter counts hits as
they come: one that arrives late, with an instant before the open window,
counts in that window, and none is dropped. The state of an identity goes
when it has been silent for ``idle_s`` seconds of processing time.

Fixed values of the contract: 60 hits per 60 s (general), 10 per 300 s (login).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

GENERAL_LIMIT = (60, 60)
LOGIN_LIMIT = (10, 300)

OUTPUT_SCHEMA = "identity string, window_start timestamp, ts timestamp, hit_no long"
STATE_SCHEMA = "identity array<string>, window_start_us array<long>, count array<long>, seen_ms array<long>"
BUCKETS = 1024


def _breach_fn(limit: int, window_s: int, idle_s: int):
    window_us, idle_ms = int(window_s) * 1_000_000, int(idle_s) * 1000

    def fn(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentProcessingTimeMs()
        held = {i: (start, count, seen) for i, start, count, seen in zip(*state.get, strict=True)} if state.exists else {}
        arrived = [] if state.hasTimedOut else [pdf for pdf in batches if len(pdf)]      # of this micro-batch
        over = []                                        # (identity, window start, instants over the limit, number of the first)
        if arrived:
            codes, names = pd.factorize(np.concatenate([pdf["identity"].to_numpy(object) for pdf in arrived]))
            instants = np.concatenate([pdf["ts"].to_numpy().astype("datetime64[us]").astype("int64") for pdf in arrived])
            order = np.lexsort((instants, codes))
            bounds = np.searchsorted(codes[order], np.arange(len(names) + 1)).tolist()
            instants = instants[order]
            for name, low, high in zip(names.tolist(), bounds[:-1], bounds[1:], strict=True):
                ts = instants[low:high]
                start, count, _ = held.get(name, (None, 0, 0))
                i = 0
                while i < len(ts):                       # one step per window, not per hit
                    if start is None or ts[i] >= start + window_us:
                        start, count = int(ts[i]), 0
                    end = int(np.searchsorted(ts, start + window_us))
                    first = max(i, i + limit - count)    # the first hit over the limit
                    if first < end:
                        over.append((name, start, ts[first:end], first - i + count + 1))
                    count += end - i
                    i = end
                held[name] = (int(start), int(count), now)
        if over:                                         # one frame for all windows
            sizes = [len(w[2]) for w in over]
            yield pd.DataFrame({"identity": np.repeat(np.array([w[0] for w in over], object), sizes),
                                "window_start": np.repeat(np.array([w[1] for w in over], np.int64), sizes).astype("datetime64[us]"),
                                "ts": np.concatenate([w[2] for w in over]).astype("datetime64[us]"),
                                "hit_no": np.concatenate([np.arange(w[3], w[3] + n) for w, n in zip(over, sizes, strict=True)])})
        held = {i: v for i, v in held.items() if v[2] + idle_ms > now}
        if held:
            state.update((list(held), *[[v[k] for v in held.values()] for k in range(3)]))
            state.setTimeoutDuration(max(1, min(v[2] for v in held.values()) + idle_ms - now))    # when the first one goes
        elif state.exists:
            state.remove()

    return fn


def rate_breaches_stream(hits: DataFrame, limit: int = GENERAL_LIMIT[0], window_s: int = GENERAL_LIMIT[1],
                         identity_col: str = "identity", ts_col: str = "ts", idle_s: int = 86_400) -> DataFrame:
    """Streaming breaches: ``identity, window_start, ts, hit_no`` for every hit over the limit."""
    src = hits.selectExpr(f"CAST({identity_col} AS STRING) AS identity", f"CAST({ts_col} AS TIMESTAMP) AS ts") \
        .filter("identity IS NOT NULL AND ts IS NOT NULL").withColumn("bucket", F.pmod(F.xxhash64("identity"), F.lit(BUCKETS)))
    return src.groupBy("bucket").applyInPandasWithState(
        _breach_fn(limit, window_s, idle_s), OUTPUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.ProcessingTimeTimeout)


NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def write_breaches(breaches: DataFrame, path: str, checkpoint: str, available_now: bool = True):
    """Start the stream of breaches into a parquet folder; returns the running query.

    A run over what is there now would never end while state waits for its time-out in batches without data, so these
    are turned off for such a run; the setting is read when a stream starts and is put back for the session's others."""
    spark = breaches.sparkSession
    trigger = {"availableNow": True} if available_now else {"processingTime": "30 seconds"}
    writer = breaches.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger)
    if not available_now:
        return writer.start()
    before = spark.conf.get(NO_DATA_BATCHES)
    spark.conf.set(NO_DATA_BATCHES, "false")
    try:
        return writer.start()
    finally:
        spark.conf.set(NO_DATA_BATCHES, before)
