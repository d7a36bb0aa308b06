"""Structured Streaming operators: rate breaches vs brute force, duplicate-fetch suppression,
manifest stream failures and quarantine."""

import json
import os
import random
from datetime import datetime, timezone

from pyspark.sql import functions as F

from helpers import write_document
from skyledger.sources.events import read_events
from skyledger.streaming import manifests as sm
from skyledger.streaming import rate_limits as rl
from skyledger.streaming import request_state as rs


def _write_lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        for r in rows:
            fh.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def brute_force_breaches(rows, limit, window_s):
    """``(identity, window_start_s, ts_s, hit_no)`` of every hit over the limit, hit by hit."""
    out, by_id = [], {}
    for ident, t in rows:
        by_id.setdefault(ident, []).append(t)
    for ident, ts in by_id.items():
        start, count = None, 0
        for t in ts:
            if start is None or t >= start + window_s:
                start, count = t, 0
            count += 1
            if count > limit:
                out.append((ident, start, t, count))
    return sorted(out)


def _breaches(spark, workdir, files, limit, window):
    for i, part in enumerate(files):
        _write_lines(os.path.join(workdir, "hits", f"part-{i}.json"),
                     [{"identity": a, "ts": datetime.fromtimestamp(t, timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")} for a, t in part])
        os.utime(os.path.join(workdir, "hits", f"part-{i}.json"), (1_700_000_000 + i, 1_700_000_000 + i))
    hits = spark.readStream.schema("identity string, ts timestamp").option("maxFilesPerTrigger", 1) \
        .json(os.path.join(workdir, "hits"))
    before = spark.conf.get(rl.NO_DATA_BATCHES)
    rl.write_breaches(rl.rate_breaches_stream(hits, limit, window), os.path.join(workdir, "out"), os.path.join(workdir, "ck")).awaitTermination()
    assert spark.conf.get(rl.NO_DATA_BATCHES) == before == "true"
    return sorted((r.identity, int(r.window_start.replace(tzinfo=timezone.utc).timestamp()),
                   int(r.ts.replace(tzinfo=timezone.utc).timestamp()), r.hit_no)
                  for r in spark.read.parquet(os.path.join(workdir, "out")).collect())


def test_late_hits_are_counted(spark, workdir):
    """Seven hits, limit four; two come after later ones: the fifth to the seventh counted are breaches."""
    t = 1_700_000_000
    files = [[("a", t), ("a", t + 30)], [("a", t + 10), ("a", t + 5), ("a", t + 31)], [("a", t + 2)], [("a", t + 40), ("b", t)]]
    assert sorted(b[3] for b in _breaches(spark, workdir, files, 4, 60)) == [5, 6, 7]


def test_rate_breaches_match_brute_force(spark, workdir):
    rnd = random.Random(7)
    rows = []
    for ident in ("a", "b", "c"):
        t = 0
        for _ in range(400):
            t += rnd.choice([0, 0, 1, 1, 2, 5, 30, 70])
            rows.append((ident, 1_700_000_000 + t))
    limit, window = 10, 60
    # Hits arrive in time order, a few files (micro-batches) at a time.
    rows.sort(key=lambda r: r[1])
    expected = brute_force_breaches(rows, limit, window)
    chunk = len(rows) // 4 + 1
    got = _breaches(spark, workdir, [rows[i * chunk:(i + 1) * chunk] for i in range(4)], limit, window)
    assert got == expected and len(expected) > 0


def test_suppress_duplicate_fetches(spark, workdir):
    evs = [
        {"event_id": "1", "trace_id": "t1", "dataset_type": "actual", "created_at": "2026-01-01T00:00:00Z",
         "date_from": "2024-01-01", "date_to": "2024-01-02", "wmo_indexes": ["s1", "s2"]},
        {"event_id": "2", "trace_id": "t2", "dataset_type": "actual", "created_at": "2026-01-01T00:01:00Z",
         "date_from": "2024-01-02", "date_to": "2024-01-03", "wmo_indexes": ["s2"]},
        {"event_id": "3", "trace_id": "t3", "dataset_type": "forecast", "created_at": "2026-01-01T00:01:00Z",
         "date_from": "2024-01-02", "date_to": "2024-01-02", "wmo_indexes": ["s2"]},
    ]
    _write_lines(os.path.join(workdir, "ni", "a.json"), evs)
    src = spark.readStream.schema("event_id string, trace_id string, dataset_type string, created_at string, "
                                  "date_from string, date_to string, wmo_indexes array<string>") \
        .option("maxFilesPerTrigger", 1).json(os.path.join(workdir, "ni"))
    evs_late = dict(evs[0], event_id="4", trace_id="t4", created_at="2025-12-31T22:00:00Z", date_from="2024-01-02",
                    date_to="2024-01-04", wmo_indexes=["s2"])
    bad = dict(evs[0], event_id="5", trace_id="t5", date_from="2024-13-99")
    _write_lines(os.path.join(workdir, "ni", "b.json"), [evs_late, bad])
    rs.run_fetch_locks(rs.need_info_cells(src), lock_path=os.path.join(workdir, "locks"), answer_path=os.path.join(workdir, "out"),
                       checkpoint=os.path.join(workdir, "ck")).awaitTermination()
    cells = rs.read_answers(spark, os.path.join(workdir, "out")).collect()
    # (actual, s2, 2024-01-02) is asked for three times but fetched once; forecast is a separate lock. The late
    # event's unseen day is fetched, and its other cells are answered with the trace that owns them.
    taken = [(r.dataset_type, r.wmo_index, str(r.day)) for r in cells if r.acquired]
    assert len(taken) == len(set(taken)) == 7 and len(cells) == 10
    owners = {(r.trace_id, str(r.day)): r.owner_trace_id for r in cells if r.dataset_type == "actual" and r.wmo_index == "s2"}
    assert len({owners[k] for k in owners if k[1] == "2024-01-02"}) == 1
    assert owners[("t4", "2024-01-04")] == "t4"


def _fold_cells(batches, ttl=600):
    """Cell by cell: ``(key, event, owner, acquired)``."""
    state, out = {}, []
    for batch in batches:
        for key, event, trace, t in sorted(batch, key=lambda c: (c[3] is not None, c[3] or 0, c[1], c[2])):
            owner, locked = state.get(key, (None, None))
            take = owner is None or t is not None and t >= locked + ttl
            if take:
                owner, locked = state[key] = trace, 0 if t is None else t
            out.append((key, event, owner, take))
    return sorted(out)


def test_locks_by_brute_force_over_batches(spark, workdir, monkeypatch):
    """Late cells, cells of no instant, expiring locks, chains of locks within a batch, batches that are tried again."""
    monkeypatch.setattr(rs, "SNAPSHOT_EVERY", 3)
    monkeypatch.setattr(rs, "ROUNDS", 2)
    rnd, start = random.Random(5), 1_780_000_000
    batches, n = [], 0
    for b in range(8):
        batch = []
        for _ in range(60):
            n += 1
            t = None if rnd.random() < 0.1 else start + b * 500 + rnd.randint(-900, 2500)
            batch.append((rnd.choice(["1", "2", "3", "hot", "hot"]), f"e{n:04}", f"t{n:04}", t))
        batches.append(batch)
    now = F.lit(datetime(2026, 7, 6, tzinfo=timezone.utc))
    locks, out = os.path.join(workdir, "locks dir"), os.path.join(workdir, "answers")
    for epoch, batch in enumerate(batches):
        rows = [("actual", k, datetime(2024, 1, 1).date(), e, tr, None if t is None else datetime.fromtimestamp(t, timezone.utc)) for k, e, tr, t in batch]
        df = spark.createDataFrame(rows, "dataset_type string, wmo_index string, day date, event_id string, trace_id string, created_ts timestamp")
        for _ in range(2 if epoch in (2, 3, 6) else 1):
            rs.process_lock_batch(df, epoch, lock_path=locks, answer_path=out, now=now)
    got = sorted((r.wmo_index, r.event_id, r.owner_trace_id, r.acquired) for r in rs.read_answers(spark, out).collect())
    assert got == _fold_cells(batches)
    # silent for longer than the lifetime: forgotten, and a late cell is fetched again
    late = spark.createDataFrame([("actual", "1", datetime(2024, 1, 1).date(), "z", "tz", datetime.fromtimestamp(start - 5000, timezone.utc))], df.schema)
    rs.process_lock_batch(late, len(batches), lock_path=locks, answer_path=out, now=now + F.expr("INTERVAL 601 SECONDS"))
    assert rs.read_answers(spark, out).filter("event_id = 'z'").first().acquired


def test_manifest_stream_failures_and_quarantine(spark, workdir):
    raw_root = os.path.join(workdir, "raw")
    write_document(raw_root, "actual", "1960-01-01", [
        {"wmo_index": "1", "name": "A", "country": "X", "min_temp": 1.0, "avg_temp": 2.0, "max_temp": 3.0,
         "precipitation": 0.0}])
    good = {"event_id": "e1", "trace_id": "t1", "event_type": "weather.actual.raw.created", "schema_version": 1,
            "created_at": "2026-07-06T12:20:00Z", "source_name": "actual_fetcher", "bucket": "b",
            "object_keys": ["actual/date=1960-01-01.json"], "date_from": "1960-01-01", "date_to": "1960-01-01"}
    missing_file = dict(good, event_id="e2", trace_id="t2", date_to="1960-01-02")
    invalid = dict(good, event_id="e3", trace_id="t3", bucket="")
    topic_dir = os.path.join(workdir, "in", "topic=weather.actual.raw.created")
    _write_lines(os.path.join(topic_dir, "a.json"), [good, good, missing_file, invalid, "{broken"])
    raw = read_events(spark, "text", os.path.join(workdir, "in"))
    out = os.path.join(workdir, "outcomes")
    for q in sm.run_manifest_stream(spark, raw, raw_root=raw_root, table_root=os.path.join(workdir, "tables"),
                                    outcome_path=out, checkpoint=os.path.join(workdir, "ck")):
        q.awaitTermination()
    outcomes = {r.trace_id: r for r in spark.read.json(out).collect()}
    assert outcomes["t1"].event_type == "weather.dm.ready" and outcomes["t1"].record_count == 1
    assert outcomes["t2"].event_type == "weather.pipeline.failed"
    assert outcomes["t3"].reason == "dm_trigger_invalid_event"
    assert spark.read.json(out).filter(F.col("trace_id") == "t1").count() == 1     # redelivery dropped
    assert spark.read.text(out + "_quarantine").count() == 1


def test_finished_ids_read_their_prefixes_only(spark, workdir):
    """A batch of few ids reads few partitions; compaction leaves a file each, with a Bloom filter on the id."""
    import glob
    import pyarrow.parquet as pq
    path = os.path.join(workdir, "finished")
    ids = spark.range(3000).select(F.lit("actual").alias("dataset_type"), F.concat(F.lit("ev-"), "id").alias("event_id"))
    for epoch in range(3):
        sm.mark_finished(ids.filter(F.expr(f"substring(event_id, 4) % 3 = {epoch}")), path, epoch)
    sm.mark_finished(ids.limit(10), path, 1)                                    # a batch that was tried again
    batch = ids.filter("event_id IN ('ev-5', 'ev-77')").unionByName(spark.createDataFrame([("actual", "new"), ("forecast", "ev-5"), ("forecast", "ev-5")], ids.schema))
    got = sorted(tuple(r) for r in sm.new_manifests(batch, path, 9).select("dataset_type", "event_id").collect())
    assert got == [("actual", "new"), ("forecast", "ev-5")]
    assert sm.new_manifests(batch, path, 0).count() == 4                        # nothing is finished before batch 0
    prefixes = sorted({r.p for r in batch.select(sm.prefix_of("event_id").alias("p")).collect()})
    plan = sm.finished_ids(spark, path, prefixes, 9)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "prefix" in text.split("PartitionFilters: [")[1].split("]")[0]
    sm.compact_finished(spark, path)
    files = glob.glob(f"{path}/prefix=*/*.parquet")
    assert len(files) == len({os.path.dirname(f) for f in files}) == 256
    assert sm.finished_ids(spark, path, [p[-2:] for p in map(os.path.dirname, files)], 9).count() == 3000
    assert pq.ParquetFile(files[0]).num_row_groups == 1


def test_event_values_roundtrip_and_quarantine(spark, workdir):
    from skyledger.schemas import DM_READY_EVENT
    from skyledger.sources.events import parse_events, write_events
    ev = spark.createDataFrame([("e1", "t1", "weather.dm.ready", 1, "2026-07-06T12:20:00Z", "actual", "1960-01-01",
                                 "1960-01-03", 6)], DM_READY_EVENT)
    target = os.path.join(workdir, "topic=weather.dm.ready")
    write_events(ev, "text", target)
    with open(os.path.join(target, "zz-poison.txt"), "w") as fh:
        fh.write("not json\n")
    raw = read_events(spark, "text", workdir, streaming=False)
    good, bad = parse_events(raw, DM_READY_EVENT)
    row = good.first()
    assert (row.trace_id, row.record_count, row.topic) == ("t1", 6, "weather.dm.ready")
    assert [r.raw_value for r in bad.collect()] == ["not json"]
