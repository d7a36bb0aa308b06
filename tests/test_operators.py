"""Operator-level tests: newest-wins, coverage invariants, dimension CSV, payloads,
request state, checks and the presentation maths."""

import os

import pytest
from pyspark.sql import functions as F

from skyledger.operators import coverage as cov
from skyledger.operators import current as cur
from skyledger.operators import dimension as dim
from skyledger.operators import metrics as mx
from skyledger.operators import requests as rq
from skyledger.sources import dimension_csv as dcsv
from skyledger.sources import documents as docs


def test_current_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1, "2024-01-01 00:00:00", 1, 1.0), ("a", 1, "2024-01-01 00:00:00", 2, 2.0),
         ("a", 2, None, 9, 3.0), ("a", 2, "2024-01-01 00:00:00", 1, 4.0)],
        "k string, d int, v string, seq int, x double").withColumn("v", F.col("v").cast("timestamp"))
    got = {(r.k, r.d): r.x for r in cur.current(df, ["k", "d"], "v", "seq").collect()}
    assert got == {("a", 1): 2.0, ("a", 2): 4.0}     # later insert wins a tie; null version loses


def test_upsert_insert_if_absent_replace(spark):
    t = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "k string, d int, x double")
    n = spark.createDataFrame([("b", 1, None), ("c", 2, 5.0)], "k string, d int, x double")
    up = {(r.k, r.d): r.x for r in cur.upsert(t, n, ["k", "d"]).collect()}
    assert up == {("a", 1): 1.0, ("b", 1): None, ("c", 2): 5.0}   # whole row replaced, nulls included
    ins = {r.k for r in cur.insert_if_absent(t, n, ["k", "d"]).collect()}
    assert ins == {"c"}
    rep = sorted(tuple(r) for r in cur.replace_partitions(t, n.filter("d = 1"), "d").collect())
    assert rep == [("b", 1, None)]


def test_coverage_invariants(spark):
    err = spark.createDataFrame(
        [("s1", d) for d in ["2024-01-01", "2024-01-02", "2024-01-04"]] + [("s2", "2024-01-02")],
        "wmo_index string, day string").withColumn("day", F.to_date("day"))
    rs = spark.createDataFrame([("r1", "s1"), ("r2", "s1"), ("r2", "s2"), ("r2", "s2")],
                               "request_id string, wmo_index string")
    rr = spark.createDataFrame([("r1", "2024-01-01", "2024-01-05"), ("r2", "2024-01-01", "2024-01-03")],
                               "request_id string, date_from string, date_to string") \
        .select("request_id", F.to_date("date_from").alias("date_from"), F.to_date("date_to").alias("date_to"))
    covered = {(r.request_id, str(r.day)) for r in cov.covered_days(err, rs, rr).collect()}
    assert covered == {("r1", "2024-01-01"), ("r1", "2024-01-02"), ("r1", "2024-01-04"), ("r2", "2024-01-02")}
    missing = {(r.request_id, str(r.day)) for r in cov.missing_days(err, rs, rr).collect()}
    cal = {(r.request_id, str(r.day)) for r in cov.request_calendar(rr).collect()}
    assert covered | missing == cal and not (covered & missing)
    ranges = {(r.request_id, str(r.range_start), str(r.range_end))
              for r in cov.missing_ranges(err, rs, rr).collect()}
    assert ranges == {("r1", "2024-01-03", "2024-01-03"), ("r1", "2024-01-05", "2024-01-05"),
                      ("r2", "2024-01-01", "2024-01-01"), ("r2", "2024-01-03", "2024-01-03")}
    need = cov.need_info_requests(cov.missing_ranges(err, rs, rr), rs).collect()
    assert len(need) == 8 and {r.dataset_type for r in need} == {"actual", "forecast"}
    assert {r.n_stations for r in need if r.request_id == "r2"} == {2}


def test_calendar_inverted_is_empty(spark):
    assert cov.calendar(spark, "2024-01-05", "2024-01-01").count() == 0
    assert cov.calendar(spark, "2024-01-01", "2024-01-03").count() == 3


def test_check_and_clamp_requests(spark):
    req = spark.createDataFrame(
        [("a", "2024-01-01", "2024-01-10", 1), ("b", "2024-01-10", "2024-01-01", 1),
         ("c", "2024-01-01", "2024-12-31", 1), ("d", "2024/01/01", "2024-01-02", 1),
         ("e", "2024-02-30", "2024-03-01", 1), ("f", "2024-01-01", "2024-01-02", 0)],
        "request_id string, date_from string, date_to string, n_stations int")
    codes = {r.request_id: r.error_code for r in cov.check_requests(req, 180).collect()}
    assert codes == {"a": None, "b": "RANGE_INVERTED", "c": "RANGE_TOO_LARGE", "d": "INVALID_DATE",
                     "e": "INVALID_DATE", "f": "EMPTY_SELECTION"}
    picks = spark.createDataFrame(
        [("x", "2021-05-01", "2022-12-31", "from"), ("y", "2025-01-01", "2027-01-01", "to")],
        "request_id string, date_from string, date_to string, edited string") \
        .select("request_id", F.to_date("date_from").alias("date_from"), F.to_date("date_to").alias("date_to"),
                "edited")
    got = {r.request_id: (str(r.clamped_from), str(r.clamped_to)) for r in cov.clamp_requests(picks).collect()}
    assert got == {"x": ("2022-01-01", "2022-06-29"), "y": ("2026-01-02", "2026-06-30")}


def test_station_csv_dimension(spark, workdir):
    path = os.path.join(workdir, "stations.csv")
    with open(path, "w") as fh:
        fh.write("WMO_index,Station,Region,Latitude,Longitude\n")
        fh.write(" 20674 , Ostrov Dikson ,24,73.5,80.4\n")
        fh.write(",Radar,24,1,2\n")                       # no id: skipped
        fh.write("20891,,24,72.0,abc\n")                  # blank name, bad longitude
        fh.write("20891,Hatanga,25,,\n")                  # same id, another region, no coords
        fh.write("30000, ,,1.0d,2\n")                     # blank name and region; '1.0d' is not a number
    station, members, skipped = dcsv.scan_station_dimension(spark, path)
    rows = {r.wmo_index: r for r in station.collect()}
    assert set(rows) == {"20674", "20891", "30000"}
    assert rows["20674"].name == "Ostrov Dikson" and rows["20674"].lat == 73.5
    assert rows["20891"].name == "Hatanga" and rows["20891"].region_id == "25" and rows["20891"].lat is None
    assert rows["30000"].name is None and rows["30000"].lat is None
    assert skipped.count() == 1
    by_region = {r.region_id: r.n_stations for r in dim.stations_by_region(members).collect()}
    assert by_region == {"24": 2, "25": 1}                # a station listed under two regions is in both
    stats = dim.dimension_stats(station, skipped).first()
    assert (stats.stations_loaded, stats.stations_with_name, stats.skipped_no_id) == (3, 2, 1)
    found = [r.wmo_index for r in dim.search_stations(station, "  DIK ", 99).collect()]
    assert found == ["20674"]
    assert dim.search_stations(station, "   ", 5).count() == 0
    assert [r.wmo_index for r in dim.search_stations(station, "2", 1).collect()] == ["20674"]
    ids = spark.createDataFrame([("20674",), ("20891",), ("99999",)], "wmo_index string")
    assert {r.wmo_index for r in dim.unresolvable_stations(ids, station).collect()} == {"20891", "99999"}
    assert {r.wmo_index for r in dim.names_for(ids, station).collect()} == {"20674", "20891"}
    regions = spark.createDataFrame([("24",), ("77",)], "region_id string")
    got_ids, unknown = dim.stations_for_regions(members, regions)
    assert {r.wmo_index for r in got_ids.collect()} == {"20674", "20891"}
    assert [r.region_id for r in unknown.collect()] == ["77"]


def test_payload_parsing(spark, workdir):
    single = os.path.join(workdir, "single.json")
    many = os.path.join(workdir, "many.json")
    with open(single, "w") as fh:
        fh.write('{"latitude": 1.0, "longitude": 2.0, "daily": {"time": ["2024-01-01", "2024-01-02"],'
                 ' "temperature_2m_mean": [1.5], "precipitation_sum": [0.0, 0.2]}}')
    with open(many, "w") as fh:
        fh.write('[{"latitude": 3.0, "longitude": 4.0, "daily": {"time": ["2024-01-01"],'
                 ' "temperature_2m_mean": [7.0]}}, {"latitude": 5.0, "longitude": 6.0, "daily": null}]')
    p, rejected = docs.scan_provider_payload(spark, workdir + "/*.json")
    assert rejected.collect() == []
    assert p.count() == 3
    rows = docs.payload_rows(p).collect()
    assert len(rows) == 3                                   # null daily -> no rows; time drives the rows
    short = [r for r in rows if str(r.date) == "2024-01-02"][0]
    assert short.temperature_2m_mean is None and short.precipitation_sum == 0.2
    coords = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos int, wmo_index string")
    pairs, report = docs.zip_locations(coords, p.filter(F.col("source").contains("many")).select("pos", "payload"))
    assert pairs.count() == 2 and report.first().mismatch


def test_merge_measurements(spark):
    old = spark.createDataFrame([("2024-01-01", "1", 1.0), ("2024-01-01", "2", 2.0)], "date string, wmo_index string, t double")
    new = spark.createDataFrame([("2024-01-01", "2", None)], "date string, wmo_index string, t double")
    got = {r.wmo_index: r.t for r in docs.merge_measurements(old, new).collect()}
    assert got == {"1": 1.0, "2": None}


def test_request_state_rollup(spark):
    waiters = spark.createDataFrame([("r1", "t1"), ("r1", "t2"), ("r2", "t2"), ("r3", "t3")],
                                    "request_id string, trace_id string")
    out = spark.createDataFrame(
        [("t1", rq.TOPIC_DM_READY, "2024-01-01 00:00:00", "e1", None, None, None),
         ("t2", rq.TOPIC_DM_READY, "2024-01-01 00:00:05", "e2", None, None, None),
         ("t2", rq.TOPIC_FAILED, "2024-01-01 00:00:09", "e3", "dm", "spark_job_failed", "boom")],
        "trace_id string, event_type string, created_at string, event_id string, stage string, reason string, "
        "details string").withColumn("created_at", F.col("created_at").cast("timestamp"))
    st = {r.request_id: r for r in rq.request_status_rollup(waiters, out).collect()}
    assert st["r1"].status == "failed" and st["r1"].error_message == "upstream failure (dm): spark_job_failed — boom"
    assert st["r2"].status == "failed"
    assert st["r3"].status == "pending" and st["r3"].n_pending == 1
    ok_only = out.filter(F.col("event_type") == rq.TOPIC_DM_READY)
    st2 = {r.request_id: r.status for r in rq.request_status_rollup(waiters, ok_only).collect()}
    assert st2 == {"r1": "ready", "r2": "ready", "r3": "pending"}
    timed = rq.request_timeouts(rq.request_status_rollup(waiters, ok_only).withColumn(
        "updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp")), F.lit("2024-01-01 00:10:01").cast("timestamp"))
    assert {r.request_id: r.status for r in timed.collect()} == {"r1": "ready", "r2": "ready", "r3": "failed"}


def test_presentation_maths(spark):
    rows = spark.createDataFrame([("2024-01-01", 2.0, None), ("2024-01-01", -4.0, 1.0), ("2024-01-02", None, 0.0)],
                                 "day string, a double, b double")
    sev = {(r.day, r.a): r.a_severity for r in mx.severity(rows, ["a", "b"]).collect()}
    assert sev[("2024-01-01", 2.0)] == 0.5 and sev[("2024-01-02", None)] == 0.0
    mxabs = mx.column_max_abs(rows, ["a", "b"]).first()
    assert (mxabs.a_max_abs, mxabs.b_max_abs) == (4.0, 1.0)
    long = mx.to_series(rows, ["a", "b"]).collect()
    assert len(long) == 4                                       # null points dropped
    metrics = spark.createDataFrame([(0.5, 3.0, 5.0, None, 1.0, -4.0, 0.0, 0.3)],
                                    "temperature_mae double, temp_min_mae double, temp_max_mae double, "
                                    "precipitation_mm_mae double, temperature_bias double, temp_min_bias double, "
                                    "temp_max_bias double, precipitation_mm_bias double")
    bands = {r.kpi: (r.band, r.needle) for r in mx.kpi_bands(metrics).collect()}
    assert bands["temperature_mae"] == ("good", 0.125) and bands["temp_min_mae"] == ("poor", 0.75)
    assert bands["temp_max_mae"] == ("poor", 1.0) and bands["precipitation_mm_mae"] == (None, 0.0)
    bias = {r.kpi: (r.position_pct, r.intensity) for r in mx.bias_scale(metrics).collect()}
    assert bias["temp_min_bias"] == (-50.0, 1.0) and bias["temperature_bias"][0] == pytest.approx(50 / 3)


def test_manifest_split_and_need_info(spark):
    ev = spark.createDataFrame(
        [("e1", "t1", "b", ["k"], "2024-01-01", "2024-01-02"), ("e2", "", "b", ["k"], "2024-01-01", "2024-01-02"),
         ("e3", "t3", None, ["k"], "2024-01-01", "2024-01-02"), ("e4", "t4", "b", [], "2024-01-01", "x")],
        "event_id string, trace_id string, bucket string, object_keys array<string>, date_from string, "
        "date_to string")
    valid, failures = rq.split_manifests(ev)
    assert [r.event_id for r in valid.collect()] == ["e1"]
    assert failures.count() == 3 and {r.reason for r in failures.collect()} == {rq.INVALID_MANIFEST_REASON}
    ni = spark.createDataFrame(
        [("a", "actual", ["1"], "2024-01-01", "2024-01-02"), (" ", "actual", ["1"], "2024-01-01", "2024-01-02"),
         ("b", None, ["1"], "2024-01-01", "2024-01-02"), ("c", "actual", [], "2024-01-01", "2024-01-02"),
         ("d", "actual", ["1"], "2024-01-03", "2024-01-02"), ("e", "forecast", ["1"], "2024-01-01", "2024-01-01")],
        "event_id string, dataset_type string, wmo_indexes array<string>, date_from string, date_to string")
    assert [r.event_id for r in rq.valid_need_info(rq.route_need_info(ni, "actual")).collect()] == ["a"]


def test_pipeline_state_upsert(spark, workdir):
    from skyledger.sources.tables import STATE_SCHEMA, upsert_state
    path = os.path.join(workdir, "etl_state")
    first = spark.createDataFrame([("p", "last_day", "2024-01-01", None), ("p", "runs", "1", None)], STATE_SCHEMA)
    upsert_state(spark, path, first)
    upsert_state(spark, path, spark.createDataFrame([("p", "runs", "2", None)], STATE_SCHEMA))
    got = {r.key: r.value for r in spark.read.parquet(path).collect()}
    assert got == {"last_day": "2024-01-01", "runs": "2"}


def test_text_functions(spark):
    from skyledger.functions import text as tx
    df = spark.createDataFrame([(" a, b ,,c ", None, "x")], "s string, n string, i string")
    r = df.select(tx.comma_split(F.col("s")).alias("parts"), tx.empty_if_null(F.col("n")).alias("e"),
                  tx.station_label(F.col("n"), F.col("i")).alias("label"),
                  tx.is_empty(tx.remove_from(F.array(F.lit("t1")), F.lit("t1"))).alias("done")).first()
    assert r.parts == ["a", "b", "c"] and r.e == "" and r.label == "x" and r.done


def test_sort_rows_nulls_last_both_ways(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (-2.0, "c")], "x double, k string")
    asc = [r.k for r in mx.sort_rows(df, "x").collect()]
    desc = [r.k for r in mx.sort_rows(df, "x", descending=True).collect()]
    assert asc == ["c", "a", "b"] and desc == ["a", "c", "b"]


def _brute_windows(rows, window_s, limit):
    out = []
    by_id = {}
    for ident, t in rows:
        by_id.setdefault(ident, []).append(t)
    for ident, ts in by_id.items():
        ts.sort()
        i = 0
        while i < len(ts):
            start = ts[i]
            j = i
            while j < len(ts) and ts[j] < start + window_s:
                j += 1
            n = j - i
            out.append((ident, start, n, n > limit, ts[i + limit] if n > limit else None))
            i = j
    return sorted(out, key=lambda r: (r[0], r[1]))


def test_anchored_windows_match_brute_force(spark):
    import random
    from datetime import datetime, timezone
    from skyledger.operators.anchored_windows import anchored_windows
    rnd = random.Random(3)
    rows = []
    for ident, n in (("hot", 3000), ("b", 200), ("c", 50), ("d", 1)):
        t = 1_700_000_000
        for _ in range(n):
            t += rnd.choice([0, 0, 1, 3, 9, 20, 61, 300])       # ties, bursts and gaps
            rows.append((ident, t))
    hits = spark.createDataFrame([(i, datetime.fromtimestamp(t, timezone.utc)) for i, t in rows],
                                 "identity string, ts timestamp")
    limit, window = 10, 60
    got = anchored_windows(hits, window, limit).collect()
    norm = sorted(((r.identity, int(r.window_start.replace(tzinfo=timezone.utc).timestamp()), r.n_hits, r.breached,
                    int(r.first_breach_at.replace(tzinfo=timezone.utc).timestamp()) if r.first_breach_at else None)
                   for r in got), key=lambda r: (r[0], r[1]))
    assert norm == _brute_windows(rows, window, limit)


def test_window_chains_by_brute_force(spark):
    """Borders of stretches and segments: gaps of just under, exactly and over a window, before and after zero."""
    import random
    from skyledger.operators.anchored_windows import in_windows, window_starts
    rnd, width, expected = random.Random(4), 10, {}
    for key in "abc":
        t, start = rnd.randint(-500, 0), None
        for _ in range(150):
            t += rnd.choice([1, 1, 2, 3, 6, width - 1, width, width + 1, 3 * width])
            start = t if start is None or t >= start + width else start
            expected[key, t] = start
    points = spark.createDataFrame(sorted(expected), "k string, t long")
    starts = window_starts(points, ["k"], width)
    assert {(r.k, r.t): r.start for r in in_windows(points, starts, ["k"], width).collect()} == expected
    assert sorted((r.k, r.t) for r in starts.collect()) == sorted({(k, s) for (k, _), s in expected.items()})


def test_station_search_order_and_float_syntax(spark, workdir):
    path = os.path.join(workdir, "s.csv")
    with open(path, "w") as fh:
        fh.write("WMO_index,Station,Region,Latitude,Longitude\n")
        fh.write("111,,1,1_0.5,nan\n")         # first line of 111 has no name
        fh.write("222,Alpha,1,1.0d,2\n")       # '1.0d' is not a float for the loader
        fh.write("111,Alpine,1,,\n")           # 111 gets its name after 222
    station, _members, _skipped = dcsv.scan_station_dimension(spark, path)
    rows = {r.wmo_index: r for r in station.collect()}
    assert rows["111"].lat == 10.5 and rows["111"].lng != rows["111"].lng      # NaN kept, like float('nan')
    assert rows["222"].lat is None
    assert [r.wmo_index for r in dim.search_stations(station, "alp", 5).collect()] == ["222", "111"]


def test_instant_functions(spark):
    from skyledger.functions import timefmt as tf
    r = spark.range(1).select(
        tf.iso_instant_to_ts(F.lit("2026-07-06T15:20:00.123456+03:00")).alias("a"),
        tf.iso_instant_text(tf.iso_instant_to_ts(F.lit("2026-07-06T12:20:00Z"))).alias("b"),
        tf.month_bucket(F.to_date(F.lit("1960-01-31"))).alias("m")).first()
    assert r.a.strftime("%Y-%m-%d %H:%M:%S.%f") == "2026-07-06 12:20:00.000000"   # UTC, cut to seconds
    assert r.b == "2026-07-06T12:20:00.000000Z" and r.m == "196001"


def test_fingerprint_is_python_json(spark):
    import hashlib
    import json
    from skyledger.operators.coverage import request_fingerprint
    ids = [["20674"], ['a"b\\c/', "é ß\u007f", "\n\r\t\b\f\x01", "🙂 中", ""], [], ["x", None]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "i int, ids array<string>")
    got = {r.i: r.k for r in df.select("i", request_fingerprint(F.lit("/p"), F.lit("2024-01-01"), F.lit("2024-02-01"), F.col("ids"), "station ids").alias("k")).collect()}
    for i, x in enumerate(ids[:3]):
        body = json.dumps({"from": "2024-01-01", "to": "2024-02-01", "station ids": x}, sort_keys=True)
        assert got[i] == "/p:" + hashlib.sha256(body.encode()).hexdigest(), x
