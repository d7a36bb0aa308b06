"""Property tests: newest-wins, the one-aggregation pairing and coverage against
plain-Python models on generated inputs (SURVEY §5 invariants)."""

from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skyledger.operators import coverage as cov
from skyledger.operators.current import current
from skyledger.operators.layers import current_pairs, error_mart, forecast_error

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(
    st.tuples(st.sampled_from(["actual", "forecast"]), st.sampled_from(["a", "b", "c"]), st.integers(0, 3),
              st.one_of(st.none(), st.floats(-40, 40, allow_nan=False)), st.integers(0, 4), st.integers(0, 50)),
    min_size=1, max_size=40)


def _frame(spark, rows):
    base = date(2024, 1, 1)
    data = [(ds, st_, base + timedelta(days=d), v, v, v, v, f"{ds}-{seq}", ver, seq)
            for ds, st_, d, v, ver, seq in rows]
    return spark.createDataFrame(
        data, "dataset_type string, wmo_index string, day date, temperature double, temp_min double, "
              "temp_max double, precipitation_mm double, trace_id string, ingested_at long, seq long")


def _newest(rows, ds):
    best = {}
    for r in rows:
        if r[0] != ds:
            continue
        key, rank = (r[1], r[2]), (r[4], r[5])
        if key not in best or rank > best[key][0]:
            best[key] = (rank, r[3])
    return {k: v[1] for k, v in best.items()}


@SETTINGS
@given(rows=rows_st)
def test_current_and_pairing_match_model(spark, rows):
    # Unique (dataset, key, version, seq) so "newest" is well defined.
    seen, uniq = set(), []
    for r in rows:
        k = (r[0], r[1], r[2], r[4], r[5])
        if k not in seen:
            seen.add(k)
            uniq.append(r)
    df = _frame(spark, uniq)
    w, f = _newest(uniq, "actual"), _newest(uniq, "forecast")
    cur = {(r.wmo_index, (r.day - date(2024, 1, 1)).days): r.temperature
           for r in current(df.filter("dataset_type = 'actual'").drop("dataset_type"),
                            ["wmo_index", "day"], "ingested_at", "seq").collect()}
    assert cur == w
    expected = {k: (None if w[k] is None or f[k] is None else f[k] - w[k]) for k in w.keys() & f.keys()}
    one_pass = {(r.wmo_index, (r.day - date(2024, 1, 1)).days): r.temperature_error
                for r in forecast_error(current_pairs(df)).collect()}
    assert one_pass == expected
    sides = [current(df.filter(F.col("dataset_type") == ds).drop("dataset_type"), ["wmo_index", "day"],
                     "ingested_at", "seq") for ds in ("actual", "forecast")]
    joined = {(r.wmo_index, (r.day - date(2024, 1, 1)).days): r.temperature_error
              for r in error_mart(*sides).collect()}
    assert joined == expected                       # both pairing plans agree
    for r in forecast_error(current_pairs(df)).collect():
        if r.temperature_error is not None:
            assert r.temperature_abs_error == abs(r.temperature_error)


cells_st = st.sets(st.tuples(st.sampled_from(["s1", "s2", "s3"]), st.integers(0, 20)), max_size=40)


@SETTINGS
@given(cells=cells_st, stations=st.sets(st.sampled_from(["s1", "s2", "s3"]), min_size=1),
       lo=st.integers(0, 20), span=st.integers(-2, 20))
def test_coverage_model(spark, cells, stations, lo, span):
    base = date(2024, 1, 1)
    err = spark.createDataFrame([(s, base + timedelta(days=d)) for s, d in cells] or [("zz", base)],
                                "wmo_index string, day date")
    rs = spark.createDataFrame([("r", s) for s in sorted(stations)], "request_id string, wmo_index string")
    rr = spark.createDataFrame([("r", base + timedelta(days=lo), base + timedelta(days=lo + span))],
                               "request_id string, date_from date, date_to date")
    want = [lo + i for i in range(span + 1)] if span >= 0 else []
    covered = {d for d in want if all((s, d) in cells for s in stations)}
    got_cov = {(r.day - base).days for r in cov.covered_days(err, rs, rr).collect()}
    assert got_cov == covered
    missing = sorted(set(want) - covered)
    got_missing = sorted((r.day - base).days for r in cov.missing_days(err, rs, rr).collect())
    assert got_missing == missing
    ranges = [((r.range_start - base).days, (r.range_end - base).days)
              for r in cov.missing_ranges(err, rs, rr).collect()]
    re_expanded = sorted(d for a, b in ranges for d in range(a, b + 1))
    assert re_expanded == missing                   # ranges re-expand to exactly the missing days
    starts = sorted(a for a, _ in ranges)
    assert all(b - a >= 2 for a, b in zip([e for _, e in sorted(ranges)], starts[1:]))   # gaps between ranges
