"""Golden values, idempotence and order independence of the write path."""

from pyspark.sql import functions as F

from helpers import write_document
from skyledger.plans.write_path import Manifest, read_current_dm, read_current_errors, run_manifest
from skyledger.sources import documents as docs

ACTUAL = [
    {"wmo_index": 20674, "name": "Ostrov Dikson", "country": "RU",
     "min_temp": -35.1, "avg_temp": -31.9, "max_temp": -25.9, "precipitation": 0},
    {"wmo_index": "20891", "name": "Hatanga", "country": "RU",
     "min_temp": -29.0, "avg_temp": -27.5, "max_temp": -24.6, "precipitation": None},
]
FORECAST = [
    {"wmo_index": "20674", "name": "Ostrov Dikson", "country": "RU",
     "min_temp": -33.0, "avg_temp": -30.0, "max_temp": -24.0, "precipitation": 0.5},
    {"wmo_index": 20891, "name": "Hatanga", "country": "RU",
     "min_temp": -28.0, "avg_temp": -26.5, "max_temp": -23.6, "precipitation": 1.0},
]


def manifest(ds, eid="e1", day="1960-01-01"):
    return Manifest(dataset_type=ds, date_from=day, date_to=day, trace_id=f"t-{ds}-{eid}", event_id=eid,
                    bucket="weather-raw", source_name=f"{ds}_fetcher", created_at="2026-07-06T12:20:00.5Z")


def _errors(spark, root):
    rows = read_current_errors(spark, root).orderBy("wmo_index").collect()
    return {r.wmo_index: r for r in rows}


def test_golden_pair(spark, workdir):
    raw_root, tables = f"{workdir}/raw", f"{workdir}/tables"
    write_document(raw_root, "actual", "1960-01-01", ACTUAL)
    write_document(raw_root, "forecast", "1960-01-01", FORECAST)
    s1 = run_manifest(spark, raw_root, tables, manifest("actual"))
    assert s1["record_count"] == 2
    # Only one side so far: no mart rows.
    assert _errors(spark, tables) == {} or len(_errors(spark, tables)) == 0
    run_manifest(spark, raw_root, tables, manifest("forecast"))
    err = _errors(spark, tables)
    g = err["20674"]
    assert round(g.temperature_error, 6) == 1.9
    assert round(g.temp_min_error, 6) == 2.1
    assert round(g.temp_max_error, 6) == 1.9
    assert round(g.precipitation_mm_error, 6) == 0.5
    assert g.temperature_abs_error == abs(g.temperature_error)
    # A pair with a null metric still yields a row; the metric error is null.
    h = err["20891"]
    assert h.precipitation_mm_error is None and round(h.temperature_error, 6) == 1.0


def test_idempotent_rerun_and_order_independence(spark, workdir):
    raw_root = f"{workdir}/raw"
    write_document(raw_root, "actual", "1960-01-01", ACTUAL)
    write_document(raw_root, "forecast", "1960-01-01", FORECAST)
    a, b = f"{workdir}/t1", f"{workdir}/t2"
    run_manifest(spark, raw_root, a, manifest("actual"))
    run_manifest(spark, raw_root, a, manifest("forecast"))
    run_manifest(spark, raw_root, b, manifest("forecast"))
    run_manifest(spark, raw_root, b, manifest("actual"))
    run_manifest(spark, raw_root, b, manifest("actual", eid="e2"))      # re-delivery / re-run
    cols = ["wmo_index", "day", "temperature_error", "temp_min_error", "temp_max_error", "precipitation_mm_error"]
    ra = sorted(tuple(r) for r in read_current_errors(spark, a).select(*cols).collect())
    rb = sorted(tuple(r) for r in read_current_errors(spark, b).select(*cols).collect())
    assert ra == rb and len(ra) == 2
    assert read_current_dm(spark, b, "actual").count() == 2            # one row per key after re-run


def test_missing_file_fails(spark, workdir):
    raw_root = f"{workdir}/raw"
    write_document(raw_root, "actual", "1960-01-01", ACTUAL)
    m = Manifest("actual", "1960-01-01", "1960-01-02", "t", "e", "b", "s", "2026-01-01T00:00:00Z")
    try:
        run_manifest(spark, raw_root, f"{workdir}/t", m)
    except Exception as exc:  # noqa: BLE001
        assert "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc).lower()
    else:
        raise AssertionError("a missing daily file must fail the run")


def test_document_edge_cases(spark, workdir):
    root = f"{workdir}/raw"
    write_document(root, "actual", "1960-01-01", [
        {"wmo_index": 1, "name": "", "country": "", "min_temp": None, "avg_temp": None, "max_temp": None,
         "precipitation": None},
        {"wmo_index": "2", "name": "B", "country": "X", "min_temp": -1, "avg_temp": 0, "max_temp": 3,
         "precipitation": 0},
        {"wmo_index": "2", "name": "B", "country": "X", "min_temp": -2, "avg_temp": 0, "max_temp": 3,
         "precipitation": 0}])
    write_document(root, "actual", "1960-01-02", [])
    d = docs.scan_daily_documents(spark, root, "actual", "1960-01-01", "1960-01-02")
    rows = docs.explode_stations(d).select("observation_date", "station.*", "raw_object_key").collect()
    assert len(rows) == 3                                     # empty list -> no rows
    assert {r.wmo_index for r in rows} == {"1", "2"}          # number and string ids -> string
    assert all(r.raw_object_key == "actual/date=1960-01-01.json" for r in rows)
    nulls = [r for r in rows if r.wmo_index == "1"][0]
    assert nulls.avg_temp is None and nulls.min_temp is None
    whole = [r for r in rows if r.wmo_index == "2"][0]
    assert isinstance(whole.max_temp, float)


def test_partitioned_documents_roundtrip(spark, workdir):
    rows = spark.createDataFrame(
        [("1960-01-01", "1", "A", "X", -1.0, 0.0, 1.0, None), ("1960-01-02", "1", "A", "X", -2.0, 0.0, 2.0, 0.5)],
        "date string, wmo_index string, name string, country string, min_temp double, avg_temp double, "
        "max_temp double, precipitation double")
    docs.write_daily_documents(rows, f"{workdir}/docs", "forecast")
    back = docs.explode_stations(docs.scan_daily_documents(spark, f"{workdir}/docs", "forecast", "1960-01-02",
                                                           "1960-01-02", layout="partitioned"))
    got = back.select("observation_date", "station.wmo_index", "station.max_temp", "raw_object_key").collect()
    assert len(got) == 1 and got[0].max_temp == 2.0 and got[0].raw_object_key == "forecast/date=1960-01-02"
    by_date = docs.measurements_by_date(rows.withColumn("date", F.to_date("date"))).collect()
    assert [len(r.stations) for r in by_date] == [1, 1]


def test_replace_days_and_compaction_on_disk(spark, workdir):
    from skyledger.sources import tables as tb
    path = f"{workdir}/dm"
    first = spark.createDataFrame(
        [("1", "2024-01-01", 1.0, "t1"), ("1", "2024-01-02", 2.0, "t1"), ("2", "2024-02-01", 3.0, "t1")],
        "wmo_index string, day string, temperature double, trace_id string").withColumn("day", F.to_date("day"))
    tb.replace_days(spark, first, path)
    again = spark.createDataFrame([("9", "2024-01-02", 9.0, "t2")],
                                  "wmo_index string, day string, temperature double, trace_id string") \
        .withColumn("day", F.to_date("day"))
    tb.replace_days(spark, again, path)
    got = sorted((r.wmo_index, str(r.day), r.temperature) for r in spark.read.parquet(path).collect())
    assert got == [("1", "2024-01-01", 1.0), ("2", "2024-02-01", 3.0), ("9", "2024-01-02", 9.0)]
    # Append a newer version of a key, then compact the touched month.
    newer = spark.createDataFrame([("1", "2024-01-01", 5.0, "t3")],
                                  "wmo_index string, day string, temperature double, trace_id string") \
        .withColumn("day", F.to_date("day"))
    tb.append_layer(newer, path)
    assert spark.read.parquet(path).count() == 4
    tb.compact_current(spark, path, ["wmo_index", "day"], "trace_id")
    got = sorted((r.wmo_index, str(r.day), r.temperature, r.month) for r in spark.read.parquet(path).collect())
    assert got == [("1", "2024-01-01", 5.0, "202401"), ("2", "2024-02-01", 3.0, "202402"),
                   ("9", "2024-01-02", 9.0, "202401")]


def _rows(spark, rows):
    return spark.createDataFrame(rows, "wmo_index string, day string, temperature double").withColumn("day", F.to_date("day"))


def test_rewrite_that_breaks_off_is_repeated_from_its_copy(spark, workdir, monkeypatch):
    from skyledger.sources import paths
    from skyledger.sources import tables as tb
    path = f"{workdir}/my table"
    tb.replace_days(spark, _rows(spark, [("1", "2024-01-01", 1.0), ("1", "2024-02-01", 2.0), ("1", "2024-03-01", 3.0)]), path)

    def broken(spark, copy, path, *rest):
        paths.remove_tree(spark, f"{path}/month=202401")                 # the overwrite ends when it has removed a partition
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(paths, "_overwrite", broken)
        try:
            tb.replace_days(spark, _rows(spark, [("2", "2024-01-01", 9.0), ("2", "2024-02-02", 8.0)]), path)
        except RuntimeError:
            pass
    assert spark.read.parquet(path).filter("month = '202401'").count() == 0
    # a copy that was never finished goes
    _rows(spark, [("7", "2024-01-01", 7.0)]).write.parquet(f"{path}/_rewrite-half")
    paths.remove_tree(spark, f"{path}/_rewrite-half/_SUCCESS")
    tb.replace_days(spark, _rows(spark, [("3", "2024-03-01", 5.0)]), path)
    got = sorted((r.wmo_index, str(r.day), r.temperature) for r in spark.read.parquet(path).collect())
    assert got == [("1", "2024-02-01", 2.0), ("2", "2024-01-01", 9.0), ("2", "2024-02-02", 8.0), ("3", "2024-03-01", 5.0)]
    assert [n for n in paths.child_names(spark, path) if n.startswith("_rewrite")] == []


def test_state_of_one_pipeline_leaves_the_others(spark, workdir):
    from skyledger.sources import tables as tb
    path = f"{workdir}/pipeline state"
    rows = lambda *r: spark.createDataFrame([(p, k, v, None) for p, k, v in r], tb.STATE_SCHEMA)
    tb.upsert_state(spark, path, rows(("a=1/b", "x", "1"), ("c", "x", "2")))
    other = {f for f in spark.read.schema(tb.STATE_SCHEMA).parquet(path).inputFiles() if "pipeline_name=c" in f}
    tb.upsert_state(spark, path, rows(("a=1/b", "x", "3"), ("a=1/b", "y", "4")))
    read = spark.read.schema(tb.STATE_SCHEMA).parquet(path).select("pipeline_name", "key", "value")
    assert sorted(tuple(r) for r in read.collect()) == [("a=1/b", "x", "3"), ("a=1/b", "y", "4"), ("c", "x", "2")]
    assert other <= set(read.inputFiles())


def test_producers_objects_and_merge(spark, workdir):
    import json
    root, schema = f"{workdir}/raw data", "date string, wmo_index string, name string, country string, min_temp double, avg_temp double, max_temp double, precipitation double"
    rows = [("2024-01-01", str(i), f'"n" {i}\\', "é", float(i), None, 1e-7, 0.0) for i in (30, 4, 100)] + [("2024-01-02", "7", None, None, None, None, None, None), (None, "9", "x", "y", 0., 0., 0., 0.)]
    docs.write_documents(spark, spark.createDataFrame(rows, schema), root, "actual")
    first = json.load(open(f"{root}/actual/date=2024-01-01.json"))
    assert first["date"] == "2024-01-01" and [s["wmo_index"] for s in first["stations"]] == ["100", "30", "4"]
    assert list(first["stations"][1].values()) == ["30", '"n" 30\\', "é", 30.0, None, 1e-7, 0.0]
    assert json.load(open(f"{root}/actual/date=2024-01-02.json"))["stations"] == [dict.fromkeys(first["stations"][0], None) | {"wmo_index": "7"}]
    with open(f"{root}/actual/date=2024-01-03.json", "w") as fh:
        fh.write('{"date":"2024-01-03","stations":[{"wmo_index"')                # unreadable: counts as absent
    before = open(f"{root}/actual/date=2024-01-02.json").read()
    fresh = [("2024-01-01", "5", "new", None, None, None, None, None), ("2024-01-01", "30", None, None, None, 2.0, None, None),
             ("2024-01-03", "1", "a", None, None, None, None, None), ("2024-01-04", "1", "b", None, None, None, None, None)]
    keys = docs.merge_into_documents(spark, spark.createDataFrame(fresh, schema), root, "actual")
    assert keys == [f"actual/date=2024-01-0{i}.json" for i in (1, 3, 4)]
    got = json.load(open(f"{root}/actual/date=2024-01-01.json"))["stations"]
    assert [(s["wmo_index"], s["name"], s["avg_temp"]) for s in got] == [("100", '"n" 100\\', None), ("30", None, 2.0), ("4", '"n" 4\\', None), ("5", "new", None)]
    assert [len(json.load(open(f"{root}/{k}"))["stations"]) for k in keys] == [4, 1, 1]
    assert open(f"{root}/actual/date=2024-01-02.json").read() == before              # untouched days are not rewritten


def test_empty_fresh_rows_write_nothing(spark, workdir):
    schema = "date string, wmo_index string, name string, country string, min_temp double, avg_temp double, max_temp double, precipitation double"
    assert docs.merge_into_documents(spark, spark.createDataFrame([], schema), f"{workdir}/raw", "forecast") == []
