"""Work that grows no faster than its input: stretches of days, bounded batches, files and tasks."""

import os
import random
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import functions as F

from skyledger.sources import documents as docs
from skyledger.streaming import rate_limits as rl
from skyledger.streaming import request_state as rs


def test_locks_are_held_by_stretches_of_days(spark, workdir, monkeypatch):
    """Ranges of days over batches, some tried again, equal the same cells day by day, in far fewer rows; nothing staged is left."""
    from test_streaming import _fold_cells
    from skyledger.session import scratch_dir
    made = []
    monkeypatch.setattr(rs, "scratch_dir", lambda s, purpose: made.append(scratch_dir(s, purpose)) or made[-1])
    monkeypatch.setattr(rs, "SNAPSHOT_EVERY", 2)
    monkeypatch.setattr(rs, "ROUNDS", 2)
    rnd, start, first = random.Random(11), 1_780_000_000, date(1969, 11, 1)
    batches, n = [], 0
    for b in range(3):
        batch = []
        for _ in range(12):
            n += 1
            t = None if rnd.random() < 0.1 else start + b * 500 + rnd.randint(-900, 2500)
            low = first + timedelta(rnd.randint(0, 200))
            batch.append((rnd.choice(["1", "hot"]), low, low + timedelta(rnd.choice([0, 3, 90, 150])), f"e{n:03}", f"t{n:03}", t))
        batches.append(batch)
    now, locks, out = F.lit(datetime(2026, 7, 6, tzinfo=timezone.utc)), os.path.join(workdir, "locks"), os.path.join(workdir, "answers")
    schema = "dataset_type string, wmo_index string, first_day date, last_day date, event_id string, trace_id string, created_ts timestamp"
    for epoch, batch in enumerate(batches):
        rows = [("actual", k, a, z, e, tr, None if t is None else datetime.fromtimestamp(t, timezone.utc)) for k, a, z, e, tr, t in batch]
        for _ in range(2 if epoch == 1 else 1):
            rs.process_lock_batch(spark.createDataFrame(rows, schema), epoch, lock_path=locks, answer_path=out, now=now)
    by_day = [[((k, a + timedelta(i)), e, tr, t) for k, a, z, e, tr, t in batch for i in range((z - a).days + 1)] for batch in batches]
    got = sorted(((r.wmo_index, r.day), r.event_id, r.owner_trace_id, r.acquired) for r in rs.read_answers(spark, out).collect())
    assert got == _fold_cells(by_day)
    assert rs.read_answers(spark, out, by_day=False).count() < len(got) / 4
    assert len(made) == 4 and not any(map(os.path.exists, made))


class _State:
    def __init__(self):
        self.value, self.now, self.hasTimedOut, self.timer = None, 0, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def getCurrentProcessingTimeMs(self):
        return self.now

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.timer = self.now + ms


def test_a_call_counts_many_identities_in_one_frame():
    """Windows of several identities in one call give one frame; each identity's state goes by its own silence."""
    import pandas as pd
    fn, state = rl._breach_fn(1, 60, 100), _State()
    hits = lambda *rows: iter([pd.DataFrame({"identity": [r[0] for r in rows], "ts": pd.to_datetime([r[1] for r in rows], unit="s")})])
    frames = list(fn((0,), hits(("a", 10), ("b", 5), ("a", 0), ("a", 70), ("b", 6), ("a", 71)), state))
    assert len(frames) == 1
    assert sorted(zip(frames[0].identity, frames[0].hit_no)) == [("a", 2), ("a", 2), ("b", 2)]
    state.now = 60_000
    late = list(fn((0,), hits(("b", 7)), state))
    assert late[0].hit_no.tolist() == [3] and state.timer == 100_000
    state.now, state.hasTimedOut = 100_000, True
    assert not list(fn((0,), iter([]), state)) and state.value[0] == ["b"] and state.timer == 160_000
    state.now = 160_000
    assert not list(fn((0,), iter([]), state)) and not state.exists


def _parses(df, name):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.lower().count(name)


def test_payloads_and_events_are_parsed_once(spark):
    from skyledger.schemas import DM_READY_EVENT
    from skyledger.sources.events import parse_events
    text = spark.createDataFrame([(1, '{"latitude": 1.0}'), (2, ' [ {"latitude": 2}, 5, {"latitude": "x"}]'), (3, "17"), (4, "[1"), (5, None), (6, "[]"), (7, "null")],
                                 "k int, value string")
    good, rejected = docs.split_payload_text(text)
    assert sorted((r.k, r.pos) for r in good.collect()) == [(1, 0), (2, 0)]
    assert sorted((r.k, r.pos, r.reason) for r in rejected.filter("k <> 2").collect()) == [(3, None, "not_a_payload"), (4, None, "malformed"), (5, None, "malformed"),
                                                                                            (7, None, "not_a_payload")]
    assert sorted((r.pos, r.reason, r.raw_value) for r in rejected.filter("k = 2").collect()) == [(1, "wrong_type", "5"), (2, "wrong_type", '{"latitude":"x"}')]
    raw = spark.createDataFrame([('{"trace_id": "t"}', "x")], "value string, topic string")
    fine, bad = parse_events(raw, DM_READY_EVENT)
    rows = docs.payload_rows(good, keep=["k", "pos"])
    assert [_parses(df, "jsontostructs(") + _parses(df, "from_json(") for df in (good, rejected, rows, fine, bad)] == [1] * 5


def test_deliveries_have_few_files(spark, workdir):
    import __spark_entry__  # noqa: F401
    from skyledger.plans.catalog_streaming import _publish
    _publish(spark.range(200, numPartitions=20).select(F.col("id").cast("string").alias("event_id")), workdir, "t", copies=2)
    assert len([x for x in os.listdir(f"{workdir}/topic=t") if x.endswith(".txt")]) <= 8
    assert spark.read.text(workdir).count() == 400


def test_dimension_lines_are_written_by_many_tasks(spark, workdir, monkeypatch):
    """The last name in order of the key wins, whichever file it is in."""
    import __spark_entry__  # noqa: F401
    from skyledger.plans import catalog_layers as layers
    csv = f"{workdir}/stations csv"
    monkeypatch.setattr(layers, "scratch_dir", lambda s, purpose: csv)
    spark.range(1, 400).selectExpr("id AS o_orderkey", "id % 3 AS o_custkey", "'1-URGENT' AS o_orderpriority").repartition(3).write.parquet(f"{workdir}/orders.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.wmo_index: r.name for r in layers.q_dimension_csv(spark, workdir).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    last = {k % 3: k for k in range(1, 400) if k % 13 and k % 5}
    assert got == {str(c): f'St. "1-URGENT", {k}' for c, k in last.items()}
    assert len([x for x in os.listdir(csv) if x.endswith(".csv")]) > 1


def test_tasks_take_bounded_partitions(spark):
    from skyledger.session import apply_defaults
    assert int(apply_defaults(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) <= 64 << 20


def test_workers_keep_no_tokenizer(spark):
    from skyledger.llm import token_ids
    from skyledger.llm.packing import token_pieces
    docs_ = spark.createDataFrame([(i, "a few words") for i in range(40)], "doc_id long, text string").repartition(4)
    assert token_pieces(docs_, token_ids.tokenizer_path()).count() == 40

    def kept(batches):
        import pyarrow as pa
        from skyledger.llm import token_ids as own
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(own._encoders)])], ["n"])

    assert spark.range(40, numPartitions=8).mapInArrow(kept, "n long").agg(F.max("n")).first()[0] == 0


def test_locations_are_paired_without_a_table_of_all_orders(spark, workdir):
    """Lines meet their orders by a merge join (a broadcast grows with the orders); keys repeat and are null, the shorter side cuts."""
    from skyledger.plans import catalog_layers as layers
    from skyledger.session import apply_defaults
    apply_defaults(spark)
    spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "o_orderkey long").write.parquet(f"{workdir}/zip/orders.parquet")
    lines = [(1, 5, 71, 1, "N"), (1, 5, 72, 2, "R"), (1, 5, 73, 3, None), (1, 5, 74, 4, "A"), (2, 5, 75, 1, "N"), (3, 5, 76, 1, "R"),
             (None, 5, 77, 1, "N"), (9, 5, 78, 1, "N")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string") \
        .selectExpr("*", "date'2024-01-01' AS l_shipdate", "1.0D AS l_quantity").write.parquet(f"{workdir}/zip/lineitem.parquet")
    pairs = layers.q_zip_locations(spark, f"{workdir}/zip")
    assert sorted(map(tuple, pairs.collect())) == [(1, 0, "71"), (1, 1, "72"), (2, 0, "75"), (2, 1, "75")]
    lookups = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert lookups.count("rightHint=(strategy=merge)") == 2
    assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) <= 16 << 20
