"""What operators 2 and 8 and the pipeline leave on disk and hold in memory on their way."""

import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import decontaminate, kernels, near_dedup, packing, suffix_dedup
from skyledger.llm.common import BATCH_BYTES, BATCHES, CLEANUP, READ_ROWS, READS, small_batches, staged

LARGE = "64m"


@pytest.fixture
def large_batches(spark):
    before = spark.conf.get(BATCHES)
    spark.conf.set(BATCHES, LARGE)
    yield
    spark.conf.set(BATCHES, before)


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for name in (blocks.apply(i).name() for i in range(blocks.size())) if name.startswith("shuffle_")}


def left(spark, before):
    """Shuffle files that came since and have not gone after some seconds."""
    for _ in range(50):
        found = shuffle_files(spark) - before
        if not found:
            break
        time.sleep(0.2)
    return found


def test_shuffle_files_of_a_staged_table_go(spark):
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP)
    counts = staged(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "test-staged")
    assert not left(spark, before)
    assert spark.conf.get(CLEANUP) == setting
    assert {r["count"] for r in counts.collect()} == {142, 143}


def test_large_rows_lie_in_small_row_groups(spark):
    rows = spark.range(0, 24, 1, 1).select("id", F.repeat(F.lit("x"), 1 << 20).cast("binary").alias("payload"))
    back = staged(rows, "test-large-rows", large_rows=True)
    files = [pq.ParquetFile(path.removeprefix("file://").removeprefix("file:")) for path in back.inputFiles()]
    groups = [f.metadata.row_group(i) for f in files for i in range(f.num_row_groups)]
    assert sum(g.num_rows for g in groups) == 24 and max(g.num_rows for g in groups) <= 10
    assert {(r.id, r.n) for r in back.select("id", F.length("payload").alias("n")).collect()} == {(i, 1 << 20) for i in range(24)}


def test_no_tables_stay_after_a_task():
    def run(batches):
        for data in batches:
            yield len(kernels.byte_rolling(data).windows(2))

    assert list(kernels.released(run)([np.zeros(9, np.uint8)])) == [8] and not kernels._tables


def test_repeated_bytes_leave_no_shuffle_files_on_the_way(spark, docs):
    before = shuffle_files(spark)
    suffix_dedup.removal_report(docs.coalesce(1))                  # all but the last step has run
    assert not left(spark, before)


def test_rows_go_to_workers_in_small_batches(spark, large_batches):
    rows = spark.range(0, 24, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    def most():
        return [r.n for r in rows.mapInArrow(sizes, "n long").collect()]

    assert max(most()) > 8
    small_batches(spark)
    assert max(most()) <= (BATCH_BYTES >> 20) + 1 and sum(most()) == 24


@pytest.mark.parametrize("allowed, then", [("1m", "1m"), ("4096k", "4096k"), ("1g", str(BATCH_BYTES)), ("67108864b", str(BATCH_BYTES))])
def test_smaller_batches_stay(spark, large_batches, allowed, then):
    spark.conf.set(BATCHES, allowed)
    small_batches(spark)
    assert spark.conf.get(BATCHES).rstrip("b") == then


def test_every_stage_sends_small_batches(spark, docs, large_batches, monkeypatch):
    for name in ("accepted_documents", "one_of_each", "without_repeated_bytes", "without_contaminated", "pack_documents", "table", "tokenizer_path"):
        monkeypatch.setattr(corpus_pipeline, name, lambda *a, **b: docs)
    for _, stage in corpus_pipeline.STAGES:
        spark.conf.set(BATCHES, LARGE)
        stage(spark, docs, "")
        assert spark.conf.get(BATCHES).rstrip("b") == str(BATCH_BYTES)


def test_the_query_sends_small_batches(spark, docs, large_batches):
    suffix_dedup.removal_report(docs)
    assert spark.conf.get(BATCHES).rstrip("b") == str(BATCH_BYTES)


def test_a_groups_function_gives_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(kernels, "_give_back", lambda: given.append(1))
    assert kernels.released_group(lambda table: table.num_rows)(pa.table({"a": [1, 2]})) == 2 and given == [1]
    with pytest.raises(ZeroDivisionError):
        kernels.released_group(lambda table: 1 // 0)(pa.table({"a": [1]}))
    assert given == [1, 1]


def test_search_and_filter_share_a_worker(spark):
    words = [f"w{k}" for k in range(26)]
    items = spark.createDataFrame([("a", " ".join(words[:13])), ("b", " ".join(words[13:]))], "item_id string, text string")
    docs = spark.createDataFrame([(1, " ".join(words[:13])), (2, "clean text"), (3, " ".join(words[13:])), (4, None)], "doc_id long, text string")
    for options, searches in (({}, 1), ({"block_words": 1}, 2)):
        left_over = decontaminate.without_contaminated(docs, items, **options)
        assert left_over._jdf.queryExecution().analyzed().toString().count("MapInArrow") == searches
        assert sorted(r.doc_id for r in left_over.collect()) == [2, 4]


class Worker:
    """Stands for a table; keeps the function that would run in the workers."""

    def __init__(self, schema):
        self.schema, self.run = schema, None

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        self.run = run
        return self


@pytest.fixture(scope="module")
def batch():
    """4 MB of words, as a worker gets them."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=300)) for _ in range(2000)]
    return pa.RecordBatch.from_arrays([pa.array(range(2000), pa.int64()), pa.array(texts)], ["doc_id", "text"])


def most_held(make, schema, batch):
    """MB that Python's and numpy's memory grows by at most while the worker's function goes through the batch twice."""
    run = make(Worker(schema)).run
    sum(b.num_rows for b in run(iter([batch])))                   # what is made once
    tracemalloc.start()
    try:
        rows = sum(b.num_rows for b in run(iter([batch, batch])))
        return rows, tracemalloc.get_traced_memory()[1] / (1 << 20)
    finally:
        tracemalloc.stop()


def test_a_packing_worker_holds_little(docs, batch):
    rows, mb = most_held(lambda d: packing.token_pieces(d, packing.tokenizer_path(), keep=corpus_pipeline.KEPT_PIECES), docs.schema, batch)
    assert rows >= 2 * 2000 and mb < 48


def test_a_sketching_worker_holds_little(docs, batch):
    rows, mb = most_held(lambda d: near_dedup.sketches(d, percent=near_dedup.CORPUS_PERCENT), docs.schema, batch)
    assert rows == 2 * 2000 and mb < 40


@pytest.mark.parametrize("allowed, then", [("4096", READ_ROWS), ("64", 64)])
def test_files_are_read_in_small_batches(spark, docs, monkeypatch, allowed, then):
    for name in ("accepted_documents", "one_of_each", "without_repeated_bytes", "without_contaminated", "pack_documents", "table", "tokenizer_path"):
        monkeypatch.setattr(corpus_pipeline, name, lambda *a, **b: docs)
    before = spark.conf.get(READS)
    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(READS, allowed)
            stage(spark, docs, "")
            assert int(spark.conf.get(READS)) == then
    finally:
        spark.conf.set(READS, before)
