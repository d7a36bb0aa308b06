"""Token files against the tokenizer's plain call, and what their readers skip."""

import glob
import zlib

import numpy as np
import pytest
from pyarrow import orc
from tokenizers import Tokenizer

from skyledger.llm import token_files
from skyledger.llm.token_ids import tokenizer_path
from skyledger.session import scratch_dir


def expected(rows):
    """[(doc_id, start, n_tokens, crc)] of rows with distinct ids."""
    tokenizer, out, start = Tokenizer.from_file(tokenizer_path()), [], 0
    for d, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def read(spark, path):
    got = token_files.with_crc(token_files.token_rows(spark, path)).collect()
    starts = {(r.part, r.part_start): r.start for r in token_files.token_rows(spark, path).collect()}
    return sorted(((r.doc_id, starts[r.part, r.part_start], r.n_tokens, r.ids_crc32) for r in got), key=lambda r: r[1])


@pytest.fixture(scope="module")
def written(spark, docs):
    path = scratch_dir(spark, "test-tokens")
    token_files.write_token_files(docs.repartition(3), path, tokenizer_path(), index_rows=1000)
    return path


def test_round_trip(spark, rows, written):
    assert read(spark, written) == expected(rows)
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {r.doc_id: r.ids for r in token_files.token_rows(spark, written).collect()}
    assert all(ids[d] == tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for d, t, *_ in rows)


def test_files_are_in_order(spark, written):
    last = -1
    for name in sorted(glob.glob(f"{written}/part-*.orc")):
        for doc in orc.ORCFile(name).read(["doc_id"]).column(0).to_pylist():
            assert doc > last
            last = doc


def test_stretches_of_the_stream(spark, rows, written):
    whole = np.concatenate([np.array(r.ids) for r in sorted(token_files.token_rows(spark, written).collect(), key=lambda r: r.start)])
    for first, end in [(0, 10), (37, 900), (1500, 1501), (len(whole) - 5, len(whole) + 40), (0, len(whole)), (len(whole), len(whole) + 3), (9, 9)]:
        got = sorted(token_files.ids_between(spark, written, first, end).collect(), key=lambda r: r.position)
        flat = [x for r in got for x in r.ids]
        assert flat == whole[first:end].tolist() and (not flat or got[0].position == first)


def scanned(df):
    """Rows that the scan gave after pruning."""
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_pruned_by_index_and_bloom_filter(spark):
    rows = [(2 * i, f"text {i}") for i in range(40_000)]
    path = scratch_dir(spark, "test-tokens")
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), path, tokenizer_path(), index_rows=1000)
    one = token_files.documents_of(spark, path, [2 * 777])
    assert "PushedFilters: [In(doc_id" in one._jdf.queryExecution().toString() or "EqualTo(doc_id" in one._jdf.queryExecution().toString()
    assert 0 < scanned(one) < 10_000 and [r.doc_id for r in one.collect()] == [1554]
    absent = token_files.documents_of(spark, path, [3, 1555, 70_001])    # within the statistics, held back by Bloom filters
    assert scanned(absent) < 10_000 and absent.collect() == []
    streams = orc.ORCFile(sorted(glob.glob(f"{path}/part-*.orc"))[0])
    assert streams.nrows > 0 and streams.nstripes >= 1


def test_odd_rows(spark, empty):
    path = scratch_dir(spark, "test-tokens")
    token_files.write_token_files(empty, path, tokenizer_path())
    assert read(spark, path) == []
    rows = [(None, "null id"), (5, None), (3, ""), (-4, "<|endoftext|> x"), (9, "word " * 60_000)]
    path = scratch_dir(spark, "test-tokens")
    wide = spark.createDataFrame([(*r, 1, 2, "x", 3) for r in rows], "doc_id long, text string, part int, part_start long, ids string, __text int")
    token_files.write_token_files(wide, path, tokenizer_path())
    assert read(spark, path) == expected(rows)


def test_repeated_rows_and_ids(spark):
    rows = [(1, "same")] * 30 + [(1, f"other {i}") for i in range(30)] + [(2, "end")] * 2
    path = scratch_dir(spark, "test-tokens")
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), path, tokenizer_path())
    got = read(spark, path)
    assert sorted((r[0], r[2], r[3]) for r in got) == sorted((r[0], r[2], r[3]) for r in expected(rows))
    assert [r[1] for r in got] == [sum(r[2] for r in got[:i]) for i in range(len(got))] and [r[0] for r in got] == sorted(r[0] for r in got)
