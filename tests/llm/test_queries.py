"""The registered queries over the smallest driver tables, against direct versions."""

import os
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from skyledger.llm import licenses
from test_decontaminate import expected as contaminated
from test_licenses import expected as scanned
from test_near_dedup import expected as components
from test_neighbours import exact
from test_packing_sharding import check_layout, direct_pieces, fewest, least_capacity
from test_repeats import expected_bytes, expected_words
from test_token_files import expected as token_files
from test_warc import expected as archived

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def run(spark, prefix, *columns):
    name, = [k for k in entry.queries() if k.startswith(prefix)]
    df = entry.queries()[name](spark, SF)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str) if columns else df.collect()


def test_op2(spark, texts):
    assert run(spark, "op2_", "doc_id", "n_words", "n_removed", "kept_sha256") == expected_words(texts)


def test_op8(spark, texts):
    assert run(spark, "op8_", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected_bytes(texts)


def test_op7(spark, texts):
    assert run(spark, "op7_", "doc_id", "n_shingles", "component_id", "kept") == components(texts)


def test_op9(spark, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = run(spark, "op9_", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == contaminated(texts, items) and any(r[5] for r in got)


def test_op3(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert run(spark, "op3_", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == archived(pages)


def test_op4(spark, texts):
    rows = run(spark, "op4_")
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == direct_pieces(texts)
    assert len(check_layout(rows)) <= 1.01 * fewest([r.length for r in rows]) + 1


def test_op5(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], np.float32)
    want, got = exact(ids, x), {}
    for q, _, v, score in run(spark, "op5_", "query_id", "rank", "vec_id", "score"):
        got.setdefault(q, {})[v] = score
    assert got.keys() == want.keys() and all(len(g) == 20 for g in got.values())
    assert sum(len(got[q].keys() & dict(want[q]).keys()) for q in want) >= 0.95 * 20 * len(want)
    assert all(abs(got[q][v] - s) < 1e-12 for q in want for v, s in want[q] if v in got[q])


def test_op6(spark, texts):
    got = run(spark, "op6_", "doc_id", "license_id", "shingles", "found")
    assert got == scanned(texts, licenses.TEMPLATES) and got


def test_op1(spark):
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = run(spark, "op1_", "doc_id", "language", "accepted")
    assert len(got) == len(labels) and sum(labels[d] == x for d, x, _ in got) >= 0.97 * len(got)
    pages = run(spark, "language_id_pages", "page_id", "language", "confidence")
    assert len(pages) == spark.read.parquet(f"{SF}/pages.parquet").count()


def test_op10(spark, texts):
    import hashlib
    rows = run(spark, "op10_")
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in texts)
    groups, loads = {}, {}
    for _, t in texts:
        key = hashlib.md5((t or "").encode()).hexdigest()
        groups[key] = groups.get(key, 0) + len((t or "").encode()) + 1
    for r in rows:
        loads[r.shard] = loads.get(r.shard, 0) + r.size
        assert r.law == "bytes" and r.grown_shard is None
    assert max(loads.values()) == least_capacity([groups[k] for k in sorted(groups)], 8)
    for s in loads:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_op13(spark, texts):
    assert run(spark, "op13_", "doc_id", "start", "n_tokens", "ids_crc32") == sorted(token_files(texts), key=str)


@pytest.mark.parametrize("name", ["op11_phrase_collocations", "op12_conversation_trie"])
def test_queries_with_sql(spark, name):
    from oracle_check import compare
    assert compare(spark, SF, [name], verbose=False)[name].startswith("ok")
