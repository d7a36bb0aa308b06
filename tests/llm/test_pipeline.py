"""Every stage of the pipeline against a direct version on its own input, and the whole run."""

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm.common import staged
from skyledger.llm.near_dedup import banding
from test_decontaminate import expected as contaminated
from test_near_dedup import expected as components
from test_packing_sharding import check_layout, direct_pieces
from test_repeats import covered

SF = "/root/testdata/sf0.001"


def column(df):
    return [(r.doc_id, r.text) for r in df.collect()]


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_each_stage_as_done_directly(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = (column(docs) if "text" in docs.columns else None)
        docs = staged(stage(spark, docs, SF), f"test-{name}")
        if name != "packing":
            assert docs.columns == documents.columns and docs.dtypes == documents.dtypes
    # language: what goes has no text to speak of
    kept = {d for d, _ in seen["near_dedup"]}
    gone = [t for d, t in seen["language_id"] if d not in kept]
    assert len(gone) <= 0.02 * len(seen["language_id"])
    # near duplicates
    assert {d for d, _ in seen["suffix_dedup"]} == {c[0] for c in components(seen["near_dedup"], 80) if c[3]}
    # repeated bytes
    texts = [(d, (t or "").encode()) for d, t in seen["suffix_dedup"]]
    left = {d: bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore") for (d, b), gone in zip(texts, covered(texts, 50))}
    assert {d: t or "" for d, t in seen["decontamination"]} == left
    # benchmark passages
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert {d for d, _ in seen["packing"]} == {c[0] for c in contaminated(seen["decontamination"], items) if not c[5]}
    # packing
    rows = docs.collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=str) == direct_pieces(seen["packing"])
    check_layout(rows)
    # the whole run is the stages one after another
    compare = ["doc_id", "piece", "start", "length", "ids_crc32"]
    whole = corpus_pipeline.run(spark, SF).select(*compare).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, docs.select(*compare).collect()))


def between(seed=6, n=40):
    """Pairs of texts with similarities around 0.82: a run of 10 replaced words in 140 makes 122 of 150 shingles common."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"b{rng.randrange(10**6)}" for _ in range(140)]
        other = list(words)
        at = rng.randrange(10, 120)
        other[at:at + 10] = [f"c{rng.randrange(10**6)}" for _ in range(10)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    return rows


def test_near_dedup_goes_by_four_fifths(spark):
    rows = between()
    want = {c[0] for c in components(rows, 80) if c[3]}
    assert len(want) == len(rows) / 2 and len([c for c in components(rows) if c[3]]) == len(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, df, "").collect()} == want


def test_bands_reach_the_threshold():
    assert banding(85) == (48, 8)
    for percent in (80, 85):
        bands, rows = banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands < 3e-7


def test_stages_take_odd_and_empty_tables(spark, docs, empty, tmp_path):
    spark.createDataFrame([(1, "al ra be ti"), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for start in (docs.withColumn("token", F.lit(1)), empty):
        table = start
        for name, stage in corpus_pipeline.STAGES:
            out = staged(stage(spark, table, str(tmp_path)), f"test-{name}")
            if name != "packing":
                assert out.columns == table.columns
            table = out
        assert (table.count() > 0) == (start is not empty)


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "suffix_dedup", "decontamination", "packing"]


def test_stages_leave_no_intermediate_tables(spark, tmp_path, monkeypatch):
    """What a stage staged on its way is gone when its rows are asked for; else it lies beside the tables of later stages."""
    from skyledger.llm import common
    from skyledger.llm.language import accepted_documents
    from skyledger.llm.near_dedup import one_of_each
    monkeypatch.setattr(common, "scratch_dir", lambda s, purpose: f"{tmp_path}/{purpose}-{uuid.uuid4().hex}")
    text = "the old man went to the river and sat there for the whole of the long day with his dog "
    docs = spark.createDataFrame([(1, text * 2, "en", "a"), (2, text * 2, "en", "a"), (3, "it was not what they had thought of before " * 3, "en", None), (4, "", None, None)],
                                 "doc_id long, text string, lang string, source string")
    assert sorted(r.doc_id for r in one_of_each(docs).collect()) == [1, 3, 4]
    assert [d.rsplit("-", 1)[0] for d in os.listdir(tmp_path)] == ["near-copies"]
    accepted_documents(docs).collect()
    assert sorted(d.rsplit("-", 1)[0] for d in os.listdir(tmp_path)) == ["language-rejected", "near-copies"]


def test_tables_pass_also_when_a_stage_fails(spark, tmp_path, monkeypatch):
    from skyledger.llm import common
    monkeypatch.setattr(common, "scratch_dir", lambda s, purpose: f"{tmp_path}/{purpose}")
    with pytest.raises(ZeroDivisionError), common.passing(spark, "all"):
        assert common.staged(spark.range(3), "kept", lasting=True).count() == staged(spark.range(3), "gone").count() == 3
        1 / 0
    assert os.listdir(tmp_path) == ["kept"]
