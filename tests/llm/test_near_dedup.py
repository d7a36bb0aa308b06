"""Operator 7 against all pairs."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from skyledger.llm import near_dedup
from skyledger.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def expected(rows, percent=85):
    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return sorted(((d, len(s), None if d is None else root(d), d is None or root(d) == d) for d, s in sets), key=str)


def found(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()), key=str)


def test_components_as_over_all_pairs(docs, rows):
    want = expected(rows)
    assert sum(not w[3] for w in want) > 8
    assert found(docs) == want


def chains(seed=2):
    """Texts that drift apart step by step, so that few members resemble the smallest one; ids in random order."""
    rng = random.Random(seed)
    texts = []
    for _ in range(4):
        words = [f"t{rng.randrange(10**6)}" for _ in range(90)]
        for _ in range(14):
            texts.append(" ".join(words))
            at = rng.randrange(90)
            words[at] = f"t{rng.randrange(10**6)}"
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts))


def test_links_that_miss_the_first_centre(spark):
    rows = chains()
    want = expected(rows)
    assert len({w[2] for w in want}) < 12
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_repeated_and_null_ids(spark, rows):
    more = rows + [rows[3], (rows[2][0], rows[13][1], "en", "s", 1), (None, rows[2][1], "en", "s", 1), (None, None, "en", "s", 1)]
    df = spark.createDataFrame([(*r[:2], 1, 2) for r in more], "doc_id long, text string, node long, component long")
    got = found(df)
    want = expected(more)
    # rows that share an id are one document: the smallest component of its texts
    assert [(g[0], g[1]) for g in got] == [(w[0], w[1]) for w in want]
    assert all(g[2] is None and g[3] for g in got if g[0] is None)
    assert len({g[2] for g in got if g[0] == rows[2][0]}) == 1


def test_empty_table(empty):
    assert found(empty) == []


def test_components_of_long_paths(spark):
    rng = random.Random(4)
    ids = list(range(300))
    rng.shuffle(ids)
    path = [(ids[i], ids[i + 1]) for i in range(298) if i != 150]
    got = {r.node: r.component for r in components(spark.createDataFrame([*path, (7, 7)], "a long, b long")).collect()}
    for part in (ids[:151], ids[151:299]):
        assert {got[i] for i in part} == {min(part)}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for same in (30, 300):
        x = rng.integers(0, 2**64, same * 10 // 9, dtype=np.uint64)
        y = np.r_[x[:same], rng.integers(0, 2**64, same // 9, dtype=np.uint64)]
        x, y = np.sort(x), np.sort(y)
        signs = near_dedup.signatures(np.r_[x, y], np.array([0, len(x), len(x) + len(y)]))
        assert abs((signs[0] == signs[1]).mean() - same / (len(x) + len(y) - same)) < 0.2


def test_sketches_cover_whole_texts(spark):
    text = " ".join(f"w{i}" for i in range(40000))
    df = spark.createDataFrame([(1, text), (2, text + " tail")], "doc_id long, text string")
    assert {(r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()} == {(39996, 1), (39997, 1)}
    assert near_dedup.sketches(df).select(F.size("bands")).distinct().first()[0] == near_dedup.BANDS
