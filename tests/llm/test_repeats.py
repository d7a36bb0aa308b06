"""Operators 2 and 8 against direct searches, and the suffix array against sorting."""

import hashlib
import random
import re

import numpy as np
import pytest

from skyledger.llm import repeats, substring_dedup, suffix_dedup
from skyledger.llm.suffix_array import common_prefixes, suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def covered(sequences, length):
    """For each (doc_id, symbols): which symbols a string covers that also starts in a smaller document."""
    first = {}
    for d, s in sequences:
        if d is not None:
            for i in range(len(s) - length + 1):
                key = tuple(s[i:i + length]) if isinstance(s, list) else s[i:i + length]
                first[key] = min(first.get(key, d), d)
    out = []
    for d, s in sequences:
        gone = [False] * len(s)
        if d is not None:
            for i in range(len(s) - length + 1):
                key = tuple(s[i:i + length]) if isinstance(s, list) else s[i:i + length]
                if first[key] < d:
                    gone[i:i + length] = [True] * length
        out.append(gone)
    return out


def expected_words(rows, length=50):
    texts = [(r[0], WORD.findall(r[1] or "")) for r in rows]
    out = []
    for (d, w), gone in zip(texts, covered(texts, length)):
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def expected_bytes(rows, length=50):
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    out = []
    for (d, b), gone in zip(texts, covered(texts, length)):
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and not p for g, p in zip(gone, [False, *gone]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def words_found(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.removal_report(df).collect()), key=str)


def bytes_found(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_report(df).collect()), key=str)


def test_words_as_searched_directly(docs, rows):
    want = expected_words(rows)
    assert sum(w[2] for w in want) > 1000
    assert words_found(docs) == want


def test_bytes_as_searched_directly(docs, rows):
    want = expected_bytes(rows)
    assert sum(w[2] for w in want) > 5000
    assert bytes_found(docs) == want


@pytest.mark.parametrize("found, expected", [(words_found, expected_words), (bytes_found, expected_bytes)])
def test_small_blocks_repeated_ids_and_null_ids(spark, rows, monkeypatch, found, expected):
    """Many blocks; rows that share an id, with one text and with two; rows without an id; clashing column names."""
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 2000)
    more = rows + [rows[12], (rows[2][0], rows[13][1], "en", "s", 1), (None, rows[2][1], "en", "s", 1)]
    df = spark.createDataFrame([(r[0], r[1], 5, "x") for r in more], "doc_id long, text string, block long, runs string")
    assert found(df.repartition(3)) == expected(more)


def test_empty_tables(empty):
    assert words_found(empty) == [] and bytes_found(empty) == []


def test_parts_of_a_shard(docs, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 300)
    assert bytes_found(docs) == expected_bytes(rows)


def hot_line(seed=8, n=90):
    """A line that a third of all documents hold between texts of their own; some of these begin or end alike."""
    rng = random.Random(seed)
    own = lambda k: " ".join(f"{rng.randrange(10**5)}" for _ in range(k))
    line = " ".join(f"l{i}" for i in range(60))
    tails = [own(70) for _ in range(4)]
    rows = []
    for i in range(n):
        text = f"{own(60)} {line} {own(60)}" if i % 3 == 0 else own(80)
        rows.append((i, text if i % 9 else f"{own(60)} {line} {tails[i % 4][:rng.randint(60, 300)]} {own(30)}"))
    return rows


@pytest.mark.parametrize("module, found, expected", [(substring_dedup, words_found, expected_words), (suffix_dedup, bytes_found, expected_bytes)])
def test_hot_anchors_are_split(spark, docs, rows, monkeypatch, module, found, expected):
    """No more slices of an anchor than MOST_SLICES are settled together, and the results stay."""
    monkeypatch.setattr(repeats, "MOST_SLICES", 4, raising=False)
    settle = module.settle

    def bounded(unit, group, contents, least):
        largest = int(np.unique(group, return_counts=True)[1].max()) if len(group) else 0
        if largest > 4:
            raise ValueError(f"{largest} slices of an anchor")
        return settle(unit, group, contents, least)

    monkeypatch.setattr(module, "settle", bounded)
    lines = hot_line()
    want = expected(lines)
    assert sum(w[2] for w in want) > 1000
    assert found(spark.createDataFrame(lines, "doc_id long, text string").repartition(3)) == want
    assert found(docs) == expected(rows)


def test_slices_of_anchors_are_counted(spark):
    """A block tells how many distinct slices an anchor has."""
    n = np.array([0, 1, 2, 3, 4, 5])
    u = lambda *x: np.array(x, np.uint64)
    slices = repeats.Slices(n, n, n + 1, u(7, 7, 7, 7, 9, 9), u(5, 6, 5, 8, 3, 3), n)
    key, many, several, told = repeats._told(slices, 4)
    assert many.tolist() == [True, True] and several.tolist() == [True, False] and told.tolist() == [3, 3]


def test_texts_without_repeats_keep_their_columns(docs, rows):
    got = {r.doc_id: r for r in suffix_dedup.without_repeated_bytes(docs).collect()}
    assert len(got) == len(rows)
    texts = [(r[0], (r[1] or "").encode()) for r in rows]
    for (d, b), gone, row in zip(texts, covered(texts, 50), rows):
        kept = bytes(x for x, g in zip(b, gone) if not g)
        assert (got[d].text or "") == kept.decode("utf-8", "ignore")
        assert got[d].lang == row[2] and got[d].source == row[3]
        assert row[1] is None or got[d].n_chars == len(got[d].text)


def test_longest_repeats_double_until_none_survive(spark):
    rng = random.Random(5)
    long = [f"w{rng.randrange(9)}{rng.randrange(99)}" for _ in range(230)]
    texts = [" ".join(long), " ".join(["q", *long]), " ".join(long[:120]), " ".join(long[:60]), "one two"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.length for r in substring_dedup.longest_repeats(df).collect()} == {1: 200, 2: 100, 3: 50}
    assert substring_dedup.longest_repeats(df.limit(1)).collect() == []


def test_suffix_arrays_and_common_prefixes():
    rng = random.Random(1)
    for trial in range(250):
        n, k = rng.randint(1, 60), rng.choice([1, 2, 3, 5, 3000])
        text = [rng.randint(1, k) for _ in range(n)] * (1 + 2 * (trial % 3 == 0)) + [0]
        array = np.array(text, np.int64)
        order = suffix_array(array)
        want = sorted(range(len(text)), key=lambda i: text[i:])
        assert order.tolist() == want
        shared = common_prefixes(array, order)
        for a, b in zip(want[:-1], want[1:]):
            same = 0
            while same < min(len(text) - a, len(text) - b) and text[a + same] == text[b + same]:
                same += 1
            assert shared[b] == same
