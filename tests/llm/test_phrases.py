"""Phrase collocations against counts by brute force."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from skyledger.llm import kernels, phrases

SCHEMA = "text string, lang string"


def expected(rows, support=30, top=2000, covered=80, scale=2_000_000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in (1, 2, 3, 4):
                for i in range(len(words) - k + 1):
                    f[lang or "und"][tuple(words[i:i + k])] += 1
    out = []
    for lang, count in f.items():
        candidates = {p: a for p, a in count.items() if len(p) > 1 and a >= support}
        longest = Counter()
        for p, a in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longest[p[i:i + k]] = max(longest[p[i:i + k]], a)
        found = []
        for p, a in candidates.items():
            if 100 * longest[p] >= covered * a:
                continue
            score, k = min((scale * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            found.append((lang, " ".join(p), a, count[p[:k]], count[p[k:]], n[lang], score))
        found.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i, *r[1:]) for i, r in enumerate(found[:top], 1)]
    return sorted(out)


def result(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in phrases.collocations(df, **options).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed=5, n=160):
    rng = random.Random(seed)
    words = [a + b for a in ("al", "bé", "Co", "ß") for b in ("ra", "ti", "lu")]
    stock = [" ".join(rng.choice(words) for _ in range(k)) for k in (2, 3, 4, 6, 30)]
    rows = []
    for i in range(n):
        parts = [rng.choice(stock) if rng.random() < 0.4 else " ".join(rng.choices(words, weights=range(12, 0, -1), k=rng.randint(1, 7))) for _ in range(9)]
        text = "".join(p + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "!? ", ":"]) for p in parts)
        rows.append((text, rng.choice(["en", "en", "de", None])))
    return rows + [(None, "en"), ("", "fr"), ("  \t", "fr"), ("...", None), ("x " * 400, "und"), ("solo", None), ("a\x00b c\x00 a\x00b", "en")] + rows[:5]


@pytest.mark.parametrize("support", [2, 6, 30])
def test_as_counted_directly(spark, support):
    rows = texts()
    got = result(spark, rows, support=support)
    assert got and got == expected(rows, support)


def test_first_of_each_language_and_ties(spark):
    rows = texts(9)
    assert result(spark, rows, support=3, top=7) == expected(rows, 3, 7)


def test_clashing_hashes_are_drawn_anew(spark):
    rows = texts(11, 60)
    words = phrases.word_counts(spark.createDataFrame([(lang, text) for text, lang in rows], "lang string, text string").fillna("und"), 0, 9).collect()
    assert len({w.id for w in words}) < len(words)                       # nine bits: words of one id, told apart
    assert result(spark, rows, support=4, id_bits=9) == expected(rows, 4)


def test_long_passages_are_one_path(spark, monkeypatch):
    line = " ".join(f"w{i}" for i in range(90))
    rows = [(line, "en")] * 4 + [("w3 w4 w5", "en")] * 3
    monkeypatch.setattr(phrases, "PATH_EDGES", 16)
    assert result(spark, rows, support=4) == expected(rows, 4)
    df = spark.createDataFrame([(x[1], x[0]) for x in rows], "lang string, text string")
    frequent = phrases.word_counts(df).filter("f >= 4")
    edges = phrases.phrase_edges(df, frequent, 4).cache()
    nodes = edges.groupBy("w1", "w2", "w3").agg(*[phrases.F.expr(x) for x in ("sum(f) as f", "count(1) as ways", "sum(int(w4 = 0)) as ends")]).filter("w3 <> 0")
    paths = phrases.compact_paths(edges.filter("w4 <> 0"), phrases.unary_nodes(edges, nodes)).collect()
    assert sorted(len(p.words) - 3 for p in paths) == [3, 4, 16, 16, 16, 16, 16]     # the node w3 w4 w5 ends the first path
    assert {p.weight for p in paths} == {4}


def test_empty_and_clashing_columns(spark):
    assert result(spark, []) == [] and result(spark, [(None, None), (" ", "en")]) == []
    rows = texts(13, 40)
    wide = spark.createDataFrame([(t, x, 1, 2, 3, 4, None) for t, x in rows], SCHEMA + ", id int, f int, w1 int, n int, phrase string")
    got = sorted(tuple(r) for r in phrases.collocations(wide, support=5).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == expected(rows, 5)


def test_words_of_a_large_batch_take_bounded_memory():
    text = " ".join(f"word{i % 977} of,sentence{i % 31}" for i in range(4000))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 120), pa.array([text] * 120)], ["lang", "text"])
    tracemalloc.start()
    counted = sum(len(words.marks()) for words in phrases._sliced([batch], 0, 64))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counted == 120 * 12000 and peak < 64 << 20


def test_workers_give_memory_back_when_a_task_ends(spark, monkeypatch):
    given = []
    monkeypatch.setattr(kernels, "_give_back", lambda: given.append(True))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array(["a b a"])], ["lang", "text"])

    class Docs:
        def mapInArrow(self, run, schema):
            assert list(run([batch]))
            return spark.createDataFrame([], schema)

    phrases.word_counts(Docs())
    phrases._grams(Docs(), lambda words: [words.ids], ["w1"], 0, 64)
    assert len(given) == 2
