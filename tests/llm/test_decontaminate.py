"""Operator 9 against a direct search."""

import hashlib
import random
import re

from skyledger.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def expected(docs, items, window=13):
    out = []
    for d, text in docs:
        w = words(text)
        hit, found = [False] * len(w), set()
        for i, t in items:
            v = words(t)
            for k in range(max(1, len(v) - window + 1)) if v else ():
                part = v[k:k + window]
                for s in range(len(w) - len(part) + 1):
                    if w[s:s + len(part)] == part:
                        hit[s:s + len(part)] = [True] * len(part)
                        if i is not None:
                            found.add(str(i))
        n = sum(hit)
        out.append((d, len(w), n, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), n > 0 and 20 * n >= len(w)))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(8)
    vocabulary = ["Ab", "cd", "é", "Él", "x9", "fo", "ga", "hu"]
    some = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    items = [(i, rng.choice([" ", ", ", "-"]).join(some(rng.randint(14, 40)))) for i in range(12)]
    items += [(20, "cd ga"), (21, "hu"), (22, "zz zz zz"), (23, None), (24, ""), (25, "..."), (3, items[3][1]), (None, "fo fo fo fo"), (26, items[2][1])]
    docs = []
    for i in range(60):
        body = [f"n{rng.randrange(99)}" for _ in range(rng.randint(0, 300))]
        if i % 3 == 0:
            source = words(items[rng.randrange(12)][1])
            s = rng.randrange(len(source) - 12)
            at = rng.randint(0, len(body))
            body[at:at] = source[s:s + rng.randint(11, 30)]
        if i % 5 == 0:
            body[len(body) // 2:] += ["hu", "cd", "GA"]
        docs.append((i, rng.choice([" ", "\n", ". "]).join(body)))
    docs += [(100, None), (101, ""), (102, "cd"), (103, items[0][1]), (103, items[1][1]), (None, items[4][1]), (104, "hu " * 5000)]
    return docs, items


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_as_searched_directly(spark, monkeypatch):
    docs, items = corpus()
    monkeypatch.setattr(decontaminate, "LANE", 7)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    want = expected(docs, items)
    assert sum(w[5] for w in want) > 10 and sum(w[2] > 0 and not w[5] for w in want) > 3
    assert found(decontaminate.judged(d, b, ["doc_id"])) == want
    # the benchmark in many blocks gives the same
    assert found(decontaminate.judged(d, b, ["doc_id"], block_words=40)) == want


def test_clean_rows_stay_as_they_are(spark):
    docs, items = corpus()
    d = spark.createDataFrame([(i, t, 1, "k") for i, t in docs], "doc_id long, text string, n_words int, contaminated string")
    b = spark.createDataFrame(items, "item_id long, text string")
    dirty = [w[0] for w in expected(docs, items) if w[5]]
    got = found(decontaminate.without_contaminated(d, b))
    assert sorted((r[0] for r in got), key=str) == sorted((i for i, t in docs if i not in dirty), key=str)
    assert {r[2:] for r in got} == {(1, "k")}


def test_empty_tables(spark):
    docs, items = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    none_d, none_b = d.limit(0), spark.createDataFrame([], "item_id long, text string")
    assert found(decontaminate.judged(d, none_b, ["doc_id"])) == expected(docs, [])
    assert found(decontaminate.judged(none_d, spark.createDataFrame(items, "item_id long, text string"), ["doc_id"])) == []


def test_columns_called_as_the_operators_own(spark):
    items = spark.createDataFrame([("i", " ".join(f"w{k}" for k in range(13)))], "item_id string, text string")
    rows = [(1, " ".join(f"w{k}" for k in range(13)), "x", 1), (2, "clean text", "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __contamination string, __contamination_ int")
    assert [tuple(r) for r in decontaminate.without_contaminated(docs, items).collect()] == [rows[1]]
