"""Operator 6 against a direct scan of all windows."""

import random
import re

from skyledger.llm import common, licenses


def words(text):
    return [w for w in re.split(r"[^\w]+|_", text.lower()) if w]


def shingles(w):
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def expected(docs, templates):
    """The same windows and the same exact test, without hashes or bands."""
    out = []
    for doc_id, text in docs:
        w, of_license = shingles(words(text or "")), {}
        for license_id, template in sorted(set(templates)):
            t = set(shingles(words(template or "")))
            n, size = len(words(template or "")), licenses.SMALLEST_WINDOW
            while size < n * 4 / 3:
                size *= 2
            best = 0
            for k in range(0, len(w) * 4 // size + 1):
                start = k * size // 4
                own = set(w[start:start + size - 4])
                begin = max(0, start - size // 2)
                if own & t:
                    best = max(best, len(t & set(w[begin:start + size * 3 // 2 - 4])))
            if t and best >= 0.8 * len(t):                         # of several texts the one found best, then the largest, then the first
                of_license.setdefault(license_id, []).append((best / len(t), len(t), best))
        for license_id, found_texts in of_license.items():
            _, n, best = max(found_texts, key=lambda x: x[:2])
            out.append((doc_id, license_id, n, best))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(6)
    vocabulary = ["software", "license", "the", "of", "and", "under", "is", "free", "copy", "é", "work", "to"]
    some = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    docs = []
    for i in range(60):
        body = some(rng.randint(0, 120))
        if i % 2 == 0:
            statement = licenses.TEMPLATES[rng.randrange(len(licenses.TEMPLATES))][1].split()
            if i % 4 == 0 and len(statement) > 20:
                statement[len(statement) // 2] = "changed"
            if i % 10 == 0:
                statement = statement[:max(3, len(statement) * 3 // 4)]
            at = rng.randint(0, len(body))
            body[at:at] = statement
        docs.append((i, " ".join(body).upper() if i % 7 == 0 else " ".join(body)))
    docs += [(100, None), (101, ""), (102, "MIT"), (103, docs[0][1]), (None, licenses.TEMPLATES[3][1]), (0, licenses.TEMPLATES[8][1]),
             (104, " ".join(some(9000) + licenses.TEMPLATES[5][1].split() + some(9000)))]
    return docs


def found(df):
    return sorted(((r.doc_id, r.license_id, r.shingles, r.found) for r in df.collect()), key=str)


def test_as_scanned_directly(spark):
    docs = corpus()
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, size int, shingles string").repartition(3)
    want = expected(docs, licenses.TEMPLATES)
    assert len(want) > 20 and any(w[3] < w[2] for w in want)
    assert found(licenses.scan(df, licenses.templates(spark))) == want


def test_texts_of_one_license(spark):
    """Two texts under one id: a document with either is found, one with both once, with the text that it has whole."""
    first, second = "alpha beta gamma delta epsilon zeta eta", "one two three four five six seven eight nine ten"
    given = [("L", second), ("L", first), ("L", first), ("M", "one two three four five"), ("M", None)]
    docs = [(1, f"x {first} y"), (2, f"{second}"), (3, f"{first} . {second[:-9]} changed word"), (4, "beta gamma")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = found(licenses.scan(df, spark.createDataFrame(given, "license_id string, text string")))
    assert got == expected(docs, [g for g in given if g[1]]) and [g[:2] for g in got] == [(1, "L"), (2, "L"), (2, "M"), (3, "L"), (3, "M")]


def test_body_without_its_opening(spark):
    mit = [t for i, t in licenses.TEMPLATES if i == "MIT-notice"]
    assert len(mit) == 3
    df = spark.createDataFrame([(1, "code code code\n\n" + "\n".join(mit[1:]) + "\nint main"), (2, "int main")], "doc_id long, text string")
    assert [(r.doc_id, r.license_id, r.containment) for r in licenses.scan(df, licenses.templates(spark)).collect()] == [(1, "MIT-notice", 1.0)]


def test_place_and_containment(spark):
    df = spark.createDataFrame([(1, "a b c. Released under the MIT License, d e")], "doc_id long, text string")
    row = licenses.scan(df, licenses.templates(spark)).first()
    assert (row.license_id, row.containment, row.first_word) == ("MIT", 1.0, 3)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    assert licenses.scan(none, licenses.templates(spark)).collect() == []
    assert licenses.scan(docs, spark.createDataFrame([], "license_id string, text string")).collect() == []
    short = spark.createDataFrame([("s", "too short to tell"), ("n", None)], "license_id string, text string")
    assert licenses.scan(docs, short).collect() == []


def test_no_python_in_the_plan(spark):
    docs = common.staged(spark.createDataFrame(corpus(), "doc_id long, text string"), "t")
    plan = licenses.scan(docs, licenses.templates(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)
