import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed: int = 3, n: int = 60):
    """Small documents with shared passages, exact and near copies, nulls, blanks, odd white space and non-ASCII text."""
    rng = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ("al", "be", "çe", "do", "ê", "fo") for b in ("ra", "ti", "ßo", "lu", "9")]
    words = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage, other = words(70), words(55)
    texts = []
    for i in range(n):
        kind = i % 10
        body = words(rng.randint(20, 160))
        if kind == 1 and texts:
            texts.append(texts[rng.randrange(len(texts))])                    # exact copy
            continue
        if kind in (2, 3):
            at = rng.randint(0, len(body))
            body[at:at] = passage
        if kind == 4:
            body = other[:rng.randint(48, 55)] + body + passage[5:60]
        if kind == 5 and texts:
            body = (texts[rng.randrange(len(texts))] or "").split()           # near copy
            for _ in range(2):
                if body:
                    body[rng.randrange(len(body))] = rng.choice(vocabulary)
        if kind == 6:
            body = body[:rng.randint(1, 6)]
        if kind == 7:
            body = ["ab"] * rng.randint(40, 120)                              # periodic
        texts.append(rng.choice([" ", "  ", "\n", "\t "]).join(body).replace("doti", "DoTi"))
    texts += [None, "", "   ", "\n", None, " ", "x", "a" * 3000, " ".join(["w"] * 49), " ".join(["w"] * 51)]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return [(i, t, "en", "s0" if i % 3 else None, None if t is None else len(t)) for i, t in zip(ids, texts)]


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
