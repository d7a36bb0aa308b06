"""The trie against one built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from skyledger.llm import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def expected(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c - 5 * int(c / 5))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    out, below = [], {}
    for path in sorted(members, key=len, reverse=True):
        kids, who = children[path], members[path]
        leaves = sum(below[k][0] for k in kids) or 1
        saved = sum(below[k][1] for k in kids) + ((len(who) - 1) * len(path[-1][1].encode()) if path else 0)
        below[path] = leaves, saved
        stop = ",".join(str(c) for c in who if len(built[c]) == len(path))
        out.append((min(who), len(path), min(members[path[:-1]]) if path else None, len(who), len(kids), leaves, saved, hashlib.sha256(stop.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in conversation_trie.trie(df).select(*columns).collect()), key=str)


def conversations(seed, n, longest, words=("a", "béta", "", "gamma ray", None)):
    rng = random.Random(seed)
    shared = [(rng.choice(["user", "assistant", None]), rng.choice(words)) for _ in range(longest)]
    rows = []
    for c in rng.sample(range(-n, 3 * n), n):
        k = rng.choice([1, 2, 3, 8, min(9, longest), longest])
        turns = [shared[i] if rng.random() < 0.97 else ("user", rng.choice(words)) for i in range(k)]
        rows += [(c, i if i else rng.choice([None, 0]), *t) for i, t in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,n,longest", [(1, 40, 8), (2, 60, 17), (3, 25, 45)])
def test_as_built_directly(spark, seed, n, longest):
    rows = conversations(seed, n, longest)
    got = result(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert got == expected(rows) and max(r[1] for r in got) >= 8


def test_one_conversation_with_most_turns_and_many_equal_ones(spark):
    rows = [(7, i, "user", f"turn {i}") for i in range(300)] + [(c, i, "user", f"turn {i}") for c in range(100, 160) for i in range(3)] + [(5, 0, "user", "x"), (200, 0, "user", "x")]
    assert result(spark.createDataFrame(rows, SCHEMA).repartition(4)) == expected(rows)


def test_copies_of_a_long_conversation(spark):
    rows = [(c, i, "user", f"turn {i}" * (i % 3)) for c in (10, 20, 30, 40) for i in range(70 + c % 3)]
    rows += [(50, i, "user", f"turn {i}" * (i % 3)) for i in range(33)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_odd_rows(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == [] and result(spark.createDataFrame([(None, 1, "user", "x")], SCHEMA)) == []
    rows = [(0, None, None, None), (0, 1, "user", "z" * 200_000), (5, 1, "a", "b"), (5, 1, "a", "b"), (5, 1, "a", "a"), (5, None, "q", ""), (1, 3, "a:1", ""), (6, 3, "a", ":1")]
    wide = spark.createDataFrame([(*r, 1, "k", 2, 3, "p") for r in rows], SCHEMA + ", pos long, t string, n int, block long, prior string")
    assert result(wide) == expected(rows)
    rows = [(c, 0, "user", "") for c in (1, 2, 3, 4)]                  # shared conversation absent: some are without turns
    assert result(spark.createDataFrame(rows, SCHEMA)) == expected(rows)
