"""Operators 4 and 10: rules of their results, and direct versions."""

import random
import zlib
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import packing, sharding


# -- packing ------------------------------------------------------------------------

def check_layout(rows, size=1024):
    """Each sequence is filled gapless from 0 and holds `size` tokens at most."""
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return by_sequence


def fewest(lengths, size=1024):
    """A lower bound on the number of sequences: pieces that cannot share one, and what no room is left for."""
    best = 0
    for a in range(size // 2 + 1):
        alone = [x for x in lengths if x > size - a]
        large = [x for x in lengths if size // 2 < x <= size - a]
        small = sum(x for x in lengths if a <= x <= size // 2)
        best = max(best, len(alone) + len(large) + max(0, -(-(small - (len(large) * size - sum(large))) // size)))
    return best


def direct_pieces(rows, size=1024):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    out = []
    for d, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        for k, (s, n) in enumerate(packing.cut(len(ids), size)):
            out.append((d, k, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())))
    return sorted(out, key=str)


def test_pieces_are_the_tokenizers_own(spark, docs, rows):
    long = " ".join(f"word{i}, it's {i}" for i in range(3000))
    odd = ["a\n\nb", "  two  spaces  ", "don't we'll I'M", "x y z　w", "\tTab\r\n\r\nend ", "<|endoftext|> no", "中文 字", "1a2 b3", "é !?...", "🙂 🙂", "_a_ __b", "\x1c\x1f a", "ё слово, 'тест'", "end\n"]
    more = [*rows, (500, long), (500, long), *[(600 + i, t) for i, t in enumerate(odd)]]
    df = docs.select("doc_id", "text").union(spark.createDataFrame([m[:2] for m in more[len(rows):]], "doc_id long, text string"))
    got = packing.pack_documents(df, packing.tokenizer_path()).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == direct_pieces(more)
    used = check_layout(got)
    assert len(used) <= 1.01 * fewest([r.length for r in got]) + 1


def test_pieces_of_random_texts_are_the_tokenizers_own():
    rng = random.Random(3)
    alphabet = ["a", "B", "é", "ß", " ", " ", "  ", "\n", "\t", "'", "'s", "'ll", "1", "_", ".", ",", "-", " ", "　", "\x1d", "中", "̈", "🙂", "\x85", "ÿ", "÷", "ſ", "²"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(packing.tokenizer_path()).encode_batch(texts, add_special_tokens=False)
    for text, got, want in zip(texts, split_ids(texts), plain):
        assert got == want.ids, repr(text)


def split_ids(texts):
    parts = [t.encode() for t in texts]
    ids, begins = packing.encoder(packing.tokenizer_path()).encode(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]))
    return [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])]


def test_strings_of_added_tokens_as_in_a_plain_call(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    mark = "<|endoftext|>"
    texts = [mark, f"a {mark} b", f"{mark}{mark}", f"one\n{mark}\n two{mark}", f"x<{mark}>'s", f"<|endof{mark}text|>", "<|endoftext |>", f"  {mark}  é{mark}9 ", "no mark"]
    plain = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert sum(ids.count(50256) for ids in plain) == 10
    assert split_ids(texts) == plain
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.token_pieces(df, packing.tokenizer_path()).collect()}
    assert got == {i: (len(x) + 1, zlib.crc32(np.array([*x, packing.END_ID], "<u4").tobytes())) for i, x in enumerate(plain)}


def test_cut():
    assert packing.cut(1024, 1024) == [(0, 1024)]
    assert packing.cut(1025, 1024) == [(0, 1), (1, 1024)]
    assert packing.cut(2048, 1024) == [(0, 1024), (1024, 1024)]


def test_fullest_combination_as_by_trying_all():
    rng = random.Random(4)
    for _ in range(60):
        counts = {rng.randint(1, 12): rng.randint(1, 3) for _ in range(4)}
        room = rng.randint(1, 30)
        best = max(sum(c) for k in range(13) for c in combinations_with_replacement(sorted(counts), k)
                   if sum(c) <= room and all(c.count(x) <= counts[x] for x in set(c)))
        chosen = packing.fullest(counts, room)
        assert sum(x * k for x, k in chosen) == best and all(k <= counts[x] for x, k in chosen)


def test_plan_uses_every_piece_once():
    rng = random.Random(5)
    counts = {rng.randint(1, 100): rng.randint(1, 400) for _ in range(50)}
    plan = packing.slack_plan(counts, 100)
    used = defaultdict(int)
    for copies, chosen in plan:
        assert sum(x * k for x, k in chosen) <= 100
        for x, k in chosen:
            used[x] += copies * k
    assert dict(used) == counts and len(plan) <= 4 * len(counts)


def test_packing_many_equal_lengths_and_none(spark, empty):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(1).alias("sequence_id"))
    got = packing.pack_documents(df, packing.tokenizer_path()).collect()
    assert len(check_layout(got)) == 5 and len(got) == 5000
    assert packing.pack_documents(empty, packing.tokenizer_path()).collect() == []


# -- sharding -----------------------------------------------------------------------

def least_capacity(sizes, shards):
    """The smallest largest part over all contiguous partitions, by dynamic programming."""
    sums = np.r_[0, np.cumsum(sizes)]
    best = sums[1:].copy()
    for _ in range(shards - 1):
        best = np.array([min(max(best[j - 1] if j else 0, sums[i + 1] - sums[j]) for j in range(i + 1)) for i in range(len(sizes))])
    return int(best[-1])


@pytest.mark.parametrize("seed", range(3))
def test_capacity_is_the_least_one(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 50) for _ in range(40)]
    for shards in (1, 3, 8, 50):
        assert sharding.smallest_capacity(sizes, shards) == least_capacity(sizes, shards)


def shard_rows(df, shards=8):
    got = sharding.sharded(df, shards).collect()
    by_shard, by_text = defaultdict(list), defaultdict(set)
    for r in got:
        by_shard[r.shard].append(r)
        by_text[(r.text_crc32, r.size)].add(r.shard)
    for part in by_shard.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    assert all(len(s) == 1 for s in by_text.values())
    assert set(by_shard) <= set(range(shards)) and {(r.law, r.grown_shard) for r in got} <= {("bytes", None)}
    return got, {s: sum(r.size for r in part) for s, part in by_shard.items()}


@pytest.mark.parametrize("hot", [0, 400])
def test_shards_reach_the_least_capacity(spark, docs, rows, monkeypatch, hot):
    """Two digest bits a level make every cut need refinement."""
    import hashlib
    monkeypatch.setattr(sharding, "BITS", 4)
    monkeypatch.setattr(sharding, "_LEVELS", 9)
    more = [(10_000 + i, "hot text") for i in range(hot)]
    df = docs.select("doc_id", "text", F.lit(1).alias("shard"), F.lit(2).alias("digest"))
    if more:
        df = df.unionByName(spark.createDataFrame([(*m, 1, 2) for m in more], "doc_id long, text string, shard int, digest int"))
    got, loads = shard_rows(df)
    texts = [r[1] for r in rows] + [m[1] for m in more]
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in texts)
    groups = defaultdict(int)
    for t in texts:
        groups[hashlib.md5((t or "").encode()).hexdigest()] += len((t or "").encode()) + 1
    assert max(loads.values()) == least_capacity([groups[k] for k in sorted(groups)], 8)


def test_few_groups_and_none(spark, empty):
    got, loads = shard_rows(spark.createDataFrame([(1, "a"), (2, "a"), (None, "b"), (2, "a")], "doc_id long, text string"))
    assert len(got) == 4 and len(loads) == 2
    assert sharding.sharded(empty).collect() == []


def test_sharding_runs_no_python(docs):
    from skyledger.llm import common
    plan = sharding.sharded(common.staged(docs, "t"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
