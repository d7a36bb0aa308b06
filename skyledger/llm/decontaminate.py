"""Benchmark decontamination by Wu-Manber multi-pattern search (operator 9).

Texts and benchmark items are sequences of words. A pattern is `window` consecutive words of an
item, or a whole shorter item. For patterns of one length m, a table keyed by two-word blocks says
how far the search may move on: a block that no pattern holds lets it skip m - 1 words, one inside
a pattern less, and one that ends a pattern gives 0. At 0, the bucket of that block's hash selects
the patterns to try, and direct comparison of all words confirms an occurrence. Many search
positions advance together (one lane for each stretch of a slice of texts).

The benchmark is a stated query set. Its items are dealt to blocks of at most `block_words` words;
each block's tables go to the tasks as one bounded broadcast, and the documents pass through the
blocks one after another in the same stage, without a shuffle.

Defined results: null has no words and is never contaminated; rows with an equal doc_id are judged
each by its own text; repeated items count once by item_id; items with a null item_id count for hits
and contamination, not for n_items; an empty benchmark hits nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.llm.common import register, table
from skyledger.llm.kernels import ALNUM_WORDS, LOWER, released, spread, text_slices, word_hashes, word_spans

WINDOW = 13
BLOCK_WORDS = 200_000          # words of benchmark items in one broadcast
LANE = 512                     # words of text per search position
FOUND = "__contamination"
_BUCKETS = 1 << 16


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, number of the first word of each document)."""
    data = LOWER[data]
    starts, ends, firsts = word_spans(data, offsets, ALNUM_WORDS)
    return word_hashes(data, starts, ends), firsts


class ShiftSearch:
    """The shift and bucket tables for patterns of m words."""

    def __init__(self, patterns: np.ndarray, items: np.ndarray):
        """patterns: one row of m word hashes each; items: the number of the item each comes from."""
        self.m = patterns.shape[1]
        rows, group = np.unique(patterns, axis=0, return_inverse=True)
        self.patterns, group = rows, group.reshape(-1)
        order = np.argsort(group, kind="stable")
        self.items, self._item_at = items[order], np.searchsorted(group[order], np.arange(len(rows) + 1))
        self.block = min(2, self.m)
        self.skip = self.m - self.block + 1
        self.shift = np.full(_BUCKETS, self.skip, np.int64)
        for end in range(self.block - 1, self.m):
            np.minimum.at(self.shift, self._key(rows[:, end - self.block + 1], rows[:, end]), self.m - 1 - end)
        last = self._key(rows[:, self.m - self.block], rows[:, self.m - 1])
        self._by_bucket = np.argsort(last, kind="stable")
        self._bucket_at = np.searchsorted(last[self._by_bucket], np.arange(_BUCKETS + 1))

    @staticmethod
    def _key(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        return ((first * np.uint64(3) + last) >> np.uint64(48)).astype(np.int64)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, pattern) of all occurrences in one word sequence."""
        n = len(words)
        if n < self.m:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = self._key(words[:-1], words[1:]) if self.block == 2 else self._key(words, words)
        steps = self.shift[keys]                           # by the block's first word
        at = np.arange(self.m - 1, n, LANE)                # positions of a pattern's last word
        stop = np.minimum(at + LANE, n)
        zeros = []
        while len(at):
            move = steps[at - self.block + 1]
            zeros.append(at[move == 0])
            at = at + np.maximum(move, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        ends = np.concatenate(zeros) if zeros else np.zeros(0, np.int64)
        bucket = keys[ends - self.block + 1]
        counts = self._bucket_at[bucket + 1] - self._bucket_at[bucket]
        tried = self._by_bucket[np.repeat(self._bucket_at[bucket], counts) + spread(counts)]
        starts = np.repeat(ends, counts) - self.m + 1
        for j in range(self.m):                            # direct comparison, word by word
            same = words[starts + j] == self.patterns[tried, j]
            starts, tried = starts[same], tried[same]
        return starts, tried

    def items_of(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into `patterns`, item number) for all items of the given patterns."""
        counts = self._item_at[patterns + 1] - self._item_at[patterns]
        return np.repeat(np.arange(len(patterns)), counts), self.items[np.repeat(self._item_at[patterns], counts) + spread(counts)]


class ItemBlock:
    """Search tables for some benchmark items."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.ids = [i for i, _ in items]
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        for _, _, data, offsets, first_row in _slices([t for _, t in items]):
            words, firsts = words_of(data, offsets)
            for i in range(len(offsets) - 1):
                own = words[firsts[i]:firsts[i + 1]]
                if len(own):
                    m = min(window, len(own))
                    views = np.lib.stride_tricks.sliding_window_view(own, m)
                    by_length.setdefault(m, []).append((views, first_row + i))
        self.searches = [ShiftSearch(np.concatenate([v for v, _ in got]), np.concatenate([np.full(len(v), i) for v, i in got]))
                         for _, got in sorted(by_length.items())]


def _slices(texts: list[str | None]):
    for row, end, data, offsets in text_slices(pa.array(texts, pa.large_string())):
        yield row, end, data, offsets, row


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> list[list[tuple[object, str | None]]]:
    """The benchmark's items in blocks of bounded size (one item may be larger). The items are read
    through an iterator, one partition at a time."""
    blocks, size = [[]], 0
    for row in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        n = len(row["text"] or "") // 2 + 1                # no text has more words
        if blocks[-1] and size + n > block_words:
            blocks.append([])
            size = 0
        blocks[-1].append((row["item_id"], row["text"]))
        size += n
    return blocks


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS, then: Callable | None = None, schema: StructType | None = None) -> DataFrame:
    """All rows and columns of `docs`, and last a struct column FOUND with n_words, the hit word ranges
    (arrays of starts and ends) and the item ids found (array of strings, sorted). `then`: a function over
    these batches, with rows of `schema`, that runs in the worker of the last search (a step of its own would take a second worker a core)."""
    spark = docs.sparkSession
    out = docs.withColumn(FOUND, F.lit(None).cast(
        "struct<n_words:bigint,starts:array<bigint>,ends:array<bigint>,item_ids:array<string>>"))
    blocks = [b for b in item_blocks(benchmark, block_words) if b] or [[]]
    for i, block in enumerate(blocks):
        last = i == len(blocks) - 1
        out = _searched(out, spark.sparkContext.broadcast(block), text_col, window, then if last else None, schema if last else None)
    return out


def _searched(docs: DataFrame, block, text_col: str, window: int, then: Callable | None, schema: StructType | None) -> DataFrame:
    names = docs.columns
    text_at, found_at = names.index(text_col), names.index(FOUND)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None
        for batch in batches:
            tables = tables or ItemBlock(block.value, window)
            found = []
            for row, end, data, offsets in text_slices(batch.column(text_at)):
                found += _found(tables, data, offsets)
            before = batch.column(found_at).to_pylist()
            merged = [(n, [*(b["starts"] if b else []), *s], [*(b["ends"] if b else []), *e],
                       sorted({*(b["item_ids"] if b else []), *i})) for b, (n, s, e, i) in zip(before, found, strict=True)]
            kinds = (("n_words", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("item_ids", pa.list_(pa.string())))
            struct = pa.StructArray.from_arrays([pa.array([m[k] for m in merged], t) for k, (_, t) in enumerate(kinds)],
                                                fields=[pa.field(n, t) for n, t in kinds])
            yield pa.RecordBatch.from_arrays([struct if i == found_at else batch.column(i) for i in range(len(names))], names)

    if then is None:
        return docs.mapInArrow(released(run), docs.schema)
    return docs.mapInArrow(released(lambda batches: then(run(batches))), schema)


def _found(tables: ItemBlock, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, list[int], list[int], set[str]]]:
    words, firsts = words_of(data, offsets)
    n_docs = len(offsets) - 1
    spans: list[tuple[list[int], list[int]]] = [([], []) for _ in range(n_docs)]
    items: list[set[str]] = [set() for _ in range(n_docs)]
    for search in tables.searches:
        starts, patterns = search.find(words)
        doc = np.searchsorted(firsts, starts, "right") - 1
        inside = starts + search.m <= firsts[doc + 1] if len(starts) else np.zeros(0, bool)
        starts, patterns, doc = starts[inside], patterns[inside], doc[inside]
        which, item = search.items_of(patterns)
        for d, i in set(zip(doc[which].tolist(), item.tolist(), strict=True)):
            if tables.ids[i] is not None:
                items[d].add(str(tables.ids[i]))
        order = np.lexsort((starts, doc))
        starts, doc = starts[order], doc[order]
        if len(starts):
            new = np.r_[True, (doc[1:] != doc[:-1]) | (starts[1:] > starts[:-1] + search.m)]
            first, last = np.flatnonzero(new), np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]
            for d, s, e in zip(doc[first].tolist(), (starts[first] - firsts[doc[first]]).tolist(),
                               (starts[last] + search.m - firsts[doc[first]]).tolist(), strict=True):
                spans[d][0].append(s)
                spans[d][1].append(e)
    counts = np.diff(firsts).tolist()
    return [(counts[d], *spans[d], items[d]) for d in range(n_docs)]


def _union_length(starts: list[int], ends: list[int]) -> int:
    total, reach = 0, 0
    for s, e in sorted(zip(starts, ends, strict=True)):
        total += max(0, e - max(s, reach))
        reach = max(reach, e)
    return total


def _hits(rows: list[dict]) -> list[int]:
    return [_union_length(r["starts"], r["ends"]) for r in rows]


def _contaminated(n_hit: int, n_words: int) -> bool:
    return n_hit > 0 and 20 * n_hit >= n_words


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that are not contaminated, as they are, whatever their columns are called."""
    names, free = docs.columns, f"{FOUND}_"
    while free in names:
        free += "_"
    renamed = docs.toDF(*[free if c == FOUND else c for c in names])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(len(names)).to_pylist()
            clean = pa.array([not _contaminated(h, r["n_words"]) for h, r in zip(_hits(rows), rows, strict=True)], pa.bool_())
            yield batch.select(range(len(names))).filter(clean)

    return contamination(renamed, benchmark, **options, then=run, schema=renamed.schema).toDF(*names)


def judged(docs: DataFrame, benchmark: DataFrame, keep: list[str], **options) -> DataFrame:
    """The columns `keep` of every document, with n_words, n_hit, n_items, items_sha256, contaminated."""
    found = contamination(docs, benchmark, **options)
    names = [*keep, FOUND]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(len(keep)).to_pylist()
            hit = _hits(rows)
            own = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([
                *own, pa.array([r["n_words"] for r in rows], pa.int64()), pa.array(hit, pa.int64()),
                pa.array([len(r["item_ids"]) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(",".join(r["item_ids"]).encode()).hexdigest() for r in rows], pa.string()),
                pa.array([_contaminated(h, r["n_words"]) for h, r in zip(hit, rows, strict=True)], pa.bool_())],
                [*keep, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    selected = found.select(*names)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in selected.schema if f.name != FOUND)
    return selected.mapInArrow(run, f"{schema}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


@register("op9_benchmark_decontamination")
def op9_benchmark_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs, table(spark, sf_dir, "benchmark"), ["doc_id"])
