"""Substring de-duplication by level-wise doubling (operator 2).

The first level looks at windows of half the length (25 of 50 words): of those that anchor a full
window, the ones that occur in one document only go no further. Only windows around repeated ones
are extended to twice that length and compared again by their hashes (64 bits of the half window and
64 of the full one). Asked for longer repeats (`longest_repeats`), the doubling goes on over the
documents that still hold a repeated window, until no candidate survives.

Words are `[^\\x20\\x09-\\x0D]+`. Every word covered by a window whose word sequence also starts in a
document with a smaller doc_id is removed.

Defined results: a null text has no words; documents shorter than a window lose nothing; rows with a
null doc_id neither lose nor take anything; rows that share a doc_id do not affect each other;
windows count as they are in the input, not in what is left.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import register, staged, table
from skyledger.llm.kernels import spread
from skyledger.llm.repeats import Sequence, Unit, runs_of, without_repeats

WINDOW = 50


def settle(unit: Unit, group: np.ndarray, contents: pa.Array, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The smallest document of every window of the slices, as runs: windows with one half window and one hash are equal."""
    offsets = np.frombuffer(contents.buffers()[1], np.int64)[contents.offset:contents.offset + len(contents) + 1] // 8
    hashes = np.frombuffer(contents.buffers()[2], np.uint64)
    counts = np.diff(offsets)
    slice_, place = np.repeat(np.arange(len(counts)), counts), spread(counts)
    hashes = hashes[np.repeat(offsets[:-1], counts) + place]
    if not len(hashes):
        return runs_of(*[np.zeros(0, np.int64)] * 3)
    anchor = group[slice_]
    order = np.lexsort((hashes, anchor))
    h, a = hashes[order], anchor[order]
    new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (a[1:] != a[:-1])])
    smallest = np.empty(len(hashes), np.int64)
    smallest[order] = np.repeat(np.minimum.reduceat(least[slice_[order]], new), np.diff(np.r_[new, len(h)]))
    return runs_of(slice_, place, smallest)


def _kept(sequence: Sequence, spans: dict) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the kept words, number of the first kept word of each row)"""
    gone = np.zeros(int(sequence.firsts[-1]) + 1, np.int32)
    for i, (starts, ends) in spans.items():
        gone[starts + sequence.firsts[i]] += 1
        gone[ends + sequence.firsts[i]] -= 1
    words = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
    return words, np.searchsorted(words, sequence.firsts)


def kept_texts(sequence: Sequence, spans: dict) -> list[bytes]:
    """The kept words of each row, joined by one space."""
    words, firsts = _kept(sequence, spans)
    sizes = sequence.ends[words] - sequence.starts[words] + 1      # a space after each word
    ends = np.cumsum(sizes)
    source = np.repeat(sequence.starts[words], sizes) + spread(sizes)
    joined = sequence.data[np.minimum(source, len(sequence.data) - 1)] if len(sequence.data) else np.zeros(0, np.uint8)
    joined[ends - 1] = 0x20
    at = np.r_[0, ends][firsts]
    return [joined[s:max(e - 1, s)].tobytes() for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def removal_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, longest_span (removed words in a row), kept_sha256 of every row (columns doc_id and text)."""
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def finish(unit: Unit, sequence: Sequence, rows: pa.Table, spans: dict) -> pa.RecordBatch:
        lost = [int((spans[i][1] - spans[i][0]).sum()) if i in spans else 0 for i in range(rows.num_rows)]
        runs = [len(spans[i][0]) if i in spans else 0 for i in range(rows.num_rows)]
        longest = [int((spans[i][1] - spans[i][0]).max()) if i in spans else 0 for i in range(rows.num_rows)]
        return pa.RecordBatch.from_arrays([
            rows.column(0).combine_chunks(), pa.array(np.diff(sequence.firsts)), pa.array(lost, pa.int64()), pa.array(runs, pa.int64()),
            pa.array(longest, pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in kept_texts(sequence, spans)], pa.string())],
            ["doc_id", "n_words", "n_removed", "n_spans", "longest_span", "kept_sha256"])

    return without_repeats(docs, Unit("words", window, (window + 1) // 2), settle, finish,
                           f"doc_id {kind}, n_words long, n_removed long, n_spans long, longest_span long, kept_sha256 string")


def longest_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, length): the longest of the lengths window, 2 x window, 4 x window, ... at which a window of
    the document repeats one of a smaller document; documents without any are left out.

    Each level looks only at texts that may hold a repeated window of its length: documents with a
    removed run as long, and the documents that could be its source (those with as many words).
    """
    texts, length, levels = docs.select("doc_id", "text"), window, None
    while True:
        report = staged(removal_report(texts, length), "level")
        repeated = report.filter("n_removed > 0").select("doc_id", F.lit(length).alias("length"))
        if repeated.isEmpty():
            break
        levels = repeated if levels is None else levels.unionByName(repeated)
        length *= 2
        alive = report.filter(F.col("n_words") >= length).select("doc_id").distinct()
        texts = staged(texts.join(alive, "doc_id", "left_semi"), "level-texts")
    if levels is None:
        return report.select("doc_id", F.lit(window).alias("length")).limit(0)
    return levels.groupBy("doc_id").agg(F.max("length").alias("length"))


@register("op2_substring_dedup")
def op2_substring_dedup(spark, sf_dir):
    return removal_report(table(spark, sf_dir, "documents"))
