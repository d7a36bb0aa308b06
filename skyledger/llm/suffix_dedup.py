"""Suffix-array de-duplication (operator 8).

Every byte covered by a string of `length` bytes that also starts in a document with a smaller
doc_id is removed. Strings meet in shards (see `repeats`). A shard joins its distinct slices, sorts
all their suffixes by induced sorting, computes the longest common prefixes in text order, and takes
neighbours in suffix order that share `length` bytes as one string; its first document is the
smallest of their slices' documents.

Slices of different anchors share no string, so a shard is sorted in parts of at most PART_BYTES
(an anchor's slices stay together: MOST_SLICES of them at most, see `repeats`).

Defined results: a null text has no bytes; documents shorter than `length` lose nothing; rows with a
null doc_id neither lose nor take anything; rows that share a doc_id do not affect each other;
strings count as they are in the input, not in what is left.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm.common import register, table
from skyledger.llm.repeats import Sequence, Unit, runs_of, without_repeats
from skyledger.llm.suffix_array import common_prefixes, suffix_array

LENGTH = 50
GRAM = 16
PART_BYTES = 1 << 19


def settle(unit: Unit, group: np.ndarray, contents: pa.Array, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The smallest document of every string of the slices, as runs."""
    offsets = np.frombuffer(contents.buffers()[1], np.int64)[contents.offset:contents.offset + len(contents) + 1]
    data = np.frombuffer(contents.buffers()[2], np.uint8)
    out, at = [], 0
    while at < len(group):
        end = max(int(np.searchsorted(offsets, offsets[at] + PART_BYTES, "right")) - 1, at + 1)
        end = len(group) if end >= len(group) else int(np.searchsorted(group, group[end]))
        if end <= at:                                              # one anchor over the limit
            end = int(np.searchsorted(group, group[at], "right"))
        slice_, first, stop, doc = _sorted_part(unit.length, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at], least[at:end])
        out.append((slice_ + at, first, stop, doc))
        at = end
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else runs_of(*[np.zeros(0, np.int64)] * 3)


def _sorted_part(length: int, data: np.ndarray, offsets: np.ndarray, least: np.ndarray):
    sizes = np.diff(offsets)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    text = np.ones(len(data) + len(sizes) + 1, np.uint16)          # 1 after each slice, 0 at the end
    place = np.arange(len(data)) + owner
    text[place] = data.astype(np.uint16) + 2
    text[-1] = 0
    order = suffix_array(text)
    shared = common_prefixes(text, order)
    slice_at = np.full(len(text), -1, np.int64)                    # the slice of each full string
    full = np.arange(len(data)) + length <= offsets[owner + 1]
    slice_at[place[full]] = owner[full]
    strings = order[slice_at[order] >= 0]
    new = np.flatnonzero(np.r_[True, shared[strings][1:] < length])
    docs = least[slice_at[strings]]
    smallest = np.empty(len(text), np.int64)
    smallest[strings] = np.repeat(np.minimum.reduceat(docs, new), np.diff(np.r_[new, len(strings)])) if len(strings) else docs
    places = place[full]
    return runs_of(owner[full], np.arange(len(data))[full] - offsets[owner[full]], smallest[places])


def _report(unit: Unit, sequence: Sequence, rows: pa.Table, spans: dict, id_at: int) -> pa.RecordBatch:
    n_removed, n_spans, digests = [], [], []
    for i, (s, e) in enumerate(zip(sequence.offsets[:-1].tolist(), sequence.offsets[1:].tolist(), strict=True)):
        kept, lost, count = kept_bytes(sequence.data[s:e], spans.get(i))
        n_removed.append(lost)
        n_spans.append(count)
        digests.append(hashlib.sha256(kept).hexdigest())
    return pa.RecordBatch.from_arrays([
        rows.column(id_at).combine_chunks(), pa.array(np.diff(sequence.offsets)), pa.array(n_removed, pa.int64()),
        pa.array(n_spans, pa.int64()), pa.array(digests, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def kept_bytes(data: np.ndarray, spans) -> tuple[bytes, int, int]:
    """(what is left, bytes removed, maximal removed runs)"""
    if spans is None:
        return data.tobytes(), 0, 0
    starts, ends = spans
    keep = np.zeros(len(data) + 1, np.int8)
    keep[starts] += 1
    keep[ends] -= 1
    return data[np.cumsum(keep[:-1]) == 0].tobytes(), int((ends - starts).sum()), len(starts)


def removal_report(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row (columns doc_id and text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")

    def finish(unit, sequence, rows, spans):
        return _report(unit, sequence, rows, spans, 0)

    return without_repeats(docs, Unit("bytes", length, gram), settle, finish,
                           f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeated_bytes(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The rows and columns of `docs` with the repeated bytes taken out of `text`; what is left of a
    character that was cut goes too. `n_chars`, where there is one, follows the text."""
    names = docs.columns
    text_at = names.index("text")

    def finish(unit, sequence, rows, spans):
        texts = rows.column(text_at).combine_chunks().to_pylist()
        for i, found in spans.items():
            s, e = sequence.offsets[i], sequence.offsets[i + 1]
            texts[i] = kept_bytes(sequence.data[s:e], found)[0].decode("utf-8", "ignore")
        columns = [rows.column(i).combine_chunks() for i in range(len(names))]
        columns[text_at] = pa.array(texts, rows.schema.field(text_at).type)
        if "n_chars" in names and spans:
            at = names.index("n_chars")
            counts = columns[at].to_pylist()
            for i in spans:
                counts[i] = len(texts[i])
            columns[at] = pa.array(counts, columns[at].type)
        return pa.RecordBatch.from_arrays(columns, names)

    return without_repeats(docs, Unit("bytes", length, gram), settle, finish, docs.schema)


@register("op8_suffix_array_dedup")
def op8_suffix_array_dedup(spark, sf_dir):
    return removal_report(table(spark, sf_dir, "documents"))
