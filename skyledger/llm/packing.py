"""Best-fit packing by minimum bin slack (operator 4).

Every document becomes token ids and an end token; only documents longer than a sequence are cut.
The pieces' lengths are counted (at most one row per length), the plan is made from those counts,
and the plan is applied to all pieces in parallel by their numbers among pieces of equal length.

The plan: the longest length left opens a bin, bitset subset-sum dynamic programming over the
lengths left (with their counts) finds the fullest combination beside it, and the combination is
taken as often as the counts allow. After a step some length has fewer pieces left than the step
took at once, so the number of steps depends on the lengths, not on the number of documents.

Defined results: a null text counts as empty (the end token alone); repeated rows are packed as
often as they occur; the string of an added token (<|endoftext|>) is that token; ties go to longer lengths; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import dense_rank_in, register, staged, table
from skyledger.llm.kernels import released, text_slices
from skyledger.llm.token_ids import KEEP, drop_encoders, encoder, tokenizer_path

SEQUENCE = 1024
END_ID = 2
_SLICE = 1 << 20
_STRETCH = 1 << 18              # bytes whose pieces are found at once


def cut(n_ids: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; of several, only the first may be shorter."""
    if n_ids <= size:
        return [(0, n_ids)]
    first = n_ids % size
    return ([(0, first)] if first else []) + [(s, size) for s in range(first, n_ids, size)]


def token_pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SEQUENCE, end_id: int = END_ID, keep: int = KEEP) -> DataFrame:
    """One row per piece: its document, number, start, length and the CRC-32 of its ids. `keep`: text pieces whose ids a worker remembers."""
    @released
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            encode = encoder(tokenizer, keep, _STRETCH).encode
            for batch in batches:
                for row, end, data, offsets in text_slices(batch.column(1), _SLICE):
                    ids, begins = encode(data, offsets)
                    closed = np.insert(ids, begins[1:], end_id).astype("<u4")
                    begins = begins + np.arange(len(begins))             # every document before has its end token by now
                    out = []
                    for i, (at, n) in enumerate(zip(begins[:-1].tolist(), np.diff(begins).tolist(), strict=True)):
                        out += [(row + i, k, s, length, zlib.crc32(closed[at + s:at + s + length])) for k, (s, length) in enumerate(cut(n, size))]
                    which, piece, start, length, crc = map(list, zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])
        finally:
            drop_encoders()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, times) of the fullest combination of lengths that fits `room`: bitset subset sums."""
    reach, steps = 1, []
    limit = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if counts[x] and x <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left:                                        # 1, 2, 4, ... copies at once
            part = min(part, left)
            steps.append((length, part, reach))
            reach |= (reach << (length * part)) & limit
            left -= part
            part *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, part, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + part
            total -= length * part
    return list(chosen.items())


def slack_plan(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[int, list[tuple[int, int]]]]:
    """(copies, [(length, times)]) of each combination, in order."""
    left = {k: v for k, v in counts.items() if v}
    plan = []
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = dict(fullest(left, size - longest))
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        copies = min(left[x] // k for x, k in chosen.items())
        for x, k in chosen.items():
            left[x] -= k * copies
            if not left[x]:
                del left[x]
        plan.append((copies, sorted(chosen.items(), reverse=True)))
    return plan


def packed(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Add `sequence_id` and `offset` to pieces (rows with a `length` of 1 to `size`)."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}   # at most `size` rows
    rows, used, sequence = [], dict.fromkeys(counts, 0), 0
    for copies, chosen in slack_plan(counts, size):
        offset = 0
        for length, times in chosen:
            rows.append((length, used[length], copies, sequence, offset))
            used[length] += copies * times
            offset += length * times
        sequence += copies
    rows.sort()
    lengths, first, copies, base, offset = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 5
    bounds = np.searchsorted(lengths, np.arange(size + 2))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False)
            number = batch.column(names.index("__number")).to_numpy(zero_copy_only=False)
            lo, hi = bounds[length], bounds[length + 1] - 1
            while (open_ := lo < hi).any():                # the last step of the length that begins at or before the number
                mid = (lo + hi + 1) // 2
                over = first[mid] > number
                hi = np.where(open_ & over, mid - 1, hi)
                lo = np.where(open_ & ~over, mid, lo)
            place_ = number - first[lo]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i, n in enumerate(names) if n != "__number"] +
                [pa.array(base[lo] + place_ % copies[lo]), pa.array(offset[lo] + place_ // copies[lo] * length)],
                [n for n in names if n != "__number"] + ["sequence_id", "offset"])

    identity = [c for c in pieces.columns if c != "length"]
    numbered = dense_rank_in(pieces, ["length"], [F.col(c) for c in identity], [F.col(c) for c in identity], "__number")
    names = numbered.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "__number")
    return numbered.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID, keep: int = KEEP) -> DataFrame:
    """All documents as pieces with their places in sequences of at most `size` tokens."""
    pieces = staged(token_pieces(docs, tokenizer, size=size, end_id=end_id, keep=keep), "token-pieces")
    return packed(pieces, size)


@register("op4_best_fit_packing")
def op4_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
