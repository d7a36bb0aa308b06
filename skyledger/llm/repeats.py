"""Repeated substrings over all documents: the exchange that operators 2 and 8 share.

A string of `length` symbols (words or bytes) in one document is repeated when it also starts in
another. Every such string holds `length` - `gram` + 1 grams; its anchor is the one with the least
hash (the leftmost of equals). Equal strings have equal anchors, so only strings with the same
anchor need to meet, and consecutive strings with one anchor travel as one slice.

1. Documents are gathered into blocks of bounded size, written once to the shared folder. A block
   tells each bucket which anchors it has, and a mark of each one's slice (72 bits, once per block).
2. A bucket answers which anchors occur in two documents at least, which of these have more than
   one slice, and which more than MOST_SLICES; other text goes no further.
3. A block sends its distinct slices under repeated anchors, each once with the smallest and
   largest of its documents in the block, and with its contents where the anchor has several
   slices. (The strings of an anchor's only slice start where the slice does, and nowhere else.)
   Under an anchor of more than MOST_SLICES (a line that many documents hold, each before its own
   text), every string travels alone, and its hash takes the anchor's place: equal strings still meet.
4. A shard settles slices that share an anchor (`settle`: the operator's own method): for every
   string of a slice, the smallest document it starts in. Only strings that some document of the
   block must lose return.
5. A block joins the answers with its documents and removes what a smaller document has.

Nothing is gathered by content in one task: a passage that a third of all documents share is one
slice per block. Rows exchanged are blocks; buckets grow in number with the shuffle partitions.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import partitions, small_batches, staged
from skyledger.llm.kernels import (
    SPACE_WORDS,
    Rolling,
    binary_column,
    byte_rolling,
    merged_spans,
    mixed,
    released,
    released_group,
    spread,
    text_slices,
    word_hashes,
    word_spans,
)

BLOCK_BYTES = 4 << 20
MOST_SLICES = 8192                      # of one anchor that are settled together
_SLICE = 1 << 18
_LOW_BITS, _TOLD = 30, 9                # bits of an anchor within its bucket; bytes told of an anchor
_LOW = np.uint64((1 << _LOW_BITS) - 1)
_ZSTD = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))


@dataclass(frozen=True)
class Unit:
    """What symbols are (`words` or `bytes`), how many make a string, and how many make a gram."""

    symbols: str
    length: int
    gram: int


@dataclass
class Slices:
    """Occurrences of anchored slices in some documents: row, first symbol in its document, number of strings, anchor, fingerprint."""

    row: np.ndarray
    start: np.ndarray
    strings: np.ndarray
    anchor: np.ndarray
    mark: np.ndarray
    place: np.ndarray            # first symbol in the sequence that the rows lie in


class Sequence:
    """The symbols of some documents, one after another."""

    def __init__(self, unit: Unit, data: np.ndarray, offsets: np.ndarray):
        self.unit, self.data, self.offsets = unit, data, offsets
        if unit.symbols == "words":
            self.starts, self.ends, self.firsts = word_spans(data, offsets, SPACE_WORDS)
            self.rolling = Rolling(word_hashes(data, self.starts, self.ends))
        else:
            self.firsts = offsets
            self.rolling = byte_rolling(data)

    def slices(self) -> Slices:
        unit, firsts = self.unit, self.firsts
        n = int(firsts[-1])
        grams = self.rolling.windows(unit.gram)
        if n < unit.length:
            none = np.zeros(0, np.int64)
            return Slices(none, none, none, none.astype(np.uint64), none.astype(np.uint64), none)
        least = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        reach, width = unit.length - unit.gram + 1, 1
        while width * 2 <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < reach:
            least = np.minimum(least[:n - unit.length + 1], least[reach - width:])
        at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)       # the anchor's place, by the string's start
        off = np.zeros(n + 1, np.int32)
        np.add.at(off, np.maximum(firsts[:-1], firsts[1:] - unit.length + 1), 1)
        np.add.at(off, firsts[1:], -1)
        starts = np.flatnonzero(np.cumsum(off)[:n - unit.length + 1] == 0)
        if not len(starts):
            return Slices(starts, starts, starts, starts.astype(np.uint64), starts.astype(np.uint64), starts)
        at = at[starts]
        new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)])
        first, place = starts[new], at[new]
        strings = np.diff(np.r_[new, len(starts)])
        row = np.searchsorted(firsts, first, "right") - 1
        mark = mixed(self.rolling.of(first, first + strings - 1 + unit.length) + ((place - first) << 20 | strings).astype(np.uint64))
        return Slices(row, first - firsts[row], strings, grams[place], mark, first)

    def contents(self, place: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What a shard needs of slices, as bytes one after another, and sizes: the text, or the hash of each string."""
        if self.unit.symbols == "words":
            return _gathered(self.rolling.windows(self.unit.length), place, strings).view(np.uint8), strings * 8
        sizes = strings - 1 + self.unit.length
        return _gathered(self.data, place, sizes), sizes

    def apart(self, slices: Slices, chosen: np.ndarray) -> Slices:
        """The slices, with each string of the chosen ones as a slice of its own; the hash of its halves is its anchor."""
        n = np.where(chosen, slices.strings, 1)
        of = np.repeat(np.arange(len(n)), n)
        split, step = chosen[of], spread(n)
        anchor, mark, place = slices.anchor[of], slices.mark[of], slices.place[of] + step
        first, end = place[split], place[split] + self.unit.length
        middle = first + self.unit.length // 2
        anchor[split] = mixed(self.rolling.of(first, middle) * np.uint64(0x9E3779B97F4A7C15) + self.rolling.of(middle, end))
        mark[split] = np.maximum(self.rolling.of(first, end), np.uint64(1))
        return Slices(slices.row[of], slices.start[of] + step, np.where(split, 1, slices.strings[of]), anchor, mark, place)


def _gathered(data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Stretches of `data`, one after another; their places are worked out for some stretches at a time."""
    out, at = np.empty(int(sizes.sum()), data.dtype), 0
    for i in range(0, len(sizes), 1 << 14):
        some = sizes[i:i + (1 << 14)]
        end = at + int(some.sum())
        out[at:end] = data[np.repeat(begins[i:i + (1 << 14)], some) + spread(some)]
        at = end
    return out


def _bucket(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _packed(columns: dict) -> bytes:
    return _stream(pa.Table.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns)))


def _stream(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=_ZSTD) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(scalar) -> pa.Table:
    return pa.ipc.open_stream(scalar.as_buffer()).read_all().combine_chunks()


def _number(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _listed(names: tuple[str, str], groups: list[tuple[int, bytes]]) -> pa.Array:
    """One row: an array of (bucket, bytes)."""
    struct = pa.StructArray.from_arrays([pa.array([g[0] for g in groups], pa.int32()), pa.array([g[1] for g in groups], pa.binary())], list(names))
    return pa.ListArray.from_arrays(pa.array([0, len(groups)], pa.int32()), struct)


def _ids(table: pa.Table, id_at: int) -> tuple[np.ndarray, np.ndarray]:
    column = table.column(id_at).cast(pa.int64())
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy()


def _sequences(unit: Unit, table: pa.Table, text_at: int) -> Iterator[tuple[int, int, Sequence]]:
    for row, end, data, offsets in text_slices(table.column(text_at), _SLICE):
        yield row, end, Sequence(unit, data, offsets)


def _all_slices(unit: Unit, table: pa.Table, id_at: int, text_at: int, keep: Callable | None = None) -> tuple[Slices, list]:
    """Slices of all rows with an id, and contents of those that `keep` selects by anchor."""
    ids, known = _ids(table, id_at)
    found, contents = [], []
    for row, _, sequence in _sequences(unit, table, text_at):
        s = sequence.slices()
        said = np.ones(len(s.row), np.int64) if keep is None else keep(s.anchor)
        chosen = np.flatnonzero(known[s.row + row] & (said > 0))
        own = Slices(s.row[chosen] + row, s.start[chosen], s.strings[chosen], s.anchor[chosen], s.mark[chosen], s.place[chosen])
        if keep is not None:
            said = said[chosen]
            if (said == 3).any():
                split = said == 3
                said = np.repeat(said, np.where(split, own.strings, 1))
                own = sequence.apart(own, split)
            alone = said == 1
            own.mark = np.where(alone, np.uint64(0), own.mark)
            data, sizes = sequence.contents(own.place[~alone], own.strings[~alone])
            every = np.zeros(len(said), np.int64)
            every[~alone] = sizes
            contents.append((data, every))
        found.append(own)
    parts = [np.concatenate([getattr(f, n) for f in found]) if found else np.zeros(0, np.int64) for n in Slices.__annotations__]
    return Slices(*parts), contents


def _key(anchor: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 30 bits of an anchor, as one number."""
    return _bucket(anchor, buckets).astype(np.uint64) << np.uint64(_LOW_BITS) | (anchor & _LOW)


def _told(slices: Slices, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchors in order: (key, whether two rows have it, whether it has two slices, their number or the only one's mark)."""
    key = _key(slices.anchor, buckets)
    order = np.argsort(key, kind="stable")
    key, row, mark = key[order], slices.row[order], slices.mark[order]
    new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    if not len(new):
        return key, np.zeros(0, bool), np.zeros(0, bool), mark
    many = np.maximum.reduceat(row, new) != np.minimum.reduceat(row, new)
    several = np.maximum.reduceat(mark, new) != np.minimum.reduceat(mark, new)
    told, n = mark[new], np.where(several, np.diff(np.r_[new, len(key)]), 0)
    at = np.repeat(new, n) + spread(n)                             # all slices of anchors with several
    group, own = np.repeat(np.arange(len(new)), n), mark[at]
    order = np.lexsort((own, group))
    group, own = group[order], own[order]
    distinct = np.r_[True, (group[1:] != group[:-1]) | (own[1:] != own[:-1])] if len(own) else np.zeros(0, bool)
    told[several] = np.bincount(group[distinct], minlength=len(new))[several]
    return key[new], many, several, told


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Stretches of equal values in a sorted array."""
    cuts = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
    edges = [0, *cuts.tolist(), len(bucket)] if len(bucket) else []
    for s, e in zip(edges[:-1], edges[1:], strict=True):
        yield int(bucket[s]), slice(s, e)


def without_repeats(docs: DataFrame, unit: Unit, settle: Callable, finish: Callable, schema: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of `finish` for all rows of `docs`.

    settle(unit, group, contents, least): for distinct slices (`group`: equal for equal anchors, in
    ascending order; `contents`: an Arrow binary array; `least`: the smallest document of each) the
    arrays (slice, first string, end, smallest document), in order of slice.
    finish(unit, sequence, table, spans): an Arrow batch of `schema` for the rows of a sequence;
    spans: for each row with removed symbols, their maximal runs.
    """
    names = docs.columns
    id_at, text_at = names.index(id_col), names.index(text_col)
    buckets, most = 4 * partitions(docs), MOST_SLICES
    small_batches(docs.sparkSession)

    @released
    def block(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _in_blocks(batches, text_at):
            yield pa.RecordBatch.from_arrays([pa.array([int.from_bytes(os.urandom(8), "little", signed=True)], pa.int64()),
                                              pa.array([_stream(table)], pa.binary())], ["block", "payload"])

    blocks = staged(docs.mapInArrow(block, "block long, payload binary"), "blocks", large_rows=True)

    @released
    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                slices, _ = _all_slices(unit, _unpacked(batch.column(1)[r]), id_at, text_at)
                key, many, several, mark = _told(slices, buckets)
                words = np.zeros((len(key), _TOLD), np.uint8)
                words[:, :4] = ((key & _LOW) << np.uint64(2) | many.astype(np.uint64) << np.uint64(1) | several).view(np.uint8).reshape(-1, 8)[:, :4]
                words[:, 4:] = np.ascontiguousarray(mark).view(np.uint8).reshape(-1, 8)[:, :5]
                parts = list(_by_bucket((key >> np.uint64(_LOW_BITS)).astype(np.int64)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(parts), batch.column(0)[r].as_py()), pa.int64()), pa.array([b for b, _ in parts], pa.int32()),
                    pa.array([words[part].tobytes() for _, part in parts], pa.binary())], ["block", "bucket", "anchors"])

    @released_group
    def answer(table: pa.Table) -> pa.Table:
        sizes = [len(x.as_buffer()) // _TOLD for x in table.column("anchors")]
        told = np.frombuffer(b"".join(x.as_buffer().to_pybytes() for x in table.column("anchors")), np.uint8).reshape(-1, _TOLD)
        low = np.ascontiguousarray(told[:, :4]).view(np.uint32).reshape(-1)
        mark = np.zeros((len(told), 8), np.uint8)
        mark[:, :5] = told[:, 4:]
        mark = mark.reshape(-1).view(np.uint64)
        order = np.argsort(low >> 2, kind="stable")
        sorted_low, sorted_mark = low[order], mark[order]
        new = np.r_[True, sorted_low[1:] >> 2 != sorted_low[:-1] >> 2]
        first, group = np.flatnonzero(new), np.cumsum(new) - 1
        repeated = (np.diff(np.r_[first, len(order)]) > 1) | (np.maximum.reduceat(sorted_low & 2, first) > 0)
        several = (np.maximum.reduceat(sorted_mark, first) != np.minimum.reduceat(sorted_mark, first)) | (np.maximum.reduceat(sorted_low & 1, first) > 0)
        number = np.add.reduceat(np.where(sorted_low & 1, sorted_mark, 1), first)      # of slices, each once per block
        said = np.empty(len(order), np.uint8)                      # 0: one document only, 1: one slice, 2: several, 3: too many
        said[order] = (repeated * (1 + several + (several & (number > most))))[group]
        ends = np.cumsum(sizes)
        answers = [np.packbits(np.stack([said[e - s:e] & 1, said[e - s:e] >> 1])).tobytes() for s, e in zip(sizes, ends.tolist(), strict=True)]
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "bits": pa.array(answers, pa.binary())})

    answers = blocks.mapInArrow(tell, "block long, bucket int, anchors binary").groupBy("bucket").applyInArrow(
        answer, "block long, bucket int, bits binary")
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))      # as many as there are buckets
    answers = staged(answers, "answers")                           # the anchors' exchange goes before the blocks are joined

    @released
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                table = _unpacked(batch.column(1)[r])
                bits = {a["bucket"]: a["bits"] for a in batch.column(2)[r].as_py()}
                every, _ = _all_slices(unit, table, id_at, text_at)
                key, _, _, _ = _told(every, buckets)
                del every
                said = [np.unpackbits(np.frombuffer(bits[b], np.uint8), count=2 * (part.stop - part.start)).reshape(2, -1)
                        for b, part in _by_bucket((key >> np.uint64(_LOW_BITS)).astype(np.int64))]
                said = np.array([1, 2]) @ np.concatenate(said, axis=1) if said else np.zeros(0, np.int64)
                repeated, said = key[said > 0], said[said > 0]

                def keep(anchor: np.ndarray, repeated=repeated, said=said) -> np.ndarray:
                    """0: goes no further, 1: the anchor's only slice, 2: one of several, 3: one of too many."""
                    wanted = _key(anchor, buckets)
                    at = np.searchsorted(repeated, wanted)
                    at[at == len(repeated)] = 0
                    return np.where(repeated[at] == wanted, said[at], 0) if len(repeated) else np.zeros(len(anchor), np.int64)

                slices, contents = _all_slices(unit, table, id_at, text_at, keep)
                ids, _ = _ids(table, id_at)
                yield _sent(batch.column(0).slice(r, 1), slices, contents, ids, buckets)

    sent = staged(blocks.select("block", "payload").join(answers, "block").mapInArrow(
        send, "block long, occurrences binary, sent array<struct<bucket:int,slices:binary>>"), "slices", large_rows=True)

    @released_group
    def shard(table: pa.Table) -> pa.Table:
        return _settled(unit, settle, table)

    runs = sent.select("block", F.explode("sent").alias("s")).select("block", "s.bucket", "s.slices").groupBy("bucket").applyInArrow(
        shard, "block long, bucket int, runs binary")
    runs = runs.groupBy("block").agg(F.collect_list(F.struct("bucket", "runs")).alias("runs"))
    results = staged(runs, "runs")

    @released
    def done(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                table = _unpacked(batch.column(0)[r])
                row, start, end = _removed(unit, table, id_at, batch.column(1)[r], batch.column(2)[r])
                for first, last, sequence in _sequences(unit, table, text_at):
                    s, e = np.searchsorted(row, [first, last])
                    spans = {int(k) - first: merged_spans(start[s:e][p], end[s:e][p]) for k, p in _by_bucket(row[s:e])}
                    yield finish(unit, sequence, table.slice(first, last - first), spans)

    whole = blocks.select("block", "payload").join(sent.select("block", "occurrences"), "block", "left").join(results, "block", "left")
    return whole.select("payload", "occurrences", "runs").mapInArrow(done, schema)


def _in_blocks(batches: Iterable[pa.RecordBatch], text_at: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        lengths = np.cumsum(pc.binary_length(batch.column(text_at)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
        row, before = 0, 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(lengths, before + BLOCK_BYTES - size, "right")))
            held.append(batch.slice(row, end - row))
            size += int(lengths[end - 1]) - before
            row, before = end, int(lengths[end - 1])
            if size >= BLOCK_BYTES or row < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _sent(block: pa.Array, slices: Slices, contents: list, ids: np.ndarray, buckets: int) -> pa.RecordBatch:
    bucket = _bucket(slices.anchor, buckets)
    order = np.lexsort((slices.mark, slices.anchor, bucket))
    b, anchor, mark = bucket[order], slices.anchor[order], slices.mark[order]
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (mark[1:] != mark[:-1])] if len(order) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    doc = ids[slices.row[order]]
    least = np.minimum.reduceat(doc, first) if len(first) else doc
    most = np.maximum.reduceat(doc, first) if len(first) else doc
    sizes = np.concatenate([c[1] for c in contents]) if contents else np.zeros(0, np.int64)
    data = np.concatenate([c[0] for c in contents]) if contents else np.zeros(0, np.uint8)
    begins = np.cumsum(sizes) - sizes
    chosen = order[first]
    column = binary_column(_gathered(data, begins[chosen], sizes[chosen]), sizes[chosen])
    strings = slices.strings[chosen].astype(np.int16)
    groups = [(k, _packed({"anchor": anchor[first][p], "mark": mark[first][p], "least": least[p], "most": most[p], "strings": strings[p], "content": column[p.start:p.stop]}))
              for k, p in _by_bucket(b[first])]
    # occurrences: in order of bucket and of the slice's number in it
    number = np.cumsum(new) - 1
    within = number - (np.searchsorted(b[first], b, "left") if len(b) else number)
    local = _packed({"bucket": b.astype(np.int32), "number": within.astype(np.int32), "row": slices.row[order].astype(np.int32), "start": slices.start[order].astype(np.int32)})
    return pa.RecordBatch.from_arrays([block, pa.array([local], pa.binary()), _listed(("bucket", "slices"), groups)], ["block", "occurrences", "sent"])


def _settled(unit: Unit, settle: Callable, table: pa.Table) -> pa.Table:
    parts = [_unpacked(x) for x in table.column("slices")]
    counts = np.array([p.num_rows for p in parts])
    got = pa.concat_tables(parts).combine_chunks()
    anchor, mark, least, most = (_number(got, n) for n in ("anchor", "mark", "least", "most"))
    order = np.lexsort((mark, anchor))
    a, m = anchor[order], mark[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (m[1:] != m[:-1])]
    first = np.flatnonzero(new)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1                              # each block's slice -> distinct slice
    smallest = np.minimum.reduceat(least[order], first)
    group = np.cumsum(np.r_[True, a[first][1:] != a[first][:-1]]) - 1
    contents = got.column("content").combine_chunks()
    contents = contents.chunk(0) if isinstance(contents, pa.ChunkedArray) else contents
    # a group of one slice has nothing to compare: its strings start where the slice does, and nowhere else. An anchor's only slice
    # comes without a mark; strings that travel alone, and what is left of an anchor in a shard, may be such groups too
    single = (m[first] == 0) | (np.bincount(group)[group] == 1)
    several = np.flatnonzero(~single)
    slice_, start, end, doc = settle(unit, group[several], contents.take(pa.array(order[first[several]])), smallest[several])
    alone = np.flatnonzero(single & (smallest < np.maximum.reduceat(most[order], first)))      # else one document has it
    slice_ = np.r_[several[slice_], alone]
    start, end = np.r_[start, np.zeros(len(alone), np.int64)], np.r_[end, _number(got, "strings")[order[first[alone]]]]
    doc = np.r_[doc, smallest[alone]]
    by_slice = np.argsort(slice_, kind="stable")
    slice_, start, end, doc = slice_[by_slice], start[by_slice], end[by_slice], doc[by_slice]
    lo, hi = np.searchsorted(slice_, which), np.searchsorted(slice_, which, "right")
    n = hi - lo
    at = np.repeat(lo, n) + spread(n)
    owner = np.repeat(np.arange(len(which)), n)
    useful = doc[at] < most[owner]                                 # some document of the block loses these strings
    at, owner = at[useful], owner[useful]
    ends = np.cumsum(counts)
    out = []
    for size, stop in zip(counts.tolist(), ends.tolist(), strict=True):
        s, e = np.searchsorted(owner, [stop - size, stop])
        out.append(_packed({"number": (owner[s:e] - (stop - size)).astype(np.int32), "first": start[at[s:e]].astype(np.int32),
                            "end": end[at[s:e]].astype(np.int32), "doc": doc[at[s:e]]}))
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "runs": pa.array(out, pa.binary())})


def _removed(unit: Unit, table: pa.Table, id_at: int, occurrences, runs) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first symbol, end) of what smaller documents have, by row."""
    none = np.zeros(0, np.int64)
    if not occurrences.is_valid or not runs.is_valid:
        return none, none, none
    ids, _ = _ids(table, id_at)
    local = _unpacked(occurrences)
    keys, firsts, ends, docs = [], [], [], []
    for part in runs:
        got = _unpacked(part["runs"])
        if got.num_rows:
            keys.append(np.int64(part["bucket"].as_py()) << 32 | _number(got, "number").astype(np.int64))
            firsts.append(_number(got, "first"))
            ends.append(_number(got, "end"))
            docs.append(_number(got, "doc"))
    if not keys:
        return none, none, none
    key, first, end, doc = map(np.concatenate, (keys, firsts, ends, docs))
    order = np.argsort(key, kind="stable")
    key, first, end, doc = key[order], first[order], end[order], doc[order]
    own = _number(local, "bucket").astype(np.int64) << 32 | _number(local, "number")
    lo, hi = np.searchsorted(key, own), np.searchsorted(key, own, "right")
    n = hi - lo
    at = np.repeat(lo, n) + spread(n)
    row = np.repeat(_number(local, "row"), n).astype(np.int64)
    start = np.repeat(_number(local, "start"), n).astype(np.int64)
    lost = doc[at] < ids[row]
    at, row, start = at[lost], row[lost], start[lost]
    order = np.lexsort((start, row))
    return row[order], (start + first[at])[order], (start + end[at] - 1 + unit.length)[order]


def runs_of(slice_: np.ndarray, place: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Strings (in order of slice and place) with one smallest document, as runs: (slice, first, end, document)."""
    if not len(slice_):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    new = np.flatnonzero(np.r_[True, (slice_[1:] != slice_[:-1]) | (doc[1:] != doc[:-1])])
    last = np.r_[new[1:] - 1, len(slice_) - 1]
    return slice_[new], place[new], place[last] + 1, doc[new]
