"""MinHash near-duplicates (operator 7): one-permutation hashing with optimal densification,
banded buckets and star-shaped candidate edges, confirmed on the full shingle sets.

1. One pass over the texts: the set of distinct five-word shingles (64-bit hashes), its size, its
   fingerprint and its signature. The hash range is cut into bins (384 at 85 %) and the least hash of each
   non-empty bin is kept; an empty bin takes the value of a bin drawn by its own hash sequence.
2. Documents with equal sets collapse to the one with the smallest doc_id.
3. Each band (`banding`: 48 of 8 bins at 85 %, 64 of 7 at 80 %) gives a bucket. Within a bucket every member is paired with the
   smallest one: n - 1 pairs. Pairs whose sizes rule the similarity out go.
4. Pairs are confirmed on full sets, computed anew from the two texts.
5. A star can miss a link between two members that are both unlike the centre. Documents of buckets that still hold several
   components are contested. Of each such bucket the member with the fewest shingles of its own becomes a second
   centre: where a bucket holds edited copies, that is what they were made from, and they are joined by it.
6. What contested documents are still apart meets by an exact prefix filter: their shingles are ordered by rarity, and two sets
   that reach the similarity share one of the first few, in both of which enough must follow. Only pairs of
   different components are made; pairs within one change nothing. A common passage's shingles come late in the order.
   No bucket is capped.

A pair shares no bucket with probability 2e-7 at the threshold, and less above it: (1 - s^8)^48 at
similarity s for 85 %, (1 - s^7)^64 for 80 %. Long bands keep texts that only share a passage apart
(at 0.3 one pair in 300 meets in 48 bands of 8, one in 70 in 64 of 7). Operator 7 asks for 85 %, the
pipeline's stage for 80 % (`CORPUS_PERCENT`).

Defined results: a null or blank text has an empty set and stands alone; a null doc_id is linked with
nothing and kept; rows that share a doc_id are one document, linked by any of its texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from skyledger.llm.common import passing, register, staged, table
from skyledger.llm.graph import components
from skyledger.llm.kernels import LOWER, SPACE_WORDS, Rolling, mixed, released, text_slices, word_hashes, word_spans

SHINGLE = 5
PERCENT = 85
CORPUS_PERCENT = 80
MISSED = 3e-7                   # a pair at the threshold shares no bucket with at most this probability


def banding(percent: int) -> tuple[int, int]:
    """(bands, bins of a band) for a threshold."""
    rows = 8 if percent >= PERCENT else 7
    return math.ceil(math.log(MISSED) / math.log1p(-min(percent / 100, 0.99) ** rows)), rows


BANDS, ROWS = banding(PERCENT)


@cache
def _attempts(bins: int) -> np.ndarray:
    return np.random.default_rng(7).integers(0, bins, (96, bins))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes of all documents, each document's ascending; where each document's begin)."""
    data = LOWER[data]
    starts, ends, firsts = word_spans(data, offsets, SPACE_WORDS)
    words = word_hashes(data, starts, ends)
    rolling = Rolling(words)
    every = rolling.windows(size)
    sets = []
    for first, end in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
        if end - first >= size:
            own = np.sort(every[first:end - size + 1])
            sets.append(own[np.r_[True, own[1:] != own[:-1]]])
        elif end > first:                                # fewer words: the whole sequence
            sets.append(mixed(rolling.of(np.array([first]), np.array([end])) + np.uint64(end - first)))
        else:
            sets.append(np.zeros(0, np.uint64))
    at = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=at[1:])
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), at


def signatures(hashes: np.ndarray, at: np.ndarray, bins: int = BANDS * ROWS) -> np.ndarray:
    """The densified one-permutation signature of each set (a row of zeros for an empty one)."""
    n = len(at) - 1
    doc = np.repeat(np.arange(n), np.diff(at))
    cell = doc * bins + ((hashes >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)      # ascending in a set
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
    values, filled = np.zeros(n * bins, np.uint64), np.zeros(n * bins, bool)
    values[cell[first]], filled[cell[first]] = hashes[first], True
    values, filled = values.reshape(n, bins), filled.reshape(n, bins)
    out = values.copy()
    row, bin_ = np.nonzero(~filled & filled.any(axis=1)[:, None])
    for attempt in _attempts(bins):                            # each empty bin follows its own sequence of bins
        source = attempt[bin_]
        got = filled[row, source]
        out[row[got], bin_[got]] = values[row[got], source[got]]
        row, bin_ = row[~got], bin_[~got]
        if not len(row):
            break
    step = 0
    while len(row):                                      # sets of a few shingles: the next filled bin
        step += 1
        source = (bin_ + step) % bins
        got = filled[row, source]
        out[row[got], bin_[got]] = values[row[got], source[got]]
        row, bin_ = row[~got], bin_[~got]
    return out


def band_keys(signature: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit bucket key per band, different for different bands."""
    parts = signature.reshape(len(signature), bands, rows)
    key = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(rows):
        key = mixed((key ^ parts[:, :, i]) + np.uint64(i + 1))
    return key


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, two fingerprints of the set and its band keys (none for an empty set)."""
    kind = docs.schema[id_col].dataType.simpleString()
    n_bands, n_rows = banding(percent)

    @released
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column(1)):
                hashes, at = shingle_sets(data, offsets)
                sums = [np.r_[np.uint64(0), np.cumsum(mixed(hashes ^ np.uint64(salt)))] for salt in (0x51ED27, 0xC0FFEE)]
                keys = band_keys(signatures(hashes, at, n_bands * n_rows), n_bands, n_rows).view(np.int64)
                n = np.diff(at)
                full = np.flatnonzero(n > 0)
                bands = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.where(n > 0, n_bands, 0))], pa.int32()), pa.array(keys[full].reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(n), *(pa.array((s[at[1:]] - s[at[:-1]]).view(np.int64)) for s in sums), bands],
                    ["doc_id", "n_shingles", "f1", "f2", "bands"])

    return docs.select(id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_shingles long, f1 long, f2 long, bands array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach `percent` % similarity."""
    second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    both = pairs.select("a", "b").join(second, "b").join(first, "a").select("a", "b", "text_a", "text_b")

    @released
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = [[s for _, _, data, offsets in text_slices(batch.column(i)) for s in _split(*shingle_sets(data, offsets))] for i in (2, 3)]
                linked = []
                for x, y in zip(*sets, strict=True):
                    small, large = (x, y) if len(x) <= len(y) else (y, x)
                    place = np.searchsorted(large, small)
                    place[place == len(large)] = 0
                    common = int((large[place] == small).sum()) if len(small) else 0
                    linked.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
                keep = pa.array(linked, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    schema = f"a {both.schema['a'].dataType.simpleString()}, b {both.schema['b'].dataType.simpleString()}"
    return both.mapInArrow(run, schema).distinct()


def _split(hashes: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    return [hashes[s:e] for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of `docs` (columns doc_id and text)."""
    rows = staged(sketches(docs, percent=percent), "sketches")
    known = rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
    same = ["f1", "f2", "n_shingles"]
    sets = staged(known.groupBy(*same).agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands")), "sets")
    members = sets.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    centres = members.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("c"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = staged(members.join(centres, "bucket").select(
        "bucket", "node", "n", "size", F.col("c.node").alias("centre"), F.col("c.n").alias("centre_n")), "buckets")
    possible = f"100 * least(n, centre_n) >= {percent} * greatest(n, centre_n)"
    pairs = staged(shared.filter("node <> centre").filter(possible).select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    # later rounds only pair documents that share a bucket with two others at least
    wanted = shared.filter("size > 2").select("node").union(pairs.select("a")).union(pairs.select("b")).distinct()
    texts = staged(docs.select("doc_id", "text").join(wanted.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi"), "texts")
    links = staged(confirmed(pairs, texts, percent), "links")
    labels = staged(components(links), "components")
    shared = staged(_contested(shared, labels), "contested")
    contested = texts.join(shared.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    prefixes, own = rare_prefixes(contested, percent)
    shared = staged(shared.join(own, "node", "left").withColumn("rest", F.greatest(F.lit(0), F.col("n") - F.coalesce("own", F.lit(0)))).drop("own"), "contested")
    tested = pairs
    for find in (lambda: _stars(shared, labels, _plainest(shared, labels), percent), lambda: _between(prefixes, labels, percent)):
        fresh = staged(find().join(tested, ["a", "b"], "left_anti"), "pairs")
        more = staged(confirmed(fresh, texts, percent), "links")
        if not more.isEmpty():
            links = more.unionByName(labels.select(F.col("component").alias("a"), F.col("node").alias("b")))
            labels = staged(components(links), "components")
        tested = tested.unionByName(fresh)
    of_set = sets.select(*same, F.col("node")).join(labels, "node", "left").select(*same, F.coalesce("component", "node").alias("set_component"))
    # rows that share a doc_id may have different sets; the document's component is the smallest of theirs
    own = rows.join(of_set, same, "left")
    by_id = own.groupBy("doc_id").agg(F.min("set_component").alias("least"))
    return rows.join(by_id, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("least", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def rare_prefixes(texts: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """((node, n, shingle, place), (node, own)) of the contested texts (columns doc_id and text).

    The shingles of a text are ordered by how many contested texts have them, rarest first, ties by hash; `place` is a shingle's
    number in that order. Only the first n - ceil(percent % of n) + 1 are kept, and of these the ones that another text
    has: two sets that reach the similarity share one of them. `own` counts the shingles that no other text has (of documents with one text)."""
    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column(2)):
                hashes, at = shingle_sets(data, offsets)
                n = np.diff(at)
                of = np.repeat(np.arange(len(n)), n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row).take(pa.array(of)), batch.column(1).slice(row, end - row).take(pa.array(of)),
                     pa.array(n[of]), pa.array(hashes.view(np.int64))], ["node", "member", "n", "shingle"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    numbered = texts.select("doc_id", F.monotonically_increasing_id().alias("member"), "text")
    every = staged(numbered.mapInArrow(released(send), f"node {kind}, member long, n long, shingle long"), "contested-shingles")
    had = every.groupBy("shingle").agg(F.count(F.lit(1)).alias("had"))
    place = F.row_number().over(Window.partitionBy("member").orderBy("had", "shingle")) - 1
    ranked = staged(every.join(had, "shingle").withColumn("place", place).filter(
        F.expr(f"place <= n - ({percent} * n + 99) div 100")), "prefixes")
    own = every.join(had.filter("had = 1"), "shingle").groupBy("node", "member").agg(F.count(F.lit(1)).alias("own"))
    own = own.groupBy("node").agg(F.max("own").alias("own"), F.count(F.lit(1)).alias("k"))
    one_text = texts.groupBy(F.col("doc_id").alias("node")).agg(F.count(F.lit(1)).alias("texts")).filter("texts = 1")
    return ranked.filter("had > 1").select("node", "n", "shingle", "place"), own.join(one_text, "node").select("node", "own")


def _labelled(shared: DataFrame, labels: DataFrame) -> DataFrame:
    return shared.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _contested(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the buckets of three and more members that hold several components."""
    at = _labelled(shared.filter("size > 2"), labels)
    several = at.groupBy("bucket").agg(F.min("component").alias("l"), F.max("component").alias("m")).filter("l <> m").select("bucket")
    return at.join(several, "bucket").select("bucket", "node", "n", "centre")


def _plainest(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Of each contested bucket the member with the fewest shingles of its own: what edited copies were made from, if it is there."""
    best = F.min(F.struct((F.col("n") - F.col("rest")).alias("alone"), "node", "n", "rest", "component")).alias("b")
    return _labelled(shared, labels).groupBy("bucket").agg(best).select("bucket", "b.node", "b.n", "b.rest", "b.component")


def _between(prefixes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that share a shingle of their prefixes early enough: what stands after it in either
    order must still make up the common part that the similarity asks for."""
    at = _labelled(prefixes, labels).select("shingle", "node", "n", "place", "component")
    other = at.select("shingle", *[F.col(c).alias(f"o_{c}") for c in ("node", "n", "place", "component")])
    common = f"(({percent} * (n + o_n) + {99 + percent}) div {100 + percent})"
    early = f"n - place >= {common} AND o_n - o_place >= {common}"
    met = at.join(other, "shingle").filter(f"node < o_node AND component <> o_component AND 100 * least(n, o_n) >= {percent} * greatest(n, o_n) AND {early}")
    return met.select(F.col("node").alias("a"), F.col("o_node").alias("b")).distinct()


def _stars(shared: DataFrame, labels: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    """Pairs of the chosen centres with the members of other components (the first centre has met all)."""
    centres = chosen.select("bucket", F.col("node").alias("c"), F.col("n").alias("c_n"), F.col("rest").alias("c_rest"), F.col("component").alias("c_component"))
    met = _labelled(shared, labels).join(centres, "bucket").filter("component <> c_component AND node <> c AND node <> centre")
    met = met.filter(f"100 * least(rest, c_rest) >= {percent} * (n + c_n - least(rest, c_rest))")
    return met.select(F.least("c", "node").alias("a"), F.greatest("c", "node").alias("b")).distinct()


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` that are the smallest document of their group, as they are."""
    with passing(docs.sparkSession, "near-dedup"):
        gone = staged(near_duplicates(docs, percent).filter(~F.col("kept")).select("doc_id").distinct(), "near-copies", lasting=True)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


@register("op7_minhash_near_dedup")
def op7_minhash_near_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
