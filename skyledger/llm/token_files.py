"""Token-id files in ORC (operator 13).

`write_token_files` deals documents to files by ranges of their id, encodes each file's documents in
ascending order and writes them as ORC: integer run-length encoding for the ids, stripes that readers
take in parallel, an index every `INDEX_ROWS` rows and Bloom filters on the document id. A row holds
its document, the file's number (`part`), the ids of the file before it (`part_start`), `n_tokens` and `ids`.
`part_starts` is the small table of where files begin, from the footers' narrow columns alone, so that
`start`, the place in the whole stream of ids, needs neither a window nor a second pass over the ids.
`token_rows` reads whole files; `documents_of` and `ids_between` push their predicates into the reader,
which skips files, stripes and row groups by statistics and Bloom filters.

Texts are dealt before they are encoded, so each is encoded once; the dealing keys are the id, a hash of the text
and the input's partition, so that rows of one id don't meet in one task.

Defined results: a null text is empty (the end id alone); a null id comes first; rows of one id stand beside each other
in the order of a hash of their texts; repeated rows are encoded as often as they occur; strings of added
tokens are these tokens; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.llm.common import register, table
from skyledger.llm.kernels import text_slices
from skyledger.llm.token_ids import encoder, tokenizer_path
from skyledger.session import scratch_dir

END_ID = 0
STRIPE_BYTES, INDEX_ROWS, FALSE_POSITIVES = 64 << 20, 1000, 0.01
_SLICE = 4 << 20


def file_schema(id_type: str) -> str:
    return f"doc_id {id_type}, part int, part_start long, n_tokens long, ids array<int>"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
                      stripe_bytes: int = STRIPE_BYTES, index_rows: int = INDEX_ROWS) -> None:
    """Write all documents' ids, each document's followed by `end_id`, in ascending order of their ids."""
    schema = file_schema(docs.schema[id_col].dataType.simpleString())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, written = encoder(tokenizer).encode, TaskContext.get().partitionId(), 0
        for batch in batches:
            for row, end, data, offsets in text_slices(batch.column(1), _SLICE):
                ids, begins = encode(data, offsets)
                closed = np.insert(ids, begins[1:], end_id).astype(np.int32)
                begins = begins + np.arange(len(begins))             # every document before has its end id by now
                counts = np.diff(begins)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(np.full(end - row, part, np.int32)), pa.array(written + begins[:-1]),
                     pa.array(counts), pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(closed))],
                    ["doc_id", "part", "part_start", "n_tokens", "ids"])
                written += len(closed)

    keyed = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("__text"), F.spark_partition_id().alias("__from"))
    dealt = keyed.repartitionByRange(F.asc_nulls_first("doc_id"), "__text", "__from").sortWithinPartitions(F.asc_nulls_first("doc_id"), "__text")
    (dealt.select("doc_id", "text").mapInArrow(run, schema).write
     .option("orc.stripe.size", stripe_bytes).option("orc.row.index.stride", index_rows)
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", FALSE_POSITIVES).orc(path))


def token_rows(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """The rows of the files, with `start`: the ids of all documents before."""
    files = spark.read.schema(file_schema(id_type)).orc(path)
    return files.join(part_starts(files), "part").withColumn("start", F.col("file_start") + F.col("part_start")).drop("file_start")


def part_starts(files: DataFrame) -> DataFrame:
    """(part, start of its first id): one row per file, from the two narrow columns."""
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select("part", F.coalesce(before, F.lit(0)).cast("long").alias("file_start"))


def documents_of(spark: SparkSession, path: str, ids: list, id_type: str = "bigint") -> DataFrame:
    """The rows of some documents; the reader prunes by the index and the Bloom filters."""
    return spark.read.schema(file_schema(id_type)).orc(path).filter(F.col("doc_id").isin(ids)).select("doc_id", "n_tokens", "ids")


def ids_between(spark: SparkSession, path: str, first: int, end: int, id_type: str = "bigint") -> DataFrame:
    """(position, ids): the whole stream's ids from `first` up to `end`, in rows; files and row groups outside are not read."""
    files = spark.read.schema(file_schema(id_type)).orc(path)
    starts = [(r.part, r.file_start) for r in part_starts(files).orderBy("part").collect()]        # one row per file
    inside = F.lit(False)
    for (part, start), (_, after) in zip(starts, [*starts[1:], (None, None)]):
        if start < end and (after is None or after > first):
            inside = inside | ((F.col("part") == part) & (F.col("part_start") < end - start) & (F.col("part_start") + F.col("n_tokens") > first - start))
    rows = files.filter(inside).join(part_starts(files), "part").withColumn("start", F.col("file_start") + F.col("part_start"))
    skip = F.greatest(F.lit(first) - F.col("start"), F.lit(0))
    stop = F.least(F.lit(end) - F.col("start"), F.col("n_tokens"))
    return rows.select((F.col("start") + skip).alias("position"), F.slice("ids", (skip + 1).cast("int"), (stop - skip).cast("int")).alias("ids"))


def with_crc(rows: DataFrame) -> DataFrame:
    """(doc_id, part, part_start, n_tokens, ids_crc32) counted from the ids that were read."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            at = lists.offsets.to_numpy()
            ids = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())], ["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "part", "part_start", "ids").mapInArrow(run, f"doc_id {kind}, part int, part_start long, n_tokens long, ids_crc32 long")


@register("op13_token_id_files")
def op13_token_id_files(spark, sf_dir):
    path = scratch_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path())
    files = spark.read.schema(file_schema("bigint")).orc(path)
    return with_crc(files).join(part_starts(files), "part").select(
        "doc_id", (F.col("file_start") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")
