"""Token ids as Parquet list columns, written in document order and read selectively.

Ids are dictionary-encoded (or delta-encoded, when a row group has too many distinct
ids for a dictionary), in row groups and pages of chosen size with page indexes.
Rows are range-partitioned by id, so a file holds a range of documents and the
statistics of row groups and pages lead to the few pages a range of ids needs.
Lengths are columns of their own: positions are computed without reading ids.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import part_offsets, text_key
from .tokens import encode_texts, text_groups

# Bytes of texts encoded together, and of the pieces remembered: larger than the usual
# ones, as nothing else is held beside them here.
GROUP_BYTES = 6 << 20
REMEMBERED_BYTES = 32 << 20
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 1 << 20


def encode_rows(path: str, end: int, spaced: bool):
    def run(batches):
        before = 0
        for batch in batches:
            for first, texts in text_groups(batch.column("text"), GROUP_BYTES):
                ids, bounds = encode_texts(texts, path, end, spaced, REMEMBERED_BYTES)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))
                sizes = np.diff(bounds)
                start = before + bounds[:-1]
                before += int(bounds[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        batch.column("part").slice(first, len(texts)),
                        pa.array(start),
                        pa.array(sizes),
                        lists,
                    ],
                    ["doc_id", "part", "part_start", "n_tokens", "ids"],
                )

    return run


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end: int,
    spaced: bool,
    row_group_bytes: int = ROW_GROUP_BYTES,
    page_bytes: int = PAGE_BYTES,
) -> None:
    """Write ``doc_id, part, part_start, n_tokens, ids`` in ascending order of ``doc_id``.

    ``part`` numbers the ranges in order and ``part_start`` counts the ids before the
    document in its range.  Null and empty texts have the end id only.  Documents
    with a null id come first; rows that repeat an id follow each other in any order.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    keys = ["doc_id", "_th", "_row"]
    ranged = (
        docs.select("doc_id", "text", text_key().alias("_th"), F.monotonically_increasing_id().alias("_row"))
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    coded = ranged.mapInArrow(
        encode_rows(tokenizer_path, end, spaced),
        f"doc_id {kind}, part int, part_start long, n_tokens long, ids array<int>",
    )
    (
        coded.write.option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.dictionary.page.size", page_bytes)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "true")
        .option("compression", "zstd")
        .parquet(folder)
    )


def read_positions(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, part, part_start, n_tokens, start``, without reading any ids."""
    return with_start(spark.read.parquet(folder).select("doc_id", "part", "part_start", "n_tokens"), spark, folder)


def with_start(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Add ``start``, the number of ids of all documents before."""
    totals = spark.read.parquet(folder).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = part_offsets(totals, "part", "n")
    return rows.join(F.broadcast(before), "part").withColumn("start", F.col("part_start") + F.col("_before")).drop("_before")


def read_tokens(spark: SparkSession, folder: str, low=None, high=None) -> DataFrame:
    """Documents with ``low <= doc_id < high`` and their ids; other pages are not read."""
    rows = spark.read.parquet(folder)
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") < high)
    return with_start(rows, spark, folder)


def checksums(batches):
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    for batch in batches:
        ids = batch.column("ids")
        flat = ids.flatten().to_numpy(zero_copy_only=False).astype("<i4", copy=False)
        bounds = ids.offsets.to_numpy() - ids.offsets[0].as_py()
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
        names = [n for n in batch.schema.names if n != "ids"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], pa.array(crc, pa.int64())], [*names, "ids_crc32"]
        )
