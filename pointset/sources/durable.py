"""Caching policy, lineage cuts and size-checked small tables."""

from __future__ import annotations

import threading
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CACHE_MODES = ("none", "persist", "unpersist")

# Largest table that may be brought to the driver and shipped to every task.
SMALL_ROWS = 50_000
SMALL_BYTES = 128 << 20

# Rows of one key from which a join with a large lookup table splits it.
HOT_ROWS = 1_000_000
SALTED_ROWS = 250_000

_scopes = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """Folder for written tables: the one the cluster names for checkpoints."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    # A local session without the setting gets one folder for all its tables.
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="pointset-")
    return _local_folders[context.applicationId]


_local_folders: dict[str, str] = {}


class Lifetime:
    """Owns frames kept on the executors and tables written to the shared folder.

    What is kept or written while a lifetime is active belongs to it and goes when it
    is closed.  A lifetime made while another is active ends with that one at the latest.
    """

    def __init__(self):
        self._owned: list = []
        outer = getattr(_scopes, "lifetime", None)
        if outer is not None:
            outer.own(self.close)

    def own(self, release) -> None:
        self._owned.append(release)

    def close(self) -> None:
        while self._owned:
            self._owned.pop()()

    @contextmanager
    def active(self):
        outer = getattr(_scopes, "lifetime", None)
        _scopes.lifetime = self
        try:
            yield self
        finally:
            _scopes.lifetime = outer


def owned(release) -> None:
    """Hand a release over to the active lifetime, if there is one."""
    lifetime = getattr(_scopes, "lifetime", None)
    if lifetime is not None:
        lifetime.own(release)


@contextmanager
def table_scope():
    """Release, at the end, every intermediate table written and frame kept inside.

    What was computed inside has to be consumed (or written elsewhere) by then.
    """
    lifetime = Lifetime()
    try:
        with lifetime.active():
            yield
    finally:
        lifetime.close()


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/pointset/{name}-{uuid.uuid4().hex}"
    owned(lambda: _delete(spark, path))
    return path


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: what follows survives lost executors without
    repeating what came before.  Column metadata is kept.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize`` and what the write itself measured: aggregates by name.

    The numbers come from the tasks that write, so they cost no job of their own.
    """
    seen = Observation()
    table = materialize(df.observe(seen, *[value.alias(key) for key, value in metrics.items()]), name)
    found = seen.get
    return table, {key: found.get(key) for key in metrics}


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def discard(df: DataFrame) -> None:
    """Delete the files of a superseded ``materialize`` result."""
    spark = df.sparkSession
    owned = f"{shared_folder(spark).rstrip('/')}/pointset/"
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        if owned.split(":", 1)[-1].lstrip("/") in folder:
            _delete(spark, folder)


class Cache:
    """What to do with intermediate tables that are read more than once.

    ``none`` recomputes them and needs no storage.  ``unpersist`` keeps the latest
    generation: about one copy of ids and vectors on the executors, and at times one
    in the shared folder.  ``persist`` keeps every generation, until the lifetime it was
    kept in is closed.
    """

    def __init__(self, mode: str = "none"):
        if mode not in CACHE_MODES:
            raise ValueError(f"cache must be one of {CACHE_MODES}, not {mode!r}")
        self.mode = mode

    @property
    def keeps(self) -> bool:
        return self.mode != "none"

    def hold(self, df: DataFrame) -> DataFrame:
        if not self.keeps:
            return df
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        owned(kept.unpersist)
        return kept

    def release(self, df: DataFrame) -> None:
        if self.mode == "unpersist":
            df.unpersist()

    def hold_once(self, source: DataFrame, df: DataFrame) -> DataFrame:
        """Keep ``df``, which selects from ``source``, unless ``source`` is kept already."""
        return df if is_kept(source) else self.hold(df)

    def release_once(self, source: DataFrame, df: DataFrame) -> None:
        if not is_kept(source):
            self.release(df)


def is_kept(df: DataFrame) -> bool:
    level = df.storageLevel
    return level.useMemory or level.useDisk


def fetch_small(df: DataFrame) -> pa.Table | None:
    """The table as Arrow data if it is within the bounds, else ``None``.

    The width of a row is known before any is fetched, from the length recorded with
    its vectors or else from one row.  A limit then stops reading at the first row
    beyond the bounds, so a larger table reaches neither the driver nor a single task.
    """
    schema = to_arrow_schema(df.schema)
    per_row = _row_bytes(df)
    if per_row is None:
        first = df.limit(1).collect()
        if not first:
            return schema.empty_table()
        per_row = pa.Table.from_pylist([r.asDict(recursive=True) for r in first], schema=schema).nbytes
    most = min(SMALL_ROWS, int(SMALL_BYTES / max(1, per_row)))
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        return None
    table = pa.Table.from_pylist([row.asDict(recursive=True) for row in rows], schema=schema)
    return table if is_small(table.num_rows, table.nbytes) else None


def _row_bytes(df: DataFrame) -> int | None:
    """Bytes of a row, texts taken as 64; ``None`` if a vector's length is not recorded."""
    total = 0
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            if "dim" not in field.metadata:
                return None
            total += 8 * int(field.metadata["dim"])
        else:
            total += 64 if isinstance(field.dataType, (T.StringType, T.BinaryType, T.StructType)) else 8
    return total


def is_small(rows: float, size: float) -> bool:
    return rows <= SMALL_ROWS and size <= SMALL_BYTES


def local_table(spark: SparkSession, table: pa.Table, schema) -> DataFrame:
    return spark.createDataFrame(table, schema=schema)


def lookup_join(big: DataFrame, small: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows to a lookup table with one row per ``key``.

    A lookup table within the bounds is broadcast.  A larger one is joined by a
    shuffle, in which only keys found hot are split: such a key gets a part of its
    own for every ``SALTED_ROWS`` of its rows, and only its lookup row is copied.
    """
    spark = big.sparkSession
    table = fetch_small(small)
    if table is not None:
        return big.join(F.broadcast(local_table(spark, table, small.schema)), key, how)
    counts = big.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n") > HOT_ROWS)
    # At most rows / HOT_ROWS keys are hot: some ten thousand among 10^10 rows.
    hot = {row[0]: -(-row["_n"] // SALTED_ROWS) for row in counts.collect() if row[0] is not None}
    if not hot:
        return big.join(small, key, how)
    parts = spark.createDataFrame(list(hot.items()), [key, "_parts"]).withColumn(key, F.col(key).cast(small.schema[key].dataType))
    others = [F.col(name) for name in big.columns]
    salted = big.join(F.broadcast(parts), key, "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(*others), F.col("_parts")), F.lit(0)).cast("int")
    ).drop("_parts")
    copies = small.join(F.broadcast(parts), key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), (F.coalesce("_parts", F.lit(1)) - 1).cast("int")))
    ).drop("_parts")
    return salted.join(copies, [key, "_salt"], how).drop("_salt")
