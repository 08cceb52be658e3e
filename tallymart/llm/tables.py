"""Stored intermediates on shared storage, and Arrow batches cut by bytes."""

from __future__ import annotations

import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text of so many bytes is worked on at once inside a task (one longer text is its own block).
BLOCK_BYTES = 1 << 20

#: Bits of a filter: so many a key, up to the second figure (8 MB).
FILTER_BITS, FILTER_MOST = 32, 1 << 26


#: Share of its largest size from which on the driver's heap is cleared between steps.
HEAP_SHARE = 0.45


#: Folder of a local session that names none, by application.
_LOCAL: dict[str, str] = {}


class Scratch:
    """Tables written once and read again, in the folder that ``spark.checkpoint.dir`` names.

    A written table cuts lineage (a lost executor costs no recomputation of what lies
    before it) and gives both sides of a later join a fresh exchange, which AQE can split
    when one key is hot.  ``drop`` frees a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
            base = _LOCAL.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="run-")
            _LOCAL[spark.sparkContext.applicationId] = base
        self.spark = spark
        self.root = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it back; the shuffles of this one write are freed when it ends."""
        cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(cleanup, "false")
        self.spark.conf.set(cleanup, "true")
        try:
            df.write.parquet(self.path(name))
        finally:
            self.spark.conf.set(cleanup, before)
        relieve(self.spark)
        return self.get(name, df)

    def get(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            at = jvm.org.apache.hadoop.fs.Path(self.path(name))
            at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def ship(spark: SparkSession) -> None:
    """Ready a session: Arrow batches bounded in rows and bytes, and this package sent to the executors.

    Sending is for Python workers that cannot import it by path, and happens once a session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    sent = f"{spark.sparkContext.applicationId}.package"
    if not any(sent in f for f in spark.sparkContext._python_includes):
        root = Path(__file__).resolve().parents[2]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='run-')}/{sent}", "zip", root, "tallymart")
        spark.sparkContext.addPyFile(archive)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner free what a written stage no longer needs (its broadcast models and filters, its shuffles).

    The cleaner acts on objects the JVM has collected, and the JVM holds them while Python
    does; so Python's collector runs first, then the JVM's.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def relieve(spark: SparkSession) -> None:
    """``release`` once the driver's heap has grown past HEAP_SHARE of what it may take.

    A step of many small jobs leaves plans, broadcasts and events behind that the JVM would
    rather grow for than collect, and it gives grown memory back at a full collection only.
    """
    runtime = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() > HEAP_SHARE * runtime.maxMemory():
        release(spark)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def crc_of_id(column: str) -> Column:
    """crc32 of an id's decimal text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


class Bits:
    """A filter of fixed size over keys: never wrong about a key that is in it."""

    def __init__(self, spark: SparkSession, keys: DataFrame, column: str, count: int, hashed: bool = False):
        """``hashed``: the column is a hash already, such as a crc32 that tasks can work out too."""
        bits = 1 << 16
        while bits < min(count * FILTER_BITS, FILTER_MOST):
            bits <<= 1
        at = keys.select(F.pmod(F.col(column) if hashed else F.xxhash64(column), F.lit(bits)).alias("at"))
        found = at.groupBy(F.expr("at div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(pmod(at, 64) as int)))").alias("mask")).toArrow()
        words = np.zeros(bits // 64, np.int64)
        words[found["word"].to_numpy()] = found["mask"].to_numpy()
        self.bits, self.words = bits, spark.sparkContext.broadcast(words)

    def place(self, column: str) -> Column:
        """Where a key's bit is; Spark works out the hash, ``hit`` looks it up in Arrow batches."""
        return F.pmod(F.xxhash64(column), F.lit(self.bits))

    @staticmethod
    def hit(words: np.ndarray, places: pa.Array) -> pa.Array:
        at = places.to_numpy()
        return pa.array(((words[at >> 6] >> (at & 63)) & 1).astype(bool))


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        part = np.cumsum(sizes) // most
        cuts = np.flatnonzero(np.diff(part)) + 1
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(start), int(end - start))


def strings_of(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)


def list_array(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A list column from flat values and the end of each row."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values))
