"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Joins carry no broadcast hints anywhere in this package: Catalyst (static sizes)
# and AQE (measured sizes) pick broadcast only under the size threshold, and fall
# back to a sort-merge join whose skewed partitions AQE splits.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Call-site capture costs several JVM round trips per expression.
    "spark.sql.dataFrameQueryContext.enabled": "false",
}


def build_session(app: str = "tallymart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path for a written table, under the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting may use a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tallymart-")
    return f"{base.rstrip('/')}/tallymart/{purpose}-{uuid.uuid4().hex}"


def local_frame(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Fixed rows as a local relation: its size is known to Catalyst and it needs no Python worker."""
    fields = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows)) or [()] * len(fields)

    def plain(value):
        return list(value.items()) if isinstance(value, dict) else value

    arrays = [pa.array([plain(v) for v in column], type=f.type) for column, f in zip(columns, fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields))


_FROZEN: WeakKeyDictionary[SparkSession, dict[str, DataFrame]] = WeakKeyDictionary()


def frozen(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A frame built from this package's constants (never from data), worked out once per session into local rows."""
    kept = _FROZEN.setdefault(spark, {})
    if name not in kept:
        kept[name] = _freeze(build())
    return kept[name]


def _freeze(df: DataFrame) -> DataFrame:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return local_frame(df.sparkSession, [tuple(r) for r in df.collect()], ddl)
