"""A stored star laid out in buckets of ``geo_id``: joins and groupings by place then need no exchange.

The fact and the places are written as tables bucketed (and sorted) by ``geo_id`` into the
same number of buckets, so Spark joins them bucket by bucket and groups by any keys that hold
``geo_id`` inside a bucket.  A bucket is read by one task, so a place holding more rows than
a bucket's share would make that task as long as the place is large.  Such places are
measured before writing (an aggregate of counts per place; there can be no more of them
than buckets) and their rows go to a table of their own without buckets, whose files are
split as usual; a query over the star is the union of the bucketed part, without exchange,
and of that part, aggregated partially before its small exchange and joined to its few
places by broadcast.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators import analytics
from tallymart.session import shared_folder
from tallymart.sources.sinks import remove_folder

#: Buckets of the stored star; at scale about the fact's bytes over 256 MB.
BUCKETS = 16


@dataclass(frozen=True)
class StoredStar:
    fact: str
    hot: str
    places: str
    hot_places: tuple


def _save(df: DataFrame, name: str, buckets: int | None) -> None:
    writer = df.write.option("path", shared_folder(df.sparkSession, name))
    if buckets:
        writer = writer.bucketBy(buckets, "geo_id").sortBy("geo_id")
    writer.saveAsTable(name)


def store(fact: DataFrame, places: DataFrame | Callable[[DataFrame], DataFrame], *, buckets: int = BUCKETS, name: str | None = None) -> StoredStar:
    """Write ``fact`` and ``places`` (one row per geo_id) as bucketed tables; hot places apart.

    The fact is worked out once, by a plain write; places are counted and the tables dealt out
    from that.  ``places`` may be a function of the written fact, for places that follow from it.
    A place is hot when it holds more than a bucket's share of the fact's rows (rows over
    ``buckets``); a null geo_id is a place like any other.
    """
    name = name or f"star_{uuid.uuid4().hex[:12]}"
    spark, plain = fact.sparkSession, shared_folder(fact.sparkSession, f"{name}_plain")
    fact.write.parquet(plain)
    fact = spark.read.schema(fact.schema).parquet(plain)
    if callable(places):
        places = places(fact)
    counts = fact.groupBy("geo_id").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = tuple(r.geo_id for r in counts.where(F.col("n") > total / buckets).collect())  # at most `buckets` rows
    is_hot = F.coalesce(F.col("geo_id").isin(*hot), F.lit(False)) if hot else F.lit(False)
    stored = StoredStar(f"{name}_fact", f"{name}_hot", f"{name}_places", hot)
    _save(fact.where(~is_hot), stored.fact, buckets)
    _save(fact.where(is_hot), stored.hot, None)
    _save(places, stored.places, buckets)
    remove_folder(spark, plain)
    return stored


def latest(spark: SparkSession, stored: StoredStar, keys: Sequence[str], values: Sequence[str], period: str = "period",
           place_columns: Sequence[str] = ()) -> DataFrame:
    """Newest values per group of ``keys`` (which hold geo_id), as ``analytics.latest_per_group``, with ``place_columns`` of the place.

    In the bucketed part both the grouping and the join with the places stay in their buckets.
    """
    if "geo_id" not in keys:
        raise ValueError("the keys must hold geo_id, the bucket column")
    places = spark.table(stored.places).select("geo_id", *place_columns)
    cold = analytics.latest_per_group(spark.table(stored.fact), keys, values, period=period)
    warm = analytics.latest_per_group(spark.table(stored.hot), keys, values, period=period)
    if place_columns:
        few = places.where(F.col("geo_id").isin(*stored.hot_places)) if stored.hot_places else places.limit(0)
        cold, warm = cold.join(places, "geo_id"), warm.join(F.broadcast(few), "geo_id")  # at most `buckets` hot places
    return cold.unionByName(warm)


def star(spark: SparkSession, stored: StoredStar) -> DataFrame:
    """Fact rows with their place's columns; places without rows are left out, as in ``mart.star``."""
    places = spark.table(stored.places)
    cold = spark.table(stored.fact).join(places, "geo_id")
    few = places.where(F.col("geo_id").isin(*stored.hot_places)) if stored.hot_places else places.limit(0)
    warm = spark.table(stored.hot).join(F.broadcast(few), "geo_id")  # at most `buckets` places
    return cold.unionByName(warm)
