"""Rows of a hot group stay spread when they meet facts about their group."""

import pytest
from pyspark.sql import functions as F

from tallymart.operators import analytics, geo, reshape
from tallymart.operators.spread import join_facts

ROWS = 40_000


@pytest.fixture
def hot(spark):
    """Four fifths of the rows in one group; no broadcast, no coalescing."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    group = F.when(F.col("id") % 5 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 997).cast("string")))
    yield spark.range(ROWS).select(group.alias("g"), F.col("id").cast("string").alias("i"))
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_share(df):
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_join_facts(hot):
    facts = hot.groupBy("g").agg(F.count("*").alias("n"))
    plain = hot.join(facts, "g")
    spread = join_facts(hot, facts, ["g"])
    assert largest_share(plain) > 0.75 and largest_share(spread) < 0.3
    assert spread.columns == plain.columns
    assert sorted(spread.select("i", "n").collect()) == sorted(plain.select("i", "n").collect())


def test_operators_on_a_hot_group(hot):
    assert largest_share(reshape.drop_summary_rows(hot, ["g"], "i")) < 0.3
    assert largest_share(analytics.members_by_value(hot, ["g"], "i")) < 0.3
    places = hot.select(F.col("g").alias("name")).distinct().select("name", F.lit("p").alias("place_id"), F.lit(1).alias("tier"))
    assert largest_share(geo.lookup_places(hot.select(F.col("g").alias("name"), "i"), places)) < 0.3
    directory = places.select(F.col("name").alias("geo_name"), F.lit("CMA").alias("geo_level"), F.col("place_id").alias("geo_id"))
    assert largest_share(geo.tag_level(hot.select(F.col("g").alias("geo_name"), "i"), directory)) < 0.3
