"""The star stored in buckets of geo_id: no exchange in the bucketed part, hot places apart, equal results."""

from pyspark.sql import functions as F

from tallymart.operators import analytics
from tallymart.sources import bucketed


def fact_and_places(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 97 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), (F.col("id") % 53).cast("string"))).alias("geo_id"),
        (F.col("id") % 3).alias("metric_id"), F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("period"),
        (F.col("id") * 1.5).alias("value"))
    places = rows.select("geo_id").distinct().where("geo_id is not null").withColumn("geo_name", F.upper("geo_id"))
    return rows, places


def key(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_latest_and_star_equal_plain_ones(spark):
    fact, places = fact_and_places(spark)
    stored = bucketed.store(fact, places, buckets=8)
    assert stored.hot_places == ("hot",)
    assert spark.table(stored.hot).count() == 2800 and spark.table(stored.fact).count() == 1200
    keys = ["geo_id", "metric_id"]
    assert key(bucketed.latest(spark, stored, keys, ["value"])) == key(analytics.latest_per_group(fact, keys, ["value"]))
    assert key(bucketed.latest(spark, stored, keys, ["value"], place_columns=["geo_name"])) == key(analytics.latest_per_group(fact, keys, ["value"]).join(places, "geo_id"))
    assert key(bucketed.star(spark, stored)) == key(fact.join(places, "geo_id"))


def test_bucketed_part_needs_no_exchange(spark):
    fact, places = fact_and_places(spark)
    stored = bucketed.store(fact, places, buckets=8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        grouped = analytics.latest_per_group(spark.table(stored.fact), ["geo_id", "metric_id"], ["value"]).join(spark.table(stored.places), "geo_id")
        plan = grouped._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_no_hot_place_and_empty(spark):
    fact, places = fact_and_places(spark)
    cool = fact.where("geo_id <> 'hot'")
    stored = bucketed.store(cool, places, buckets=8)
    assert stored.hot_places == ()
    assert key(bucketed.latest(spark, stored, ["geo_id", "metric_id"], ["value"])) == key(analytics.latest_per_group(cool, ["geo_id", "metric_id"], ["value"]))
    none = bucketed.store(fact.limit(0), places.limit(0))
    assert bucketed.star(spark, none).count() == 0


def test_fact_is_worked_out_once(spark):
    fact, places = fact_and_places(spark)
    worked = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            worked.add(len(batch))
            yield batch

    stored = bucketed.store(fact.mapInPandas(counted, fact.schema), lambda f: f.select("geo_id").distinct().withColumn("geo_name", F.upper("geo_id")), buckets=8)
    assert worked.value == 4000
    assert key(bucketed.star(spark, stored)) == key(fact.join(places, "geo_id"))
