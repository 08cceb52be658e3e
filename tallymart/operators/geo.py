"""Places: resolving names, tagging levels, hierarchy lookups, the geography dimension.

Reference frames are caller-supplied and all-string on ids (leading zeros matter):
``provinces(name)``, ``metros(metro_uid, metro_code, name)``,
``members(district_uid, name, type, metro_code)`` and ``districts(district_uid, name, type)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions import normalize_name, strip
from tallymart.operators.spread import join_facts

LEVELS = ("Province", "CMA", "CSD")  # Fixed values: level labels, by precedence.


def with_resolved_place(df: DataFrame) -> DataFrame:
    """The lowest place a row is about: the sub-geography if given, else the geography asked for."""
    return df.withColumn("geo_name", F.coalesce("sub_geography", "geography"))


def district_label(name: Column, kind: Column) -> Column:
    return normalize_name(F.concat(name, F.lit(" ("), kind, F.lit(")")))


def _named(districts: DataFrame) -> DataFrame:
    """Districts with name and type; blank reference rows are left out."""
    return districts.where((strip(F.col("name")) != "") & (strip(F.col("type")) != ""))


def level_universe(provinces: DataFrame, metros: DataFrame, *districts: DataFrame) -> DataFrame:
    """Every known name with its level; a name on several levels takes the first and is flagged."""
    parts = [provinces.select(normalize_name(F.col("name")).alias("geo_name"), F.lit(0).alias("rank"))]
    parts.append(metros.select(normalize_name(F.col("name")).alias("geo_name"), F.lit(1).alias("rank")))
    for frame in districts:
        label = district_label(F.col("name"), F.col("type"))
        parts.append(_named(frame).select(label.alias("geo_name"), F.lit(2).alias("rank")))
    named = parts[0]
    for part in parts[1:]:
        named = named.unionByName(part)
    levels = F.array(*(F.lit(level) for level in LEVELS))
    return (
        named.groupBy("geo_name")
        .agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
        .select(
            "geo_name",
            F.get(levels, F.col("first")).alias("geo_level"),
            (F.col("first") != F.col("last")).alias("ambiguous"),
        )
    )


def district_parents(members: DataFrame, metros: DataFrame) -> DataFrame:
    """District label -> district uid, metro code, metro name, metro uid; misses give null."""
    named = _named(members).select(
        district_label(F.col("name"), F.col("type")).alias("geo_name"), "district_uid", "metro_code"
    )
    parents = metros.select("metro_code", normalize_name(F.col("name")).alias("cma"), F.col("metro_uid").alias("cma_uid"))
    return (
        named.groupBy("geo_name")
        .agg(F.max(F.struct("district_uid", "metro_code")).alias("m"))
        .select("geo_name", F.col("m.district_uid").alias("csduid"), F.col("m.metro_code").alias("metro_code"))
        .join(parents, "metro_code", "left")
    )


def geo_id(level: Column, name: Column, csduid: Column, cma_uid: Column, province_id: Column) -> Column:
    return (
        F.when(level == "Province", province_id)
        .when(level == "CMA", F.concat(F.lit("CMA:"), F.coalesce(cma_uid, name)))
        .when(level == "CSD", F.concat(F.lit("CSD:"), F.coalesce(csduid, name)))
        .otherwise(name)
    )


def member_metros(metros: DataFrame, members: DataFrame) -> DataFrame:
    """Metros that some member district belongs to: those of the province the members are of."""
    return metros.join(members.select("metro_code").distinct(), "metro_code", "left_semi")


def place_directory(provinces: DataFrame, metros: DataFrame, members: DataFrame, *districts: DataFrame,
                    province_id: Column) -> DataFrame:
    """One row per known place name: level, ids, parent metro, membership.

    Built from reference frames alone, so the fact meets it in a single join and
    is never scanned for its places first.  Only metros with a member district are known
    places (``metros`` may list the whole country); any metro can be a district's parent.
    """
    own_metros = member_metros(metros, members)
    universe = level_universe(provinces, own_metros, *districts, members)
    by_district = district_parents(members, metros).select(
        "geo_name", F.lit("CSD").alias("geo_level"), "csduid",
        F.col("cma").alias("parent_cma"), F.col("cma_uid").alias("parent_uid"), F.lit(True).alias("member"),
    )
    by_metro = (
        own_metros.groupBy(normalize_name(F.col("name")).alias("geo_name"))
        .agg(F.max("metro_uid").alias("own_uid"))
        .withColumn("geo_level", F.lit("CMA"))
    )
    full = (
        universe.join(by_district, ["geo_name", "geo_level"], "left")
        .join(by_metro, ["geo_name", "geo_level"], "left")
        .withColumn("cma", F.when(F.col("geo_level") == "CMA", F.col("geo_name")).otherwise(F.col("parent_cma")))
        .withColumn("cma_uid", F.coalesce("own_uid", "parent_uid"))
    )
    key = geo_id(F.col("geo_level"), F.col("geo_name"), F.col("csduid"), F.col("cma_uid"), province_id)
    return full.select(
        "geo_name", "geo_level", "ambiguous", key.alias("geo_id"), "cma", "csduid", "cma_uid",
        F.coalesce("member", F.lit(False)).alias("is_member"),
    )


def tag_level(df: DataFrame, directory: DataFrame) -> DataFrame:
    """Canonical ``geo_name`` with level and id; rows of unknown places are dropped."""
    known = directory.select("geo_name", "geo_level", "geo_id")
    return join_facts(df.withColumn("geo_name", normalize_name(F.col("geo_name"))), known, ["geo_name"])


def geography_dimension(fact: DataFrame, directory: DataFrame, *, province: Column,
                        placeholders: bool = True) -> DataFrame:
    """Places of the fact, and member districts it has nothing on (``has_data`` false)."""
    seen = fact.select("geo_id").distinct().withColumn("seen", F.lit(True))
    places = directory.join(seen, "geo_id", "left").withColumn("has_data", F.coalesce("seen", F.lit(False)))
    wanted = F.col("has_data") | (F.lit(placeholders) & F.col("is_member"))
    return places.where(wanted).select(
        "geo_id", "geo_name", "geo_level", province.alias("province"), "cma", "csduid", "cma_uid", "has_data"
    )


def attach_geo_id(fact: DataFrame, geographies: DataFrame) -> DataFrame:
    return fact.join(geographies.select("geo_name", "geo_level", "geo_id"), ["geo_name", "geo_level"], "left")


def name_to_uid(df: DataFrame, name: str, lookup: DataFrame) -> DataFrame:
    """Attach ``uid`` by name, either spelling; rows without a uid are dropped.

    ``lookup`` is (name, uid).  Names that map to several uids would multiply rows,
    so they are resolved to one before the join.
    """
    ids = (
        lookup.groupBy(normalize_name(F.col("name")).alias("_name"))
        .agg(F.max("uid").alias("uid"))
    )
    return df.join(ids, normalize_name(F.col(name)) == F.col("_name")).drop("_name")


def search_names(names: DataFrame, needle: str) -> DataFrame:
    """Exact hits of ``needle``, else case-insensitive substring hits, with their number.

    More than one hit marks an ambiguous search.
    """
    name = F.col("name")
    hits = (
        names.select("name").distinct()
        .where(F.contains(F.lower(name), F.lit(needle.lower())))
        .select(F.lit(needle).alias("query"), "name", F.when(name == needle, 0).otherwise(1).alias("rank"))
    )
    counts = hits.groupBy("query", "rank").agg(F.count(F.lit(1)).alias("n_hits"))
    best = counts.groupBy("query").agg(F.min(F.struct("rank", "n_hits")).alias("b"))
    best = best.select("query", "b.rank", "b.n_hits")
    return hits.join(best, ["query", "rank"])


def lookup_places(wanted: DataFrame, places: DataFrame) -> DataFrame:
    """Resolve (name) against (name, place_id, tier): the lowest tier wins, misses keep a null id."""
    best = places.groupBy("name").agg(F.min(F.struct("tier", "place_id")).alias("b"))
    return join_facts(wanted, best, ["name"], "left").select(
        *wanted.columns, F.col("b.place_id").alias("place_id"), F.col("b.tier").alias("tier")
    )


def all_places(country: DataFrame, provinces: DataFrame, metros: DataFrame) -> DataFrame:
    """(name, place_id, tier) of the country, every province and every metro: what ``lookup_places`` looks up in.

    Each frame is (name, place_id).  A name of several tiers is listed once for each.
    """
    tiers = [df.select("name", "place_id", F.lit(tier).alias("tier")) for tier, df in enumerate((country, provinces, metros))]
    return tiers[0].unionByName(tiers[1]).unionByName(tiers[2])


def choropleth(features: DataFrame, latest: DataFrame, key: str) -> DataFrame:
    """Every boundary feature with the value to colour it by; features without one stay."""
    return features.join(latest, key, "left")


def with_band_order(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """1-based display position by a fixed list; unlisted bands come last."""
    listed = F.array(*(F.lit(band) for band in order))
    at = F.array_position(listed, F.col(column))
    return df.withColumn("band_order", F.when(at > 0, at).otherwise(F.lit(len(order) + 1)).cast("int"))
