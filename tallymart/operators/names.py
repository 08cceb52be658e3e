"""Names matched to ids while tolerating a few typing errors, by deletion neighbourhoods.

Two spellings within edit distance ``d`` share a string that each reaches by at most ``d``
deletions.  So names are expanded into deletion neighbourhoods (a name and every string with
up to ``k`` characters removed), the two sides meet by an equi-join on those strings, and
each candidate pair is verified by its exact edit distance.  Distances are tried in turn: a
query found at distance 0 is not expanded, one found at 1 not by two deletions, so the many
names two edits from each other (running numbers, say) are paired only for queries that
nothing nearer answers.  No pair of names is formed that does not share a neighbour; a very
common neighbour is a skewed join key, which AQE splits.

A query takes the uid of the nearest name; when several uids are equally near it is
``ambiguous`` and gets none, as does a query with no name in reach.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.text import normalize_name

#: Edits tolerated by the length of the shorter spelling: none under 4 characters, one under 8, else two.
ONE_EDIT_FROM, TWO_EDITS_FROM = 4, 8
MOST_EDITS = 2


def canonical(col: Column) -> Column:
    """Spelling that is compared: hyphenated compounds, lower case, no outer blanks."""
    return F.lower(F.trim(normalize_name(col)))


def edits_allowed(length: Column) -> Column:
    return F.when(length >= TWO_EDITS_FROM, 2).when(length >= ONE_EDIT_FROM, 1).otherwise(0)


def neighbourhood(word: Column, k: Column) -> Column:
    """``word`` and every string made from it by removing up to ``k`` (0 to 2) characters."""
    n = F.length(word)
    one = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(word.substr(F.lit(1), i - 1), word.substr(i + 1, n)))
    two = F.flatten(F.transform(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        lambda i: F.transform(F.sequence(i + 1, F.greatest(n, i + 1)),
                              lambda j: F.concat(word.substr(F.lit(1), i - 1), word.substr(i + 1, j - i - 1), word.substr(j + 1, n))),
    ))
    return F.array_distinct(
        F.when(k >= 2, F.concat(F.array(word), one, two)).when(k >= 1, F.concat(F.array(word), one)).otherwise(F.array(word))
    )


def _at_distance(asked: DataFrame, known: DataFrame, d: int) -> DataFrame:
    """query, distance, n_best, uid: the uids at distance ``d`` of queries that have none nearer."""

    def side(df: DataFrame, name: str) -> DataFrame:
        able = df.where(edits_allowed(F.length(name)) >= d)
        return able.select("*", F.explode(neighbourhood(F.col(name), F.lit(d))).alias("key")) if d else able.withColumn("key", F.col(name))

    # Expanded sides are sized as the names they come from, far too small; so they are merged, never broadcast.
    pairs = side(asked, "query").join(side(known, "known").hint("merge"), "key")
    if d:
        pairs = pairs.where(F.levenshtein("query", "known", d) >= 0)
    return pairs.groupBy("query").agg(F.lit(d).alias("distance"), F.count_distinct("uid").alias("n_best"), F.min("uid").alias("uid"))


def tolerant_uids(queries: DataFrame, name: str, lookup: DataFrame) -> DataFrame:
    """Per distinct canonical query name: query (canonical), uid, distance, n_best (uids at that distance), ambiguous.

    ``lookup`` is (name, uid).  A null or blank query matches nothing.
    """
    asked = queries.select(canonical(F.col(name)).alias("query")).where(F.col("query").isNotNull() & (F.col("query") != "")).distinct()
    known = lookup.select(canonical(F.col("name")).alias("known"), "uid").where(F.col("known").isNotNull()).distinct()
    found, left = None, asked
    for d in range(MOST_EDITS + 1):
        level = _at_distance(left, known, d)
        found = level if found is None else found.unionByName(level)
        if d < MOST_EDITS:
            left = left.join(level, "query", "left_anti")
    found = found.select("query", F.when(F.col("n_best") == 1, F.col("uid")).alias("uid"), "distance", "n_best", (F.col("n_best") > 1).alias("ambiguous"))
    return asked.join(found, "query", "left").select(
        "query", "uid", "distance", F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("ambiguous", F.lit(False)).alias("ambiguous"))


#: Letters of the grams of the substring index; shorter needles use grams of their own length.
GRAM = 3


def _grams(text: Column, size: Column) -> Column:
    """Distinct substrings of ``size`` letters of ``text`` (none if it is shorter)."""
    n = F.length(text)
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))), lambda i: text.substr(i, size)))


def search_many(names: DataFrame, needles: DataFrame) -> DataFrame:
    """Every (needle, name) where the name holds the needle, case aside: needle, name, rank (0: equal, 1: inside).

    Names are indexed by their distinct grams of 1 to GRAM letters; a needle meets the
    postings of its rarest gram of min(GRAM, its length) letters only, and each candidate is
    verified by ``contains``.  Equal to testing every pair, without forming them.  A null or
    empty needle matches nothing.
    """
    named = names.select(F.col("name")).where(F.col("name").isNotNull()).distinct().withColumn("low", F.lower("name"))
    postings = named.select("name", "low", F.explode(F.flatten(F.array(*[_grams(F.col("low"), F.lit(s)) for s in range(1, GRAM + 1)]))).alias("gram"))
    frequency = postings.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    asked = needles.select(F.col("needle")).where(F.length("needle") > 0).distinct().withColumn("want", F.lower("needle"))
    grams = asked.select("needle", "want", F.explode(_grams(F.col("want"), F.least(F.length("want"), F.lit(GRAM)))).alias("gram"))
    rarest = grams.join(frequency, "gram").groupBy("needle", "want").agg(F.min(F.struct("df", "gram"))["gram"].alias("gram"))
    found = rarest.join(postings, "gram").where(F.contains("low", "want"))
    return found.select("needle", "name", F.when(F.col("low") == F.col("want"), 0).otherwise(1).alias("rank"))
