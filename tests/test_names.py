"""Tolerant name matching by deletion neighbourhoods, against a plain edit distance over all pairs."""

import random

from pyspark.sql import functions as F

from tallymart.operators import names


def edit_distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def allowed(n):
    return 2 if n >= names.TWO_EDITS_FROM else 1 if n >= names.ONE_EDIT_FROM else 0


def brute(queries, lookup):
    out = {}
    for q in {x.strip().lower() for x in queries if x is not None and x.strip()}:
        near = [(edit_distance(q, n.lower()), u) for n, u in lookup if edit_distance(q, n.lower()) <= min(allowed(len(q)), allowed(len(n)))]
        if not near:
            out[q] = (None, None, 0)
            continue
        d = min(x for x, _ in near)
        uids = {u for x, u in near if x == d}
        out[q] = (min(uids) if len(uids) == 1 else None, d, len(uids))
    return out


def test_equal_to_all_pairs(spark):
    rng = random.Random(8)
    base = ["ottawa", "toronto", "guelph", "montreal", "halifax", "regina", "london", "hull", "st. john's", "saint john", "ab", "abcd", "abce"]
    base += ["".join(rng.choice("abcde") for _ in range(rng.randrange(2, 12))) for _ in range(60)]
    lookup = [(w, i) for i, w in enumerate(base)] + [("ottawa", 99), ("Toronto", 1)]
    queries = base + ["ottowa", "torontoo", "gelph", "hallifax", "zzz", " Toronto ", "lond", "saint jon", "", None]
    queries += ["".join(rng.choice("abcde") for _ in range(rng.randrange(2, 12))) for _ in range(60)]
    got = names.tolerant_uids(spark.createDataFrame([(q,) for q in queries], "q string"), "q", spark.createDataFrame(lookup, "name string, uid long"))
    found = {r.query: (r.uid, r.distance, r.n_best) for r in got.collect()}
    assert found == brute(queries, lookup)
    assert found["ottawa"] == (None, 0, 2) and found["ottowa"][1] == 1  # same name, two uids: ambiguous
    assert {r.ambiguous for r in got.collect()} == {True, False}


def test_neighbourhood_sizes(spark):
    row = spark.createDataFrame([("abcdefgh",)], "w string").select(names.neighbourhood(F.col("w"), names.edits_allowed(F.length("w"))).alias("n")).first()
    assert len(row.n) == 1 + 8 + 28 and "cdefgh" in row.n and "abcdefgh" in row.n


def test_many_needles_equal_contains_on_all_pairs(spark):
    rng = random.Random(4)
    hay = ["".join(rng.choice("abcAB ") for _ in range(rng.randrange(0, 14))) for _ in range(150)] + ["Ottawa", "ottawa", None]
    needles = ["".join(rng.choice("abcAB ") for _ in range(rng.randrange(0, 5))) for _ in range(80)] + ["OTTAWA", "t", "", None]
    got = names.search_many(spark.createDataFrame([(h,) for h in hay], "name string"), spark.createDataFrame([(n,) for n in needles], "needle string"))
    want = {(n, h, 0 if h.lower() == n.lower() else 1) for n in needles if n for h in hay if h is not None and n.lower() in h.lower()}
    assert {tuple(r) for r in got.collect()} == want
    assert any(len(n) < 3 for n, _, _ in want)


def test_neighbourhoods_are_never_broadcast_and_running_numbers_stay_apart(spark):
    """Catalyst sizes an expanded side as the few names it comes from, far below the threshold of a broadcast."""
    known = spark.range(3000).select(F.concat(F.lit("Supplier#"), F.lpad(F.col("id").cast("string"), 9, "0")).alias("name"), F.col("id").alias("uid"))
    asked = known.select(F.when(F.col("uid") % 2 == 0, F.regexp_replace("name", "pp", "p")).otherwise(F.col("name")).alias("q"))
    got = names.tolerant_uids(asked, "q", known)
    assert "BroadcastHashJoin [key" not in got._jdf.queryExecution().executedPlan().toString()
    rows = got.collect()
    assert len(rows) == 3000 and all(r.uid == int(r.query.split("#")[1]) and r.distance == (r.uid % 2 == 0) and r.n_best == 1 for r in rows)
