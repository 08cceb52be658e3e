"""How five document filters interact: survivors of every subset, per part and label, from truth-table words.

Each document fails some of the filters A to E; its failures are a 5-bit code ``f``.  Its
survival word has 32 bits, bit ``S`` set when it passes every filter of subset ``S``
(``f & S == 0``).  Per (part, good, toxic) the survivors of each subset are the positional
popcounts of these words, counted bit-parallel with carry-save adders inside each task (three
words of one weight become one of that weight and one of the next); Spark sums the counts of
all tasks with a partial aggregation, so a hot part is summed where it lies.

From survivors ``N(S)`` of a part every figure of every order follows without another look at
the documents: after steps with set ``P`` so far, ``kept = N(P)``; its filter ``X`` removes
``N(P) - N(P | X)``; documents failing ``X`` that earlier steps removed are
``(N(0) - N(X)) - (N(P) - N(P | X))``; documents failing ``X`` alone are
``N(all - X) - N(all)``; and the Shapley-like sum adds what ``X`` removes over all 120 orders.

Filter E (a text identical to that of a smaller doc_id) needs the least doc_id of every text:
texts are compared by SHA-256 (taken as equality), the least id per digest is a partial
aggregation, written, and joined back on the digest, where AQE splits a hot group of copies.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.tables import Scratch

#: Fixed values of the audit: filters in their order, the word pattern, symbols of D.
FILTERS = "ABCDE"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"
MIN_WORDS, DISTINCT_PCT, UPPER_PCT = 200, 50, 2

SUBSETS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in itertools.permutations(FILTERS)]


def failures(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """part, doc_id and the 5-bit code of failed filters (bit i: FILTERS[i]) of every row.

    Null text counts as empty (fails A only); null source is part ''.  A null doc_id never
    fails E and makes no other row fail it.  Repeated rows of one doc_id are each counted; a
    repeat does not fail E by its twin, whose id is not smaller.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_count(text, F.lit(WORD))
    distinct = F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))))
    upper = F.regexp_count(text, F.lit("[A-Z]"))
    rows = docs.select(
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(text, 256).alias("digest"),
        (
            F.when(words < MIN_WORDS, 1).otherwise(0)
            + F.when(100 * distinct < DISTINCT_PCT * words, 2).otherwise(0)
            + F.when(100 * upper > UPPER_PCT * F.char_length(text), 4).otherwise(0)
            + F.when(text.rlike(SYMBOLS), 8).otherwise(0)
        ).alias("code"),
    )
    rows = scratch.put("rows", rows)
    least = scratch.put("least", rows.groupBy("digest").agg(F.min("doc_id").alias("least")))
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    return rows.join(least, "digest").select("part", "doc_id", (F.col("code") + F.when(copy, 16).otherwise(0)).alias("code"))


#: Truth table: the word of surviving subsets of each failure code.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not f & s) for f in range(SUBSETS)], np.uint32)


def survival_words(codes: np.ndarray) -> np.ndarray:
    """The 32-bit word of surviving subsets of each failure code."""
    return WORDS[codes]


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of ``words`` have each of the 32 bits set, by carry-save adders.

    Words of weight 2^k are reduced three at a time to one word of weight 2^k (their sum
    bits) and one of weight 2^(k+1) (their carries) until at most two are left at a weight;
    their bits are then counted at that weight.  Linear work, 32 positions per operation.
    """
    counts = np.zeros(32, np.int64)
    level, weight = np.asarray(words, np.uint32), 1
    bits = np.arange(32, dtype=np.uint32)
    while level.size:
        carries = []
        while level.size > 2:
            m = level.size // 3 * 3
            a, b, c = level[0:m:3], level[1:m:3], level[2:m:3]
            carries.append((a & b) | (a & c) | (b & c))
            level = np.concatenate([a ^ b ^ c, level[m:]])
        for w in level:
            counts += ((w >> bits) & 1).astype(np.int64) * weight
        level, weight = (np.concatenate(carries) if carries else np.zeros(0, np.uint32)), weight * 2
    return counts


def subset_survivors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task: survivors of every subset for each (part, good, toxic) met, summed over its batches."""
    total: dict[tuple, np.ndarray] = {}
    for batch in batches:
        if batch.empty:
            continue
        words = survival_words(batch["code"].to_numpy(np.int64))
        keys = batch[["part", "good", "toxic"]].astype({"good": bool, "toxic": bool})
        for key, at in keys.groupby(["part", "good", "toxic"], sort=False).indices.items():
            total[key] = total.get(key, 0) + positional_popcount(words[at])
    for (part, good, toxic), counts in total.items():
        yield pd.DataFrame({"part": part, "good": good, "toxic": toxic, "subset": np.arange(32), "n": counts})


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step: the figures of that step.

    part (source; null: ''), filter_order (a permutation of ABCDE), step (1 to 5), filter
    (its letter), kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.
    A document is good (toxic) if any of its ``labels`` rows has quality (toxic) 1.  Every
    part met has all 600 rows, zeros included; an empty table gives no rows.  Further
    columns of ``docs`` or ``labels``, clashing names included, are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "filter-audit")
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    coded = failures(docs, scratch).join(marks, "doc_id", "left").select(
        "part", "code", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )
    counted = coded.mapInPandas(subset_survivors, "part string, good boolean, toxic boolean, subset int, n long")
    n = counted.groupBy("part", "subset").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("n_good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("n_toxic"),
    )
    # per part the 32 survivor counts, index = subset (bounded: 32 entries of three counts)
    per_part = n.groupBy("part").agg(F.sort_array(F.collect_list(F.struct("subset", "n", "n_good", "n_toxic"))).alias("by"))
    steps = F.array(*[
        F.struct(F.lit(order).alias("filter_order"), F.lit(k + 1).alias("step"), F.lit(order[k]).alias("filter"),
                 F.lit(_mask(order[:k])).alias("before"), F.lit(_mask(order[k])).alias("bit"))
        for order in ORDERS for k in range(len(FILTERS))
    ])
    rows = per_part.select("part", "by", F.inline(steps))

    def at(mask, field: str):
        return F.element_at("by", mask + 1)[field]

    before, after = F.col("before"), F.col("before").bitwiseOR(F.col("bit"))
    everything, others = F.lit(SUBSETS - 1), F.lit(SUBSETS - 1) - F.col("bit")
    removed = at(before, "n") - at(after, "n")
    figures = rows.select(
        "part", "filter_order", "step", "filter",
        at(after, "n").alias("kept"),
        removed.alias("removed"),
        ((at(F.lit(0), "n") - at(F.col("bit"), "n")) - removed).alias("redundant"),
        (at(others, "n") - at(everything, "n")).alias("unique_fails"),
        (at(before, "n_good") - at(after, "n_good")).alias("good_lost"),
        (at(before, "n_toxic") - at(after, "n_toxic")).alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter"))
    return figures.withColumn("shapley", shapley.cast("long"))


def _mask(letters: str) -> int:
    return sum(1 << FILTERS.index(x) for x in letters)


def _permutations_sql() -> str:
    letters = " UNION ALL ".join(f"SELECT '{x}' AS x, {i} AS i" for i, x in enumerate(FILTERS))
    return f"l AS ({letters}), o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e WHERE a.i NOT IN (b.i, c.i, d.i, e.i) AND b.i NOT IN (c.i, d.i, e.i) AND c.i NOT IN (d.i, e.i) AND d.i <> e.i)"


#: DuckDB twin: every document's failures, then each step's figures by brute force over documents.
SQL = f"""
WITH t AS (SELECT doc_id, COALESCE(source, '') AS part, COALESCE(text, '') AS text FROM documents),
m AS (SELECT doc_id, MAX(COALESCE(quality = 1, FALSE)) AS good, MAX(COALESCE(toxic = 1, FALSE)) AS toxic FROM labels GROUP BY doc_id),
w AS (SELECT t.*, len(regexp_extract_all(text, '{WORD}')) AS n_words, len(list_distinct(regexp_extract_all(text, '{WORD}'))) AS n_distinct,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(text) AS n_chars,
        COALESCE(doc_id > MIN(doc_id) OVER (PARTITION BY text), FALSE) AS copy FROM t),
d AS (SELECT w.part, COALESCE(m.good, FALSE) AS good, COALESCE(m.toxic, FALSE) AS toxic,
        n_words < {MIN_WORDS} AS fa, 100 * n_distinct < {DISTINCT_PCT} * n_words AS fb, 100 * n_upper > {UPPER_PCT} * n_chars AS fc,
        regexp_matches(text, '{SYMBOLS}') AS fd, copy AS fe FROM w LEFT JOIN m ON w.doc_id = m.doc_id),
{_permutations_sql()},
s AS (SELECT filter_order, k AS step, substr(filter_order, k, 1) AS filter, substr(filter_order, 1, k - 1) AS before FROM o, range(1, 6) r(k)),
f AS (SELECT d.*, s.*,
        (contains(before, 'A') AND fa) OR (contains(before, 'B') AND fb) OR (contains(before, 'C') AND fc) OR (contains(before, 'D') AND fd) OR (contains(before, 'E') AND fe) AS gone,
        CASE filter WHEN 'A' THEN fa WHEN 'B' THEN fb WHEN 'C' THEN fc WHEN 'D' THEN fd ELSE fe END AS fails,
        (CASE WHEN fa THEN 1 ELSE 0 END) + (CASE WHEN fb THEN 1 ELSE 0 END) + (CASE WHEN fc THEN 1 ELSE 0 END) + (CASE WHEN fd THEN 1 ELSE 0 END) + (CASE WHEN fe THEN 1 ELSE 0 END) AS n_fails
      FROM d, s),
g AS (SELECT part, filter_order, step, filter,
        SUM(CASE WHEN NOT gone AND NOT fails THEN 1 ELSE 0 END)::BIGINT AS kept,
        SUM(CASE WHEN NOT gone AND fails THEN 1 ELSE 0 END)::BIGINT AS removed,
        SUM(CASE WHEN gone AND fails THEN 1 ELSE 0 END)::BIGINT AS redundant,
        SUM(CASE WHEN fails AND n_fails = 1 THEN 1 ELSE 0 END)::BIGINT AS unique_fails,
        SUM(CASE WHEN NOT gone AND fails AND good THEN 1 ELSE 0 END)::BIGINT AS good_lost,
        SUM(CASE WHEN NOT gone AND fails AND toxic THEN 1 ELSE 0 END)::BIGINT AS toxic_lost
      FROM f GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, filter, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (SUM(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley
FROM g
"""
