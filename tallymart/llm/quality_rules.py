"""Quality rules with thresholds that adapt to each language and source.

Every document is measured once over its whole text.  Per (language, source) and measure a
quantile sketch is kept: counts of logarithmic bins (exact below 64, then 32 bins for every
doubling, so a quantile is off by a 32nd at most).  Sketches of parts of the data merge by
adding counts, which is what Spark's partial aggregation does, so a source with a third of
all rows moves no more data than any other.  Quartiles give fences, fences are joined back
to the measured documents, and documents outside a fence are dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.tables import Scratch, batch_of, blocks
from tallymart.llm.words import Texts, windows

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: Fences lie so many interquartile ranges outside the quartiles.
SPREAD = 3
#: Measure (per mille, or tenths of a character): slack added to its fence, and whether low values are fenced too.
RULES = {"symbol_rate": (50, False), "dup_line_rate": (600, False), "repeat_rate": (300, False), "word_length": (20, True)}
EXACT = 64
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def counts(texts: Texts) -> list[np.ndarray]:
    """The numbers of COUNTS for each text."""
    n = len(texts)
    words, lines = texts.words(), texts.lines()
    hashes = words.hashes()
    sums = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[texts.start])
    chars = np.bincount(words.owner, words.sums(texts.code_points()), n).astype(np.int64)
    symbols = sums(np.isin(texts.data, np.frombuffer(SYMBOLS, np.uint8)))

    line_of = np.searchsorted(lines.begin, words.begin, "right") - 1
    worded = np.bincount(line_of, minlength=len(lines.begin)) > 0
    owner, text = lines.owner[worded], lines.hashes()[worded]
    n_lines = np.bincount(owner, minlength=n)
    order = np.lexsort((text, owner))
    again = np.zeros(len(order), bool)
    again[1:] = (text[order][1:] == text[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    dup_lines = np.bincount(owner[order], again, n).astype(np.int64)

    grams, at = windows(hashes, words.owner, 3)
    repeated = np.zeros(len(hashes), bool)
    if len(at):
        order = np.lexsort((grams, words.owner[at]))
        same = (grams[order][1:] == grams[order][:-1]) & (words.owner[at][order][1:] == words.owner[at][order][:-1])
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for j in range(3):
            repeated[at[twice] + j] = True
    return [words.counts(), chars, symbols, dup_lines, np.bincount(words.owner, repeated, n).astype(np.int64), n_lines]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the numbers of COUNTS."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string()), *((c, pa.int64()) for c in COUNTS)])

    def work(batches):
        for block in blocks(batches, "text"):
            yield batch_of(schema, *(block.column(c) for c in ("doc_id", "lang", "source")), *counts(Texts.of(block.column("text"))))

    columns = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", "text").mapInArrow(work, f"doc_id long, lang string, source string, {columns}")


def rated(table: DataFrame) -> DataFrame:
    """The measures of RULES, and base_failed."""
    least = lambda c: F.greatest(F.col(c), F.lit(1))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    whole = lambda a, b: F.floor(a / b).cast("long")
    return table.withColumns({
        "base_failed": failed,
        "symbol_rate": whole(1000 * F.col("n_symbols"), least("word_chars")),
        "dup_line_rate": whole(1000 * F.col("n_dup_lines"), least("n_lines")),
        "repeat_rate": whole(1000 * F.col("n_repeat_words"), least("n_words")),
        "word_length": whole(10 * F.col("word_chars"), least("n_words")),
    })


def bin_of(value: Column) -> Column:
    """The lower end of a value's bin: itself below EXACT, else its six leading binary digits."""
    spare = F.length(F.bin(value)) - 6
    width = F.pow(F.lit(2.0), spare).cast("long")
    return F.when(value < EXACT, value).otherwise(F.floor(value / width).cast("long") * width)


def sketches(table: DataFrame) -> DataFrame:
    """lang, source, measure, bin, n: mergeable counts of the documents that pass the base rules."""
    values = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), bin_of(F.col(m)).alias("bin")) for m in RULES))).alias("value")
    return table.filter("not base_failed").select("lang", "source", values).groupBy("lang", "source", "value.measure", "value.bin").agg(F.count("*").alias("n"))


def fences(sketch: DataFrame) -> DataFrame:
    """lang, source, and a lower and upper fence for each measure; one row for each group."""
    group = Window.partitionBy("lang", "source", "measure")
    ranked = sketch.withColumns({"upto": F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)), "total": F.sum("n").over(group)})
    quartile = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("total"), F.col("bin")))
    found = ranked.groupBy("lang", "source", "measure").agg(quartile(1).alias("low"), quartile(3).alias("high"))
    cases = []
    for m, (slack, _) in RULES.items():
        reach = SPREAD * (F.col("high") - F.col("low")) + slack
        cases += [F.max(F.when(F.col("measure") == m, F.col("low") - reach)).alias(f"{m}_from"), F.max(F.when(F.col("measure") == m, F.col("high") + reach)).alias(f"{m}_to")]
    return found.groupBy("lang", "source").agg(*cases)


def judge(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, source): counts, base_failed, measures, kept.

    A null or empty text has no words and fails the base rules.  A null language or source
    is a group of its own.  Rows that repeat or share or lack an id are judged each for
    itself; other columns are ignored; no rows give none.
    """
    scratch = Scratch(docs.sparkSession, "quality-rules")
    table = rated(scratch.put("measured", measured(docs)))
    limits = scratch.put("fences", fences(sketches(table)))
    inside = F.lit(True)
    for m, (_, both) in RULES.items():
        inside = inside & (F.col(m) <= F.col(f"{m}_to"))
        if both:
            inside = inside & (F.col(m) >= F.col(f"{m}_from"))
    limits = limits.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    joined = table.join(limits, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left")
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(False))
    return joined.select("doc_id", *COUNTS, "base_failed", *RULES, kept.alias("kept"))


SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d
), g AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, ws[i], ws[i + 1], ws[i + 2]) AS c
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)
), r AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM g, (VALUES (0), (1), (2)) o(k) WHERE c > 1 GROUP BY rid
), b AS (
  SELECT w.rid, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines FROM w LEFT JOIN r USING (rid)
), m AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    1000 * n_symbols // greatest(word_chars, 1) AS symbol_rate, 1000 * n_dup_lines // greatest(n_lines, 1) AS dup_line_rate,
    1000 * n_repeat_words // greatest(n_words, 1) AS repeat_rate, 10 * word_chars // greatest(n_words, 1) AS word_length FROM b
), s AS (
  SELECT lang, source, measure, CASE WHEN v < 64 THEN v ELSE v // (2 ** (length(bin(v)) - 6))::BIGINT * (2 ** (length(bin(v)) - 6))::BIGINT END AS bin, count(*) AS n
  FROM (SELECT lang, source, unnest(['symbol_rate', 'dup_line_rate', 'repeat_rate', 'word_length']) AS measure,
          unnest([symbol_rate, dup_line_rate, repeat_rate, word_length]) AS v FROM m WHERE NOT base_failed)
  GROUP BY ALL
), q AS (
  SELECT lang, source, measure, min(bin) FILTER (4 * upto >= total) AS low, min(bin) FILTER (4 * upto >= 3 * total) AS high
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, measure ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY lang, source, measure) AS total FROM s)
  GROUP BY ALL
), f AS (
  SELECT lang, source, max(high + 3 * (high - low) + 50) FILTER (measure = 'symbol_rate') AS symbol_to,
    max(high + 3 * (high - low) + 600) FILTER (measure = 'dup_line_rate') AS dup_to, max(high + 3 * (high - low) + 300) FILTER (measure = 'repeat_rate') AS repeat_to,
    max(high + 3 * (high - low) + 20) FILTER (measure = 'word_length') AS word_to, max(low - 3 * (high - low) - 20) FILTER (measure = 'word_length') AS word_from
  FROM q GROUP BY lang, source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed, symbol_rate, dup_line_rate, repeat_rate, word_length,
  NOT base_failed AND coalesce(symbol_rate <= symbol_to AND dup_line_rate <= dup_to AND repeat_rate <= repeat_to AND word_length BETWEEN word_from AND word_to, false) AS kept
FROM m LEFT JOIN f ON m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source
"""
