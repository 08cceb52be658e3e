"""Exact top-k search by distributed histogram selection.

Queries and candidates meet in blocks: a group of queries (bounded) and a group of
candidates (bounded) are one task, whatever their number.  Scores are never stored; each
round works them out again by a matrix product and keeps counts.

Every round each task counts, for each of its queries, the scores of its candidates in
``BINS`` bins of the interval that is known to hold the query's kth score, and reports
the bins from the top down to where it has itself seen k scores (lower ones cannot matter).
The summed histograms narrow the interval to one bin; when a bin holds a single value,
that is the kth score.  A last round returns the scores above it and, of those equal to it, the
smallest ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.tables import Scratch, batch_of

BINS = 256
#: Queries of one group, candidates of one group (at most), scores worked on at once.
QUERY_GROUP, CANDIDATE_GROUP, SCORES = 16_384, 65_536, 1 << 20
EXACT = float(1 << 53)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, dim, norm, vec (float64 bytes of floor(256 x)) of the vectors that take part."""
    schema = pa.schema([("vec_id", pa.int64()), ("dim", pa.int32()), ("norm", pa.float64()), ("vec", pa.binary())])

    def work(batches):
        for batch in batches:
            rows = []
            for i, x in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
                if i is None or not x.is_valid or x.values.null_count or not len(x.values):
                    continue
                v = np.floor(256 * np.asarray(x.values).astype(np.float64))
                if np.isfinite(v).all():
                    rows.append((i, len(v), float(np.sqrt(v @ v)), v.tobytes()))
            if rows:
                yield batch_of(schema, *(list(c) for c in zip(*rows)))

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(work, "vec_id long, dim int, norm double, vec binary")


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.array([np.frombuffer(x, np.float64) for x in column.to_pylist()])


def products(left: pa.Table, right: pa.Table, ids: np.ndarray, queries: np.ndarray):
    """For stretches of the candidates: their ids and scores (candidate by query), a query's own row at minus infinity."""
    order = np.argsort(ids)
    step = max(1, SCORES // max(1, len(ids)))
    own, vectors = left["vec_id"].to_numpy(), left["vec"]
    for i in range(0, len(own), step):
        mine, x = own[i : i + step], matrix(vectors.slice(i, step))
        if np.abs(x).max(initial=0) * np.abs(queries).max(initial=0) * x.shape[1] < EXACT:
            scores = x @ queries.T
        else:  # float products would round: whole numbers, at the price of speed
            scores = (x.astype(np.int64) @ queries.T.astype(np.int64)).astype(np.float64)
        at = np.minimum(np.searchsorted(ids, mine, sorter=order), len(ids) - 1)
        hit = np.flatnonzero(ids[order[at]] == mine)
        scores[hit, order[at[hit]]] = -np.inf
        yield mine, scores


def histogram_round(pairs, k: int) -> DataFrame:
    """query_id, bin, n: counts in the bins of each query's interval, from the top down."""
    schema = pa.schema([("query_id", pa.int64()), ("bin", pa.int64()), ("n", pa.int64())])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids, queries = right["query_id"].to_numpy(), matrix(right["vec"])
        low, width, high = (right[c].to_numpy().astype(np.float64) for c in ("low", "width", "high"))
        count = np.zeros(len(ids) * (BINS + 2), np.int64)
        base = np.arange(len(ids)) * (BINS + 2)
        for _, scores in products(left, right, ids, queries):
            bins = np.clip(np.floor((scores - low) / width), -1, BINS).astype(np.int64) + 1
            bins[scores >= high] = BINS + 1
            count += np.bincount((bins + base).ravel(), minlength=len(count))
        count = count.reshape(len(ids), BINS + 2)[:, 1:-1]
        above = np.cumsum(count[:, ::-1], axis=1)[:, ::-1] - count
        q, b = np.nonzero((count > 0) & (above < k))
        return pa.table([ids[q], b, count[q, b]], schema=schema)

    return pairs.applyInArrow(work, "query_id long, bin long, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))


def last_round(pairs, k: int) -> DataFrame:
    """query_id, vec_id, score: all above the kth score, and of those equal to it the smallest ids of each task."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        ids, queries, low = right["query_id"].to_numpy(), matrix(right["vec"]), right["low"].to_numpy().astype(np.float64)
        order = np.argsort(left["vec_id"].to_numpy(), kind="stable")
        left = left.take(pa.array(order))
        tied = np.zeros(len(ids), np.int64)
        out = []
        for mine, scores in products(left, right, ids, queries):
            equal = scores == low
            # Candidates come by rising id, so the first k ties of a query are its smallest.
            early = equal & (np.cumsum(equal, axis=0) + tied <= k)
            tied += equal.sum(axis=0)
            c, q = np.nonzero((scores > low) | early)
            out.append((ids[q], mine[c], scores[c, q].astype(np.int64)))
        return pa.table([np.concatenate(x) for x in zip(*out)], schema=schema)

    return pairs.applyInArrow(work, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest inner products of each query with all rows but its own.

    ``vectors`` has vec_id and embedding; other columns are ignored.  Components are taken
    as floor(256 x).  Vectors that are null or empty, hold a null or non-finite component,
    or have no id take no part.  Ties go to the smaller id.  A repeated query id is one query
    (its smallest vector); rows with the query's id are its own; repeated candidates all
    count.  Vectors meet only those of their length.  A query without a candidate gives no row.  Scores
    must fit into a long.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "top-k")
    held = scratch.put("vectors", usable(vectors).withColumn("row", F.monotonically_increasing_id()))
    count, longest = held.agg(F.count("*"), F.coalesce(F.max("norm"), F.lit(0.0))).first()
    parts = max(1, -(-count // CANDIDATE_GROUP), min(-(-count // 1024), 2 * spark.sparkContext.defaultParallelism))
    bound = F.ceil(F.col("norm") * longest * (1 + 1e-9)).cast("long") + 1
    queries = held.filter(is_query).groupBy(F.col("vec_id").alias("query_id")).agg(F.min(F.struct("dim", "vec", "norm")).alias("of")).select("query_id", "of.*")
    sizes = queries.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_GROUP).cast("int").alias("groups"))
    sizes = scratch.put("sizes", sizes)
    queries = queries.join(sizes, "dim").select("query_id", "dim", "vec", bound.alias("bound"), F.pmod(F.xxhash64("query_id"), F.col("groups")).cast("int").alias("group"))
    queries = scratch.put("queries", queries)
    candidates = held.join(sizes, "dim").select(
        "dim", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part"), "vec_id", "vec")

    def pairs(state: DataFrame):
        """Each group of queries with its state, once for each part of the candidates."""
        with_state = queries.drop("bound").join(state, "query_id").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        return candidates.groupBy("dim", "group", "part").cogroup(with_state.groupBy("dim", "group", "part"))

    # low, high (exclusive), width: the interval and its bins; above: the number of scores from high on.
    first = F.ceil((2 * F.col("bound") + 1) / BINS).cast("long")
    state = scratch.put("state-0", queries.select("query_id", (-F.col("bound")).alias("low"), (F.col("bound") + 1).alias("high"), first.alias("width"), F.lit(0).cast("long").alias("above")))
    widest, step = state.agg(F.max("width")).first()[0] or 0, 0
    while widest:
        found = histogram_round(pairs(state), k).join(state, "query_id")
        down = Window.partitionBy("query_id").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        found = found.withColumn("upto", F.sum("n").over(down) + F.col("above")).filter(F.col("upto") >= k)
        found = found.groupBy("query_id").agg(F.max(F.struct("bin", "upto", "n")).alias("at")).select("query_id", "at.*")
        # Without k scores in all, the interval's lower end lets all of them through.
        low = F.col("low") + F.col("bin") * F.col("width")
        few = F.col("bin").isNull()
        after = state.join(found, "query_id", "left").select(
            "query_id", F.when(few, F.col("low")).otherwise(low).alias("low"), F.when(few, F.col("low")).otherwise(F.least(low + F.col("width"), "high")).alias("high"),
            F.when(few, F.lit(1)).otherwise(F.ceil(F.col("width") / BINS)).cast("long").alias("width"), F.when(few, F.lit(k)).otherwise(F.col("upto") - F.col("n")).alias("above"))
        state, step = scratch.put(f"state-{step + 1}", after), step + 1
        widest = 0 if widest == 1 else -(-widest // BINS)
    best = scratch.put("best", last_round(pairs(state.select("query_id", "low")), k))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
