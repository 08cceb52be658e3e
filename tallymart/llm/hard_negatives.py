"""Hard negatives by a GNAT-style multiway hyperplane tree over inner products, exact at the leaves.

Scores are integer inner products.  Each vector ``x`` becomes ``y = (x, sqrt(M² - |x|²))``
with ``M²`` the largest squared norm; a query ``q`` becomes ``(q, 0)``.  Then
``|q' - y|² = |q|² + M² - 2 q·x``: a higher score is a smaller distance, and a window of
scores is an annulus of distances around the query, so metric-tree pruning applies.

The tree (after Brin's GNAT): a node holds a few split points; every point goes to the child
of its nearest split point (the multiway hyperplane split), and the node stores, for every
split point ``i`` and child ``j``, the range of distances from ``i`` to the points of ``j``.
A query at distance ``d_i`` from split point ``i`` looking for points at distances in
``[r_lo, r_hi]`` can only meet child ``j`` if ``[max(d_i - r_hi, r_lo - d_i), d_i + r_hi]``
meets the range of (i, j); siblings whose ranges miss the annulus are dropped, and children
are visited nearest bound first until the k-th result so far is closer than any bound left.
Leaves are scanned exactly with integer scores, so pruning (with a float slack on the safe
side) never changes a result.

At scale the top level is a Spark job: its split points come from a bounded sample
(``SAMPLE_ROWS`` rows by a hash threshold, farthest first), every row goes to its nearest
split point, and each child is cut by hash into chunks of about ``LEAF_ROWS`` rows, so a hot
vector repeated a third of the table fills many chunks rather than one.  Chunk ranges are an
aggregation.  Queries are routed to the subtrees and chunks whose ranges meet their annulus
(an equi-join on the subtree, then a filter on the chunk's ranges), met with the chunk's rows
in groups of at most ``QUERY_ROWS`` queries, searched in a local tree built in the task, and
each query's best ``k`` over all chunks are kept by a window.  A first pass over the query's
own subtree gives each query a k-th distance that bounds the routing of the second pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.llm.tables import Scratch

#: Fixed values of the mining: quantizing scale, anchors, relabelled rows, classes, counts, window.
SCALE, ANCHOR_EVERY, RELABEL_EVERY, CLASSES = 256, 100, 7, 10
POSITIVES, NEGATIVES = 5, 10
LOW_PCT, HIGH_PCT = 30, 90

#: Split points of the top level, chosen from at most about SAMPLE_ROWS rows (a documented, bounded sample).
SPLITS, SAMPLE_ROWS = 16, 4096
#: Rows of a chunk (a child of the top level, cut by hash), queries met by a chunk at once.
LEAF_ROWS, QUERY_ROWS = 2048, 512
#: Local trees: split points of a node, and rows of a leaf scanned exactly.
ARITY, NODE_LEAF = 6, 128
#: Relative slack of float distances; pruning is loosened by it, never tightened.
SLACK = 1e-9
#: Stands for no score yet.
_LOWEST = -(1 << 63)


def prepared(emb: DataFrame) -> DataFrame:
    """vec_id, label (relabelled) and the quantized vector of every row that takes part.

    Rows with a null vec_id, label or vector, or any null, NaN or infinite component take no
    part.  A vector shorter than others counts as padded with zeros.  Repeated rows are
    separate rows: each can be an anchor, a positive or a negative.
    """
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    label = F.col("label").cast("long")
    return emb.filter(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull() & ok).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % RELABEL_EVERY == 0, (label + 1) % CLASSES).otherwise(label).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("v"),
    )


def _matrix(v: pd.Series, dim: int) -> np.ndarray:
    out = np.zeros((len(v), dim), np.int64)
    for r, x in enumerate(v):
        if len(x):
            out[r, : len(x)] = x
    return out


def _lift(x: np.ndarray, m2: float) -> np.ndarray:
    """Rows (x, sqrt(M² - |x|²)) as floats."""
    n2 = (x.astype(np.float64) ** 2).sum(1)
    return np.hstack([x.astype(np.float64), np.sqrt(np.maximum(m2 - n2, 0.0))[:, None]])


def _dists(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between the rows of a and of b."""
    d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * a @ b.T
    return np.sqrt(np.maximum(d2, 0.0))


def farthest_first(points: np.ndarray, k: int) -> np.ndarray:
    """Indices of up to k points, each the farthest from those already chosen (starting at 0)."""
    if not len(points):
        return np.zeros(0, np.int64)
    chosen = [0]
    near = _dists(points, points[:1])[:, 0]
    while len(chosen) < min(k, len(points)):
        nxt = int(np.argmax(near))
        if near[nxt] <= 0:
            break  # the rest repeat points already chosen
        chosen.append(nxt)
        near = np.minimum(near, _dists(points, points[nxt : nxt + 1])[:, 0])
    return np.array(chosen, np.int64)


def _products(x: np.ndarray, q: np.ndarray, size: float) -> np.ndarray:
    """Exact inner products (queries x rows) of integer vectors; ``size`` bounds the product of two norms.

    Sums below 2^53 are exact as floats in any order, sums below 2^63 as longs; beyond, Python's integers.
    """
    if size < 2.0**52:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    if size < 2.0**62:
        return q @ x.T
    return q.astype(object) @ x.astype(object).T


class Tree:
    """A local GNAT over rows (ids, labels, integer vectors), searched exactly by many queries at once."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, m2: float):
        order = np.lexsort((np.arange(len(ids)), ids))  # rows by vec_id, so that splits do not hang on arrival
        self.ids, self.labels, self.x, self.m2 = ids[order], labels[order], x[order], m2
        self.y = _lift(self.x, m2)
        self.norm = math.sqrt((self.x.astype(np.float64) ** 2).sum(1).max(initial=0.0))
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(self.ids)))

    def _build(self, rows: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(None)
        split = rows[:0] if len(rows) <= NODE_LEAF else rows[farthest_first(self.y[rows], ARITY)]
        if len(split) >= 2:
            d = _dists(self.y[rows], self.y[split])  # rows x splits
            child = np.argmin(d, 1)
            used = np.unique(child)  # of equal points, told apart by rounding alone, some get no rows
            split, d, child = split[used], d[:, used], np.searchsorted(used, child)
        if len(split) < 2:
            self.nodes[at] = ("leaf", rows)  # few points, or all equal: no split can part them
            return at
        ranges = np.zeros((len(split), len(split), 2))
        kids = []
        for j in range(len(split)):
            mine = child == j
            ranges[:, j, 0], ranges[:, j, 1] = d[mine].min(0), d[mine].max(0)
            kids.append(self._build(rows[mine]))
        self.nodes[at] = ("node", self.y[split], ranges, kids)
        return at

    def search(self, q: np.ndarray, r_lo: float, r_hi: float, k: int, keep) -> list[tuple[int, int]]:
        """One query's (score, row) pairs, best first, among rows that ``keep(ids, labels, scores)`` accepts."""
        one = lambda at, ids, labels, scores: np.asarray(keep(ids, labels, scores[0]), bool)[None, :]
        _, scores, rows = self.search_many(q[None, :], np.array([r_lo]), np.array([r_hi]), np.array([k]), one)
        return list(zip(scores.tolist(), rows.tolist()))

    def search_many(self, q: np.ndarray, r_lo: np.ndarray, r_hi: np.ndarray, k: np.ndarray, keep, least: np.ndarray | None = None):
        """Each query's first ``k`` rows (higher score, then smaller vec_id): arrays (query, score, row), best first.

        ``keep(queries, ids, labels, scores)`` is the exact test (label, own id, integer window) as a mask
        of queries x rows; ``r_lo`` and ``r_hi`` bound the distances of the rows it can accept, loosened by
        the slack.  Rows scoring under ``least`` are not wanted.  A node is met by all queries whose annulus
        meets one of its children, a leaf scanned for all that reach it; each query's own k-th score shrinks
        its annulus on the way.
        """
        m = len(q)
        y = np.hstack([q.astype(np.float64), np.zeros((m, 1))])
        q2 = (y * y).sum(1)
        size = self.norm * math.sqrt(q2.max(initial=0.0))
        floor = np.full(m, _LOWEST, np.int64) if least is None else least.astype(np.int64)
        reach = np.minimum(r_hi, _reach(q2, self.m2, floor))
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
        todo = [(self.root, np.flatnonzero(r_lo <= r_hi), np.zeros(m))]
        while todo:
            at, mine, bound = todo.pop()
            mine = mine[bound[mine] <= reach[mine]]
            if not len(mine):
                continue
            node = self.nodes[at]
            if node[0] == "leaf":
                rows = node[1]
                scores = _products(self.x[rows], q[mine], size)
                ok = keep(mine, self.ids[rows], self.labels[rows], scores) & (scores >= floor[mine][:, None]).astype(bool)
                a, r = np.nonzero(ok)
                if not len(a):
                    continue
                found = scores[a, r]
                if found.dtype == object and max(abs(int(s)) for s in found) >= 1 << 63:
                    raise OverflowError("a score does not fit a long")
                touched = np.zeros(m, bool)
                touched[mine[a]] = True
                old = touched[best[0]]
                whose = np.concatenate([best[0][old], mine[a]])
                score = np.concatenate([best[1][old], found.astype(np.int64)])
                row = np.concatenate([best[2][old], rows[r]])
                order = np.lexsort((row, self.ids[row], ~score, whose))
                whose, score, row = whose[order], score[order], row[order]
                place = np.arange(len(whose)) - np.searchsorted(whose, whose)
                last = place == k[whose] - 1
                floor[whose[last]] = score[last]
                changed = whose[last]
                reach[changed] = np.minimum(reach[changed], _reach(q2[changed], self.m2, floor[changed]))
                kept = place < k[whose]
                best = tuple(np.concatenate([b[~old], n[kept]]) for b, n in zip(best, (whose, score, row)))
                continue
            _, points, ranges, kids = node
            dq = _dists(y[mine], points)[:, :, None]  # queries x splits x 1
            low, high = ranges[None, :, :, 0], ranges[None, :, :, 1]
            hi = reach[mine][:, None, None]
            meets = ((np.maximum(dq - hi, r_lo[mine][:, None, None] - dq) <= high) & (dq + hi >= low)).all(1)
            lower = np.maximum(np.maximum(low - dq, dq - high), 0).max(1)
            for j in np.argsort(-lower.mean(0), kind="stable"):  # the nearest child is popped first
                if meets[:, j].any():
                    further = np.zeros(m)
                    further[mine] = np.maximum(lower[:, j], r_lo[mine])
                    todo.append((kids[j], mine[meets[:, j]], further))
        order = np.lexsort((best[2], self.ids[best[2]], ~best[1], best[0]))
        return tuple(b[order] for b in best)


def _reach(q2: np.ndarray, m2: float, score: np.ndarray) -> np.ndarray:
    """Per query, the distance of a row of this score, loosened outward; without end where there is no score yet."""
    s = score.astype(np.float64)
    slack = SLACK * (q2 + m2 + np.abs(s) + 1.0)
    return np.where(score == _LOWEST, math.inf, np.sqrt(np.maximum(q2 + m2 - 2.0 * s, 0.0) + slack) + slack)


def _radius(q2: float, m2: float, score: float, up: bool) -> float:
    """The distance of a row of this score from the query, loosened outward (``up``) or inward by the slack."""
    d2 = max(q2 + m2 - 2.0 * score, 0.0)
    slack = SLACK * (q2 + m2 + abs(score) + 1.0)
    return math.sqrt(d2 + slack) + slack if up else math.sqrt(max(d2 - slack, 0.0)) - slack


def _annulus(q2: float, m2: float, lo: float | None, hi: float | None) -> tuple[float, float]:
    """Distances of rows whose scores lie in [lo, hi] (None: unbounded), loosened by the slack."""
    r_lo = 0.0 if hi is None else max(_radius(q2, m2, hi, up=False), 0.0)
    r_hi = math.inf if lo is None else _radius(q2, m2, lo, up=True)
    return r_lo, r_hi


QUERY = "qid long, v array<long>, label long, own long, same boolean, k int, ps long"


def _limits(ps) -> tuple[int, int]:
    """The least and greatest score in a positive's window, as integers: a hundredfold score need not fit a long."""
    return -(-LOW_PCT * int(ps) // 100), HIGH_PCT * int(ps) // 100


def _keep(queries: pd.DataFrame):
    """The exact test of queries against rows: label, own id, and the integer window of a negative."""
    label, same = queries["label"].to_numpy(np.int64), queries["same"].to_numpy(bool)
    has_own, has_ps = queries["own"].notna().to_numpy(), queries["ps"].notna().to_numpy()
    own = np.array([int(o) if h else 0 for o, h in zip(queries["own"], has_own)], np.int64)
    limits = [_limits(p) if h else (_LOWEST, -_LOWEST - 1) for p, h in zip(queries["ps"], has_ps)]
    low, high = (np.array([w[i] for w in limits], np.int64) for i in (0, 1))

    def keep(at, ids, labels, scores):
        ok = (labels[None, :] == label[at][:, None]) == same[at][:, None]
        ok &= ~has_own[at][:, None] | (ids[None, :] != own[at][:, None])
        window = (scores >= low[at][:, None]) & (scores <= high[at][:, None])
        return ok & (~has_ps[at][:, None] | window.astype(bool))

    return keep


def _window(query, q2: float, m2: float) -> tuple[float, float]:
    if query.ps is None or pd.isna(query.ps):
        return 0.0, math.inf
    lo, hi = _limits(query.ps)
    return (1.0, 0.0) if lo > hi else _annulus(q2, m2, lo, hi)


def _search_chunks(dim: int, m2: float):
    """cogroup function: one chunk's rows and a block of its queries, each query's best k in the chunk."""

    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or queries.empty:
            return pd.DataFrame({"qid": [], "vec_id": [], "score": []}, dtype="int64")
        tree = Tree(rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), _matrix(rows["v"], dim), m2)
        who, scores, found = tree.search_many(
            _matrix(queries["v"], dim), queries["r_lo"].to_numpy(np.float64), queries["r_hi"].to_numpy(np.float64),
            queries["k"].to_numpy(np.int64), _keep(queries), queries["bound"].to_numpy(np.int64),
        )
        return pd.DataFrame({"qid": queries["qid"].to_numpy(np.int64)[who], "vec_id": tree.ids[found], "score": scores})

    return run


def _route(points: np.ndarray, ranges: np.ndarray, dim: int, m2: float):
    """mapInPandas: each query's home subtree and the subtrees whose ranges meet its annulus."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            x = _matrix(batch["v"], dim)
            dq = _dists(np.hstack([x.astype(np.float64), np.zeros((len(x), 1))]), points)  # queries x splits
            homes, meets, lows, highs, norms = [], [], [], [], []
            for r, query in enumerate(batch.itertuples(index=False)):
                q2 = float((x[r].astype(np.float64) ** 2).sum())
                r_lo, r_hi = _window(query, q2, m2)
                lo_need = np.maximum(dq[r] - r_hi, r_lo - dq[r])[:, None]
                hi_need = (dq[r] + r_hi)[:, None]
                ok = ((lo_need <= ranges[:, :, 1]) & (hi_need >= ranges[:, :, 0])).all(0) & (r_lo <= r_hi)
                homes.append(int(np.argmin(dq[r])))
                meets.append(np.flatnonzero(ok).astype(np.int64).tolist())
                lows.append(r_lo)
                highs.append(r_hi)
                norms.append(q2)
            yield batch.assign(home=homes, dq=list(dq), meets=meets, r_lo=lows, r_hi=highs, q2=norms)

    return run


def _chunk_meets(r_lo, r_hi, dq, lo, hi):
    """Native test that a chunk's ranges (per split point) meet a query's annulus."""
    need = F.arrays_zip(dq.alias("d"), lo.alias("lo"), hi.alias("hi"))
    return F.forall(need, lambda t: (F.greatest(t["d"] - r_hi, r_lo - t["d"]) <= t["hi"]) & (t["d"] + r_hi >= t["lo"]))


def search(index: dict, queries: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """qid, vec_id, score, rank: each query's best k rows, exactly."""
    dim, m2, chunks, rows = index["dim"], index["m2"], index["chunks"], index["rows"]
    more = T.StructType(queries.schema.fields + [
        T.StructField("home", T.IntegerType()), T.StructField("dq", T.ArrayType(T.DoubleType())), T.StructField("meets", T.ArrayType(T.LongType())),
        T.StructField("r_lo", T.DoubleType()), T.StructField("r_hi", T.DoubleType()), T.StructField("q2", T.DoubleType()),
    ])
    routed = queries.mapInPandas(_route(index["points"], index["ranges"], dim, m2), more)
    routed = scratch.put(f"{name}-routed", routed)
    asked = ["qid", "v", "label", "own", "same", "k", "ps", "r_lo", "r_hi"]

    def searched(pairs: DataFrame, tag: str) -> DataFrame:
        """Results of queries met with chunks: pairs (query columns, j, c, bound).

        A cogroup deals both sides out by the hash of the keys, and an int and a long of the same
        value hash apart, so ``j`` is cast to the type it has in the index.
        """
        pairs = scratch.put(f"{name}-{tag}-pairs", pairs.select(F.col("j").cast("int").alias("j"), "c", *asked, F.coalesce("bound", F.lit(_LOWEST)).alias("bound")))
        blocks = pairs.groupBy("j", "c").agg(F.count(F.lit(1)).alias("n")).select("j", "c", F.ceil(F.col("n") / QUERY_ROWS).cast("int").alias("blocks"))
        pairs = pairs.join(blocks, ["j", "c"]).withColumn("qb", F.pmod(F.xxhash64("qid"), F.col("blocks")).cast("int"))
        copies = rows.join(blocks, ["j", "c"]).select("j", "c", "vec_id", "label", "v", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("qb"))
        found = (
            copies.groupBy("j", "c", "qb")
            .cogroup(pairs.select("j", "c", "qb", *asked, "bound").groupBy("j", "c", "qb"))
            .applyInPandas(_search_chunks(dim, m2), "qid long, vec_id long, score long")
        )
        return scratch.put(f"{name}-{tag}", found)

    # first pass: each query in the chunks of its own subtree
    home = routed.withColumn("bound", F.lit(None).cast("long")).join(chunks.select(F.col("j").alias("home"), "c"), "home").withColumn("j", F.col("home"))
    first = searched(home, "home")
    ranked = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    kth = (
        first.withColumn("rank", F.row_number().over(ranked))
        .join(routed.select("qid", "k"), "qid")
        .filter(F.col("rank") == F.col("k"))
        .select("qid", F.col("score").alias("bound"))
    )
    # second pass: the other subtrees whose ranges meet the annulus, bounded by the k-th of the first
    rest = (
        routed.join(kth, "qid", "left")
        .select("*", F.explode("meets").alias("j"))
        .filter(F.col("j") != F.col("home"))
        .join(chunks, "j")
    )
    q2 = F.col("q2")
    slack = F.lit(SLACK) * (q2 + F.lit(m2) + F.abs("bound") + 1.0)
    reach = F.when(F.col("bound").isNull(), F.lit(math.inf)).otherwise(F.sqrt(F.greatest(q2 + F.lit(m2) - 2.0 * F.col("bound"), F.lit(0.0)) + slack) + slack)
    rest = rest.filter(_chunk_meets(F.col("r_lo"), F.least(F.col("r_hi"), reach), F.col("dq"), F.col("lo"), F.col("hi")))
    second = searched(rest, "rest")
    return first.unionByName(second).withColumn("rank", F.row_number().over(ranked)).join(routed.select("qid", "k"), "qid").filter(F.col("rank") <= F.col("k")).drop("k")


def build_index(rows: DataFrame, scratch: Scratch) -> dict | None:
    """The top level: split points from a bounded sample, rows in chunks of their nearest split point, ranges."""
    stats = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.size("v")).alias("dim"),
        F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("m2"),
    ).first()
    if not stats["n"]:
        return None
    dim, m2 = int(stats["dim"]), float(stats["m2"])
    share = min(1.0, SAMPLE_ROWS / stats["n"])
    drawn = F.shiftrightunsigned(F.xxhash64("row"), 11) < F.lit(int(share * (1 << 53)))
    sample = rows.filter(drawn).select("row", "v").limit(2 * SAMPLE_ROWS).toPandas().sort_values("row")
    lifted = _lift(_matrix(sample["v"], dim), m2)
    points = lifted[farthest_first(lifted, SPLITS)]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            d = _dists(_lift(_matrix(batch["v"], dim), m2), points)
            yield batch.assign(j=np.argmin(d, 1).astype(np.int32), dists=list(d))

    more = T.StructType(rows.schema.fields + [T.StructField("j", T.IntegerType()), T.StructField("dists", T.ArrayType(T.DoubleType()))])
    assigned = scratch.put("assigned", rows.mapInPandas(assign, more))
    sizes = {r["j"]: r["n"] for r in assigned.groupBy("j").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most SPLITS rows
    cut = F.create_map(*[F.lit(x) for j, n in sizes.items() for x in (j, max(1, -(-n // LEAF_ROWS)))])
    chunked = scratch.put("chunked", assigned.withColumn("c", F.pmod(F.xxhash64("row"), cut[F.col("j")]).cast("int")))
    flat = chunked.select("j", "c", F.posexplode("dists").alias("i", "d")).groupBy("j", "c", "i").agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    chunks = flat.groupBy("j", "c").agg(F.sort_array(F.collect_list(F.struct("i", "lo", "hi"))).alias("r")).select("j", "c", F.col("r.lo").alias("lo"), F.col("r.hi").alias("hi"))
    chunks = scratch.put("chunks", chunks)
    top = flat.groupBy("i", "j").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()  # splits x splits rows
    ranges = np.zeros((len(points), len(points), 2))
    ranges[:, :, 0], ranges[:, :, 1] = math.inf, -math.inf  # a subtree without rows meets nothing
    for r in top:
        ranges[r["i"], r["j"]] = (r["lo"], r["hi"])
    return {"dim": dim, "m2": m2, "points": points, "ranges": ranges, "chunks": chunks, "rows": chunked.select("j", "c", "vec_id", "label", "v")}


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(emb: DataFrame) -> DataFrame:
    """Per anchor and positive, the first NEGATIVES rows of another label in the score window.

    anchor_id, positive_id, rank (1 up, among those returned), negative_id, positive_score,
    negative_score.  Anchors are rows whose vec_id is divisible by ANCHOR_EVERY; positives
    are an anchor's first POSITIVES rows of its label other than its own vec_id, by score
    then smaller vec_id; negatives lie in LOW_PCT..HIGH_PCT percent of the positive's score.
    An anchor without positives, or a positive without negatives, gives no rows; an empty
    table gives none.  Further columns of ``emb``, clashing names included, are not read.
    """
    spark = emb.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    rows = scratch.put("rows", prepared(emb).withColumn("row", F.monotonically_increasing_id()))
    index = build_index(rows, scratch)
    if index is None:
        return spark.createDataFrame([], OUT)
    anchors = rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0).select(
        F.col("row").alias("qid"), "v", "label", F.col("vec_id").alias("own"), F.lit(True).alias("same"), F.lit(POSITIVES).alias("k"), F.lit(None).cast("long").alias("ps")
    )
    positives = search(index, anchors, scratch, "positives")
    pairs = positives.join(anchors.select("qid", F.col("own").alias("anchor_id"), "v", "label"), "qid").select(
        (F.col("qid") * (POSITIVES + 1) + F.col("rank")).alias("qid"), "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("ps"), "v", "label"
    )
    pairs = scratch.put("pairs", pairs)
    negatives = search(index, pairs.select("qid", "v", "label", F.lit(None).cast("long").alias("own"), F.lit(False).alias("same"), F.lit(NEGATIVES).alias("k"), "ps"), scratch, "negatives")
    return negatives.join(pairs.select("qid", "anchor_id", "positive_id", "ps"), "qid").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("ps").alias("positive_score"), F.col("score").alias("negative_score")
    )


#: DuckDB twin: the same lists by brute force over all pairs.
SQL = f"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % {RELABEL_EVERY} = 0 THEN (label + 1) % {CLASSES} ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) IS NOT FALSE),
a AS (SELECT * FROM r WHERE vec_id % {ANCHOR_EVERY} = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, a.v AS av, r.vec_id, r.label,
             COALESCE(list_sum(list_transform(list_zip(a.v, r.v), lambda t: COALESCE(t[1], 0) * COALESCE(t[2], 0))), 0)::BIGINT AS score
      FROM a, r),
p AS (SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS prank
      FROM s WHERE label = anchor_label AND vec_id <> anchor_id QUALIFY prank <= {POSITIVES}),
n AS (SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id
      WHERE s.label <> p.anchor_label AND {LOW_PCT} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH_PCT} * p.positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
