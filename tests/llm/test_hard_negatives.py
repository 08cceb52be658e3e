"""Hard negatives by the GNAT against brute force, with nulls, repeats, a hot vector and many chunks."""

import math

import duckdb
import numpy as np
import pytest

from tallymart.llm import hard_negatives as hn


def brute(rows):
    """rows: (vec_id, label, vector or None) -> the contract's lists, by plain loops."""
    ok = []
    for vec_id, label, vec in rows:
        if vec_id is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        ok.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vec]))
    dim = max((len(v) for _, _, v in ok), default=0)
    dot = lambda a, b: sum(x * y for x, y in zip(a + [0] * dim, b + [0] * dim))
    out = []
    for aid, alab, av in ok:
        if aid % 100:
            continue
        pos = sorted(((-dot(av, v), i) for i, lab, v in ok if lab == alab and i != aid))[:5]
        for nps, pid in pos:
            ps = -nps
            neg = sorted(((-dot(av, v), i) for i, lab, v in ok if lab != alab and 30 * ps <= 100 * dot(av, v) <= 90 * ps))[:10]
            out += [(aid, pid, r + 1, nid, ps, -ns) for r, (ns, nid) in enumerate(neg)]
    return sorted(out)


@pytest.fixture(scope="module")
def table():
    rng = np.random.default_rng(11)
    rows = []
    hot = rng.normal(0, 0.1, 8).tolist()
    for i in range(1400):
        vec = hot if i % 3 == 0 else rng.normal(0, 0.1, 8).tolist()
        rows.append((i, int(rng.integers(0, 4)), vec))
    rows += [(1400, 1, None), (1500, None, [0.1] * 8), (1600, 2, [0.1, None] + [0.0] * 6), (1700, 2, [float("nan")] + [0.0] * 7),
             (1800, 3, [float("inf")] + [0.0] * 7), (1900, 1, [0.05] * 8), (1900, 1, [0.05] * 8), (2000, 1, []), (None, 1, [0.1] * 8)]
    return rows


def test_mine_equals_brute_force_over_many_chunks(ready, table, monkeypatch):
    monkeypatch.setattr(hn, "LEAF_ROWS", 90)
    monkeypatch.setattr(hn, "SPLITS", 5)
    monkeypatch.setattr(hn, "QUERY_ROWS", 7)
    emb = ready.createDataFrame(table, "vec_id long, label int, embedding array<float>").selectExpr("*", "1 as row", "2 as v", "3 as qid")
    got = sorted(tuple(r) for r in hn.mine(emb).collect())
    assert got == brute(table)
    assert len(got) > 50


def test_mine_equals_sql(ready, table):
    """The twin numbers anchors by vec_id, so repeated anchor rows (one list each here) are left out of it."""
    emb = ready.createDataFrame([r for r in table if r[0] != 1900], "vec_id long, label int, embedding array<float>")
    con = duckdb.connect()
    con.register("embeddings", emb.toArrow())
    want = sorted(tuple(r) for r in con.execute(hn.SQL).fetchall())
    assert sorted(tuple(r) for r in hn.mine(emb).collect()) == want


def test_empty_and_all_null(ready):
    none = ready.createDataFrame([(1, None, [0.1])], "vec_id long, label int, embedding array<float>")
    assert hn.mine(none).count() == 0
    assert hn.mine(none.filter("false")).count() == 0


def test_local_tree_equals_scan():
    rng = np.random.default_rng(5)
    x = rng.integers(-40, 40, (600, 6))
    x[::4] = x[0]  # repeated points
    ids, labels = np.arange(600), rng.integers(0, 3, 600)
    m2 = float((x * x).sum(1).max())
    tree = hn.Tree(ids, labels, x, m2)
    for q in x[:40]:
        scores = x @ q
        for lo, hi in ((None, None), (0.3, 0.9)):
            ps = int(scores.max())
            keep = (lambda i, lab, s: lab != 1) if lo is None else (lambda i, lab, s, ps=ps: (30 * ps <= 100 * s) & (100 * s <= 90 * ps))
            r_lo, r_hi = (0.0, math.inf) if lo is None else hn._annulus(float(q @ q), m2, lo * ps, hi * ps)
            got = [(s, tree.ids[r]) for s, r in tree.search(q, r_lo, r_hi, 10, keep)]
            ok = keep(ids, labels, scores)
            want = sorted(((int(scores[i]), int(ids[i])) for i in np.flatnonzero(ok)), key=lambda t: (-t[0], t[1]))[:10]
            assert got == want


def test_scores_whose_hundredfold_leaves_a_long_and_a_square_beyond_it(ready):
    """Scores near 2^62 fit a long, a hundred times them do not; one row's square does not either, its scores do."""
    rng = np.random.default_rng(9)
    rows = [(i, int(rng.integers(0, 3)), (rng.normal(0, 1, 8) * s).tolist()) for i, s in enumerate([2.0e6] * 400)]
    got = sorted(tuple(r) for r in hn.mine(ready.createDataFrame(rows, "vec_id long, label int, embedding array<float>")).collect())
    assert got == brute(rows) and max(abs(r[4]) for r in got) > 2**63 // 100
    rows = [(i, int(rng.integers(0, 3)), rng.normal(0, 1, 8).tolist()) for i in range(400)] + [(401, 2, [1e11] * 8)]
    got = sorted(tuple(r) for r in hn.mine(ready.createDataFrame(rows, "vec_id long, label int, embedding array<float>")).collect())
    assert got == brute(rows) and got


def test_many_queries_at_once_equal_scan_of_copies():
    """Far more equal points than a leaf holds, beside others; each query's list by plain sorting."""
    rng = np.random.default_rng(6)
    x = rng.integers(-90, 90, (3000, 7))
    x[:1200] = x[0]
    ids, labels = rng.permutation(3000), rng.integers(0, 3, 3000)
    tree = hn.Tree(ids, labels, x, float((x * x).sum(1).max()))
    q = x[::60]
    who, scores, rows = tree.search_many(q, np.zeros(len(q)), np.full(len(q), math.inf), np.full(len(q), 9), lambda at, i, lab, s: np.broadcast_to(lab != 1, s.shape))
    for n, one in enumerate(q):
        want = sorted((-int(s), int(i)) for s, i, lab in zip(x @ one, ids, labels) if lab != 1)[:9]
        assert [(-int(s), int(tree.ids[r])) for w, s, r in zip(who, scores, rows) if w == n] == want


def test_rows_and_queries_of_a_chunk_meet_in_any_number_of_partitions(ready, table):
    """Both sides of the cogroup are dealt alike; a single partition would hide keys of different types."""
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    before = {k: ready.conf.get(k) for k in held}
    for k, v in held.items():
        ready.conf.set(k, v)
    try:
        emb = ready.createDataFrame(table, "vec_id long, label int, embedding array<float>")
        assert sorted(tuple(r) for r in hn.mine(emb).collect()) == brute(table)
    finally:
        for k, v in before.items():
            ready.conf.set(k, v)
