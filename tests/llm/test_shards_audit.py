"""Shards by the weighted hash tree, and the audit of filter interactions."""

import math
import struct

import duckdb
import numpy as np
import pytest
import xxhash

from tallymart.llm import filter_audit, sharding

SF = "/root/testdata/sf0.001"


def spark_xxhash64(doc_id, shard):
    """Spark's xxhash64(long, int) with seed 42: a null is skipped, each value seeds the next."""
    seed = 42 if doc_id is None else xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42)
    return xxhash.xxh64_intdigest(struct.pack("<i", shard), seed=seed)


def brute_shard(root, doc_id):
    def draw(leaf):
        u = (spark_xxhash64(doc_id, leaf.shard) >> (64 - sharding.DRAW_BITS)) + 1
        return -math.log(u / float(1 << sharding.DRAW_BITS)) / leaf.weight

    node = root
    while node.shard is None:
        node = min(node.children, key=lambda c: min(draw(leaf) for leaf in c.leaves()))
    return node.shard


def test_shards_equal_brute_force(ready, edge_docs):
    docs = ready.read.parquet(f"{SF}/documents.parquet").unionByName(edge_docs.select("doc_id", "text", "lang", "source"), allowMissingColumns=True)
    got = sharding.shard(docs).toPandas()
    assert len(got) == docs.count()
    root = sharding.tree()
    more = sharding.grown(root)
    for doc_id, shard, grown in got[["doc_id", "shard", "grown_shard"]].itertuples(index=False):
        doc_id = None if doc_id is None or (isinstance(doc_id, float) and math.isnan(doc_id)) else int(doc_id)
        assert shard == brute_shard(root, doc_id)
        assert grown == brute_shard(more, doc_id)
        assert grown in (shard, 16)
    for _, slots in got.groupby("shard")["slot"]:
        assert sorted(slots) == list(range(len(slots)))
    assert set(got["law"]) == {"key"}


def test_shard_sizes_and_edges(ready, edge_docs, no_docs):
    got = sharding.shard(edge_docs).toPandas()
    assert len(got) == 14
    sizes = dict(zip(got["doc_id"].fillna(-1), got["size"]))
    assert sizes[4] == 1 and sizes[5] == 1 and sizes[11] == len(("élan " * 70).encode()) + 1
    assert got.loc[got["doc_id"] == 4, "text_crc32"].iloc[0] == 0
    assert sharding.shard(no_docs).count() == 0


def test_growth_moves_rows_only_into_the_new_shard(ready):
    docs = ready.range(20_000).withColumnRenamed("id", "doc_id").selectExpr("doc_id", "cast(null as string) as text")
    got = sharding.shard(docs).toPandas()
    moved = got[got["shard"] != got["grown_shard"]]
    assert set(moved["grown_shard"]) == {16}
    assert 0.04 < len(moved) / len(got) < 0.08  # about 1/17
    counts = got["shard"].value_counts()
    assert counts.min() > 0.8 * len(got) / 16


def test_positional_popcount_equals_plain_count():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3, 5, 100, 1001):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        plain = [int(((words >> b) & 1).sum()) for b in range(32)]
        assert list(filter_audit.positional_popcount(words)) == plain


def test_survival_words():
    words = filter_audit.survival_words(np.array([0, 1, 31]))
    assert words[0] == 0xFFFFFFFF
    assert words[1] == sum(1 << s for s in range(32) if not s & 1)
    assert words[2] == 1


def test_audit_equals_sql_with_edges(ready, edge_docs, edge_rows, no_docs):
    labels = ready.createDataFrame([(1, 1, 0), (1, 0, 1), (6, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(edge_docs, labels.withColumn("n", labels["doc_id"])).toPandas()
    con = duckdb.connect()
    con.register("documents", duckdb.from_query("SELECT * FROM (VALUES " + ",".join(
        "(" + ",".join("NULL" if v is None else (str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'") for v in r) + ")" for r in edge_rows
    ) + ") t(doc_id, text, lang, source)", connection=con).to_arrow_table())
    con.register("labels", labels.toPandas())
    want = con.execute(filter_audit.SQL).df()
    assert len(got) == len(want) == 600 * 4  # parts a, b, c and ''
    key = ["part", "filter_order", "step"]
    both = got.merge(want, on=key, suffixes=("", "_sql"))
    assert len(both) == len(got)
    for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"):
        assert (both[c] == both[c + "_sql"]).all(), c
    assert filter_audit.audit(no_docs, labels).count() == 0
