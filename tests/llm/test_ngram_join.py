import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallymart.llm import ngram_join
from tallymart.llm.tables import Scratch
from tallymart.llm.components import components


def shingles(text):
    lowered = (text or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}))
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return frozenset(tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))) if words else frozenset()


def brute(rows):
    """Rows (id, set size, smallest id of the component) in any order."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    shared = Counter((a, b) for held in by.values() for b in held for a in held if a < b)
    for (a, b), n in shared.items():
        if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
            parent[find(b)] = find(a)
    least = defaultdict(lambda: None)
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        if doc is not None and (least[r] is None or doc < least[r]):
            least[r] = doc
    return Counter((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows))


def near_copies(seed, n):
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 120))] for _ in range(8)]
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 7)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(900)}"
        if rng.random() < 0.4:
            words = passage + words[: rng.randrange(len(words))]
        rows.append((i, " ".join(words)))
    return rows + [(i, rows[3][1]) for i in range(n, n + 25)]


def test_equals_brute_force_with_groups_and_common_passages(ready, monkeypatch):
    monkeypatch.setattr(ngram_join, "PIVOT_ROWS", 7)  # several groups a pivot
    rows = near_copies(5, 160)
    got = ngram_join.ngram_join(ready.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute(rows)


def test_edges_and_one_row_of_each_component(edge_docs, edge_rows):
    rows = [(r[0], r[1]) for r in edge_rows]
    got = ngram_join.ngram_join(edge_docs).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute(rows)
    kept = ngram_join.keep_first(edge_docs)
    assert kept.columns == edge_docs.columns
    # 1 and 2 (twice) are one text; 7 and 8 differ in case; rows without words all stay.
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 3, 4, 5, None, None, 6, 7, 9, 10, 11])


def test_no_rows(no_docs):
    assert ngram_join.ngram_join(no_docs).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 6, 7, 19, 20, 100])
def test_linked_sets_share_enough(n):
    least = ngram_join.needed(n, 85, 100)
    assert 100 * least >= 85 * n > 100 * (least - 1)


def test_outline_never_rules_out_a_link():
    rng = np.random.default_rng(0)
    for size in (3, 40, 900, 5000):
        for changed in (0, size // 20, size // 12, size // 3):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[changed:], rng.integers(0, 2**64, changed, dtype=np.uint64)]))
            exact = ngram_join.link(a.tobytes(), b.tobytes(), 85, 100)
            assert ngram_join.may_link(ngram_join.packed(a), ngram_join.packed(b), 85, 100) or not exact
    a = np.arange(4000, dtype=np.uint64) * np.uint64(7919)
    b = np.append(a, np.arange(200, dtype=np.uint64) * np.uint64(104729) + np.uint64(1))
    assert ngram_join.may_link(ngram_join.packed(a), ngram_join.packed(b), 85, 100)  # 16 and 32 bits meet


def test_components_of_a_chain_and_a_star(ready):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)]
    got = components(ready.createDataFrame(edges, "a long, b long"), Scratch(ready, "test"), "c").collect()
    assert {r["node"]: r["label"] for r in got} == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_parities_never_rule_out_a_link(ready):
    rng = np.random.default_rng(1)
    sets, links = [], set()
    for size in (3, 63, 65, 130, 512, 540, 900, 5000):
        for changed in (0, 1, size // 20, size // 13, size // 12, size // 11, size // 3):
            for extra in (0, size // 8):
                a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
                b = np.unique(np.concatenate([a[changed:], rng.integers(0, 2**64, changed + extra, dtype=np.uint64)]))
                if ngram_join.link(a.tobytes(), b.tobytes(), 85, 100):
                    links.add(len(sets))
                sets += [a, b]
    rows = [(i, len(t), [[0]], ngram_join.parity(t).tolist()) for i, t in enumerate(sets)]
    sketches = ready.createDataFrame(rows, "row long, n long, others array<array<int>>, parity array<long>")
    pairs = ready.createDataFrame([(i, i + 1) for i in range(0, len(sets), 2)], "a long, b long")
    got = {r["a"] for r in ngram_join.near_parities(pairs, sketches, ngram_join.rows_of(ready, pairs), 85, 100).collect()}
    assert links <= got and len(links) > 40
    assert len(got - links) <= 16  # those near the limit, and of few tokens or more than PARITY_MOST


def test_pairs_that_share_a_passage_but_do_not_link_fetch_neither_prefixes_nor_sets(ready, monkeypatch):
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(150)]
    rows = [(i, " ".join(passage + [f"w{rng.randrange(10**6)}" for _ in range(100)])) for i in range(28)]
    rows += [(100 + i, t.replace("p70 ", "q ")) for i, t in rows[:3]]
    written, put = {}, Scratch.put

    def counted(self, name, df):
        out = put(self, name, df)
        written[name] = out.count()
        return out

    monkeypatch.setattr(Scratch, "put", counted)
    got = ngram_join.ngram_join(ready.createDataFrame(rows, "doc_id long, text string").repartition(2))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()) == brute(rows)
    assert written["stars-sized"] + written["rest-sized"] > 100
    assert written["stars-left"] + written["rest-left"] <= 6
