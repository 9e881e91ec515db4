"""Operators 3 and 6 against brute force."""

import math
import random

import numpy as np

from gleaner.llm import op3_embeddings
from gleaner.llm.op3_embeddings import near_duplicates
from gleaner.llm.op6_topk import ImpactIndex, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, node string, shard string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, lab, "n", "s") for i, v, lab in rows], SCHEMA)


def vectors(seed, n=240, d=16):
    rng = np.random.RandomState(seed)
    rows = []
    for i in range(n):
        if i and rng.rand() < 0.5:
            base = np.array(rows[rng.randint(len(rows))][1], np.float64)
            v = base + rng.normal(0, rng.choice([0.0, 0.02, 0.05, 0.1]), d)
        else:
            v = rng.normal(size=d)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.randint(3))))
    odd = [(900, None, 1), (901, [0.0] * d, 1), (902, [float("nan")] * d, 1), (903, [1.0] * (d - 1) + [None], 1), (904, [1.0] * d, None), (905, [], 1),
           (906, [1.0] * 5, 1), (907, [2.0] * 5, 1), (908, [float("inf")] * d, 0), (906, [1.0] * 5, 1)]
    return rows + odd


def test_links_equal_brute_force(spark):
    rows = vectors(3)
    got = near_duplicates(table(spark, rows)).collect()
    assert len(got) == len(rows)
    good = [(i, np.array(v, np.float64), lab) for i, v, lab in rows
            if v and lab is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, parent = {}, {i: i for i, _, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a, la) in enumerate(good):
        n = 0
        for y, (j, b, lb) in enumerate(good):
            if x != y and la == lb and len(a) == len(b) and a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= 0.98:
                n += 1
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
        links[i] = n
    for r in got:
        assert r.n_links == links.get(r.vec_id, 0), r
        assert r.component_id == root(r.vec_id) and r.kept == (r.vec_id == root(r.vec_id))


def test_a_crowded_label_is_searched_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(op3_embeddings, "BLOCK", 60)
    rng = np.random.RandomState(4)
    middle = rng.normal(size=16)
    rows = [(i, [float(np.float32(x)) for x in middle + rng.normal(0, 0.09, 16)], 1) for i in range(300)]
    rows += [(300 + i, [float(np.float32(x)) for x in rng.normal(size=16)], 1) for i in range(100)]
    x = np.array([v for _, v, _ in rows], np.float64)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    want = (x @ x.T >= 0.98).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in near_duplicates(table(spark, rows)).collect()}
    assert want.sum() > 10_000 and got == dict(enumerate(want.tolist()))


def test_every_vector_is_led_to():
    rng = np.random.RandomState(2)
    x = op3_embeddings.unit(np.vstack([np.ones(32) + rng.normal(0, 0.1, (700, 32)), rng.normal(size=(100, 32))]))
    head, tail = op3_embeddings.robust_prune(x)
    assert len(np.unique(tail)) == 800 and (np.diff(head) >= 0).all()
    near = np.argsort(-(x @ x.T), axis=1, kind="stable")[:, 1:16]
    edges = set(zip(head.tolist(), tail.tolist()))
    assert all(any((int(u), v) in edges for u in near[v]) for v in range(700))


def test_no_vectors(spark):
    assert near_duplicates(table(spark, [])).count() == 0
    assert near_duplicates(table(spark, [(1, None, 1)])).collect()[0].kept


def best(rows, k):
    fine = [(i, [math.floor(64 * x) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in fine:
        if q % 20 == 0:
            ranked = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in fine if j != q)[:k]
            out |= {(q, r + 1, j, -s) for r, (s, j) in enumerate(ranked)}
    return out


def test_top_k_equals_brute_force(spark):
    rows = [r for r in vectors(5) if r[0] != 906] + [(2000 + i, vectors(5)[7][1], 0) for i in range(40)]
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(table(spark, rows), k=20, block=64).collect()}
    assert got == best(rows, 20)


def test_few_candidates_and_none(spark):
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (20, [-1.0, 0.5], 1)]
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(table(spark, rows)).collect()}
    assert got == best(rows, 20)
    assert top_k(table(spark, [])).count() == 0
    assert top_k(table(spark, [(1, [1.0], 1), (3, None, 1)])).count() == 0
    lone = [(20, [], 1), (40, [], 1), (7, [3.0], 1)]
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(table(spark, lone)).collect()} == best(lone, 20)


def test_queries_in_portions_meet_all_rows(spark):
    rows = [r for r in vectors(6) if r[0] != 906]
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(table(spark, rows), k=20, block=100, portion=512).collect()}
    assert got == best(rows, 20)


def test_index_stops_early_and_stays_exact():
    rng = random.Random(1)
    v = np.array([[rng.randint(-60, 60) ** 3 // 3000 for _ in range(24)] for _ in range(700)])
    ids = np.array(rng.sample(range(5000), 700))
    index = ImpactIndex(ids, v)
    for q, (found, score) in zip(v[:30], index.search(v[:30], np.full(30, -1), 9)):
        want = sorted((-int(q @ x), int(i)) for i, x in zip(ids, v))[:9]
        assert [(-int(s), int(i)) for i, s in zip(found, score)] == want
