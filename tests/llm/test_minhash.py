"""Operator 7 against brute force over all pairs."""

import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from gleaner.llm.components import connected_components
from gleaner.llm.op7_minhash import _neighbours, near_duplicates, recall, stage
from tests.llm.cases import awkward, documents

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if len(words) >= k:
        return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return frozenset([tuple(words)] if words else [])


def brute(rows, k, percent):
    ids = sorted({d for d, _, _ in rows if d is not None})
    texts = {}
    for d, t, _ in rows:
        if d is not None:
            texts.setdefault(d, []).append(sets_of(t, k))
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    every = [(i, s) for i in ids for s in texts[i] if s]
    for x in range(len(every)):
        for y in range(x):
            (i, a), (j, b) = every[x], every[y]
            n = len(a & b)
            if 100 * n >= percent * (len(a) + len(b) - n):
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def near_copies(seed, groups=12):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, doc = [], 1000
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(20, 200))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((doc, " ".join(copy), f"s{g % 3}"))
            doc += 1
    return rows


def test_components_equal_brute_force(spark):
    rows = awkward() + near_copies(1)
    got = near_duplicates(documents(spark, rows), 3, 85).collect()
    want = brute(rows, 3, 85)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == want[r.doc_id])
    sizes = {d: len(sets_of(t, 3)) for d, t, _ in rows}
    assert all(r.n_shingles == sizes[r.doc_id] for r in got if r.doc_id is not None)


def test_one_large_group_of_near_copies_is_one_component(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(300)}" for _ in range(150)]
    rows = []
    for i in range(400):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy), "s"))
    want = brute(rows, 3, 85)
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(spark, rows), 3, 85).collect()}
    assert got == want


def test_links_among_many_documents_of_one_boilerplate(spark):
    rng = random.Random(6)
    own = lambda n: [f"x{rng.randrange(10**9)}" for _ in range(n)]
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(base + own(21)), "s") for i in range(560)]
    for i in range(600, 680, 2):
        shared = own(8)
        rows += [(i, " ".join(base + shared + own(13)), "s"), (i + 1, " ".join(base + shared + own(13)), "s")]
    rng.shuffle(rows)
    rows = [(i, t, s) for i, (_, t, s) in enumerate(rows)]
    want = brute(rows, 3, 85)
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(spark, rows), 3, 85).collect()}
    assert len(set(want.values())) == 600 and got == want


def test_recall_is_measured_on_a_sample(spark):
    docs = documents(spark, near_copies(3, 20))
    found = near_duplicates(docs, 3, 85)
    got, there = recall(docs, found, 3, 85)
    assert got == there > 20
    none = found.withColumn("component_id", F.col("doc_id"))
    assert recall(docs, none, 3, 85, sample=500) == (0, recall(docs, found, 3, 85, sample=500)[1])


def test_neighbours_of_a_sorted_order():
    one, two, three = 1 << 42, 1 << 21, 1
    rows = {"key": [1, 1, 1, 1, 2, 3, 3], "tail": [0, one, one + two, one + two, 5, 7 * two, 7 * two + three], "id": [10, 11, 12, 13, 20, 30, 31], "n": [5, 6, 7, 8, 9, 1, 2]}
    whole = pa.RecordBatch.from_pydict(rows)
    want = {(10, 11): 0, (11, 12): 1, (12, 13): 3, (30, 31): 2}
    want |= {(b, a): d for (a, b), d in want.items()}
    for cuts in ([7], [1, 1, 1, 1, 1, 1, 1], [3, 4], [2, 3, 2]):
        at, frames = 0, []
        for c in cuts:
            frames.append(whole.slice(at, c))
            at += c
        got = [r for batch in _neighbours(iter(frames)) for r in batch.to_pylist()]
        assert {(r["x"], r["y"]): r["depth"] for r in got} == want and len(got) == len(want)
        sizes = dict(zip(rows["id"], rows["n"]))
        assert all(sizes[r["x"]] == r["nx"] and sizes[r["y"]] == r["ny"] for r in got)


def test_stage_keeps_one_of_each_group_and_the_columns(spark):
    rows = near_copies(2) + [(1, None, None), (2, "", "s")]
    docs = documents(spark, rows)
    out = stage(spark, docs, "")
    want = brute(rows, 5, 80)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({v for v in want.values()})


def test_empty_table(spark):
    assert near_duplicates(documents(spark, []), 3, 85).count() == 0


def test_components_of_chains_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (201, 200), (None, 5)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.id: r.component for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {200: 200, 201: 200}
