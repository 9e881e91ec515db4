"""Precision and recall on some thousand rows with planted keys, identifiers and near vectors, by kind."""

import random

import numpy as np

from tests.llm.cases import documents

LOWER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "0123456789"


def prose(rng, n):
    return " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_random_keys_by_encoding(spark):
    from gleaner.llm.op1_secrets import scan

    rng = random.Random(31)
    alphabets = {"base64": (LOWER + LOWER.upper() + DIGITS + "+/", 64), "base32": (LOWER.upper() + "234567", 56), "lower": (LOWER + DIGITS, 50), "HEX": (DIGITS + "ABCDEF", 64)}
    parts = "customer payment account identifier reference transaction number history settings archive report internal monthly summary".split()
    rows, planted = [], {}
    for i in range(3000):
        decoy = rng.choice(["_", "-", "/"]).join(rng.choice(parts) for _ in range(4)) + str(rng.randint(1, 99))
        text = f"{prose(rng, 12)} {decoy} {prose(rng, 8)}"
        if i % 15 == 0:
            kind = list(alphabets)[i // 15 % 4]
            letters, size = alphabets[kind]
            key = "".join(rng.choice(letters) for _ in range(size))
            planted[i] = (kind, len(text) + 6, len(text) + 6 + size)
            text += f" kept {key} here"
        rows.append((i, text, "s"))
    got = {r.doc_id: {tuple(s.split(":")) for s in r.spans.split(",") if s.startswith("random")} for r in scan(documents(spark, rows)).collect()}
    right = {kind: 0 for kind in alphabets}
    for i, (kind, start, end) in planted.items():
        right[kind] += ("random", str(start), str(end)) in got[i]
    found = sum(map(len, got.values()))
    assert found and sum(right.values()) / found >= 0.99, (right, found)
    assert all(n >= 45 for n in right.values()), right  # of 50


def test_identifiers_in_learned_contexts_by_kind(spark):
    from gleaner.llm.op9_pii import scan

    rng = random.Random(32)
    digits = lambda n: "".join(rng.choice(DIGITS) for _ in range(n))
    name = lambda: "".join(rng.choice(LOWER) for _ in range(6))
    seeds = {"phone": lambda: f"please dial +1 (555) {digits(7)} today", "email": lambda: f"please write {name()}@{name()}.org today", "ip": lambda: f"from host 10.{rng.randint(0, 255)}.{rng.randint(0, 255)}.1 today"}
    unseen = {"phone": lambda: ("please dial ", f"555 {digits(4)} {digits(4)}"), "email": lambda: ("please write ", f"{name()}_{name()}"), "ip": lambda: ("from host ", f"10.{rng.randint(256, 999)}.0.{rng.randint(256, 999)}")}
    decoys = [lambda: f"order {digits(9)} shipped", lambda: f"the file {name()}_{name()} is here", lambda: f"version 1.{rng.randint(256, 999)}.0.2 is out"]
    rows, planted = [], {}
    for i in range(3000):
        text = f"{prose(rng, 10)}. {rng.choice(decoys)()}. {prose(rng, 5)}. "
        if i % 5 == 0:
            text += rng.choice(list(seeds.values()))()
        elif i % 30 == 1:  # a pattern is trusted where four in five of its instances are seeds
            kind = list(unseen)[i // 30 % 3]
            before, value = unseen[kind]()
            planted[i] = f"{kind}_context:{len(text) + len(before)}:{len(text) + len(before) + len(value)}"
            text += f"{before}{value} today"
        rows.append((i, text, "s"))
    got = {r.doc_id: [s for s in r.spans.split(",") if "_context" in s] for r in scan(documents(spark, rows)).collect()}
    found = sum(map(len, got.values()))
    right = {kind: [planted[i] in got[i] for i in planted if planted[i].startswith(kind)] for kind in unseen}
    hits = sum(sum(v) for v in right.values())
    assert found and hits / found >= 0.95, (found, hits)
    assert all(sum(v) >= 0.95 * len(v) for v in right.values()), {k: (sum(v), len(v)) for k, v in right.items()}


def test_near_vectors(spark):
    from gleaner.llm.op3_embeddings import near_duplicates

    rng = np.random.RandomState(33)
    x = rng.normal(size=(4000, 32))
    pairs = [(i, 3000 + i) for i in range(300)]
    for i, j in pairs:
        x[j] = x[i] + rng.normal(size=32) * 0.08
    x = x.astype(np.float32)
    rows = [(i, [float(v) for v in row], i % 3 if i < 3000 else (i - 3000) % 3, "n") for i, row in enumerate(x)]
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, node string")).collect()}
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(near, False)
    assert near.sum() >= 500 and [got[i][0] for i in range(4000)] == near.sum(axis=1).tolist()
    for i, j in pairs:
        assert (got[i][1] == got[j][1]) == bool(near[i, j])
