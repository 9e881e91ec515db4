"""Operators 4 and 2: exact round trips and plain recomputation."""

import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gleaner.llm.bpe import Encoder
from gleaner.llm.op2_mixing import _keyed, mixed_documents, mixed_rows, targets
from gleaner.llm.op4_packing import best_fit_decreasing, pack
from tests.llm.cases import awkward, documents


@pytest.fixture(scope="module")
def encoder():
    import public_tokenizers

    return Encoder(public_tokenizers.path("byte_bpe_50k.json"))


@given(st.lists(st.text(alphabet=st.sampled_from("ab'strelvmd 1\n\té!.Я漢  <|>"), max_size=40), max_size=8))
@settings(max_examples=60, deadline=None)
def test_ids_are_the_librarys(encoder, texts):
    ids, counts = encoder.encode(texts)
    want = [e.ids for e in encoder.library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts))[: len(texts)]] == want


def test_pieces_cover_every_id_once(spark, encoder):
    rows = awkward()
    got = pack(documents(spark, rows)).collect()
    want = defaultdict(list)
    for d, t, _ in rows:
        ids = np.array(encoder.library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want[d].append(ids)
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    assert pieces.keys() == want.keys()
    for d, texts in want.items():
        left = sorted((r.doc_tokens, r.start, r.length, r.ids_crc32) for r in pieces[d])
        made = []
        for ids in texts:
            starts = [s for n, s, _, _ in left if n == len(ids)]
            for s in sorted(set(starts)):
                length = next(ln for n, s2, ln, _ in left if n == len(ids) and s2 == s)
                made.append((len(ids), s, length, zlib.crc32(ids[s : s + length].tobytes())))
            assert sum(m[2] for m in made if m[0] == len(ids)) >= len(ids)
        assert sorted(made) == left
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 1024


@given(st.lists(st.integers(1, 64), max_size=80))
@settings(max_examples=100, deadline=None)
def test_best_fit_decreasing_fits_and_is_tight(sizes):
    placed = best_fit_decreasing(sizes, 64)
    rooms: list[int] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):  # the plain rule
        fitting = [r for r in rooms if r >= sizes[i]]
        if fitting:
            rooms[rooms.index(min(fitting))] -= sizes[i]
        else:
            rooms.append(64 - sizes[i])
    loads = defaultdict(int)
    for size, (window, _) in zip(sizes, placed):
        loads[window] += size
    assert sorted(loads.values()) == sorted(64 - r for r in rooms)


def test_packing_an_empty_table(spark):
    assert pack(documents(spark, [])).count() == 0


def water(sizes, weights=(5, 2, 1), most=3):
    """Targets by resharing until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total = sum(sizes.values())
    capped = {}
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            return capped
        rest = total - sum(capped.values())
        t = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if t[s] > most * sizes[s]]
        if not over:
            return capped | t
        capped |= {s: most * sizes[s] for s in over}


@given(st.dictionaries(st.one_of(st.none(), st.sampled_from([f"s{i}" for i in range(9)])), st.integers(0, 500), min_size=1, max_size=8))
@settings(max_examples=8, deadline=None)
def test_targets_equal_resharing(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in targets(df).collect()}
    assert got == pytest.approx(water(sizes))


def test_mix_keeps_to_targets(spark):
    rows = [r for r in awkward(n=200) if r[0] is not None]
    docs = documents(spark, rows)
    got = mixed_rows(docs).collect()
    assert len(got) == len(rows)
    size = defaultdict(int)
    for _, t, s in rows:
        size[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = water(size)
    source_of = {}
    for d, _, s in rows:
        source_of[d] = s
    taken = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        assert r.source_size == size[source_of[r.doc_id]] and r.target == pytest.approx(want[source_of[r.doc_id]])
        taken[source_of[r.doc_id]] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= 1
    again = sorted((str(r.doc_id), r.taken) for r in mixed_rows(docs).collect())
    assert again == sorted((str(r.doc_id), r.taken) for r in got)


def test_words_taken_equal_brute_force(spark):
    rows = [(i, t, s) for i, (_, t, s) in enumerate(awkward(n=300))]
    docs = documents(spark, rows)
    keyed = [(r.source, r._key, r.doc_id, r._size) for r in _keyed(docs.select("doc_id", "source", "text"), 7).collect()]
    size = defaultdict(int)
    for s, _, _, n in keyed:
        size[s] += n
    want = {}
    for s, target in water(size).items():
        wanted = math.floor(target + 0.5)
        epochs, left = divmod(wanted, max(size[s], 1))
        left = wanted - epochs * size[s]
        for _, doc, n in sorted((k, d, n) for x, k, d, n in keyed if x == s):
            part = max(0, min(n, left))
            left -= n
            want[doc] = epochs * n + part
    assert {r.doc_id: r.taken for r in mixed_rows(docs).collect()} == want


def test_mixed_documents_hold_the_words_taken(spark):
    rows = [r for r in awkward(n=120) if r[0] is not None]
    docs = documents(spark, rows)
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in out.collect())
    assert words == sum(r.taken for r in mixed_rows(docs).collect())


def test_mixing_an_empty_table(spark):
    assert mixed_rows(documents(spark, [])).count() == 0
