"""Operators 11 to 13 against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from gleaner.llm import op11_decontaminate, op12_spelling, op13_lexical
from gleaner.llm.op11_decontaminate import FMIndex, WaveletTree, contaminated, suffix_order
from gleaner.llm.op12_spelling import variants
from gleaner.llm.op13_lexical import length_share, ranked
from tests.llm.cases import awkward, documents

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII)))


def items(spark, rows):
    return spark.createDataFrame([(i, t, -1, "y") for i, t in rows], "item_id long, text string, n_words long, score string")


def asked(rows):
    """Items with windows of the documents, short ones, repeats, and ones that are nowhere."""
    texts = [t for _, t, _ in rows if t and len(t.split()) > 20]
    rng, out = random.Random(9), [(1, None), (2, ""), (3, "!?"), (4, "one"), (4, "one"), (None, "alpha beta"), (5, "ALPHA, beta"), (6, "nowhere at all"), (7, "no id here at all")]
    for i in range(20):
        words = rng.choice(texts).split()
        at = rng.randrange(len(words) - 12)
        out.append((100 + i, " ".join(words[at : at + rng.randint(3, 12)]).upper() + (" tail words " * (i % 3))))
    return [*out, (300, "word " * 10), (301, "x" * 120000)]


def test_suffixes_and_ranks_equal_sorting_and_counting():
    rng = np.random.RandomState(1)
    for n, sigma in ((1, 1), (2, 2), (300, 3), (500, 40), (257, 2)):
        symbols = np.append(rng.randint(0, max(1, sigma - 1), n - 1), sigma - 1).astype(np.int64) if n > 1 else np.zeros(1, np.int64)
        plain = sorted(range(n), key=lambda i: symbols[i:].tolist())
        assert suffix_order(symbols, sigma).tolist() == plain
        tree = WaveletTree(symbols, sigma)
        at = rng.randint(0, n + 1, 60)
        asked_for = rng.randint(0, sigma, 60)
        assert tree.rank(asked_for, at).tolist() == [int((symbols[:i] == c).sum()) for c, i in zip(asked_for, at)]
        symbol, rank = tree.access(np.arange(n))
        assert symbol.tolist() == symbols.tolist() and rank.tolist() == [int((symbols[:i] == symbols[i]).sum()) for i in range(n)]
        index = FMIndex(symbols, sigma)
        for _ in range(30 if sigma > 1 else 0):  # no phrase holds the last symbol
            length = rng.randint(1, 4)
            phrase = rng.randint(0, sigma - 1, length)
            row = np.concatenate([np.full(4 - length, -1), phrase])[None, :]
            low, high = index.search(row)
            found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
            assert found == [i for i in range(n - length + 1) if symbols[i : i + length].tolist() == phrase.tolist()]


def plain_hits(docs, bench, width=10):
    windows = {}
    for item, text in bench:
        words = tuple(m.group() for m in tokens(text))
        for i in range(max(1, len(words) - width + 1)) if words else ():
            windows.setdefault(words[i : i + width], set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text, _ in docs:
        found = tokens(text)
        words, hit, own = [m.group() for m in found], set(), set()
        for i in range(len(words)):
            for n in sizes:
                if i + n <= len(words) and (got := windows.get(tuple(words[i : i + n]))):
                    hit.update(range(i, i + n))
                    own |= got
        runs = [i for i in sorted(hit) if i - 1 not in hit]
        ends = [i + 1 for i in sorted(hit) if i + 1 not in hit]
        spans = [(a, b, found[a].start(), found[b - 1].end()) for a, b in zip(runs, ends)]
        out.append((doc, len(words), spans, sorted(own - {None})))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 18, 20])
def test_contaminated_words_equal_plain_search(spark, block):
    rows = awkward()
    bench = asked(awkward())
    got = contaminated(documents(spark, rows), items(spark, bench), block=block).collect()
    assert sorted(((r.doc_id, r.n_words, [tuple(s) for s in r.spans], list(r["items"])) for r in got), key=repr) == plain_hits(rows, bench)


def test_shards_of_long_texts_overlap(monkeypatch):
    import pyarrow as pa

    rng = random.Random(4)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in (0, 1, 400, 9, 10, 333, 0)]
    words = op11_decontaminate.Words(texts)
    phrases = [texts[2][:19], texts[5][-19:], "a b", "c"]
    hashes = [op11_decontaminate.Words([p]).hash.view(np.int64).tolist() for p in phrases]
    rows = pa.table({"words": pa.array(hashes, pa.list_(pa.int64())), "item_id": pa.array([1, 2, 3, None], pa.int64())})
    whole = op11_decontaminate._found(words, op11_decontaminate.Phrases(rows, 10))
    monkeypatch.setattr(op11_decontaminate, "SHARD", 50)
    parted = op11_decontaminate._found(words, op11_decontaminate.Phrases(rows, 10))
    assert whole[0].tolist() == parted[0].tolist() and whole[1] == parted[1] and whole[0].any()


def test_empty_tables_of_documents_or_items(spark):
    none, rows = documents(spark, []), documents(spark, [(1, "a b", "s")])
    assert contaminated(none, items(spark, [(1, "a")])).count() == 0
    assert [tuple(r) for r in contaminated(rows, items(spark, [])).collect()] == [(1, 2, [], [])]
    assert ranked(none, items(spark, [(1, "a")])).count() == 0 and ranked(rows, items(spark, [])).count() == 0
    assert variants(none).count() == 0


def plain_ranks(docs, bench, k=10):
    counted = [(d, Counter(m.group() for m in tokens(t))) for d, t, _ in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    big_n, big_l = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in set(bench_rows(bench)):
        scores = []
        for d, c, n in counted:
            m = 100 - 75 + (75 * n * big_n) // big_l
            s = sum(math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t.group()] + 1))) * ((10**9 * c[t.group()]) // (1000 * c[t.group()] + 8 * m))
                    for t in tokens(text) if t.group() in c)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def bench_rows(bench):
    return [(i, t or "") for i, t in bench]


@pytest.mark.parametrize("block", [1 << 20, 25])
def test_ranks_equal_scoring_all_documents(spark, block):
    rows = awkward()
    bench = asked(rows)
    got = ranked(documents(spark, rows), items(spark, bench), block=block).collect()
    assert sorted(map(tuple, got), key=repr) == plain_ranks(rows, bench)


def test_ranks_in_many_small_shards():
    rng = np.random.RandomState(2)
    n, terms = 400, 30
    m = rng.randint(26, 400, n)
    tf = rng.poisson(0.4, (n, terms))
    doc, term = np.nonzero(tf)
    shard = op13_lexical.Shard(np.arange(n), m, term, doc, tf[doc, term], terms)
    weight = rng.randint(0, 9000, 6)
    asked_for = rng.choice(terms, 6, replace=False)
    exact = sum(w * (10**9 * tf[:, t] // (1000 * tf[:, t] + 8 * m)) for t, w in zip(asked_for, weight))
    best = np.sort(exact)[::-1]
    for reached in (0, int(best[4])):
        docs, scores = shard.best(asked_for, weight, 10, reached)
        assert scores.tolist() == exact[docs].tolist()
        assert set(np.flatnonzero(exact >= max(best[9], reached))) <= set(docs.tolist())
    assert length_share(np.array([10**9]), 10**11, 10**13).tolist() == [25 + 75 * 10**9 * 10**11 // 10**13]


def plain_variants(docs):
    counts = Counter()
    for doc, text, _ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    links = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(links[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(links[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def test_variants_equal_all_pairs(spark, monkeypatch):
    rng = random.Random(3)
    stems = ["banana", "bananas", "aaaaaa", "aaaaa", "aaaaaaa", "straße", "strasse", "element", "ababab", "bababa", "éléphant", "elephant", "Tête-à-tête", "quick×fox"]

    def typed():
        w = rng.choice(stems)
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abeé") + w[i:], w[:i] + rng.choice("abn") + w[i + 1 :]])
        return rng.choice([w, w.upper(), w])

    rows = [*awkward(), *[(6000 + i, " ".join(typed() for _ in range(80)), "s") for i in range(60)], (None, "banana banana", "s")]
    got = variants(documents(spark, rows)).collect()
    expected = plain_variants(rows)
    assert sorted(map(tuple, got)) == expected and len(expected) > 200
    assert any(r[1] and r[2] != r[1] for r in expected)


def test_prefixes_of_words_one_edit_apart_meet():
    """The three rarest bigrams and repeats of the third suffice under any order."""
    rng = random.Random(7)
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(5, 9)))
        i = rng.randrange(len(a))
        b = rng.choice([a[:i] + a[i + 1 :], a[:i] + rng.choice("abc") + a[i + 1 :]])
        if a == b or len(b) < 5:
            continue
        grams = sorted({w[j : j + 2] for w in (a, b) for j in range(len(w) - 1)}, key=lambda g: rng.random())
        order = {g: n for n, g in enumerate(grams)}
        long, short = op12_spelling.prefix_of(a, order), op12_spelling.prefix_of(b, order)
        near = {0: {0}, 1: {0, 1}}[len(a) - len(b)]
        assert any(g == h and p - q in near for g, p in long for h, q in short)
