"""Operators 5, 8 and 10: held-out accuracy, plain recomputation, and the pipeline."""

import itertools
import math
import random
import re
import zlib

import numpy as np

import corpus_pipeline
from gleaner.llm import op5_quality, op8_toxicity, op10_licenses
from tests.llm.cases import awkward, documents


def corpus(n=400, seed=2):
    rng = random.Random(seed)
    words = "the quick brown fox jumps over lazy dogs while many people read books near rivers and hills".split()
    rows, labels = [], []
    for i in range(n):
        lines = [" ".join(rng.choice(words) for _ in range(rng.randint(4, 14))) + "." for _ in range(rng.randint(1, 6))]
        quality, toxic = 1, 0
        if i % 5 == 0:
            quality = 0
            lines = [rng.choice(["BUY!! NOW!! CHEAP!!", "x | y | z | w | q", "a$$$ b%%% c&&& d###", "go go go go go go go go"]) for _ in lines]
        if i % 4 == 1:
            toxic = 1
            lines[0] = f"you are an {rng.choice(['idiot', 'moron', 'scum'])} {lines[0]}"
        rows.append((i, "\n".join(lines), f"s{i % 7}"))
        if i % 10 != 9:
            labels.append((i, quality, toxic))
    return rows, labels


def label_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def fold(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def check_scores(rows, got, labels, column, threshold, least):
    assert len(got) == len(rows)
    truth = {d: (q, t)[column] for d, q, t in labels}
    right = []
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= threshold) and r.held_out == fold(r.doc_id)
        if r.held_out and r.doc_id in truth:
            right.append(r.predicted == truth[r.doc_id])
    assert np.mean(right) >= least


def test_quality_on_held_out_rows(spark):
    rows, labels = corpus()
    rows += [(d if d is None else d + 10_000, t, s) for d, t, s in awkward()]
    docs = documents(spark, rows)
    check_scores(rows, op5_quality.score(docs, op5_quality.train(docs, label_table(spark, labels))).collect(), labels, 0, 0.5, 0.95)


def test_toxicity_on_held_out_rows(spark):
    rows, labels = corpus()
    rows += [(d if d is None else d + 10_000, t, s) for d, t, s in awkward()]
    docs = documents(spark, rows)
    check_scores(rows, op8_toxicity.score(docs, op8_toxicity.train(docs, label_table(spark, labels))).collect(), labels, 1, 0.7, 0.95)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    rows, labels = corpus(120)
    docs = documents(spark, rows)
    turned = [(d, 1 - q, 1 - t) if fold(d) else (d, q, t) for d, q, t in labels]
    for op in (op5_quality, op8_toxicity):
        a, b = (sorted((r.doc_id, r.score) for r in op.score(docs, op.train(docs, label_table(spark, x))).collect()) for x in (labels, turned))
        assert a == b


def test_no_labels_and_no_rows(spark):
    docs, none = documents(spark, awkward()), label_table(spark, [])
    assert {r.score for r in op5_quality.score(docs, op5_quality.train(docs, none)).collect()} == {0.5}
    assert op8_toxicity.score(docs, op8_toxicity.train(docs, none)).count() == len(awkward())
    empty = documents(spark, [])
    assert op5_quality.score(empty, op5_quality.train(empty, none)).count() == 0
    assert op8_toxicity.score(empty, op8_toxicity.train(empty, none)).count() == 0
    assert op10_licenses.scan(empty).count() == 0


def test_forward_backward_equals_enumeration():
    rng = np.random.RandomState(0)
    lengths = np.array([3, 1, 4])
    unary, step = rng.normal(size=8), rng.normal(size=(2, 2))
    good, pair = op5_quality.Chains(lengths).run(unary, step)
    at = 0
    for n in lengths:
        u = unary[at : at + n]
        mass, marginal, joint = 0.0, np.zeros(n), np.zeros((n, 2, 2))
        for y in itertools.product((0, 1), repeat=int(n)):
            w = np.exp(sum(u[i] * y[i] for i in range(n)) + sum(step[y[i - 1], y[i]] for i in range(1, n)))
            mass += w
            marginal += w * np.array(y)
            for i in range(1, n):
                joint[i, y[i - 1], y[i]] += w
        assert np.allclose(good[at : at + n], marginal / mass)
        assert np.allclose(pair[at : at + n], joint / mass)
        at += n


def words_run(text):
    """Pattern totals of a text by the seed lexicon."""
    x = op8_toxicity.Grammar({}, {}).features([text])[0]
    return dict(zip(op8_toxicity.PATTERNS, np.expm1(x[:-1]).round(6)))


def test_clause_grammar():
    assert words_run("you are an idiot") == {"insult": 0, "insult_target": 1.5, "threat_target": 0, "negated": 0, "reported": 0}
    assert words_run("what an idiot")["insult"] == 1
    assert words_run("idiot like you")["insult_target"] == 1.5
    assert words_run("I will kill you")["threat_target"] == 1.5
    for harmless in ("the plant will die this week", "You kill the process", "they kill", "a plain text"):
        assert not any(words_run(harmless).values())
    assert words_run("you are not an idiot")["negated"] == 0.25 and words_run("you are not an idiot")["insult_target"] == 0
    assert words_run("that idea is not bad, you idiot")["insult_target"] == 1.5
    assert words_run("he said you are scum")["reported"] == 0.5
    assert words_run("not at all in any way scum")["insult"] == 1


def test_wishes_passives_reflexives_and_objects():
    for threat in ("I hope you die", "go to hell", "you people should be killed", "kill yourself", "You will be hurt", "I wish they would suffer", "you deserve to get beaten", "shoot you now"):
        assert words_run(threat)["threat_target"] == 1.5, threat
    for harmless in ("shoot you an email", "I will beat you at chess", "go to the shop", "I hope you win", "he was killed in an accident", "we hope the plan may die", "you will be early", "kill you in that game"):
        assert not any(words_run(harmless).values()), harmless
    assert words_run("you will not be hurt") == {"insult": 0, "insult_target": 0, "threat_target": 0, "negated": 0.25, "reported": 0}
    agreed = words_run("he said it is fine and I agree you moron")
    assert agreed["insult_target"] == 1.5 and agreed["reported"] == 0
    assert words_run("he said that and you are a moron")["reported"] == 0.5
    assert words_run("I will beat you at chess you idiot")["insult_target"] == 1.5


def test_a_document_scores_as_recomputed_from_words_and_weights():
    """Features, totals and score of a text from its clauses, by the best path of every one."""
    grammar = op8_toxicity.Grammar({"zork": 0.6}, {"grum": 0.4})
    grammar.coefficients = np.array([-2.0, 1.0, 1.5, 2.0, 0.3, 0.2, 0.7])
    text = "You are a zork. He said grumble, you idiot! Nothing here; kill them all\nplain words only"
    kinds = {"you": 2, "he": 2, "them": 2, "said": 4, "zork": 0, "idiot": 0, "grumble": 0, "kill": 1}
    weights = {"zork": 0.6, "grumble": 0.4, "idiot": 1.0, "kill": 1.0}
    totals, hits, clauses = dict.fromkeys(op8_toxicity.PATTERNS, 0.0), 0, re.split(r"[.!;\n]", text)
    for clause in clauses:
        tokens = re.findall(r"\w+|,", clause.lower())
        path = brute_best([6 if t == "," else kinds.get(t, 5) for t in tokens], [weights.get(t, 0.0) for t in tokens])
        name, value = max(path.items(), key=lambda kv: kv[1])
        if name:
            totals[name] += value
            hits += 1
    x = [*(math.log1p(totals[p]) for p in op8_toxicity.PATTERNS), hits / len(clauses)]
    assert np.allclose(grammar.features([text])[0], x) and hits == 3
    z = -2.0 + np.dot(x, [1.0, 1.5, 2.0, 0.3, 0.2, 0.7])
    assert abs(grammar.scores([text])[0] - 1 / (1 + math.exp(-z))) < 1e-12


def test_plain_words_out_of_reach_change_nothing():
    rng = random.Random(14)
    words = ["you", "idiot", "kill", "not", "said", "and", "i", "hope", "die", "be", "killed", "go", "hell", "email", ","] + ["plain"] * 25
    grammar = op8_toxicity.Grammar({}, {})
    h, kinds, weights, *_ = grammar._tables()
    table = dict(zip(h.tolist(), zip(kinds.tolist(), weights.tolist())))
    for _ in range(150):
        clause = [rng.choice(words) for _ in range(rng.randint(1, 40))]
        tokens = [w for w in clause if w != ","]
        if not tokens:
            continue
        kind = [(6, 0.0) if w == "," else table.get(int(op8_toxicity._hash_words([w])[0]), (5, 0.0)) for w in clause]
        while kind and kind[0][0] == 6:  # a mark before the first word parts nothing
            kind.pop(0)
        kind = [k for i, k in enumerate(kind) if k[0] != 6 or (i + 1 < len(kind) and kind[i + 1][0] != 6)]  # one break for several marks
        for alone, partners in op8_toxicity.PARTNERS:
            if not any(k in partners for k, _ in kind):
                kind = [(5, 0.0) if k in alone else (k, w) for k, w in kind]
        want = op8_toxicity.clause_patterns([k for k, _ in kind], [w for _, w in kind])
        loud = any(op8_toxicity.CLASSES[k] in op8_toxicity.LOUD for k, _ in kind)
        got = words_run(" ".join(clause))
        assert got == {p: round(v, 6) if loud else 0 for p, v in want.items()}, clause


def brute_best(kinds, weights):
    """The best path by trying every path of the cascade, one transducer after another."""
    best = {}

    def walk(i, states, total):
        if i == len(kinds):
            if all(s in part.finals for s, part in zip(states, op8_toxicity.PARTS)):
                name = op8_toxicity.PARTS[-1].finals[states[-1]]
                best[name] = max(best.get(name, -1e9), total)
            return

        def through(k, symbol, after, gained):
            if k == len(op8_toxicity.PARTS):
                walk(i + 1, tuple(after), total + gained)
                return
            for state, read, out, constant, multiple, to in op8_toxicity.PARTS[k].arcs:
                if state == states[k] and read == symbol:
                    through(k + 1, out, [*after, to], gained + constant + multiple * weights[i])

        through(0, op8_toxicity.CLASSES[kinds[i]], [], 0.0)

    walk(0, (0,) * len(op8_toxicity.PARTS), 0.0)
    return best


def test_best_paths_equal_enumeration():
    rng = random.Random(8)
    clauses = [[rng.choice(range(7)) for _ in range(rng.randint(1, 6))] for _ in range(120)]
    weights = [[round(rng.uniform(0.1, 1), 3) for _ in c] for c in clauses]
    found, value = op8_toxicity.AUTOMATON.best(
        np.array(sum(clauses, [])), np.array(sum(weights, [])), np.array([len(c) for c in clauses]))
    for kinds, w, pattern, total in zip(clauses, weights, found, value):
        best = brute_best(kinds, w)
        name = (*op8_toxicity.PATTERNS, "")[pattern]
        assert abs(max(best.values()) - total) < 1e-9 and abs(best[name] - total) < 1e-9


def test_licenses_are_found_by_wording(spark):
    rows = awkward() + [
        (2001, "some text\nLicensed under the Apache License, Version 2.0.\nmore", "s"),
        (2002, "Licensed under CC BY-NC 4.0.", "s"), (2003, "a license to drive is required here", "s"),
        (2004, "This work is licensed under the GNU General Public License, version 2.", "s"),
        (2005, op10_licenses.TEMPLATES["MIT"][3].replace(" any person", " any new person").replace(", subject", "\n subject"), "s"),
    ]
    got = {r.doc_id: r for r in op10_licenses.scan(documents(spark, rows)).collect()}
    names = {i: re.sub(r":\d+", "", got[i].licenses) for i in range(2001, 2006)}
    assert names == {2001: "Apache-2.0", 2002: "CC-BY-NC-4.0", 2003: "", 2004: "GPL-2.0", 2005: "MIT"}
    text = rows[-5][1]
    _, start, end = got[2001].licenses.split(":")
    assert text[int(start) : int(end)] == "Licensed under the Apache License, Version 2.0"
    assert got[2005].added == 1
    assert sum(r.n_licenses for i, r in got.items() if i is not None and i < 2000) == 0


def test_a_license_is_found_amid_long_running_text(spark):
    rng = random.Random(12)
    prose = lambda n: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(n))
    rows, want = [], {}
    names = ["Apache-2.0", "MIT", "ISC", "all-rights-reserved"]
    for i, (n, name) in enumerate((n, name) for n in (60, 120, 400, 3000) for name in names):
        before, notice = prose(n // 2), op10_licenses.TEMPLATES[name][-1]
        rows.append((i, f"{before} {notice} {prose(n // 2)}", "s"))
        want[i] = f"{name}:{len(before) + 1}:{len(before) + 1 + len(notice.rstrip('.:'))}"
    got = {r.doc_id: r.licenses for r in op10_licenses.scan(documents(spark, rows)).collect()}
    assert got == want


def test_near_versions_and_denials_are_no_licenses(spark):
    rows = [
        (1, "This work is licensed under the GNU General Public License, version 4.", "s"),
        (2, "This code is not licensed under the terms of the MIT license", "s"),
        (3, "Licensed under CC BY 3.0.", "s"), (4, "This work is licensed under the GNU General Public License, version 2.", "s"),
    ]
    got = {r.doc_id: re.sub(r":\d+", "", r.licenses) for r in op10_licenses.scan(documents(spark, rows)).collect()}
    assert got == {1: "", 2: "", 3: "", 4: "GPL-2.0"}


def plain_find(text):
    """Every place where a template stands word for word, longest first, none overlapping."""
    words = op10_licenses.words_of(text)
    spans = []
    for name, wordings in op10_licenses.TEMPLATES.items():
        for wording in wordings:
            want = [w for w, _, _ in op10_licenses.words_of(wording)]
            for i in range(len(words) - len(want) + 1):
                if [w for w, _, _ in words[i : i + len(want)]] == want:
                    spans.append((len(want), i, i + len(want), name))
    out, taken = [], set()
    for _, a, b, name in sorted(spans, key=lambda s: (-s[0], s[1])):
        if not taken & set(range(a, b)):
            taken |= set(range(a, b))
            out.append(f"{name}:{words[a][1]}:{words[b - 1][2]}")
    return sorted(out, key=lambda s: int(s.split(":")[1]))


def test_exact_notices_equal_brute_force(spark):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("bcdfgklmnrst") for _ in range(rng.randint(2, 8)))
    every = [w for ws in op10_licenses.TEMPLATES.values() for w in ws]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(1, 6)):
            parts.append(rng.choice(every) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(1, 40))))
            parts.append(rng.choice([" ", "\n", " - ", "\n\n"]))
        rows.append((i, "".join(parts), "s"))
    got = {r.doc_id: r for r in op10_licenses.scan(documents(spark, rows)).collect()}
    cue = re.compile(op10_licenses.CUE, re.I)
    for i, text, _ in rows:
        want = [s for s in plain_find(text) if cue.search(text)]
        assert got[i].licenses == ",".join(want), (text, want)


def test_wrapped_and_commented_texts_are_found_whole(spark, monkeypatch):
    import textwrap

    apache = next(t for t in op10_licenses.TEMPLATES["Apache-2.0"] if "AS IS" in t)
    header = "\n".join("# " + line for line in textwrap.wrap(apache, 60))
    paragraphs = op10_licenses._MIT.replace("conditions: ", "conditions:\n\n").replace("Software. THE", "Software.\n\nTHE")
    bsd = textwrap.fill(op10_licenses._BSD_START + op10_licenses._BSD_END, 50).replace("\n", "\n * ")
    rows = [
        (1, f"#!/bin/sh\n#\n{header}\n#\necho hello", "s"), (2, f"MIT License\n\nCopyright (c) 2024 A Person\n\n{paragraphs}", "s"), (3, f"/* {bsd}\n */ int main", "s"),
        (4, "dual licensed under the MIT License or the Apache License, Version 2.0", "s"), (5, "// SPDX-License-Identifier: Apache-2.0", "s"),
        (6, "SPDX-License-Identifier: GPL-2.0-or-later\ncode", "s"), (7, "the MIT License", "s"), (8, "SPDX-License-Identifier: Apache-3.0", "s"),
    ]
    got = {r.doc_id: r for r in op10_licenses.scan(documents(spark, rows)).collect()}
    names = {i: re.sub(r":\d+", "", got[i].licenses) for i in got}
    assert names == {1: "Apache-2.0", 2: "MIT,MIT", 3: "BSD-2-Clause", 4: "MIT,Apache-2.0", 5: "Apache-2.0", 6: "GPL-2.0", 7: "MIT", 8: ""}
    start, end = map(int, got[1].licenses.split(":")[1:])
    assert rows[0][1][start:end].startswith("Licensed under") and rows[0][1][start:end].endswith("under the\n# License")
    assert got[2].n_licenses == 2 and got[2].missing == 0 and 0.5 < got[1].best_saving < 1
    # Without the dictionaries' savings the shorter notices within a text come first.
    text = rows[0][1]
    ready, cue = op10_licenses.Templates(op10_licenses.TEMPLATES), re.compile(op10_licenses.CUE, re.I)
    whole = op10_licenses.find(text, ready, cue)
    monkeypatch.setattr(op10_licenses.Templates, "saved", lambda self, data, entry: 0)
    assert op10_licenses.find(text, ready, cue) != whole and len(whole) == 1


def test_all_licenses_of_a_line_are_found(spark):
    names = ["MIT", "Apache-2.0", "GPL-3.0", "MIT", "BSD-3-Clause", "CC-BY-4.0", "MPL-2.0", "LGPL-3.0", "AGPL-3.0", "MIT", "Unlicense", "all-rights-reserved"]
    line = " ".join(op10_licenses.TEMPLATES[n][0] for n in names)
    rows = [(1, line, "s"), (2, "All rights reserved. " * 500, "s"), (3, f"first line\n{line}\n{line}\nlast", "s")]
    got = {r.doc_id: r for r in op10_licenses.scan(documents(spark, rows)).collect()}
    assert re.sub(r":\d+", "", got[1].licenses).split(",") == names and got[1].n_licenses == 12
    assert got[2].n_licenses == 500 and got[3].n_licenses == 24
    assert got[1].missing == got[1].added == 0


def test_pipeline_stage_by_stage(spark, tmp_path):
    rows, labels = corpus(150)
    rows += [(5000 + i, rows[2][1], "s1") for i in range(3)] + [(6000, 'keep this line with a token = "abcdefabcdef0123456789" please and read on.', "s2")]
    folder = str(tmp_path)
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    label_table(spark, labels).write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    seen = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/out{i}")
        docs = spark.read.parquet(f"{folder}/out{i}")
        seen.append(docs)
        if i < 4:
            assert docs.columns == names
    bad = {d for d, q, _ in labels if q == 0}
    kept = {r.doc_id for r in seen[0].collect()}
    assert len(kept & bad) <= 0.1 * len(bad) and len(kept - bad) >= 0.97 * (len(rows) - 30)
    assert not {5000, 5001, 5002} & {r.doc_id for r in seen[1].collect()}
    masked = [r for r in seen[2].collect() if r.doc_id == 6000]
    assert masked and "[SECRET]" in masked[0].text and "abcdefabcdef" not in masked[0].text
    assert {r.doc_id for r in seen[2].collect()} == {r.doc_id for r in seen[1].collect()}
    assert sum(r.length for r in seen[4].collect()) > 0
    assert seen[4].select("doc_id").distinct().count() == seen[3].select("doc_id").distinct().count()


def test_pipeline_of_an_empty_table(spark, tmp_path):
    folder = str(tmp_path)
    documents(spark, []).write.parquet(f"{folder}/documents.parquet")
    label_table(spark, []).write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_pipeline_run_equals_brute_force(spark, tmp_path):
    import math
    from collections import Counter, defaultdict

    import public_tokenizers
    from tokenizers import Tokenizer

    from gleaner.llm.op2_mixing import _keyed
    from tests.llm.test_minhash import brute
    from tests.llm.test_packing_mixing import water

    rows, labels = corpus(160, seed=9)
    rows += [(5000 + i, rows[2][1], "s1") for i in range(3)] + [(6000, 'keep this line with a token = "abcdefabcdef0123456789" please and read on.', "s2")]
    rows += [(7000, None, None), (7001, "", "s3")]
    folder = str(tmp_path)
    documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
    label_table(spark, labels).write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    # Quality by the fitted field over whole texts; one document of each group; masks; the mix; tokens.
    field = op5_quality.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = [r for r in rows if field.scores([r[1] or ""])[0] >= 0.5]
    first = brute(good, 5, 80)
    single = [r for r in good if first[r[0]] == r[0]]
    mark = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}""", re.I)
    clean = [(d, t and mark.sub("[SECRET]", t), s) for d, t, s in single]
    keyed = [(r.source, r._key, r.doc_id, r._size) for r in _keyed(documents(spark, clean).select("doc_id", "source", "text"), 7).collect()]
    size = defaultdict(int)
    for s, _, _, n in keyed:
        size[s] += n
    texts, want = {d: t or "" for d, t, _ in clean}, Counter()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for s, target in water(size).items():
        epochs = math.floor(target + 0.5) // max(size[s], 1)
        left = math.floor(target + 0.5) - epochs * size[s]
        for _, d, n in sorted((k, d, n) for x, k, d, n in keyed if x == s):
            part = max(0, min(n, left))
            left -= n
            copies = [texts[d]] * epochs + ([texts[d]] if part == n and n else [re.match(r"(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){%d}" % part, texts[d])[0]] if part else [])
            for t in copies:
                want[d, len(tokenizer.encode(t, add_special_tokens=False).ids) + 1] += 1
    got = Counter((r.doc_id, r.doc_tokens) for r in corpus_pipeline.run(spark, folder).collect() if r.start == 0)
    assert got == want and len(good) < len(rows) and len(single) < len(good)
