"""Toxicity by a weighted finite-state pattern grammar.

Four weighted transducers read a clause as a string of token classes. The first decides
whether an insult or a threat is meant; the second marks what a negation reaches; the third
what is reported speech and where the writer speaks again; the last looks for patterns: a bare
insult, an insult near a person, a threat at a person, and those that are negated or reported.
A threat is a verb that a person follows, unless a harmless object follows both; what is wished
to a person, what a person is to have done to them, and where a person is told to go. Arcs
carry a constant and a multiple of the token's own weight. Their composition is built once;
the path of greatest weight through it gives a clause its pattern and its score. A word
alone decides nothing: a threat without a person after it, or a negated insult, is another
path of another weight.

What a pattern is worth to a document, and which words are insults beside the seed list, is
learned from labelled rows outside the held-out fold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import batches, held_out, labelled_sample, table
from gleaner.llm.textvec import Batch, chunks, folded, letters, runs

#: Most labelled rows that the lexicon and the weights are learned from.
SAMPLE = 8000
#: Most words, and most stems, that the learned lexicon holds.
LEXICON = 2000
STEMS = (4, 5, 6)
#: Natural-log likelihood ratios over chance that a learned word may have to reach; which, cross-validation over so many folds of the
#: training rows decides.
PROOFS, FOLDS = (6.0, 8.0, 10.0, 13.0), 3
#: Share of a learned word's documents that must be toxic.
PRECISION = 0.92
THRESHOLD = 0.7

# Seed classes.
INSULTS = (
    "idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting clown clowns dumb fool fools "
    "imbecile jerk creep vermin filth coward bastard bitch asshole retard degenerate subhuman parasite parasites garbage "
    "ugly hateful"
).split()
THREATS = "kill murder hurt destroy burn shoot stab beat crush strangle hang exterminate".split()
PERSONS = (
    "you your yours him his her them their he she they people everyone guy woman man men women vous tu toi il elle ils "
    "du dich dir sie er ihr ihn usted te ellos ella yourself yourselves himself herself themselves"
).split()
NEGATIONS = "not no never nobody isn aren wasn don doesn didn without hardly nicht kein keine pas jamais nunca".split()
REPORTS = "said says say told wrote writes quoted claimed called reported according stated sagte dit dijo".split()
WISHES = "hope hopes hoping wish wishes wishing pray espero ojalá hoffe hoffentlich espère".split()
FATES = "die dies suffer bleed rot perish drown choke sterben verrecken crève crever mueras muere".split()
DONE = "killed murdered destroyed burned burnt shot stabbed beaten crushed strangled hanged exterminated erased".split()
PASSIVES = "be get getting".split()
DOOMS = "hell hölle enfer infierno".split()
GOING = "go geh fahr va vete".split()
HARMLESS = "email emails mail message text note line letter link call chess tennis cards poker game games race match score deadline record".split()
TURNS = "and but und aber mais et pero y".split()
SELVES = "i ich je yo we wir nous".split()

#: Classes of tokens; a break is a mark inside a clause, such as a comma.
CLASSES = ("insult", "threat", "person", "negation", "report", "word", "break", "wish", "fate", "done", "passive", "doom", "going", "harmless", "turn", "self")
(_INSULT, _THREAT, _PERSON, _NEGATION, _REPORT, _PLAIN, _BREAK, _WISH, _FATE, _DONE, _PASSIVE, _DOOM, _GOING, _HARMLESS, _TURN, _SELF) = range(16)
#: Classes that can make a pattern.
LOUD = ("insult", "threat", "fate", "done", "doom")
#: Classes that mean something only beside one of others in their clause.
PARTNERS = (
    ((_TURN, _SELF), (_REPORT,)), ((_HARMLESS,), (_THREAT,)), ((_FATE,), (_WISH, _GOING)), ((_DOOM,), (_GOING,)), ((_DONE,), (_PASSIVE,)),
    ((_PASSIVE,), (_THREAT, _DONE)), ((_WISH, _GOING), (_FATE, _DOOM)),
)
#: Patterns a clause can end in.
PATTERNS = ("insult", "insult_target", "threat_target", "negated", "reported")
#: Tokens over which a negation reaches, and at which a person is near an insult or follows a threat, a harmless object
#: follows the two, and the parts of a wish, a passive or a curse follow each other.
REACH, NEAR, AFTER, OBJECT, LINKED = 3, 3, 2, 3, 3
#: Weights: a person near an insult, a threat at a person, and the share that negated and reported ones keep; what a harmless
#: object takes away is more than a threat can weigh.
AT_PERSON, AT_THREAT, NEGATED, REPORTED, TURNED = 0.5, 0.5, 0.25, 0.5, -2.0


class Transducer:
    """Weighted arcs (state, input, output, constant, multiple of the token's weight, next state); state 0 starts.

    ``finals`` names the states a path may end in.
    """

    def __init__(self, arcs: list[tuple], finals: dict):
        self.arcs, self.finals = arcs, finals
        self.leaving: dict[tuple, list[tuple]] = {}
        for state, symbol, *rest in arcs:
            self.leaving.setdefault((state, symbol), []).append(tuple(rest))

    def then(self, other: Transducer) -> Transducer:
        """The composition: what this one puts out, ``other`` reads. Weights add."""
        numbers, arcs, todo = {(0, 0): 0}, [], [(0, 0)]
        symbols = {s for _, s, *_ in self.arcs}
        while todo:
            at = todo.pop()
            for symbol in sorted(symbols):
                for out, constant, multiple, to in self.leaving.get((at[0], symbol), ()):
                    for out2, constant2, multiple2, to2 in other.leaving.get((at[1], out), ()):
                        if (to, to2) not in numbers:
                            numbers[to, to2] = len(numbers)
                            todo.append((to, to2))
                        arcs.append((numbers[at], symbol, out2, constant + constant2, multiple + multiple2, numbers[to, to2]))
        finals = {n: other.finals[b] for (a, b), n in numbers.items() if a in self.finals and b in other.finals}
        return Transducer(arcs, finals)


def _sense() -> Transducer:
    """Insults and threats are meant, or are words like others."""
    arcs = [(0, c, c, 0.0, 0.0, 0) for c in CLASSES]
    return Transducer(arcs + [(0, c, "word", 0.0, 0.0, 0) for c in LOUD], {0: ""})


def _negation() -> Transducer:
    """Counts down over the tokens after a negation; a break ends it."""
    arcs = []
    for left in range(REACH + 1):
        for c in CLASSES:
            to = REACH if c == "negation" else 0 if c == "break" else max(left - 1, 0)
            hit = left > 0 and c in LOUD
            arcs.append((left, c, "negated" if hit else c, 0.0, 0.0, to))
    return Transducer(arcs, dict.fromkeys(range(REACH + 1), ""))


def _report() -> Transducer:
    """What follows a verb of saying is reported, until a conjunction and a first person take over."""
    arcs = []
    for c in (*CLASSES, "negated"):
        arcs.append((0, c, c, 0.0, 0.0, 1 if c == "report" else 0))
        out = "reported" if c in LOUD else c
        arcs.append((1, c, out, 0.0, 0.0, 2 if c == "turn" else 1))
        arcs.append((2, c, out, 0.0, 0.0, 0 if c == "self" else 2 if c == "turn" else 1))
    return Transducer(arcs, dict.fromkeys(range(3), ""))


def _pattern() -> Transducer:
    """Which pattern a clause makes.

    A state is (best pattern so far, what is open, tokens it stays open). Open are: a person, an
    insult without one, a threat that still needs one, a threat that hit one and that a
    harmless object may turn, a wish, a person it is for, a person to whom something is to be
    done, and one who is told to go.
    """
    ranks = ("", "negated", "reported", *PATTERNS[:3])
    numbers: dict[tuple, int] = {}
    arcs, todo = [], []

    def number(state: tuple) -> int:
        if state not in numbers:
            numbers[state] = len(numbers)
            todo.append(state)
        return numbers[state]

    def best(a: str, b: str) -> str:
        return max(a, b, key=ranks.index)

    number(("", "", 0))
    while todo:
        state = todo.pop()
        have, near, left = state
        # A threat that nothing turned counts once its object can't come any more.
        settled = best(have, "threat_target") if near == "hit" else have
        fade = (have, near, left - 1) if left > 1 else (settled, "", 0)
        for c in (*CLASSES, "negated", "reported"):
            constant, multiple, to = 0.0, 0.0, fade
            if c == "insult":
                multiple = 1.0
                if near == "person":
                    constant, to = AT_PERSON, (best(have, "insult_target"), near, left)
                elif near in ("hit", "wished"):  # a person is there
                    constant, to = AT_PERSON, (best(settled, "insult_target"), "person", NEAR)
                elif near == "threat":
                    to = (best(have, "insult"), *fade[1:])
                else:
                    to = (best(have, "insult"), "insult", NEAR)
            elif c in ("threat", "done") and near == "passive" or c == "fate" and near in ("wished", "going") or c == "doom" and near == "going":
                constant, multiple, to = AT_THREAT, 1.0, (best(have, "threat_target"), "", 0)
            elif c == "threat":
                multiple, to = 1.0, (settled, "threat", AFTER)
            elif c == "person":
                if near == "threat":
                    constant, to = AT_THREAT, (have, "hit", OBJECT)
                elif near == "insult":
                    constant, to = AT_PERSON, (best(have, "insult_target"), "person", NEAR)
                elif near in ("wish", "wished"):
                    to = (have, "wished", LINKED)
                else:
                    to = (settled, "person", NEAR)
            elif c == "harmless" and near == "hit":
                constant, to = TURNED, (have, "", 0)
            elif c == "wish" and near != "threat":
                to = (settled, "wish", LINKED)
            elif c == "passive" and near in ("person", "wished"):
                to = (have, "passive", LINKED)
            elif c == "going" and near in ("", "person"):
                to = (have, "going", LINKED)
            elif c in ("negated", "reported"):
                multiple, to = NEGATED if c == "negated" else REPORTED, (best(fade[0], c), *fade[1:])
            if near == "threat" and left <= 1 and c != "person":
                continue  # a threat that no person has followed is not one
            arcs.append((numbers[state], c, c, constant, multiple, number(to)))
    return Transducer(arcs, {n: best(have, "threat_target") if near == "hit" else have for (have, near, _), n in numbers.items() if near != "threat"})


PARTS = (_sense(), _negation(), _report(), _pattern())


class Automaton:
    """Best paths through the composed grammar, many clauses at a time."""

    def __init__(self, *parts: Transducer):
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.then(part)
        self.states = 1 + max(max(a[0], a[-1]) for a in whole.arcs)
        self.moves = []
        for c in CLASSES:
            arcs = sorted((a for a in whole.arcs if a[1] == c), key=lambda a: (a[5], a[0]))
            to = np.array([a[5] for a in arcs])
            first = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            self.moves.append((np.array([a[0] for a in arcs]), np.array([a[3] for a in arcs]), np.array([a[4] for a in arcs]), first, to[first]))
        self.final = np.full(self.states, len(PATTERNS))  # nothing found
        allowed = np.zeros(self.states, bool)
        for state, name in whole.finals.items():
            allowed[state] = True
            if name:
                self.final[state] = PATTERNS.index(name)
        self.allowed = allowed

    def best(self, kinds: np.ndarray, weights: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, weight) of each clause; tokens of all clauses end to end. Pattern len(PATTERNS) is none."""
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(-lengths, kind="stable")
        value = np.full((len(lengths), self.states), -np.inf)
        value[:, 0] = 0.0
        active = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")
        for t, k in enumerate(active.tolist()):
            rows = order[:k]
            at = starts[rows] + t
            kind, weight = kinds[at], weights[at]
            for c in np.unique(kind).tolist():
                here = kind == c
                source, constant, multiple, first, to = self.moves[c]
                reached = value[np.ix_(rows[here], source)] + constant + weight[here][:, None] * multiple
                new = np.full((int(here.sum()), self.states), -np.inf)
                new[:, to] = np.maximum.reduceat(reached, first, axis=1)
                value[rows[here]] = new
        value = np.where(self.allowed, value, -np.inf)
        end = value.argmax(axis=1)
        return self.final[end], value[np.arange(len(lengths)), end]


AUTOMATON = Automaton(*PARTS)


def clause_patterns(kinds: list[int], weights: list[float]) -> dict[str, float]:
    """The pattern of one clause and its weight; 0 for the others."""
    pattern, weight = AUTOMATON.best(np.array(kinds, np.int64), np.array(weights, np.float64), np.array([len(kinds)]))
    return {name: float(weight[0]) if i == pattern[0] else 0.0 for i, name in enumerate(PATTERNS)}


def _hash_words(words: list[str]) -> np.ndarray:
    batch = Batch(words)
    return batch.span_hash(batch.sums(), batch.bounds[:-1], batch.bounds[1:])


class Grammar:
    """The lexicon as hash tables and the weights of the document score."""

    def __init__(self, learned_words: dict[str, float], learned_stems: dict[str, float]):
        self.words, self.stems = learned_words, learned_stems
        self.coefficients = np.array([-4.0, 1.5, 2.0, 1.5, 0.5, 0.5, 0.5])

    def _tables(self):
        entries: dict[str, tuple[int, float]] = {}
        for kind, words in (
            (_TURN, TURNS), (_SELF, SELVES), (_HARMLESS, HARMLESS), (_GOING, GOING), (_DOOM, DOOMS), (_PASSIVE, PASSIVES), (_DONE, DONE), (_FATE, FATES), (_WISH, WISHES),
            (_REPORT, REPORTS), (_NEGATION, NEGATIONS), (_PERSON, PERSONS), (_THREAT, THREATS), (_INSULT, INSULTS),
        ):
            entries.update({w: (kind, 1.0) for w in words})
        for w, weight in self.words.items():  # a learned threat stays one
            kind = entries.get(w, (_INSULT, 0))[0]
            if kind in (_INSULT, _THREAT):
                entries[w] = (kind, weight)
        names = sorted(entries)
        h = _hash_words(names)
        order = np.argsort(h)
        stems = sorted(self.stems)
        sh = _hash_words(stems)
        stem_order = np.argsort(sh)
        return (
            h[order], np.array([entries[names[i]][0] for i in order]), np.array([entries[names[i]][1] for i in order]),
            sh[stem_order], np.array([self.stems[stems[i]] for i in stem_order]),
        )

    def features(self, texts: list[str]) -> np.ndarray:
        """Pattern weights of each text: log totals by pattern and the share of clauses hit."""
        if not hasattr(self, "_cached"):
            self._cached = self._tables()
        h, kinds, weights, sh, stem_weights = self._cached
        batch = Batch(texts)
        codes = folded()[batch.codes]
        start, end, text = runs(letters()[batch.codes], batch.bounds)
        out = np.zeros((batch.n, len(PATTERNS) + 1))
        if not len(start):
            return out
        sums = batch.sums(codes)
        token = batch.span_hash(sums, start, end)
        at = np.minimum(np.searchsorted(h, token), len(h) - 1)
        found = h[at] == token
        kind = np.where(found, kinds[at], _PLAIN)
        weight = np.where(found, weights[at], 0.0)
        if len(sh):
            for k in STEMS:
                wide = np.flatnonzero((kind == _PLAIN) & (end - start >= k))
                stem = batch.span_hash(sums, start[wide], start[wide] + k)
                at = np.minimum(np.searchsorted(sh, stem), len(sh) - 1)
                hit = sh[at] == stem
                kind[wide[hit]] = _INSULT
                weight[wide[hit]] = stem_weights[at[hit]]
        # Clauses end at sentence marks, line ends and text ends.
        stops = np.isin(batch.codes, [ord(c) for c in ".!?;\n。…"])
        before = np.concatenate([[0], np.cumsum(stops)])[start] + text
        clause = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])])
        # Tokens whose partners aren't in their clause can make no pattern there and are plain words.
        for alone, partners in PARTNERS:
            near = np.zeros(int(clause[-1]) + 1, bool)
            near[clause[np.isin(kind, partners)]] = True
            plain = np.isin(kind, alone) & ~near[clause]
            kind[plain], weight[plain] = _PLAIN, 0.0
        loud = np.unique(clause[np.isin(kind, [CLASSES.index(c) for c in LOUD])])
        first = np.searchsorted(clause, loud, side="left")
        last = np.searchsorted(clause, loud, side="right")
        # The tokens of these clauses, with a break before those that a comma or the like precedes.
        length = last - first
        token = np.repeat(first - (np.cumsum(length) - length), length) + np.arange(length.sum())
        marks = np.concatenate([[0], np.cumsum(np.isin(batch.codes, [ord(c) for c in ",:()–—«»“”\""]))])
        broken = np.zeros(len(start), bool)
        broken[1:] = (marks[start[1:]] > marks[start[:-1]]) & (clause[1:] == clause[:-1])
        places = np.flatnonzero(broken[token])
        which = np.repeat(np.arange(len(loud)), length)
        kinds, weights = np.insert(kind[token], places, _BREAK), np.insert(weight[token], places, 0.0)
        length = length + np.bincount(which[places], minlength=len(loud))
        # Plain words before all others change nothing, and of a run of them no more than the longest reach does.
        at, start_at = np.arange(len(kinds)), np.repeat(np.cumsum(length) - length, length)
        spoken = np.maximum.accumulate(np.where(kinds != _PLAIN, at, -1))
        keep = (kinds != _PLAIN) | ((spoken >= start_at) & (at - spoken <= max(REACH, NEAR, AFTER, OBJECT, LINKED) + 1))
        which = np.repeat(np.arange(len(loud)), length)
        found, value = AUTOMATON.best(kinds[keep], weights[keep], np.bincount(which[keep], minlength=len(loud)))
        sure = found < len(PATTERNS)
        np.add.at(out, (text[first[sure]], found[sure]), value[sure])
        hits = np.bincount(text[first[sure]], minlength=batch.n)
        clauses = np.bincount(text[np.unique(clause, return_index=True)[1]], minlength=batch.n)
        out[:, :-1] = np.log1p(out[:, :-1])
        out[:, -1] = hits / np.maximum(clauses, 1)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        z = self.coefficients[0] + self.features(texts) @ self.coefficients[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray) -> Grammar:
        """Ridge logistic regression towards the starting weights, by Newton steps."""
        start = self.coefficients.copy()
        x = np.hstack([np.ones((len(x), 1)), x])
        theta = start.copy()
        ridge = np.array([1e-3] + [0.05] * (x.shape[1] - 1))
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
            w = p * (1 - p) + 1e-6
            gradient = x.T @ (y - p) - ridge * (theta - start)
            move = np.linalg.solve((x * w[:, None]).T @ x + np.diag(ridge), gradient)
            theta = theta + np.clip(move, -2, 2)
        self.coefficients = theta
        return self


def counted_entries(sample: DataFrame) -> DataFrame:
    """(entry, fold, bad, n): in how many rows of the sample, by fold, each word ("=") and stem ("^") stands, and in how many toxic ones."""
    tokens = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    stems = F.array(*[F.lit(k) for k in STEMS])
    entries = F.concat(
        F.transform(F.filter(tokens, lambda w: F.length(w) >= 3), lambda w: F.concat(F.lit("="), w)),
        F.array_distinct(F.flatten(F.transform(stems, lambda k: F.transform(
            F.filter(tokens, lambda w: F.length(w) >= k), lambda w: F.concat(F.lit("^"), F.substring(w, F.lit(1), k)))))),
    )
    return (
        sample.select("label", "fold", F.explode(entries).alias("entry"))
        .groupBy("entry", "fold").agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("n"))
    )


def learn_lexicon(counted: DataFrame, totals: dict[int, tuple[int, int]], without: int | None, least: float) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems that mark toxic rows of the folds but one beyond chance, with weights in (0, 1].

    Counts documents, not occurrences; ``totals`` has (toxic, all) rows by fold. At most ``LEXICON`` of each come to the driver.
    """
    bad, every = (sum(t[k] for fold, t in totals.items() if fold != without) for k in (0, 1))
    base = bad / every
    merged = counted.where(F.col("fold") != F.lit(-1 if without is None else without)).groupBy("entry").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    p = F.least((F.col("bad") + 0.0) / F.col("n"), F.lit(1 - 1e-9))
    proof = F.col("bad") * F.log(F.greatest(p, F.lit(1e-9)) / base) + (F.col("n") - F.col("bad")) * F.log((1 - p) / (1 - base))
    best = (
        merged.where((F.col("bad") >= 4) & (p >= PRECISION)).withColumn("proof", proof).where(F.col("proof") >= least)
        .orderBy(F.desc("proof"), "entry").limit(2 * LEXICON).collect()
    )
    weigh = lambda r: r.bad / (r.n + 1)
    words = {r.entry[1:]: weigh(r) for r in best if r.entry[0] == "="}
    return words, {r.entry[1:]: weigh(r) for r in best if r.entry[0] == "^"}


def _featured(sample: DataFrame, grammars: list[Grammar]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(labels, folds, features by each grammar) of the sample's rows, in one order."""
    def run(frames):
        for frame in frames:
            texts = frame.column("text").to_pylist()
            for a, b in chunks(texts):
                yield pa.RecordBatch.from_pydict({
                    "doc_id": frame.column("doc_id").slice(a, b - a), "label": frame.column("label").slice(a, b - a), "fold": frame.column("fold").slice(a, b - a),
                    "x": pa.array(list(np.hstack([g.features(texts[a:b]) for g in grammars]))),
                })

    rows = batches(sample, run, "doc_id long, label int, fold int, x array<double>").collect()  # at most the sample's
    rows.sort(key=lambda r: (r.doc_id, r.label, r.x))
    x = np.array([r.x for r in rows])
    return np.array([float(r.label) for r in rows]), np.array([r.fold for r in rows]), np.split(x, len(grammars), axis=1)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Grammar:
    """A grammar learned from at most ``sample`` labelled rows outside the held-out fold.

    How much proof a learned word needs is chosen among ``PROOFS`` by cross-validation within these
    rows: a lexicon and weights are learned without each of ``FOLDS`` folds and judged on it by log
    loss, ties to less proof. As evidence grows with the rows, what is asked of fewer rows is
    less in proportion. Without two rows of either label in every fold the middle one is
    taken, and without a row of either the seeds and starting weights stand.
    """
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int").alias("fold")
    chosen = table(labelled_sample(docs, labels, "toxic", sample).select("doc_id", "text", "label", fold))
    totals = {r.fold: (r.bad, r.n) for r in chosen.groupBy("fold").agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("n")).collect()}
    if not sum(b for b, _ in totals.values()) or not sum(n - b for b, n in totals.values()):
        return Grammar({}, {})
    counted = table(counted_entries(chosen))
    least = PROOFS[1]
    if len(totals) == FOLDS and all(min(b, n - b) >= 2 for b, n in totals.values()):
        tried = [(proof, out) for proof in PROOFS for out in range(FOLDS)]
        y, folds, x = _featured(chosen, [Grammar(*learn_lexicon(counted, totals, out, proof * (FOLDS - 1) / FOLDS)) for proof, out in tried])
        losses = dict.fromkeys(PROOFS, 0.0)
        for (proof, out), own in zip(tried, x):
            here = folds == out
            theta = Grammar({}, {}).fit(own[~here], y[~here]).coefficients
            p = np.clip(1 / (1 + np.exp(-np.clip(theta[0] + own[here] @ theta[1:], -30, 30))), 1e-9, 1 - 1e-9)
            losses[proof] -= np.where(y[here] > 0, np.log(p), np.log1p(-p)).sum()
        least = min(PROOFS, key=lambda proof: round(losses[proof], 6))
    grammar = Grammar(*learn_lexicon(counted, totals, None, least))
    y, _, (x,) = _featured(chosen, [grammar])
    return grammar.fit(x, y)


def score(docs: DataFrame, grammar: Grammar, threshold: float = THRESHOLD) -> DataFrame:
    """docs(doc_id, text) with held_out, score and predicted, a row for each row.

    Null and empty texts hold no clause and get the score of a clean one. Rows may repeat; a
    null id is not held out. An empty table gives an empty result; other columns are ignored.
    """
    def run(frames):
        for frame in frames:
            texts = frame.column("text").to_pylist()
            for a, b in chunks(texts):
                s = grammar.scores(texts[a:b])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": frame.column("doc_id").slice(a, b - a), "score": s, "predicted": pa.array((s >= threshold).astype(np.int32), pa.int32()),
                })

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    scored = batches(slim, run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from ``labels.toxic`` outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
