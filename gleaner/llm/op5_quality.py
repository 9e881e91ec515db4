"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from features of itself and of its neighbours, with
transition scores between adjacent labels. Forward-backward gives each line's probability
of being good; the length-weighted mean over a document's lines, calibrated on the
training rows, is the document's score.

The field learns from document labels: a training document's lines all carry its label.
Training reads at most ``SAMPLE`` labelled rows, whatever the size of the corpus; scoring
runs over all rows, whole texts, without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.llm.common import batches, held_out, labelled_sample
from gleaner.llm.textvec import Batch, chunks, mix, runs

#: Most labelled rows the field is fitted on.
SAMPLE = 2000
#: Most lines of a row the field is fitted on; longer rows are scored but not learned from.
LINES = 400
ROUNDS = 60
#: Classes a line's characters are counted in.
_SPACE, _LOWER, _UPPER, _LETTER, _DIGIT, _STOP, _SHOUT, _BAR, _SYMBOL, _OTHER = range(10)
OWN = 13


def _kinds() -> np.ndarray:
    table = np.full(0x3000, _OTHER, np.uint8)
    for c in range(len(table)):
        ch = chr(c)
        if ch.islower():
            table[c] = _LOWER
        elif ch.isupper():
            table[c] = _UPPER
        elif ch.isalpha():
            table[c] = _LETTER
        elif ch.isdigit():
            table[c] = _DIGIT
        elif ch.isspace():
            table[c] = _SPACE
    for chars, kind in ((".,;:'\"()-?", _STOP), ("!", _SHOUT), ("|\t", _BAR), ("#$%&*+<=>@[]\\^_`{}~/", _SYMBOL)):
        table[[ord(c) for c in chars]] = kind
    return table


_table: list[np.ndarray] = []


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features of each line, characters of each line, lines of each text).

    Lines end at line feeds; an empty text is one empty line.
    """
    if not _table:
        _table.append(_kinds())
    batch = Batch([t + "\n" for t in texts])
    kind = np.where(batch.codes < len(_table[0]), _table[0][np.minimum(batch.codes, len(_table[0]) - 1)], np.uint8(_LETTER))
    breaks = np.flatnonzero(batch.codes == 10)
    start, end = np.concatenate([[0], breaks[:-1] + 1]), breaks
    line_of = np.repeat(np.arange(len(start)), end - start + 1)
    counts = np.bincount(line_of * 10 + kind, minlength=10 * len(start)).reshape(-1, 10).astype(np.float64)
    counts[:, _SPACE] -= 1  # the line feed itself
    text_of = np.searchsorted(batch.bounds, start, side="right") - 1
    size = (end - start).astype(np.float64)
    solid = np.maximum(size - counts[:, _SPACE], 1)
    letters = counts[:, _LOWER] + counts[:, _UPPER] + counts[:, _LETTER]
    own = np.zeros((len(start), OWN), np.float32)
    own[:, 0] = np.log1p(size) / 5
    own[:, 1] = counts[:, _UPPER] / np.maximum(letters, 1)
    for i, k in enumerate((_DIGIT, _STOP, _SHOUT, _BAR, _SYMBOL, _OTHER)):
        own[:, 2 + i] = counts[:, k] / solid
    # Words: their length, how many of a line's are repeats, and how often one repeats the last.
    ws, we, _ = runs(kind != _SPACE, np.append(start, len(kind)))
    word_line = line_of[ws]
    words = np.bincount(word_line, minlength=len(start)).astype(np.float64)
    hashed = batch.hashes(ws, we, lower=True)
    own_words = np.maximum(words, 1)
    new = np.unique(mix(hashed ^ mix(word_line.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    own[:, 8] = 1 - np.bincount(word_line[new], minlength=len(start)) / own_words
    same = np.zeros(len(ws), bool)
    same[1:] = (hashed[1:] == hashed[:-1]) & (word_line[1:] == word_line[:-1])
    own[:, 9] = np.bincount(word_line[same], minlength=len(start)) / own_words
    own[:, 10] = np.minimum(solid / own_words / 10, 3)
    own[:, 11] = words == 0
    # A line seen before in its document.
    lines = mix(batch.hashes(start, end) ^ mix(text_of.astype(np.uint64)))
    again = np.ones(len(start), bool)
    again[np.unique(lines, return_index=True)[1]] = False
    own[:, 12] = again & (size > 0)
    return own, size, np.bincount(text_of, minlength=len(texts))


def with_neighbours(own: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each line's features beside those of the lines before and after it, and a constant."""
    first = np.zeros(len(own), bool)
    ends = np.cumsum(lengths)
    first[ends - lengths] = True
    last = np.zeros(len(own), bool)
    last[ends - 1] = True
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first] = 0
    after[last] = 0
    return np.hstack([own, before, after, first[:, None], last[:, None], np.ones((len(own), 1), np.float32)])


class Chains:
    """Forward-backward over many chains at once, one step of all chains at a time."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.starts = (np.cumsum(lengths) - lengths)[self.order]
        self.active = [int(n) for n in np.searchsorted(-self.lengths, -np.arange(1, (self.lengths[0] if len(lengths) else 0) + 1), side="right")]

    def run(self, unary: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(P(good) of each line, expected transition counts of each line's step from its predecessor).

        ``unary`` is the score of good over bad, ``step[i, j]`` the score of j after i.
        """
        n = len(unary)
        score = np.zeros((n, 2))
        score[:, 1] = unary
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        pair = np.zeros((n, 2, 2))
        for t, k in enumerate(self.active):
            at = self.starts[:k] + t
            if t:
                f = forward[at - 1][:, :, None] + step[None]
                forward[at] = np.logaddexp(f[:, 0], f[:, 1]) + score[at]
            else:
                forward[at] = score[at]
        for t in range(len(self.active) - 2, -1, -1):
            at = self.starts[: self.active[t + 1]] + t
            g = step[None] + (score[at + 1] + backward[at + 1])[:, None, :]
            backward[at] = np.logaddexp(g[:, :, 0], g[:, :, 1])
        total = np.zeros(n)
        whole = forward + backward
        total = np.logaddexp(whole[:, 0], whole[:, 1])
        good = np.exp(whole[:, 1] - total)
        for t, k in enumerate(self.active):
            if t:
                at = self.starts[:k] + t
                pair[at] = np.exp(forward[at - 1][:, :, None] + step[None] + (score[at] + backward[at])[:, None, :] - total[at][:, None, None])
        return good, pair


class Field:
    """Weights of the field and the calibration of document scores."""

    def __init__(self, width: int):
        self.weights = np.zeros(width)
        self.step = np.zeros((2, 2))
        self.scale = np.array([1.0, 0.0])

    def fit(self, x: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> Field:
        """Adam on the penalised log-likelihood; each document counts once, whatever its length."""
        chains = Chains(lengths)
        line = np.repeat(labels, lengths).astype(np.float64)
        share = np.repeat(1.0 / np.maximum(lengths, 1), lengths) * 1.0
        balance = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-3), 0.5 / max(1 - labels.mean(), 1e-3))
        share *= np.repeat(np.minimum(balance, 4), lengths)
        inner = np.ones(len(line), bool)
        inner[np.cumsum(lengths) - lengths] = False
        seen = np.zeros((2, 2))
        for v in (0, 1):
            seen[v, v] = share[inner & (line == v)].sum()
        theta = np.zeros(len(self.weights) + 4)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for i in range(1, ROUNDS + 1):
            good, pair = chains.run(x @ theta[:-4], theta[-4:].reshape(2, 2))
            grad = np.concatenate([x.T @ (share * (line - good)), (seen - (pair * share[:, None, None]).sum(axis=0)).ravel()]) / len(labels)
            grad -= 1e-4 * theta
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            theta += 0.3 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
        self.weights, self.step = theta[:-4], theta[-4:].reshape(2, 2)
        raw = self.raw(x, sizes, lengths)
        a, b = 1.0, 0.0
        for _ in range(50):  # Newton steps on the two calibration numbers
            p = 1 / (1 + np.exp(-(a * raw + b)))
            w = p * (1 - p) + 1e-6
            g = np.array([((labels - p) * raw).sum() - 1e-2 * (a - 1), (labels - p).sum()])
            h = np.array([[(w * raw * raw).sum() + 1e-2, (w * raw).sum()], [(w * raw).sum(), w.sum()]])
            move = np.linalg.solve(h, g)
            a, b = a + np.clip(move[0], -1, 1), b + np.clip(move[1], -1, 1)
        self.scale = np.array([max(a, 1e-3), b])
        return self

    def raw(self, x: np.ndarray, sizes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log-odds of the length-weighted mean probability of good."""
        if not len(lengths):
            return np.zeros(0)
        good, _ = Chains(lengths).run(x @ self.weights, self.step)
        text = np.repeat(np.arange(len(lengths)), lengths)
        weight = sizes + 1.0
        mean = np.bincount(text, weights=good * weight) / np.bincount(text, weights=weight)
        mean = np.clip(mean, 1e-3, 1 - 1e-3)
        return np.log(mean / (1 - mean))

    def scores(self, texts: list[str]) -> np.ndarray:
        own, sizes, lengths = line_features(texts)
        raw = self.raw(with_neighbours(own, lengths), sizes, lengths)
        return 1 / (1 + np.exp(-(self.scale[0] * raw + self.scale[1])))


def _features(frames):
    """(label, lines, features and sizes as scoring has them) of each training row of at most LINES lines."""
    for frame in frames:
        frame = frame.filter(pa.array([t.count("\n") < LINES for t in frame.column("text").to_pylist()], pa.bool_()))
        texts = frame.column("text").to_pylist()
        for a, b in chunks(texts):
            own, sizes, lengths = line_features(texts[a:b])
            at = np.concatenate([[0], np.cumsum(lengths)])
            packed = np.hstack([own, sizes[:, None]]).astype(np.float32)
            yield pa.RecordBatch.from_pydict({
                "doc_id": frame.column("doc_id").slice(a, b - a),
                "label": frame.column("label").slice(a, b - a), "lines": pa.array(lengths, pa.int64()),
                "packed": pa.array([packed[at[i] : at[i + 1]].tobytes() for i in range(b - a)], pa.binary()),
            })


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """A field fitted on at most ``sample`` labelled rows outside the held-out fold.

    Only line features of these rows come to the driver. Without a row of either label the
    field stays at its start and scores everything 0.5.
    """
    chosen = labelled_sample(docs, labels, "quality", sample).select("doc_id", "text", "label")
    rows = batches(chosen, _features, "doc_id long, label int, lines long, packed binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.label, r.lines, bytes(r.packed)))
    field = Field(3 * OWN + 3)
    labels_seen = np.array([r.label for r in rows])
    if len(set(labels_seen.tolist())) < 2:
        return field
    packed = np.concatenate([np.frombuffer(r.packed, np.float32).reshape(-1, OWN + 1) for r in rows])
    lengths = np.array([r.lines for r in rows])
    return field.fit(with_neighbours(packed[:, :OWN], lengths), packed[:, OWN].astype(np.float64), lengths, labels_seen)


def score(docs: DataFrame, field: Field) -> DataFrame:
    """docs(doc_id, text) with held_out, score and predicted, a row for each row.

    A null or empty text is one empty line and is scored as such. Rows may repeat; a null id is
    not held out. An empty table gives an empty result; other columns are ignored.
    """
    def run(frames):
        for frame in frames:
            texts = frame.column("text").to_pylist()
            for a, b in chunks(texts):
                s = field.scores(texts[a:b])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": frame.column("doc_id").slice(a, b - a), "score": s, "predicted": pa.array((s >= 0.5).astype(np.int32), pa.int32()),
                })

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    scored = batches(slim, run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from ``labels.quality`` outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents predicted bad. The text decides, so rows need no unique id."""
    field = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    names = docs.columns
    at = names.index("text")

    def run(frames):
        for frame in frames:
            texts = [t or "" for t in frame.column(at).to_pylist()]
            for a, b in chunks(texts):
                good = field.scores(texts[a:b]) >= 0.5
                yield frame.slice(a, b - a).filter(pa.array(good))

    return batches(docs, run, docs.schema)
