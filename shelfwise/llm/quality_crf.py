"""Document quality by a linear-chain conditional random field over lines.

Every line of a text (parts between line feeds) is good or bad. A line's evidence is
a weighted sum of features of itself and of the lines before and after it: case,
digits, signs, repeated words and signs, word lengths, lines met before. Transition
weights tie neighbouring labels. Forward-backward gives each line's probability of
being good; their mean, weighted by line length, is turned into the document's score
by a logistic curve.

Training labels are known for documents only. All lines of a good document are good.
Lines of a bad one start as bad and are labelled anew by the current weights, the
worst staying bad, before the field is fitted to whole chains by gradient steps on its
likelihood. The fit reads a sample of at most ``PER_CLASS`` documents of each class;
scoring reads every line of every text. The model is a few hundred numbers.

Cases: a null or empty text is one empty line; a text without line feeds is one line;
without labelled rows of both classes every score is 0.5; labels, lang, source and ids
are not read by a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm import words
from shelfwise.llm.columns import batch_of, ids_and_texts
from shelfwise.llm.sampling import held_out, labelled_sample
from shelfwise.llm.staging import staged
from shelfwise.llm.toxicity import logistic

FOLD, FOLDS = 2, 4
PER_CLASS = 2500
THRESHOLD = 0.7
RELABELLINGS = 3
STEPS, RATE, RIDGE = 60, 0.05, 1e-3

LOWER, UPPER, DIGIT, SPACE, MARK, CALL, BAR, SIGN, WIDE = range(9)


def _kinds() -> np.ndarray:
    """The kind of each byte."""
    kinds = np.full(256, SIGN, np.int64)
    kinds[128:] = WIDE
    kinds[words.SPACES] = SPACE
    for first, last, kind in (("a", "z", LOWER), ("A", "Z", UPPER), ("0", "9", DIGIT)):
        kinds[ord(first) : ord(last) + 1] = kind
    for mark in ".,;:'\"-?()":
        kinds[ord(mark)] = MARK
    kinds[ord("!")], kinds[ord("|")] = CALL, BAR
    return kinds


KINDS = _kinds()
OWN_FEATURES = 17


class Lines:
    """The lines of a piece and their features."""

    def __init__(self, piece: words.Piece):
        data = piece.data
        starts = np.flatnonzero(data == 10) + 1
        inside = np.searchsorted(piece.offsets[:-1], starts, "right") - 1
        keep = (starts > piece.offsets[inside]) & (starts < len(data))  # a line feed at a text's end begins no line
        self.starts = np.sort(np.concatenate((piece.offsets[:-1], starts[keep])), kind="stable")
        ends = np.append(self.starts[1:], len(data))
        self.lengths = ends - self.starts
        # Documents of the same offset are empty: one line each.
        self.first = np.concatenate((np.arange(len(piece.rows)) + np.searchsorted(np.sort(starts[keep]), piece.offsets[:-1], "left"), [len(self.starts)]))
        self.doc = np.repeat(np.arange(len(piece.rows)), np.diff(self.first))
        self.features = self._features(piece)

    def _features(self, piece: words.Piece) -> np.ndarray:
        n = len(self.starts)
        line = np.repeat(np.arange(n), self.lengths)
        kind = KINDS[piece.data]
        counts = np.bincount(line * 9 + kind, minlength=n * 9).reshape(n, 9).astype(float)
        same = (piece.data[1:] == piece.data[:-1]) & (kind[1:] >= MARK) & (kind[1:] <= SIGN)
        doubled = np.bincount(line[1:][same], minlength=n)
        hashes = piece.hashes()
        line_of = line[piece.starts]
        n_words = np.bincount(line_of, minlength=n)

        def repeats(back: int) -> np.ndarray:
            again = (hashes[back:] == hashes[:-back]) & (line_of[back:] == line_of[:-back])
            return np.bincount(line_of[back:][again], minlength=n)

        last = kind[piece.ends - 1]
        odd_ends = np.bincount(line_of[(last >= CALL) & (last <= SIGN)], minlength=n)
        total = np.zeros(n, np.uint64)
        np.add.at(total, line_of, hashes)
        length, many = np.maximum(self.lengths, 1), np.maximum(n_words, 1)
        letters = np.maximum(counts[:, LOWER] + counts[:, UPPER], 1)
        return np.column_stack(
            [
                np.log1p(self.lengths),
                np.log1p(n_words),
                counts[:, UPPER] / letters,
                *(counts[:, k] / length for k in (DIGIT, SPACE, MARK, CALL, BAR, SIGN, WIDE)),
                doubled / length,
                repeats(1) / many,
                repeats(2) / many,
                odd_ends / many,
                np.minimum(self.lengths / many, 40) / 10,
                self._met_before(total),
                n_words == 0,
            ]
        )

    def _met_before(self, identity: np.ndarray) -> np.ndarray:
        order = np.lexsort((identity, self.doc))
        again = np.zeros(len(identity), bool)
        again[order[1:]] = (identity[order[1:]] == identity[order[:-1]]) & (self.doc[order[1:]] == self.doc[order[:-1]])
        return again

    def with_neighbours(self, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
        """Standardised features of each line, the one before, the one after, and a one."""
        x = np.clip((self.features - mean) / scale, -6, 6)
        return beside(x, self.first)


def beside(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    before, after = np.zeros_like(x), np.zeros_like(x)
    before[1:], after[:-1] = x[:-1], x[1:]
    before[first[:-1]] = 0
    after[first[1:] - 1] = 0
    return np.column_stack([x, before, after, np.ones(len(x))])


def marginals(evidence: list[float], change: np.ndarray) -> tuple[list[float], np.ndarray, float]:
    """Probability of good for each line, expected transitions, and the log of the partition sum.

    ``evidence`` is the log-odds of good of each line alone; ``change[a, b]`` weighs label b after a.
    """
    bb, bg, gb, gg = (float(v) for v in np.exp(change).reshape(-1))
    odds = [math.exp(max(-30.0, min(30.0, e))) for e in evidence]
    n = len(odds)
    good, bad, log_sum = [0.0] * n, [0.0] * n, 0.0
    g, b = odds[0], 1.0
    for t in range(n):
        if t:
            g, b = (b * bg + g * gg) * odds[t], b * bb + g * gb
        total = g + b
        g, b = g / total, b / total
        good[t], bad[t] = g, b
        log_sum += math.log(total)
    expected = np.zeros((2, 2))
    later_g = later_b = 1.0
    result = [0.0] * n
    result[-1] = good[-1]
    for t in range(n - 1, 0, -1):
        into_g, into_b = odds[t] * later_g, later_b
        pairs = (bad[t - 1] * bb * into_b, bad[t - 1] * bg * into_g, good[t - 1] * gb * into_b, good[t - 1] * gg * into_g)
        total = sum(pairs)
        expected += np.array(pairs).reshape(2, 2) / total
        result[t - 1] = (pairs[2] + pairs[3]) / total
        later_g, later_b = gb * into_b + gg * into_g, bb * into_b + bg * into_g
        total = later_g + later_b
        later_g, later_b = later_g / total, later_b / total
    return result, expected, log_sum


@dataclass
class Model:
    """Feature scales, weights of evidence, transition weights and the final curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    change: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def log_odds(self, evidence: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> Iterator[float]:
        """The log-odds of each document's length-weighted share of good lines."""
        values = evidence.tolist()
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            good, _, _ = marginals(values[a:b], self.change)
            weight = lengths[a:b] + 1
            share = min(max(float(np.dot(good, weight) / weight.sum()), 1e-6), 1 - 1e-6)
            yield math.log(share / (1 - share))

    def scores(self, texts: pa.Array) -> np.ndarray:
        found = []
        for piece in words.pieces(texts):
            lines = Lines(piece)
            evidence = lines.with_neighbours(self.mean, self.scale) @ self.weights
            found.extend(self.log_odds(evidence, lines.lengths, lines.first))
        return 1 / (1 + np.exp(-np.clip(self.slope * np.array(found) + self.shift, -30, 30)))


def _line_weights(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge logistic regression by Newton steps: evidence of single lines."""
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = (x * (weight * p * (1 - p) + 1e-12)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(slope, x.T @ (weight * (y - p)) - ridge * beta)
        beta = beta + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def _fit_chains(x: np.ndarray, y: np.ndarray, first: np.ndarray, weight: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Adam steps on the mean log-likelihood of the chains; ``weight`` is each document's."""
    chains = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
    seen = np.zeros((2, 2))
    for (a, b), w in zip(chains, weight, strict=True):
        np.add.at(seen, (y[a : b - 1].astype(int), y[a + 1 : b].astype(int)), w / max(b - a - 1, 1))
    line_weight = np.repeat(weight / np.diff(first), np.diff(first))
    point = np.concatenate([beta, np.zeros(4)])
    momentum, square = np.zeros_like(point), np.zeros_like(point)
    for step in range(1, STEPS + 1):
        evidence = (x @ point[:-4]).tolist()
        change = point[-4:].reshape(2, 2)
        good, expected = np.empty(len(x)), np.zeros((2, 2))
        for (a, b), w in zip(chains, weight, strict=True):
            good[a:b], pairs, _ = marginals(evidence[a:b], change)
            expected += pairs * (w / max(b - a - 1, 1))
        slope = np.concatenate([x.T @ (line_weight * (y - good)), (seen - expected).reshape(-1)]) - RIDGE * point
        momentum, square = 0.9 * momentum + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        point = point + RATE * (momentum / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return point[:-4], point[-4:].reshape(2, 2)


def fit(docs: DataFrame, labels: DataFrame, fold: int = FOLD, folds: int = FOLDS, per_class: int = PER_CLASS) -> Model | None:
    """A model of labelled documents outside the held-out fold; None if a class is missing."""
    sample = labelled_sample(docs, labels, "quality", fold, folds, per_class).select("label", "text")

    def lines_of(batches):
        for batch in batches:
            label = batch.column(0).to_numpy()
            for piece in words.pieces(batch.column(1)):
                lines = Lines(piece)
                for k, row in enumerate(piece.rows):
                    a, b = lines.first[k], lines.first[k + 1]
                    yield batch_of(
                        label=pa.array([int(label[row])], pa.int32()),
                        lengths=pa.array([lines.lengths[a:b].tolist()], pa.list_(pa.int64())),
                        features=pa.array([lines.features[a:b].reshape(-1).tolist()], pa.list_(pa.float64())),
                    )

    rows = staged(sample.mapInArrow(lines_of, "label int, lengths array<long>, features array<double>"), "quality-sample").collect()
    if {r.label for r in rows} != {0, 1}:
        return None
    first = np.cumsum([0, *(len(r.lengths) for r in rows)])
    sizes = np.diff(first)
    raw = np.concatenate([np.array(r.features).reshape(-1, OWN_FEATURES) for r in rows])
    lengths = np.concatenate([np.array(r.lengths) for r in rows])
    label = np.array([r.label for r in rows], float)
    mean, scale = raw.mean(axis=0), raw.std(axis=0) + 1e-6
    x = beside(np.clip((raw - mean) / scale, -6, 6), first)
    balance = np.where(label > 0, 0.5 / label.sum(), 0.5 / (1 - label).sum())
    share = (lengths + 1) / np.repeat(np.add.reduceat(lengths + 1, first[:-1]), sizes)
    line_weight = np.repeat(balance, sizes) * share
    y = np.repeat(label, sizes)
    for _ in range(RELABELLINGS):
        beta = _line_weights(x, y, line_weight, 1e-4)
        evidence = x @ beta
        for k in np.flatnonzero(label == 0):
            own = slice(first[k], first[k + 1])
            y[own] = evidence[own] > 0
            y[first[k] + int(np.argmin(evidence[own]))] = 0
    beta = _line_weights(x, y, line_weight, 1e-4)
    beta, change = _fit_chains(x, y, first, balance, beta)
    model = Model(mean, scale, beta, change)
    log_odds = np.array(list(model.log_odds(x @ beta, lengths, first)))
    model.slope, model.shift = logistic(log_odds, label)
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, fold: int = FOLD, folds: int = FOLDS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row."""
    pairs = ids_and_texts(docs)
    model = fit(pairs, labels, fold, folds)
    rows = pairs.select("doc_id", held_out(fold, folds).alias("held_out"), "text")

    def scored(batches):
        for batch in batches:
            score = np.full(batch.num_rows, 0.5) if model is None else model.scores(batch.column(2))
            yield batch_of(doc_id=batch.column(0), held_out=batch.column(1), score=pa.array(score, pa.float64()))

    result = rows.mapInArrow(scored, "doc_id long, held_out boolean, score double")
    return result.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
