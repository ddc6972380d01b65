"""Toxicity by a support vector machine over a subsequence string kernel.

Kernel. A word's features are its subsequences of three letters that span at most
``SPAN`` letters, weighted by ``DECAY`` to the power of the span, so a letter put in
between or left out weakens a match and does not end it; the kernel is squared. Case, punctuation inside
words and common look-alike digits are folded first, and letters set apart by single
separators are read as one word. A sentence's similarity to a landmark is that of its
best word; words of more than ``PART`` letters are read in overlapping parts.

Nyström landmarks. Letter runs that toxic training sentences have and others lack
(by the log-likelihood ratio of document counts) and that together cover the toxic
documents are the landmarks. A word's kernel
values with them, times the inverse root of the landmarks' own kernel matrix, are its
coordinates; a squared-hinge support vector machine is fitted to them. The words
of toxic and of clean sentences are its examples, those most like a landmark first,
weighted by the share of documents that hold them. A document scores as its worst sentence does, turned
into a probability by a logistic curve fitted to the training documents.

The fit reads a sample of at most ``PER_CLASS`` documents of each class, whole;
scoring reads every word of every text. The fitted model is a few kilobytes. Its size and
the fit's are bounded: at most ``LANDMARKS`` landmarks, chosen among the ``CANDIDATE_RUNS``
runs of letters that most toxic documents of the sample hold, and as examples words whose
kernel value with some landmark is above 0.1, of three kinds (most toxic, most like a
landmark, commonest among clean documents) ``HARDEST`` each at most. All of that concerns the sample, none of it
the documents that are scored.

Cases: null and empty texts, and texts without words, score as the model's floor;
without labelled rows of both classes, or where no run of letters tells the sample's classes
apart, every score is 0; labels, lang, source and ids are not read by a score.
"""

from __future__ import annotations

import math
import re
import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.columns import ids_and_texts, without
from shelfwise.llm.kept import kept
from shelfwise.llm.sampling import held_out, labelled_sample
from shelfwise.llm.staging import staged

SPAN, DECAY, POWER = 6, 0.9, 2
PART = 24
RUNS = range(5, 9)
LANDMARKS = 96
CANDIDATE_RUNS = 50_000
LEAST_COVER, PURITY, COVERS = 0.004, 0.85, 3
PER_CLASS = 2500
HARDEST = 8_000
CLEAN_WEIGHT = 6.0
CACHED_WORDS = 100_000
FOLD, FOLDS = 1, 3
THRESHOLD = 0.7

#: Digits and signs that stand for letters.
LOOK_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

#: Single letters set apart: "i d i o t", "i.d.i.o.t".
APART = re.compile(r"(?<!\S)\w(?:[ ._*-]\w){3,}(?!\S)")

_OFFSETS = [(i, j) for j in range(2, SPAN) for i in range(1, j)]


#: Stands before a word, as one more letter: many insults are stems with changing ends.
START = "^"


def _alphabet() -> np.ndarray:
    """Six-bit codes of the first 2**16 characters: a to z, START, classes of other letters, 0 for the rest."""
    codes = np.zeros(1 << 16, np.uint8)
    codes[0xC0:] = 28 + np.arange((1 << 16) - 0xC0) % 36
    for k in range(26):
        codes[ord("a") + k] = k + 1
    codes[ord(START)] = 27
    for sign, letter in LOOK_ALIKE.items():
        codes[ord(sign)] = codes[ord(letter)]
    return codes


CODES = _alphabet()


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word number, three-letter code and weight of every subsequence of the words' letters."""
    points = np.frombuffer("\n".join(words).encode("utf-32-le", "replace"), np.uint32)
    word = np.cumsum(points == 10)
    letters = CODES[np.minimum(points, (1 << 16) - 1)].astype(np.int32)
    word, letters = word[letters > 0], letters[letters > 0]
    owners, codes, weights = [], [], []
    for i, j in _OFFSETS:
        if len(letters) > j:
            one = word[:-j] == word[j:]
            made = (letters[:-j] << 12) | (letters[i : len(letters) - j + i] << 6) | letters[j:]
            owners.append(word[:-j][one])
            codes.append(made[one])
            weights.append(np.full(int(one.sum()), DECAY ** (j + 1)))
    if not owners:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0)
    return np.concatenate(owners), np.concatenate(codes), np.concatenate(weights)


def parts_of(word: str) -> list[str]:
    """A word with its start mark, or overlapping parts of it."""
    word = START + word
    return [word] if len(word) <= PART else [word[k : k + PART] for k in range(0, len(word) - PART // 2, PART // 2)]


class Landmarks:
    """Kernel values with a few landmarks, by their subsequences' weights."""

    def __init__(self, names: list[str]):
        self.names = names
        owner, code, weight = subsequences(names)
        codes, row = np.unique(code, return_inverse=True)
        self.row_of = np.full(1 << 18, -1, np.int32)
        self.row_of[codes] = np.arange(len(codes))
        self.table = np.zeros((len(codes), len(names)), np.float32)
        np.add.at(self.table, (row, owner), weight)
        matrix = self.table.T.astype(float) @ self.table
        self.own = np.sqrt(np.diag(matrix))
        values, vectors = np.linalg.eigh((matrix / np.outer(self.own, self.own)) ** POWER)
        self.root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T

    def __reduce__(self):
        return Landmarks, (self.names,)

    def similarity(self, words: list[str]) -> np.ndarray:
        """How much of each landmark a word holds, 0 to 1 (words x landmarks)."""
        result = np.zeros((len(words), len(self.names)), np.float32)
        pieces = [parts_of(w) for w in words]
        owner, code, weight = subsequences([p for ps in pieces for p in ps])
        code = self.row_of[code]
        word = np.repeat(np.arange(len(words)), [len(ps) for ps in pieces])
        keep = code >= 0
        owner, code, weight = owner[keep], code[keep], weight[keep]
        if not len(owner):
            return result
        order = np.argsort(owner, kind="stable")
        owner, code, weight = owner[order], code[order], weight[order].astype(np.float32)
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        sums = np.add.reduceat(self.table[code] * weight[:, None], first, axis=0)
        np.maximum.at(result, word[owner[first]], np.minimum(sums / (self.own**2).astype(np.float32), 1) ** POWER)
        return result


@dataclass
class Model:
    """Landmarks, and the weights of a word's similarities to them."""

    landmarks: Landmarks
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def margins(self, words: list[str]) -> np.ndarray:
        return self.landmarks.similarity(words) @ self.weights + self.bias


def text_words(text: str) -> set[str]:
    """The distinct words of a text in lower case, with set-apart letters joined."""
    text = text.lower()
    return {*text.split(), *(re.sub(r"[ ._*-]", "", m) for m in APART.findall(text))}


def document_margins(model: Model, texts: list[str], known: dict[str, float]) -> np.ndarray:
    """The largest margin of each text's words; ``known`` keeps margins between calls."""
    found = [text_words(t) for t in texts]
    if len(known) > CACHED_WORDS:
        known.clear()
    new = list(set().union(*found) - known.keys())
    for k in range(0, len(new), 20_000):
        part = new[k : k + 20_000]
        known.update(zip(part, model.margins(part).tolist(), strict=True))
    floor = float(model.bias)
    return np.array([max(map(known.__getitem__, words), default=floor) for words in found])


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Newton steps for a linear support vector machine."""
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    beta = np.zeros(x.shape[1])

    def loss(at: np.ndarray) -> float:
        return float(weight @ np.maximum(0, 1 - y * (x @ at)) ** 2 + penalty @ at**2)

    for _ in range(100):
        inside = y * (x @ beta) < 1
        xi, wi = x[inside], weight[inside]
        step = np.linalg.solve((xi * wi[:, None]).T @ xi + np.diag(penalty), (xi * wi[:, None]).T @ y[inside]) - beta
        length = 1.0
        while length > 1e-4 and loss(beta + length * step) > loss(beta):
            length /= 2
        beta = beta + length * step
        if np.abs(length * step).max() < 1e-7:
            break
    return beta[:-1], float(beta[-1])


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve with smoothed targets (Platt)."""
    high, low = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    target, balance = np.where(y > 0, high, low), np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    a = np.column_stack([x, np.ones(len(x))])
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        slope = (a * (balance * p * (1 - p) + 1e-9)[:, None]).T @ a + 1e-6 * np.eye(2)
        step = np.linalg.solve(slope, a.T @ (balance * (target - p)) - 1e-6 * beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


def _runs(text: str) -> set[str]:
    """The letter runs of a text's words; START counts as a letter."""
    marked = [START + w for w in text_words(text)]
    return {w[k : k + n] for w in marked for n in RUNS for k in range(len(w) - n + 1) if w[max(k, 1) : k + n].isalpha()}


def _runs_of(sample: DataFrame, only: set[str] | None = None) -> DataFrame:
    """(doc_id, run) for the distinct runs of each text, or those among ``only``."""

    def rows(batches):
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = _runs(text) if only is None else _runs(text) & only
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([doc] * len(found), pa.int64()), "run": pa.array(sorted(found), pa.string())})

    return sample.select("doc_id", "text").mapInArrow(rows, "doc_id long, run string")


def _landmark_names(sample: DataFrame, n_toxic: int, n_clean: int) -> list[str]:
    """Runs that explain the toxic documents: each covers documents that the ones before do not.

    A run counts if toxic documents hold it more often than chance allows, over all runs
    that were looked at. Covering keeps out the ordinary words of groups of toxic copies.
    """
    toxic, clean = sample.where("label = 1"), sample.where("label = 0")
    support = max(2, math.ceil(LEAST_COVER * n_toxic))
    frequent = _runs_of(toxic).groupBy("run").agg(F.countDistinct("doc_id").alias("toxic")).where(F.col("toxic") >= support)
    counts = frequent.orderBy(F.desc("toxic"), "run").limit(CANDIDATE_RUNS).toPandas()
    only = set(counts["run"])
    in_clean = _runs_of(clean, only).groupBy("run").agg(F.countDistinct("doc_id").alias("clean")).toPandas()
    counts = counts.merge(in_clean, on="run", how="left").fillna({"clean": 0})
    expected = (counts["toxic"] + counts["clean"]) * n_toxic / (n_toxic + n_clean)
    purity = (counts["toxic"] / n_toxic) / (counts["toxic"] / n_toxic + counts["clean"] / n_clean)
    counts["evidence"] = counts["toxic"] * np.log(counts["toxic"] / expected)
    good = counts[(purity > PURITY) & (counts["evidence"] > min(math.log(len(counts) + 1), 0.5 * counts["evidence"].max()))]
    evidence = dict(zip(good["run"], good["evidence"], strict=True))
    holders: dict[str, set[int]] = {}
    for doc, run in _runs_of(toxic, set(evidence)).collect():  # bounded by the sample and its candidate runs
        holders.setdefault(run, set()).add(doc)
    chosen: list[str] = []
    times: dict[int, int] = {}
    while holders and len(chosen) < LANDMARKS:
        most = max(len(docs) for docs in holders.values())
        if most < support:
            break
        best = max((r for r, docs in holders.items() if len(docs) >= 0.9 * most), key=lambda r: (len(r), evidence[r], r))
        for doc in holders.pop(best):
            times[doc] = times.get(doc, 0) + 1
        chosen.append(best)
        done = {doc for doc, n in times.items() if n >= COVERS}
        holders = {r: left for r, docs in holders.items() if not (r in best or best in r) and (left := docs - done)}
    return chosen


def fit(docs: DataFrame, labels: DataFrame, fold: int = FOLD, folds: int = FOLDS, per_class: int = PER_CLASS) -> Model | None:
    """A model of labelled documents outside the held-out fold; None if a class is missing."""
    sample = staged(labelled_sample(docs, labels, "toxic", fold, folds, per_class), "toxic-sample")
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return None
    names = _landmark_names(sample, sizes[1], sizes[0])
    if not names:
        return None
    landmarks = Landmarks(names)

    def nearest(batches):
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = sorted(text_words(text))
                best = landmarks.similarity(words).max(axis=1) if words else np.empty(0)
                near = best > 0.1
                yield pa.RecordBatch.from_pydict(
                    {"label": pa.array([label] * int(near.sum()), pa.int32()), "word": pa.array([w for w, k in zip(words, near, strict=True) if k], pa.string()), "best": pa.array(best[near].astype(float))}
                )

    near = sample.select("label", "text").mapInArrow(nearest, "label int, word string, best double")
    counts = near.groupBy("word").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"), F.max("best").alias("best"))
    counts = staged(counts, "toxic-words")
    hard = counts.where("clean > 0").orderBy(F.desc("best"), "word").limit(HARDEST)
    usual = counts.where("clean > 0").orderBy(F.desc("clean"), "word").limit(HARDEST)
    bad = counts.where("toxic > 0").orderBy(F.desc(F.expr("toxic - clean")), F.desc("best"), "word").limit(HARDEST)
    seen = bad.union(hard).union(usual).distinct().toPandas()
    # A word stands once for each class, weighted by how many documents of it hold the word.
    words = [*seen["word"], *seen["word"], ""]
    y = np.repeat([1.0, -1.0], [len(seen), len(seen) + 1])
    weight = np.concatenate([seen["toxic"] / sizes[1], CLEAN_WEIGHT * seen["clean"] / sizes[0], [1.0]])
    x = landmarks.similarity(words).astype(float) @ landmarks.root
    beta, bias = _squared_hinge(x, y, weight)
    model = Model(landmarks, landmarks.root @ beta, bias)

    def margins(batches):
        known: dict[str, float] = {}
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"label": batch.column(0), "margin": pa.array(document_margins(model, batch.column(1).to_pylist(), known))})

    seen = sample.select("label", "text").mapInArrow(margins, "label int, margin double").toPandas()
    model.slope, model.shift = logistic(seen["margin"].to_numpy(), seen["label"].to_numpy(float))
    return model


def score_texts(model: Model | None, column: str = "text"):
    """The toxicity of a text column, as an expression."""

    @F.pandas_udf("double")
    def score(batches: pd.Series) -> pd.Series:
        texts = batches.fillna("").tolist()
        if model is None:
            return pd.Series(np.zeros(len(texts)))
        known = kept(model.name, dict)  # margins that the worker has worked out
        made = []
        for k in range(0, len(texts), 256):
            margins = document_margins(model, texts[k : k + 256], known)
            made.append(1 / (1 + np.exp(-np.clip(model.slope * margins + model.shift, -30, 30))))
        return pd.Series(np.concatenate(made) if made else np.empty(0))

    return score(F.col(column))


def toxicity_scores(docs: DataFrame, labels: DataFrame, fold: int = FOLD, folds: int = FOLDS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row."""
    pairs = ids_and_texts(docs)
    model = fit(pairs, labels, fold, folds)
    scored = pairs.select("doc_id", held_out(fold, folds).alias("held_out"), score_texts(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, training: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that a model of ``training`` and ``labels`` finds toxic."""
    model = fit(ids_and_texts(training), labels)
    name = "toxicity of the text"
    return without(docs.withColumn(name, score_texts(model)).where(F.col(name) < threshold), [name])
