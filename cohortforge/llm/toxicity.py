"""Toxicity: a support vector machine over a subsequence string kernel, with Nyström landmarks.

Kernel. Two words are compared by their gapped subsequences of ``P`` = 4 characters: one that spans s characters
weighs ``DECAY`` ** (s - P), spans up to ``SPAN``; the kernel is the inner product of these weights, divided by the root of the sum of squared weights of each word's places.
Inserted or left-out characters thus lower a match and don't undo it. Words are lower-cased, stripped of what is
neither letter nor digit and framed by end marks; runs of single characters (``a b c d``) are also read as one word,
and words over ``LONGEST`` characters in overlapping windows.

Machine. ``landmarks`` words span the feature space (Nyström: kernel to the landmarks times the inverse root of the
kernel among them). A sentence is as toxic as its most toxic word (a latent SVM): rounds of choosing each sentence's
word and fitting a squared-hinge SVM. As decision values are a sum over landmarks of kernels, and a kernel is an inner
product, the fitted machine folds exactly into one weight per subsequence, so scoring needs no landmark.

Document. A logistic curve over the sentence values (largest, sums and means above 0 and 0.5, their number) gives the
score.

Fit: whole texts of at most ``rows_per_class`` labelled rows of each class (a documented bound) with the smallest
hashes of their ids; the driver fits. Without labels of both classes every score is 0.

Edge cases: null and empty texts have no word and score like any text with none; null labels don't teach; of
several labels of a document each counts; repeated rows stay; very long texts are scored whole; an empty table gives no
rows; columns named ``score`` or ``predicted`` give way to the results, all others are carried along.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import Shared, bounded_batches, lean, slices, smallest_hashes

P, SPAN, DECAY, LONGEST = 4, 6, 0.6, 30
#: Offsets of the other characters from the first, and what they weigh.
COMBOS = [(0, *c) for c in combinations(range(1, SPAN), P - 1)]
WEIGHTS = np.array([DECAY ** (c[-1] - P + 1) for c in COMBOS], dtype=np.float32)
#: Characters fall into 64 classes: end marks, digits, letters; rare letters share classes by code.
END, CLASSES = 1, 64
#: Words that a scorer remembers, and of which the fit remembers the pieces.
MEMORY, FIT_MEMORY = 250_000, 30_000
#: Characters cut into words at once (a longer text goes whole).
CHUNK = 1_000_000
SINGLES = 4


def _classes() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    out[:] = 40 + np.arange(0x110000) % 24
    for i, c in enumerate("abcdefghijklmnopqrstuvwxyz"):
        out[ord(c)] = 2 + i
    for i, c in enumerate("0123456789"):
        out[ord(c)] = 28 + i
    out[ord("^")] = END
    return out


CLASS_OF = _classes()
_strip = re.compile(r"[\W_]+").sub


def pieces(word: str) -> list[str]:
    """The framed windows by which a lower-cased word is compared; none for words without letters or digits."""
    bare = word if word.isalnum() else _strip("", word)
    if not bare:
        return []
    framed = f"^{bare}^" if len(bare) > 1 else f"^{bare}^^"
    if len(framed) <= LONGEST:
        return [framed]
    return [framed[i : i + LONGEST] for i in range(0, len(framed) - LONGEST // 2, LONGEST // 2)]


def _norms() -> np.ndarray:
    """By length of a framed word: root of the sum of the squared weights of its subsequences, each place by itself."""
    lengths = np.arange(LONGEST + 1)
    total = sum(w * w * np.maximum(lengths - c[-1], 0) for c, w in zip(COMBOS, WEIGHTS))
    return np.sqrt(np.maximum(total, 1e-12))


NORM_OF = _norms()


def subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Per combination of offsets: keys, places in the joined words where they begin, and their weight."""
    codes = CLASS_OF[np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)].astype(np.int32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters from here to the word's end
    shifted = [np.append(codes[k:], np.zeros(k, np.int32)) for k in range(SPAN)]
    inside = {k: np.flatnonzero(left > k) for k in range(P - 1, SPAN)}
    three: dict[tuple, np.ndarray] = {}
    for c, w in zip(COMBOS, WEIGHTS):
        if c[:3] not in three:
            three[c[:3]] = (codes << 12 | shifted[c[1]] << 6 | shifted[c[2]]) << 6
        at = inside[c[-1]]
        yield (three[c[:3]] | shifted[c[3]])[at], at, float(w)


def word_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Of each character of the joined words its word; lengths of the words."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.repeat(np.arange(len(words)), lengths), lengths


def landmark_features(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted subsequences of all landmarks and their normalised weights, a column per landmark."""
    of, lengths = word_of(landmarks)
    keys, cols, weights = [], [], []
    for k, at, w in subsequences(landmarks):
        keys.append(k)
        cols.append(of[at])
        weights.append(np.full(len(k), w) / NORM_OF[lengths[of[at]]])
    kinds, place = np.unique(np.concatenate(keys), return_inverse=True)
    table = np.zeros((len(kinds), len(landmarks)), np.float32)
    np.add.at(table, (place, np.concatenate(cols)), np.concatenate(weights))
    return kinds, table


def kernel(words: list[str], kinds: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Normalised kernel of every word with every landmark."""
    out = np.zeros((len(words), table.shape[1]), np.float32)
    for s in range(0, len(words), 500):
        part = words[s : s + 500]
        of, lengths = word_of(part)
        counts = np.zeros((len(part), len(kinds)), np.float32)
        for k, at, w in subsequences(part):
            place = np.searchsorted(kinds, k)
            place[place == len(kinds)] = 0
            hit = kinds[place] == k
            np.add.at(counts, (of[at[hit]], place[hit]), np.float32(w))
        out[s : s + 500] = counts @ table / NORM_OF[lengths][:, None]
    return out


@dataclass
class Model:
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    bias: float = 0.0
    curve: np.ndarray | None = None  # logistic over document_features, the constant last


class Scorer:
    """Word values by a table over all subsequences; remembers words between calls."""

    def __init__(self, model: Model):
        self.model, self.memory = model, {}
        first = np.unique(model.keys >> 12)  # a block of the table for every first two characters that have weights, block 0 for all others
        self.block = np.zeros(1 << 12, np.int32)
        self.block[first] = np.arange(1, len(first) + 1) << 12
        self.table = np.zeros(len(first) + 1 << 12, np.float32)
        self.table[self.places(model.keys)] = model.weights
        self.values = np.zeros(1 << 16, np.float32)
        self.flags = np.zeros(1 << 16, np.uint8)

    def places(self, keys: np.ndarray) -> np.ndarray:
        return self.block[keys >> 12] + (keys & 4095)

    def framed(self, framed: list[str]) -> np.ndarray:
        """Values of framed words: a look-up per subsequence."""
        out = []
        for s in range(0, len(framed), 4000):
            part = framed[s : s + 4000]
            of, lengths = word_of(part)
            sums = np.zeros(len(of), np.float32)
            for k, at, w in subsequences(part):
                sums[at] += self.table[self.places(k)] * np.float32(w)
            starts = np.cumsum(lengths) - lengths
            out.append(np.add.reduceat(sums, starts) / NORM_OF[lengths] + self.model.bias)
        return np.concatenate(out).astype(np.float32) if out else np.zeros(0, np.float32)

    def _values(self, words: list[str]) -> np.ndarray:
        cut = [pieces(w) for w in words]
        sizes = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = self.framed([x for c in cut for x in c])
        out = np.full(len(words), self.model.bias, np.float32)
        some = sizes > 0
        if some.any():
            out[some] = np.maximum.reduceat(flat, (np.cumsum(sizes) - sizes)[some])
        return out

    def _learn(self, words: list[str]) -> None:
        base = len(self.memory)
        while base + len(words) > len(self.values):
            self.values, self.flags = np.append(self.values, np.zeros_like(self.values)), np.append(self.flags, np.zeros_like(self.flags))
        self.values[base : base + len(words)] = self._values(words)
        ends = np.fromiter((w[-1] in ".!?" for w in words), np.uint8, len(words))
        self.flags[base : base + len(words)] = ends | np.fromiter((len(w) == 1 for w in words), np.uint8, len(words)) << 1
        self.memory.update(zip(words, range(base, base + len(words))))

    def sentences(self, texts: list[str]) -> list[np.ndarray]:
        """Per text the value of each sentence: that of its most toxic word."""
        return [v for i, j in slices([len(t) for t in texts], CHUNK) for v in self._sentences(texts[i:j])]

    def _sentences(self, texts: list[str]) -> list[np.ndarray]:
        split = [t.lower().split() for t in texts]
        if len(self.memory) > MEMORY:
            self.memory.clear()
        fresh = list(set().union(*split).difference(self.memory))
        self._learn(fresh)
        look, out = self.memory.__getitem__, []
        for words in split:
            if not words:
                out.append(np.zeros(0, np.float32))
                continue
            at = np.fromiter(map(look, words), np.int64, len(words))
            values, flags = self.values[at], self.flags[at]
            if (flags & 2).sum() >= SINGLES:
                values = self._with_runs(words, values, flags & 2 > 0)
            starts = np.flatnonzero(np.append(1, flags[:-1] & 1))
            out.append(np.maximum.reduceat(values, starts))
        return out

    def _with_runs(self, words: list[str], values: np.ndarray, single: np.ndarray) -> np.ndarray:
        """Runs of single characters also count as the word they spell, at their first place."""
        edge = np.flatnonzero(np.diff(np.concatenate([[0], single.view(np.int8), [0]])))
        runs = [(a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= SINGLES]
        if runs:
            values = values.copy()
            spelt = self._values(["".join(words[a:b]) for a, b in runs])
            for (a, _), v in zip(runs, spelt):
                values[a] = max(values[a], v)
        return values


def document_features(sentences: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sentences), 9))
    out[:, 8] = 1
    for row, v in zip(out, sentences):
        if len(v):
            most, above = v.max(), np.maximum(v, 0)
            half = np.maximum(v - 0.5, 0)
            row[:8] = (min(max(most, 0), 1), min(max(most - 0.5, 0), 0.5) * 2, np.log1p(above.sum()), np.log1p(2 * half.sum()),
                       np.sqrt(above.mean()), np.sqrt(2 * half.mean()), (v > 0.5).any(), np.log1p(len(v)) / 5)
    return out


def _svm(x: np.ndarray, plus: np.ndarray, minus: np.ndarray, ridge: float) -> np.ndarray:
    """Squared hinge with ridge by Newton steps; plus and minus weigh each row as either class, the last column is the constant."""
    w = np.zeros(x.shape[1])
    penal = np.append(np.full(x.shape[1] - 1, ridge), 1e-6)
    for _ in range(30):
        f = x @ w
        up, down = plus * (f < 1), minus * (f > -1)
        bend = np.diag(penal)
        for s in range(0, len(x), 2000):
            part = x[s : s + 2000].astype(np.float64)
            bend += part.T @ (part * (up + down)[s : s + 2000, None])
        step = np.linalg.solve(bend, penal * w + x.T @ (down * (1 + f) - up * (1 - f)))
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _numbered(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different pieces of all texts, sorted; the place there of each piece in turn; where its sentences and its
    texts begin; the first sentence of each text, their number last. A few bytes a word: the driver holds them all at once."""
    number: dict[str, int] = {}
    known: dict[str, tuple[int, ...]] = {}
    flat, sentences, begins, firsts = array("i"), array("q"), array("q"), array("q")
    for t in texts:
        begins.append(len(flat))
        firsts.append(len(sentences))
        for s in re.split(r"(?<=[.!?])\s+", t.lower()):
            start = len(flat)
            for w in s.split():
                if w not in known:
                    if len(known) >= FIT_MEMORY:
                        known.clear()
                    known[w] = tuple(number.setdefault(x, len(number)) for x in pieces(w))
                flat.extend(known[w])
            if len(flat) > start:
                sentences.append(start)
    firsts.append(len(sentences))
    words = sorted(number)
    place = np.zeros(len(words), np.int32)
    place[[number[w] for w in words]] = np.arange(len(words))
    return words, place[np.array(flat, np.int32)], np.array(sentences, np.int64), np.array(begins, np.int64), np.array(firsts, np.int64)


def fit(texts: list[str], toxic: list[int], landmarks: int = 256, rounds: int = 3, ridge: float = 1.0) -> Model:
    """Texts of the bounded sample with labels 0/1."""
    y = np.array(toxic)
    if len(set(toxic)) < 2:
        return Model()
    words, flat, sentences, begins, firsts = _numbered(texts)
    inside, outside = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for d, label in zip(np.split(flat, begins[1:]), toxic):
        (inside if label else outside)[np.unique(d)] += 1
    hot, cold = max(1, y.sum()), max(1, (1 - y).sum())
    odds = np.log((inside + 0.3) / (hot + 1)) - np.log((outside + 0.3) / (cold + 1))
    several = np.flatnonzero(inside > 1)
    best = several[np.argsort(-odds[several] * np.sqrt(inside[several]), kind="stable")][: landmarks // 2]  # of equal ones the first word
    rest = np.setdiff1d(np.flatnonzero(outside), best)
    often = rest[np.argsort(-outside[rest], kind="stable")]
    chosen = [words[i] for i in [*best, *often[: 4 * landmarks : 4][: landmarks - len(best)]]]
    kinds, table = landmark_features(chosen)
    values, vectors = np.linalg.eigh(kernel(chosen, kinds, table).astype(np.float64))
    root = vectors @ np.diag(np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)) @ vectors.T
    score = np.where(inside > 1, odds, 0.0)
    model = Model()
    for turn in range(rounds):
        order = np.argsort(score, kind="stable")
        rank = np.zeros(len(words), np.int32)
        rank[order] = np.arange(len(words))
        most = np.maximum.reduceat(rank[flat], sentences) if len(sentences) else rank[:0]  # of each sentence
        chosen, labels, weights = [], [], []
        for begin, end, label in zip(firsts[:-1], firsts[1:], toxic):
            picks = most[begin:end]
            if not len(picks):
                continue
            if label:  # a toxic text need not be toxic in every sentence, but in one
                keep = picks[score[order[picks]] > (1.5 if turn == 0 else 0)]
                if turn == 0 and not len(keep):
                    keep = picks.max(keepdims=True)
            else:
                keep = np.append(np.sort(picks)[::-1][:5], picks[:: max(1, len(picks) // 5)])
            chosen += [words[i] for i in order[keep]]
            labels += [1 if label else -1] * len(keep)
            weights += [1 / len(keep)] * len(keep) if len(keep) else []
        # the most telling words once more, each with a letter inserted in turn at every inner place
        telling = [words[i] for i in best[: landmarks // 4] if score[i] > 0.5] if turn else []
        spread = [w[:i] + "aeixz"[i % 5] + w[i:] for w in telling for i in range(3, len(w) - 1)]
        chosen += spread
        labels += [1] * len(spread)
        weights += [0.3] * len(spread)
        if len(set(labels)) < 2:
            break
        yy, ww = np.array(labels, float), np.array(weights)
        for s in (1, -1):
            ww[yy == s] *= len(yy) / 2 / ww[yy == s].sum()
        different, at = np.unique(np.array(chosen, object), return_inverse=True)
        x = np.hstack([kernel(list(different), kinds, table) @ root.astype(np.float32), np.ones((len(different), 1), np.float32)])
        side = np.bincount(at, ww * yy), np.bincount(at, ww)
        w = _svm(x, (side[1] + side[0]) / 2, (side[1] - side[0]) / 2, ridge)
        alpha = root @ w[:-1]
        model = Model(kinds, (table @ alpha).astype(np.float32), float(w[-1]))
        score = Scorer(model).framed(words).astype(np.float64)
    del words, flat  # before the words of the texts are remembered
    scorer = Scorer(model)
    model.curve = _logistic(document_features(scorer.sentences(texts)), y)
    return model


def sample_rows(docs: DataFrame, labels: DataFrame, rows_per_class: int) -> DataFrame:
    """(text, toxic) of the labelled documents with the smallest hashes: at most so many labels of each class."""
    marks = labels.where("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("toxic"))
    some = smallest_hashes(marks, "toxic", ["__id"], rows_per_class)
    return docs.join(F.broadcast(some), F.col("doc_id") == F.col("__id")).where("text is not null").select("text", "toxic")  # 2 * rows_per_class rows


def score_texts(docs: DataFrame, model: Model, threshold: float = 0.3, keep_only_clean: bool = False) -> DataFrame:
    """docs with a whole text each -> their columns plus score and predicted; or the columns of those below the threshold."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = Shared(spark, model)  # bounded by the landmarks

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        curve = shared.value.curve
        for pdf in batches:
            x = document_features(scorer.sentences([t or "" for t in pdf["text"]]))
            score = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30))) if curve is not None else np.zeros(len(x))
            if keep_only_clean:
                yield pdf[score < threshold]
            else:
                yield pdf.assign(score=score, predicted=(score >= threshold).astype(np.int32))

    schema = docs.schema
    if not keep_only_clean:
        schema = T.StructType([f for f in schema.fields if f.name not in ("score", "predicted")]).add("score", T.DoubleType()).add("predicted", T.IntegerType())
    return docs.mapInPandas(lean(run), schema)
