"""Toxicity by a subsequence string kernel, Nyström landmarks and a support vector machine.

The kernel of two words counts the three-letter subsequences they share, each weighed by a
decay per letter that it spans, gaps included. ``idiot``, ``idxiot`` and ``i d i o t`` are
close in it. Labels are per text, so the machine learns from the words of labelled texts:
words that toxic texts share beyond chance and clean texts never have are positive, words of
clean texts negative, and the most mistaken of these are added round by round. A word is
described by its kernels with landmark words, made orthonormal (Nyström); a linear machine
with squared hinge loss separates them. A text scores as its worst word, mapped to a
probability on the training texts.

As the machine is linear, all landmarks fold into one weight per subsequence. So every
distinct word of a text is scored by summing weights, whatever the number of landmarks, and
each word of a whole text counts.
"""

from __future__ import annotations

import math
import re
import sys
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from churnlake.llm.words import OBJECT_BYTES, chunks, tidy

#: Labelled texts to learn from: at most so many toxic and clean ones, by a hash of doc_id.
MAX_TOXIC, MAX_CLEAN = 1500, 3000
LANDMARKS = 320
DECAY = 0.7
#: Price of a word on the wrong side of the margin.
COST = 20.0
#: Letters that a subsequence may span.
SPAN = 6
#: Letters of a word looked at together; longer words are covered by overlapping stretches.
STRETCH = 24
_LETTERS = 64
#: Letters with a code of their own; the others share the rest by a hash.
_COMMON = 46
_PATTERNS = [(i, j) for i in range(1, SPAN - 1) for j in range(1, SPAN - i)]
#: Scored words that a worker keeps at hand.
REMEMBERED = 1_000_000
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def variants(word: str) -> list[str]:
    """What is scored for a word: the word, and its letters alone, in stretches, with marks at
    both ends."""
    bare = _NOT_LETTERS.sub("", word)
    out = []
    for unit in {word, bare} if bare else {word}:
        if len(unit) <= STRETCH:
            out.append(unit)
        else:
            out.extend(unit[i : i + STRETCH] for i in range(0, len(unit) - STRETCH // 2, STRETCH // 2))
    return [f" {unit} " for unit in out]


def units_of(text: str) -> set[str]:
    """Distinct lower-cased words of a text, and runs of three or more single letters as one
    word each."""
    words = text.lower().split()
    found = set(words)
    single = [i for i, w in enumerate(words) if len(w) == 1 and w.isalpha()]
    run: list[int] = []
    for i in [*single, -2]:
        if run and i != run[-1] + 1:
            if len(run) > 2:
                found.add("".join(words[j] for j in run))
            run = []
        run.append(i)
    return found


class Kernel:
    """Subsequences of three letters as indices into a table of weights."""

    def __init__(self, alphabet: str):
        self.alphabet = (" " + alphabet)[: _COMMON + 1]  # a space marks the ends of a word
        points = np.arange(0x110000, dtype=np.uint64)
        rest = _LETTERS - _COMMON - 1
        self.code = (_COMMON + 1 + ((points * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(rest)).astype(np.int32)
        for i, c in enumerate(self.alphabet):
            self.code[ord(c)] = i

    def _letters(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.code[points], np.array([len(w) for w in words], np.int64)

    def norms(self, lengths: np.ndarray) -> np.ndarray:
        total = np.zeros(len(lengths))
        for i, j in _PATTERNS:
            total += np.maximum(0, lengths - i - j) * DECAY ** (2 * (i + j + 1))
        return np.sqrt(np.maximum(total, 1e-12))

    def each(self, words: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
        """For each pattern of gaps: the letters' places it starts at, the subsequences there,
        and their weight."""
        letters, lengths = self._letters(words)
        ends = np.repeat(np.cumsum(lengths), lengths)
        for i, j in _PATTERNS:
            at = np.arange(max(0, len(letters) - i - j))
            at = at[at + i + j < ends[at]]
            yield at, (letters[at] * _LETTERS + letters[at + i]) * _LETTERS + letters[at + i + j], DECAY ** (i + j + 1)

    def scores(self, words: Sequence[str], weights: np.ndarray) -> np.ndarray:
        """Normalised sum of ``weights`` over the subsequences of each word."""
        lengths = np.array([len(w) for w in words], np.int64)
        sums = np.zeros(int(lengths.sum()))
        for at, features, weight in self.each(words):
            sums[at] += weights[features] * weight
        if not len(words):
            return np.zeros(0)
        # Each word by itself, so that its score does not depend on the words before it.
        return np.add.reduceat(sums, np.cumsum(lengths) - lengths) / self.norms(lengths)

    def against(self, words: Sequence[str], landmarks: Sequence[str]) -> np.ndarray:
        """Kernels of words (rows) with landmarks (columns)."""
        letters = np.array([len(w) for w in landmarks], np.int64)
        column = np.repeat(np.arange(len(landmarks)), letters)
        found = [(features, column[at], weight) for at, features, weight in self.each(landmarks)]
        used = np.unique(np.concatenate([f for f, _, _ in found]))
        row = np.zeros(_LETTERS**3, np.int32)
        row[used] = np.arange(1, len(used) + 1)
        # Only subsequences of landmarks have a row; the first row stands for all others.
        dense = np.zeros((len(used) + 1, len(landmarks)))
        for features, columns, weight in found:
            np.add.at(dense, (row[features], columns), weight)
        dense /= self.norms(letters)
        out = np.zeros((len(words), len(landmarks)))
        for first in range(0, len(words), 500):
            part = words[first : first + 500]
            lengths = np.array([len(w) for w in part], np.int64)
            owner = np.repeat(np.arange(len(part)), lengths)
            for at, features, weight in self.each(part):
                rows = row[features]
                at, rows = at[rows > 0], rows[rows > 0]
                if len(at):  # places are in order, so each word's are together
                    starts = np.flatnonzero(np.diff(owner[at], prepend=-1))
                    out[first + owner[at[starts]]] += np.add.reduceat(dense[rows], starts) * weight
            out[first : first + len(part)] /= self.norms(lengths)[:, None]
        return out

    def table(self, word: str) -> np.ndarray:
        """A word as weights of its subsequences: its kernel with x is ``scores(x, table)``."""
        out = np.zeros(_LETTERS**3)
        for _, features, weight in self.each([word]):
            np.add.at(out, features, weight)
        return out / self.norms(np.array([len(word)]))[0]


@dataclass
class ToxicModel:
    """One weight per subsequence, a bias, and the map from margin to probability."""

    alphabet: str
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def margins(self, words: Sequence[str], kernel: Kernel) -> np.ndarray:
        """Margin of each word: that of its worst variant."""
        out = [np.zeros(0)]
        for first in range(0, len(words), 50_000):
            each = [variants(w) for w in words[first : first + 50_000]]
            flat = kernel.scores([u for v in each for u in v], self.weights)
            starts = np.cumsum([0] + [len(v) for v in each[:-1]])
            out.append(np.maximum.reduceat(flat, starts) + self.bias)
        return np.concatenate(out)

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -60, 60)))


def _independent(texts: list[str]) -> list[int]:
    """Texts that are no copies of an earlier one: none of four min-hashes of five-word runs
    is known already."""
    keep, seen = [], [set(), set(), set(), set()]
    for i, text in enumerate(texts):
        words = text.lower().split()
        # A hash that does not change from process to process.
        runs = [zlib.crc32(" ".join(words[j : j + 5]).encode("utf-8", "surrogatepass")) + 1 for j in range(max(1, len(words) - 4))]
        marks = [min((r * m) & 0xFFFFFFFFFFFF for r in runs) for m in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]
        if not any(m in s for m, s in zip(marks, seen)):
            keep.append(i)
            for m, s in zip(marks, seen):
                s.add(m)
    return keep


def _positive_words(bad: list[set[str]], good: list[set[str]]) -> dict[str, int]:
    """Words that are found in more toxic texts than chance allows and mostly in toxic ones,
    and the best such word of each toxic text that has none. Labels may be wrong."""
    in_bad, in_good = Counter(w for d in bad for w in d), Counter(w for d in good for w in d)
    rate = len(bad) / (len(bad) + len(good))
    limit = math.log(0.05 / max(1, len(in_bad)))

    def surprise(word: str) -> float:
        """Log of Chernoff's bound on the chance of so many toxic texts."""
        a, n = in_bad[word], in_bad[word] + in_good[word]
        share = a / n
        if share <= rate:
            return 0.0
        rest = (1 - share) * math.log((1 - share) / (1 - rate)) if share < 1 else 0.0
        return -n * (share * math.log(share / rate) + rest)

    own = {w: n for w, n in in_bad.items() if n > 1 and 2 * n > in_bad[w] + in_good[w] and len(w) > 2}
    sure = {w: n for w, n in own.items() if surprise(w) < limit}
    more = {}
    for doc in bad:
        if not doc & sure.keys():
            best = min((w for w in doc if w in own and w not in in_good), key=lambda w: (surprise(w), w), default=None)
            if best is not None and (not sure or surprise(best) < limit / 3):
                more[best] = own[best]
    return sure | more


def _support_vectors(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Linear machine with squared hinge loss by Newton steps; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        inside = y * (x @ w) < 1
        xs = x[inside] * cost[inside, None]
        new = np.linalg.solve(ridge + xs.T @ x[inside], xs.T @ y[inside])
        if np.allclose(new, w, atol=1e-8):
            break
        w = new
    return w


def fit(texts: Sequence[str], toxic: Sequence[int]) -> ToxicModel:
    """Learn from labelled texts. Without any word that toxic texts alone share, every text
    gets the share of toxic ones as its score."""
    toxic = np.array(toxic, int)
    # Equal words of all texts are one object, which keeps the driver's memory small.
    docs = [set(map(sys.intern, units_of(t))) for t in texts]
    rate = (toxic.sum() + 1) / (len(toxic) + 2)
    letters = Counter(c for d in docs for w in d for c in w if c.isalpha())
    common = sorted(letters, key=lambda c: (-letters[c], c))[:_COMMON]
    alphabet = "".join(sorted(common))
    kernel = Kernel(alphabet)
    alone = _independent(list(texts))
    bad, good = [docs[i] for i in alone if toxic[i]], [docs[i] for i in alone if not toxic[i]]
    found = _positive_words(bad, good) if bad and good else {}
    model = ToxicModel(alphabet, np.zeros(_LETTERS**3), 0.0, 0.0, math.log(rate / (1 - rate)))
    if not found:
        return model
    shown = lambda words: [f" {w} " for w in words]
    positive = sorted(found, key=lambda w: (-found[w], w))
    clean = sorted(set().union(*(docs[i] for i in range(len(docs)) if not toxic[i])) - found.keys())
    negative = dict.fromkeys(clean[:: max(1, len(clean) // 3000)])
    hard: list[str] = list(negative)[:: max(1, len(negative) // 32)]
    for _ in range(5):
        landmarks = positive[: LANDMARKS // 2]
        landmarks += hard[: LANDMARKS - len(landmarks)]
        between = kernel.against(shown(landmarks), shown(landmarks))
        values, vectors = np.linalg.eigh((between + between.T) / 2)
        axes = values > 1e-6 * values.max()
        map_ = vectors[:, axes] / np.sqrt(values[axes])  # Nyström: kernels to features
        words = positive + list(negative)
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        w = _support_vectors(kernel.against(shown(words), shown(landmarks)) @ map_, y, np.full(len(y), COST))
        model.bias = float(w[-1])
        model.weights = np.zeros(_LETTERS**3)
        for share, landmark in zip(map_ @ w[:-1], shown(landmarks)):
            model.weights += share * kernel.table(landmark)
        margin = model.margins(clean, kernel)
        worst = [clean[i] for i in np.argsort(-margin, kind="stable")[:1500] if margin[i] > -1]
        negative |= dict.fromkeys(worst)
        hard = list(dict.fromkeys(worst[:64] + hard))
    worst = np.array([model.margins(list(d), kernel).max(initial=model.bias) for d in docs])
    # Labels may be wrong; targets stop short of 0 and 1 (as in Platt's map).
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    target = np.where(toxic == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * worst + offset, -60, 60)))
        g, h = p - target, np.maximum(p * (1 - p), 1e-9)
        a = np.array([[(h * worst * worst).sum() + 1e-6, (h * worst).sum()], [(h * worst).sum(), h.sum() + 1e-6]])
        move = np.linalg.solve(a, [(g * worst).sum(), g.sum()])
        slope, offset = slope - np.clip(move[0], -1, 1), offset - np.clip(move[1], -1, 1)
    model.slope, model.offset = float(max(slope, 1e-3)), float(offset)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that are kept from learning: crc32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> ToxicModel:
    """Fit on a bounded sample of the labelled rows that are not held out.

    At most ``max_toxic`` toxic and ``max_clean`` clean labels, by a hash of doc_id, are
    looked up in ``docs``. Null labels and texts are left out; of several labels of a
    document the toxic one counts. If doc_ids repeat, the bound holds for the rows of each
    class by itself.
    """
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.filter("toxic = 1").orderBy(*order).limit(max_toxic).union(known.filter("toxic <> 1").orderBy(*order).limit(max_clean))
    # No more rows than asked for are broadcast; a doc_id may have many texts.
    known_texts = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(picked), "doc_id")
    toxic = known_texts.filter("toxic = 1").orderBy(*order, "text").limit(max_toxic)
    clean = known_texts.filter("toxic <> 1").orderBy(*order, "text").limit(max_clean)
    rows = [*clean.collect(), *toxic.collect()]
    return fit([r["text"] for r in rows], [int(r["toxic"] == 1) for r in rows])


class _Scorer:
    def __init__(self, model: ToxicModel):
        self.model, self.kernel = model, Kernel(model.alphabet)
        self.known: dict[str, float] = {}

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        docs = [units_of(t or "") for t in texts]
        distinct = set().union(*docs)
        if len(self.known) + len(distinct) > REMEMBERED:
            self.known.clear()
        new = [w for w in distinct if w not in self.known]
        self.known.update(zip(new, self.model.margins(new, self.kernel).tolist()))
        known, empty = self.known.__getitem__, self.model.bias
        worst = np.array([max(map(known, d), default=empty) for d in docs], float)
        return self.model.probability(worst)


def _score(model: ToxicModel, column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(model)
        for batch in batches:
            for part in chunks(batch, each=OBJECT_BYTES):
                scores = pa.array(scorer(part.column("text").to_pylist()), pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, scores], names=[*part.schema.names, column])

    return run


def score_texts(docs: DataFrame, model: ToxicModel, column: str = "toxicity") -> DataFrame:
    """``docs`` with the toxicity of ``text``, from 0 to 1, in ``column``.

    A null or empty text scores as one without any known word. All rows and columns are kept,
    nulls and repeats included; an existing column of that name is replaced.
    """
    kept = docs.drop(column)
    schema = StructType([*kept.schema.fields, StructField(column, DoubleType())])
    return kept.mapInArrow(tidy(_score(model, column)), schema)
