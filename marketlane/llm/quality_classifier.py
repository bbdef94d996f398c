"""Ordinal quality classifier: a cumulative-link regression over hashed text features.

A text's features are its distinct words and tokens for its shape (case, symbols, repeated lines), hashed into one
weight vector that all grades share; ordered thresholds cut the score into grades. P(grade > k) = sigmoid(score - t_k)
gives the expected grade and the tail probability by which documents are selected. The sum over a text's features is
divided by the root of their number, so that a long text's ordinary words don't outweigh the rest. Words that nearly
only occur in texts of the second highest grade (toxic ones) are marked, and how many of them a text has counts in full.

Documents are kept from a cut on that is found on labelled rows left out of a first fit: the highest that loses
at most ``CLEAN_LOSS`` of those of the highest grade, and 0.5 at least.

The fit takes a bounded sample: at most ``max_train`` labelled documents, those whose ids hash lowest, as rows of
hashed features. Scoring is one pass over all documents, without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlane.llm.common import add_columns, bounded, byte_texts, sliced
from marketlane.llm.decontaminate import words_of

BITS = 18
#: Ratings in order: poor, good but toxic, good and clean. The number is fixed, whatever grades the labels have.
GRADES = 3
#: Labelled documents that the fit takes at most; each is read to its end.
MAX_TRAIN = 12_000
#: Features in fewer training texts than this have no weight.
MIN_TEXTS = 4
#: The score is the sum of a text's weights times this, by the root of the number of its features.
SCALE = 8.0
#: A word is marked if its odds of being in a text of the second highest grade are surely (by 3 standard errors) this many times those in the highest.
MARK_RATIO = 8
#: Numbers of marked words from which on a weight of its own is added.
MARK_STEPS = np.array([1, 2, 4])
#: Share of the held-out texts of the highest grade that the cut may lose; with fewer texts than this it is 0.5.
CLEAN_LOSS, CLEAN_LEAST = 0.01, 100
SYMBOLS = b"!|*$%&#<>{}[]@=_~^\\"
_UPPER, _LETTERS = re.compile(rb"[^A-Z]+"), re.compile(rb"[^A-Za-z]+")


def _bin(part: int, whole: int) -> bytes:
    """Bins of a share: 0, then doubling from 1/512 up."""
    return b"none" if not part else b"%d" % max(0, 9 + int(np.floor(np.log2(part / max(1, whole)))))


def shape_tokens(text: bytes) -> list[bytes]:
    letters = len(_LETTERS.sub(b"", text))
    out = [b"\0upper " + _bin(len(_UPPER.sub(b"", text)), letters)]
    out += [b"\0symbol " + bytes([c]) + b" " + _bin(text.count(c), len(text)) for c in SYMBOLS]
    lines = [x for x in text.split(b"\n") if x.strip()]
    out.append(b"\0lines again " + _bin(len(lines) - len(set(lines)), len(lines)))
    n = text.count(b" ") + text.count(b"\n") + 1
    out.append(b"\0words 2^%d" % int(np.log2(n)))
    out.append(b"\0word length %d" % min(20, len(text) // n))
    return out


class Hasher:
    """Feature numbers of tokens, remembered in a dictionary of bounded size."""

    def __init__(self, bits: int) -> None:
        import xxhash

        self.hash, self.mask, self.known = xxhash.xxh3_64_intdigest, (1 << bits) - 1, {}

    def __call__(self, text: bytes) -> np.ndarray:
        tokens = {*words_of(text), *shape_tokens(text)} if text else set()
        known = self.known
        fresh = tokens.difference(known)
        if fresh:
            if len(known) > 150_000:
                known.clear()
                fresh = tokens
            for t in fresh:
                known[t] = self.hash(t) & self.mask
        return np.unique(np.fromiter(map(known.__getitem__, tokens), np.int32, len(tokens)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray
    bits: int = BITS
    #: Of each feature, whether it is a marked word; the weights of MARK_STEPS.
    marked: np.ndarray | None = None
    steps: np.ndarray | None = None
    #: Texts of at least this P(highest grade) are kept.
    cut: float = 0.5

    def score(self, features: np.ndarray) -> float:
        score = float(self.weights[features].sum()) * SCALE / np.sqrt(max(1, len(features)))
        return score if self.marked is None else score + float(self.steps[self.marked[features].sum() >= MARK_STEPS].sum())

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score (row) and threshold k (column)."""
        return _sigmoid(np.asarray(scores)[:, None] - self.thresholds)

    @classmethod
    def fit(cls, features: list[np.ndarray], grades: np.ndarray, bits: int = BITS, steps: int = 300, rate: float = 0.1, shrink: float = 5e-4) -> OrdinalModel:
        """Adam with soft-thresholding on the mean log-likelihood; deterministic.

        A grade that no row has stays as unlikely as its thresholds start, about 1 in 1,000. Without any row nothing
        speaks against a text: the weights are 0 and the highest grade is the likeliest.
        """
        if not len(features):
            return cls(np.zeros(1 << bits), np.full(GRADES - 1, -1.0), bits)
        flat, size = np.concatenate(features), np.array([len(x) for x in features])
        row = np.repeat(np.arange(len(features)), size)
        marked = _marked(flat, grades[row], grades, bits)
        high = (np.bincount(row, weights=marked[flat], minlength=len(features))[:, None] >= MARK_STEPS).astype(float)
        by = SCALE / np.sqrt(np.maximum(1, size))
        seen = np.bincount(flat, minlength=1 << bits) >= MIN_TEXTS
        used = seen[flat]
        columns, flat = np.unique(flat[used], return_inverse=True)
        row, n = row[used], len(features)
        below = np.array([(grades <= k).mean() for k in range(GRADES - 1)]).clip(1e-3, 1 - 1e-3)
        t = np.log(below / (1 - below))
        # A threshold between a grade and the next has no evidence if one side of it is empty.
        empty = np.array([not ((grades <= k).any() and (grades > k).any()) for k in range(GRADES - 1)])
        w = np.zeros(len(columns))
        u = np.zeros(len(MARK_STEPS))
        m, v, mt, vt, mu, vu = (np.zeros_like(x) for x in (w, w, t, t, u, u))
        for step in range(1, steps + 1):
            _, gw, gt, gu = gradient(flat, row, by, high, grades, w, t, u)
            gt[empty] = 0
            m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw**2
            mt, vt = 0.9 * mt + 0.1 * gt, 0.999 * vt + 0.001 * gt**2
            mu, vu = 0.9 * mu + 0.1 * gu, 0.999 * vu + 0.001 * gu**2
            c1, c2 = 1 - 0.9**step, 1 - 0.999**step
            scale = rate / (np.sqrt(v / c2) + 1e-4)
            w = w - scale * m / c1
            w = np.sign(w) * np.maximum(np.abs(w) - scale * shrink, 0)
            scale = rate / (np.sqrt(vu / c2) + 1e-4)
            u = u - scale * mu / c1
            u = np.sign(u) * np.maximum(np.abs(u) - scale * shrink, 0)
            t = np.maximum.accumulate(t - rate * (mt / c1) / (np.sqrt(vt / c2) + 1e-4))
        weights = np.zeros(1 << bits)
        weights[columns] = w
        return cls(weights, t, bits, marked, u)

    @classmethod
    def fit_with_cut(cls, features: list[np.ndarray], grades: np.ndarray, bits: int = BITS) -> OrdinalModel:
        """A model of all rows, with the cut found on every fourth row by a model of the others."""
        model = cls.fit(features, grades, bits)
        top = GRADES - 1
        held = np.arange(len(features)) % 4 == 0
        clean = [features[i] for i in np.flatnonzero(held & (grades == top))]
        if len(clean) >= CLEAN_LEAST and (~held & (grades == top)).any():
            part = cls.fit([features[i] for i in np.flatnonzero(~held)], grades[~held], bits)
            found = np.quantile(part.tails(np.array([part.score(x) for x in clean]))[:, -1], CLEAN_LOSS, method="lower")
            model.cut = max(0.5, float(found))
        return model


def gradient(flat: np.ndarray, row: np.ndarray, by: np.ndarray, high: np.ndarray, grades: np.ndarray, w: np.ndarray, t: np.ndarray, u: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """The mean negative log-likelihood, and its gradient by weights, thresholds and step weights.

    ``flat``: features of all texts, ``row``: the text of each; ``by``: what a text's sum is multiplied by; ``high``: its steps.
    """
    n = len(grades)
    s = np.bincount(row, weights=w[flat], minlength=n) * by + high @ u
    padded = np.concatenate(([-np.inf], t, [np.inf]))
    a, b = _sigmoid(padded[grades + 1] - s), _sigmoid(padded[grades] - s)
    gap = np.maximum(a - b, 1e-9)
    gw = np.bincount(flat, weights=((1 - a - b) * by)[row], minlength=len(w)) / n
    gu = (1 - a - b) @ high / n
    up, down = -a * (1 - a) / gap, b * (1 - b) / gap
    gt = np.array([up[grades == k].sum() + down[grades == k + 1].sum() for k in range(len(t))]) / n
    return float(-np.log(gap).mean()), gw, gt, gu


def _marked(flat: np.ndarray, grade: np.ndarray, grades: np.ndarray, bits: int) -> np.ndarray:
    """Of each feature, whether it is a word that tells the second highest grade from the highest. ``grade``: that of each in ``flat``."""
    low, top = (np.bincount(flat[grade == k], minlength=1 << bits) for k in (GRADES - 2, GRADES - 1))
    n_low, n_top = ((grades == k).sum() for k in (GRADES - 2, GRADES - 1))
    odds = np.log((low + 0.5) / (n_low + 1)) - np.log((top + 0.5) / (n_top + 1))
    return (odds - 3 * np.sqrt(1 / (low + 0.5) + 1 / (top + 0.5)) > np.log(MARK_RATIO)) & (low >= MIN_TEXTS)


def grade_of(quality: F.Column, toxic: F.Column) -> F.Column:
    """Ratings in order: 0 poor text, 1 good text with toxic words, 2 good and clean. Null toxic counts as clean."""
    return F.when(quality == 0, 0).when(F.coalesce(toxic, F.lit(0)) == 1, 1).when(quality.isNotNull(), 2)


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", bits: int = BITS, max_train: int = MAX_TRAIN) -> OrdinalModel:
    """The model of the ``max_train`` labelled documents whose ids hash lowest. Rows with a null quality, id or text are left out.

    Ids may be of any type. Of labels that repeat an id the lowest grade counts in the order of the sample; a repeated
    document is a row of its own within the bound. For labels with no rows, or of one grade only, see ``OrdinalModel.fit``.
    """
    bounded(docs.sparkSession)
    rated = labels.select(F.col(id_col), grade_of(F.col("quality"), F.col("toxic")).alias("grade")).filter(f"grade IS NOT NULL AND {id_col} IS NOT NULL")
    sample = rated.orderBy(F.xxhash64(id_col), "grade").limit(max_train)
    texts = docs.select(id_col, text_col).filter(F.col(text_col).isNotNull()).join(sample, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(bits)
        for b in sliced(batches, 1):
            features = [hasher(t).tobytes() for t in byte_texts(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(features, pa.binary()), b.column(2)], names=["place", "features", "grade"])

    hashed = texts.select(F.xxhash64(id_col).alias("place"), text_col, "grade").mapInArrow(run, "place long, features binary, grade int")
    # A repeated id may match more than once: the bound holds for rows, too.
    rows = hashed.orderBy("place", "features", "grade").limit(max_train).toArrow()
    return OrdinalModel.fit_with_cut([np.frombuffer(x, np.int32) for x in rows["features"].to_pylist()], rows["grade"].to_numpy().astype(np.int64), bits)


COLUMNS = T.StructType([T.StructField("quality_score", T.DoubleType()), T.StructField("expected_grade", T.DoubleType()), T.StructField("p_top", T.DoubleType()), T.StructField("kept", T.BooleanType())])


def classify(docs: DataFrame, model: OrdinalModel, text_col: str = "text", least: float | None = None) -> DataFrame:
    """``docs`` with quality_score, expected_grade, p_top (of the highest grade) and kept (p_top >= least, the model's cut if None).

    Columns of the same names are replaced. Null and empty texts have no features; they are not kept.
    """
    least = model.cut if least is None else least
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        m: OrdinalModel = shared.value
        hasher = Hasher(m.bits)
        for b in batches:
            texts = byte_texts(b[text_col])
            scores = np.array([m.score(hasher(t)) for t in texts])
            tails = m.tails(scores) if len(texts) else np.zeros((0, 1))
            top = tails[:, -1]
            yield {"quality_score": pa.array(scores, pa.float64()), "expected_grade": pa.array(tails.sum(axis=1)), "p_top": pa.array(top), "kept": pa.array((top >= least) & np.array([bool(t.strip()) for t in texts], bool))}

    return add_columns(docs, [text_col], COLUMNS, work)
