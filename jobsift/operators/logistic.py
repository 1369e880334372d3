"""Logistic regression with a squared penalty, over counted terms that lie in a written table.

The loss is convex, so any way down ends at the same coefficients.  A pass over the
documents is what costs; L-BFGS in well chosen units needs few of them, and a document
is read as its counts, three bytes a term.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift.functions.arrays import slices
from jobsift.operators.tfidf import SLICE_TERMS, Weights, word_lists
from jobsift.session import stored

# Steps that L-BFGS remembers at most and at least, and the bytes they should take
STEPS = (10, 30)
STEP_BYTES = 64 << 20
# Iterations over which the change of the loss is taken
WINDOW = 10
# Losses that one iteration tries
TRIES = 20
# Partial sums that one task, or the driver, adds
PARTIALS = 32
# Below this variance a term counts as the same in all documents
LEAST_VARIANCE = 1e-14


@dataclass
class Counted:
    """Documents as counts of the vocabulary's terms, some of them in each row of ``blocks``."""

    blocks: DataFrame
    idf: np.ndarray
    n_labels: int
    n: int
    tasks: int

    @classmethod
    def of(cls, docs: DataFrame, text_col: str, label_col: str, words: Weights, labels: list[str]) -> Counted:
        """One scan of the texts; the counts are written, as every pass reads them."""
        context = docs.sparkSession.sparkContext
        shipped = context.broadcast((words, labels))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, labels = shipped.value
            names, width = pa.array(labels, pa.string()), _term_type(len(words.ids))
            for batch in batches:
                # words are half of the terms
                for low, high in slices(pc.list_value_length(batch.column(0)).to_numpy(), SLICE_TERMS // 2):
                    part = batch.slice(low, high - low)
                    document, term, tf, length = words.count(part.column(0))
                    truth = pc.index_in(part.column(1), value_set=names)
                    if truth.null_count:
                        raise ValueError("a row without a label cannot be learned from")
                    columns = (
                        truth.to_numpy().astype("int32"),
                        np.bincount(document, minlength=len(part)).astype("int32"),
                        length,
                        term.astype(width),
                        tf.astype("uint8" if tf.max(initial=0) < 256 else "int32"),
                    )
                    packed = [pa.array([c.tobytes()], pa.binary()) for c in columns]
                    yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int64()), *packed], _BLOCK_NAMES)

        rows = docs.select(word_lists(text_col).alias("words"), F.col(label_col).cast("string").alias("label"))
        blocks = stored(rows.mapInArrow(run, _BLOCK), "train-terms")
        n = blocks.agg(F.sum("n")).first()[0]
        tasks = min(blocks.rdd.getNumPartitions(), 2 * context.defaultParallelism)
        return cls(blocks.select(*_BLOCK_NAMES[1:]), words.idf, len(labels), n, max(tasks, 1))

    def summed(self, value: object, work: Callable) -> np.ndarray:
        """The sum of ``work(documents, value)``, an array, over all documents.

        A task sends one array; many of them are added in groups.
        """
        shipped = self.blocks.sparkSession.sparkContext.broadcast(value)
        width = _term_type(len(self.idf))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                for block in zip(*batch.columns):
                    found = work(Documents.of(block, width), shipped.value)
                    total = found if total is None else np.add(total, found, out=total)
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = _added(part.as_py() for batch in batches for part in batch.column(0))
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

        parts = self.blocks.coalesce(self.tasks).mapInArrow(run, "part binary")
        if self.tasks > PARTIALS:
            groups = -(-self.tasks // PARTIALS)
            grouped = parts.withColumn("_group", F.spark_partition_id() % groups).repartition(groups, "_group")
            parts = grouped.select("part").mapInArrow(added, "part binary")
        try:
            return _added(row[0] for row in parts.collect())
        finally:
            shipped.destroy()

    def loss(self, coefficients: np.ndarray, intercepts: np.ndarray, penalty: float) -> tuple[float, np.ndarray, np.ndarray]:
        """The mean loss plus half the penalty times the squared coefficients, and its gradient."""
        sums = self.summed((coefficients * self.idf, intercepts), _loss)
        slopes = sums[1 : 1 + coefficients.size].reshape(coefficients.shape) * self.idf / self.n
        value = sums[0] / self.n + penalty / 2 * (coefficients**2).sum()
        return value, slopes + penalty * coefficients, sums[1 + coefficients.size :] / self.n

    def mean_and_variance(self) -> tuple[np.ndarray, np.ndarray]:
        """Of the weight of each term."""
        first, second = self.summed(len(self.idf), _moments).reshape(2, -1)
        mean = first * self.idf / self.n
        return mean, np.maximum(second * self.idf**2 / self.n - mean * mean, 0)

    def shares(self) -> np.ndarray:
        """The share of each label."""
        return self.summed(self.n_labels, _sizes) / self.n


_BLOCK_NAMES = ["n", "truth", "terms", "length", "term", "tf"]
_BLOCK = "n long, truth binary, terms binary, length binary, term binary, tf binary"


def _term_type(size: int) -> str:
    return "uint16" if size <= 1 << 16 else "int32"


@dataclass
class Documents:
    """Some documents: their labels, how many terms they have, their scales; the terms, one document after another.

    A count times the scale of its document and the IDF of its term is the weight.
    """

    truth: np.ndarray
    terms: np.ndarray
    scale: np.ndarray
    term: np.ndarray
    tf: np.ndarray

    @classmethod
    def of(cls, block: tuple[pa.BinaryScalar, ...], width: str) -> Documents:
        truth, terms, length, term, tf = (memoryview(b.as_buffer()) for b in block)
        truth, terms, length = np.frombuffer(truth, "int32"), np.frombuffer(terms, "int32"), np.frombuffer(length, "float64")
        term = np.frombuffer(term, width).astype("int64")
        tf = np.frombuffer(tf, "uint8" if len(tf) == len(term) else "int32").astype("float64")
        return cls(truth, terms, np.divide(1.0, length, out=np.zeros(len(length)), where=length > 0), term, tf)

    def dot(self, rows: np.ndarray) -> np.ndarray:
        """The sum of count times number for each row of numbers and each document."""
        found, some = np.zeros((len(rows), len(self.terms))), self.terms > 0
        if len(self.term):
            starts, numbers = (np.cumsum(self.terms) - self.terms)[some], np.empty(len(self.term))
            for i, row in enumerate(rows):
                # all terms are within the row; without the test it is faster
                np.multiply(np.take(row, self.term, out=numbers, mode="clip"), self.tf, out=numbers)
                found[i, some] = np.add.reduceat(numbers, starts)
        return found

    def by_term(self, shares: np.ndarray, size: int) -> np.ndarray:
        """The sum of count times number for each row of numbers, one for each document, and each term."""
        found = np.empty((len(shares), size))
        for i, share in enumerate(shares):
            numbers = np.repeat(share, self.terms)
            found[i] = np.bincount(self.term, np.multiply(numbers, self.tf, out=numbers), minlength=size)
        return found


def _added(parts: Iterator[bytes]) -> np.ndarray | None:
    total = None
    for part in parts:
        numbers = np.frombuffer(part, "float64")
        total = numbers.copy() if total is None else np.add(total, numbers, out=total)
    return total


def _loss(documents: Documents, value: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Loss, slopes of the coefficients (not yet times the IDF) and of the intercepts."""
    coefficients, intercepts = value
    margins = documents.dot(coefficients) * documents.scale + intercepts[:, None]
    if len(intercepts) == 1:
        # two labels have one row of coefficients; the other label's margin is 0
        margins = np.vstack([np.zeros_like(margins), margins])
    margins -= margins.max(0)
    own = documents.truth, np.arange(len(documents.truth))
    share = np.exp(margins)
    total = share.sum(0)
    loss = (np.log(total) - margins[own]).sum()
    share /= total
    share[own] -= 1
    share = share[-len(intercepts) :]
    slopes = documents.by_term(share * documents.scale, coefficients.shape[1])
    return np.concatenate([[loss], slopes.ravel(), share.sum(1)])


def _moments(documents: Documents, size: int) -> np.ndarray:
    weight = documents.tf * np.repeat(documents.scale, documents.terms)
    return np.concatenate([np.bincount(documents.term, w, minlength=size) for w in (weight, weight * weight)])


def _sizes(documents: Documents, n_labels: int) -> np.ndarray:
    return np.bincount(documents.truth, minlength=n_labels).astype("float64")


@dataclass
class Descent:
    """L-BFGS from coefficients of 0, and on from where it stopped.

    It moves in other units than the coefficients': those of a term are divided by the
    square root of its deviation, and its weights are taken from their mean, which only
    shifts the intercepts.  Rare and frequent terms are then about as far from their best
    coefficients, and a third of the passes lead there.
    """

    counted: Counted
    penalty: float
    iterations: int = 0
    losses: list[float] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.mean, variance = self.counted.mean_and_variance()
        self.unit = np.where(variance > LEAST_VARIANCE, variance, 1.0) ** -0.25
        start = np.log(self.counted.shares())
        start = start[1:] - start[:1] if len(start) == 2 else start - start.mean()
        self.x = np.hstack([np.zeros((len(start), len(self.mean))), start[:, None]])
        self.f, self.g = self._evaluate(self.x)
        self.losses.append(self.f)
        self.past: list[tuple[np.ndarray, np.ndarray, float]] = []
        self.steps = max(STEPS[0], min(STEPS[1], STEP_BYTES // (16 * self.x.size)))

    def model(self) -> tuple[np.ndarray, np.ndarray]:
        """Coefficients (label x term) and intercepts; those of more than two labels add up to 0."""
        coefficients, intercepts = self._in_own_units(self.x)
        return coefficients, intercepts - intercepts.mean() if len(intercepts) > 1 else intercepts

    def run(self, max_iter: int, tolerance: float) -> None:
        """Until the loss changes by less than ``tolerance`` of it, or ``max_iter`` iterations were made in all."""
        while self.iterations < max_iter and self._step():
            self.losses.append(self.f)
            self.iterations += 1
            if max(self.losses[-WINDOW - 1 :]) - self.f <= tolerance * abs(self.f):
                break
            if np.linalg.norm(self.g) <= max(tolerance * abs(self.f), 1e-8):
                break

    def _in_own_units(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        coefficients = x[:, :-1] * self.unit
        return coefficients, x[:, -1] - coefficients @ self.mean

    def _evaluate(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        value, slopes, free = self.counted.loss(*self._in_own_units(x), self.penalty)
        return value, np.hstack([(slopes - np.outer(free, self.mean)) * self.unit, free[:, None]])

    def _direction(self) -> np.ndarray:
        q, shares = self.g.copy(), []
        for s, y, r in reversed(self.past):
            shares.append(r * np.vdot(s, q))
            q -= shares[-1] * y
        if self.past:
            s, y, r = self.past[-1]
            q /= r * np.vdot(y, y)
        for (s, y, r), share in zip(self.past, reversed(shares)):
            q += s * (share - r * np.vdot(y, q))
        return -q

    def _step(self) -> bool:
        """One iteration; false if no step leads further down."""
        while True:
            direction = self._direction()
            slope = np.vdot(self.g, direction)
            if slope < 0 and self._search(direction, slope):
                return True
            if not self.past:
                return False
            # once more, straight down
            self.past.clear()

    def _search(self, direction: np.ndarray, slope: float) -> bool:
        """A step after which the loss is lower and its slope flatter (Wolfe's conditions)."""
        step = 1.0 if self.past else 1 / np.linalg.norm(direction)
        low, high, best = 0.0, np.inf, None
        # what rounding of the sums leaves open
        slack = 1e-13 * abs(self.f)
        for _ in range(TRIES):
            x = self.x + step * direction
            f, g = self._evaluate(x)
            new_slope = np.vdot(g, direction)
            if not f <= self.f + 1e-4 * step * slope + slack:
                high = step
            else:
                if best is None or f < best[1]:
                    best = (x, f, g)
                if new_slope < 0.9 * slope:
                    low = step
                elif new_slope > -0.9 * slope:
                    high = step
                else:
                    best = (x, f, g)
                    break
            step = 2 * low if high == np.inf else (low + high) / 2
        if best is None:
            return False
        x, f, g = best
        s, y = x - self.x, g - self.g
        if np.vdot(s, y) > 0:
            self.past = [*self.past, (s, y, 1 / np.vdot(s, y))][-self.steps :]
        self.x, self.f, self.g = x, f, g
        return True
