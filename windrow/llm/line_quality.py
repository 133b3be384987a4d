"""Quality classifier (operator 1): a linear-chain conditional random field over lines.

Every line is good or bad. Its potential adds up weights for binned statistics of the line
itself, of the line before and of the line after; a 2 by 2 table weighs neighbouring labels.
Forward-backward passes give each line's probability of being good, and the mean of these,
weighted by line length, is the document's quality. All documents of a batch go through the
passes together, one line of each at a time.

The field is trained on whole label sequences, every line bearing its document's label, from a
bounded sample: ``SAMPLE`` labelled documents taken by a hash of their id.

- null or empty text: one empty line; a text of line ends only: empty lines, all of one weight;
- null label: not learned from; labels of one kind only: every score is that label;
- nothing to learn from: every score is 1, so that nothing is rejected untaught;
- several rows with one id: one result each; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.common import BLANKS, fold_of, in_batches, load
from windrow.llm.registry import query

#: Labelled documents trained on, bins per statistic, training steps.
SAMPLE, BINS, STEPS = 5_000, 8, 250

#: The statistics of a line, in this order.
STATISTICS = 12

_SYMBOLS, _ENDS, _DIGITS = b"#*$%&|<>~^=_{}[]\\@+", b"!?", b"0123456789"
_UPPER = bytes(range(65, 91))


def line_statistics(line: str, earlier: set[str]) -> tuple[float, ...]:
    """Shape, make-up and repetition of one line; ``earlier`` holds the lines before it."""
    raw = line.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), len(raw) + 1
    kinds = len(set(words))
    bare = line.strip(BLANKS)
    again = bare in earlier
    earlier.add(bare)
    symbols = size - 1 - len(raw.translate(None, _SYMBOLS))
    runs = sum(map(bytes.__eq__, words, words[1:]))
    return (
        math.log1p(n),
        (size - n) / (n + 1),
        symbols / (n + 1),
        (size - 1 - len(raw.translate(None, _ENDS))) / (n + 1),
        (size - 1 - len(raw.translate(None, _UPPER))) / size,
        (size - 1 - len(raw.translate(None, _DIGITS))) / size,
        (n - kinds) / (n + 1),
        runs / (n + 1),
        float(again and n > 0),
        float(bare[-1:] in ".!?:\"'" and n > 0),
        max(map(len, words), default=0) / 10,
        symbols / size,
    )


def text_lines(text: str | None) -> tuple[list[tuple[float, ...]], list[int]]:
    """Statistics and weights, one more than the length, of a text's lines."""
    earlier: set[str] = set()
    lines = (text or "").split("\n")
    return [line_statistics(line, earlier) for line in lines], [len(line) + 1 for line in lines]


def binned(statistics: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Bin numbers of lines, offset so that each statistic has its own range."""
    bins = [np.searchsorted(edge, statistics[:, i], "right") + i * BINS for i, edge in enumerate(edges)]
    return np.stack(bins, axis=1)


class Chains:
    """Label sequences of several documents, passed through one line at a time together."""

    def __init__(self, sizes: np.ndarray):
        self.sizes = sizes
        self.first = np.cumsum(sizes) - sizes
        self.order = np.argsort(-sizes, kind="stable")
        ranked = sizes[self.order]
        # How many documents have a line number t.
        self.active = np.searchsorted(-ranked, -np.arange(1, (ranked[0] if len(ranked) else 0) + 1), "right")
        self.starts, self.ranked = self.first[self.order], ranked
        self.lines = int(sizes.sum())

    def passes(self, potential: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward probabilities of good per line, and the potentials used."""
        weight = np.exp(np.clip(potential, -30, 30))
        ahead, back = np.empty(self.lines), np.empty(self.lines)
        state = np.full(len(self.order), 0.5)
        for t, n in enumerate(self.active.tolist()):
            at = self.starts[:n] + t
            good = state[:n]
            if t:
                good, bad = good * table[1, 1] + (1 - good) * table[0, 1], good * table[1, 0] + (1 - good) * table[0, 0]
            else:
                bad = 1 - good
            good = good * weight[at]
            state[:n] = good / (good + bad)
            ahead[at] = state[:n]
        # The backward message to line t, as the probability of good it stands for.
        for t in range(len(self.active) - 1, -1, -1):
            n = int(self.active[t])
            at = self.starts[:n] + t
            here = np.full(n, 0.5)
            m = int(self.active[t + 1]) if t + 1 < len(self.active) else 0
            if m:
                after = at[:m] + 1
                good, bad = back[after] * weight[after], 1 - back[after]
                toward_good, toward_bad = table[1, 1] * good + table[1, 0] * bad, table[0, 1] * good + table[0, 0] * bad
                here[:m] = toward_good / (toward_good + toward_bad)
            back[at] = here
        return ahead, back, weight

    def marginals(self, potential: np.ndarray, table: np.ndarray) -> np.ndarray:
        """Probability of good for every line."""
        ahead, back, _ = self.passes(potential, table)
        good, bad = ahead * back, (1 - ahead) * (1 - back)
        return good / (good + bad)


def _neighbours(bins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bins of the line before and after; a last bin row stands for no line."""
    none = np.full((1, bins.shape[1]), STATISTICS * BINS)
    ends = np.cumsum(sizes)
    before, after = np.concatenate([none, bins[:-1]]), np.concatenate([bins[1:], none])
    before[ends - sizes] = none
    after[ends - 1] = none
    return before, after


def _potentials(bins: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    before, after = _neighbours(bins, sizes)
    return weights[0][bins].sum(1) + weights[1][before].sum(1) + weights[2][after].sum(1) + weights[3][0]


class Field:
    """Bin edges, weights (own, before, after, bias) and the table of neighbouring labels."""

    def __init__(self, statistics: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
        # Equal quantiles, as of a count that is mostly 0, leave bins empty; the top ones matter.
        self.edges = []
        for column in statistics.T:
            edge = np.unique(np.concatenate([np.quantile(column, quantiles), np.quantile(column, [0.95, 0.99])]))
            self.edges.append(np.nextafter(edge[-(BINS - 1) :], np.inf))
        bins = binned(statistics, self.edges)
        chains = Chains(sizes)
        before, after = _neighbours(bins, sizes)
        size = STATISTICS * BINS + 1
        parts = [bins, before, after]
        good = np.repeat(labels, sizes).astype(float)
        follows = np.ones(len(bins), bool)
        follows[chains.first] = False
        later = np.flatnonzero(follows)
        seen = np.zeros((2, 2))
        np.add.at(seen, (good[later - 1].astype(int), good[later].astype(int)), 1)
        weights, logs = np.zeros((4, size)), np.zeros((2, 2))
        means, squares = np.zeros(weights.size + 4), np.zeros(weights.size + 4)
        documents = len(sizes)
        for step in range(1, STEPS + 1):
            self.weights, self.table = weights, np.exp(logs)
            ahead, back, weight = chains.passes(_potentials(bins, sizes, weights), self.table)
            marginal = ahead * back / (ahead * back + (1 - ahead) * (1 - back))
            error = good - marginal
            slope = np.zeros((4, size))
            for row, part in enumerate(parts):
                slope[row] = np.bincount(part.ravel(), np.repeat(error, part.shape[1]), size)
            slope[3][0] = error.sum()
            a, b, w = ahead[later - 1], back[later], weight[later]
            pair = np.stack(
                [
                    (1 - a) * self.table[0, 0] * (1 - b),
                    (1 - a) * self.table[0, 1] * w * b,
                    a * self.table[1, 0] * (1 - b),
                    a * self.table[1, 1] * w * b,
                ]
            )
            expected = (pair / pair.sum(0)).sum(1).reshape(2, 2)
            slope = np.concatenate([slope.ravel(), (seen - expected).ravel()]) / documents
            whole = np.concatenate([weights.ravel(), logs.ravel()])
            slope -= 0.002 * whole
            # Adam steps, smaller towards the end.
            means = 0.9 * means + 0.1 * slope
            squares = 0.99 * squares + 0.01 * slope**2
            rate = 0.08 * (1 - step / (STEPS + 1))
            whole = whole + rate * (means / (1 - 0.9**step)) / (np.sqrt(squares / (1 - 0.99**step)) + 1e-8)
            weights, logs = whole[:-4].reshape(4, size), np.clip(whole[-4:].reshape(2, 2), -3, 3)
        self.weights, self.table = weights, np.exp(logs)

    def line_marginals(self, statistics: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        bins = binned(statistics, self.edges)
        return Chains(sizes).marginals(_potentials(bins, sizes, self.weights), self.table)


def _flat(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Statistics and weights of all lines of several texts, and the lines of each text."""
    parts = [text_lines(t) for t in texts]
    sizes = np.array([len(w) for _, w in parts], np.int64)
    statistics = np.array([s for some, _ in parts for s in some]).reshape(-1, STATISTICS)
    return statistics, np.array([w for _, some in parts for w in some], float), sizes


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality"):
    """A field, or the one score that labels of a single kind leave, from the bounded sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(text_lines(t)[0]).ravel().tolist() for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(rows, pa.list_(pa.float32()))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "lines"])

    known = labels.where(F.col(label).isNotNull())
    given = known.select(F.col(doc_id).alias("id"), (F.col(label) > 0).cast("int").alias("label"))
    sample = given.orderBy(F.xxhash64("id"), "id", "label").limit(SAMPLE)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    chosen = texts.join(F.broadcast(sample), "id").select("label", "text")
    found = in_batches(chosen, run, "label int, lines array<float>").toPandas()
    if not len(found):
        return 1.0
    target = found["label"].to_numpy()
    if len(set(target.tolist())) == 1:
        return float(target[0])
    sizes = np.array([len(x) // STATISTICS for x in found["lines"]], np.int64)
    statistics = np.concatenate(found["lines"].to_list()).reshape(-1, STATISTICS).astype(np.float64)
    # Rows come in any order; the sum over documents must not depend on it.
    order = np.lexsort((sizes, [float(np.sum(x)) for x in found["lines"]]))
    cut = np.split(statistics, np.cumsum(sizes)[:-1])
    return Field(np.concatenate([cut[i] for i in order]), sizes[order], target[order])


def score_texts(docs: DataFrame, field: Field | float, keep: list[str], text: str = "text") -> DataFrame:
    """The columns to keep, with ``score`` and ``line_scores``, the probability of good per line."""
    model = (field.edges, field.weights, field.table) if isinstance(field, Field) else field
    names = [*keep, "score", "line_scores"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            statistics, weight, sizes = _flat(batch.column(len(keep)).to_pylist())
            if isinstance(model, float):
                good = np.full(len(weight), model)
            else:
                edges, weights, table = model
                bins = binned(statistics.astype(np.float32).astype(np.float64), edges)
                good = Chains(sizes).marginals(_potentials(bins, sizes, weights), table)
            starts = np.cumsum(sizes) - sizes
            score = np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts) if len(sizes) else good
            lines = pa.ListArray.from_arrays(np.append(starts, len(good)).astype(np.int32), pa.array(good))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(np.clip(score, 0, 1)), lines], names)

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "score double, line_scores array<double>"])
    return in_batches(docs.select(*keep, text), run, schema)


@query("op1_crf_quality")
def op1_crf_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learned from four fifths of those labelled."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    held = fold_of(F.col("doc_id"), 5) == 0
    field = train(docs.where(~held), labels.where(~held))
    scored = score_texts(docs.select("doc_id", held.alias("held_out"), "text"), field, ["doc_id", "held_out"])
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", "held_out", "score", predicted)
