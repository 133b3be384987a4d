"""Quality rules (operator 3): robust multivariate outliers per language and source.

Each document gives exact counts and from them four transformed rates. Per language and source
the minimum covariance determinant (MCD) of these vectors gives a centre and a scatter that
the worst quarter of the documents can't move; documents far from the centre in Mahalanobis
distance are rejected, besides those that fail the base rules.

The vectors are first gathered into small cells that keep exact counts, sums and products, as
in Harrington and Salibian-Barrera (2010), so the concentration steps of a group see at most
its occupied cells however many documents it has, and all documents count. A cell goes into
the half kept as a whole, the last one by part.

- null or empty text: no words, fails the base rules; null language or source: a group of its own;
- documents failing the base rules take no part in the estimates;
- a group of fewer than ``SMALLEST`` documents takes the estimate of its language, then of all documents;
  only where all are fewer, the base rules decide alone;
- several rows with one id: one result each; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.common import BLANKS, in_batches, load, written
from windrow.llm.registry import query

#: Words of a repeated window, share of documents the estimate rests on, smallest group.
WINDOW, SHARE, SMALLEST = 5, 0.75, 20

#: Width of a cell, and the standard deviation below which a rate is not told from its centre.
CELL, FLOOR = 0.1, 0.2

#: Rejected are vectors beyond this quantile of the distance under a normal law.
QUANTILE = 1 - 1e-9

RATES = 4
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"

_BLANK_BYTES = BLANKS.encode()
# Fixed value: the characters counted as symbols.
_SYMBOL_BYTES = b"#*$%&|<>"


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by windows that stand twice or more in the list."""
    n = len(words)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    kinds, m = len(number), n - window + 1
    if kinds == n:
        return 0
    code, span = ids[:m].copy(), kinds
    for k in range(1, window):
        if span * kinds >= 1 << 62:  # number the parts anew, so that codes stay exact
            code = np.unique(code, return_inverse=True)[1].astype(np.int64)
            span = int(code.max()) + 1
        code = code * kinds + ids[k : k + m]
        span *= kinds
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(m, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    edge[at] += 1
    np.add.at(edge, at + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """Words, their code points, symbols, repeated lines, repeated words, lines."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    blanks = len(raw) - len(raw.translate(None, _BLANK_BYTES))
    symbols = len(raw) - len(raw.translate(None, _SYMBOL_BYTES))
    lines = text.split("\n")
    repeated = 0
    if len(set(lines)) < len(lines):
        full = [line for line in lines if line.strip(BLANKS)]
        repeated = len(full) - len(set(full))
    return len(words), len(text) - blanks, symbols, repeated, repeated_words(words), len(lines)


def document_counts(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """The columns to keep and the counts of every text."""
    names = [*keep, *(c.split()[0] for c in COUNTS.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_counts(t) for t in batch.column(len(keep)).to_pylist()]
            counts = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 6
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *counts], names)

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), COUNTS])
    return in_batches(docs.select(*keep, text), run, schema)


def rates() -> list[Column]:
    """Transformed rates, each drawn to a usual value where the text is short."""
    words, lines = F.col("n_words"), F.col("n_lines")
    return [
        F.log((F.col("word_chars") + 60) / (words + 10)),
        F.log1p(20 * F.col("n_symbols") / (words + 10)),
        F.log1p(5 * F.col("n_dup_lines") / (lines + 3)),
        F.log1p(5 * F.col("n_repeat_words") / (words + 10)),
    ]


def _chi2(x: float, df: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 0.0
    for k in range(df // 2):
        total += term
        term *= x / 2 / (k + 1)
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(p: float, df: int = RATES) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2(middle, df) < p else (low, middle)
    return high


def _moments(weight: np.ndarray, share: np.ndarray, sums: np.ndarray, products: np.ndarray):
    """Mean and scatter of the cells, each by its share."""
    n = float((weight * share).sum())
    mean = (sums * share[:, None]).sum(0) / n
    scatter = (products * share[:, None, None]).sum(0) / n - np.outer(mean, mean)
    return mean, scatter + np.eye(len(mean)) * FLOOR**2


def _distances(points: np.ndarray, mean: np.ndarray, scatter: np.ndarray) -> np.ndarray:
    whitened = np.linalg.solve(np.linalg.cholesky(scatter), (points - mean).T)
    return (whitened**2).sum(0)


def _nearest(distance: np.ndarray, weight: np.ndarray, total: float) -> np.ndarray:
    """Shares of the cells that hold the ``total`` nearest documents."""
    order = np.argsort(distance, kind="stable")
    before = np.cumsum(weight[order]) - weight[order]
    share = np.zeros(len(weight))
    share[order] = np.clip((total - before) / weight[order], 0, 1)
    return share


def minimum_determinant(weight: np.ndarray, sums: np.ndarray, products: np.ndarray, starts: int = 24):
    """Reweighted MCD centre and scatter of cells given by count, sums and products."""
    n, points = float(weight.sum()), sums / weight[:, None]
    total = math.ceil(SHARE * n)
    random = np.random.default_rng(0)
    order = np.argsort(points, axis=0, kind="stable")
    halves = np.cumsum(weight[order], axis=0) >= n / 2
    middle = points[order[halves.argmax(axis=0), range(RATES)], range(RATES)]
    best = None
    for start in range(starts):
        if start == 0:
            distance = ((points - middle) ** 2).sum(1)
        else:
            some = random.choice(len(weight), RATES + 1, p=weight / n)
            mean, scatter = _moments(weight[some], np.ones(RATES + 1), sums[some], products[some])
            distance = _distances(points, mean, scatter)
        last = math.inf
        for _ in range(50):
            mean, scatter = _moments(weight, _nearest(distance, weight, total), sums, products)
            size = float(np.linalg.slogdet(scatter)[1])
            if size >= last - 1e-9:
                break
            last, distance = size, _distances(points, mean, scatter)
        if best is None or last < best[0] - 1e-9:
            best = (last, mean, scatter)
    _, mean, scatter = best
    share = total / n
    scatter = scatter * (share / _chi2(chi2_quantile(share), RATES + 2) if share < 1 else 1.0)
    near = (_distances(points, mean, scatter) <= chi2_quantile(0.975)).astype(float)
    return _moments(weight, near, sums, products) if near.sum() else (mean, scatter)


_PAIRS = [(i, j) for i in range(RATES) for j in range(i, RATES)]
_SUMS = [f"s{i}" for i in range(RATES)] + [f"p{i}{j}" for i, j in _PAIRS]


def occupied_cells(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of the rates per group: ``weight``, the rates' sums and the sums of their products."""
    vector = [rate.alias(f"x{i}") for i, rate in enumerate(rates())]
    rows = counted.where(~F.col("base_failed")).select(*keys, *vector)
    cell = [F.floor(F.col(f"x{i}") / CELL).alias(f"cell{i}") for i in range(RATES)]
    return rows.groupBy(*keys, *cell).agg(
        F.count("*").alias("weight"),
        *(F.sum(f"x{i}").alias(f"s{i}") for i in range(RATES)),
        *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"p{i}{j}") for i, j in _PAIRS),
    )


def estimates_of(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Centre and whitening rows per group of cells, where a group has ``SMALLEST`` documents."""
    kinds = dict(cells.dtypes)

    def estimate(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([f"cell{i}" for i in range(RATES)])
        weight = frame["weight"].to_numpy(float)
        if weight.sum() < SMALLEST:
            return pd.DataFrame(columns=[*keys, "centre", "whiten"])
        products = np.zeros((len(frame), RATES, RATES))
        for i, j in _PAIRS:
            products[:, i, j] = products[:, j, i] = frame[f"p{i}{j}"]
        mean, scatter = minimum_determinant(weight, frame[[f"s{i}" for i in range(RATES)]].to_numpy(), products)
        whiten = np.linalg.inv(np.linalg.cholesky(scatter))
        head = frame[keys].iloc[:1].reset_index(drop=True)
        return head.assign(centre=[mean.tolist()], whiten=[whiten.ravel().tolist()])

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "centre array<double>, whiten array<double>"])
    return cells.groupBy(*keys).applyInPandas(estimate, schema)


def group_estimates(counted: DataFrame, keys: list[str]) -> DataFrame:
    """Centre and whitening rows per group: ``centre`` and ``whiten``, arrays of double."""
    return estimates_of(occupied_cells(counted, keys), keys)


def pooled_estimates(counted: DataFrame, keys: list[str]) -> DataFrame:
    """``group_estimates`` of every group: one that is too small takes that of the keys before its last,
    and so on to that of all documents. Cells add up, so the documents are read once.
    """
    cells = written(occupied_cells(counted, keys), "cells")
    grid = [f"cell{i}" for i in range(RATES)]
    none = F.lit(None).cast("array<double>")
    found = cells.select(*keys).distinct().withColumns({"centre": none, "whiten": none})

    def pooled(some: list[str]) -> DataFrame:
        return cells.groupBy(*some, *grid).agg(F.sum("weight").alias("weight"), *[F.sum(c).alias(c) for c in _SUMS])

    for size in range(len(keys), 0, -1):
        some = keys[:size]
        level = estimates_of(pooled(some), some)
        level = level.withColumnsRenamed({**{k: f"_{k}" for k in some}, "centre": "_centre", "whiten": "_whiten"})
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in some])
        found = found.join(level, same, "left").select(*keys, *[F.coalesce(c, f"_{c}").alias(c) for c in ("centre", "whiten")])
    # The last estimate is one row of twenty numbers, alike for all groups.
    last = estimates_of(pooled([]).withColumn("_all", F.lit(0)), ["_all"]).first()
    if last:
        found = found.withColumns({c: F.coalesce(c, F.array(*map(F.lit, last[c]))) for c in ("centre", "whiten")})
    return found.where(F.col("centre").isNotNull())


def quality_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """Counts, the base verdict, the squared distance and the verdict of every document.

    Returns ``doc_id, lang, source``, the counts, ``base_failed, distance, kept``.
    """
    renamed = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col(text).alias("text")
    )
    counted = document_counts(renamed, ["doc_id", "lang", "source"], "text")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counted = written(counted.withColumn("base_failed", failed), "counts")
    found = written(pooled_estimates(counted, ["lang", "source"]), "estimates")
    found = found.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    joined = counted.join(
        found, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")), "left"
    )
    apart = [rate - F.get("centre", F.lit(i)) for i, rate in enumerate(rates())]
    whitened = [
        sum((F.get("whiten", F.lit(i * RATES + j)) * apart[j] for j in range(1, i + 1)), F.get("whiten", F.lit(i * RATES)) * apart[0])
        for i in range(RATES)
    ]
    distance = sum((w * w for w in whitened[1:]), whitened[0] * whitened[0])
    near = F.coalesce(F.col("distance") <= chi2_quantile(QUANTILE), F.lit(True))
    return joined.withColumn("distance", distance).withColumn("kept", ~F.col("base_failed") & near).drop(
        "of_lang", "of_source", "centre", "whiten"
    )


@query("op3_mcd_quality_rules")
def op3_mcd_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over all documents."""
    result = quality_rules(load(spark, sf_dir, "documents"))
    return result.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )
