"""Toxicity (operator 7) by class-conditional Kneser-Ney models of letters.

Two models share one backoff. Within a class, a letter after four others has its discounted
count; the mass taken off goes to a Kneser-Ney model of lower order whose continuation counts
are those of both classes together, so that an expression rare in either class tells nothing.
The log-likelihood ratio per letter, toxic against ordinary, is averaged over every stretch of
a few letters, and the largest average decides: an insult in a long text weighs as much as in a
short one. A gram that neither class has seen leaves both to the shared model and counts as 0;
how much mass each class has left for it only tells how much text it had. A logistic curve
turns the average into a score.

Counts come from every labelled text of the training folds and are gathered by Spark. The model
has one ratio for every gram seen, under a 64-bit hash (equal hashes are taken as equal), and
grows with them; it travels to the tasks in blocks of about ``2 ** BITS`` grams, of which the
driver and a task hold one at a time. The curve is fitted on a bounded sample of the training
documents, ``SAMPLE`` labels taken by a hash of their id.

- null or empty text: scored like a text without letters;
- null label: not learned from; a class without a document: every score is 0;
- several rows with one id: one result each, labels of one id all count; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.common import fold_of, in_batches, kept, load, slices, written
from windrow.llm.registry import query

#: Letters of a gram, letters of a stretch, absolute discount.
ORDER, STRETCH, DISCOUNT = 5, 8, 0.75

#: Grams of a block of the model sent to the tasks, as a power of two; labelled documents that fit the curve.
BITS, SAMPLE = 21, 20_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def letter_table() -> np.ndarray:
    """The letter each code point counts as: lower case, a blank for all that is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            low = letter.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def letters_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts in a row, and where the grams of each begin and end."""
    table = kept(("letters",), letter_table)
    gap = " " * (ORDER - 1)
    raw = np.frombuffer("".join(gap + (t or "") + " " for t in texts).encode("utf-32-le", "replace"), "<u4")
    sizes = np.array([len(t or "") + 1 for t in texts], np.int64)
    firsts = np.cumsum(sizes + ORDER - 1) - sizes - (ORDER - 1)
    return table[raw], np.stack([firsts, firsts + sizes], axis=1)


def gram_codes(letters: np.ndarray) -> np.ndarray:
    """Hashes of the gram that begins at each place."""
    n = max(0, len(letters) - ORDER + 1)
    code = np.zeros(n, np.uint64)
    for k in range(ORDER):
        code = (code + letters[k : k + n] + np.uint64(1)) * _MIX
        code ^= code >> np.uint64(29)
    return code


def buckets(codes: np.ndarray) -> np.ndarray:
    """The key of a gram in the model: its hash, with the leading bits well mixed."""
    return codes * _MIX


def gram_counts(rows: DataFrame, text: str, toxic: str) -> DataFrame:
    """Every gram with its count in each class: ``gram, toxic, ordinary``."""
    names = ["gram", "toxic", "ordinary"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0, 3 << 20):
            letters, spans = letters_of(batch.column(0).to_pylist())
            codes = gram_codes(letters)
            label = np.repeat(np.asarray(batch.column(1)).astype(np.int64), spans[:, 1] - spans[:, 0])
            at = np.concatenate([np.arange(a, b) for a, b in spans]) if len(spans) else np.zeros(0, np.int64)
            _, first, kind = np.unique(codes[at], return_index=True, return_inverse=True)
            bad = np.bincount(kind, label, len(first)).astype(np.int64)
            plain = letters.tobytes().decode("utf-32-le", "replace")
            grams = [plain[i : i + ORDER] for i in at[first].tolist()]
            counts = np.bincount(kind, minlength=len(first)) - bad
            yield pa.RecordBatch.from_arrays([pa.array(grams), pa.array(bad), pa.array(counts)], names)

    found = in_batches(rows.select(text, toxic), run, "gram string, toxic long, ordinary long")
    return found.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def shared_backoff(grams: DataFrame) -> DataFrame:
    """Probability of a gram's last letter after those before it, for grams one shorter than given.

    Interpolated Kneser-Ney: a gram counts once for every letter seen before it, both classes
    together, down to single letters. Returns ``gram, p``.
    """
    levels = []
    longer = grams.select("gram")
    for size in range(ORDER - 1, 0, -1):
        longer = longer.groupBy(F.substring("gram", 2, size).alias("gram")).agg(F.count("*").alias("n"))
        levels.append((size, longer))
        longer = longer.select("gram")
    chance = None
    for size, level in reversed(levels):
        context = F.substring("gram", 1, size - 1)
        per = level.groupBy(context.alias("context")).agg(F.sum("n").alias("all"), F.count("*").alias("kinds"))
        with_context = level.withColumn("context", context).join(per, "context")
        if chance is None:
            chance = with_context.select("gram", (F.col("n") / F.col("all")).alias("p"))
            continue
        below = chance.select(F.col("gram").alias("ending"), F.col("p").alias("lower"))
        joined = with_context.withColumn("ending", F.substring("gram", 2, size - 1)).join(below, "ending")
        own = F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("all")
        chance = joined.select("gram", (own + DISCOUNT * F.col("kinds") / F.col("all") * F.col("lower")).alias("p"))
    return chance


def _kept_mass(kinds: Column, total: Column) -> Column:
    """What a class leaves to the backoff after a context; all of it where it has none."""
    return F.when(total > 0, DISCOUNT * kinds / total).otherwise(1.0)


def likelihood_ratios(grams: DataFrame) -> DataFrame:
    """Log ratio of every gram that a class has seen: ``gram, weight, ratio``."""
    context = F.substring("gram", 1, ORDER - 1)
    per = grams.groupBy(context.alias("context")).agg(
        *(F.sum(c).alias(f"{c}_all") for c in ("toxic", "ordinary")),
        *(F.sum((F.col(c) > 0).cast("long")).alias(f"{c}_kinds") for c in ("toxic", "ordinary")),
    )
    left = {c: _kept_mass(F.col(f"{c}_kinds"), F.col(f"{c}_all")) for c in ("toxic", "ordinary")}
    joined = grams.withColumns({"context": context, "ending": F.substring("gram", 2, ORDER - 1)}).join(per, "context")
    below = shared_backoff(grams).select(F.col("gram").alias("ending"), "p")

    def chance(c: str) -> Column:
        own = F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"{c}_all"), F.lit(1))
        return own + left[c] * F.col("p")

    return joined.join(below, "ending").select(
        "gram",
        (F.col("toxic") + F.col("ordinary")).alias("weight"),
        (F.log(chance("toxic")) - F.log(chance("ordinary"))).alias("ratio"),
    )


def block_of(keys: np.ndarray, ratio: np.ndarray, skip: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Keys in order, their ratios, and where the keys that share the bits after the first ``skip`` begin."""
    order = np.argsort(keys)
    keys, bits = keys[order], max(1, len(keys).bit_length())
    lead = (keys << np.uint64(skip)) >> np.uint64(64 - bits)
    return keys, ratio[order], np.searchsorted(lead, np.arange((1 << bits) + 1, dtype=np.uint64)), skip


def found_in(block: tuple[np.ndarray, np.ndarray, np.ndarray, int], asked: np.ndarray) -> np.ndarray:
    """The ratio of each key asked for, 0 where the block has none."""
    keys, ratio, starts, skip = block
    out = np.zeros(len(asked))
    lead = ((asked << np.uint64(skip)) >> np.uint64(64 - (len(starts) - 1).bit_length() + 1)).astype(np.int64)
    at, end = starts[lead], starts[lead + 1]
    left = np.flatnonzero(at < end)
    at, end = at[left], end[left]
    while len(left):
        same = keys[at] == asked[left]
        out[left[same]] = ratio[at[same]]
        on = ~same & (at + 1 < end)
        left, at, end = left[on], at[on] + 1, end[on]
    return out


class Ratios:
    """The ratio of every gram seen, by key; 0 for others. Block ``k`` has the keys whose first ``bits`` bits are ``k``."""

    def __init__(self, blocks: list, bits: int):
        self.blocks, self.bits = blocks, bits

    def __getitem__(self, keys):
        asked = np.atleast_1d(np.asarray(keys, np.uint64))
        if not self.bits:
            out = found_in(self.blocks[0].value, asked)
            return out if np.ndim(keys) else out[0]
        out = np.zeros(len(asked))
        block = (asked >> np.uint64(64 - self.bits)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        ends = np.cumsum(np.bincount(block, minlength=len(self.blocks)))
        for sent, first, last in zip(self.blocks, [0, *ends.tolist()], ends.tolist()):
            if last > first:
                some = order[first:last]
                out[some] = found_in(sent.value, asked[some])
                sent.__dict__.pop("_value", None)  # read again when asked again: one block in memory
        return out if np.ndim(keys) else out[0]


def bucketed(rows: DataFrame) -> Ratios:
    """The model of all grams given, ready for tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = "".join(batch.column(0).to_pylist()).encode("utf-32-le")
            chosen = gram_codes(np.frombuffer(raw, "<u4"))[::ORDER]
            yield pa.RecordBatch.from_arrays([pa.array(buckets(chosen).view(np.int64)), batch.column(1)], ["key", "ratio"])

    found = written(in_batches(rows.select("gram", "ratio"), run, "key long, ratio double"), "ratios")
    bits = max(0, (max(1, found.count()) - 1).bit_length() - BITS)
    blocks = []
    for k in range(1 << bits):
        block = found.where(F.shiftrightunsigned("key", 64 - bits) == k) if bits else found
        got = block.toArrow()
        keys, ratio = (got.column(c).to_numpy() for c in ("key", "ratio"))
        blocks.append(rows.sparkSession.sparkContext.broadcast(block_of(keys.view(np.uint64), ratio, bits)))
    return Ratios(blocks, bits)


def stretch_ratio(texts: list[str | None], table: Ratios) -> list[float]:
    """The largest mean log ratio over the stretches of each text."""
    letters, spans = letters_of(texts)
    ratio = table[buckets(gram_codes(letters))]
    sums = np.concatenate([[0.0], np.cumsum(ratio, dtype=np.float64)])
    best = []
    for first, last in spans.tolist():
        size = min(STRETCH, last - first)
        best.append(float((sums[first + size : last + 1] - sums[first : last + 1 - size]).max() / size))
    return best


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve by Newton steps, slightly drawn to zero."""
    rows = np.stack([x, np.ones_like(x)], axis=1)
    weights = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (p - y) + 0.05 * weights * [1, 0]
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag([0.05, 1e-6])
        step = np.linalg.solve(curve, slope)
        weights -= step / max(1.0, np.abs(step).max() / 3)
        if np.abs(step).max() < 1e-8:
            break
    return float(weights[0]), float(weights[1])


def score_texts(docs: DataFrame, model: tuple | None, keep: list[str], text: str = "text") -> DataFrame:
    """The columns to keep, with ``ratio`` and ``score``."""
    table, slope, start = model or (None, 0.0, 0.0)
    # Every block is read once for a slice: slices are larger where there are several.
    size = 1 << 20 if table is None or not table.bits else 8 << 20
    names = [*keep, "ratio", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(keep), size):
            texts = batch.column(len(keep)).to_pylist()
            ratio = np.array([0.0] * len(texts) if table is None else stretch_ratio(texts, table))
            score = ratio if table is None else 1 / (1 + np.exp(-np.clip(slope * ratio + start, -500, 500)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(ratio), pa.array(score)], names)

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "ratio double, score double"])
    return in_batches(docs.select(*keep, text), run, schema)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic"):
    """Model from labelled documents: the ratios and the curve; None without both classes."""
    given = labels.where(F.col(toxic).isNotNull()).select(F.col(doc_id).alias("id"), F.col(toxic).cast("int").alias("toxic"))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # Labels grow with the documents: they are never sent whole to the tasks, however few they are.
    labelled = texts.join(given.hint("shuffle_hash"), "id")
    grams = written(gram_counts(labelled, "text", "toxic"), "grams")
    table = bucketed(likelihood_ratios(grams))
    sample = given.orderBy(F.xxhash64("id"), "id", "toxic").limit(SAMPLE)
    scored = score_texts(texts.join(F.broadcast(sample), "id"), (table, 1.0, 0.0), ["toxic"]).toPandas()
    if scored["toxic"].nunique() < 2:
        return None
    return table, *fit_curve(scored["ratio"].to_numpy(), scored["toxic"].to_numpy(float))


@query("op7_kneser_ney_toxicity")
def op7_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from four fifths of those labelled."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    held = fold_of(F.col("doc_id"), 5) == 0
    model = train(docs.where(~held), labels.where(~held))
    scored = score_texts(docs.select("doc_id", held.alias("held_out"), "text"), model, ["doc_id", "held_out"])
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", "held_out", "score", predicted)
