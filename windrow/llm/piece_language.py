"""Language identification (operator 5) by segmentation-marginalised unigrams.

A word's probability in a language is the sum, over all ways to cut it into pieces of a fixed
public vocabulary, of the product of the pieces' probabilities in that language; a forward
pass over the word computes it without listing the ways. The piece probabilities are expected
counts from a forward-backward pass over every training text, so what is gathered has at most
one number per piece and language, however large the corpus.

The sums run on plain products; a word whose products come near the smallest number that a
float holds in any language (long runs of letters never learned) is summed again in logs.

Words are runs of letters, lower-cased and marked at their start, each summed over whole, however long:
scripts without blanks have runs of a paragraph. Words of up to ``LONGEST`` letters go together;
a longer one goes letter by letter, with the states that a piece can reach back to and a scale
per language, so its memory does not grow with it. Equal words of a batch are scored once.
The probabilities come from one expectation step, from even ones.

- null text or text without a letter: ``und``, score 0; null languages are never learned;
- several rows with one id: one result each; equal likelihoods: the first language by name;
- nothing to learn from: every text is ``und``; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.common import fold_of, in_batches, kept, load
from windrow.llm.registry import query

#: Letters of words that are scored together, words scored together, weight of the shared counts.
LONGEST, TOGETHER, SHARED = 32, 16_384, 200.0

#: A sum of products this large has lost nothing that counts to underflow: what is lost is below 1e-300.
SAFE = 1e-200

START = "▁"
_words = re.compile(r"[^\W\d_]+").findall


def cut_words(piece: str) -> list[str]:
    """Marked words of a text."""
    return [START + w for w in _words(piece.lower())]


def in_order(words: list[str]) -> tuple[np.ndarray, list[int]]:
    """Places of the words that go together, by length, and of those that are too long for it."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    short = [i for i in order if len(words[i]) <= LONGEST + 1]
    return np.array(short, np.int64), order[len(short) :]


class Lattice:
    """The pieces of a vocabulary as a trie, and the ways to cut words into them."""

    def __init__(self, pieces: list[str]):
        self.pieces = pieces
        child: dict[int, int] = {}
        piece_at = [-1]
        for number, piece in enumerate(pieces):
            node = 0
            for letter in piece:
                key = node << 21 | ord(letter)
                if key not in child:
                    child[key] = len(piece_at)
                    piece_at.append(-1)
                node = child[key]
            piece_at[node] = number
        self.child, self.depth = child, max(map(len, pieces))
        keys = np.array(sorted(child), np.int64)
        self.keys = np.append(keys, 1 << 62)
        self.children = np.array([child[k] for k in keys.tolist()] + [0], np.int32)
        self.piece_at = np.array(piece_at, np.int32)
        #: The number of the piece that stands for a letter outside the vocabulary.
        self.unknown = len(pieces)

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
        """Lengths, and per start and length of a piece the words that have one: (start, end, words, pieces)."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        width = int(size.max())
        letters = np.zeros((len(words), width), np.int64)
        letters[np.arange(width) < size[:, None]] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        steps = []
        for start in range(width):
            row = np.flatnonzero(size > start)
            node = np.zeros(len(row), np.int64)
            for end in range(start + 1, width + 1):
                letter = letters[row, end - 1]
                key = node << 21 | letter
                at = np.searchsorted(self.keys, key)
                live = (self.keys[at] == key) & (letter > 0)
                if end == start + 1:
                    known = np.where(live, self.piece_at[self.children[at]], -1)
                    lost = known < 0
                    if lost.any():
                        steps.append((start, end, row[lost], np.full(int(lost.sum()), self.unknown)))
                row, node = row[live], self.children[at[live]].astype(np.int64)
                if not len(row):
                    break
                piece = self.piece_at[node]
                hit = piece >= 0
                if hit.any():
                    steps.append((start, end, row[hit], piece[hit]))
        return size, width, steps

    def forward(self, words: list[str], chance: np.ndarray) -> np.ndarray:
        """Log probability of each word under each column of ``chance`` (piece by language)."""
        logs = np.empty((len(words), chance.shape[1]))
        order, long = in_order(words)
        for i in long:
            logs[i] = self.forward_long(words[i], chance)
        for first in range(0, len(order), TOGETHER):
            rows = order[first : first + TOGETHER]
            size, width, steps = self.edges([words[i] for i in rows.tolist()])
            reach = np.zeros((width + 1, len(rows), chance.shape[1]))
            reach[0] = 1.0
            for start, end, row, piece in steps:
                reach[end, row] += reach[start, row] * chance[piece]
            whole = reach[size, np.arange(len(rows))]
            low = (whole < SAFE).any(axis=1)
            logs[rows[~low]] = np.log(whole[~low])
            if low.any():
                logs[rows[low]] = self.forward_in_logs([words[i] for i in rows[low].tolist()], chance)
        return logs

    def forward_in_logs(self, words: list[str], chance: np.ndarray) -> np.ndarray:
        """The same for words whose products are too small for a float."""
        size, width, steps = self.edges(words)
        with np.errstate(divide="ignore"):
            logs = np.log(chance)
        reach = np.full((width + 1, len(words), chance.shape[1]), -np.inf)
        reach[0] = 0.0
        for start, end, row, piece in steps:
            reach[end, row] = np.logaddexp(reach[end, row], reach[start, row] + logs[piece])
        return reach[size, np.arange(len(words))]

    def ways(self, word: str, start: int) -> Iterator[tuple[int, int]]:
        """Ends and pieces of the steps from a place of a word."""
        node, child, piece_at = 0, self.child, self.piece_at
        for end in range(start, min(len(word), start + self.depth)):
            node = child.get(node << 21 | ord(word[end]))
            piece = -1 if node is None else int(piece_at[node])
            if piece >= 0:
                yield end + 1, piece
            elif end == start:
                yield end + 1, self.unknown
            if node is None:
                return

    def forward_long(self, word: str, chance: np.ndarray) -> np.ndarray:
        """The same for one word of any length, letter by letter."""
        ring = self.depth + 1
        reach = np.zeros((ring, chance.shape[1]))
        reach[0], logs = 1.0, np.zeros(chance.shape[1])
        for start in range(len(word)):
            here = reach[start % ring].copy()
            reach[start % ring] = 0.0
            for end, piece in self.ways(word, start):
                reach[end % ring] += here * chance[piece]
            if start % 8 == 7:
                scale = reach.max(axis=0)
                reach /= scale
                logs += np.log(scale)
        return logs + np.log(reach[len(word) % ring])

    def expected_long(self, word: str, weight: float, chance: np.ndarray, into: np.ndarray) -> None:
        """Add the expected pieces of one word of any length, in logs."""
        n, logs = len(word), np.log(chance).tolist()
        ahead, back = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
        ahead[0] = back[n] = 0.0

        def plus(a: float, b: float) -> float:
            low, high = (a, b) if a < b else (b, a)
            return high if low == -math.inf else high + math.log1p(math.exp(low - high))

        for start in range(n):
            for end, piece in self.ways(word, start):
                ahead[end] = plus(ahead[end], ahead[start] + logs[piece])
        for start in range(n - 1, -1, -1):
            for end, piece in self.ways(word, start):
                onward = logs[piece] + back[end]
                into[piece] += weight * math.exp(ahead[start] + onward - ahead[n])
                back[start] = plus(back[start], onward)

    def expected(self, words: list[str], weight: np.ndarray, chance: np.ndarray, into: np.ndarray) -> None:
        """Add the expected number of each piece in the words, each word ``weight`` times."""
        order, long = in_order(words)
        for i in long:
            self.expected_long(words[i], float(weight[i]), chance, into)
        for first in range(0, len(order), TOGETHER):
            rows = order[first : first + TOGETHER]
            size, width, steps = self.edges([words[i] for i in rows.tolist()])
            n = len(rows)
            ahead, back = np.zeros((width + 1, n)), np.zeros((width + 1, n))
            ahead[0] = 1.0
            for start, end, row, piece in steps:
                ahead[end, row] += ahead[start, row] * chance[piece]
            back[size, np.arange(n)] = weight[rows] / ahead[size, np.arange(n)]
            for start, end, row, piece in reversed(steps):
                onward = back[end, row] * chance[piece]
                back[start, row] += onward
                into += np.bincount(piece, ahead[start, row] * onward, len(into))


def vocabulary(path: str) -> Lattice:
    """Lower-cased pieces of a sentencepiece file that are letters, with or without the start mark."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {START}
    for number in range(model.get_piece_size()):
        piece = model.id_to_piece(number).lower()
        bare = piece.removeprefix(START)
        if bare and _words(bare) == [bare] and not (model.is_control(number) or model.is_unknown(number)):
            pieces.add(piece)
    return Lattice(sorted(pieces))


def learn(rows: DataFrame, path: str, lang: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages by name, and the probability of every piece in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = kept(("lattice", path), lambda: vocabulary(path))
        even = np.full(len(lattice.pieces) + 1, 1 / (len(lattice.pieces) + 1))
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            found: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, Counter()).update(text.split())
            for lang, pieces in found.items():
                words: Counter = Counter()
                for piece, times in pieces.items():
                    for word in cut_words(piece):
                        words[word] += times
                into = sums.setdefault(lang, np.zeros(len(even)))
                if words:
                    lattice.expected(list(words), np.array(list(words.values()), float), even, into)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at])],
                ["lang", "piece", "n"],
            )

    trained = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(lang, text)
    counts = in_batches(trained, run, "lang string, piece int, n double")
    # At most one row per piece and language.
    counted = counts.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counted["lang"].unique())
    size = len(vocabulary(path).pieces) + 1
    table = np.zeros((size, len(langs)))
    table[counted["piece"], counted["lang"].map({x: i for i, x in enumerate(langs)}).astype(int)] = counted["n"]
    # Pieces that a language lacks get a share by their use in all, and every piece a little.
    overall = (table.sum(axis=1) + 0.1) / (table.sum() + 0.1 * size)
    return langs, (table + SHARED * overall[:, None]) / (table.sum(axis=0) + SHARED)


def predict(
    docs: DataFrame, langs: list[str], chance: np.ndarray, path: str, keep: list[str], text: str = "text"
) -> DataFrame:
    """The columns to keep, with ``lang_pred`` and ``score``, the language's share of the likelihood."""
    sent = docs.sparkSession.sparkContext.broadcast(chance)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = kept(("lattice", path), lambda: vocabulary(path))
        for batch in batches:
            pieces = [(t or "").split() if langs else [] for t in batch.column(len(keep)).to_pylist()]
            number = {p: i for i, p in enumerate({p for some in pieces for p in some})}
            cut = [cut_words(p) for p in number]
            place = {w: i for i, w in enumerate({w for words in cut for w in words})}
            of = np.repeat(np.arange(len(cut)), [len(words) for words in cut])
            at = np.array([place[w] for words in cut for w in words], np.int64)
            score = np.zeros((len(number) + 1, max(1, len(langs))))
            if place:
                logs = lattice.forward(list(place), sent.value)
                for k in range(len(langs)):
                    score[:-1, k] = np.bincount(of, logs[at, k], len(number))
            said, sure = [], []
            for some in pieces:
                total = score[[number[p] for p in some]].sum(axis=0) if some else score[-1]
                if not total.any():
                    said.append("und")
                    sure.append(0.0)
                    continue
                best = int(total.argmax())
                said.append(langs[best])
                sure.append(float(1 / np.exp(total - total[best]).sum()))
            columns = [*batch.columns[: len(keep)], pa.array(said, pa.string()), pa.array(sure, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "lang_pred string", "score double"])
    return in_batches(docs.select(*keep, text), run, schema)


@query("op5_piece_language")
def op5_piece_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learned from two thirds of those that have one."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = load(spark, sf_dir, "documents")
    held = (fold_of(F.col("doc_id"), 3) == 1).alias("held_out")
    langs, chance = learn(docs.where(~held), path)
    return predict(docs.select("doc_id", held, "text"), langs, chance, path, ["doc_id", "held_out"])
