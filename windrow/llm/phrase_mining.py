"""Phrase collocation mining (operator 12) over count streams in prefix and suffix order.

First the phrases are counted. Each task turns blocks of text into distinct phrases with counts
and deals them out by a hash of the whole phrase, so a very common word or phrase is one row per
block; packed blocks of ids with their own vocabulary move, not rows of text. What occurs often
enough is kept as a stream of counts: every part of a frequent phrase is frequent too, so the
streams hold all that a candidate's score needs.

The streams are laid out twice, sorted by the words from the left and from the right, and cut
into ranges. One pass over a range joins them in lockstep: a phrase comes right after the phrases
it begins with (or ends with, from the right), so a stack holds the counts of its left (right)
parts, the words of its language at the bottom, and the largest count among its extensions.
Phrases whose extensions reach into later ranges are copied there, so a range of a very
common first word can be cut anywhere. No table of phrases is looked up.

- null text: empty; null language: ``und``, together with rows that say so;
- ids play no part: repeated rows count as often as they stand there;
- very long texts are taken in pieces, a phrase across two of them counts once;
- empty table: no phrases; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from windrow.llm.common import in_batches, load, written
from windrow.llm.packing import chunks, pack, pack_words, tally, unpack, unpack_words
from windrow.llm.registry import query

#: Words of a block, phrases merged in one task, parts that a block is dealt to at once, rows of
#: a range, candidates ranked in one task before the ranks are merged.
BLOCK_WORDS, PART_ROWS, FAN, RANGE_ROWS, RANK_ROWS = 3_000_000, 4_000_000, 256, 250_000, 1_000_000

# What ends a piece becomes a line end, a tab a blank, A to Z become a to z.
_ENDS = set(b".,;:!?\n\x0b\x0c\r")
_FOLD = bytes(10 if b in _ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Marks in a sequence of word numbers: the end of a piece; nothing between two blanks.
_END, _NOTHING = -1, -2

BLOCKS = "part long, lang string, total long, words binary, lengths binary, ids array<binary>, counts array<binary>"
COUNTS = "lang string, size int, key binary, n long"


class Numbers(dict):
    """Words to numbers, given out as words come."""

    def __init__(self) -> None:
        super().__init__({b"\n": _END, b"": _NOTHING})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) - 2
        return number


class Block:
    """Word numbers per language, to be turned into counted phrases."""

    def __init__(self, max_words: int):
        self.max_words, self.numbers, self.size = max_words, Numbers(), 0
        self.said: dict[str, list[np.ndarray]] = {}
        self.begun: dict[str, int] = {}  # words at a language's beginning that the block before has counted

    def add(self, lang: str, tokens: list[bytes]) -> None:
        ids = np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens))
        self.said.setdefault(lang, []).append(ids[ids != _NOTHING])
        self.size += len(tokens)

    def tail(self, lang: str) -> list[bytes]:
        """The last words of a language, those that a phrase going on may need."""
        ids = np.concatenate(self.said[lang])
        ends = np.flatnonzero(ids == _END)
        ids = ids[ends[-1] + 1 if len(ends) else 0 :][-(self.max_words - 1) :] if self.max_words > 1 else ids[:0]
        words = list(self.numbers)[2:]
        return [words[i] for i in ids]

    def dealt(self, fan: int) -> Iterator[dict]:
        """Rows of ``BLOCKS``, dealt to ``fan`` parts."""
        words = pa.array(list(self.numbers)[2:], pa.binary())
        for lang, runs in self.said.items():
            ids = np.concatenate(runs)
            skip = self.begun.get(lang, 0)
            grams = []
            for n in range(1, self.max_words + 1):
                columns = [ids[k : len(ids) - n + 1 + k] for k in range(n)] if len(ids) >= n else [ids[:0]] * n
                whole = np.logical_and.reduce([c >= 0 for c in columns])
                whole[: max(0, skip - n + 1)] = False
                grams.append(tally([c[whole] for c in columns], max(1, len(words))))
            yield from deal(lang, words, grams, int(grams[0][1].sum()), fan)


def deal(lang: str, words: pa.Array, grams: list, total: int, fan: int, level: int = 0, part: int = 0) -> Iterator[dict]:
    """Counted phrases by a digit of their hash, each part with its own vocabulary."""
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words.to_pylist()], np.uint64)
    dealt = []
    for rows, sums in grams:
        mixed = np.zeros(len(sums), np.uint64)
        for column in rows:
            mixed = (mixed ^ hashes[column]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        digit = ((mixed >> np.uint64(8)) // np.uint64(fan**level) % np.uint64(fan)).astype(np.uint16)
        order = np.argsort(digit, kind="stable")
        bounds = np.concatenate([[0], np.cumsum(np.bincount(digit, minlength=fan))])
        dealt.append(([c[order] for c in rows], sums[order], bounds))
    used, place = np.zeros(len(words), bool), np.zeros(len(words), np.int32)
    for p in range(fan):
        some = [([c[b[p] : b[p + 1]] for c in rows], sums[b[p] : b[p + 1]]) for rows, sums, b in dealt]
        own_total = total if p == 0 else 0
        if not own_total and not any(len(sums) for _, sums in some):
            continue
        for rows, _ in some:
            for column in rows:
                used[column] = True
        own = np.flatnonzero(used)
        used[own] = False
        place[own] = np.arange(len(own))
        text, lengths = pack_words(words.take(pa.array(own)))
        yield {
            "part": part + p * fan**level,
            "lang": lang,
            "total": own_total,
            "words": text,
            "lengths": lengths,
            "ids": [pack(np.concatenate([place[c] for c in rows])) for rows, _ in some],
            "counts": [pack(sums.astype(np.int64)) for _, sums in some],
        }


def _each(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    for row in rows:
        yield pa.RecordBatch.from_pylist([row], _BLOCKS)


_BLOCKS = pa.schema(
    [("part", pa.int64()), ("lang", pa.string()), ("total", pa.int64()), ("words", pa.binary()), ("lengths", pa.binary()),
     ("ids", pa.list_(pa.binary())), ("counts", pa.list_(pa.binary()))]
)


def counted_blocks(docs: DataFrame, max_words: int, fan: int) -> DataFrame:
    """``BLOCKS`` of the phrases of all texts; ``docs`` has the columns lang and text."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        block = Block(max_words)
        for batch in batches:
            for lang, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                for chunk in chunks((value.as_py() or b"").translate(_FOLD)):
                    block.add(lang, chunk.replace(b"\n", b" \n ").split(b" "))
                    if block.size >= BLOCK_WORDS:
                        tail = block.tail(lang)
                        yield from block.dealt(fan)
                        block = Block(max_words)
                        block.add(lang, tail)
                        block.begun[lang] = len(tail)
                block.add(lang, [b"\n"])
        if block.size:
            yield from block.dealt(fan)

    return in_batches(docs.select("lang", F.col("text").cast("binary")), lambda b: _each(dealt(b)), BLOCKS)


class Merged:
    """Blocks of one language put together."""

    def __init__(self) -> None:
        self.words: list[pa.Array] = []
        self.rows: list[list[tuple[int, list[np.ndarray], np.ndarray]]] = []
        self.total, self.size, self.room = 0, 0, 2 * PART_ROWS

    def add(self, row: dict) -> None:
        self.words.append(unpack_words(row["words"], row["lengths"]))
        for n, (ids, counts) in enumerate(zip(row["ids"], row["counts"])):
            counts = unpack(counts, np.int64)
            columns = list(unpack(ids, np.int32).reshape(n + 1, -1))
            if len(self.rows) <= n:
                self.rows.append([])
            self.rows[n].append((len(self.words) - 1, columns, counts))
            self.size += len(counts)
        self.total += row["total"]

    def merge(self) -> tuple[pa.Array, list[tuple[list[np.ndarray], np.ndarray]]]:
        """One vocabulary, and the distinct phrases of each size with their counts."""
        coded = pa.concat_arrays(self.words).dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
        starts = np.concatenate([[0], np.cumsum([len(some) for some in self.words])])
        numbers = [code[a:b] for a, b in zip(starts[:-1], starts[1:])]
        grams = []
        for n, some in enumerate(self.rows):
            columns = [np.concatenate([numbers[b][cols[k]] for b, cols, _ in some]) for k in range(n + 1)]
            grams.append(tally(columns, max(1, len(words)), np.concatenate([counts for _, _, counts in some])))
        self.words, self.size = [words], sum(len(sums) for _, sums in grams)
        self.rows = [[(0, rows, sums)] for rows, sums in grams]
        return words, grams


def dealt_again(blocks: DataFrame, fan: int, level: int, slices: int) -> DataFrame:
    """Blocks of the parts of one level, merged in slices and dealt to the parts of the next."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        last, merged = None, {}

        def emptied(some: dict[str, Merged]) -> Iterator[dict]:
            for lang, have in some.items():
                words, grams = have.merge()
                yield from deal(lang, words, grams, have.total, fan, level, last)

        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != last:
                    yield from emptied(merged)
                    last, merged = row["part"], {}
                have = merged.setdefault(row["lang"], Merged())
                have.add(row)
                if have.size > PART_ROWS:
                    yield from emptied({row["lang"]: merged.pop(row["lang"])})
        yield from emptied(merged)

    slice_of = F.pmod(F.xxhash64("words", "counts"), F.lit(slices))
    spread = blocks.repartition(fan**level * slices, "part", slice_of).sortWithinPartitions("part")
    return in_batches(spread, lambda b: _each(dealt(b)), BLOCKS)


def _escape(word: bytes) -> bytes:
    """Order is kept, and the bytes 0 and the end of a word can't be mistaken."""
    return word.replace(b"\x01", b"\x01\x02").replace(b"\x00", b"\x01\x01")


def _plain(word: bytes) -> bytes:
    return word.replace(b"\x01\x01", b"\x00").replace(b"\x01\x02", b"\x01")


def frequent(blocks: DataFrame, parts: int, min_count: int) -> DataFrame:
    """``COUNTS``: phrases said at least ``min_count`` times, words joined by the byte 0.

    The empty phrase of a language has the number of all its words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[str, Merged] = {}
        for batch in batches:
            for row in batch.to_pylist():
                have = merged.setdefault(row["lang"], Merged())
                have.add(row)
                if have.size > have.room:
                    have.merge()
                    have.room = 2 * max(PART_ROWS, have.size)
        for lang, have in merged.items():
            words, grams = have.merge()
            if have.total:
                yield _counts(lang, 0, pa.array([b""], pa.binary()), [have.total])
            for n, (rows, sums) in enumerate(grams):
                often = np.flatnonzero(sums >= min_count)
                parts_of = [words.take(pa.array(c[often])) for c in rows]
                parts_of = [pa.array([_escape(w) for w in p.to_pylist()], pa.binary()) for p in parts_of]
                keys = pc.binary_join_element_wise(*parts_of, b"\x00") if n else parts_of[0]
                for start in range(0, len(often), 1 << 16):
                    cut = slice(start, start + (1 << 16))
                    yield _counts(lang, n + 1, keys[cut], sums[often[cut]])

    return in_batches(blocks.repartitionById(parts, F.col("part").cast("int")), run, COUNTS)


def _counts(lang: str, size: int, keys: pa.Array, counts) -> pa.RecordBatch:
    n = len(keys)
    columns = [pa.array([lang] * n, pa.string()), pa.array([size] * n, pa.int32()), keys, pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in COUNTS.split(", ")])


# Streams ---------------------------------------------------------------------------------

LAID = "part int, line binary, n long, copied boolean"
PASSED = "lang string, phrase string, size int, a long, n long, forward boolean, parts array<long>, longer long"


def _line(forward: bool, lang: str, key: bytes) -> bytes:
    """Sort key: the direction, the language, then the words from the left or from the right."""
    words = key.split(b"\x00") if key else []
    return b"\x00".join([(b"p" if forward else b"s") + _escape(lang.encode()), *(words if forward else words[::-1])])


def _splitters(counts: DataFrame, rows: int) -> list[bytes]:
    """Lines that cut both streams into ranges of about equal size, from a sample by hash.

    Some fifty lines for every range come to the driver; they only place the cuts.
    """
    ranges = math.ceil(2 * rows / RANGE_ROWS)
    if ranges < 2:
        return []
    every = max(1, rows // (50 * ranges))
    some = counts.where(F.pmod(F.xxhash64("lang", "key"), F.lit(every)) == 0).select("lang", "key").collect()
    lines = sorted(_line(forward, r.lang, bytes(r.key)) for r in some for forward in (True, False))
    return sorted({lines[len(lines) * i // ranges] for i in range(1, ranges)}) if lines else []


def laid_out(counts: DataFrame, cuts: list[bytes]) -> DataFrame:
    """Both streams in ranges, a phrase also where its extensions lie; sorted within each range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            laid: tuple[list, list, list, list] = ([], [], [], [])

            def put(part: int, line: bytes, n: int, copied: bool) -> None:
                for column, value in zip(laid, (part, line, n, copied)):
                    column.append(value)

            for lang, key, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "key", "n"))):
                for forward in (True, False):
                    line = _line(forward, lang, key)
                    own = bisect.bisect_right(cuts, line)
                    put(own, line, n, False)
                    for part in range(bisect.bisect_right(cuts, line + b"\x00"), bisect.bisect_left(cuts, line + b"\x01") + 1):
                        if part != own:
                            put(part, line, n, True)
            kinds = (pa.int32(), pa.binary(), pa.int64(), pa.bool_())
            arrays = [pa.array(c, k) for c, k in zip(laid, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in LAID.split(", ")])

    laid = in_batches(counts, run, LAID)
    return laid.repartitionById(len(cuts) + 1, "part").sortWithinPartitions("line")


def lockstep(laid: DataFrame) -> DataFrame:
    """``PASSED``: phrases of two words and more with the counts of the parts they begin (end) with.

    A phrase copied into several ranges is passed in each; its ``longer`` is the largest
    count among the extensions there.
    """

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        # Of every phrase the current one begins with: its words, count, and longest extension's count.
        stack: list[list] = []

        def leave() -> tuple | None:
            words, n, longer = stack.pop()
            if len(words) < 3:
                return None
            forward = words[0][:1] == b"p"
            said = b" ".join(map(_plain, words[1:] if forward else words[:0:-1])).decode("utf-8", "replace")
            parts = [held[1] for held in stack[1:]]
            return _plain(words[0][1:]).decode(), said, len(words) - 1, n, stack[0][1], forward, parts, longer

        for batch in batches:
            for line, n, copied in zip(*(batch.column(c).to_pylist() for c in ("line", "n", "copied"))):
                words = line.split(b"\x00")
                while stack and (len(stack) >= len(words) or stack[-1][0] != words[: len(stack)]):
                    if done := leave():
                        yield done
                if stack and not copied:
                    stack[-1][2] = max(stack[-1][2], n)
                stack.append([words, n, 0])
        while stack:
            if done := leave():
                yield done

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in PASSED.split(", ")]
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.int64())
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names)

        for row in passed(batches):
            held.append(row)
            if len(held) == 1 << 14:
                yield batch()
                held = []
        if held:
            yield batch()

    return in_batches(laid.select("line", "n", "copied"), run, PASSED)


def lowest_cut() -> Column:
    """Score, place and counts of the cut that binds the two parts least, the first of equal ones."""

    def wide(value: Column) -> Column:
        return value.cast("decimal(19,0)")

    def cut(k: Column) -> Column:
        left, right = F.get("lefts", k - 1), F.get("rights", F.col("size") - k - 1)
        square = wide(F.col("a")) * wide(F.col("a")) * F.lit(1_000_000).cast("decimal(7,0)")
        score = F.call_function("div", square, wide(left) * wide(right))
        return F.struct(score.alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    return F.array_min(F.transform(F.sequence(F.lit(1), F.col("size") - 1), cut))


def mine_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_words: int = 3,
    min_count: int = 10,
    share: int = 50,
    top: int = 2000,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Candidates are phrases of 2 to ``max_words`` words said ``min_count`` times or more. One that
    lies in a longer candidate said at least ``share`` per cent as often goes.
    """
    given = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size * max_words / 6 / PART_ROWS))
    levels = max(1, math.ceil(math.log(parts, FAN))) if parts > 1 else 1
    fan = max(1, math.ceil(parts ** (1 / levels)))
    blocks = counted_blocks(given, max_words, fan)
    for level in range(1, levels):
        blocks = dealt_again(blocks, fan, level, math.ceil(parts / fan**level))
    counts = written(frequent(blocks, fan**levels, min_count), "counts")
    rows = counts.count()
    passed = lockstep(laid_out(counts, _splitters(counts, rows)))
    # Every extension of a phrase is at most as frequent as some extension by one word.
    found = passed.groupBy("lang", "phrase", "size", "a", "n").agg(
        F.max(F.when(F.col("forward"), F.col("parts"))).alias("lefts"),
        F.max(F.when(~F.col("forward"), F.col("parts"))).alias("rights"),
        F.max("longer").alias("longer"),
    )
    kept = found.where(100 * F.col("longer") < share * F.col("a")).withColumn("cut", lowest_cut())
    scored = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Ranked in slices first, so that no task sorts all candidates of a language.
    sliced = scored.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(max(1, math.ceil(rows / RANK_ROWS)))))
    first = sliced.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
said AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM said),
grams AS (
  SELECT lang, list_slice(w, i, i + size - 1) AS g FROM starts, (VALUES (1), (2), (3)) AS sizes(size)
  WHERE i + size - 1 <= len(w)),
f AS (SELECT lang, g, len(g) AS size, count(*) AS a FROM grams GROUP BY lang, g),
words AS (SELECT lang, sum(a) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT * FROM f WHERE size >= 2 AND a >= 10),
cuts AS (
  SELECT c.lang, c.g, c.a, k, x.a AS l, y.a AS r, 1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) AS c
  JOIN f AS x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, k)
  JOIN f AS y ON y.lang = c.lang AND y.g = list_slice(c.g, k + 1, c.size)),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (
  SELECT lang, list_slice(g, 1, 2) AS g, a AS longer FROM candidates WHERE size = 3
  UNION ALL SELECT lang, list_slice(g, 2, 3), a FROM candidates WHERE size = 3),
dropped AS (SELECT c.lang, c.g FROM candidates AS c JOIN inside USING (lang, g) WHERE 100 * longer >= 50 * c.a),
ranked AS (
  SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM lowest ANTI JOIN dropped USING (lang, g))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN words USING (lang)
QUALIFY rank <= 2000
"""


@query("op12_stream_collocations", OP12_SQL)
def op12_stream_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of two and three words in all documents, 2000 for each language."""
    return mine_phrases(load(spark, sf_dir, "documents"))
