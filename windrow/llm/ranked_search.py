"""Ranked lexical search (operator 11): Block-Max MaxScore over shards of an inverted index.

The index is a stored table of shards, each of whole documents of about four million words. A shard
has, per term, its postings in packed blocks of 128, and for each block the pairs of occurrences
and document length that no other posting of the block beats. A score grows with the one and
falls with the other, so these pairs give the block's exact maximum whatever the statistics of
the whole corpus turn out to be; these are sums over the stored shards.

A search goes through a shard in runs of documents. The bounds of the lists, lowest first, are added
up for as long as they stay under the score to beat: these lists are non-essential, and only
documents of the others are looked at. From the highest bound down, the non-essential lists then
give their block's maximum, which rejects most candidates before the block is unpacked. The ten
best go on to the task's next shard as the score to beat, and the heaps of all tasks are
merged by rank. Search terms are sent in blocks of bounded size, each for one pass over the shards.

- null or empty text: no terms, in a document or an item; such an item finds nothing;
- rows of equal ``doc_id`` are ranked each for itself, a null id after all others of its score;
- rows of equal ``item_id`` (nulls too) are one item with the terms of all its texts;
- fewer documents above 0 than asked: all of them; empty tables: no rows;
- extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from windrow.llm.common import in_batches, load, written
from windrow.llm.packing import chunks, firsts, pack, pack_words, tally, unpack, unpack_words
from windrow.llm.registry import query

#: Words of a shard, postings of a block, documents of a run, bytes of search terms sent at once.
SHARD_WORDS, BLOCK, RUN_DOCS, SENT_BYTES = 4_000_000, 128, 1024, 4 << 20

# Terms are runs of letters, digits and all characters beyond ASCII.
_KEPT = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if (b in _KEPT or 65 <= b <= 90) else 32 for b in range(256))

PACKED = "sizes words lengths counts lasts pairs pair_tf pair_size widths postings".split()
INDEX = "n_docs long, n_terms long, docs array<long>, " + ", ".join(f"{c} binary" for c in PACKED)


def terms_of(text: bytes | None) -> Iterator[list[bytes]]:
    """Terms of a text, in lists of bounded size."""
    for part in chunks((text or b"").translate(_FOLD)):
        yield part.split()


class Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


# The index -------------------------------------------------------------------------------


def _competitive(block: np.ndarray, tf: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Postings that none of their block beats in both: more occurrences, shorter document."""
    alone = np.bincount(block)[block] == 1
    some = np.flatnonzero(~alone)
    order = some[np.lexsort((size[some], -tf[some], block[some]))]
    # Each block lies below all before it, so one running minimum serves all.
    level = size[order].astype(np.int64) - block[order].astype(np.int64) * (int(size.max(initial=0)) + 1)
    least = np.minimum.accumulate(level) if len(level) else level
    wins = np.concatenate([[True], level[1:] < least[:-1]]) if len(level) else np.zeros(0, bool)
    return np.sort(np.concatenate([np.flatnonzero(alone), order[wins]]))


def _width(largest: np.ndarray) -> np.ndarray:
    return np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4))


def _packed_postings(block: np.ndarray, gaps: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Blocks in as few bytes as their largest number needs: the gaps, then the occurrences less one."""
    first = firsts(block)
    if not len(first):
        return np.zeros(0, np.uint8), b""
    counts = np.diff(first, append=len(block))
    wide = _width(np.maximum.reduceat(gaps, first)), _width(np.maximum.reduceat(tf - 1, first))
    starts = np.concatenate([[0], np.cumsum(counts * (wide[0] + wide[1]))])
    data = np.zeros(starts[-1], np.uint8)
    inside = np.arange(len(block)) - np.repeat(first, counts)
    for values, width, base in ((gaps, wide[0], starts[:-1]), (tf - 1, wide[1], starts[:-1] + counts * wide[0])):
        each = np.repeat(width, counts)
        place = np.repeat(base, counts) + inside * each
        for byte in range(4):
            has = each > byte
            data[place[has] + byte] = (values[has] >> (8 * byte)) & 255
    return (wide[0] * 8 + wide[1]).astype(np.uint8), data.tobytes()


def _shard(keys: list, sizes: list[int], words: list[bytes], ids: list[np.ndarray]) -> dict:
    """A row of ``INDEX``; documents in the order of their ids, nulls last."""
    size = np.array(sizes, np.int64)
    order = sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] or 0))
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    (term, doc), tf = tally([np.concatenate(ids), np.repeat(place, size)], max(len(words), len(keys), 1)) if ids else ([size[:0]] * 2, size[:0])
    size = size[order]
    counts = np.bincount(term, minlength=len(words)) if len(words) else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(counts)])
    within = np.arange(len(term)) - starts[term]
    blocks_of = -(-counts // BLOCK)
    block = np.concatenate([[0], np.cumsum(blocks_of)])[term] + within // BLOCK
    before = np.concatenate([[-1], doc[:-1]])
    before[within == 0] = -1
    widths, postings = _packed_postings(block, doc - before - 1, tf)
    last = np.flatnonzero(np.concatenate([block[1:] != block[:-1], [True]])) if len(block) else np.zeros(0, np.int64)
    best = _competitive(block, tf, size[doc]) if len(block) else np.zeros(0, np.int64)
    text, lengths = pack_words(pa.array(words, pa.binary()))
    return {
        "n_docs": int((size > 0).sum()),
        "n_terms": int(size.sum()),
        "docs": [keys[i] for i in order],
        "sizes": pack(size),
        "words": text,
        "lengths": lengths,
        "counts": pack(counts.astype(np.int32)),
        "lasts": pack(doc[last].astype(np.int32)),
        "pairs": pack(np.bincount(block[best]).astype(np.int32) if len(best) else np.zeros(0, np.int32)),
        "pair_tf": pack(tf[best].astype(np.int32)),
        "pair_size": pack(size[doc[best]].astype(np.int32)),
        "widths": pack(widths),
        "postings": postings,
    }


_INDEX = pa.schema(
    [("n_docs", pa.int64()), ("n_terms", pa.int64()), ("docs", pa.list_(pa.int64())), *[(c, pa.binary()) for c in PACKED]]
)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all texts, stored in the shared folder. Ids are integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes, ids, number, held = [], [], [], Numbers(), 0
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                size = 0
                for terms in terms_of(value.as_py()):
                    ids.append(np.fromiter(map(number.__getitem__, terms), np.int32, len(terms)))
                    size += len(terms)
                keys.append(key)
                sizes.append(size)
                held += size + 1
                if held >= SHARD_WORDS:
                    yield pa.RecordBatch.from_pylist([_shard(keys, sizes, list(number), ids)], _INDEX)
                    keys, sizes, ids, number, held = [], [], [], Numbers(), 0
        if keys:
            yield pa.RecordBatch.from_pylist([_shard(keys, sizes, list(number), ids)], _INDEX)

    given = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string").cast("binary"))
    return written(in_batches(given, run, INDEX), "shards")


# The search ------------------------------------------------------------------------------


class PostingList:
    """One term's postings in a shard, unpacked block by block as asked."""

    def __init__(self, shard: Shard, term: int, weight: int):
        self.shard, self.weight = shard, weight
        self.low, self.high = int(shard.block_of[term]), int(shard.block_of[term + 1])
        self.size = int(shard.counts[term])
        self.lasts = shard.lasts[self.low : self.high]
        self.unpacked: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @cached_property
    def bounds(self) -> np.ndarray:
        """The highest score in each block."""
        shard = self.shard
        a, b = shard.pair_start[self.low], shard.pair_start[self.high]
        scores = self.weight * shard.part(shard.pair_tf[a:b], shard.pair_length(slice(a, b)))
        return np.maximum.reduceat(scores, shard.pair_start[self.low : self.high] - a)

    @cached_property
    def bound(self) -> int:
        return int(self.bounds.max())

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the list's block ``i``."""
        have = self.unpacked.get(i)
        if have is None:
            shard, at = self.shard, self.low + i
            n = min(BLOCK, self.size - i * BLOCK)
            gap, tf = int(shard.widths[at]) >> 3, int(shard.widths[at]) & 7
            start = int(shard.posting_start[at])
            kinds = {1: np.uint8, 2: np.uint16, 4: np.uint32}
            gaps = np.frombuffer(shard.postings, kinds[gap], n, start).astype(np.int64)
            times = np.frombuffer(shard.postings, kinds[tf], n, start + n * gap).astype(np.int64) + 1
            docs = np.cumsum(gaps + 1) + (int(self.lasts[i - 1]) if i else -1)
            have = self.unpacked[i] = docs, self.weight * shard.part(times, shard.length[docs])
        return have

    def between(self, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Postings of the documents from ``low`` to before ``high``."""
        for i in range(int(np.searchsorted(self.lasts, low)), len(self.lasts)):
            docs, scores = self.block(i)
            a, b = np.searchsorted(docs, (low, high))
            yield docs[a:b], scores[a:b]
            if self.lasts[i] >= high - 1:
                break

    def block_of(self, docs: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lasts, docs)


class Shard:
    """A row of the index with the statistics of all documents."""

    def __init__(self, row: dict[str, pa.Scalar], n: int, total: int):
        raw = {c: row[c].as_py() for c in PACKED}
        self.docs, self.n, self.total = row["docs"].values, n, total
        self.sizes = unpack(raw["sizes"], np.int64)
        self.words = unpack_words(raw["words"], raw["lengths"])
        self.counts = unpack(raw["counts"], np.int32).astype(np.int64)
        self.lasts = unpack(raw["lasts"], np.int32)
        pairs = unpack(raw["pairs"], np.int32)
        self.pair_tf, self.pair_size = unpack(raw["pair_tf"], np.int32).astype(np.int64), unpack(raw["pair_size"], np.int32)
        self.widths, self.postings = unpack(raw["widths"], np.uint8), raw["postings"]
        blocks = -(-self.counts // BLOCK)
        self.block_of = np.concatenate([[0], np.cumsum(blocks)])
        self.pair_start = np.concatenate([[0], np.cumsum(pairs)])
        within = np.arange(len(self.lasts)) - np.repeat(self.block_of[:-1], blocks)
        held = np.minimum(BLOCK, np.repeat(self.counts, blocks) - within * BLOCK)
        self.posting_start = np.concatenate([[0], np.cumsum(held * ((self.widths >> 3) + (self.widths & 7)))])
        self.length = self._length(self.sizes)

    def _length(self, sizes: np.ndarray) -> np.ndarray:
        """The part of the formula that grows with a document's terms."""
        if int(sizes.max(initial=0)) * 90 * self.n >= 1 << 62:
            return np.array([10 + 90 * int(s) * self.n // self.total for s in sizes], np.int64)
        return 10 + 90 * sizes.astype(np.int64) * self.n // max(1, self.total)

    def pair_length(self, where: slice) -> np.ndarray:
        return self._length(self.pair_size[where])

    @staticmethod
    def part(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * tf // (1000 * tf + 8 * length)

    def lists(self, terms: pa.Array, weights: list[int]) -> dict[int, PostingList]:
        """The lists of those search terms that the shard has and that weigh anything."""
        found = pc.index_in(self.words, value_set=terms).to_numpy(zero_copy_only=False)
        here = np.flatnonzero(~np.isnan(found)) if found.dtype.kind == "f" else np.arange(len(found))
        return {int(found[t]): PostingList(self, int(t), weights[int(found[t])]) for t in here if weights[int(found[t])]}


Best = list[tuple[int, bool, int]]


def search_shard(shard: Shard, lists: list[PostingList], best: Best, k: int) -> Best:
    """The ``k`` best of ``best`` and the shard: (-score, id is null, id), in order."""
    lists = sorted((some for some in lists if some.bound), key=lambda some: some.bound)
    upto = np.cumsum([0, *[some.bound for some in lists]])  # upto[i]: the most that the lists before i can give
    for low in range(0, len(shard.sizes), RUN_DOCS):
        high = min(low + RUN_DOCS, len(shard.sizes))
        beat = -best[k - 1][0] if len(best) >= k else 0
        # Lists before this one can't reach the score to beat, even together.
        essential = int(np.searchsorted(upto[1:], beat, "left")) if beat else 0
        if essential == len(lists):
            break
        sums = np.zeros(high - low, np.int64)
        for some in lists[essential:]:
            for docs, scores in some.between(low, high):
                sums[docs - low] += scores
        docs = np.flatnonzero(sums)
        score = sums[docs]
        docs += low
        for i in range(essential - 1, -1, -1):
            some = lists[i]
            block = some.block_of(docs)
            most = np.append(some.bounds, 0)[block]
            alive = score + most + upto[i] >= beat
            docs, score, block = docs[alive], score[alive], block[alive]
            if not len(docs):
                break
            for b in np.unique(block[block < len(some.lasts)]).tolist():
                held, scores = some.block(b)
                mine = np.flatnonzero(block == b)
                at = np.searchsorted(held, docs[mine])
                same = held[at] == docs[mine]
                score[mine[same]] += scores[at[same]]
        good = score >= max(beat, 1)
        if good.any():
            keys = [shard.docs[int(d)].as_py() for d in _few(docs[good], score[good], k)]
            points = score[good][np.isin(docs[good], _few(docs[good], score[good], k))]
            best = sorted([*best, *[(-int(s), key is None, key or 0) for s, key in zip(points, keys)]])[:k]
    return best


def _few(docs: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` best documents by score, then by place, in the order of their places."""
    return np.sort(docs[np.lexsort((docs, -score))[:k]])


def asked_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Each item's distinct terms as rows (item, term), stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, value in zip(batch.column(0), batch.column(1)):
                for terms in terms_of(value.as_py()):
                    some = pa.array(sorted(set(terms)), pa.binary())
                    named = pa.array([item.as_py()] * len(some), pa.string())
                    yield pa.RecordBatch.from_arrays([named, some], ["item", "term"])

    given = items.select(F.col(item_id).cast("string"), F.col(text).cast("string").cast("binary"))
    return written(in_batches(given, run, "item string, term binary").distinct(), "asked")


def _sent(asked: DataFrame) -> Iterator[dict[str | None, list[bytes]]]:
    """Items with their terms, whole items in blocks of about ``SENT_BYTES``."""
    size = asked.agg(F.sum(F.octet_length("term") + 60)).first()[0] or 0
    blocks = math.ceil(size / SENT_BYTES)
    block = F.pmod(F.xxhash64("item"), F.lit(max(1, blocks)))
    for b in range(blocks):
        items: dict[str | None, list[bytes]] = {}
        for row in asked.where(block == b).collect():
            items.setdefault(row.item, []).append(bytes(row.term))
        if items:
            yield items


def _documents_with(index: DataFrame, terms: list[bytes]) -> dict[bytes, int]:
    """The number of documents that hold each of the terms."""
    sent = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = pa.array(sent.value, pa.binary())
        sums = np.zeros(len(asked), np.int64)
        for batch in batches:
            for words, lengths, counts in zip(*(batch.column(c).to_pylist() for c in ("words", "lengths", "counts"))):
                found = pc.fill_null(pc.index_in(asked, value_set=unpack_words(words, lengths)), -1).to_numpy()
                counts = unpack(counts, np.int32)
                sums[found >= 0] += counts[found[found >= 0]]
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(sums[some], pa.int64())], ["term", "df"])

    rows = in_batches(index.select("words", "lengths", "counts"), run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {terms[r.term]: r.df for r in rows.collect()}


def _searched(index: DataFrame, items: dict, n: int, total: int, k: int) -> DataFrame:
    """The ``k`` best of each task for every item of a block: ``item, doc_id, score``."""
    terms = sorted({t for some in items.values() for t in some})
    df = _documents_with(index, terms)
    terms = [t for t in terms if t in df]
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) for t in terms]
    number = {t: i for i, t in enumerate(terms)}
    named = [(item, [number[t] for t in some if t in number]) for item, some in items.items()]
    sent = index.sparkSession.sparkContext.broadcast((terms, weights, named))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, named = sent.value
        asked = pa.array(terms, pa.binary())
        best: list[Best] = [[] for _ in named]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard({name: batch.column(name)[i] for name in batch.schema.names}, n, total)
                lists = shard.lists(asked, weights)
                for j, (_, some) in enumerate(named):
                    best[j] = search_shard(shard, [lists[t] for t in some if t in lists], best[j], k)
        rows = [(item, None if no_id else key, -score) for (item, _), some in zip(named, best) for score, no_id, key in some]
        if rows:
            arrays = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score"])

    return in_batches(index, run, "item string, doc_id long, score long")


def search_index(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", k: int = 10) -> DataFrame:
    """The ``k`` best documents of each item: ``item_id, rank, doc_id, score``."""
    kind = items.schema[item_id].dataType
    n, total = (value or 0 for value in index.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    found = None
    for block in _sent(asked_terms(items, item_id, text)):
        part = _searched(index, block, n, total, k)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = index.sparkSession.createDataFrame([], "item string, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").cast(kind).alias(item_id), "rank", "doc_id", "score")


_TERMS_SQL = r"""unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t"""

OP11_SQL = f"""
WITH said AS (SELECT doc_id, {_TERMS_SQL} FROM documents),
asked AS (SELECT DISTINCT item_id, t FROM (SELECT item_id, {_TERMS_SQL} FROM benchmark)),
times AS (SELECT doc_id, t, count(*) AS tf FROM said GROUP BY doc_id, t),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM times GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes),
weights AS (
  SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
  FROM (SELECT t, count(*) AS df FROM times GROUP BY t), totals),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN times USING (t) JOIN weights USING (t) JOIN sizes USING (doc_id), totals
  GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""


@query("op11_block_max_search", OP11_SQL)
def op11_block_max_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item."""
    index = build_index(load(spark, sf_dir, "documents"))
    return search_index(index, load(spark, sf_dir, "benchmark"))
