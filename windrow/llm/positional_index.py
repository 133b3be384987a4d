"""Benchmark decontamination (operator 10) by a distributed positional inverted index.

The training texts are cut into segments of about half a million words, whole documents each. A
segment is one row of a stored table: its documents, its terms, and per term the sorted
positions where it stands. Test items are searched in every segment: lists are taken from the
rarest term to the most frequent, each moved back by its offset in the phrase and intersected
with what is left, so most phrases end at a term the segment does not have. Proximity works the
same way on the ranges of window starts from which a term is in reach. A segment never needs
another one, so nothing is shuffled and no term is hot. Tests are sent in blocks of bounded
size, each searched against the whole index.

What a segment holds is packed into a few binary values, and the stored table is cut into small row
groups, as Spark decodes up to a whole one at once for each task that reads. Texts are read a few
hundred at a time. Phrases of tests are kept as places in the words of their items, never written out.

- null or empty text: no words, never hit; a null id: a row of its own;
- an item without words: no phrase; items with one text or one id: each counts, equal ids once;
- items with a null id are searched like others and cover words; those that hit count as one item
  among the items hit, and the list of ids leaves them out;
- an occurrence never crosses from one document into the next;
- extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.common import in_batches, load, short_reads, written
from windrow.llm.packing import firsts, pack, pack_list, unpack, unpack_words
from windrow.llm.registry import query

#: Words and documents of a segment, unless one document has more; test text sent to the tasks at once.
SEGMENT_WORDS, BLOCK_BYTES = 500_000, 8 << 20

#: Bytes of a row group of the stored index, unless one segment has more; texts read at once.
ROW_GROUP_BYTES, READ_ROWS = 4 << 20, 512

# Words are runs of letters, digits and all characters beyond ASCII.
_KEPT = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if (b in _KEPT or 65 <= b <= 90) else 32 for b in range(256))

PACKED = "sizes words lengths counts steps".split()
INDEX = "docs array<long>, " + ", ".join(f"{c} binary" for c in PACKED)
MATCHES = "array<struct<item:string,first:int,last:int>>"


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8, A to Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _segment_row(docs: list, sizes: list[int], ids: list[int], terms: dict[bytes, int]) -> pa.RecordBatch:
    """Postings by term; a posting is stored as its step from the one before."""
    of = np.array(ids, np.int32)
    at = np.argsort(of, kind="stable").astype(np.int32)
    counts = np.bincount(of, minlength=len(terms)).astype(np.int32)
    steps = np.diff(at, prepend=np.int32(0))
    begins = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)[counts > 0]
    steps[begins] = at[begins]
    packed = [pack(np.array(sizes, np.int32)), *pack_list(list(terms)), pack(counts), pack(steps)]
    columns = [pa.array([docs], pa.list_(pa.int64())), *(pa.array([c], pa.binary()) for c in packed)]
    return pa.RecordBatch.from_arrays(columns, ["docs", *PACKED])


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The positional index of all texts, stored in the shared folder. Ids are integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list[int], list[int], dict[bytes, int]] = ([], [], [], {})
        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(value.as_py())
                rows, sizes, ids, terms = held
                if rows and len(ids) + len(rows) + len(words) >= SEGMENT_WORDS:
                    yield _segment_row(*held)
                    rows, sizes, ids, terms = held = ([], [], [], {})
                rows.append(key)
                sizes.append(len(words))
                for word in set(words).difference(terms):
                    terms[word] = len(terms)
                ids.extend(map(terms.__getitem__, words))
        if held[0]:
            yield _segment_row(*held)

    rows = in_batches(docs.select(F.col(doc_id).cast("long"), text), run, INDEX)
    # The values are compressed, and sizes are looked at from a group's first row on.
    options = {
        "compression": "none",
        "parquet.enable.dictionary": "false",
        "parquet.block.size": str(ROW_GROUP_BYTES),
        "parquet.page.size.row.check.min": "1",
        "parquet.page.size.row.check.max": "1",
    }
    with short_reads(docs.sparkSession, READ_ROWS):
        return written(rows, "positions", **options)


class Segment:
    """One row of the index, its lists ready to be intersected."""

    def __init__(self, row: dict[str, pa.Scalar]):
        sizes, words, lengths, counts, steps = (row[name].as_py() for name in PACKED)
        self.docs = row["docs"].values
        self.starts = np.concatenate([[0], np.cumsum(unpack(sizes, np.int32), dtype=np.int64)])
        self.terms = unpack_words(words, lengths)
        self.ends = np.concatenate([[0], np.cumsum(unpack(counts, np.int32), dtype=np.int64)])
        self.steps = unpack(steps, np.int32)

    def number(self, words: pa.Array) -> np.ndarray:
        """Term numbers of words, -1 where the segment lacks one."""
        return np.asarray(pc.fill_null(pc.index_in(words, self.terms), -1), dtype=np.int64)

    def count(self, terms: np.ndarray) -> np.ndarray:
        return np.where(terms < 0, 0, self.ends[terms + 1] - self.ends[terms])

    def positions(self, term: int) -> np.ndarray:
        return np.cumsum(self.steps[self.ends[term] : self.ends[term + 1]], dtype=np.int64)

    def within(self, first: np.ndarray, size: int) -> np.ndarray:
        """Those of the starts whose next ``size`` words lie in one document."""
        doc = np.searchsorted(self.starts, first, "right") - 1
        return first[first + size <= self.starts[doc + 1]]

    def phrase(self, terms: np.ndarray, lists: dict[int, np.ndarray]) -> np.ndarray:
        """Where the terms stand in a row: offset-adjusted lists, the rarest first."""
        left = None
        for offset in np.argsort(self.count(terms), kind="stable").tolist():
            term = int(terms[offset])
            here = lists.get(term)
            if here is None:
                here = lists[term] = self.positions(term)
            if left is None:
                left = here[here >= offset] - offset
            else:
                at = np.searchsorted(here, left + offset)
                at[at == len(here)] = 0
                left = left[here[at] == left + offset]
            if not len(left):
                break
        return self.within(left, len(terms))

    def near(self, terms: np.ndarray, span: int) -> np.ndarray:
        """Starts of the ``span`` consecutive words of one document that hold every term.

        A start is left out when the one before it serves as well, unless a document begins there.
        """
        terms = np.unique(terms)
        left = None
        for term in terms[np.argsort(self.count(terms), kind="stable")].tolist():
            here = self.positions(term)
            if left is None:
                doc = np.searchsorted(self.starts, here, "right") - 1
                low = np.maximum(here - span + 1, self.starts[doc])
                left = np.unique(np.concatenate([np.arange(a, b + 1) for a, b in zip(low, here)]))
            at = np.searchsorted(here, left)
            reach = np.where(at < len(here), here[np.minimum(at, len(here) - 1)], np.iinfo(np.int64).max)
            doc = np.searchsorted(self.starts, left, "right") - 1
            left = left[(reach < left + span) & (reach < self.starts[doc + 1])]
            if not len(left):
                break
        first = np.ones(len(left), bool)
        first[1:] = (np.diff(left) > 1) | np.isin(left[1:], self.starts)
        return left[first]


class Tests:
    """The phrases of a block of test items: windows of consecutive words.

    The words of all items stand one after the other as numbers; a phrase is the place of its
    first occurrence there.
    """

    def __init__(self, items: list[tuple[str, str | None]], window: int | None):
        self.items = [item for item, _ in items]
        number: dict[bytes, int] = {}
        parts = [np.array([number.setdefault(w, len(number)) for w in words_of(text)], np.int32) for _, text in items]
        self.words = pa.array(list(number), pa.binary())
        self.ids = np.concatenate([np.zeros(0, np.int32), *parts])
        lengths = np.array([len(part) for part in parts], np.int64)
        sizes = lengths if window is None else np.minimum(lengths, window)
        begins = np.cumsum(lengths) - lengths
        # Runs of one, two, four ... words are numbered by twos of the runs before.
        run, of_run = 1, self.ids.astype(np.int64)
        #: By size: places of the distinct phrases, the items of each one, where these begin.
        self.sizes: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
        for size in np.unique(sizes[sizes > 0]).tolist():
            while 2 * run <= size:
                code = of_run[:-run] * len(self.ids) + of_run[run:]
                of_run, run = np.unique(code, return_inverse=True)[1], 2 * run
            asked = np.flatnonzero(sizes == size)
            held = lengths[asked] - size + 1
            item = np.repeat(asked, held)
            place = np.repeat(begins[asked] - (np.cumsum(held) - held), held) + np.arange(held.sum())
            code = of_run[place] * len(self.ids) + of_run[place + size - run]
            phrase = np.unique(code, return_index=True, return_inverse=True)[1:]
            pairs = np.unique(phrase[1] * len(items) + item)
            holder, item = np.divmod(pairs, len(items))
            self.sizes.append((size, place[phrase[0]], item, np.append(firsts(holder), len(item))))


def _search(segment: Segment, tests: Tests, span: int | None) -> list[list[dict] | None]:
    """Matches per document of a segment, runs of overlapping windows as one."""
    terms = segment.number(tests.words)
    lists: dict[int, np.ndarray] = {}
    hits: dict[int, list[tuple[np.ndarray, int]]] = {}
    ids = terms[tests.ids]
    lacks = np.concatenate([[0], np.cumsum(ids < 0)])
    for size, places, items, begins in tests.sizes:
        for i in np.flatnonzero(lacks[places] == lacks[places + size]).tolist():
            asked = ids[places[i] : places[i] + size]
            found = segment.phrase(asked, lists) if span is None else segment.near(asked, span)
            if len(found):
                for item in items[begins[i] : begins[i + 1]].tolist():
                    hits.setdefault(item, []).append((found, size if span is None else span))
    matches: list[list[dict] | None] = [None] * len(segment.docs)
    for item, some in hits.items():
        first = np.concatenate([f for f, _ in some])
        last = np.concatenate([f + size - 1 for f, size in some])
        doc = np.searchsorted(segment.starts, first, "right") - 1
        last = np.minimum(last, segment.starts[doc + 1] - 1)
        order = np.lexsort((last, first))
        first, last, doc = first[order], np.maximum.accumulate(last[order]), doc[order]
        new = np.concatenate([[True], first[1:] > last[:-1] + 1]) | np.concatenate([[True], doc[1:] != doc[:-1]])
        cut = np.flatnonzero(new)
        ends = last[np.concatenate([cut[1:] - 1, [len(last) - 1]])]
        for d, a, b in zip(doc[cut].tolist(), first[cut].tolist(), ends.tolist()):
            start = int(segment.starts[d])
            if matches[d] is None:
                matches[d] = []
            matches[d].append({"item": tests.items[item], "first": a - start, "last": b - start})
    return matches


def _blocks(items: DataFrame) -> Iterator[list[tuple[str, str | None]]]:
    """Items as (id, text), in blocks of about ``BLOCK_BYTES`` of text."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(size / BLOCK_BYTES) or 1
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for k in range(blocks):
        rows = items.where(block == k).collect()
        yield [(row.item, row.text) for row in rows]


def search_index(
    index: DataFrame,
    items: DataFrame,
    item_id: str = "item_id",
    text: str = "text",
    window: int | None = 13,
    span: int | None = None,
) -> DataFrame:
    """Occurrences of test items in the indexed documents, one row per document.

    A phrase is every run of ``window`` words of an item (the whole item where it is shorter, or
    where ``window`` is None). With ``span``, a phrase occurs where all its words stand within
    ``span`` consecutive words, in any order. Returns ``doc_id, n_words`` and ``matches``, an
    array of item, first and last word of each stretch covered.
    """
    asked = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    parts = []
    for block in _blocks(asked):
        sent = index.sparkSession.sparkContext.broadcast(block)
        parts.append(_searched(index, sent, window, span))
    if len(parts) == 1:
        return parts[0].select("doc_id", "n_words", "matches")
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    whole = F.flatten(F.collect_list("matches")).alias("matches")
    return found.groupBy("segment", "at", "doc_id", "n_words").agg(whole).select("doc_id", "n_words", "matches")


def _searched(index: DataFrame, sent, window: int | None, span: int | None) -> DataFrame:
    names = ["segment", "at", "doc_id", "n_words", "matches"]
    struct = pa.list_(pa.struct([("item", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = Tests(sent.value, window)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                segment = Segment(row)
                n = len(segment.docs)
                found = [m or [] for m in _search(segment, tests, span)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["segment"].as_py()] * n, pa.string()),
                        pa.array(range(n), pa.int32()),
                        segment.docs.cast(pa.int64()),
                        pa.array(np.diff(segment.starts), pa.int64()),
                        pa.array(found, struct),
                    ],
                    names,
                )

    # A segment is known by its documents and their sizes, which no other one shares in full
    # unless it is equal in every way.
    name = F.concat_ws(":", F.input_file_name(), F.xxhash64("docs", "sizes", "counts"), F.monotonically_increasing_id())
    schema = f"segment string, at int, doc_id long, n_words long, matches {MATCHES}"
    return in_batches(index.withColumn("segment", name), run, schema)


def covered_words(matches: Column) -> Column:
    """Number of words in the union of the stretches."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["first"].alias("first"), m["last"].alias("last"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(-1).alias("upto"))

    def add(have: Column, span: Column) -> Column:
        fresh = F.greatest(F.lit(0), span["last"] - F.greatest(span["first"] - 1, have["upto"]))
        return F.struct((have["n"] + fresh).alias("n"), F.greatest(have["upto"], span["last"]).alias("upto"))

    return F.aggregate(spans, start, add)["n"].cast("long")


def contamination(found: DataFrame, share: int = 20) -> DataFrame:
    """Per document the words hit, the ids found, how many (null as one) and the verdict: at least one word in ``share`` hit."""
    ids = F.array_distinct(F.transform("matches", lambda m: m["item"]))
    counted = found.select(
        "doc_id",
        "n_words",
        covered_words(F.col("matches")).alias("n_hit"),
        F.array_sort(F.array_compact(ids)).alias("items"),
        F.size(ids).cast("long").alias("n_items"),
    )
    return counted.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


_WORDS_SQL = r"""coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""

OP10_SQL = f"""
WITH said AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
asked AS (SELECT item_id, {_WORDS_SQL} AS w, least(13, len(w)) AS m FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, m, list_slice(w, i, i + m - 1) AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM asked WHERE m > 0)),
places AS (
  SELECT doc_id, m, i, list_slice(w, i, i + m - 1) AS phrase
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM said, (SELECT DISTINCT m FROM phrases) AS sizes WHERE len(w) >= m)),
hits AS (SELECT doc_id, item_id, i, p.m FROM places p JOIN phrases q ON p.m = q.m AND p.phrase = q.phrase),
words_hit AS (
  SELECT doc_id, count(DISTINCT at_word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + m)) AS at_word FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM said LEFT JOIN words_hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op10_benchmark_phrases", OP10_SQL)
def op10_benchmark_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, in windows of 13 words."""
    index = build_index(load(spark, sf_dir, "documents"))
    result = contamination(search_index(index, load(spark, sf_dir, "benchmark")))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return result.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")
