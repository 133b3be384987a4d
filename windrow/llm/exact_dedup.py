"""Exact dedup (operator 13) by Grace hash partitioning.

Rows are partitioned by a hash of their text until a bucket fits an open-addressing table, which
compares complete contents. On the way in, each task runs its rows through such a table, so the
copies of a text leave it as one record with a list of their ids; the records are spilled to
files in the shared folder. Buckets whose records fit are settled in one task each. The others
are taken further: their records are dealt to smaller buckets by more bits of the hash and, since
copies share every bit, in slices of a bucket; each slice merges its copies into one record that
points to those it stands for. So a text that a third of all rows hold shrinks before it meets
in one table. Verdicts go back along these pointers, joined by record; texts do not move again.

- null text: the empty text, a text like any other;
- null ``doc_id``: smaller than every id; ``keep_id`` is null where no copy has an id;
- rows equal in id and text: copies like others; exactly one row of a group is kept;
- very long texts: a record is never cut; one that exceeds the table's bound has it to itself;
- extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.common import in_batches, load
from windrow.llm.registry import query
from windrow.session import scratch_dir

#: Bytes of the records that one table takes in, what a record counts besides its text, and the
#: bits by which buckets that don't fit are split further.
TABLE_BYTES, RECORD_BYTES, MORE_BITS = 48 << 20, 160, 6

#: Records that a slice has at least, so that slices of copies shrink whatever a text's length.
SLICE_RECORDS = 16

# A to Z become a to z, all other bytes of UTF-8 stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: A record: its number, hash, bytes counted, rows, largest id with its place, and the text.
RECORD = "rec long, h long, size long, n long, top long, win_rec long, win_at int, text binary"
SETTLED = "rec long, keep_id long, win_rec long, win_at int, group_size long"


class ContentTable:
    """Open addressing with linear probing. Entries are equal if all their bytes are."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.texts: list[bytes] = []

    def place(self, h: int, text: bytes) -> int:
        """Number of the entry with this content; a new one where there is none."""
        mask = len(self.slots) - 1
        at = h & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.texts[entry] == text:
                return entry
            at = (at + 1) & mask
        entry = self.slots[at] = len(self.texts)
        self.hashes.append(h)
        self.texts.append(text)
        if 3 * len(self.texts) > 2 * len(self.slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        self.slots = [-1] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for entry, h in enumerate(self.hashes):
            at = h & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


class Groups:
    """A content table with rows, the row to keep, and members of every entry."""

    def __init__(self) -> None:
        self.table = ContentTable()
        self.rows: list[int] = []
        self.best: list[tuple[int | None, int, int]] = []
        self.members: list[list] = []
        self.held = 0

    def add(self, h: int, text: bytes, n: int, top: int | None, place: tuple[int, int], member) -> int:
        entry = self.table.place(h, text)
        if entry == len(self.rows):
            self.rows.append(0)
            self.best.append((top, *place))
            self.members.append([])
            self.held += len(text) + RECORD_BYTES
        self.rows[entry] += n
        self.held += 8
        self.members[entry].append(member)
        other, *first = self.best[entry]
        # The largest id; of equal ones the row that comes first.
        ahead = top is not None and (other is None or top > other)
        if ahead or (top == other and place < tuple(first)):
            self.best[entry] = (top, *place)
        return entry


def _number() -> int:
    """First record number of this task; records of one written table never share one."""
    return TaskContext.get().partitionId() << 40


def _records(groups: Groups, first: int, more: list[pa.Array], names: list[str]) -> Iterator[pa.RecordBatch]:
    """The entries as record batches of bounded size; ``more`` are further columns."""
    top, win_rec, win_at = zip(*groups.best)
    texts, hashes = groups.table.texts, groups.table.hashes
    sizes = [len(t) + RECORD_BYTES for t in texts]
    start, have = 0, 0
    for i, size in enumerate([*sizes, 0]):
        if i == len(sizes) or (i > start and have + size > 4 << 20):
            cut = slice(start, i)
            columns = [
                pa.array(range(first + start, first + i), pa.int64()),
                pa.array(hashes[cut], pa.int64()),
                pa.array(sizes[cut], pa.int64()),
                pa.array(groups.rows[cut], pa.int64()),
                pa.array(top[cut], pa.int64()),
                pa.array(win_rec[cut], pa.int64()),
                pa.array(win_at[cut], pa.int32()),
                pa.array(texts[cut], pa.binary()),
                *[column.slice(start, i - start) for column in more],
            ]
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in RECORD.split(", ")] + names)
            start, have = i, 0
        have += size


def _spill(rows: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder, packed tighter than Spark's default, and read back."""
    folder = scratch_dir(rows.sparkSession, label)
    rows.write.option("compression", "zstd").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def first_records(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows as records: within a task's table, copies of a text are one, with all their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = _number()
        groups, digests = Groups(), []

        def flush() -> Iterator[pa.RecordBatch]:
            ids = pa.array(groups.members, pa.list_(pa.int64()))
            yield from _records(groups, number, [ids, pa.array(digests, pa.binary())], ["ids", "sha"])

        for batch in batches:
            for key, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = (value.as_py() or b"").translate(_FOLD)
                sha = hashlib.sha256(body).digest()
                h = int.from_bytes(sha[:8], "big", signed=True)
                entry = groups.table.place(h, body)
                place = (number + entry, len(groups.members[entry]) if entry < len(groups.members) else 0)
                groups.add(h, body, 1, key, place, key)
                if entry == len(digests):
                    digests.append(sha)
                if groups.held > TABLE_BYTES:
                    yield from flush()
                    number += len(digests)
                    groups, digests = Groups(), []
        if digests:
            yield from flush()

    given = docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string").cast("binary"))
    return _spill(in_batches(given, run, f"{RECORD}, ids array<long>, sha binary"), "records")


def _lots(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, tuple]]:
    """Records sorted by their lot, the first column; whether a new lot begins, and the record."""
    last = None
    for batch in batches:
        numbers = [batch.column(i).to_pylist() for i in range(8)]
        for i, value in enumerate(batch.column(8)):
            lot, *rest = [column[i] for column in numbers]
            yield lot != last, (*rest, value.as_py())
            last = lot


def _by_lot(records: DataFrame, tasks: int, lot: Column) -> DataFrame:
    """Dealt out by lot, the records of each one after another."""
    given = records.select(lot.alias("lot"), *[f.split()[0] for f in RECORD.split(", ")])
    return given.repartition(tasks, "lot").sortWithinPartitions("lot")


def settle(records: DataFrame, tasks: int, bucket: Column) -> DataFrame:
    """The group of every record; equal texts are in one bucket, and each bucket fits a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, numbers, entries = Groups(), array("q"), array("q")

        def verdicts() -> Iterator[pa.RecordBatch]:
            for start in range(0, len(numbers), 1 << 16):
                some = entries[start : start + (1 << 16)]
                best = [groups.best[e] for e in some]
                columns = [numbers[start : start + (1 << 16)], *zip(*best), [groups.rows[e] for e in some]]
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in SETTLED.split(", ")])

        for new, (rec, h, _, n, top, win_rec, win_at, text) in _lots(batches):
            if new:
                yield from verdicts()
                groups, numbers, entries = Groups(), array("q"), array("q")
            numbers.append(rec)
            entries.append(groups.add(h, text, n, top, (win_rec, win_at), None))
        yield from verdicts()

    return in_batches(_by_lot(records, tasks, bucket), run, SETTLED)


def merge_slices(records: DataFrame, tasks: int, lot: Column) -> DataFrame:
    """Records of one slice with one text become one; ``children`` are those it stands for.

    A table that is full is emptied: what it held is merged again in the next round.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, groups = _number(), Groups()

        def flush() -> Iterator[pa.RecordBatch]:
            yield from _records(groups, number, [pa.array(groups.members, pa.list_(pa.int64()))], ["children"])

        for new, (rec, h, _, n, top, win_rec, win_at, text) in _lots(batches):
            # Inside a lot, a table is emptied only if it holds different texts.
            if groups.held > TABLE_BYTES and (new or len(groups.rows) > 1):
                yield from flush()
                number += len(groups.rows)
                groups = Groups()
            groups.add(h, text, n, top, (win_rec, win_at), rec)
        if groups.rows:
            yield from flush()

    return _spill(in_batches(_by_lot(records, tasks, lot), run, f"{RECORD}, children array<long>"), "merged")


def _bucket(bits: int) -> Column:
    return F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")


def _groups_of(records: DataFrame, more: int = 0) -> DataFrame:
    """``SETTLED`` for every record, by as many rounds of splitting as its bucket needs."""
    size = records.agg(F.sum("size")).first()[0] or 0
    # A quarter of the bound on average: only copies or very long texts make a bucket that does not fit.
    tasks = max(1, math.ceil(4 * size / TABLE_BYTES))
    bits = min(64, math.ceil(math.log2(tasks)) + more)
    keyed = records.withColumn("bucket", _bucket(bits))
    held = keyed.groupBy("bucket").agg(F.sum("size").alias("held"), F.count("*").alias("having"))
    big = held.where((F.col("held") > TABLE_BYTES) & (F.col("having") > 1))
    found, heavy = big.agg(F.count("*"), F.sum("held")).first()
    if bits == 64 or not found:
        return settle(records, tasks, _bucket(bits))
    big = _spill(big.withColumnRenamed("bucket", "of"), "big")
    fits = keyed.join(big, F.col("bucket") == F.col("of"), "left_anti").select(records.columns)
    slices = F.least(F.ceil(F.col("held") / TABLE_BYTES), F.ceil(F.col("having") / SLICE_RECORDS))
    lot = F.xxhash64(_bucket(min(64, bits + MORE_BITS)), F.pmod(F.xxhash64("rec"), slices))
    wide = keyed.join(big, F.col("bucket") == F.col("of")).select(*records.columns, lot.alias("dealt"))
    merged = merge_slices(wide, max(1, math.ceil(heavy / TABLE_BYTES)), F.col("dealt"))
    above = _groups_of(merged.select(records.columns), more + MORE_BITS)
    child = merged.select(F.col("rec").alias("parent"), F.explode("children").alias("child"))
    verdicts = child.join(above.withColumnRenamed("rec", "parent"), "parent").select(
        F.col("child").alias("rec"), "keep_id", "win_rec", "win_at", "group_size"
    )
    return settle(fits, tasks, _bucket(bits)).unionByName(verdicts)


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal if they are so after lower-casing A to Z. Of equal texts the row with the
    largest id is kept. Ids are integers.
    """
    first = first_records(docs, doc_id, text)
    settled = _groups_of(first.drop("ids", "sha"))
    members = first.select("rec", "ids", F.lower(F.hex("sha")).alias("text_sha256"))
    return (
        members.join(settled, "rec")
        .select("rec", "text_sha256", "keep_id", "group_size", "win_rec", "win_at", F.posexplode("ids").alias("at", "id"))
        .select(
            F.col("id").alias(doc_id),
            "keep_id",
            "group_size",
            ((F.col("rec") == F.col("win_rec")) & (F.col("at") == F.col("win_at"))).alias("kept"),
            "text_sha256",
        )
    )


def kept_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns. Ids are unique and not null."""
    verdicts = exact_dedup(docs, doc_id, text).where("kept").select(F.col(doc_id).alias("_kept"))
    return docs.join(verdicts, docs[doc_id] == F.col("_kept"), "left_semi")


OP13_SQL = """
WITH normal AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY t)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM normal JOIN groups USING (t)
"""


@query("op13_grace_exact_dedup", OP13_SQL)
def op13_grace_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies among all documents, whole texts compared."""
    return exact_dedup(load(spark, sf_dir, "documents"))
