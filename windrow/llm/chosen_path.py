"""N-gram Jaccard join (operator 6) by chosen paths.

A document is the set of its five-word shingles. Equal sets are one node from the start. A
node's signature holds ``COORDINATES`` minhashes; two nodes agree on about as many of them as
their similarity says. A run walks every node down a random tree: at each step a few coordinates
are sampled by a hash of the path so far, and the node goes on to one child for each, named by
its minhash there; so nodes meet again exactly where they share the sampled tokens. Buckets of
one node are dropped, small ones compared by brute force, large ones split further. Runs are
repeated until pairs of the least similarity meet with the target probability.

Within a bucket, signatures tell which members may have a partner; only these get their
shingles, and every pair that passes is decided on the sets themselves. A pair that meets in
several buckets counts in the first of them. Pairs are never listed: a bucket gives, for each
member, how many documents it is linked to, and a link to the member that joins it to the rest.
A bucket too large for one task after the last split holds texts that agree almost everywhere;
it is compared in blocks, each pair of blocks a task of its own.

- null or empty text, or no word: linked to nothing, a class of its own;
- fewer words than a shingle: one shingle of all words;
- repeated rows and copies: one class; each row has its own result;
- null id: takes part; its class is the smallest id that is not null; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.common import in_batches, kept, load, written
from windrow.llm.positional_index import words_of
from windrow.llm.registry import query

#: Words of a shingle, least similarity, probability that a pair of that similarity is found.
WORDS, LEAST, RECALL = 5, 0.8, 0.995

#: Minhashes of a signature; levels of every run; nodes compared in one task; extra levels.
COORDINATES, LEVELS, SMALL, SPLITS = 128, 2, 2048, 2

#: Children of a node at an extra split, times what a pair of the least similarity needs.
WIDER = 2.0

_MIX = np.uint64(0x9E3779B97F4A7C15)
_HASHED_WORDS = 100_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def first_coordinates(runs: int) -> list[list[int]]:
    """The coordinates each run begins with, taken in turn from a shuffled list: two in every fourth
    run and one in the others, ``1 / LEAST`` on average."""
    order = np.argsort(mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64)), kind="stable").tolist()
    chosen, at = [], 0
    for run in range(runs):
        size = 2 if run % 4 == 0 else 1
        chosen.append([order[(at + k) % COORDINATES] for k in range(size)])
        at += size
    return chosen


def runs_needed(recall: float = RECALL) -> int:
    """Runs until a pair of the least similarity has met with this probability.

    All runs share one signature, on which such a pair agrees in a binomial number of coordinates:
    the probability to miss is averaged over that number. After the first coordinates, a pair that
    agrees as expected shares one sampled token on average at each level, which is the branching
    process whose chance to live on is 1 - exp(-chance one level further down).
    """
    agreed = np.arange(COORDINATES + 1)
    ways = np.array([float(math.comb(COORDINATES, k)) for k in agreed.tolist()])
    likely = ways * LEAST**agreed * (1 - LEAST) ** (COORDINATES - agreed)
    agreement = agreed / COORDINATES
    chance = np.ones(COORDINATES + 1)
    for level in range(LEVELS - 1 + SPLITS, 0, -1):
        chance = 1 - np.exp(-(WIDER if level >= LEVELS else 1.0) * agreement / LEAST * chance)
    missed, runs = np.ones(COORDINATES + 1), 0
    while likely @ missed > 1 - recall:
        missed *= (1 - agreement * chance) ** (2 if runs % 4 == 0 else 1)
        runs += 1
    return runs


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Hashes of the text's distinct shingles, sorted."""
    said = words_of(text)
    if not said:
        return np.zeros(0, np.uint64)
    known: dict[bytes, int] = kept(("word hashes",), dict)
    if len(known) > _HASHED_WORDS:
        known.clear()
    for word in set(said).difference(known):
        known[word] = xxhash.xxh64_intdigest(word)
    codes = np.fromiter(map(known.__getitem__, said), np.uint64, len(said))
    m = max(1, len(codes) - words + 1)
    code = np.zeros(m, np.uint64)
    for k in range(min(words, len(codes))):
        code = (code + codes[k : k + m]) * _MIX
        code ^= code >> np.uint64(29)
    return np.unique(mixed(code))


def signature(tokens: np.ndarray) -> np.ndarray:
    """The smallest hash of the set under each of the hash functions."""
    seeds = kept(("seeds", COORDINATES), lambda: mixed(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * _MIX))
    factors, terms = seeds[:COORDINATES] | np.uint64(1), seeds[COORDINATES:]
    least = np.full(COORDINATES, np.iinfo(np.uint32).max, np.uint32)
    for first in range(0, len(tokens), 2048):
        part = tokens[first : first + 2048, None] * factors + terms
        least = np.minimum(least, (part >> np.uint64(32)).astype(np.uint32).min(axis=0))
    return least


def set_number(tokens: np.ndarray) -> int:
    """A signed 64-bit hash that names the set."""
    return int(np.int64(np.uint64(xxhash.xxh64_intdigest(tokens.tobytes()))))


def sets_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per row the id, the number of its set, the set's signature, and two hashes that know the text; nulls without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, signatures = [], []
            for value in batch.column(1):
                tokens = shingles(value.as_py())
                numbers.append(set_number(tokens) if len(tokens) else None)
                signatures.append(signature(tokens).tobytes() if len(tokens) else None)
            columns = [batch.column(0), pa.array(numbers, pa.int64()), pa.array(signatures, pa.binary()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "node", "signature", "h1", "h2"])

    kind = dict(docs.dtypes)[doc_id]
    given = docs.select(doc_id, text, *text_hashes(F.col(text)))
    return in_batches(given, run, f"doc {kind}, node long, signature binary, h1 long, h2 long")


def text_hashes(text: Column) -> list[Column]:
    """Two 64-bit hashes of a text, ``h1`` and ``h2``."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def sampled(paths: np.ndarray, width: float) -> np.ndarray:
    """For each path, which coordinates are chosen next: ``width / LEAST`` of them on average."""
    coordinate = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * _MIX)
    limit = np.uint64(min(1.0, width / LEAST / COORDINATES) * float(2**64 - 2048))
    return mixed(paths[:, None] + coordinate) < limit


def children(paths: np.ndarray, signatures: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the given arrays that go on, and the paths of their children."""
    row, coordinate = np.nonzero(sampled(paths, width))
    return row, _named(paths[row], coordinate, signatures[row, coordinate])


def _named(paths: np.ndarray, coordinate: np.ndarray | int, values: np.ndarray) -> np.ndarray:
    """Paths of the children reached by a coordinate and the minhash there."""
    token = values.astype(np.uint64) + (np.asarray(coordinate).astype(np.uint64) << np.uint64(32))
    return mixed(paths * _MIX + mixed(token + _MIX))


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def walks(nodes: DataFrame, runs: int) -> DataFrame:
    """``path, node`` for every bucket that a node reaches in any run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, signatures = np.asarray(batch.column(0)), _signatures(batch.column(1))
            starts = mixed(np.arange(1, runs + 1, dtype=np.uint64))
            for start, coordinates in zip(starts, first_coordinates(runs)):
                rows = np.tile(np.arange(len(number)), len(coordinates))
                begun = np.full(len(number), start)
                paths = np.concatenate([_named(begun, c, signatures[:, c]) for c in coordinates])
                for _ in range(LEVELS - 1):
                    row, paths = children(paths, signatures[rows], 1.0)
                    rows = rows[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(paths.view(np.int64)), pa.array(number[rows])], ["path", "node"]
                )

    return in_batches(nodes.select("node", "signature"), run, "path long, node long")


def split_further(rows: DataFrame) -> DataFrame:
    """The children of ``path, node, signature`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = np.asarray(batch.column(0)).view(np.uint64)
            row, further = children(paths, _signatures(batch.column(2)), WIDER)
            number = np.asarray(batch.column(1))[row]
            yield pa.RecordBatch.from_arrays([pa.array(further.view(np.int64)), pa.array(number)], ["path", "node"])

    return in_batches(rows.select("path", "node", "signature"), run, "path long, node long")


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of buckets with company, and their number of nodes."""
    # Grouped by a struct, the sizes are dealt anew for the join: a full bucket can be split.
    sizes = rows.groupBy(F.struct("path").alias("key")).agg(F.count("*").alias("size")).where("size > 1")
    return rows.join(sizes.select("key.path", "size"), "path")


def buckets(nodes: DataFrame, runs: int) -> DataFrame:
    """``path, node, size`` of all buckets to compare; those over ``SMALL`` can't be split."""
    done, rows = None, walks(nodes, runs)
    for split in range(SPLITS + 1):
        sized = written(_sized(rows), f"paths{split}")
        large = sized.where(F.col("size") > SMALL)
        if split == SPLITS or large.isEmpty():
            return sized if done is None else done.unionByName(sized)
        small = sized.where(F.col("size") <= SMALL)
        done = small if done is None else done.unionByName(small)
        rows = split_further(large.join(nodes, "node"))
        # Two children of one path may carry a node to one bucket only once.
        rows = rows.distinct()
    raise AssertionError("unreachable")


def with_blocks(rows: DataFrame) -> DataFrame:
    """Rows with ``block``, the pair of blocks to compare, and ``side``, the row's own block.

    A bucket of up to ``SMALL`` nodes is one block.
    """
    blocks = F.ceil(F.col("size") / SMALL).cast("int")
    side = F.pmod(F.xxhash64("node", "path"), blocks).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (
        rows.withColumn("blocks", blocks)
        .withColumn("side", side)
        .withColumn("other", others)
        .withColumn("block", F.struct(F.least("side", "other").alias("a"), F.greatest("side", "other").alias("b")))
        .drop("blocks", "other", "size")
    )


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows of sorted batches, those with equal first columns together."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if held and held[-1][:keys] != row[:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _dealt(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows of a pair of blocks in one partition and in a row."""
    flat = rows.select("path", F.col("block.a").alias("a"), F.col("block.b").alias("b"), "side", "node", *columns)
    return flat.repartition("path", "a", "b").sortWithinPartitions("path", "a", "b")


def _pairs_allowed(a: int, b: int, sides: np.ndarray) -> np.ndarray:
    """Within one block all pairs; between two, only those across."""
    n = len(sides)
    allowed = np.ones((n, n), bool) if a == b else sides[:, None] != sides[None, :]
    np.fill_diagonal(allowed, False)
    return allowed


def alike(signatures: np.ndarray) -> np.ndarray:
    """Pairs whose signatures agree as those of linked sets do, but for one in a hundred thousand."""
    spread = math.sqrt(LEAST * (1 - LEAST) / COORDINATES)
    least = math.floor(COORDINATES * (LEAST - 4.3 * spread))
    close = np.empty((len(signatures), len(signatures)), bool)
    for i, row in enumerate(signatures):
        close[i] = (signatures == row).sum(axis=1) >= least
    return close


def with_partners(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``path, node`` of the rows that have a likely partner in their bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, 3):
            if len(group) < 2:
                continue
            path, a, b = group[0][:3]
            sides = np.array([r[3] for r in group])
            close = alike(np.frombuffer(b"".join(r[5] for r in group), np.uint32).reshape(-1, COORDINATES))
            found = np.flatnonzero((close & _pairs_allowed(a, b, sides)).any(axis=1)).tolist()
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(found)), pa.array([group[i][4] for i in found])], ["path", "node"]
                )

    dealt = _dealt(with_blocks(rows).join(nodes, "node"), "signature")
    return in_batches(dealt, run, "path long, node long").distinct()


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    kinds, number, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    # What one set alone holds is in no intersection.
    column = np.cumsum(seen > 1) - 1
    kept_ones = seen[number] > 1
    owner, column = owner[kept_ones], column[number[kept_ones]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total, width = np.zeros((len(sets), len(sets)), np.int32), max(1, (2 << 20) // len(sets))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [first, first + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        total += (part @ part.T).astype(np.int32)
    return total


def first_meetings(group: list[tuple]) -> np.ndarray:
    """Pairs of a pair of blocks that are in no earlier bucket together.

    Rows begin with path, a, b, side, node, paths. Most pairs of a close group have met before.
    """
    path, a, b = group[0][:3]
    first_here = _pairs_allowed(a, b, np.array([r[3] for r in group]))
    earlier = {p: i for i, p in enumerate(sorted({p for r in group for p in r[5] if p < path}))}
    if earlier:
        met = np.zeros((len(group), len(earlier)), np.float32)
        for i, r in enumerate(group):
            met[i, [earlier[p] for p in r[5] if p < path]] = 1
        first_here &= ~(met @ met.T > 0)
    return first_here


def with_first_meetings(rows: DataFrame) -> DataFrame:
    """The rows of ``path, block, side, node, paths`` that meet some node first in that bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        for group in _groups(batches, 3):
            if len(group) > 1:
                found = np.flatnonzero(first_meetings(group).any(axis=1)).tolist()
                if found:
                    columns = zip(*(group[i] for i in found))
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    names = ["path", "a", "b", "side", "node", "paths"]
    schema = "path long, a int, b int, side int, node long, paths array<long>"
    met = in_batches(_dealt(rows, "paths"), run, schema)
    return met.withColumn("block", F.struct("a", "b")).drop("a", "b")


def bucket_links(group: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Of one pair of blocks: documents linked to each member, and links that join the members.

    Rows are path, a, b, side, node, paths, copies, set.
    """
    first_here = first_meetings(group)
    copies = np.array([r[6] for r in group], np.int64)
    sets = [np.frombuffer(r[7], np.uint64) for r in group]
    sizes = np.array([len(s) for s in sets], np.int64)
    linked = shared_counts(sets)
    # Jaccard of 4/5 or more, in whole numbers: 5 * both >= 4 * (the rest of the union and both).
    for i, both in enumerate(linked):
        first_here[i] &= 5 * both >= 4 * (sizes[i] + sizes - both)
    linked = first_here
    counts = np.array([copies[row].sum() for row in linked])
    degrees = [(group[i][4], int(counts[i])) for i in np.flatnonzero(counts).tolist()]
    # A spanning forest: members reached from the smallest node not yet reached.
    joins, nodes = [], np.array([r[4] for r in group])
    left = np.ones(len(group), bool)
    for i in np.argsort(nodes, kind="stable").tolist():
        if not left[i]:
            continue
        left[i] = False
        front = np.array([i])
        while len(front):
            near = np.flatnonzero(linked[front].any(axis=0) & left)
            left[near] = False
            joins.extend((int(nodes[j]), int(nodes[i])) for j in near.tolist())
            front = near
    return degrees, joins


def links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, other, n``: counts of linked documents (``other`` null) and joining links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for group in _groups(batches, 3):
            if len(group) > 1:
                degrees, joins = bucket_links(group)
                counts.update(dict(degrees))
                if joins:
                    yield batch_of([n for n, _ in joins], [o for _, o in joins], [0] * len(joins))
        yield batch_of(list(counts), [None] * len(counts), list(counts.values()))

    def batch_of(*columns: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "other", "n"])

    paths = rows.groupBy(F.struct("node").alias("key")).agg(F.array_sort(F.collect_list("path")).alias("paths"))
    sizes = rows.groupBy(F.struct("path").alias("key")).agg(F.count("*").alias("size"))
    sized = rows.join(sizes.select("key.path", "size"), "path")
    met = with_first_meetings(with_blocks(sized).join(paths.select("key.node", "paths"), "node"))
    return in_batches(_dealt(met.join(sets, "node"), "paths", "copies", "tokens"), run, "node long, other long, n long")


def node_sets(docs: DataFrame, members: DataFrame, wanted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``node, copies, tokens`` of the wanted nodes, from the text of one of their documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for node, copies, value in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = shingles(value)
                if len(tokens) and set_number(tokens) == node:
                    rows.append((node, copies, tokens.tobytes()))
            columns = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "copies", "tokens"])

    # One row of each node, known by its id and its text: rows without an id, or with one id, meet
    # the nodes of their own text only.
    row = F.struct("doc", "h1", "h2")
    chosen = members.join(wanted, "node", "left_semi").groupBy("node").agg(F.min(row).alias("row"), F.count("*").alias("copies"))
    of = chosen.select(F.col("row.doc").alias("of"), F.col("row.h1").alias("of1"), F.col("row.h2").alias("of2"), "node", "copies")
    texts = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("body"), *text_hashes(F.col(text)))
    same = F.col("doc").eqNullSafe(F.col("of")) & (F.col("h1") == F.col("of1")) & (F.col("h2") == F.col("of2"))
    carried = texts.join(of, same)
    return in_batches(carried.select("node", "copies", "body"), run, "node long, copies long, tokens binary").dropDuplicates(["node"])


def components(joins: DataFrame) -> DataFrame:
    """``node, root`` for every node with a link: the smallest node it is connected to.

    Every node points to its smallest neighbour, pointers are followed to their ends, and links
    are drawn between the ends until none is left.
    """
    edges = joins.select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other"))
    edges = written(edges.where("node <> other").distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        ends = written(edges.groupBy("node").agg(F.min("other").alias("root")), "pointers")
        while True:
            further = ends.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
            followed = ends.join(further, "root", "left").select("node", F.coalesce("beyond", "root").alias("root"), "beyond")
            followed = written(followed, "followed")
            moved = not followed.where(F.col("beyond").isNotNull()).isEmpty()
            ends = followed.drop("beyond")
            if not moved:
                break
        if roots is None:
            roots = ends
        else:
            step = ends.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
            older = roots.join(step, "root", "left").select("node", F.coalesce("beyond", "root").alias("root"))
            known = older.select(F.col("node").alias("known"))
            new = ends.join(known, F.col("node") == F.col("known"), "left_anti")
            roots = written(older.unionByName(new), "roots")
        a = ends.select("node", F.col("root").alias("a"))
        b = ends.select(F.col("node").alias("other"), F.col("root").alias("b"))
        drawn = edges.join(a, "node", "left").join(b, "other", "left").select(
            F.coalesce("a", "node").alias("a"), F.coalesce("b", "other").alias("b")
        )
        drawn = drawn.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
        edges = written(drawn.distinct(), "edges")
    return joins.sparkSession.createDataFrame([], "node long, root long") if roots is None else roots


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", recall: float = RECALL) -> DataFrame:
    """Every row's class and its number of links.

    Returns ``doc_id``, ``class_id`` (the smallest id that links lead to) and ``n_links`` (other
    rows whose sets are as similar as asked, copies included).
    """
    rows = written(sets_of(docs, doc_id, text), "sets")
    members = rows.select("doc", "node", "h1", "h2")
    nodes = rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.first("signature").alias("signature"))
    nodes = written(nodes, "nodes")
    partners = written(with_partners(buckets(nodes, runs_needed(recall)), nodes), "partners")
    sets = node_sets(docs, members, partners.select("node").distinct(), doc_id, text)
    found = written(links(partners, sets), "links")
    roots = components(found.where(F.col("other").isNotNull()))
    degrees = found.where(F.col("other").isNull()).groupBy("node").agg(F.sum("n").alias("linked"))
    copies = members.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc").alias("least"), F.count("*").alias("copies"))
    placed = copies.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = written(placed.join(degrees, "node", "left"), "classes")
    least = classes.groupBy(F.struct("root").alias("key")).agg(F.min("least").alias("class_id"))
    whole = classes.join(least.select("key.root", "class_id"), "root").select(
        F.col("node").alias("of"), "class_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    joined = members.select("doc", "node").join(whole, F.col("node") == F.col("of"), "left")
    own = F.when(F.col("node").isNull(), F.col("doc")).otherwise(F.col("class_id"))
    links_of = F.coalesce("n_links", F.lit(0)).cast("long")
    return joined.select(F.col("doc").alias(doc_id), own.alias("class_id"), links_of.alias("n_links"))


OP6_SQL = r"""
WITH RECURSIVE said AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM said WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared s JOIN sizes p ON s.a = p.doc_id JOIN sizes q ON s.b = q.doc_id
  WHERE 5 * s.n >= 4 * (p.n + q.n - s.n)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT r.a AS doc_id, min(r.b) AS class_id, coalesce(any_value(d.n), 0)::BIGINT AS n_links
FROM reached r LEFT JOIN degrees d ON r.a = d.a GROUP BY r.a
"""


@query("op6_chosen_path_join", OP6_SQL)
def op6_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents: class and number of links of each."""
    return jaccard_join(load(spark, sf_dir, "documents"))
