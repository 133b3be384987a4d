"""Ranked search against plain scoring of every document."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import hostile_rows, prose

from windrow.llm import ranked_search
from windrow.llm.queries import QUERIES
from windrow.llm.ranked_search import build_index, search_index

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def plainly(rows, items, k=10):
    """Per item (rank, id, score)."""
    counts = [(key, Counter(terms(text))) for key, text in rows]
    n = sum(1 for _, c in counts if c)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item].update(terms(text))
    result = {}
    for item, some in asked.items():
        scored = []
        for key, c in counts:
            size, score = sum(c.values()), 0
            for t in some & c.keys():
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + (90 * size * n) // total
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0))
        best = sorted(scored)[:k]
        result[item] = [(i, None if null else key, -s) for i, (s, null, key) in enumerate(best, 1)]
    return {item: rows for item, rows in result.items() if rows}


def got(frame):
    result = defaultdict(list)
    for r in frame.orderBy("rank").collect():
        result[r.item_id].append((r["rank"], r.doc_id, r.score))
    return dict(result)


def corpus(seed, docs):
    """Frequent and rare words, a third of all documents equal, short and long ones."""
    pick = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    rows = []
    for i in range(docs):
        text = "W0 w1 common copy w5" if i % 3 == 0 else " ".join(pick.choices(words, weights, k=pick.randint(1, 90)))
        rows.append((pick.randint(0, 10 * docs), text))
    items = [(j, " ".join(pick.choices(words, k=pick.randint(1, 25)))) for j in range(25)]
    items += [(100, "w0 w1 w2"), (101, "nowhere at all"), (102, None), (103, "W5, w5; w5"), (7, "common"), (None, "w3 w9"), (None, "w17")]
    return rows, items


def frames(spark, rows, items, partitions=3):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    return docs, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize(("words", "block", "run", "sent"), [(4_000_000, 128, 1024, 4 << 20), (900, 4, 16, 400)])
def test_shards_blocks_and_runs_of_any_size(spark, monkeypatch, words, block, run, sent):
    for name, value in zip(("SHARD_WORDS", "BLOCK", "RUN_DOCS", "SENT_BYTES"), (words, block, run, sent)):
        monkeypatch.setattr(ranked_search, name, value)
    rows, items = corpus(2, 700)
    docs, asked = frames(spark, rows, items)
    index = build_index(docs)
    assert got(search_index(index, asked)) == plainly(rows, items)
    assert got(search_index(index, asked, k=3)) == plainly(rows, items, 3)


def test_hostile_rows_and_nothing(spark, hostile, nothing):
    items = [(1, "the quick fox"), (2, "東京 one 123"), (3, ""), (4, "x" * 200_000), (5, prose(1, 40))]
    asked = spark.createDataFrame([(*i, "z") for i in items], "item_id long, text string, score string")
    assert got(search_index(build_index(hostile), asked)) == plainly([r[:2] for r in hostile_rows()], items)
    assert search_index(build_index(nothing), asked).count() == 0
    empty = search_index(build_index(hostile), asked.limit(0))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_block_bounds_are_met_and_blocks_rejected_unread(spark, monkeypatch):
    """Every block's bound is the score of one of its postings; most blocks of frequent terms stay packed."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(5, 60, 4000).tolist()
    common = [np.concatenate([[0], rng.integers(1, 300, s - 1)]).astype(np.int32) for s in sizes]
    for i in (10, 500, 900, 1500, 2100, 2900, 3000, 3100, 3500, 3999, 700):
        common[i][1:3] = 300  # a rare word
    words = [f"w{i}".encode() for i in range(301)]
    monkeypatch.setattr(ranked_search, "RUN_DOCS", 64)
    row = ranked_search._shard(list(range(4000)), sizes, words, common)
    import pyarrow as pa

    batch = pa.RecordBatch.from_pylist([row], ranked_search._INDEX)
    shard = ranked_search.Shard({n: batch.column(n)[0] for n in batch.schema.names}, 4000, sum(sizes))
    lists = shard.lists(pa.array(words, pa.binary()), [1] * 1 + [3] * 299 + [5000])
    for some in list(lists.values())[:20]:
        assert [int(some.block(i)[1].max()) for i in range(len(some.lasts))] == some.bounds.tolist()
        some.unpacked.clear()
    best = ranked_search.search_shard(shard, [lists[0], lists[300]], [], 3)
    assert len(best) == 3 and all(-s > 5000 for s, _, _ in best)
    assert len(lists[0].unpacked) < len(lists[0].lasts) / 2


def test_query_over_all_documents(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(QUERIES["op11_block_max_search"](spark, small)) == plainly(rows, items)
