"""Phrase search and the Jaccard join against brute force."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest_llm import WORDS, hostile_rows, prose

from windrow.llm import chosen_path, positional_index
from windrow.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(text, items, window=13):
    said, covered, found = words(text), set(), set()
    for item, body in items:
        asked = words(body)
        size = min(window, len(asked))
        phrases = {tuple(asked[i : i + size]) for i in range(len(asked) - size + 1)} if asked else set()
        for i in range(len(said) - size + 1):
            if tuple(said[i : i + size]) in phrases:
                covered.update(range(i, i + size))
                found.add(str(item))
    return len(said), len(covered), sorted(found)


def digest(items):
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def test_phrases_of_all_documents(spark, small):
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = QUERIES["op10_benchmark_phrases"](spark, small).collect()
    assert len(got) == len(docs)
    for r in got:
        n, hit, found = brute_hits(docs[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256) == (n, hit, len(found), digest(found))
        assert r.contaminated == (hit > 0 and 20 * hit >= n)


ITEMS = [
    (1, "the quick brown fox"), (2, "the the the"), (3, None), (4, "..."), (5, "over a lazy dog while seven wizards box many quiet jackals under bright morning skies the end"),
    (6, "東京 🙂"), (7, "The QUICK, brown--fox"), (7, "lazy dog"), (None, "lazy dog"), (8, "one"),
]


@pytest.mark.parametrize("block_bytes", [8 << 20, 40])
def test_phrases_in_hostile_rows_and_blocks_of_items(spark, hostile, monkeypatch, block_bytes):
    monkeypatch.setattr(positional_index, "BLOCK_BYTES", block_bytes)
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, words string")
    index = positional_index.build_index(hostile)
    found = positional_index.contamination(positional_index.search_index(index, items)).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.n_hit, list(r["items"])) for r in found)
    asked = [i for i in ITEMS if i[0] is not None]
    want = sorted((r[0] or -1, *brute_hits(r[1], asked)) for r in hostile_rows())
    assert got == want


def test_items_without_an_id_are_searched(spark):
    asked = [(None, "quiet jackals"), (None, "lazy dog"), (3, "seven wizards")]
    items = spark.createDataFrame(asked, "item_id long, text string")
    rows = [(1, "quiet jackals and a lazy dog"), (2, "seven wizards box quiet jackals"), (3, "seven wizards"), (4, "none of them")]
    index = positional_index.build_index(spark.createDataFrame(rows, "doc_id long, text string"))
    found = positional_index.contamination(positional_index.search_index(index, items)).collect()
    got = {r.doc_id: (r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in found}
    assert got == {1: (4, 1, [], True), 2: (4, 2, ["3"], True), 3: (2, 1, ["3"], True), 4: (0, 0, [], False)}


def test_phrases_never_cross_documents_or_segments(spark, monkeypatch):
    monkeypatch.setattr(positional_index, "SEGMENT_WORDS", 50)
    rows = [(i, prose(i, 17)) for i in range(40)] + [(100, "the quick"), (101, "brown fox")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    index = positional_index.build_index(docs)
    assert index.count() > 10
    items = [(i, " ".join(words(prose(i, 17))[3:9])) for i in range(10)] + [(50, "the quick brown fox")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    for r in positional_index.contamination(positional_index.search_index(index, frame)).collect():
        n, hit, found = brute_hits(dict(rows)[r.doc_id], items)
        assert (r.n_words, r.n_hit, r["items"]) == (n, hit, found)


def test_proximity(spark):
    rows = [(i, prose(i, 60)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    items = [(1, "fox wizards"), (2, "lazy dog jackals"), (3, "the the")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = positional_index.search_index(positional_index.build_index(docs), frame, window=None, span=6)
    got = {(r.doc_id, m["item"]) for r in found.collect() for m in r.matches}
    want = set()
    for doc, text in rows:
        said = words(text)
        for item, body in items:
            if any(set(words(body)) <= set(said[i : i + 6]) for i in range(len(said))):
                want.add((doc, str(item)))
    assert got == want and want


def test_row_groups_of_the_index_are_bounded(spark, monkeypatch):
    """Spark decodes up to a whole row group at once for each task that reads."""
    monkeypatch.setattr(positional_index, "SEGMENT_WORDS", 500)
    monkeypatch.setattr(positional_index, "ROW_GROUP_BYTES", 10_000, raising=False)
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(200))) for i in range(60)]
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    index = positional_index.build_index(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert spark.conf.get(key) == before
    groups = []
    for file in index.inputFiles():
        meta = pq.ParquetFile(unquote(urlparse(file).path)).metadata
        groups += [meta.row_group(g) for g in range(meta.num_row_groups)]
    assert sum(g.num_rows for g in groups) == index.count() == 30
    assert max(g.total_byte_size for g in groups) < 30_000
    items = spark.createDataFrame([(1, "w3x5 w3x6"), (2, "w59x198 w59x199 w60x0")], "item_id long, text string")
    found = positional_index.contamination(positional_index.search_index(index, items)).where("n_hit > 0").collect()
    assert [(r.doc_id, r.n_hit, list(r["items"])) for r in found] == [(3, 2, ["1"])]


def test_a_segment_holds_no_end_of_texts_without_words(spark, monkeypatch):
    monkeypatch.setattr(positional_index, "SEGMENT_WORDS", 50)
    rows = [(i if i % 3 else None, [None, "", "..."][i % 3]) for i in range(400)] + [(400, "quiet jackals")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    index = positional_index.build_index(docs)
    assert max(len(r.docs) for r in index.collect()) <= 50
    items = spark.createDataFrame([(1, "quiet jackals")], "item_id long, text string")
    found = positional_index.contamination(positional_index.search_index(index, items)).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.n_hit) for r in found)
    assert got == sorted((k or -1, 2 * (k == 400), 2 * (k == 400)) for k, _ in rows)


@pytest.mark.parametrize("window", [1, 2, 3, 13, None])
def test_phrases_are_kept_as_places(window):
    items = [(str(i), prose(i % 7, 5 + i)) for i in range(40)] + [("none", None), ("none", "..."), ("one", "fox")]
    tests = positional_index.Tests(items, window)
    said = [word.decode() for word in tests.words.to_pylist()]
    got = {}
    for size, places, holders, begins in tests.sizes:
        for i, place in enumerate(places.tolist()):
            phrase = tuple(said[n] for n in tests.ids[place : place + size].tolist())
            assert phrase not in got
            got[phrase] = holders[begins[i] : begins[i + 1]].tolist()
    want = defaultdict(list)
    for i, (_, text) in enumerate(items):
        asked = words(text)
        size = min(window or len(asked), len(asked))
        for phrase in {tuple(asked[j : j + size]) for j in range(len(asked) - size + 1)} if asked else ():
            want[phrase].append(i)
    assert got == want


def test_phrases_take_bounded_memory():
    """A block of tests is held by every worker: some tens of bytes per word, not the words of every window."""
    rng = random.Random(0)
    items = [(str(i), " ".join(f"w{rng.randrange(5000)}" for _ in range(400))) for i in range(150)]
    tracemalloc.start()
    tests = positional_index.Tests(items, 13)
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert tests.sizes and kept < 60 * 60_000 and peak < 200 * 60_000


def test_index_of_nothing(spark, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert positional_index.search_index(positional_index.build_index(nothing), items).count() == 0
    docs = spark.createDataFrame([(1, "the quick brown fox")], "doc_id long, text string")
    none = positional_index.search_index(positional_index.build_index(docs), items.limit(0)).collect()
    assert [(r.doc_id, r.n_words, r.matches) for r in none] == [(1, 4, [])]


def brute_join(rows):
    """Class and number of links of every row, all pairs compared."""
    sets, holders = {}, defaultdict(list)
    for i, (_, text) in enumerate(rows):
        said = words(text)
        if said:
            holders[frozenset(tuple(said[j : j + 5]) for j in range(max(1, len(said) - 4)))].append(i)
    kinds = list(holders)
    places = defaultdict(list)
    for k, kind in enumerate(kinds):
        for shingle in kind:
            places[shingle].append(k)
    parent, linked = list(range(len(kinds))), Counter()

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k, kind in enumerate(kinds):
        for other, both in Counter(o for s in kind for o in places[s] if o < k).items():
            if 5 * both >= 4 * (len(kind) + len(kinds[other]) - both):
                linked[k] += len(holders[kinds[other]])
                linked[other] += len(holders[kind])
                parent[root(k)] = root(other)
    least = defaultdict(list)
    for k, kind in enumerate(kinds):
        least[root(k)] += [rows[i][0] for i in holders[kind] if rows[i][0] is not None]
    result = [(doc, doc, 0) for doc, _ in rows]
    for k, kind in enumerate(kinds):
        for i in holders[kind]:
            result[i] = (rows[i][0], min(least[root(k)], default=None), linked[k] + len(holders[kind]) - 1)
    return sorted(result, key=str)


def near_rows(seed=3, groups=12, hot=150):
    """Texts, their copies and near copies of all degrees; one group holds a third of them."""
    pick, rows = random.Random(seed), []
    for g in range(groups):
        base = prose(1000 + g, 120).split(" ")
        for copy in range(hot if g == 0 else pick.randrange(1, 14)):
            edited = list(base)
            for _ in range(pick.choice([0, 0, 1, 1, 2, 3])):
                edited[pick.randrange(len(edited))] = pick.choice(WORDS) + str(pick.randrange(1000))
            rows.append(" ".join(edited))
    rows += [prose(5000 + i, 30) for i in range(200)] + ["word", "word", "two words", "", None]
    pick.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("small", [256, 20])
def test_join_against_all_pairs(spark, monkeypatch, small):
    """Also with buckets so small that groups are split and compared in blocks."""
    monkeypatch.setattr(chosen_path, "SMALL", small)
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((tuple(r) for r in chosen_path.jaccard_join(docs).collect()), key=str)
    want = brute_join(rows)
    links, found = sum(w[2] for w in want), sum(g[2] for g in got)
    assert found <= links and found >= 0.99 * links  # the method's recall
    assert sum(g[1] != w[1] for g, w in zip(got, want)) <= 0.01 * len(rows)
    assert all(g[2] <= w[2] for g, w in zip(got, want))


def test_join_of_hostile_rows(hostile):
    got = sorted((tuple(r) for r in chosen_path.jaccard_join(hostile).collect()), key=str)
    assert got == brute_join([r[:2] for r in hostile_rows()])


def test_join_of_nothing(nothing):
    assert chosen_path.jaccard_join(nothing).count() == 0


def test_chains_are_one_class(spark):
    """Links that only follow each other, longer than any step of the search for classes."""
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 2000), (2000, 1500)]
    joins = spark.createDataFrame([(b, a) for a, b in pairs], "node long, other long")
    got = {r.node: r.root for r in chosen_path.components(joins).collect()}
    assert all(got[i] == 0 for i in range(1, 201))
    assert {got.get(n, n) for n in (1000, 1500, 2000)} == {1000}


def test_runs_reach_the_recall_over_all_signatures():
    """Pairs at 0.8 drawn at random: signatures that agree more or less, met in buckets split twice."""
    random = np.random.default_rng(4)
    agreement = random.binomial(chosen_path.COORDINATES, 0.8, 400_000) / chosen_path.COORDINATES
    lives = np.ones(len(agreement))
    for width in (chosen_path.WIDER, chosen_path.WIDER, 1.0):
        lives = 1 - np.exp(-width * agreement / 0.8 * lives)
    first = sum(map(len, chosen_path.first_coordinates(chosen_path.runs_needed(0.995))))
    assert ((1 - agreement * lives) ** first).mean() <= 0.005


def test_signatures_estimate_similarity():
    a = chosen_path.shingles(prose(1, 400))
    b = np.unique(np.concatenate([a[: len(a) * 9 // 10], chosen_path.shingles(prose(2, 60))]))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    agree = (chosen_path.signature(a) == chosen_path.signature(b)).mean()
    assert abs(agree - true) < 0.15
    assert chosen_path.alike(np.stack([chosen_path.signature(a)] * 2)).all()


def test_intersections():
    pick = random.Random(2)
    sets = [np.unique(np.array([pick.randrange(50) for _ in range(20)], np.uint64)) for _ in range(30)]
    got = chosen_path.shared_counts(sets)
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(30) for j in range(30) if i != j)


def test_rows_without_an_id_meet_the_sets_of_their_own_text_only(spark):
    """The join that fetches texts carries one row per row at most, however many share an id or lack one."""
    rows = [(None if i % 2 else 7, prose(i, 30)) for i in range(60)] + [(None, prose(1, 30))] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sets = chosen_path.sets_of(docs, "doc_id", "text").cache()
    members = sets.select("doc", "node", "h1", "h2")
    fetched = chosen_path.node_sets(docs, members, members.select("node").distinct(), "doc_id", "text")
    seen = {r.node: r for r in fetched.collect()}
    assert len(seen) == sets.select("node").distinct().count()
    assert sum(r.copies for r in seen.values()) == len(rows)
    for r in sets.collect():
        assert chosen_path.set_number(np.frombuffer(seen[r.node].tokens, np.uint64)) == r.node
    plan = fetched._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, (((" in plan and "h1#" in plan.split("Join Inner", 1)[1].splitlines()[0]
    sets.unpersist()
