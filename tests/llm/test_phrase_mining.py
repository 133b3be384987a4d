"""Collocations against plain counting in Python."""

import random
import re
from collections import Counter, defaultdict

import pytest
from conftest_llm import hostile_rows

from windrow.llm import packing, phrase_mining
from windrow.llm.phrase_mining import mine_phrases
from windrow.llm.queries import ORACLES, QUERIES

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plainly(rows, max_words=3, min_count=10, share=50, top=2000):
    """``rows`` are (text, lang)."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    f[lang][tuple(words[i : i + size])] += 1
    result = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        inside = Counter()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], a)
        scored = []
        for p, a in candidates.items():
            if 100 * inside[p] >= share * a:
                continue
            score, k = min((1000000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            result.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(result)


def got(frame):
    return sorted(tuple(r) for r in frame.collect())


def corpus(seed, docs, vocabulary=40):
    pick = random.Random(seed)
    words = [f"W{i}" if i % 3 else f"ö{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    rows = []
    for _ in range(docs):
        said = pick.choices(words, weights, k=pick.randint(0, 60))
        ends = pick.choices([" ", "  ", "\t", ". ", "\n", ",", " ; "], [60, 5, 3, 5, 5, 3, 1], k=len(said))
        rows.append(("".join(a + b for a, b in zip(said, ends)), pick.choice(["en", "en", "en", "de", None, "und"])))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string").repartition(5)


SIZES = ("BLOCK_WORDS", "PART_ROWS", "FAN", "RANGE_ROWS", "RANK_ROWS")


@pytest.mark.parametrize(("chunk", "sizes"), [(10**6, [10**6] * 5), (20, [50, 1500, 256, 40, 30]), (50, [200, 1200, 3, 500, 900])])
def test_small_blocks_levels_ranges_and_slices_change_nothing(spark, monkeypatch, chunk, sizes):
    monkeypatch.setattr(packing, "CHUNK_BYTES", chunk)
    for name, value in zip(SIZES, sizes):
        monkeypatch.setattr(phrase_mining, name, value)
    rows = corpus(3, 150)
    assert got(mine_phrases(frame(spark, rows))) == plainly(rows)


def test_longer_phrases_and_few_ranks(spark):
    rows = corpus(5, 120, 12)
    want = plainly(rows, max_words=5, min_count=4, share=70, top=25)
    assert got(mine_phrases(frame(spark, rows), max_words=5, min_count=4, share=70, top=25)) == want


def test_a_word_pair_in_a_third_of_all_rows_and_odd_bytes(spark):
    rows = [("very common pair " * 40, "en")] * 30 + corpus(8, 60)
    rows += [("a\x00b \x01c a\x00b \x01c " * 8, "en"), ("a \x01\x01 " * 12, "en"), ("a \x00 " * 12, "en"), ("x" * 5000 + " y ", "e\x00n")]
    assert got(mine_phrases(frame(spark, rows))) == plainly(rows)


def test_hostile_rows_and_nothing(spark, hostile, nothing):
    want = plainly([(r[1], r[2]) for r in hostile_rows()])
    assert got(mine_phrases(hostile)) == want
    empty = mine_phrases(nothing)
    assert empty.count() == 0
    assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_counts_beyond_64_bits_stay_exact(spark):
    big = 3_000_000_019
    row = [([big + 7], [big + 11], big, 2)]
    cut = spark.createDataFrame(row, "lefts array<long>, rights array<long>, a long, size int").select(phrase_mining.lowest_cut()["score"])
    assert cut.first()[0] == 1_000_000 * big * big // ((big + 7) * (big + 11))


def test_query_over_all_documents(spark, small):
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    assert got(QUERIES["op12_stream_collocations"](spark, small)) == plainly(rows)
    assert "op12_stream_collocations" in ORACLES
