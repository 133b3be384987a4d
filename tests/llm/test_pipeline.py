"""The pipeline stage by stage: against the operators' own brute force, and its guard."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from test_lines_and_archives import brute_lines
from test_search_and_join import brute_hits, brute_join, near_rows

import corpus_pipeline
from windrow.session import scratch_dir

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def items(spark):
    """A folder with a benchmark of its own."""
    folder = scratch_dir(spark, "items")
    spark.createDataFrame([(1, "seven wizards box many quiet jackals under"), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def docs_of(spark, rows):
    return spark.createDataFrame([(k, t, "en", "a", len(t or "")) for k, t in rows], SCHEMA).repartition(4)


def test_line_stage(spark, items):
    rows = [(1, "a line held by two\nown one"), (2, "A line held by two \nmine"), (2, None), (None, "a line held by two")]
    got = stage("line_dedup")(spark, docs_of(spark, rows), items)
    assert got.columns == corpus_pipeline.COLUMNS
    want = [(k, t) for k, t, *_ in brute_lines(rows)]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text or "") for r in got.collect())


def test_join_stage_keeps_one_of_each_group(spark, items):
    rows = near_rows(seed=8, groups=6, hot=60)
    rows += rows[:3]
    got = sorted(r.doc_id for r in stage("ngram_jaccard_join")(spark, docs_of(spark, rows), items).collect())
    assert got == sorted({k for k, c, _ in brute_join(rows) if k == c})


def test_decontamination_stage(spark, items):
    rows = [(1, "x seven wizards box many quiet jackals under y"), (2, "seven wizards box many quiet jackals"), (3, None), (None, "seven wizards box many quiet jackals under")]
    rows.append((4, " ".join(f"w{i}" for i in range(400)) + " seven wizards box many quiet jackals under"))
    got = [r.doc_id for r in stage("benchmark_decontamination")(spark, docs_of(spark, rows), items).collect()]
    asked = [(1, "seven wizards box many quiet jackals under")]
    want = [k for k, t in rows for n, hit, _ in [brute_hits(t, asked)] if not (hit and 20 * hit >= n)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_every_stage_takes_hostile_rows_and_none(spark, hostile, nothing, items):
    for docs in (hostile, nothing):
        for name, fn in corpus_pipeline.STAGES:
            result = fn(spark, docs, items)
            if name != "byte_bpe_encoding":
                assert result.columns == corpus_pipeline.COLUMNS
                assert dict(result.dtypes) == dict(nothing.dtypes)
            assert result.count() <= docs.count()


def test_whole_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, fn in corpus_pipeline.STAGES:
        docs = fn(spark, docs, small)
    by_hand = sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in docs.collect())
    assert by_hand == sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in corpus_pipeline.run(spark, small).collect())
    assert 0 < len(by_hand) < spark.read.parquet(f"{small}/documents.parquet").count()


def base_fails(text):
    """The base rules by their words."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    times = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if times[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(words) < 10 or 100 * len(covered) > 20 * len(words)


def test_whole_pipeline_against_plain_python(spark):
    """Five stages over documents whose outliers are plain to see, each written in a few lines."""
    pick = random.Random(12)
    words = [f"word{i}" for i in range(900)]
    said = lambda n: "\n".join(" ".join(pick.choices(words, k=12)) for _ in range(n))
    item = " ".join(pick.choices(words, k=9))
    rows = [(i, said(pick.randint(5, 9))) for i in range(140)]
    odd = {200 + i: re.sub(r"(\w+)", r"\1####", said(6)) for i in range(8)}
    rows += list(odd.items())
    rows += [(300, "too short"), (301, None), (302, "one two three four five " * 9), (303, "")]
    shared = "a line that several documents hold in common"
    rows += [(400 + i, f"{said(6)}\n{shared.upper() if i % 2 else shared}") for i in range(6)]
    rows += [(500 + i, rows[i][1] + (" more" if i % 2 else "")) for i in range(8)]
    rows += [(600 + i, f"{said(2)} {item} {said(1)}" if i else f"{said(40)} {item}") for i in range(4)]
    rows += [rows[30], (30, said(7)), (None, said(7)), (None, said(7))]
    folder = scratch_dir(spark, "plain")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs_of(spark, rows).write.parquet(f"{folder}/documents.parquet")

    left = [(k, t) for k, t in rows if not base_fails(t) and k not in odd]
    left = [(k, t) for k, t, *_ in brute_lines(left)]
    classes = brute_join([(i, t) for i, (_, t) in enumerate(sorted(left, key=lambda r: (r[0] is not None, r[0] or 0)))])
    ranked = sorted(left, key=lambda r: (r[0] is not None, r[0] or 0))
    left = [ranked[i] for i, c, _ in classes if i == c]
    left = [(k, t) for k, t in left for n, hit, _ in [brute_hits(t, [(1, item)])] if not (hit and 20 * hit >= n)]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    from tiktoken.load import load_tiktoken_bpe

    library = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
    want = [(k, library.encode_ordinary(t), hashlib.sha256(t.encode()).hexdigest()) for k, t in left]
    got = [(r.doc_id, list(r.ids), r.decoded_sha256) for r in corpus_pipeline.run(spark, folder).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert len(got) > 130 and len([k for k, *_ in got if k is None]) == 2


def test_registered(spark):
    import __spark_entry__ as contract

    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "byte_bpe_encoding"]
    numbers = {name.split("_")[0] for name in contract.queries() if name.startswith("op")}
    assert numbers == {f"op{n}" for n in range(1, 14)} and "pipeline" in contract.queries()
