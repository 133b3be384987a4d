"""Encoding, decoding and counting against the public libraries."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest_llm import hostile_rows
from tokenizers import Tokenizer

from windrow.llm import bpe_bitmap, bpe_heap, pair_merge
from windrow.llm.registry import QUERIES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def counter():
    return Tokenizer.from_file(JSON)


def texts(n):
    pick = random.Random(5)
    out = []
    for i in range(n):
        kind = i % 4
        if kind == 0:
            out.append("".join(pick.choice("ab c\n\t  'st.,19é　\x85\x1c ") for _ in range(pick.randrange(80))))
        elif kind == 1:
            points = [pick.randrange(32, 127), pick.randrange(0x100, 0x3000), pick.randrange(0x4E00, 0x9FFF), pick.randrange(32)]
            out.append("".join(chr(pick.choice(points)) for _ in range(40)))
        elif kind == 2:
            out.append("".join(chr(c) for c in (pick.randrange(0x20, 0x30000) for _ in range(30)) if not 0xD800 <= c < 0xE000))
        else:
            out.append("ab" * pick.randrange(120) + "<|endoftext|>" * pick.randrange(3) + "a" * pick.randrange(300) + " x")
    return out


def test_encoding_equals_the_library(library):
    encoder, tokens = bpe_bitmap.vocabulary(RANKS, public_tokenizers.PATTERN)
    given = texts(400)
    for text, ids in zip(given, encoder.texts(given)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert bpe_bitmap.decode(ids, tokens) == text.encode()


def test_counts_equal_the_library(counter):
    counts, marks = bpe_heap.tokenizer(JSON, public_tokenizers.PATTERN)
    for text in texts(400):
        parts = marks.split(text)
        assert sum(counts.texts(parts)) + len(parts) - 1 == len(counter.encode(text, add_special_tokens=False).ids)


def test_a_merge_that_makes_a_smaller_rank_goes_first():
    # bc (2) makes abc (0) possible, which must take a before the second bc is looked at.
    ranks = {bytes([b]): 10 + b for b in range(256)} | {b"abc": 0, b"bc": 2, b"cb": 3, b"abcb": 1}
    library = tiktoken.Encoding("own", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})
    encode = bpe_bitmap.Encoder(ranks)
    for text in ("abcbc", "bcabcb", "abcabcbc", "cbcbcba", "abc" * 40 + "bcbcb" * 9):
        assert np.frombuffer(encode([text.encode()])[0], "<u4").tolist() == library.encode_ordinary(text)


def test_many_words_at_once_equal_one_by_one():
    words = [t.encode() for t in texts(300) if t][:200]
    words = [w[:60] for w in words]
    encoder = bpe_bitmap.vocabulary(RANKS, public_tokenizers.PATTERN)[0].encode
    symbols, sizes = pair_merge.merge_all(words, encoder.table, encoder.queue)
    alone = [pair_merge.merge_one(w, encoder.table, encoder.queue) for w in words]
    assert symbols.tolist() == [s for some in alone for s in some]
    assert sizes.tolist() == [len(some) for some in alone]


def test_a_very_long_word():
    encoder = bpe_bitmap.vocabulary(RANKS, public_tokenizers.PATTERN)[0]
    assert len(encoder.texts(["a" * 300_000])[0]) > 0


def test_queues_pop_in_order():
    pick = random.Random(1)
    for queue in (bpe_bitmap.BitmapQueue(70_000),):
        want = {}
        for _ in range(500):
            rank = pick.randrange(70_000)
            queue.push(rank, rank % 7)
            want.setdefault(rank, []).append(rank % 7)
        got = []
        while queue:
            got.append(queue.pop())
        assert got == sorted(want.items())


def test_heap_counts_against_merging_by_hand():
    """Random merges over few letters, where many entries of the heap go stale; lowest rank first, leftmost of equal ones."""
    pick = random.Random(6)
    for _ in range(30):
        known, merges = [bytes([b]) for b in b"abc"], []
        while len(merges) < 25:
            pair = (pick.choice(known), pick.choice(known))
            if pair not in merges and len(b"".join(pair)) < 9:
                merges.append(pair)
                known.append(b"".join(pair))
        counter = bpe_heap.Counter(merges)
        for _ in range(40):
            word = bytes(pick.choices(b"abc", k=pick.randint(0, 40)))
            parts = [bytes([b]) for b in word]
            while True:
                ranked = [(merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
                if not ranked:
                    break
                _, i = min(ranked)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert counter.count(word) == len(parts)


def test_hostile_rows(hostile, library, counter):
    got = bpe_bitmap.encode_texts(hostile, RANKS).collect()
    want = sorted((r[0] or -1, library.encode_ordinary(r[1] or "")) for r in hostile_rows())
    assert sorted((r.doc_id or -1, list(r.ids)) for r in got) == want
    assert all(r.n_tokens == len(r.ids) for r in got)
    texts_by_id = {(r[0], r[1] or "") for r in hostile_rows()}
    assert {(r.doc_id, bytes(r.decoded).decode()) for r in got} == texts_by_id
    got = bpe_heap.count_tokens(hostile, JSON).collect()
    want = sorted(
        (r[0] or -1, len((r[1] or "").encode()), len(counter.encode(r[1] or "", add_special_tokens=False).ids))
        for r in hostile_rows()
    )
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_no_rows(nothing):
    assert bpe_bitmap.encode_texts(nothing, RANKS).count() == 0
    assert bpe_heap.count_tokens(nothing, JSON).count() == 0


def test_queries_over_all_documents(spark, small, library, counter):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = QUERIES["op4_bpe_bitmap_queue"](spark, small).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = np.array(library.encode_ordinary(docs[r.doc_id]), "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    got = QUERIES["op8_bpe_heap_counts"](spark, small).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {
        k: len(counter.encode(t, add_special_tokens=False).ids) for k, t in docs.items()
    }
