"""Token counts (operator 8) by heap-and-linked-list byte-pair merging.

The symbols of a pre-token form a linked list, and a heap holds the rank and place of every pair that
some merge joins. The lowest is popped again and again and its pair merged if it still stands;
the count starts at the number of bytes and falls by one with each merge. No identifier is
emitted: what is left in the list is never looked at.

- null or empty text: no bytes, no tokens;
- a special token's text inside a document is that one token, as the library has it;
- several rows with one id: one result each; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from windrow.llm.common import in_batches, kept, load
from windrow.llm.pretokens import Pieces
from windrow.llm.registry import query


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte, back to the byte.

    Bytes that print as themselves in Latin-1 keep their letter; the others take the letters
    from 256 on, in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Counter:
    """Numbers of tokens of pre-tokens, by a list of merges."""

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        number: dict[bytes, int] = {bytes([b]): b for b in range(256)}
        for left, right in merges:
            number.setdefault(left + right, len(number))
        #: What a merge leaves behind, by rank; only there to look up further pairs.
        self.made = [number[a + b] for a, b in merges]
        # Of equal pairs the first one counts.
        self.rank_of = {number[a] << 32 | number[b]: rank for rank, (a, b) in reversed([*enumerate(merges)])}
        #: Ranks of pairs of bytes, -1 where no merge joins them.
        self.first = [self.rank_of.get(a << 32 | b, -1) for a in range(256) for b in range(256)]

    def count(self, word: bytes) -> int:
        """The bytes of a pre-token less its merges.

        The heap holds a pair's rank and its place, so the lowest rank comes first and the leftmost of
        equal ones. An entry is stale if the pair that now stands at its place has another rank.
        """
        first, get, made = self.first, self.rank_of.get, self.made
        waiting = [first[a << 8 | b] for a, b in zip(word, word[1:])]
        heap = [rank << 32 | i for i, rank in enumerate(waiting) if rank >= 0]
        tokens = n = len(word)
        if not heap:
            return tokens
        heapify(heap)
        waiting += (-1, -1)
        symbol = [*word, -1]
        after, before = [*range(1, n + 2)], [*range(-1, n)]
        while heap:
            entry = heappop(heap)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            if waiting[i] != rank:
                continue
            tokens -= 1
            j = after[i]
            new, k, h = made[rank], after[j], before[i]
            symbol[i], after[i], before[k], waiting[j] = new, k, i, -1
            rank = waiting[i] = get(new << 32 | symbol[k], -1)
            if rank >= 0:
                heappush(heap, rank << 32 | i)
            if h >= 0:
                rank = waiting[h] = get(symbol[h] << 32 | new, -1)
                if rank >= 0:
                    heappush(heap, rank << 32 | h)
        return tokens

    def __call__(self, words: list[bytes]) -> list[int]:
        return [*map(self.count, words)]


def tokenizer(path: str, pattern: str) -> tuple[Pieces[int], regex.Pattern | None]:
    """The counter of a byte-level vocabulary file and the pattern of its special tokens."""
    with open(path, encoding="utf-8") as file:
        said = json.load(file)
    letters = byte_letters()
    merges = []
    for merge in said["model"]["merges"]:
        left, right = merge if isinstance(merge, list) else merge.split(" ")
        merges.append((bytes(letters[c] for c in left), bytes(letters[c] for c in right)))
    special = sorted((t["content"] for t in said["added_tokens"]), key=len, reverse=True)
    marks = regex.compile("|".join(map(regex.escape, special))) if special else None
    return Pieces(pattern, Counter(merges), sum), marks


def count_tokens(
    docs: DataFrame,
    path: str,
    pattern: str = public_tokenizers.PATTERN,
    limit: int = 512,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Bytes and tokens of every text, and whether they are more than ``limit``.

    Returns the id column with ``n_bytes``, ``n_tokens`` and ``over_limit``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, marks = kept(("heap", path, pattern), lambda: tokenizer(path, pattern))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            parts = [marks.split(t) if marks else [t] for t in texts]
            each = iter(counts.texts([p for some in parts for p in some]))
            # A special token stands between two parts and is one token.
            tokens = [sum(next(each) for _ in some) + len(some) - 1 for some in parts]
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in texts]
            over = [n > limit for n in tokens]
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(over, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, [doc_id, "n_bytes", "n_tokens", "over_limit"])

    key = docs.schema[doc_id].dataType.simpleString()
    schema = f"`{doc_id}` {key}, n_bytes long, n_tokens long, over_limit boolean"
    return in_batches(docs.select(doc_id, text), run, schema)


@query("op8_bpe_heap_counts")
def op8_bpe_heap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(load(spark, sf_dir, "documents"), path)
