"""Byte-level BPE encoding and decoding (operator 4) with a hierarchical-bitmap rank queue.

The symbols of the pre-tokens form a linked list. Every adjacent pair that some merge joins
stands, by its left end, in the bucket of that merge's rank. A bitmap marks the buckets in use
and a second one marks the words of the first, so the next rank is found by two
find-first-set steps however many symbols there are. Entries whose pair has changed since are
skipped when they come up. One queue serves all new pre-tokens of a batch, so that a bucket
holds the pairs of many of them; a very long pre-token has the queue to itself.

- null or empty text: no tokens, and the empty text decoded;
- several rows with one id: one result each; extra columns are ignored;
- every byte is a token, so any text has an encoding and decodes to itself.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from windrow.llm.common import in_batches, kept, load
from windrow.llm.pair_merge import LONG, PairTable, merge_all, merge_one
from windrow.llm.pretokens import Pieces
from windrow.llm.registry import query

#: Bits of one word of the bitmaps: two levels cover a rank below its square.
WORD = 256


class BitmapQueue:
    """Positions by rank. ``pop`` empties the bucket of the smallest rank."""

    def __init__(self, ranks: int):
        self.low = [0] * (ranks // WORD + 1)
        self.high = 0
        self.buckets: dict[int, list[int]] = {}

    def __bool__(self) -> bool:
        return self.high != 0

    def push_group(self, rank: int, positions: list[int]) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.extend(positions)
            return
        self.buckets[rank] = positions
        word = rank // WORD
        self.low[word] |= 1 << (rank % WORD)
        self.high |= 1 << word

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(position)
        else:
            self.push_group(rank, [position])

    def pop(self) -> tuple[int, list[int]]:
        word = (self.high & -self.high).bit_length() - 1
        bits = self.low[word]
        first = bits & -bits
        rank = word * WORD + first.bit_length() - 1
        self.low[word] = bits ^ first
        if bits == first:
            self.high ^= 1 << word
        return rank, self.buckets.pop(rank)


def rank_pairs(ranks: dict[bytes, int]) -> PairTable:
    """Every pair of tokens that together spell a token, under that token's rank.

    Symbols 0 to 255 stand for the bytes, 256 + rank for the longer tokens.
    """
    symbol = {token: token[0] if len(token) == 1 else 256 + rank for token, rank in ranks.items()}
    pairs = (
        (symbol[token[:cut]], symbol[token[cut:]], rank)
        for token, rank in ranks.items()
        for cut in range(1, len(token))
        if token[:cut] in symbol and token[cut:] in symbol
    )
    return PairTable(pairs, {rank: symbol[token] for token, rank in ranks.items() if len(token) > 1})


class Encoder:
    """Little-endian 32-bit ids of pre-tokens by a table of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.whole = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self.table = rank_pairs(ranks)
        self.queue = BitmapQueue(self.table.ranks_size)
        self.id_of = np.arange(self.table.wall, dtype=np.int64) - 256
        for token, rank in ranks.items():
            if len(token) == 1:
                self.id_of[token[0]] = rank
        self.id_of = self.id_of.astype("<u4")

    def __call__(self, words: list[bytes]) -> list[bytes]:
        made = [self.whole.get(word, b"") for word in words]
        short = [i for i, word in enumerate(words) if word and not made[i] and len(word) <= LONG]
        if short:
            symbols, sizes = merge_all([words[i] for i in short], self.table, self.queue)
            ids = self.id_of[symbols].tobytes()
            ends = (np.cumsum(sizes) * 4).tolist()
            for i, start, end in zip(short, [0, *ends], ends):
                made[i] = ids[start:end]
        for i, word in enumerate(words):
            if len(word) > LONG and not made[i]:
                made[i] = self.id_of[merge_one(word, self.table, self.queue)].tobytes()
        return made


def vocabulary(path: str, pattern: str) -> tuple[Pieces[bytes], list[bytes]]:
    """The encoder and the token of every id; one is kept per worker."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    tokens = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return Pieces(pattern, Encoder(ranks), b"".join), tokens


def decode(ids: bytes, tokens: list[bytes]) -> bytes:
    """The bytes that little-endian 32-bit ids stand for."""
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_texts(
    docs: DataFrame,
    path: str,
    pattern: str = public_tokenizers.PATTERN,
    doc_id: str = "doc_id",
    text: str = "text",
    digests: bool = False,
) -> DataFrame:
    """Ids of every text and the text decoded from them.

    Returns the id column with ``n_tokens``, ``ids`` (array of int) and ``decoded`` (binary);
    with ``digests``, ``ids_sha256`` and ``decoded_sha256`` in their place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tokens = kept(("bitmap", path, pattern), lambda: vocabulary(path, pattern))
        for batch in batches:
            encoded = encoder.texts([t or "" for t in batch.column(1).to_pylist()])
            columns = [batch.column(0), pa.array([len(ids) // 4 for ids in encoded], pa.int64())]
            if digests:
                columns.append(pa.array([hashlib.sha256(ids).hexdigest() for ids in encoded], pa.string()))
                again = (hashlib.sha256(decode(ids, tokens)).hexdigest() for ids in encoded)
                columns.append(pa.array(again, pa.string()))
            else:
                columns.append(pa.array([np.frombuffer(ids, "<i4") for ids in encoded], pa.list_(pa.int32())))
                columns.append(pa.array([decode(ids, tokens) for ids in encoded], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)

    last = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    kinds = ["string", "string"] if digests else ["array<int>", "binary"]
    names = [doc_id, "n_tokens", *last]
    key = docs.schema[doc_id].dataType.simpleString()
    schema = f"`{doc_id}` {key}, n_tokens long, {last[0]} {kinds[0]}, {last[1]} {kinds[1]}"
    return in_batches(docs.select(doc_id, text), run, schema)


@query("op4_bpe_bitmap_queue")
def op4_bpe_bitmap_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode all documents; digests of the ids and of the decoded bytes."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_texts(load(spark, sf_dir, "documents"), path, digests=True)
