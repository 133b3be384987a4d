"""The pipeline over documents: five stages, each written and read again by the next.

Every stage but the last returns the columns of documents. What a stage decides takes effect:
rejected documents go, shared lines leave the texts, one document of each group of near copies
stays, contaminated documents go; the last stage encodes what is left.

A row is known by two 64-bit hashes of its id and text, so rows of one id are judged each for itself;
rows equal in both are judged alike. One hash would do up to some billion documents; with more, a
clean document would now and then go with another one of the same hash.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import bpe_bitmap, chosen_path, line_dedup, positional_index, robust_rules
from windrow.llm.common import load, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def row_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def row_key() -> Column:
    return F.concat_ws(":", F.hex(row_hash(0)), F.hex(row_hash(1)))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    judged = robust_rules.quality_rules(docs.select(row_key().alias("doc_id"), "text", "lang", "source"))
    rejected = written(judged.where(~F.col("kept")).select(F.col("doc_id").alias("row")), "rejected")
    # The rejected grow with the documents: they are dealt out like these, however few they are.
    return docs.select(COLUMNS).join(rejected.hint("merge"), row_key() == F.col("row"), "left_anti")


def shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that documents share; ``n_chars`` follows a changed text."""
    left = line_dedup.dedup_lines(docs, carry=("lang", "source", "n_chars"))
    changed = F.when(F.col("n_dropped") > 0, F.length("kept_text").cast("long"))
    return left.select(
        "doc_id",
        F.col("kept_text").alias("text"),
        "carried.lang",
        "carried.source",
        F.coalesce(changed, "carried.n_chars").alias("n_chars"),
    )


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each class of near copies, one row of it."""
    named = docs.select(F.struct("doc_id", row_key().alias("row")).alias("doc_id"), "text")
    classes = chosen_path.jaccard_join(named)
    first = classes.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id.row").alias("first"))
    # Equal rows meet here as well, in the partition that the join needs anyway.
    once = docs.select(*COLUMNS, row_key().alias("row")).dropDuplicates(["row"])
    return once.join(written(first, "first"), F.col("row") == F.col("first"), "left_semi").select(COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents of which a twentieth or more repeats a benchmark item."""
    items = load(spark, sf_dir, "benchmark")

    def hit(rows: DataFrame, seed: int) -> DataFrame:
        """Hashes of the contaminated: the index numbers documents by one hash."""
        index = positional_index.build_index(rows.select(row_hash(seed).alias("doc_id"), "text"))
        judged = positional_index.contamination(positional_index.search_index(index, items)).where("contaminated")
        return written(judged.select(F.col("doc_id").alias(f"hit{seed}")), "contaminated")

    # The few that the first hash names are looked at again under the second one.
    named = docs.select(COLUMNS).join(hit(docs, 0), row_hash(0) == F.col("hit0"), "left_semi")
    named = written(named, "named")
    out = named.join(hit(named, 1), row_hash(1) == F.col("hit1"), "left_semi").select(row_key().alias("out"))
    return docs.select(COLUMNS).join(written(out, "out"), row_key() == F.col("out"), "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and a digest of what they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe_bitmap.encode_texts(docs, path)
    return encoded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", shared_lines),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", decontaminate),
    ("byte_bpe_encoding", encode),
]

#: Robust estimates, the join's random trees and the merges have no SQL form; the tests check the rows
#: against the five stages written plainly in Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written as Parquet and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
