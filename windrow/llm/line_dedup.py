"""Drop lines that many documents share (operator 9), with DataFrame functions only.

Lines are keyed by two 64-bit hashes of the normalised line. One aggregation finds, per key,
the smallest and the largest document holding it; they differ exactly when two documents do.
A key held by more documents than the threshold is counted by distinct documents. Only
(hash, id, position) is shuffled by line; the texts move once, by document.

- null or empty text: one empty line, kept; a null stays null;
- a line repeated inside one document only: kept; repeated inside the keeping document: kept;
- rows with one ``doc_id``: one document for the counts; each row loses its own lines;
- null ``doc_id``: the row is left as it is and counts for no line;
- extra columns are ignored: the result has the columns named below only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm.common import BLANKS, load
from windrow.llm.registry import query

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A to Z lower-cased and nothing else."""
    bare = F.trim(line, F.lit(BLANKS))
    ascii_only = F.length(bare) == F.octet_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def shared_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Keys in at least ``min_docs`` documents, with the smallest document holding each."""
    # Grouped by a struct, the keys found are dealt anew for the join, whose both sides are then
    # plain shuffles: adaptive execution can split a line that very many documents hold.
    key = F.struct("h1", "h2").alias("key")
    if min_docs <= 2:
        found = lines.groupBy(key).agg(F.min("doc").alias("keeper"), F.max("doc").alias("last"))
        found = found.where((F.col("keeper") != F.col("last")) | F.lit(min_docs < 2))
    else:
        once = lines.select("h1", "h2", "doc").distinct()
        found = once.groupBy(key).agg(F.min("doc").alias("keeper"), F.count("*").alias("docs"))
        found = found.where(F.col("docs") >= min_docs)
    return found.select("key.h1", "key.h2", "keeper")


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = 10,
    min_docs: int = 2,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Each row's id, its text without shared lines, the lines before and the lines dropped.

    Returns ``doc_id, kept_text, n_lines, n_dropped`` and ``carried``, a struct of the columns
    to carry along.
    """
    # The lines travel as an array, split once; a lambda over the text would split it per line.
    given = docs.select(
        F.col(doc_id).alias("doc"),
        F.xxhash64(text).alias("row"),
        F.split(F.col(text), "\n", -1).alias("body"),
        F.struct(F.lit(None).cast("boolean").alias("none"), *carry).alias("carried"),
    )
    lines = (
        given.where(F.col("doc").isNotNull())
        .select("doc", "row", F.posexplode("body").alias("at", "line"))
        .select("doc", "row", "at", line_key(F.col("line")).alias("key"))
        .where(F.length("key") >= min_length)
        .select("doc", "row", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    shared = shared_lines(lines, min_docs)
    lost = (
        lines.join(shared, ["h1", "h2"])
        .where(F.col("doc") != F.col("keeper"))
        .groupBy("doc", "row")
        .agg(F.collect_set("at").alias("lost"))
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("body") - 1), F.col("lost"))
    kept = F.when(F.col("lost").isNull(), F.array_join("body", "\n")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col("body"), i)), "\n")
    )
    return given.join(lost, ["doc", "row"], "left").select(
        F.col("doc").alias(doc_id),
        kept.alias("kept_text"),
        # The size of a null is null or -1, as the session's ANSI mode has it.
        F.when(F.col("body").isNull(), 1).otherwise(F.size("body")).cast("long").alias("n_lines"),
        F.when(F.col("lost").isNull(), 0).otherwise(F.size("lost")).cast("long").alias("n_dropped"),
        "carried",
    )


OP9_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line, translate(
    trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.doc_id, k.pos, k.line, s.keeper IS NOT NULL AND s.keeper <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN shared s USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, sum(dropped::INT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query("op9_line_dedup", OP9_SQL)
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of all documents, the kept text as a digest."""
    result = dedup_lines(load(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256)
    return result.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))
